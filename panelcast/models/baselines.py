"""Forecasts that need no fitted model, and the ledger they produce."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.scalars import fallback_chain
from ..operators.aggregates import last_value_by_series
from ..operators.lags import calendar_lags
from ..operators.metrics import run_report
from ..operators.panel import future_grid
from ..operators.quantiles import exact_median

# Fixed values: (experiment, label, regime) of the baseline sweep, in ledger order.
BASELINE_RUNS = [
    ("Seasonal", "seasonal_52", "balanced"),
    ("Seasonal", "seasonal_104", "underfit"),
    ("Seasonal", "smooth_52", "balanced"),
    ("Constant", "last_value", "underfit"),
    ("Constant", "series_mean", "underfit"),
    ("Constant", "overall_median", "underfit"),
    ("Growth", "doubling", "overfit"),
]


def fallbacks(history: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(last value per series, overall median) of a long panel (unique_id, ds, y)."""
    return last_value_by_series(history), exact_median(history, "y", "median_y")


def seasonal_naive(history: DataFrame, requests: DataFrame, weeks: int = 52) -> DataFrame:
    """The value of the same week ``weeks`` earlier, else the series' last, else the median.

    Both frames carry unique_id, Store, Dept, Date; the result keeps the request rows.
    """
    past = history.select("Store", "Dept", "Date", "Weekly_Sales")
    lagged = calendar_lags(past, requests.drop("Weekly_Sales"), weeks, last_value="last_y")
    overall = exact_median(history, "Weekly_Sales", "median_y")
    filled = fallback_chain(f"lag_{weeks}", "last_y", "median_y")
    return lagged.crossJoin(F.broadcast(overall)).select(*requests.drop("Weekly_Sales").columns, filled.alias("prediction"))


def last_value_forecast(long: DataFrame, horizon: int) -> DataFrame:
    """The last known value repeated over the weeks after the series' end."""
    return future_grid(long, horizon).join(last_value_by_series(long), "unique_id", "left").select(
        "unique_id", "ds", F.col("last_y").alias("prediction"))


def baseline_predictions(fact: DataFrame, cutoff: Column) -> DataFrame:
    """Every baseline for every row: (label, unique_id, Date, IsHoliday, is_train, y, prediction,
    used_fallback).  History ends at ``cutoff``; one shuffle by series serves all baselines."""
    rows = calendar_lags(fact.withColumn("is_train", F.col("Date") < cutoff), weeks=[52, 104], cutoff=cutoff, last_value="last_y")
    series = W.partitionBy("Store", "Dept")
    past = F.when(F.col("is_train"), F.col("Weekly_Sales"))
    median = exact_median(fact.filter(F.col("Date") < cutoff), "Weekly_Sales", "median_y")
    rows = rows.withColumns({
        "mean_y": F.avg(past).over(series),
        "weeks_ahead": F.when(~F.col("is_train"), F.datediff(F.col("Date"), cutoff) / 7 + 1).otherwise(0),
    }).crossJoin(F.broadcast(median))
    raw = {
        "seasonal_52": F.col("lag_52"), "seasonal_104": F.col("lag_104"),
        "smooth_52": F.col("roll_mean_26_lag52"), "last_value": F.col("last_y"),
        "series_mean": F.col("mean_y"), "overall_median": F.col("median_y"),
        "doubling": F.col("last_y") * F.pow(F.lit(2.0), F.col("weeks_ahead")),
    }
    runs = F.array(*[
        F.struct(F.lit(k).alias("label"), v.cast("double").alias("prediction")) for k, v in raw.items()])
    out = rows.select("unique_id", "Date", "IsHoliday", "is_train", F.col("Weekly_Sales").alias("y"),
                      "last_y", "median_y", F.explode(runs).alias("r"))
    return out.select(
        "r.label", "unique_id", "Date", "IsHoliday", "is_train", "y",
        F.coalesce("r.prediction", "last_y", "median_y").alias("prediction"),
        F.col("r.prediction").isNull().alias("used_fallback"))


def baseline_ledger(fact: DataFrame, cutoff: Column) -> DataFrame:
    """Run ledger of the baseline sweep.

    A run in which more than half of the series needed the fallback counts as failed.
    """
    report = run_report(baseline_predictions(fact, cutoff))
    runs = F.array(*[
        F.struct(F.lit(e).alias("experiment"), F.lit(k).alias("label"), F.lit(r).alias("regime"), F.lit(i).alias("seq"))
        for i, (e, k, r) in enumerate(BASELINE_RUNS)])
    names = report.withColumn("run", F.filter(runs, lambda x: x["label"] == F.col("label"))[0])
    run_status = F.when(F.col("fallback_series") * 2 > F.col("series"), "FAILED").otherwise("FINISHED")
    return names.select(
        "run.seq", "run.experiment", "label", "run.regime", "train_wmae", "val_wmae", "gap_pct", "status",
        "fallback_series", run_status.alias("run_status"),
        F.substring(F.md5(F.col("label")), 1, 12).alias("run_id"))
