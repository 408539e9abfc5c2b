"""Holiday-weighted error and the reports built on it."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import abs_error, fit_status, gap_pct, holiday_weight
from .joins import join_holidays

PLAUSIBLE_FACTOR = 50.0


def wmae_expr(y="y", p="prediction", holiday="IsHoliday") -> Column:
    """Weighted mean absolute error as an aggregate expression.

    A missing prediction adds nothing to the numerator while its weight stays in the denominator,
    so rows must not be filtered first.
    """
    w = holiday_weight(holiday)
    return F.sum(w * abs_error(y, p)) / F.sum(w)


def wmae(df: DataFrame, y="y", p="prediction", holiday="IsHoliday", by: Sequence[str] = ()) -> DataFrame:
    return df.groupBy(*by).agg(wmae_expr(y, p, holiday).alias("wmae"))


def mae_by(df: DataFrame, by: Sequence[str], y="y", p="prediction") -> DataFrame:
    return df.groupBy(*by).agg(F.avg(abs_error(y, p)).alias("mae"), F.count("*").alias("n"))


def worst_series(df: DataFrame, k: int = 15, by: Sequence[str] = ("Store", "Dept"), y="y", p="prediction") -> DataFrame:
    """The k series with the largest mean error; ties go to the smaller key."""
    return mae_by(df, by, y, p).orderBy(F.desc_nulls_last("mae"), *by).limit(k)


def evaluate_forecast(oof: DataFrame, holidays: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Out-of-fold frame (unique_id, ds, y, prediction) -> weighted error."""
    return wmae(join_holidays(oof, holidays), by=by)


def fit_report(errors: DataFrame) -> DataFrame:
    """Adds gap_pct and status to (train_wmae, val_wmae)."""
    out = errors.withColumn("gap_pct", gap_pct("train_wmae", "val_wmae"))
    return out.withColumn("status", fit_status("gap_pct"))


def train_val_report(scored: DataFrame, by: Sequence[str] = ("label",)) -> DataFrame:
    """Training and validation error side by side from one pass over (label, is_train, ...)."""
    w = holiday_weight("IsHoliday")
    e = w * abs_error("y", "prediction")

    def side(train: bool):
        hit = F.col("is_train") == train
        return F.sum(F.when(hit, e)) / F.sum(F.when(hit, w))

    return fit_report(scored.groupBy(*by).agg(side(True).alias("train_wmae"), side(False).alias("val_wmae")))


def run_report(scored: DataFrame, key: str = "unique_id") -> DataFrame:
    """Per label: errors, gap, status, series scored and series that fell back, in one pass.

    Rows are (label, unique_id, is_train, IsHoliday, y, prediction, used_fallback); they are summed
    per series first, so the second step moves one row per run and series.  Training rows without
    a fitted value (a series on its fallback, weeks before the model's reach) are not scored.
    """
    w = holiday_weight("IsHoliday")
    e = w * abs_error("y", "prediction")
    held_out = ~F.col("is_train")
    fitted = F.col("is_train") & F.col("prediction").isNotNull() & ~F.isnan("prediction")
    by_series = scored.groupBy("label", key).agg(
        F.sum(F.when(fitted, e)).alias("train_e"), F.sum(F.when(fitted, w)).alias("train_w"),
        F.sum(F.when(held_out, e)).alias("val_e"), F.sum(F.when(held_out, w)).alias("val_w"),
        F.max(F.when(held_out, F.col("used_fallback").cast("int"))).alias("fell"))
    out = by_series.groupBy("label").agg(
        (F.sum("train_e") / F.sum("train_w")).alias("train_wmae"), (F.sum("val_e") / F.sum("val_w")).alias("val_wmae"),
        F.sum("fell").alias("fallback_series"), F.count("fell").alias("series"))
    return fit_report(out)


def plausible(forecast: DataFrame, history: DataFrame, key: str = "unique_id", factor: float = PLAUSIBLE_FACTOR) -> DataFrame:
    """Per series: is the forecast finite, not empty and at most ``factor`` times the history?

    The bound is at least 1 and uses the known values only.
    """
    y = F.when(~F.isnan("y"), F.col("y"))
    scale = history.groupBy(key).agg(F.max(F.abs(y)).alias("scale"))
    p = F.col("prediction")
    good = p.isNotNull() & ~F.isnan(p) & (F.abs(p) < float("inf"))
    shape = forecast.groupBy(key).agg(
        F.bool_and(good).alias("finite"), F.max(F.abs(F.when(good, p))).alias("largest"))
    bound = F.greatest(F.coalesce(F.col("scale") * factor, F.lit(1.0)), F.lit(1.0))
    out = scale.join(shape, key, "full")
    ok = F.coalesce(F.col("finite") & (F.col("largest") <= bound), F.lit(False))
    return out.select(key, ok.alias("plausible"))


def flag_fallback(oof: DataFrame, prediction: str = "prediction") -> DataFrame:
    """``used_fallback``: the model gave no value for the row."""
    return oof.withColumn("used_fallback", F.col(prediction).isNull())
