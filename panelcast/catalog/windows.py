"""Window functions."""

from pyspark.sql import functions as F

from ..operators import clean, lags, panel, split
from ..sources import tables
from . import registry as r
from .registry import query, text


def _fact(spark, sf_dir, grain="ragged"):
    return tables.staged_fact(spark, sf_dir, grain)


SERIES = "PARTITION BY unique_id ORDER BY Date"


@query("lag_positional", text(r.panel(), f"""
SELECT unique_id, Date, lag(Weekly_Sales, 26) OVER w AS lag_26, lag(Weekly_Sales, 52) OVER w AS lag_52
FROM panel WINDOW w AS ({SERIES})"""))
def lag_positional(spark, sf_dir):
    return lags.lag_positional(_fact(spark, sf_dir)).select("unique_id", "Date", "lag_26", "lag_52")


def _frame(w):
    return f"({SERIES} ROWS BETWEEN {26 + w - 1} PRECEDING AND 26 PRECEDING)"


ROLLING = ", ".join(
    f"AVG(Weekly_Sales) OVER {_frame(w)} AS rolling_mean_{w}, "
    f"round(coalesce(stddev_samp(Weekly_Sales) OVER {_frame(w)}, 0), 2) AS rolling_std_{w}" for w in (4, 13, 26))


@query("rolling_positional", text(r.panel(), f"SELECT unique_id, Date, {ROLLING} FROM panel"))
def rolling_positional(spark, sf_dir):
    out = lags.rolling_positional(_fact(spark, sf_dir))
    return out.select("unique_id", "Date", *[
        c for w in (4, 13, 26) for c in (F.col(f"rolling_mean_{w}"), F.round(f"rolling_std_{w}", 2).alias(f"rolling_std_{w}"))])


@query("rolling_calendar", text(r.panel(), r.SPINE.format(source="panel"), """
SELECT unique_id, Date, y, roll_mean_26, round(roll_std_26, 2) AS roll_std_26 FROM spine"""))
def rolling_calendar(spark, sf_dir):
    long = _fact(spark, sf_dir).select("unique_id", "Date", F.col("Weekly_Sales").alias("y"))
    out = lags.rolling_calendar(panel.weekly_spine(long, date="Date"))
    return out.withColumn("roll_std_26", F.round("roll_std_26", 2))


@query("lagged_rolling_calendar", text(r.panel(), r.CUT, r.SPINE.format(source="train"), """
SELECT v.unique_id, v.Date, s.y AS lag_52, s.roll_mean_26 AS roll_mean_26_lag52, round(s.roll_std_26, 2) AS roll_std_26_lag52
FROM valid v LEFT JOIN spine s ON s.unique_id = v.unique_id AND s.Date = v.Date - 364"""))
def lagged_rolling_calendar(spark, sf_dir):
    train, valid = split.time_split(_fact(spark, sf_dir), tables.HORIZON)
    out = lags.calendar_lags(train.select("Store", "Dept", "Date", "Weekly_Sales"), valid.drop("Weekly_Sales"))
    return out.select("unique_id", "Date", "lag_52", "roll_mean_26_lag52",
                      F.round("roll_std_26_lag52", 2).alias("roll_std_26_lag52"))


@query("ffill_bfill", text(r.covariates(), r.CLEAN, "SELECT Store, Date, CPI, Unemployment FROM clean"))
def ffill_bfill(spark, sf_dir):
    df = tables.staged_covariates(spark, sf_dir).select("Store", "Date", "CPI", "Unemployment")
    return clean.ffill_bfill(df, ["CPI", "Unemployment"])


@query("ffill_bfill_merged", text(r.panel(), r.covariates(), """
merged AS (SELECT unique_id, p.Store, Dept, p.Date, CPI, MarkDown3 FROM panel p
  LEFT JOIN covariates c ON c.Store = p.Store AND c.Date = p.Date)""", """
SELECT unique_id, Date,
  coalesce(last_value(CPI IGNORE NULLS) OVER p, first_value(CPI IGNORE NULLS) OVER f) AS CPI,
  coalesce(last_value(MarkDown3 IGNORE NULLS) OVER p, first_value(MarkDown3 IGNORE NULLS) OVER f) AS MarkDown3
FROM merged
WINDOW p AS (PARTITION BY Store ORDER BY Dept, Date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
       f AS (PARTITION BY Store ORDER BY Dept, Date ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)"""))
def ffill_bfill_merged(spark, sf_dir):
    """The fill in fact order (department, then date) of a whole store, cut into chunks."""
    right = tables.staged_covariates(spark, sf_dir).select("Store", "Date", "CPI", "MarkDown3")
    merged = _fact(spark, sf_dir).join(right, ["Store", "Date"], "left").select(
        "unique_id", "Store", "Dept", "Date", "CPI", "MarkDown3")
    filled = clean.ffill_bfill(merged, ["CPI", "MarkDown3"], ["Store"], ["Dept", "Date"])
    return filled.select("unique_id", "Date", "CPI", "MarkDown3")


@query("tail_n_per_group", text(r.panel(), """
SELECT unique_id, Date, Weekly_Sales FROM (
  SELECT *, row_number() OVER (PARTITION BY unique_id ORDER BY Date DESC) AS rn FROM panel) WHERE rn <= 52"""))
def tail_n_per_group(spark, sf_dir):
    return panel.tail_n(_fact(spark, sf_dir).select("unique_id", "Date", "Weekly_Sales"), 52, ["unique_id"])


@query("interpolate_linear", text(r.panel(), r.SPINE.format(source="panel"), r.KNOWN, "SELECT unique_id, Date AS ds, y FROM filled"))
def interpolate_linear(spark, sf_dir):
    return panel.interpolate_linear(panel.weekly_spine(panel.to_long(_fact(spark, sf_dir))))


@query("lag_with_cutoff", text(r.panel(), r.CUT, f"""
SELECT unique_id, Date, lag(CASE WHEN Date < cutoff THEN Weekly_Sales END, 26) OVER ({SERIES}) AS lag_26
FROM panel CROSS JOIN cut"""))
def lag_with_cutoff(spark, sf_dir):
    fact = _fact(spark, sf_dir)
    out = lags.lag_with_cutoff(fact, 26, split.cutoff_value(fact, tables.HORIZON))
    return out.select("unique_id", "Date", "lag_26")


@query("last_date_per_series", text(r.panel(), "SELECT unique_id, MAX(Date) AS last_ds FROM panel GROUP BY unique_id"))
def last_date_per_series(spark, sf_dir):
    return panel.last_date(_fact(spark, sf_dir), date="Date")
