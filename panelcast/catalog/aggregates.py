"""Aggregations and top-k."""

from pyspark.sql import functions as F

from ..models import baselines
from ..operators import aggregates, clean, lags, ledger, metrics, panel, split
from ..operators.quantiles import exact_median
from ..schemas import MARKDOWNS
from ..sources import tables
from . import registry as r
from .registry import query, text
from .scans import LEDGER, SHOWN, build_ledger, shown

MEASURES = ["Temperature", "Fuel_Price", "CPI", "Unemployment"] + MARKDOWNS


def _fact(spark, sf_dir, grain="ragged"):
    return tables.staged_fact(spark, sf_dir, grain)


def _part(fact):
    past = F.col("Date") < split.cutoff_value(fact, tables.HORIZON)
    return F.when(past, "train").otherwise("valid")


@query("null_share", text(r.covariates(), " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", CAST(SUM(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS DOUBLE) / COUNT(*) * 100 AS null_pct FROM covariates"
    for c in MEASURES)))
def null_share(spark, sf_dir):
    return aggregates.null_share(tables.staged_covariates(spark, sf_dir), MEASURES)


@query("series_length", text(r.panel(), "SELECT unique_id, COUNT(*) AS n FROM panel GROUP BY unique_id"))
def series_length(spark, sf_dir):
    return aggregates.series_length(_fact(spark, sf_dir))


LENGTHS = "lengths AS (SELECT unique_id, COUNT(*) AS n FROM panel GROUP BY unique_id)"


@query("series_length_summary", text(r.panel(), LENGTHS, """
SELECT COUNT(*) AS series, AVG(n) AS mean_len, round(stddev_samp(n), 6) AS std_len, MIN(n) AS min_len, quantile_cont(n, 0.25) AS q25,
       quantile_cont(n, 0.5) AS q50, quantile_cont(n, 0.75) AS q75, MAX(n) AS max_len FROM lengths"""))
def series_length_summary(spark, sf_dir):
    out = aggregates.series_length_summary(aggregates.series_length(_fact(spark, sf_dir)))
    return out.withColumn("std_len", F.round("std_len", 6))


@query("short_series_counts", text(r.panel(), LENGTHS, """
SELECT COUNT(*) AS series, COUNT(*) FILTER (n < 200) AS below_input, COUNT(*) FILTER (n < 239) AS below_input_horizon FROM lengths"""))
def short_series_counts(spark, sf_dir):
    return aggregates.short_series_counts(aggregates.series_length(_fact(spark, sf_dir)), 200, tables.HORIZON)


@query("distinct_count", text(r.panel(), r.CUT, """
SELECT COUNT(DISTINCT Date) AS "n_Date", COUNT(DISTINCT unique_id) AS n_unique_id FROM valid"""))
def distinct_count(spark, sf_dir):
    _, valid = split.time_split(_fact(spark, sf_dir), tables.HORIZON)
    return aggregates.distinct_count(valid, ["Date", "unique_id"])


PART = "(CASE WHEN Date < cutoff THEN 'train' ELSE 'valid' END)"


@query("date_bounds", text(r.panel(), r.CUT, f"""
SELECT {PART} AS part, MIN(Date) AS "first", MAX(Date) AS "last" FROM panel CROSS JOIN cut GROUP BY 1"""))
def date_bounds(spark, sf_dir):
    fact = _fact(spark, sf_dir)
    return aggregates.date_bounds(fact, _part(fact))


@query("last_value_fallback", text(r.panel(), r.CUT, r.FALLBACKS, "SELECT unique_id, last_y FROM by_id"))
def last_value_fallback(spark, sf_dir):
    train, _ = split.time_split(_fact(spark, sf_dir), tables.HORIZON)
    return aggregates.last_value_by_series(panel.to_long(train))


@query("global_median_fallback", text(r.panel(), r.CUT, r.FALLBACKS, "SELECT median_y FROM overall"))
def global_median_fallback(spark, sf_dir):
    train, _ = split.time_split(_fact(spark, sf_dir), tables.HORIZON)
    return exact_median(train, "Weekly_Sales", "median_y")


@query("mean_by_series", text(r.panel(), "SELECT unique_id, AVG(Weekly_Sales) AS mean_y FROM panel GROUP BY unique_id"))
def mean_by_series(spark, sf_dir):
    return aggregates.mean_by_series(panel.to_long(_fact(spark, sf_dir)))


# Seasonal naive without fallback, so some predictions are missing.
RAW = """raw AS (SELECT v.*, t.Weekly_Sales AS prediction FROM valid v
  LEFT JOIN train t ON t.unique_id = v.unique_id AND t.Date = v.Date - 364)"""
WMAE = """CAST(SUM((CASE WHEN IsHoliday THEN 5 ELSE 1 END) * abs(Weekly_Sales - prediction)) AS DOUBLE)
  / CAST(SUM(CASE WHEN IsHoliday THEN 5 ELSE 1 END) AS DOUBLE)"""


def raw_seasonal(spark, sf_dir, grain="ragged"):
    train, valid = split.time_split(_fact(spark, sf_dir, grain), tables.HORIZON)
    past = train.select("Store", "Dept", "Date", "Weekly_Sales")
    requests = valid.withColumnRenamed("Weekly_Sales", "y")
    return lags.calendar_lags(past, requests).withColumnRenamed("lag_52", "prediction").drop("Weekly_Sales")


@query("wmae", text(r.panel(), r.CUT, RAW, f"SELECT {WMAE} AS wmae FROM raw"))
def wmae(spark, sf_dir):
    return metrics.wmae(raw_seasonal(spark, sf_dir))


@query("mae_by_segment", text(r.panel(), r.CUT, RAW, """
SELECT Store, Dept, IsHoliday, AVG(abs(Weekly_Sales - prediction)) AS mae, COUNT(*) AS n FROM raw GROUP BY ALL"""))
def mae_by_segment(spark, sf_dir):
    return metrics.mae_by(raw_seasonal(spark, sf_dir), ["Store", "Dept", "IsHoliday"])


@query("distinct_holiday_lookup", text(r.panel(), "SELECT DISTINCT unique_id, Date AS ds, coalesce(IsHoliday, FALSE) AS IsHoliday FROM panel"))
def distinct_holiday_lookup(spark, sf_dir):
    from ..operators.joins import holiday_lookup
    return holiday_lookup(_fact(spark, sf_dir).withColumnRenamed("Date", "ds"))


# One row per store and week: the largest department comes first.
@query("dedupe_first", text(r.panel(), """
SELECT Store, Date, Dept, Weekly_Sales FROM (
  SELECT *, row_number() OVER (PARTITION BY Store, Date ORDER BY Weekly_Sales, Dept) AS rn FROM panel) WHERE rn = 1"""))
def dedupe_first(spark, sf_dir):
    slim = _fact(spark, sf_dir).select("Store", "Date", "Dept", "Weekly_Sales")
    return clean.dedupe_first(slim, ["Store", "Date"], ["Weekly_Sales", "Dept"])


@query("failure_counts", text(*LEDGER, """
SELECT label, COUNT(DISTINCT CASE WHEN raw IS NULL THEN unique_id END) AS fallback_series FROM scored WHERE NOT is_train GROUP BY label"""))
def failure_counts(spark, sf_dir):
    fact = _fact(spark, sf_dir, "dense")
    scored = baselines.baseline_predictions(fact, split.cutoff_value(fact, tables.HORIZON))
    return aggregates.failure_counts(scored.filter(~F.col("is_train")))


@query("regime_counts", text(*LEDGER, "SELECT regime, COUNT(*) AS n_configs FROM ledger GROUP BY regime"))
def regime_counts(spark, sf_dir):
    return aggregates.regime_counts(build_ledger(spark, sf_dir))


# Training-step log: one event per step, its value as the gradient norm.
STEPS = """steps AS (SELECT event_id AS step, round(value * 100) AS grad_total_norm, round(value * 100) * 2 AS grad_max_norm,
  CASE WHEN event_type = 'error' THEN 1 ELSE 0 END AS grad_nonfinite_count FROM events)"""


@query("step_metric_summary", text(STEPS, """
SELECT CAST(COUNT(*) AS DOUBLE) AS grad_records, AVG(grad_total_norm) AS grad_total_norm_mean, MAX(grad_total_norm) AS grad_total_norm_max,
       arg_max(grad_total_norm, step) AS grad_total_norm_last, MAX(grad_max_norm) AS grad_max_norm_max,
       CAST(SUM(grad_nonfinite_count) AS DOUBLE) AS grad_nonfinite_count_sum FROM steps"""))
def step_metric_summary(spark, sf_dir):
    events = tables.read(spark, sf_dir, "events")
    norm = F.round(F.col("value") * 100)
    steps = events.select(
        F.col("event_id").alias("step"), norm.alias("grad_total_norm"), (norm * 2).alias("grad_max_norm"),
        (F.col("event_type") == "error").cast("int").alias("grad_nonfinite_count"))
    return aggregates.step_metric_summary(steps)


@query("weight_counts", text(r.panel(), r.CUT, f"""
SELECT {PART} AS part, COUNT(*) AS n_rows, COUNT(*) FILTER (IsHoliday) AS n_holiday FROM panel CROSS JOIN cut GROUP BY 1"""))
def weight_counts(spark, sf_dir):
    fact = _fact(spark, sf_dir)
    return aggregates.holiday_rows(fact, _part(fact))


@query("null_lag_share", text(r.panel(), r.CUT, f"""
SELECT {PART} AS part, CAST(COUNT(*) FILTER (q.unique_id IS NULL) AS DOUBLE) / COUNT(*) AS null_share
FROM panel p CROSS JOIN cut LEFT JOIN (SELECT unique_id, Date AS d0 FROM panel) q ON q.unique_id = p.unique_id AND d0 = p.Date - 364
GROUP BY 1"""))
def null_lag_share(spark, sf_dir):
    fact = _fact(spark, sf_dir)
    lagged = lags.calendar_lags(fact)
    return aggregates.null_lag_share(lagged, _part(fact), "lag_52")


@query("infinite_counts", text(r.panel(), r.HOLIDAYS, r.CALENDAR.format(source="panel"), """
SELECT 'DaysSinceLastHoliday' AS "column", COUNT(*) FILTER (isinf(DaysSinceLastHoliday)) AS n_infinite FROM panel JOIN calendar USING (Date)
UNION ALL SELECT 'DaysToNextHoliday', COUNT(*) FILTER (isinf(DaysToNextHoliday)) FROM panel JOIN calendar USING (Date)"""))
def infinite_counts(spark, sf_dir):
    dated = clean.add_calendar(_fact(spark, sf_dir), tables.EVENTS)
    return aggregates.infinite_counts(dated, ["DaysSinceLastHoliday", "DaysToNextHoliday"])


# sorting and top-k

@query("sort_panel", text(r.panel(), "SELECT Store, Dept, Date, Weekly_Sales FROM panel ORDER BY Store, Dept, Date"))
def sort_panel(spark, sf_dir):
    return _fact(spark, sf_dir).select("Store", "Dept", "Date", "Weekly_Sales").orderBy("Store", "Dept", "Date")


@query("worst_series_topk", text(r.panel(), r.CUT, RAW, """
SELECT Store, Dept, AVG(abs(Weekly_Sales - prediction)) AS mae, COUNT(*) AS n FROM raw GROUP BY ALL
ORDER BY mae DESC NULLS LAST, Store, Dept LIMIT 15"""))
def worst_series_topk(spark, sf_dir):
    return metrics.worst_series(raw_seasonal(spark, sf_dir))


@query("rank_runs", text(*LEDGER, f"SELECT seq, {SHOWN}, status FROM ledger ORDER BY ledger.val_wmae, seq"))
def rank_runs(spark, sf_dir):
    return shown(ledger.rank_runs(build_ledger(spark, sf_dir)), "seq", "status")


@query("best_run", text(*LEDGER, f"SELECT {SHOWN}, regime FROM ledger ORDER BY ledger.val_wmae, seq LIMIT 1"))
def best_run(spark, sf_dir):
    return shown(ledger.best_run(build_ledger(spark, sf_dir)), "regime")


@query("head_n", text(r.panel(), """
SELECT unique_id, Date, Weekly_Sales FROM panel WHERE unique_id IN (SELECT DISTINCT unique_id FROM panel ORDER BY unique_id LIMIT 5)
ORDER BY unique_id, Date LIMIT 200"""))
def head_n(spark, sf_dir):
    fact = _fact(spark, sf_dir).select("unique_id", "Date", "Weekly_Sales")
    few = fact.select("unique_id").distinct().orderBy("unique_id").limit(5)
    return fact.join(few, "unique_id", "left_semi").orderBy("unique_id", "Date").limit(200)


