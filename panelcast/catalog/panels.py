"""Panel and time-series operators."""

from pyspark.sql import functions as F

from .. import schemas
from ..models import grouped
from ..operators import clean, joins, lags, panel, split
from ..sources import tables
from . import registry as r
from .registry import query, text
from .scans import SEASONAL, seasonal_submission


def _fact(spark, sf_dir, grain="ragged"):
    return tables.staged_fact(spark, sf_dir, grain)


def merged(spark, sf_dir, grain="ragged"):
    """Fact with covariates (three keys) and stores."""
    out = joins.join_covariates_3key(_fact(spark, sf_dir, grain), tables.staged_covariates(spark, sf_dir, grain))
    return joins.join_stores(out, tables.staged_stores(spark, sf_dir, grain))


MARKS = ", ".join(f"coalesce(MarkDown{i}, 0) AS MarkDown{i}" for i in range(1, 6))
SHARED = f"""merged AS (
  SELECT p.*, Temperature, Fuel_Price, MarkDown1, MarkDown2, MarkDown3, MarkDown4, MarkDown5, CPI, Unemployment, Type, Size
  FROM panel p LEFT JOIN covariates c ON c.Store = p.Store AND c.Date = p.Date AND c.IsHoliday = p.IsHoliday
       LEFT JOIN stores s ON s.Store = p.Store),
shared AS (
  SELECT unique_id, Store, Dept, m.Date, Weekly_Sales, CAST(IsHoliday AS INTEGER) AS IsHoliday, Temperature, Fuel_Price, {MARKS},
    coalesce(last_value(CPI IGNORE NULLS) OVER p, first_value(CPI IGNORE NULLS) OVER f) AS CPI,
    coalesce(last_value(Unemployment IGNORE NULLS) OVER p, first_value(Unemployment IGNORE NULLS) OVER f) AS Unemployment,
    Size, CAST(Type = 'A' AS INTEGER) AS Type_A, CAST(Type = 'B' AS INTEGER) AS Type_B, CAST(Type = 'C' AS INTEGER) AS Type_C,
    Year, Month, WeekOfYear, DaysSinceLastHoliday, DaysToNextHoliday
  FROM merged m JOIN calendar USING (Date)
  WINDOW p AS (PARTITION BY Store ORDER BY Dept, m.Date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW),
         f AS (PARTITION BY Store ORDER BY Dept, m.Date ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))"""


def feature_ctes(grain="ragged"):
    return [r.panel(grain), r.covariates(grain), r.stores(grain), r.HOLIDAYS, r.CALENDAR.format(source="panel"), SHARED]


@query("to_long", text(r.panel(), "SELECT unique_id, Date AS ds, Weekly_Sales AS y, CAST(IsHoliday AS INTEGER) AS IsHoliday FROM panel"))
def to_long(spark, sf_dir):
    return panel.to_long(_fact(spark, sf_dir), covariates=["IsHoliday", "CPI"], strict=False)


@query("weekly_spine", text(r.panel(), r.SPINE.format(source="panel"), "SELECT unique_id, Date AS ds, y FROM spine"))
def weekly_spine(spark, sf_dir):
    return panel.weekly_spine(panel.to_long(_fact(spark, sf_dir)))


@query("to_static", text(r.panel(), r.stores(), """
SELECT DISTINCT unique_id, p.Store, Dept, Size, CAST(Type = 'A' AS INTEGER) AS Type_A, CAST(Type = 'B' AS INTEGER) AS Type_B,
       CAST(Type = 'C' AS INTEGER) AS Type_C FROM panel p LEFT JOIN stores s ON s.Store = p.Store"""))
def to_static(spark, sf_dir):
    return panel.to_static(joins.join_store_onehot(_fact(spark, sf_dir), tables.staged_stores(spark, sf_dir)), schemas.STATIC_COLUMNS)


# Every store-week twice, so the deduplication has work to do.
@query("store_date_features", text(r.covariates(), r.CLEAN, r.HOLIDAYS, r.CALENDAR.format(source="covariates"), """
SELECT Store, Date, CAST(IsHoliday AS INTEGER) AS IsHoliday, Temperature, Fuel_Price, MarkDown1, MarkDown2, MarkDown3, MarkDown4,
       MarkDown5, CPI, Unemployment, Year, Month, WeekOfYear, DaysSinceLastHoliday, DaysToNextHoliday
FROM clean JOIN calendar USING (Date)"""))
def store_date_features(spark, sf_dir):
    covariates = tables.staged_covariates(spark, sf_dir)
    return clean.store_date_features(covariates.unionAll(covariates), tables.EVENTS)


@query("future_grid", text(r.panel(), """
SELECT unique_id, CAST(unnest(generate_series(MAX(Date) + 7, MAX(Date) + 273, INTERVAL 7 DAY)) AS DATE) AS ds FROM panel GROUP BY unique_id"""))
def future_grid(spark, sf_dir):
    return panel.future_grid(panel.to_long(_fact(spark, sf_dir)), tables.HORIZON)


CONTEXT = """context AS (SELECT *, row_number() OVER (PARTITION BY unique_id ORDER BY Date DESC) AS back,
  MAX(Date) OVER (PARTITION BY unique_id) AS last_ds FROM panel QUALIFY back <= 104)"""


@query("series_context", text(r.panel(), CONTEXT, """
SELECT unique_id, CAST(row_number() OVER (PARTITION BY unique_id ORDER BY Date) - 1 AS INTEGER) AS pos,
       CAST(CAST(Weekly_Sales AS FLOAT) AS DOUBLE) AS y, CAST(IsHoliday AS INTEGER) AS holiday, last_ds FROM context"""))
def series_context(spark, sf_dir):
    long = panel.to_long(_fact(spark, sf_dir), covariates=["IsHoliday"])
    packed = panel.series_context(long, 104, ["IsHoliday"])
    flat = packed.select("unique_id", "last_ds", "hist_IsHoliday", F.posexplode("context").alias("pos", "y"))
    return flat.select("unique_id", "pos", F.col("y").cast("double").alias("y"),
                       F.get("hist_IsHoliday", "pos").cast("int").alias("holiday"), "last_ds")


@query("covariate_sequence", text(r.panel(), r.CUT, """
past AS (SELECT *, row_number() OVER (PARTITION BY unique_id ORDER BY Date DESC) AS back FROM train QUALIFY back <= 52),
both_parts AS (SELECT unique_id, Date, IsHoliday FROM past
               UNION ALL SELECT unique_id, Date, IsHoliday FROM valid WHERE unique_id IN (SELECT unique_id FROM train))""", """
SELECT unique_id, CAST(row_number() OVER (PARTITION BY unique_id ORDER BY Date) - 1 AS INTEGER) AS pos,
       CAST(IsHoliday AS INTEGER) AS holiday FROM both_parts"""))
def covariate_sequence(spark, sf_dir):
    train, valid = split.time_split(_fact(spark, sf_dir), tables.HORIZON)
    context = panel.series_context(panel.to_long(train, covariates=["IsHoliday"]), 52, ["IsHoliday"])
    ahead = panel.to_long(valid, target=False, covariates=["IsHoliday"])
    packed = panel.covariate_sequence(context, ahead, ["IsHoliday"])
    return packed.select("unique_id", F.posexplode("IsHoliday").alias("pos", "h")).select(
        "unique_id", "pos", F.col("h").cast("int").alias("holiday"))


@query("shared_features", text(*feature_ctes(), "SELECT * FROM shared"))
def shared_features(spark, sf_dir):
    return clean.shared_features(merged(spark, sf_dir), tables.EVENTS, ("Dept", "Date"))


LAGS = """round(s.roll_std_26, 2) AS roll_std_26_lag52, s.y AS lag_52, s.roll_mean_26 AS roll_mean_26_lag52"""


@query("lag_feature_matrix_tree", text(*feature_ctes(), r.SPINE.format(source="panel"), f"""
SELECT f.* EXCLUDE (Weekly_Sales) REPLACE (NULLIF(DaysSinceLastHoliday, 'inf'::DOUBLE) AS DaysSinceLastHoliday,
  NULLIF(DaysToNextHoliday, 'inf'::DOUBLE) AS DaysToNextHoliday), {LAGS}
FROM shared f LEFT JOIN spine s ON s.unique_id = f.unique_id AND s.Date = f.Date - 364"""))
def lag_feature_matrix_tree(spark, sf_dir):
    frame = lags.calendar_feature_frame(merged(spark, sf_dir), tables.EVENTS, keep=["unique_id", "Date"])
    return frame.withColumn("roll_std_26_lag52", F.round("roll_std_26_lag52", 2))


def _roll(w, partition="PARTITION BY unique_id ORDER BY Date"):
    frame = f"({partition} ROWS BETWEEN {26 + w - 1} PRECEDING AND 26 PRECEDING)"
    return (f"AVG(Weekly_Sales) OVER {frame} AS rolling_mean_{w}, "
            f"round(coalesce(stddev_samp(Weekly_Sales) OVER {frame}, 0), 2) AS rolling_std_{w}")


POSITIONAL = f"""lagged AS (
  SELECT *, lag(Weekly_Sales, 26) OVER w AS lag_26, lag(Weekly_Sales, 52) OVER w AS lag_52, {_roll(4)}, {_roll(13)}, {_roll(26)}
  FROM shared WINDOW w AS (PARTITION BY unique_id ORDER BY Date))"""


@query("lag_feature_matrix_boost", text(*feature_ctes(), POSITIONAL, """
SELECT Date, Weekly_Sales, CASE WHEN IsHoliday = 1 THEN 5.0::DOUBLE ELSE 1.0::DOUBLE END AS weight, """ + ", ".join(
    f"CAST({c} AS DOUBLE) AS {c}" for c in schemas.POSITIONAL_FEATURES) + " FROM lagged WHERE " + " AND ".join(
    f"{c} IS NOT NULL" for c in schemas.POSITIONAL_FEATURES)))
def lag_feature_matrix_boost(spark, sf_dir):
    frame = lags.positional_feature_frame(merged(spark, sf_dir), tables.EVENTS)
    return frame.withColumns({f"rolling_std_{w}": F.round(f"rolling_std_{w}", 2) for w in (4, 13, 26)})


@query("serve_lag_features", text(r.panel(), r.CUT, f"""
tail AS (SELECT *, row_number() OVER (PARTITION BY unique_id ORDER BY Date DESC) AS rn FROM train QUALIFY rn <= 52),
rows AS (SELECT unique_id, Date, Weekly_Sales, FALSE AS is_test FROM tail UNION ALL SELECT unique_id, Date, NULL, TRUE FROM valid),
lagged AS (SELECT *, lag(Weekly_Sales, 26) OVER w AS lag_26, lag(Weekly_Sales, 52) OVER w AS lag_52, {_roll(4)}, {_roll(13)}, {_roll(26)}
           FROM rows WINDOW w AS (PARTITION BY unique_id ORDER BY Date))""", """
SELECT unique_id, Date, """ + ", ".join(f"coalesce({c}, 0) AS {c}" for c in schemas.POSITIONAL_LAG_COLUMNS) + """
FROM lagged WHERE is_test"""))
def serve_lag_features(spark, sf_dir):
    train, valid = split.time_split(_fact(spark, sf_dir), tables.HORIZON)
    out = lags.serve_positional_features(panel.tail_n(train, 52), valid.drop("Weekly_Sales"))
    out = out.select("unique_id", "Date", *schemas.POSITIONAL_LAG_COLUMNS)
    return out.withColumns({f"rolling_std_{w}": F.round(f"rolling_std_{w}", 2) for w in (4, 13, 26)})


@query("time_split", text(r.panel(), r.CUT, """
SELECT 'train' AS part, unique_id, Date, Weekly_Sales FROM train UNION ALL SELECT 'valid', unique_id, Date, Weekly_Sales FROM valid"""))
def time_split(spark, sf_dir):
    train, valid = split.time_split(_fact(spark, sf_dir).select("unique_id", "Date", "Weekly_Sales"), tables.HORIZON)
    return train.withColumn("part", F.lit("train")).unionByName(valid.withColumn("part", F.lit("valid")))


COMPLETE = """sizes AS (SELECT unique_id, COUNT(*) AS n, COUNT(*) FILTER (Date < cutoff) AS n_train,
  COUNT(*) FILTER (Date >= cutoff) AS n_valid FROM panel CROSS JOIN cut GROUP BY unique_id),
complete AS (SELECT unique_id FROM sizes WHERE n = (SELECT MAX(n) FROM sizes) AND n_train >= 52 AND n_valid = 39)"""


def complete_ids(fact):
    return split.complete_series(panel.to_long(fact), split.cutoff_value(fact, tables.HORIZON), tables.HORIZON)


@query("complete_series_filter", text(r.panel("dense"), r.CUT, COMPLETE, "SELECT unique_id, Date, Weekly_Sales FROM panel SEMI JOIN complete USING (unique_id)"))
def complete_series_filter(spark, sf_dir):
    fact = _fact(spark, sf_dir, "dense")
    return joins.semi_join_ids(fact.select("unique_id", "Date", "Weekly_Sales"), complete_ids(fact))


@query("stratified_series_sample", text(r.panel(), r.CUT, """
means AS (SELECT unique_id, AVG(Weekly_Sales) AS mean_y FROM train GROUP BY unique_id),
banded AS (SELECT unique_id, CASE WHEN mean_y <= (SELECT quantile_cont(mean_y, 0.25) FROM means) THEN 0
  WHEN mean_y <= (SELECT quantile_cont(mean_y, 0.5) FROM means) THEN 1
  WHEN mean_y <= (SELECT quantile_cont(mean_y, 0.75) FROM means) THEN 2 ELSE 3 END AS quartile FROM means)""", """
SELECT unique_id, quartile FROM banded
QUALIFY row_number() OVER (PARTITION BY quartile ORDER BY md5(unique_id || '|42'), unique_id) <= 15"""))
def stratified_series_sample(spark, sf_dir):
    train, _ = split.time_split(_fact(spark, sf_dir), tables.HORIZON)
    return split.stratified_sample(panel.to_long(train), 62)


@query("backtest_window", text(r.panel("dense"), r.CUT, """
usable AS (SELECT unique_id FROM valid GROUP BY unique_id HAVING COUNT(*) = 39 INTERSECT SELECT unique_id FROM train),
context AS (SELECT unique_id, AVG(Weekly_Sales) AS prediction FROM (
  SELECT *, row_number() OVER (PARTITION BY unique_id ORDER BY Date DESC) AS back FROM train) WHERE back <= 104 GROUP BY unique_id)""", """
SELECT v.unique_id, v.Date AS ds, v.Weekly_Sales AS y, prediction
FROM valid v JOIN usable USING (unique_id) JOIN context USING (unique_id)"""))
def backtest_window(spark, sf_dir):
    fact = _fact(spark, sf_dir, "dense")
    history, actual = split.backtest_window(
        panel.to_long(fact), split.cutoff_value(fact, tables.HORIZON), tables.HORIZON, 104)
    forecast = history.groupBy("unique_id").agg(F.avg("y").alias("prediction"))
    return actual.join(forecast, "unique_id")


# A lag of 26 weeks reaches past the cutoff from the 27th week of a window on.
@query("insample_windows", text(r.panel(), """
first AS (SELECT unique_id, MIN(Date) AS d0 FROM panel GROUP BY unique_id),
cut_rows AS (SELECT p.unique_id, p.Date, Weekly_Sales, CAST(floor((p.Date - d0) / 7 / 39) AS INTEGER) AS w, d0 FROM panel p JOIN first USING (unique_id))""", """
SELECT p.unique_id, p.Date AS ds, w AS "window", p.Weekly_Sales AS y,
  CASE WHEN p.Date - 182 < d0 + w * 273 THEN q.Weekly_Sales END AS prediction
FROM cut_rows p LEFT JOIN panel q ON q.unique_id = p.unique_id AND q.Date = p.Date - 182"""))
def insample_windows(spark, sf_dir):
    lagged = lags.calendar_lags(_fact(spark, sf_dir), weeks=26)
    long = lagged.select("unique_id", F.col("Date").alias("ds"), F.col("Weekly_Sales").alias("y"), F.col("lag_26").alias("prediction"))
    out = split.insample_windows(long, tables.HORIZON)
    seen = F.date_sub("ds", 182) < F.col("cutoff")
    return out.select("unique_id", "ds", "window", "y", F.when(seen, F.col("prediction")).alias("prediction"))


@query("rolling_origin", text(r.panel(), """
first AS (SELECT unique_id, MIN(Date) AS d0, MAX(Date) AS d1 FROM panel GROUP BY unique_id),
given AS (SELECT unique_id, Date, Weekly_Sales AS y, (Date - d0) / 7 AS x, lag(Date) OVER w AS d, lag(Weekly_Sales) OVER w AS b
  FROM panel JOIN first USING (unique_id) WINDOW w AS (PARTITION BY unique_id ORDER BY Date)),
cuts AS (SELECT unique_id, d0, CAST(unnest(generate_series(d0 + 273, d1, INTERVAL 273 DAY)) AS DATE) AS cutoff FROM first),
sums AS (SELECT c.unique_id, cutoff, d0, COUNT(*) AS n, SUM(x) AS sx, SUM(y) AS sy, SUM(x * x) AS sxx, SUM(x * y) AS sxy,
  SUM(CASE WHEN Date - d = 7 THEN b * y END) / SUM(CASE WHEN Date - d = 7 THEN b * b END) AS phi, MAX(Date) AS last_d, arg_max(y, Date) AS last_y
  FROM cuts c JOIN given g ON g.unique_id = c.unique_id AND g.Date < cutoff GROUP BY c.unique_id, cutoff, d0 HAVING COUNT(*) >= 52),
lines AS (SELECT *, (n * sxy - sx * sy) / (n * sxx - sx * sx) AS slope FROM sums)""", """
SELECT label, l.unique_id, cutoff, g.Date AS ds, g.y,
  round(CASE label WHEN 'trend' THEN (sy - slope * sx) / n + slope * g.x ELSE last_y * pow(phi, (g.Date - last_d) / 7) END, 2) AS prediction
FROM lines l JOIN given g ON g.unique_id = l.unique_id AND g.Date >= cutoff AND g.Date < cutoff + 273 CROSS JOIN (VALUES ('trend'), ('ar1')) AS m(label)"""))
def rolling_origin(spark, sf_dir):
    """Every series forecast from cutoffs 39 weeks apart, each fit from what lies before its cutoff."""
    out = grouped.rolling_origin(panel.to_long(_fact(spark, sf_dir)), tables.HORIZON, tables.HORIZON)
    return out.withColumn("prediction", F.round("prediction", 2))


@query("predict_submission", text(r.panel(), r.CUT, r.FALLBACKS, SEASONAL))
def predict_submission(spark, sf_dir):
    return seasonal_submission(spark, sf_dir)


