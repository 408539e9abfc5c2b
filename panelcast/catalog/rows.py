"""Projections, filters, predicates and scalar functions."""

from pyspark.sql import functions as F

from ..functions import calendar as cal
from ..functions import ids, scalars
from ..operators import aggregates, clean, lags, metrics, panel, rows, split
from ..operators.joins import with_fallbacks
from ..operators.quantiles import exact_median
from ..sources import tables
from . import registry as r
from .registry import query, text


def _fact(spark, sf_dir, grain="ragged"):
    return tables.staged_fact(spark, sf_dir, grain)


def _covariates(spark, sf_dir, grain="ragged"):
    return tables.staged_covariates(spark, sf_dir, grain)


@query("select_columns", text(r.panel(), "SELECT unique_id, Date, IsHoliday FROM panel"))
def select_columns(spark, sf_dir):
    return rows.select_columns(_fact(spark, sf_dir), ["unique_id", "Date"], ["CPI", "IsHoliday"])


@query("require_columns", text(r.covariates(), "SELECT Store, Date, CPI FROM covariates"))
def require_columns(spark, sf_dir):
    return rows.require_columns(_covariates(spark, sf_dir), ["Store", "Date", "CPI"]).select("Store", "Date", "CPI")


@query("rename_drop", text(r.panel(), "SELECT unique_id, Dept, Date AS ds, Weekly_Sales AS y, IsHoliday FROM panel"))
def rename_drop(spark, sf_dir):
    return _fact(spark, sf_dir).withColumnsRenamed({"Date": "ds", "Weekly_Sales": "y"}).drop("Store")


@query("cast_types", text(r.panel(), """
SELECT unique_id, Date, CAST(Store AS DOUBLE) AS Store, CAST(Dept AS DOUBLE) AS Dept, CAST(IsHoliday AS INTEGER) AS IsHoliday FROM panel"""))
def cast_types(spark, sf_dir):
    flags = rows.booleans_to_int(_fact(spark, sf_dir).drop("Weekly_Sales"))
    return rows.to_double(flags, ["Store", "Dept"])


@query("dropna_any", text(r.covariates(), """
SELECT Store, Date, CPI, Unemployment, MarkDown1, Temperature FROM covariates
WHERE CPI IS NOT NULL AND Unemployment IS NOT NULL AND MarkDown1 IS NOT NULL AND Temperature IS NOT NULL"""))
def dropna_any(spark, sf_dir):
    kept = rows.dropna_any(_covariates(spark, sf_dir), ["CPI", "Unemployment", "MarkDown1", "absent"], "Temperature")
    return kept.select("Store", "Date", "CPI", "Unemployment", "MarkDown1", "Temperature")


@query("date_filter", text(r.panel(), """
SELECT unique_id, Date, Weekly_Sales FROM panel WHERE Date >= DATE '1997-03-07' AND Date < DATE '1999-03-05'"""))
def date_filter(spark, sf_dir):
    df = _fact(spark, sf_dir).select("unique_id", "Date", "Weekly_Sales")
    return df.filter((F.col("Date") >= F.lit("1997-03-07").cast("date")) & (F.col("Date") < F.lit("1999-03-05").cast("date")))


@query("fill_constant", text(r.covariates(), """
SELECT Store, Date, coalesce(MarkDown1, 0) AS MarkDown1, coalesce(MarkDown2, 0) AS MarkDown2, coalesce(MarkDown3, 0) AS MarkDown3,
       coalesce(MarkDown4, 0) AS MarkDown4, coalesce(MarkDown5, 0) AS MarkDown5 FROM covariates"""))
def fill_constant(spark, sf_dir):
    cols = [f"MarkDown{i}" for i in range(1, 6)]
    return rows.fill_zero(_covariates(spark, sf_dir), cols).select("Store", "Date", *cols)


DATED = [r.panel(), r.HOLIDAYS, r.CALENDAR.format(source="panel")]


def _dated(spark, sf_dir):
    return clean.add_calendar(_fact(spark, sf_dir), tables.EVENTS)


@query("replace_infinite", text(*DATED, """
SELECT unique_id, p.Date, NULLIF(DaysSinceLastHoliday, 'inf'::DOUBLE) AS DaysSinceLastHoliday,
       NULLIF(DaysToNextHoliday, 'inf'::DOUBLE) AS DaysToNextHoliday FROM panel p JOIN calendar USING (Date)"""))
def replace_infinite(spark, sf_dir):
    cols = ["DaysSinceLastHoliday", "DaysToNextHoliday"]
    return rows.replace_infinities(_dated(spark, sf_dir), cols).select("unique_id", "Date", *cols)


@query("tag_origin", text(r.panel(), r.CUT, "SELECT unique_id, Date, TRUE AS _is_test FROM valid"))
def tag_origin(spark, sf_dir):
    train, valid = split.time_split(_fact(spark, sf_dir).select("unique_id", "Date"), tables.HORIZON)
    both = rows.tag_origin(train, "_is_test", False).unionByName(rows.tag_origin(valid, "_is_test", True))
    return both.filter("_is_test")


GRID = """last AS (SELECT unique_id, MAX(Date) AS last_ds FROM train GROUP BY unique_id),
grid AS (SELECT unique_id, CAST(unnest(generate_series(last_ds + 7, last_ds + 273, INTERVAL 7 DAY)) AS DATE) AS ds FROM last)"""


@query("missing_covariate_gate", text(r.panel(), r.covariates(), r.CUT, GRID, """
SELECT unique_id, COUNT(*) AS n_missing FROM grid LEFT JOIN covariates c
  ON c.Store = CAST(split_part(unique_id, '_', 1) AS INTEGER) AND c.Date = ds
WHERE Temperature IS NULL OR CPI IS NULL GROUP BY unique_id"""))
def missing_covariate_gate(spark, sf_dir):
    train, _ = split.time_split(_fact(spark, sf_dir), tables.HORIZON)
    grid = panel.future_grid(panel.to_long(train), tables.HORIZON)
    ready = panel.future_covariates(grid, _covariates(spark, sf_dir))
    return rows.missing_coverage(ready, ["Temperature", "CPI"])


# scalar functions

@query("series_id", text(r.panel(), "SELECT unique_id, COUNT(*) AS n FROM panel GROUP BY unique_id"))
def series_id(spark, sf_dir):
    df = _fact(spark, sf_dir).select("Store", "Dept")
    return df.groupBy(ids.series_id().alias("unique_id")).agg(F.count("*").alias("n"))


@query("submission_id", text(r.panel(), "SELECT unique_id || '_' || strftime(Date, '%Y-%m-%d') AS Id, Weekly_Sales FROM panel"))
def submission_id(spark, sf_dir):
    return _fact(spark, sf_dir).select(ids.submission_id().alias("Id"), "Weekly_Sales")


@query("split_series_id", text(r.panel(), """
SELECT unique_id, CAST(split_part(unique_id, '_', 1) AS INTEGER) AS Store, CAST(split_part(unique_id, '_', 2) AS INTEGER) AS Dept,
       COUNT(*) AS n FROM panel GROUP BY unique_id"""))
def split_series_id(spark, sf_dir):
    store, dept = ids.split_series_id()
    counted = _fact(spark, sf_dir).groupBy("unique_id").agg(F.count("*").alias("n"))
    return counted.select("unique_id", store.alias("Store"), dept.alias("Dept"), "n")


@query("calendar_parts", text(r.panel(), """
SELECT unique_id, Date, CAST(year(Date) AS INTEGER) AS Year, CAST(month(Date) AS INTEGER) AS Month,
       CAST(weekofyear(Date) AS INTEGER) AS WeekOfYear FROM panel"""))
def calendar_parts(spark, sf_dir):
    return _fact(spark, sf_dir).select("unique_id", "Date").withColumns(cal.calendar_parts())


@query("one_hot_type", text(r.stores(), """
SELECT Store, Size, CAST(Type = 'A' AS INTEGER) AS Type_A, CAST(Type = 'B' AS INTEGER) AS Type_B,
       CAST(Type = 'C' AS INTEGER) AS Type_C FROM stores"""))
def one_hot_type(spark, sf_dir):
    return clean.one_hot_type(tables.staged_stores(spark, sf_dir))


@query("encode_holiday", text(r.panel(), "SELECT unique_id, Date, CAST(IsHoliday AS INTEGER) AS IsHoliday FROM panel"))
def encode_holiday(spark, sf_dir):
    return _fact(spark, sf_dir).select("unique_id", "Date", scalars.encode_holiday().alias("IsHoliday"))


@query("holiday_weight", text(r.panel(), r.covariates(), """
SELECT unique_id, p.Date, CASE WHEN c.IsHoliday THEN 5.0::DOUBLE ELSE 1.0::DOUBLE END AS weight
FROM panel p LEFT JOIN covariates c ON c.Store = p.Store AND c.Date = p.Date"""))
def holiday_weight(spark, sf_dir):
    flags = _covariates(spark, sf_dir).select("Store", "Date", "IsHoliday")
    joined = _fact(spark, sf_dir).drop("IsHoliday").join(flags, ["Store", "Date"], "left")
    return joined.select("unique_id", "Date", scalars.holiday_weight().alias("weight"))


@query("abs_error", text(r.panel(), r.CUT, r.FALLBACKS, """
SELECT v.unique_id, v.Date, abs(Weekly_Sales - last_y) AS error FROM valid v LEFT JOIN by_id b ON b.unique_id = v.unique_id"""))
def abs_error(spark, sf_dir):
    train, valid = split.time_split(_fact(spark, sf_dir), tables.HORIZON)
    last = aggregates.last_value_by_series(train, date="Date", target="Weekly_Sales")
    return valid.join(last, "unique_id", "left").select(
        "unique_id", "Date", scalars.abs_error("Weekly_Sales", "last_y").alias("error"))


@query("cap_infinite", text(*DATED, """
SELECT unique_id, p.Date,
  CASE WHEN isinf(DaysSinceLastHoliday) THEN (SELECT MAX(DaysSinceLastHoliday) FROM calendar WHERE NOT isinf(DaysSinceLastHoliday))
       ELSE DaysSinceLastHoliday END AS DaysSinceLastHoliday,
  CASE WHEN isinf(DaysToNextHoliday) THEN (SELECT MAX(DaysToNextHoliday) FROM calendar WHERE NOT isinf(DaysToNextHoliday))
       ELSE DaysToNextHoliday END AS DaysToNextHoliday
FROM panel p JOIN calendar USING (Date)"""))
def cap_infinite(spark, sf_dir):
    cols = ["DaysSinceLastHoliday", "DaysToNextHoliday"]
    return rows.cap_infinities(_dated(spark, sf_dir).select("unique_id", "Date", *cols), cols)


DRIFT = """models AS (
  SELECT unique_id, arg_min(Weekly_Sales, Date) AS y0, arg_max(Weekly_Sales, Date) AS y1, COUNT(*) AS n,
         n >= 200 AS ok, (y1 - y0) / NULLIF(n - 1, 0) AS step FROM train GROUP BY unique_id)"""


@query("clip_nonnegative", text(r.panel(), r.CUT, DRIFT, """
SELECT unique_id, greatest(y1 + 39 * step, 0.0) AS forecast, y1 + 39 * step < 0 AS was_negative FROM models"""))
def clip_nonnegative(spark, sf_dir):
    train, _ = split.time_split(_fact(spark, sf_dir), tables.HORIZON)
    ends = train.groupBy("unique_id").agg(
        F.min_by("Weekly_Sales", "Date").alias("y0"), F.max_by("Weekly_Sales", "Date").alias("y1"), F.count("*").alias("n"))
    line = F.col("y1") + 39 * ((F.col("y1") - F.col("y0")) / F.nullif(F.col("n") - 1, F.lit(0)))
    return ends.select("unique_id", scalars.clip_nonnegative(line).alias("forecast"), (line < 0).alias("was_negative"))


# Series with fewer than 150 training weeks have no last value and fall through to the median.
@query("fallback_chain", text(r.panel(), r.CUT, r.FALLBACKS, """
SELECT v.unique_id, v.Date, coalesce(t.Weekly_Sales, b.last_y, median_y) AS prediction
FROM valid v CROSS JOIN overall LEFT JOIN train t ON t.unique_id = v.unique_id AND t.Date = v.Date - 364
     LEFT JOIN (SELECT by_id.* FROM by_id SEMI JOIN (SELECT unique_id FROM train GROUP BY unique_id HAVING COUNT(*) >= 150) l
                ON l.unique_id = by_id.unique_id) b ON b.unique_id = v.unique_id"""))
def fallback_chain(spark, sf_dir):
    train, valid = split.time_split(_fact(spark, sf_dir), tables.HORIZON)
    lagged = lags.calendar_lags(train, valid.drop("Weekly_Sales")).withColumnRenamed("lag_52", "prediction")
    table = train.groupBy("unique_id").agg(F.max_by("Weekly_Sales", "Date").alias("last_y"), F.count("*").alias("n"))
    filled = with_fallbacks(lagged, table.filter("n >= 150"), exact_median(train, "Weekly_Sales", "median_y"))
    return filled.select("unique_id", "Date", "prediction")


# Per series: mean sales before and after the cutoff as a stand-in for two error figures.
GAPS = """gaps AS (
  SELECT unique_id, AVG(CASE WHEN Date < cutoff THEN Weekly_Sales END) AS train_wmae,
         AVG(CASE WHEN Date >= cutoff THEN Weekly_Sales END) AS val_wmae FROM panel CROSS JOIN cut GROUP BY unique_id)"""
GAP = "(val_wmae - train_wmae) / NULLIF(train_wmae, 0) * 100"


def _gaps(spark, sf_dir):
    fact = _fact(spark, sf_dir)
    past = F.col("Date") < split.cutoff_value(fact, tables.HORIZON)
    return fact.groupBy("unique_id").agg(
        F.avg(F.when(past, F.col("Weekly_Sales"))).alias("train_wmae"),
        F.avg(F.when(~past, F.col("Weekly_Sales"))).alias("val_wmae"))


@query("gap_pct", text(r.panel(), r.CUT, GAPS, f"SELECT unique_id, {GAP} AS gap_pct FROM gaps"))
def gap_pct(spark, sf_dir):
    return _gaps(spark, sf_dir).select("unique_id", scalars.gap_pct("train_wmae", "val_wmae").alias("gap_pct"))


@query("fit_status", text(r.panel(), r.CUT, GAPS, f"""
SELECT unique_id, CASE WHEN {GAP} IS NULL THEN 'unknown' WHEN {GAP} > 25 THEN 'overfit' WHEN {GAP} < -10 THEN 'underfit'
  ELSE 'good' END AS status FROM gaps"""))
def fit_status(spark, sf_dir):
    return metrics.fit_report(_gaps(spark, sf_dir)).select("unique_id", "status")


SCALE = "scale AS (SELECT unique_id, MAX(abs(Weekly_Sales)) AS scale FROM train GROUP BY unique_id)"


@query("plausible_forecast", text(r.panel(), r.CUT, DRIFT, SCALE, """
SELECT m.unique_id, y1 * pow(1.12, 39) <= greatest(50 * scale, 1.0) AS plausible FROM models m JOIN scale USING (unique_id)"""))
def plausible_forecast(spark, sf_dir):
    train, _ = split.time_split(_fact(spark, sf_dir), tables.HORIZON)
    long = panel.to_long(train)
    last = aggregates.last_value_by_series(long)
    steps = last.withColumn("step", F.explode(F.sequence(F.lit(1), F.lit(tables.HORIZON))))
    growth = steps.withColumn("prediction", F.col("last_y") * F.pow(F.lit(1.12), F.col("step")))
    return metrics.plausible(growth, long)


@query("week_shift", text(r.panel(), """
SELECT unique_id, Date, Date - 364 AS year_before, Date + 273 AS horizon_end FROM panel"""))
def week_shift(spark, sf_dir):
    return _fact(spark, sf_dir).select(
        "unique_id", "Date", cal.week_shift("Date", -52).alias("year_before"), cal.week_shift("Date", 39).alias("horizon_end"))


@query("parse_param_list", text(r.panel(), """
SELECT Store, CAST(len(list(DISTINCT Dept)) AS INTEGER) AS n_items, CAST(MAX(Dept) AS INTEGER) AS largest,
       CAST(SUM(DISTINCT Dept) AS INTEGER) AS total FROM panel GROUP BY Store"""))
def parse_param_list(spark, sf_dir):
    spelled = _fact(spark, sf_dir).groupBy("Store").agg(F.collect_set("Dept").alias("d")).select(
        "Store", F.concat(F.lit("["), F.array_join("d", ", "), F.lit("]")).alias("param"))
    values = spelled.select("Store", scalars.parse_int_list("param").alias("v"))
    return values.select("Store", F.size("v").alias("n_items"), F.array_max("v").alias("largest"),
                         F.aggregate("v", F.lit(0), lambda a, b: a + b).alias("total"))
