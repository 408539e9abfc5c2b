"""Joins and set operations."""

from pyspark.sql import functions as F

from ..functions import calendar as cal
from ..functions import ids
from ..models import baselines, grids
from ..operators import aggregates, clean, joins, lags, panel, split, submit
from ..sources import tables
from . import registry as r
from .registry import query, text
from .scans import SEASONAL, seasonal_submission


def _fact(spark, sf_dir, grain="ragged"):
    return tables.staged_fact(spark, sf_dir, grain)


def _covariates(spark, sf_dir):
    return tables.staged_covariates(spark, sf_dir)


# The covariates' calendar leaves Labor Day out, so the flags disagree in those weeks.
@query("join_covariates_3key", text(r.panel(), r.covariates(), """
SELECT unique_id, p.Date, p.IsHoliday, Temperature, CPI FROM panel p
LEFT JOIN (SELECT * REPLACE (IsHoliday AND month(Date) <> 9 AS IsHoliday) FROM covariates) c
  ON c.Store = p.Store AND c.Date = p.Date AND c.IsHoliday = p.IsHoliday"""))
def join_covariates_3key(spark, sf_dir):
    right = _covariates(spark, sf_dir).withColumn("IsHoliday", F.col("IsHoliday") & (F.month("Date") != 9))
    out = joins.join_covariates_3key(_fact(spark, sf_dir), right)
    return out.select("unique_id", "Date", "IsHoliday", "Temperature", "CPI")


@query("join_covariates_2key", text(r.panel(), r.covariates(), r.CLEAN, """
SELECT unique_id, p.Date, p.IsHoliday, Temperature, MarkDown1, CPI, Unemployment
FROM panel p LEFT JOIN clean c ON c.Store = p.Store AND c.Date = p.Date"""))
def join_covariates_2key(spark, sf_dir):
    out = joins.join_covariates_2key(_fact(spark, sf_dir), _covariates(spark, sf_dir))
    return out.select("unique_id", "Date", "IsHoliday", "Temperature", "MarkDown1", "CPI", "Unemployment")


@query("join_stores", text(r.panel(), r.stores(), """
SELECT unique_id, Date, Weekly_Sales, Type, Size FROM panel LEFT JOIN stores USING (Store)"""))
def join_stores(spark, sf_dir):
    out = joins.join_stores(_fact(spark, sf_dir), tables.staged_stores(spark, sf_dir))
    return out.select("unique_id", "Date", "Weekly_Sales", "Type", "Size")


ONEHOT = """CAST(Type = 'A' AS INTEGER) AS Type_A, CAST(Type = 'B' AS INTEGER) AS Type_B, CAST(Type = 'C' AS INTEGER) AS Type_C"""


@query("join_store_onehot", text(r.panel(), r.stores(), f"SELECT unique_id, Date, Size, {ONEHOT} FROM panel LEFT JOIN stores USING (Store)"))
def join_store_onehot(spark, sf_dir):
    out = joins.join_store_onehot(_fact(spark, sf_dir), tables.staged_stores(spark, sf_dir))
    return out.select("unique_id", "Date", "Size", "Type_A", "Type_B", "Type_C")


@query("join_store_salted", text(r.panel(), r.stores(), f"SELECT unique_id, Date, Size, {ONEHOT} FROM panel LEFT JOIN stores USING (Store)"))
def join_store_salted(spark, sf_dir):
    """The same lookup spread over salts, for a store that holds a large share of the rows."""
    dim = clean.one_hot_type(tables.staged_stores(spark, sf_dir))
    out = joins.salted_lookup(_fact(spark, sf_dir), dim, ["Store"], 8, ["Dept", "Date"])
    return out.select("unique_id", "Date", "Size", "Type_A", "Type_B", "Type_C")


@query("join_forecast_keys", text(r.panel(), r.CUT, """
SELECT v.unique_id, v.Date AS ds, v.unique_id || '_' || strftime(v.Date, '%Y-%m-%d') AS Id, t.Weekly_Sales AS prediction
FROM valid v LEFT JOIN train t ON t.unique_id = v.unique_id AND t.Date = v.Date - 364"""))
def join_forecast_keys(spark, sf_dir):
    train, valid = split.time_split(_fact(spark, sf_dir), tables.HORIZON)
    forecast = train.select("unique_id", cal.week_shift("Date", 52).alias("ds"), F.col("Weekly_Sales").alias("prediction"))
    return joins.join_forecast(submit.forecast_keys(valid), forecast)


# The lookup comes from the covariates; weeks without orders are absent from it and read False.
@query("join_holiday_lookup", text(r.panel(), r.covariates(), r.CUT, """
SELECT unique_id, v.Date AS ds, Weekly_Sales AS y, coalesce(c.IsHoliday, FALSE) AS IsHoliday
FROM valid v LEFT JOIN covariates c ON c.Store = v.Store AND c.Date = v.Date"""))
def join_holiday_lookup(spark, sf_dir):
    fact = _fact(spark, sf_dir)
    _, valid = split.time_split(fact, tables.HORIZON)
    flags = _covariates(spark, sf_dir).select("Store", "Date", "IsHoliday")
    known = fact.select("unique_id", "Store", "Date").join(flags, ["Store", "Date"])
    oof = valid.select("unique_id", F.col("Date").alias("ds"), F.col("Weekly_Sales").alias("y"))
    return joins.join_holidays(oof, joins.holiday_lookup(known.withColumnRenamed("Date", "ds")))


@query("join_calendar_lag", text(r.panel(), r.SPINE.format(source="panel"), """
SELECT p.unique_id, p.Date, s.y AS lag_52, s.roll_mean_26 AS roll_mean_26_lag52, round(s.roll_std_26, 2) AS roll_std_26_lag52
FROM panel p LEFT JOIN spine s ON s.unique_id = p.unique_id AND s.Date = p.Date - 364"""))
def join_calendar_lag(spark, sf_dir):
    fact = _fact(spark, sf_dir)
    long = fact.select("unique_id", "Date", F.col("Weekly_Sales").alias("y"))
    spine = lags.rolling_calendar(panel.weekly_spine(long, date="Date"))
    out = lags.calendar_lookup(fact.select("unique_id", "Date"), spine)
    return out.withColumn("roll_std_26_lag52", F.round("roll_std_26_lag52", 2))


@query("nearest_event_join", text(r.panel(), r.HOLIDAYS, r.CALENDAR.format(source="panel"), """
SELECT unique_id, p.Date, DaysSinceLastHoliday, DaysToNextHoliday FROM panel p JOIN calendar USING (Date)"""))
def nearest_event_join(spark, sf_dir):
    return _fact(spark, sf_dir).select("unique_id", "Date").withColumns(cal.event_distance("Date", tables.EVENTS))


def _gap(to, of, back):
    a, b = ("e.ts", "p.ts") if back else ("p.ts", "e.ts")
    return f"""SELECT e.event_id, epoch_us({a}) - epoch_us({b}) AS {to} FROM events e ASOF LEFT JOIN purchases p
  ON {of}e.ts {'>=' if back else '<='} p.ts"""


USER = "e.user_id = p.user_id AND "


# Events that no literal list holds: every event to the purchases before and after it, over all users and of its own.
@query("nearest_event_asof", text("purchases AS (SELECT ts, user_id FROM events WHERE event_type = 'purchase')",
    f"a AS ({_gap('since', '', True)})", f"b AS ({_gap('until', '', False)})",
    f"c AS ({_gap('own_since', USER, True)})", f"d AS ({_gap('own_until', USER, False)})", """
SELECT event_id, since, until, own_since, own_until FROM a JOIN b USING (event_id) JOIN c USING (event_id) JOIN d USING (event_id)"""))
def nearest_event_asof(spark, sf_dir):
    events = tables.read(spark, sf_dir, "events").select("event_id", "user_id", "event_type", F.unix_micros(F.col("ts").cast("timestamp")).alias("at"))
    purchases = events.where("event_type = 'purchase'")
    overall = joins.nearest_events(events, purchases, "at").withColumnsRenamed({"last_event": "last_any", "next_event": "next_any"})
    out = joins.nearest_events(overall, purchases, "at", ["user_id"])
    return out.select("event_id", (F.col("at") - F.col("last_any")).alias("since"), (F.col("next_any") - F.col("at")).alias("until"),
                      (F.col("at") - F.col("last_event")).alias("own_since"), (F.col("next_event") - F.col("at")).alias("own_until"))


GRID = """last AS (SELECT unique_id, MAX(Date) AS last_ds FROM train GROUP BY unique_id),
grid AS (SELECT unique_id, CAST(unnest(generate_series(last_ds + 7, last_ds + 273, INTERVAL 7 DAY)) AS DATE) AS ds FROM last)"""


@query("join_store_date_grid", text(r.panel(), r.covariates(), r.CLEAN, r.CUT, GRID, """
SELECT unique_id, ds, Temperature, MarkDown2, CPI FROM grid
LEFT JOIN clean c ON c.Store = CAST(split_part(unique_id, '_', 1) AS INTEGER) AND c.Date = ds"""))
def join_store_date_grid(spark, sf_dir):
    train, _ = split.time_split(_fact(spark, sf_dir), tables.HORIZON)
    store_dates = clean.store_date_features(_covariates(spark, sf_dir), tables.EVENTS, ["Temperature", "MarkDown2", "CPI"])
    return panel.future_covariates(panel.future_grid(panel.to_long(train), tables.HORIZON), store_dates)


@query("reindex_product", text(r.panel(), r.covariates(), r.CUT, """
SELECT s.Store, d.Date, Temperature, MarkDown1 FROM (SELECT DISTINCT Store FROM panel) s
CROSS JOIN (SELECT CAST(unnest(generate_series(cutoff, cutoff + 266, INTERVAL 7 DAY)) AS DATE) AS Date FROM cut) d
LEFT JOIN covariates c ON c.Store = s.Store AND c.Date = d.Date"""))
def reindex_product(spark, sf_dir):
    fact = _fact(spark, sf_dir)
    week = F.expr("interval 7 days")
    dates = split.cutoff_date(fact, tables.HORIZON).select(
        F.sequence("cutoff", F.date_add("cutoff", 7 * (tables.HORIZON - 1)), week).alias("dates"))
    right = _covariates(spark, sf_dir).select("Store", "Date", "Temperature", "MarkDown1")
    return joins.reindex_product(fact, "Store", dates, right)


@query("semi_join_ids", text(r.panel(), """
SELECT unique_id, Date, Weekly_Sales FROM panel WHERE unique_id IN
  (SELECT unique_id FROM panel GROUP BY unique_id HAVING COUNT(*) >= 200)"""))
def semi_join_ids(spark, sf_dir):
    fact = _fact(spark, sf_dir).select("unique_id", "Date", "Weekly_Sales")
    return joins.semi_join_ids(fact, aggregates.series_length(fact).filter("n >= 200"))


# Template: the held-out rows.  Predictions: last year's rows moved a year ahead, so some series
# are missing (no sales a year ago) and some are extra (no sales this year).
DIFF = [r.panel(), r.CUT, """template AS (SELECT unique_id || '_' || strftime(Date, '%Y-%m-%d') AS Id FROM valid),
predicted AS (SELECT unique_id || '_' || strftime(Date + 364, '%Y-%m-%d') AS Id FROM train, cut
              WHERE Date + 364 >= cutoff AND Date + 364 <= (SELECT MAX(Date) FROM panel))"""]


def template_and_predicted(spark, sf_dir):
    """(held-out rows, last year's rows moved into the same weeks)."""
    fact = _fact(spark, sf_dir)
    train, valid = split.time_split(fact, tables.HORIZON)
    last = fact.agg(F.max("Date")).scalar()
    moved = train.withColumn("Date", cal.week_shift("Date", 52))
    moved = moved.filter((F.col("Date") >= split.cutoff_value(fact, tables.HORIZON)) & (F.col("Date") <= last))
    return valid, moved


def _template_and_predictions(spark, sf_dir):
    return [df.select(ids.submission_id().alias("Id")) for df in template_and_predicted(spark, sf_dir)]


@query("anti_join_ids", text(*DIFF, """
SELECT Id, 'missing' AS side FROM template WHERE Id NOT IN (SELECT Id FROM predicted)
UNION ALL SELECT Id, 'extra' FROM predicted WHERE Id NOT IN (SELECT Id FROM template)"""))
def anti_join_ids(spark, sf_dir):
    return joins.id_differences(*_template_and_predictions(spark, sf_dir))


# Only series with at least 150 training weeks have an entry.
@query("map_lookup", text(r.panel(), r.CUT, """
long_ids AS (SELECT unique_id, arg_max(Weekly_Sales, Date) AS last_y FROM train GROUP BY unique_id HAVING COUNT(*) >= 150)""", """
SELECT v.unique_id, v.Date, b.last_y FROM valid v LEFT JOIN long_ids b ON b.unique_id = v.unique_id"""))
def map_lookup(spark, sf_dir):
    train, valid = split.time_split(_fact(spark, sf_dir), tables.HORIZON)
    table = train.groupBy("unique_id").agg(F.max_by("Weekly_Sales", "Date").alias("last_y"), F.count("*").alias("n"))
    return joins.map_lookup(valid.select("unique_id", "Date"), table.filter("n >= 150"), "unique_id", "last_y")


@query("cross_config_series", text(r.panel(), """
SELECT label, regime, unique_id, n FROM (SELECT unique_id, COUNT(*) AS n FROM panel GROUP BY unique_id)
CROSS JOIN (SELECT unnest(['underfit_1', 'underfit_2', 'underfit_3']) AS label, 'underfit' AS regime
            UNION ALL SELECT 'balanced_' || i, 'balanced' FROM range(1, 10) t(i)
            UNION ALL SELECT 'overfit_' || i, 'overfit' FROM range(1, 4) t(i))"""))
def cross_config_series(spark, sf_dir):
    configs = grids.config_table(spark, grids.additive()).select("label", "regime")
    return joins.cross_configs(aggregates.series_length(_fact(spark, sf_dir)), configs)


@query("restore_template_order", text(r.panel(), r.CUT, r.FALLBACKS, f"SELECT Id, md5(Id) AS pos, Weekly_Sales FROM ({SEASONAL}) ORDER BY pos"))
def restore_template_order(spark, sf_dir):
    _, valid = split.time_split(_fact(spark, sf_dir), tables.HORIZON)
    template = valid.select(ids.submission_id().alias("Id")).withColumn("pos", F.md5("Id"))
    return joins.restore_order(template, seasonal_submission(spark, sf_dir))


# set operations

@query("union_tail_test", text(r.panel(), r.CUT, """
tail AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY unique_id ORDER BY Date DESC) AS rn FROM train) WHERE rn <= 52)""", """
SELECT unique_id, Date, Weekly_Sales, FALSE AS _is_test FROM tail
UNION ALL SELECT unique_id, Date, NULL, TRUE FROM valid"""))
def union_tail_test(spark, sf_dir):
    train, valid = split.time_split(_fact(spark, sf_dir).select("unique_id", "Date", "Weekly_Sales"), tables.HORIZON)
    tail = panel.tail_n(train, 52, ["unique_id"]).withColumn("_is_test", F.lit(False))
    test = valid.drop("Weekly_Sales").withColumn("_is_test", F.lit(True))
    return tail.unionByName(test, allowMissingColumns=True)


@query("union_parts", text(r.panel(), r.CUT, r.FALLBACKS, """
SELECT 'last_value' AS label, v.unique_id, v.Date, last_y AS prediction FROM valid v LEFT JOIN by_id b ON b.unique_id = v.unique_id
UNION ALL SELECT 'overall_median', unique_id, Date, median_y FROM valid CROSS JOIN overall"""))
def union_parts(spark, sf_dir):
    fact = _fact(spark, sf_dir)
    train, valid = split.time_split(fact, tables.HORIZON)
    by_id, overall = baselines.fallbacks(panel.to_long(train))
    keys = valid.select("unique_id", "Date")
    parts = [
        keys.join(by_id, "unique_id", "left").select(F.lit("last_value").alias("label"), "unique_id", "Date", F.col("last_y").alias("prediction")),
        keys.crossJoin(F.broadcast(overall)).select(F.lit("overall_median").alias("label"), "unique_id", "Date", F.col("median_y").alias("prediction")),
    ]
    return parts[0].unionByName(parts[1])


@query("intersect_ids", text(r.panel(), r.CUT, """
SELECT unique_id FROM train GROUP BY unique_id HAVING COUNT(*) >= 150
INTERSECT SELECT unique_id FROM valid GROUP BY unique_id HAVING COUNT(*) >= 20"""))
def intersect_ids(spark, sf_dir):
    train, valid = split.time_split(_fact(spark, sf_dir), tables.HORIZON)
    long_enough = aggregates.series_length(train).filter("n >= 150").select("unique_id")
    validated = aggregates.series_length(valid).filter("n >= 20").select("unique_id")
    return long_enough.intersect(validated)


@query("except_ids", text(*DIFF, """
SELECT count(*) FILTER (side = 'm') AS missing, count(*) FILTER (side = 'e') AS extra FROM (
  SELECT Id, 'm' AS side FROM (SELECT Id FROM template EXCEPT SELECT Id FROM predicted)
  UNION ALL SELECT Id, 'e' FROM (SELECT Id FROM predicted EXCEPT SELECT Id FROM template))"""))
def except_ids(spark, sf_dir):
    template, predicted = _template_and_predictions(spark, sf_dir)
    sides = template.exceptAll(predicted).withColumn("side", F.lit("m")).unionByName(
        predicted.exceptAll(template).withColumn("side", F.lit("e")))
    return sides.agg(F.count_if(F.col("side") == "m").alias("missing"), F.count_if(F.col("side") == "e").alias("extra"))
