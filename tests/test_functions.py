import datetime as dt

import pytest
from pyspark.sql import functions as F

from panelcast.functions import calendar as cal
from panelcast.functions import ids, scalars


def test_rule_gives_the_published_calendar():
    assert [(n, d.isoformat()) for n, d in cal.holiday_dates()] == [
        ("Super_Bowl", "2010-02-12"), ("Super_Bowl", "2011-02-11"), ("Super_Bowl", "2012-02-10"), ("Super_Bowl", "2013-02-08"),
        ("Labor_Day", "2010-09-10"), ("Labor_Day", "2011-09-09"), ("Labor_Day", "2012-09-07"), ("Labor_Day", "2013-09-06"),
        ("Thanksgiving", "2010-11-26"), ("Thanksgiving", "2011-11-25"), ("Thanksgiving", "2012-11-23"), ("Thanksgiving", "2013-11-29"),
        ("Christmas", "2010-12-31"), ("Christmas", "2011-12-30"), ("Christmas", "2012-12-28"), ("Christmas", "2013-12-27")]


def test_rule_expression_agrees_with_the_generated_dates(spark):
    days = spark.sql("select explode(sequence(date'2009-01-01', date'2014-12-31', interval 1 day)) as Date")
    hits = {(r[0], r[1]) for r in days.select(cal.holiday_name(), "Date").collect() if r[0]}
    assert hits == set(cal.holiday_dates(2009, 2014))


def test_event_distance_is_infinite_outside_the_calendar(spark):
    events = [d for _, d in cal.holiday_dates()]
    df = spark.createDataFrame([(dt.date(2010, 2, 5),), (dt.date(2010, 2, 12),), (dt.date(2011, 1, 7),), (dt.date(2014, 1, 3),)], "Date date")
    got = df.select(*[v.alias(k) for k, v in cal.event_distance("Date", events).items()]).collect()
    assert [tuple(r) for r in got] == [(float("inf"), 7.0), (0.0, 0.0), (7.0, 35.0), (7.0, float("inf"))]


def test_iso_week_with_calendar_year(spark):
    df = spark.createDataFrame([(dt.date(2010, 1, 3),)], "Date date").withColumns(cal.calendar_parts())
    assert tuple(df.first())[1:] == (2010, 1, 53)


def test_ids_round_trip(spark):
    df = spark.createDataFrame([(3, 71, dt.date(2012, 11, 2))], "Store int, Dept int, Date date")
    out = df.select(ids.series_id().alias("unique_id"), ids.submission_id().alias("Id"))
    assert tuple(out.first()) == ("3_71", "3_71_2012-11-02")
    assert tuple(out.select(*ids.split_series_id()).first()) == (3, 71)
    bad = spark.createDataFrame([("x",)], "unique_id string").select(*ids.split_series_id()).first()
    assert tuple(bad) == (None, None)


def test_scalars(spark):
    df = spark.createDataFrame([(None, 5.0), (0.0, 5.0), (4.0, 6.0), (4.0, 3.0), (4.0, 4.0)], "t double, v double")
    got = df.select(scalars.gap_pct("t", "v"), scalars.fit_status(scalars.gap_pct("t", "v"))).collect()
    assert [tuple(r) for r in got] == [(None, "unknown"), (None, "unknown"), (50.0, "overfit"), (-25.0, "underfit"), (0.0, "good")]
    x = spark.createDataFrame([(-1.0,), (2.0,), (None,), (float("inf"),), (float("nan"),)], "x double")
    assert [r[0] for r in x.limit(3).select(scalars.clip_nonnegative("x")).collect()] == [0.0, 2.0, None]
    assert x.filter(scalars.replace_infinite("x").isNull()).count() == 2
    assert x.select(scalars.fallback_chain("x", F.lit(7.0))).collect()[4][0] == 7.0


def test_one_hot_and_weight(spark):
    df = spark.createDataFrame([("A", True), ("D", False), (None, None)], "Type string, IsHoliday boolean")
    got = df.select(scalars.one_hot("Type", "A"), scalars.holiday_weight()).collect()
    assert [tuple(r) for r in got] == [(1, 5.0), (0, 1.0), (0, 1.0)]


@pytest.mark.parametrize("text, parse, want", [
    ("[3, 3]", scalars.parse_int_list, [3, 3]),
    ("['trend', 'seasonality']", scalars.parse_string_list, ["trend", "seasonality"]),
    ("[[512, 512], [64, 64]]", scalars.parse_nested_int_list, [[512, 512], [64, 64]]),
])
def test_stringified_lists(spark, text, parse, want):
    assert spark.createDataFrame([(text,)], "p string").select(parse("p")).first()[0] == want
