"""How often a plan shuffles and reads."""

import datetime as dt
import re

import pytest
from conftest import friday
from pyspark.sql import functions as F

from panelcast.operators import joins, panel, split

LONG = "unique_id string, ds date, y double, z int"


@pytest.fixture()
def no_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def exchanges(df):
    text = df._jdf.queryExecution().optimizedPlan().toString(), df._jdf.queryExecution().executedPlan().toString()
    return len(re.findall(r"Exchange ", text[1])), len(re.findall(r"Relation ", text[0]))


def test_densifying_and_blending_take_one_shuffle(spark, no_broadcast, tmp_path):
    spark.createDataFrame([("a", friday(i), float(i), i) for i in (0, 3, 4)], LONG).write.parquet(f"{tmp_path}/t")
    long = spark.read.parquet(f"{tmp_path}/t")
    filled = panel.interpolate_linear(panel.weekly_spine(long))
    assert exchanges(filled) == (1, 1)
    assert [(r.ds, r.y, r.z) for r in filled.orderBy("ds").collect()] == [(friday(i), float(i), i if i in (0, 3, 4) else None) for i in range(5)]


def test_spine_keeps_repeated_weeks_and_drops_rows_without_a_key(spark):
    rows = [("a", friday(0), 1.0, 1), ("a", friday(0), 2.0, 2), ("a", friday(2), 3.0, 3), (None, friday(0), 4.0, 4), ("b", None, 5.0, 5), ("c", friday(9), None, 6)]
    out = panel.weekly_spine(spark.createDataFrame(rows, LONG))
    assert out.columns == ["unique_id", "ds", "y", "z"]
    got = sorted((r.unique_id, r.ds, r.z or 0) for r in out.collect())
    assert got == [("a", friday(0), 1), ("a", friday(0), 2), ("a", friday(1), 0), ("a", friday(2), 3), ("c", friday(9), 6)]
    assert panel.weekly_spine(spark.createDataFrame([], LONG)).collect() == []


def test_sample_reads_the_panel_once(spark, tmp_path, monkeypatch):
    rows = [(f"{k}_1", friday(i), float(k), 0) for k in range(40) for i in range(3)]
    spark.createDataFrame(rows, LONG).write.parquet(f"{tmp_path}/panel")
    long = spark.read.parquet(f"{tmp_path}/panel")
    written = []
    real = split.write_once
    monkeypatch.setattr(split, "write_once", lambda df, name: (written.append(exchanges(df)), real(df, name))[1])
    sample = split.stratified_sample(long, 12)
    assert written == [(1, 1)]
    assert f"{tmp_path}/panel" not in sample._jdf.queryExecution().executedPlan().toString()
    assert exchanges(sample) == (1, 1)
    assert sorted((r.quartile, r["count"]) for r in sample.groupBy("quartile").count().collect()) == [(q, 3) for q in range(4)]


def test_sample_of_nothing(spark):
    assert split.stratified_sample(spark.createDataFrame([], LONG), 8).collect() == []
    bare = spark.createDataFrame([("a", dt.date(2010, 2, 5), None, 1)], LONG)
    assert split.stratified_sample(bare.withColumn("y", F.col("y")), 8).collect() == []


# as-of join

def nearest(at, events):
    return max((e for e in events if e <= at), default=None), min((e for e in events if e >= at), default=None)


@pytest.mark.parametrize("by", [(), ("k",)])
@pytest.mark.parametrize("parts", [1, 7])
def test_nearest_events_against_brute_force(spark, no_broadcast, by, parts):
    import random

    rng = random.Random(8)
    rows = [(i, rng.choice([None, "a", "b", "c", "d"]), rng.choice([None, *range(300)])) for i in range(400)] + [(1000 + i, "a", 17) for i in range(200)]
    marks = [(rng.choice([None, "a", "b", "b"]), rng.choice([None, *range(40, 280, 7)])) for _ in range(60)]
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    try:
        out = joins.nearest_events(spark.createDataFrame(rows, "id int, k string, at int"), spark.createDataFrame(marks, "k string, at int"), "at", by)
        got = {r.id: (r.last_event, r.next_event) for r in out.collect()}
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert len(got) == len(rows)
    for i, k, at in rows:
        events = [e for key, e in marks if e is not None and (not by or (key == k and k is not None))]
        assert got[i] == (nearest(at, events) if at is not None and (k is not None or not by) else (None, None))


def test_nearest_events_of_empty_tables(spark):
    rows, none = spark.createDataFrame([(1, 5)], "id int, at int"), spark.createDataFrame([], "at int")
    assert [tuple(r) for r in joins.nearest_events(rows, none, "at").select("id", "last_event", "next_event").collect()] == [(1, None, None)]
    assert joins.nearest_events(rows.limit(0), rows, "at").collect() == []


def test_nearest_events_needs_no_broadcast_for_many_events(spark, no_broadcast):
    rows, events = spark.range(3000).selectExpr("id", "id * 37 % 100000 at"), spark.range(100_000).selectExpr("id * 3 at")
    out = joins.nearest_events(rows, events, "at")
    assert "Broadcast" not in out._jdf.queryExecution().executedPlan().toString()
    wrong = out.where("last_event != at - at % 3 or next_event != at + (3 - at % 3) % 3 or last_event is null or next_event is null")
    assert out.count() == 3000 and wrong.count() == 0
