import datetime as dt

import pytest
from conftest import friday
from pyspark.sql import functions as F

from panelcast.functions.calendar import holiday_dates
from panelcast.operators import clean, joins, rows

EVENTS = [d for _, d in holiday_dates()]


def fill(values):
    out, last = [], None
    for v in values:
        last = v if v is not None else last
        out.append(last)
    nxt = None
    for i in range(len(out) - 1, -1, -1):
        nxt = values[i] if values[i] is not None else nxt
        out[i] = out[i] if out[i] is not None else nxt
    return out


def test_fill_head_middle_tail(spark):
    vals = [None, 1.0, None, None, 4.0, None]
    df = spark.createDataFrame([(1, friday(i), v) for i, v in enumerate(vals)] + [(2, friday(0), None)], "Store int, Date date, CPI double")
    got = {(r.Store, r.Date): r.CPI for r in clean.ffill_bfill(df, ["CPI"]).collect()}
    assert [got[1, friday(i)] for i in range(6)] == fill(vals) == [1.0, 1.0, 1.0, 1.0, 4.0, 4.0]
    assert got[2, friday(0)] is None


def test_chunked_fill_equals_the_fill_in_row_order(spark):
    keys = [(s, d, i) for s in (1, 2) for d in range(1, 7) for i in range(8)]
    value = {k: (float(sum(k)) if (k[0] * 5 + k[1] * 3 + k[2] * 7) % 6 == 0 and k[1] != 3 else None) for k in keys}
    df = spark.createDataFrame([(s, d, friday(i), value[s, d, i]) for s, d, i in keys], "Store int, Dept int, Date date, CPI double")
    got = {(r.Store, r.Dept, r.Date): r.CPI for r in clean.ffill_bfill(df, ["CPI"], ["Store"], ["Dept", "Date"]).collect()}
    for s in (1, 2):
        mine = [k for k in keys if k[0] == s]
        assert [got[a, b, friday(c)] for a, b, c in mine] == fill([value[k] for k in mine])


COV = "Store int, Dept int, Date date, CPI double, Unemployment double, MarkDown1 double, MarkDown2 double, MarkDown3 double, MarkDown4 double, MarkDown5 double, Type string, IsHoliday boolean"


def test_shared_features_twice_changes_nothing(spark):
    df = spark.createDataFrame(
        [(1, d, friday(i), None if i % 2 else 1.0 * i, 2.0, None, 1.0, None, None, 3.0, "A" if d == 1 else "Z", i == 1) for d in (1, 2) for i in range(5)], COV)
    once = clean.shared_features(df, EVENTS, ("Dept", "Date"))
    twice = clean.shared_features(once, EVENTS, ("Dept", "Date"))
    assert once.columns == twice.columns
    assert sorted(map(str, once.collect())) == sorted(map(str, twice.collect()))
    z = once.filter("Dept = 2").first()
    assert (z.Type_A, z.Type_B, z.Type_C, z.MarkDown1) == (0, 0, 0, 0.0)


def test_dedupe_keeps_the_first_by_explicit_order(spark):
    df = spark.createDataFrame([(1, 9.0), (1, 2.0), (2, 5.0)], "k int, v double")
    assert sorted(map(tuple, clean.dedupe_first(df, ["k"], ["v"]).collect())) == [(1, 2.0), (2, 5.0)]


def test_store_date_features_one_row_per_store_week(spark):
    rows_ = [(1, friday(i), None if i else 2.0, 1.0, None, None, None, None, None, True) for i in range(3)] * 2
    df = spark.createDataFrame(rows_, "Store int, Date date, CPI double, Unemployment double, MarkDown1 double, MarkDown2 double, MarkDown3 double, MarkDown4 double, MarkDown5 double, IsHoliday boolean")
    out = clean.store_date_features(df, EVENTS)
    assert out.count() == 3 and out.filter("CPI = 2.0 and IsHoliday = 1").count() == 3


def test_cap_infinities(spark):
    inf = float("inf")
    df = spark.createDataFrame([(1.0, inf), (inf, inf), (-inf, inf), (5.0, inf), (None, inf)], "a double, b double")
    got = [tuple(r) for r in rows.cap_infinities(df, ["a", "b"]).collect()]
    assert sorted(got, key=str) == sorted([(1.0, 0.0), (5.0, 0.0), (5.0, 0.0), (5.0, 0.0), (None, 0.0)], key=str)


def test_column_and_coverage_gates(spark):
    df = spark.createDataFrame([("1_1", 1.0), ("1_2", None)], "unique_id string, CPI double")
    with pytest.raises(ValueError, match="Size"):
        rows.require_columns(df, ["CPI", "Size"])
    with pytest.raises(ValueError, match="1 series.*1_2"):
        rows.require_coverage(df, ["CPI"])
    assert rows.require_coverage(df.filter("CPI is not null"), ["CPI"]).count() == 1
    assert rows.select_columns(df, ["unique_id"], ["nope", "CPI"]).columns == ["unique_id", "CPI"]


def test_three_key_join_needs_equal_flags(spark):
    fact = spark.createDataFrame([(1, dt.date(2010, 2, 12), True), (1, dt.date(2010, 2, 19), False)], "Store int, Date date, IsHoliday boolean")
    cov = spark.createDataFrame([(1, dt.date(2010, 2, 12), False, 7.0), (1, dt.date(2010, 2, 19), False, 8.0)], "Store int, Date date, IsHoliday boolean, CPI double")
    assert [r.CPI for r in joins.join_covariates_3key(fact, cov).orderBy("Date").collect()] == [None, 8.0]
    assert [r.CPI for r in joins.join_covariates_2key(fact, cov).orderBy("Date").collect()] == [7.0, 8.0]


def test_salted_lookup_equals_the_plain_join(spark):
    fact = spark.range(1000).select((F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id") % 7)).cast("int").alias("Store"), "id")
    dim = spark.createDataFrame([(i, i * 10) for i in range(5)], "Store int, Size int")
    plain = sorted(map(tuple, fact.join(dim, "Store", "left").select("Store", "id", "Size").collect()), key=str)
    salted = sorted(map(tuple, joins.salted_lookup(fact, dim, ["Store"], 4, ["id"]).select("Store", "id", "Size").collect()), key=str)
    assert plain == salted


def test_left_joins_keep_every_fact_row(spark, gappy):
    fact = gappy[0].withColumn("unique_id", F.concat_ws("_", "Store", "Dept")).withColumn("ds", F.col("Date"))
    n = fact.count()
    cov = fact.filter("Store = 1 and Dept = 1").select("Store", "Date", "IsHoliday").withColumns({
        c: F.lit(1.0) for c in ["CPI", "Unemployment", *[f"MarkDown{i}" for i in range(1, 6)]]})
    stores = spark.createDataFrame([(1, "A", 5)], "Store int, Type string, Size int")
    last = spark.createDataFrame([("1_1", 3.0)], "unique_id string, last_y double")
    median = spark.createDataFrame([(2.0,)], "median_y double")
    flags = fact.filter("Dept = 1").select("unique_id", "ds", "IsHoliday")
    forecast = fact.filter("Store = 2").select("unique_id", "ds", F.lit(1.0).alias("prediction"))
    results = [
        joins.join_covariates_3key(fact, cov), joins.join_covariates_2key(fact, cov), joins.join_stores(fact, stores),
        joins.join_store_onehot(fact, stores), joins.salted_lookup(fact, stores, ["Store"], 3, ["Date"]),
        joins.join_forecast(fact, forecast), joins.join_holidays(fact.drop("IsHoliday"), joins.holiday_lookup(flags)),
        joins.map_lookup(fact, last, "unique_id", "last_y"),
        joins.with_fallbacks(fact.withColumn("prediction", F.lit(None).cast("double")), last, median)]
    assert [r.count() for r in results] == [n] * len(results)
    assert {r.prediction for r in results[-1].select("prediction").distinct().collect()} == {3.0, 2.0}


def test_copies_of_a_store_week_change_nothing(spark):
    """A third of all rows are copies of one store-week."""
    rows_ = [(s, friday(i), None if (s + i) % 3 else float(i), 1.0, None, 2.0, None, None, None, False) for s in (1, 2) for i in range(30)]
    schema = "Store int, Date date, CPI double, Unemployment double, MarkDown1 double, MarkDown2 double, MarkDown3 double, MarkDown4 double, MarkDown5 double, IsHoliday boolean"
    plain = clean.store_date_features(spark.createDataFrame(rows_, schema), EVENTS)
    copied = clean.store_date_features(spark.createDataFrame(rows_ + rows_[7:8] * 30, schema), EVENTS)
    assert sorted(map(str, plain.collect())) == sorted(map(str, copied.collect()))
