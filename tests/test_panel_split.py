import numpy as np
import pytest
from conftest import friday
from pyspark.sql import functions as F

from panelcast.operators import panel, quantiles, split


@pytest.fixture(scope="module")
def long(gappy):
    return panel.to_long(gappy[0], covariates=["IsHoliday"])


def test_to_long_strict_and_lenient(gappy):
    df, rows = gappy
    with pytest.raises(ValueError, match="CPI"):
        panel.to_long(df, covariates=["CPI"])
    out = panel.to_long(df, covariates=["IsHoliday", "CPI"], strict=False)
    assert out.columns == ["unique_id", "ds", "y", "IsHoliday"] and out.count() == len(rows)
    assert dict(out.dtypes)["IsHoliday"] == "int"


def test_spine_has_no_gaps(long):
    spine = panel.weekly_spine(long)
    got = spine.groupBy("unique_id").agg(F.count("*").alias("n"), F.min("ds").alias("a"), F.max("ds").alias("b")).collect()
    assert all(r.n == (r.b - r.a).days // 7 + 1 for r in got)
    assert spine.filter("y is not null").count() == long.count()


def test_interpolation_matches_numpy(long):
    spine = panel.weekly_spine(long)
    got = panel.interpolate_linear(spine).toPandas().sort_values(["unique_id", "ds"])
    raw = spine.toPandas().sort_values(["unique_id", "ds"])
    for uid, g in got.groupby("unique_id"):
        y = raw[raw.unique_id == uid]["y"].to_numpy(float)
        i, known = np.arange(len(y)), ~np.isnan(y)
        np.testing.assert_allclose(g["y"].to_numpy(float), np.interp(i, i[known], y[known]))


def test_interpolation_extends_both_ends(spark):
    df = spark.createDataFrame([("a", friday(i), v) for i, v in enumerate([None, None, 3.0, None, 7.0, None])], "unique_id string, ds date, y double")
    assert [r.y for r in panel.interpolate_linear(df).orderBy("ds").collect()] == [3.0, 3.0, 3.0, 5.0, 7.0, 7.0]


def test_future_grid_tail_and_context(long):
    grid = panel.future_grid(long, 3).filter("unique_id = '2_1'").orderBy("ds").collect()
    assert [r.ds for r in grid] == [friday(130), friday(131), friday(132)]
    assert panel.tail_n(long, 5, ["unique_id"], "ds").groupBy("unique_id").count().filter("count = 5").count() == 3
    ctx = panel.series_context(long, 40, ["IsHoliday"])
    sizes = {r.unique_id: (len(r.context), len(r.hist_IsHoliday), r.last_ds) for r in ctx.collect()}
    assert sizes["1_1"] == (40, 40, friday(149)) and sizes["2_1"] == (30, 30, friday(129))
    ahead = panel.future_grid(long, 3).withColumn("IsHoliday", F.lit(1))
    seq = {r.unique_id: r.IsHoliday for r in panel.covariate_sequence(ctx, ahead, ["IsHoliday"]).collect()}
    assert len(seq["1_1"]) == 43 and seq["1_1"][-3:] == [1.0, 1.0, 1.0]


def test_static_has_one_row_per_series(gappy):
    df = gappy[0].withColumn("Size", F.col("Store") * 10)
    out = panel.to_static(df, ["Store", "Size"])
    assert sorted(map(tuple, out.collect())) == [("1_1", 1, 10), ("1_2", 1, 10), ("2_1", 2, 20)]
    with pytest.raises(ValueError, match="Type_A"):
        panel.to_static(df, ["Type_A"])


def test_robust_scale_of_a_constant_series(spark):
    df = spark.createDataFrame([("c", friday(i), 4.0) for i in range(5)] + [("v", friday(i), float(i)) for i in range(5)], "unique_id string, ds date, y double")
    for method in ("robust", "standard"):
        out = panel.robust_scale(df, method)
        assert out.filter("unique_id = 'c' and scaled <> 0").count() == 0
    assert panel.robust_scale(df).filter("unique_id = 'v'").agg(F.max("scaled")).first()[0] == 1.0


def test_time_split(gappy):
    df, rows = gappy
    train, valid = split.time_split(df, 10)
    days = sorted({r[2] for r in rows})
    assert train.agg(F.max("Date")).first()[0] == days[-11] and valid.agg(F.min("Date")).first()[0] == days[-10]
    assert train.count() + valid.count() == len(rows)


def test_time_split_with_too_few_dates(gappy):
    with pytest.raises(Exception, match="Not enough dates"):
        split.time_split(gappy[0], 150)[0].count()


def test_complete_series(long):
    cut = F.lit(friday(111)).cast("date")
    assert [r[0] for r in split.complete_series(long, cut, 39).collect()] == ["1_1"]
    assert split.complete_series(long, cut, 38).count() == 0


def test_backtest_skips_incomplete_windows(long):
    history, actual = split.backtest_window(long, F.lit(friday(111)).cast("date"), 39, 20)
    assert {r[0] for r in actual.select("unique_id").distinct().collect()} == {"1_1"}
    assert history.count() == 20 and actual.count() == 39
    assert history.agg(F.max("ds")).first()[0] < friday(111)


def test_insample_windows(long):
    out = split.insample_windows(long, 39).filter("unique_id = '1_1'")
    got = out.groupBy("window", "cutoff").count().orderBy("window").collect()
    assert [(r["window"], r["cutoff"], r["count"]) for r in got] == [(0, friday(0), 39), (1, friday(39), 39), (2, friday(78), 39), (3, friday(117), 33)]


def test_stratified_sample_takes_the_same_from_each_quartile(spark):
    df = spark.range(40).select(F.concat(F.lit("s"), "id").alias("unique_id"), F.col("id").cast("double").alias("y"))
    one = split.stratified_sample(df, 14)
    assert {r["count"] for r in one.groupBy("quartile").count().collect()} == {3}
    assert sorted(one.collect()) == sorted(split.stratified_sample(df.repartition(5), 14).collect())
    assert sorted(one.collect()) != sorted(split.stratified_sample(df, 14, seed=7).collect())


@pytest.mark.parametrize("accuracy", [10_000, 20])
def test_exact_quantiles_of_skewed_columns(spark, monkeypatch, accuracy):
    """A small sketch forces the bracket, bin and neighbour cases."""
    monkeypatch.setattr(quantiles, "ACCURACY", accuracy)
    monkeypatch.setattr(quantiles, "BINS", 8)
    rng = np.random.default_rng(3)
    cases = [
        rng.lognormal(3, 3, 2001), rng.normal(size=1000), np.r_[np.full(700, 5.0), rng.normal(size=1301)],
        np.array([1.0]), np.array([2.0, 1.0]), np.full(50, 3.0), np.r_[-1e12, rng.integers(0, 9, 400), 1e12]]
    probs = [0.0, 0.25, 0.5, 0.75, 1.0]
    for values in cases:
        df = spark.createDataFrame([(float(v),) for v in values] + [(None,), (float("nan"),)], "v double")
        got = {r.prob: r.value for r in quantiles.exact_quantiles(df, "v", probs).collect()}
        np.testing.assert_allclose([got[p] for p in probs], np.quantile(values, probs), rtol=1e-12)


def test_median_paths_agree(spark):
    df = spark.createDataFrame([(float(v),) for v in [5, 1, 9, 2]] + [(None,), (float("nan"),)], "v double")
    assert quantiles.exact_median(df, "v").first()[0] == 3.5
    empty = df.filter("v > 100 and not isnan(v)")
    assert quantiles.exact_median(empty, "v").first()[0] is None
