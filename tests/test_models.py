import numpy as np
import pytest
from conftest import friday
from pyspark.sql import functions as F

from panelcast import schemas
from panelcast.models import baselines, gbt, grids, grouped, linear, solvers
from panelcast.operators import split

LONG = "unique_id string, ds date, y double"
H = 39


def season(i):
    return 100.0 + 0.2 * i + 20.0 * np.sin(2 * np.pi * (7 * i) / 365.25)


@pytest.fixture(scope="module")
def long(spark):
    rows = [("1_1", friday(i), float(season(i))) for i in range(200)]
    rows += [("1_2", friday(i), float(300 - season(i))) for i in range(200) if i % 11 != 5 or i > 150]
    rows += [("2_1", friday(i), 5.0 + i % 3) for i in range(150, 200)]
    rows += [("3_1", friday(i), float(100 * np.exp(0.002 * i + 0.2 * np.sin(2 * np.pi * (7 * i) / 365.25)))) for i in range(200)]
    return spark.createDataFrame(rows, LONG)


@pytest.fixture(scope="module")
def cutoff(long):
    return split.cutoff_value(long, H, "ds")


def test_ar1_coefficient_and_forecast():
    rng = np.random.default_rng(0)
    y = np.zeros(3000)
    for t in range(1, len(y)):
        y[t] = 0.7 * y[t - 1] + rng.normal()
    cfg = {"order": [1, 0, 0], "trend": "n"}
    coefs = solvers.arma_fit(y, cfg)
    assert abs(coefs[0] - 0.7) < 0.05
    np.testing.assert_allclose(solvers.arma_forecast(y, coefs, cfg, 3), y[-1] * coefs[0] ** np.arange(1, 4))


def test_ma1_coefficient():
    rng = np.random.default_rng(1)
    e = rng.normal(size=5000)
    y = e[1:] + 0.5 * e[:-1]
    assert abs(solvers.arma_fit(y, {"order": [0, 0, 1], "trend": "n"})[0] - 0.5) < 0.08


def test_differencing_is_undone():
    y = np.arange(120.0) ** 2
    for cfg in ({"order": [0, 2, 0], "trend": "c"}, {"order": [1, 2, 0], "trend": "c"}):
        got = solvers.arma_forecast(y, solvers.arma_fit(y, cfg), cfg, 4)
        np.testing.assert_allclose(got, np.arange(120.0, 124.0) ** 2, rtol=1e-6)
    wave = np.tile(np.arange(52.0), 4) + np.repeat(np.arange(4) * 10.0, 52)
    cfg = {"order": [0, 0, 0], "seasonal_order": [0, 1, 0, 52], "trend": "c"}
    np.testing.assert_allclose(solvers.arma_forecast(wave, solvers.arma_fit(wave, cfg), cfg, 3), [40.0, 41.0, 42.0], rtol=1e-9)
    cfg = {"order": [0, 1, 0], "seasonal_order": [0, 1, 0, 52], "trend": "n"}
    np.testing.assert_allclose(solvers.arma_forecast(wave, solvers.arma_fit(wave, cfg), cfg, 3), [40.0, 41.0, 42.0], rtol=1e-9)


def test_multiplicative_form_takes_weeks_without_sales():
    days = np.arange(200) * 7.0
    y = (100 + 0.2 * np.arange(200)) * (1 + 0.3 * np.sin(2 * np.pi * days / 365.25))
    y[[40, 90]] = [-5.0, 0.0]
    cfg = grids.pick(grids.additive(), "balanced_6")[0]
    coefs = solvers.additive_fit(days, y, np.zeros(200), cfg)
    error = np.abs(solvers.additive_predict(days, np.zeros(200), coefs, cfg) - y)
    assert np.median(error) < 6


def test_fitted_values_plus_shocks_give_the_series_back():
    rng = np.random.default_rng(2)
    y = np.cumsum(rng.normal(size=300)) + 50
    cfg = {"order": [2, 1, 1], "trend": "c"}
    fitted = solvers.arma_fitted(y, solvers.arma_fit(y, cfg), cfg)
    assert fitted.shape == y.shape and np.abs(y - fitted)[10:].mean() < 1.2


@pytest.mark.parametrize("value, ok", [([1e17], False), ([float("nan")], False), ([], False), ([149.0], True), ([151.0], False)])
def test_divergence_guard(value, ok):
    assert solvers.is_plausible(np.array(value), np.array([3.0, -2.0, np.nan])) is ok
    assert solvers.is_plausible(np.array([0.9]), np.zeros(3))


@pytest.mark.parametrize("family, config, series, bound", [
    ("Additive", grids.pick(grids.additive(), "balanced_1")[0], "1_1", 3.0),
    ("Additive", grids.pick(grids.additive(), "balanced_6")[0], "3_1", 5.0),
    ("Basis", {"label": "b", "regime": "r", "input_size": 156, "n_harmonics": 2, "n_polynomials": 1}, "1_1", 1.0),
    ("ARIMA", grids.pick(grids.arima(), "complex_5")[0], "1_1", 60.0),
    ("SARIMA", grids.pick(grids.seasonal_arima(), "balanced_1")[0], "1_1", 12.0),
])
def test_sweep_on_known_series(spark, long, cutoff, family, config, series, bound):
    fits = grouped.sweep_fit(long, cutoff, family, grids.config_table(spark, [config])).toPandas()
    valid = fits[~fits.is_train]
    assert len(valid) == 4 * H and valid.prediction.notna().all() and np.isfinite(valid.prediction).all()
    good = valid[valid.unique_id == series]
    assert not good.used_fallback.any()
    assert (good.y - good.prediction).abs().mean() < bound
    short = valid[valid.unique_id == "2_1"]
    assert short.used_fallback.all() and set(short.prediction) == {5.0 + 160 % 3}
    assert (fits.groupby("unique_id").size() == [200, 200 - 14, 50, 200]).all()


@pytest.mark.parametrize("family, config", [
    ("Additive", grids.pick(grids.additive(), "balanced_1")[0]), ("ARIMA", grids.pick(grids.arima(), "balanced_9")[0])])
def test_failing_series_leave_the_training_error_alone(spark, long, cutoff, family, config):
    configs = grids.config_table(spark, [config])
    whole, part = (grouped.sweep_report(grouped.sweep_fit(x, cutoff, family, configs), configs).first()
                   for x in (long, long.filter("unique_id != '2_1'")))
    assert whole.fallback_series == 1 and part.fallback_series == 0
    assert abs(whole.train_wmae - part.train_wmae) < 1e-9


def test_weeks_without_history_have_no_fit():
    y = np.cumsum(np.arange(30.0))
    fitted = solvers.arma_fitted(y, solvers.arma_fit(y, {"order": (2, 1, 0)}), {"order": (2, 1, 0)})
    assert np.isnan(fitted[:3]).all() and np.isfinite(fitted[3:]).all()


def test_sweep_report_counts_fallbacks(spark, long, cutoff):
    configs = grids.config_table(spark, grids.pick(grids.additive(), "underfit_1", "balanced_1"))
    report = grouped.sweep_report(grouped.sweep_fit(long, cutoff, "Additive", configs), configs)
    got = {r.label: r for r in report.collect()}
    assert set(got) == {"underfit_1", "balanced_1"} and {r.fallback_series for r in got.values()} == {1}
    assert got["balanced_1"].train_wmae < got["underfit_1"].train_wmae  # looser priors follow the data closer


@pytest.mark.parametrize("family, config", [
    ("Additive", grids.pick(grids.additive(), "balanced_8")[0]), ("ARIMA", grids.pick(grids.arima(), "balanced_9")[0])])
def test_refit_store_and_forecast(long, family, config):
    models = grouped.final_refit(long, family, config)
    status = {r.unique_id: r.status for r in models.collect()}
    assert status["1_1"] == status["1_2"] == "fitted"
    out = grouped.forecast_models(models, long, family, config, 5)
    got = out.filter("unique_id = '1_1'").orderBy("ds").collect()
    assert [r.ds for r in got] == [friday(i) for i in range(200, 205)]
    assert all(np.isfinite(r.prediction) for r in got)


def test_failed_refit_is_listed(spark):
    tiny = spark.createDataFrame([("9_9", friday(i), 1.0) for i in range(6)], LONG)
    row = grouped.final_refit(tiny, "ARIMA", grids.pick(grids.arima(), "complex_6")[0]).first()
    assert row.status == "failed" and row.coefs is None


def test_last_value_forecast(long):
    out = baselines.last_value_forecast(long, 3).filter("unique_id = '2_1'").collect()
    assert [r.prediction for r in out] == [5.0 + 199 % 3] * 3


def test_decomposed_linear_learns_a_shared_pattern(spark):
    rows = [(f"{s}_1", friday(i), float(10 * s + s * 5 * np.sin(2 * np.pi * i / 13))) for s in range(1, 6) for i in range(160)]
    df = spark.createDataFrame(rows, LONG)
    cut = F.lit(friday(147)).cast("date")
    out = linear.decomposed_linear(df, cut, 13, input_size=26, moving_avg=5, ridge=1e-8)
    joined = out.join(df, ["unique_id", "ds"]).toPandas()
    assert len(joined) == 5 * 13 and (joined.prediction - joined.y).abs().max() < 0.5


@pytest.mark.parametrize("order", ["xreg + base", "base + xreg"])
def test_covariate_ridge_uses_the_covariate(spark, order):
    rng = np.random.default_rng(5)
    rows = []
    for s in range(1, 4):
        promo = rng.integers(0, 2, 150)
        rows += [(f"{s}_1", friday(i), float(100 * s + 30 * s * promo[i]), i < 111, float(promo[i])) for i in range(150)]
    df = spark.createDataFrame(rows, LONG + ", is_train boolean, promo double")
    out = linear.covariate_ridge(df, ["promo"], order, 0.0).filter("not is_train").toPandas()
    error = (out.y - out.prediction).abs().mean()
    assert len(out) == 3 * 39 and error < (5.0 if order == "xreg + base" else 45.0)
    with pytest.raises(ValueError, match="order"):
        linear.covariate_ridge(df, ["promo"], "other")


def test_covariate_ridge_equals_the_closed_form(spark):
    rng = np.random.default_rng(6)
    x = rng.normal(size=(40, 2))
    y = x @ [2.0, -1.0] + 3 + rng.normal(size=40)
    rows = [("1_1", friday(i), float(y[i]), i < 30, float(x[i, 0]), float(x[i, 1])) for i in range(40)]
    df = spark.createDataFrame(rows, LONG + ", is_train boolean, a double, b double")
    got = linear.covariate_ridge(df, ["a", "b"], "base + xreg", 5.0, weeks=100).filter("is_train").orderBy("ds").toPandas()
    mean, dev = y[:30].mean(), y[:30].std(ddof=1)
    design = np.c_[np.ones(30), x[:30]]
    w = np.linalg.solve(design.T @ design + np.diag([0.0, 5.0, 5.0]), design.T @ ((y[:30] - mean) / dev))
    np.testing.assert_allclose(got.prediction, design @ w * dev + mean, rtol=1e-9)


def test_short_series_repeat_their_last_value(spark):
    rows = [("1_1", friday(i), float(10 + i % 13)) for i in range(120)] + [("1_2", friday(i), float(i)) for i in range(90, 105)]
    out = linear.decomposed_linear(spark.createDataFrame(rows, LONG), F.lit(friday(100)).cast("date"), 13, input_size=26, moving_avg=5)
    got = {(r.unique_id, r.ds): r.prediction for r in out.collect()}
    assert len(got) == 26 and all(abs(got["1_2", friday(i)] - 99.0) < 1e-9 for i in range(100, 113))


@pytest.mark.parametrize("make, label, values", [
    (grids.decomposed_linear, "balanced_3", {"input_size": 52, "moving_avg_window": 25}),
    (grids.basis, "balanced_9", {"input_size": 52, "n_harmonics": 4, "n_polynomials": 3})])
def test_labels_name_the_published_configuration(make, label, values):
    (config,) = grids.pick(make(), label)
    assert values.items() <= config.items()


def test_tree_parameter_map():
    params, ignored = gbt.to_mllib({
        "label": "x", "regime": "y", "n_estimators": 7, "max_depth": -1, "learning_rate": 0.1, "subsample": 0.8,
        "colsample_bytree": 0.5, "min_child_weight": 0, "reg_lambda": 1.0, "num_leaves": 31})
    assert params == {"maxIter": 7, "maxDepth": 10, "stepSize": 0.1, "subsamplingRate": 0.8, "featureSubsetStrategy": "0.5", "minInstancesPerNode": 1}
    assert ignored == ["max_depth", "min_child_weight", "reg_lambda", "num_leaves"]
    assert gbt.to_mllib({"max_depth": 99})[1] == ["max_depth"] and gbt.to_mllib({"max_depth": 6})[1] == []
    assert gbt.to_mllib({"max_depth": 99, "colsample_bytree": 1.0})[0] == {"maxDepth": 30, "featureSubsetStrategy": "all"}


def test_trees_with_missing_and_infinite_values(spark):
    rng = np.random.default_rng(4)
    rows = []
    for i in range(300):
        x = {c: float(rng.normal()) for c in schemas.CALENDAR_FEATURES}
        x.update(Store=i % 3, Dept=i % 4, lag_52=None if i % 5 == 0 else 10.0 * (i % 3), DaysToNextHoliday=float("inf"))
        rows.append(tuple(x[c] for c in schemas.CALENDAR_FEATURES) + (100.0 * (i % 3),))
    kinds = ", ".join(f"{c} {'int' if c in ('Store', 'Dept') else 'double'}" for c in schemas.CALENDAR_FEATURES)
    df = spark.createDataFrame(rows, kinds + ", Weekly_Sales double")
    model = gbt.train_categorical(df, {"n_estimators": 3, "max_depth": 3, "learning_rate": 0.5})
    scored = gbt.score_categorical(model, df)
    assert scored.count() == 300 and scored.filter("isnan(prediction)").count() == 0
    assert scored.agg(F.avg(F.abs(F.col("prediction") - F.col("Weekly_Sales")))).first()[0] < 40
    unseen = gbt.score_categorical(model, df.limit(1).withColumn("Store", F.lit(99)))
    assert unseen.count() == 1


def test_rolling_origin_looks_at_nothing_behind_a_cutoff(spark):
    rng = np.random.default_rng(9)
    level = np.cumsum(rng.normal(size=140)) + 20
    rows = [("1_1", friday(i), float(level[i])) for i in range(140) if i not in (30, 31, 77)] + [("2_1", friday(i), 1.0) for i in range(20)]
    one = grouped.rolling_origin(spark.createDataFrame(rows, LONG), 13, 13, 40).collect()
    broken = [(k, d, y if d < friday(91) else -1e6) for k, d, y in rows]
    two = grouped.rolling_origin(spark.createDataFrame(broken, LONG), 13, 13, 40).collect()

    def at(got):
        return {(r.label, r.cutoff, r.ds): r.prediction for r in got if r.cutoff <= friday(91)}
    assert at(one) == at(two) and {r.unique_id for r in one} == {"1_1"}
    assert {r.cutoff for r in one} == {friday(i) for i in range(52, 140, 13)}
    weeks = np.array([i for i in range(78) if i not in (30, 31, 77)])
    slope, base = np.polyfit(weeks, level[weeks], 1)
    pairs = [(level[i - 1], level[i]) for i in weeks if i - 1 in weeks]
    phi = sum(a * b for a, b in pairs) / sum(a * a for a, _ in pairs)
    for r in one:
        if r.cutoff == friday(78):
            i = (r.ds - friday(0)).days // 7
            assert r.prediction == pytest.approx(base + slope * i if r.label == "trend" else level[76] * phi ** (i - 76), rel=1e-9)
