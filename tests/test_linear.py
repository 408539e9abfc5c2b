import datetime as dt

import numpy as np
import pytest
from conftest import friday
from pyspark.sql import functions as F

from panelcast.models import grids, grouped, linear

LONG = "unique_id string, ds date, y double"
H = 6


@pytest.fixture(scope="module")
def long(spark):
    rng = np.random.default_rng(0)
    rows = []
    for k, (a, b) in enumerate([(0, 80), (0, 80), (5, 80), (40, 80), (60, 80), (70, 76)]):
        level = np.cumsum(rng.normal(size=80)) * (k + 1) + 10 * k
        rows += [(f"{k}_1", friday(i), None if (k, i) == (1, 30) else float(level[i])) for i in range(a, b) if (k, i) not in ((1, 20), (1, 21), (2, 79))]
    return spark.createDataFrame(rows, LONG), rows


CUT = friday(74)


def windows(rows, size):
    """Scaled training series, and all windows of ``size`` weeks with the weeks ahead."""
    series = {}
    for k in sorted({r[0] for r in rows}):
        known = [((d - friday(0)).days // 7, y) for u, d, y in rows if u == k and d < CUT and y is not None]
        every = [(d - friday(0)).days // 7 for u, d, _ in rows if u == k and d < CUT]
        grid = np.arange(min(every), max(every) + 1)
        y = np.interp(grid, [i for i, _ in known], [v for _, v in known])
        low, mid, high = np.percentile(y, [25, 50, 75])
        series[k] = grid, (y - mid) / ((high - low) or 1), mid, (high - low) or 1
    x, y = [], []
    for _, v, _, _ in series.values():
        for end in range(size, len(v) - H + 1):
            x.append(v[end - size:end])
            y.append(v[end:end + H])
    return series, np.array(x), np.array(y)


def trend(window, width):
    left = (width - 1) // 2
    padded = np.r_[[window[0]] * left, window, [window[-1]] * (width - 1 - left)]
    return np.convolve(padded, np.ones(width) / width, "valid")


CONFIGS = [{"label": f"{s}_{m}", "regime": "r", "input_size": s, "moving_avg_window": m} for s, m in ((4, 3), (13, 5), (13, 9), (26, 13), (40, 3), (500, 3))]


def test_grid_equals_a_regression_on_explicit_windows(spark, long):
    frame, rows = long
    out = linear.decomposed_grid(frame, F.lit(CUT), H, CONFIGS, 0.01).collect()
    got = {(r.label, r.unique_id, r.ds): r for r in out}
    assert len(out) == len(CONFIGS) * len(rows)
    for cfg in CONFIGS[:-1]:
        size, width = cfg["input_size"], cfg["moving_avg_window"]
        series, x, y = windows(rows, size)
        parts = np.array([np.r_[t := trend(w, width), w - t] for w in x])
        mean, ahead = parts.mean(axis=0), y.mean(axis=0)
        square = (parts - mean).T @ (parts - mean)
        w = np.linalg.solve(square + 0.01 * np.trace(square) / len(square) * np.eye(len(square)), (parts - mean).T @ (y - ahead))

        def forecast(window, mid, spread):
            t = trend(window, width)
            return (ahead + (np.r_[t, window - t] - mean) @ w) * spread + mid
        for k, (grid, v, mid, spread) in series.items():
            mine = [r for (label, u, _), r in got.items() if (label, u) == (cfg["label"], k)]
            if len(v) < size:
                last = [y for u, d, y in rows if u == k and d < CUT and y is not None][-1]
                assert all(r.used_fallback and r.prediction == last for r in mine if not r.is_train)
                continue
            following = forecast(v[-size:], mid, spread)
            for r in mine:
                week = (r.ds - friday(0)).days // 7
                assert not r.used_fallback
                if not r.is_train:
                    assert r.prediction == pytest.approx(following[week - grid[-1] - 1], rel=1e-7, abs=1e-7)
                else:
                    back = -(-(grid[-1] + 1 - week) // H)  # windows that end with the training weeks
                    start = len(v) - back * H
                    if start < size:
                        assert r.prediction is None
                    else:
                        assert r.prediction == pytest.approx(forecast(v[start - size:start], mid, spread)[week - grid[0] - start], rel=1e-7, abs=1e-7)
    assert all(r.used_fallback for r in out if r.label == "500_3")


def test_one_map_or_all_maps_are_the_same(spark, long):
    frame, _ = long
    both = {(r.label, r.unique_id, r.ds): r.prediction for r in linear.decomposed_grid(frame, F.lit(CUT), H, CONFIGS).collect()}
    for cfg in (CONFIGS[0], CONFIGS[3]):
        for r in linear.decomposed_grid(frame, F.lit(CUT), H, [cfg]).collect():
            assert r.prediction is None and both[r.label, r.unique_id, r.ds] is None or r.prediction == pytest.approx(both[r.label, r.unique_id, r.ds], rel=1e-8)


def test_published_grid_is_a_sweep(spark, long):
    frame, _ = long
    configs = grids.decomposed_linear()
    report = grouped.sweep_report(linear.decomposed_grid(frame, F.lit(CUT), H, configs), grids.config_table(spark, configs)).collect()
    assert {r.label for r in report} == {c["label"] for c in configs} and len(report) == 19
    assert all(r.val_wmae is not None for r in report)


def test_series_without_values_and_empty_panels(spark):
    empty = spark.createDataFrame([], LONG)
    assert linear.decomposed_grid(empty, F.lit(CUT), H, CONFIGS[:2]).collect() == []
    bare = spark.createDataFrame([("1_1", friday(i), None) for i in range(80)], LONG)
    out = linear.decomposed_grid(bare, F.lit(CUT), H, CONFIGS[:1]).collect()
    assert len(out) == 80 and all(r.prediction is None and r.used_fallback for r in out)


# covariates

X = ["promo", "price", "flat"]


@pytest.fixture(scope="module")
def panel_rows(spark):
    rng = np.random.default_rng(1)
    rows = []
    for k, start in enumerate((0, 0, 10, 80, 99)):
        for i in range(start, 130):
            promo, price = float(rng.integers(0, 2)), float(rng.normal() * 50 + 200)
            y = 100.0 * k + 20 * promo - 0.1 * price + 5 * np.sin(i / 8) + rng.normal()
            rows.append((f"{k}_1", friday(i), None if (k, i) == (0, 60) else float(y), i < 110, promo, None if i % 17 == 3 else price, 3.0))
    return spark.createDataFrame(rows, LONG + ", is_train boolean, promo double, price double, flat double"), rows


def brute(rows, length, mode, ridge, lag=52):
    """Forecasts by explicit regression on the rows of the context; no weight for a covariate that does not vary."""
    series = {}
    for u, d, y, train, *x in rows:
        series.setdefault(u, []).append((d, y, train, [v if v is not None else 0.0 for v in x]))
    inputs, goals, state = [], [], {}
    for u, items in series.items():
        end = max((d for d, _, t, _ in items if t), default=None)
        if end is None:
            continue
        ctx = [(d, y, x) for d, y, t, x in items if t and (length is None or d > end - dt.timedelta(days=7 * length)) and y is not None]
        mean, dev = np.mean([y for _, y, _ in ctx]), np.std([y for _, y, _ in ctx], ddof=1) or 1.0
        z = {d: (y - mean) / dev for d, y, _ in ctx}
        state[u] = mean, dev, z, {d: x for d, _, x in ctx}
        for d, _, x in ctx:
            inputs.append(x)
            goals.append(z[d] - z.get(d - dt.timedelta(days=7 * lag), 0.0) if mode == "base + xreg" else z[d])
    w, w0 = np.zeros(len(X)), 0.0
    if mode:
        x, g = np.array(inputs), np.array(goals)
        dev = x.std(axis=0)
        use = dev > 1e-9
        s = (x[:, use] - x[:, use].mean(axis=0)) / dev[use]
        w[use] = np.linalg.solve(s.T @ s + ridge * np.eye(use.sum()), s.T @ (g - g.mean())) / dev[use]
        w0 = g.mean() - x.mean(axis=0) @ w
    out = {}
    for u, items in series.items():
        if u not in state:
            continue
        mean, dev, z, xs = state[u]
        rest = {d: v - (w0 + np.array(xs[d]) @ w if mode == "xreg + base" else 0) for d, v in z.items()}
        for d, _, train, x in items:
            if not train:
                base = rest.get(d - dt.timedelta(days=7 * lag), rest[max(rest)])
                out[u, d] = (base + (w0 + np.array(x) @ w if mode else 0)) * dev + mean
    return out


SETTINGS = [(None, "xreg + base", 1.0), (13, "xreg + base", 5.0), (13, "base + xreg", 0.0), (60, "base + xreg", 2.0), (60, "xreg + base", 0.0), (26, None, None), (90, "base + xreg", 1.0)]


def test_covariate_grid_equals_explicit_regressions(panel_rows):
    frame, rows = panel_rows
    configs = [{"label": f"c{i}", "context_length": c, "xreg_mode": m, "ridge": r} for i, (c, m, r) in enumerate(SETTINGS)]
    out = linear.covariate_grid(frame, X, configs).filter("not is_train").collect()
    for i, setting in enumerate(SETTINGS):
        want = brute(rows, *setting)
        got = {(r.unique_id, r.ds): r.prediction for r in out if r.label == f"c{i}"}
        assert got.keys() == want.keys()
        np.testing.assert_allclose([got[k] for k in want], list(want.values()), rtol=1e-8)


def test_ridges_share_one_decomposition():
    rng = np.random.default_rng(2)
    x = np.column_stack([np.ones(50), rng.normal(size=(50, 3)) * [1, 100, 0.01], np.full(50, 7.0)])
    y = x @ [2.0, 1.0, 0.02, 30.0, 0.0] + rng.normal(size=50) * 0.1
    found = linear.ridge_path(x.T @ x, x.T @ y, [0.0, 1.0, 5.0], standard=False)
    for ridge in (1.0, 5.0):
        w = np.linalg.solve(x[:, :4].T @ x[:, :4] + np.diag([0, ridge, ridge, ridge]), x[:, :4].T @ y)
        np.testing.assert_allclose(found[ridge][:4], w, rtol=1e-7)
        assert found[ridge][4] == 0
    assert np.abs(linear.ridge_path(x.T @ x, x.T @ y, [0.0], standard=True)[0.0][1:4] - [1, 0.02, 30]).max() < 10
    assert len(grids.covariate_ridge()) == 20


def test_infinite_covariates_and_empty_panels(spark, panel_rows):
    frame, _ = panel_rows
    configs = [{"label": "c", "context_length": 30, "xreg_mode": "xreg + base", "ridge": 1.0}]
    broken = frame.withColumn("price", F.when(F.col("ds") == F.lit(friday(100)), F.lit(float("inf"))).otherwise(F.col("price")))
    assert broken.count() == linear.covariate_grid(broken, X, configs).count()
    assert linear.covariate_grid(broken, X, configs).filter("not is_train and (prediction is null or abs(prediction) > 1e6)").count() == 0
    assert linear.covariate_grid(frame.limit(0), X, configs).collect() == []
    with pytest.raises(ValueError, match="order"):
        linear.covariate_grid(frame, X, [{**configs[0], "xreg_mode": "both"}])
