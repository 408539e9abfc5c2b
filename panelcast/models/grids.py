"""Sweep configurations.

Fixed values: the orders, prior scales and covariate settings the model families are swept over.
Tree configurations come from a rule per capacity regime.
"""

import itertools
import json

from pyspark.sql import DataFrame, SparkSession

SEASON = 52

# (p, d, q, trend) per regime.
ARIMA_ORDERS = {
    "underfit": [(0, 1, 0, "n"), (1, 0, 0, "n"), (0, 1, 1, "n"), (1, 1, 0, "n"), (0, 0, 1, "n"), (1, 1, 1, "n")],
    "balanced": [
        (1, 1, 0, "n"), (0, 1, 1, "n"), (1, 1, 1, "n"), (2, 1, 0, "n"), (0, 1, 2, "n"), (2, 1, 1, "n"),
        (1, 1, 2, "n"), (2, 1, 2, "n"), (1, 1, 0, "c"), (0, 1, 1, "c"), (1, 1, 1, "c"), (2, 1, 0, "c"),
        (0, 1, 2, "c"), (1, 0, 1, "c"), (2, 0, 1, "c"), (1, 0, 2, "c"), (2, 1, 1, "c"), (1, 1, 2, "c"),
    ],
    "complex": [(3, 1, 1, "c"), (1, 1, 3, "c"), (3, 1, 2, "c"), (2, 1, 3, "c"), (3, 0, 3, "c"), (4, 1, 2, "c")],
}

# (p, d, q), (P, D, Q), trend per regime.
SEASONAL_ORDERS = {
    "underfit": [((1, 1, 0), (1, 0, 0), "n"), ((0, 1, 1), (0, 0, 1), "n"), ((1, 1, 0), (0, 0, 1), "n")],
    "balanced": [
        ((1, 1, 0), (1, 1, 0), "n"), ((0, 1, 1), (0, 1, 1), "n"), ((1, 1, 1), (1, 1, 0), "n"),
        ((1, 1, 1), (0, 1, 1), "n"), ((1, 1, 1), (1, 1, 1), "n"), ((2, 1, 0), (1, 1, 0), "n"),
        ((0, 1, 2), (0, 1, 1), "n"), ((2, 1, 1), (1, 1, 1), "n"), ((2, 0, 1), (1, 1, 0), "c"),
        ((1, 0, 2), (0, 1, 1), "c"),
    ],
    "complex": [((3, 1, 1), (1, 1, 1), "c"), ((1, 1, 3), (1, 1, 1), "c"), ((2, 1, 2), (1, 1, 1), "c")],
}

# (changepoint, seasonality, holidays prior scale, mode, yearly pairs, changepoint range) per regime.
ADDITIVE_PRIORS = {
    "underfit": [
        (0.001, 0.1, 1.0, "additive", 5, 0.80),
        (0.005, 0.5, 0.5, "additive", 3, 0.60),
        (0.001, 0.1, 0.1, "multiplicative", 5, 0.80),
    ],
    "balanced": [
        (0.05, 10.0, 10.0, "additive", 10, 0.80),
        (0.05, 10.0, 1.0, "additive", 20, 0.80),
        (0.05, 10.0, 1.0, "multiplicative", 20, 0.80),
        (0.10, 10.0, 10.0, "additive", 20, 0.80),
        (0.10, 5.0, 5.0, "additive", 10, 0.90),
        (0.10, 5.0, 5.0, "multiplicative", 10, 0.90),
        (0.03, 15.0, 15.0, "additive", 15, 0.85),
        (0.05, 20.0, 20.0, "additive", 10, 0.80),
        (0.20, 10.0, 10.0, "additive", 20, 0.90),
    ],
    "overfit": [
        (0.50, 100.0, 100.0, "additive", 25, 0.95),
        (0.50, 100.0, 100.0, "multiplicative", 25, 0.95),
        (1.00, 200.0, 200.0, "additive", 30, 0.98),
    ],
}

# (context length, covariate order or None, ridge or None) per regime.
COVARIATE_SETTINGS = {
    "zero_shot": [(13, None, None), (26, None, None), (52, None, None), (78, None, None), (104, None, None), (130, None, None)],
    "covariates": [
        (52, "xreg + base", 5.0), (52, "xreg + base", 1.0), (78, "xreg + base", 1.0), (78, "base + xreg", 1.0),
        (104, "xreg + base", 1.0), (104, "base + xreg", 5.0), (130, "xreg + base", 5.0), (130, "base + xreg", 1.0),
    ],
    "unregularized_xreg": [
        (130, "xreg + base", 0.0), (156, "xreg + base", 0.0), (182, "xreg + base", 0.0),
        (130, "base + xreg", 0.0), (156, "base + xreg", 0.0), (182, "base + xreg", 0.0),
    ],
}

# Tree regimes: trees, depth and learning rate are crossed; smallest leaf and row share are set.
TREE_REGIMES = {
    "small": {"n_estimators": [10, 20], "max_depth": [1, 2, 3], "learning_rate": [0.3],
                     "min_child_samples": [50], "subsample": [1.0]},
    "medium": {"n_estimators": [50, 100], "max_depth": [4, 5, 6], "learning_rate": [0.05, 0.1],
                     "min_child_samples": [5], "subsample": [0.8]},
    "large": {"n_estimators": [200], "max_depth": [8, 9, 10], "learning_rate": [0.01, 0.02],
                      "min_child_samples": [1], "subsample": [0.9]},
}

# (input weeks, moving-average weeks) of the decomposed linear map; (input weeks, harmonics, polynomials).
# Keyed by number: rows that differ in training steps alone are one configuration, under the number of the first.
LINEAR_WINDOWS = {
    "underfit": {1: (13, 5), 3: (26, 9), 5: (13, 9), 6: (26, 5)},
    "balanced": {1: (52, 13), 3: (52, 25), 6: (52, 39), 7: (78, 13), 8: (78, 25), 10: (78, 39), 11: (104, 25), 13: (104, 39), 14: (104, 51)},
    "overfit": {1: (130, 51), 2: (130, 77), 3: (156, 51), 4: (156, 77), 5: (182, 51), 6: (182, 77)},
}
BASIS_SIZES = {
    "underfit": {5: (13, 2, 2), 6: (26, 2, 2)},
    "balanced": {7: (52, 2, 2), 9: (52, 4, 3), 10: (78, 4, 3), 11: (78, 2, 2), 16: (104, 4, 3)},
    "overfit": {3: (156, 8, 5), 6: (182, 8, 5)},
}


def _label(grid: dict, make) -> list[dict]:
    return [
        {"label": f"{regime}_{i}", "regime": regime, **make(row)}
        for regime, rows in grid.items() for i, row in (rows.items() if isinstance(rows, dict) else enumerate(rows, 1))]


def arima() -> list[dict]:
    return _label(ARIMA_ORDERS, lambda r: {"order": list(r[:3]), "trend": r[3]})


def seasonal_arima() -> list[dict]:
    return _label(SEASONAL_ORDERS, lambda r: {
        "order": list(r[0]), "seasonal_order": [*r[1], SEASON], "trend": r[2]})


def additive() -> list[dict]:
    names = ("changepoint_prior_scale", "seasonality_prior_scale", "holidays_prior_scale",
             "seasonality_mode", "yearly_seasonality", "changepoint_range")
    return _label(ADDITIVE_PRIORS, lambda r: dict(zip(names, r)))


def covariate_ridge() -> list[dict]:
    return _label(COVARIATE_SETTINGS, lambda r: {"context_length": r[0], "xreg_mode": r[1], "ridge": r[2]})


def decomposed_linear() -> list[dict]:
    return _label(LINEAR_WINDOWS, lambda r: {"input_size": r[0], "moving_avg_window": r[1]})


def basis() -> list[dict]:
    return _label(BASIS_SIZES, lambda r: {"input_size": r[0], "n_harmonics": r[1], "n_polynomials": r[2]})


def trees() -> list[dict]:
    grids = {
        regime: [dict(zip(spec, values)) for values in itertools.product(*spec.values())]
        for regime, spec in TREE_REGIMES.items()}
    return _label(grids, lambda r: r)


FAMILIES = {
    "ARIMA": arima, "SARIMA": seasonal_arima, "Additive": additive, "CovariateRidge": covariate_ridge,
    "DecomposedLinear": decomposed_linear, "Basis": basis, "Trees": trees,
}


def config_table(spark: SparkSession, configs: list[dict]) -> DataFrame:
    """(label, regime, params): parameters as JSON."""
    rows = [
        (c["label"], c["regime"], json.dumps({k: v for k, v in c.items() if k not in ("label", "regime")}))
        for c in configs]
    return spark.createDataFrame(rows, "label string, regime string, params string")


def pick(configs: list[dict], *labels: str) -> list[dict]:
    return [c for c in configs if c["label"] in labels]
