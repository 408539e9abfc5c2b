"""Per-series models: every configuration on every series in one Spark job.

A series is packed into one row of arrays (its weeks, so the row is bounded by the calendar).
Series are spread over the tasks by one shuffle and fitted in Arrow batches with every configuration
of the list in turn; only forecasts or coefficients leave the task.
"""

import json
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.calendar import holiday_code
from ..operators.metrics import run_report
from ..operators.panel import interpolate_linear, weekly_spine
from . import arma, solvers

MIN_TRAIN = 52

FITTED = "label string, unique_id string, ds date, IsHoliday boolean, is_train boolean, y double, prediction double, used_fallback boolean"
STORED = "label string, unique_id string, coefs array<double>, status string"
FORECAST = "unique_id string, ds date, prediction double"


def task_count(df: DataFrame) -> int:
    """Fits are CPU-bound and rows tiny, so the spread follows cores, not bytes."""
    spark = df.sparkSession
    return max(2 * spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))


def pack_series(long: DataFrame, cutoff: Column | None = None) -> DataFrame:
    """One row per series: train_* and valid_* arrays of day, value, holiday code, oldest first.

    ``long`` is (unique_id, ds, y); the repartition by series is the only shuffle.
    """
    past = F.lit(True) if cutoff is None else F.col("ds") < cutoff
    rows = long.select("unique_id", F.struct(
        F.unix_date("ds").alias("day"), F.col("y").cast("double").alias("y"),
        F.expr(holiday_code("ds")).alias("holiday"), past.alias("past")).alias("r"))
    packed = rows.repartition(task_count(long), "unique_id").groupBy("unique_id").agg(
        F.sort_array(F.collect_list("r")).alias("rows"))
    train = F.filter("rows", lambda r: r["past"])
    valid = F.filter("rows", lambda r: ~r["past"])
    split = packed.select("unique_id", train.alias("train"), valid.alias("valid"))
    return split.select("unique_id", *[
        F.col(f"{part}.{c}").alias(f"{part}_{c}") for part in ("train", "valid") for c in ("day", "y", "holiday")])


def arrays(row, part: str) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    days, y, hol = (np.asarray(getattr(row, f"{part}_{c}"), dtype=float) for c in ("day", "y", "holiday"))
    return days, y, hol


RECURSIVE = ("ARIMA", "SARIMA")


def fit_series(family: str, cfg: dict, series: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> list[np.ndarray | None]:
    """Coefficients of each (days, y, holidays); None where the fit fails."""
    if family in RECURSIVE:
        found = arma.fit_many([y for _, y, _ in series], cfg)
    else:
        found = []
        for days, y, holidays in series:
            try:
                found.append(solvers.additive_fit(days, y, holidays, cfg) if family == "Additive"
                             else solvers.basis_fit(days[-cfg["input_size"]:], y[-cfg["input_size"]:], cfg))
            except (ValueError, np.linalg.LinAlgError):
                found.append(None)
    return [w if w is not None and np.isfinite(w).all() else None for w in found]


def forecast_series(family, cfg, coefs, days, y, ahead_days, ahead_holidays) -> np.ndarray:
    if len(ahead_days) == 0:
        return np.empty(0)
    if family in RECURSIVE:
        steps = ((ahead_days - days[-1]) / 7).round().astype(int)
        return solvers.arma_forecast(y, coefs, cfg, int(steps.max()))[steps - 1]
    if family == "Additive":
        return solvers.additive_predict(ahead_days, ahead_holidays, coefs, cfg)
    return solvers.basis_predict(ahead_days, coefs, cfg)


def fitted_series(family, cfg, coefs, days, y, holidays) -> np.ndarray:
    if family in RECURSIVE:
        return solvers.arma_fitted(y, coefs, cfg)
    if family == "Additive":
        return solvers.additive_predict(days, holidays, coefs, cfg)
    out = solvers.basis_predict(days, coefs, cfg)
    out[:-cfg["input_size"]] = np.nan  # the fit has not seen these weeks
    return out


def on_weekly_grid(days: np.ndarray, y: np.ndarray) -> np.ndarray:
    """The history of a recursive model, gap weeks filled on a straight line."""
    grid = np.arange(days[0], days[-1] + 1, 7)
    known = np.isfinite(y)
    return np.interp(grid, days[known], y[known])


class _Series:
    """One packed row and what every configuration needs of it."""

    def __init__(self, row, recursive: bool):
        self.id = row.unique_id
        self.days, self.y, self.hol = arrays(row, "train")
        self.ahead, self.actual, self.ahead_hol = arrays(row, "valid")
        seen = np.isfinite(self.y)
        self.known = self.y[seen]
        if recursive:
            grid = np.arange(self.days[0], self.days[-1] + 1, 7) if self.known.size else self.days[:0]
            self.fit_on = grid, on_weekly_grid(self.days, self.y) if self.known.size else self.known, self.hol
        else:
            self.fit_on = self.days[seen], self.known, self.hol[seen]

    def scored(self, family: str, cfg: dict, label: str, coefs: np.ndarray | None) -> dict[str, np.ndarray]:
        """Rows of this series: fitted and forecast values, or its last value as forecast."""
        fitted, failed = np.full(len(self.y), np.nan), True
        forecast = np.full(len(self.ahead), self.known[-1] if self.known.size else np.nan)
        if coefs is not None:
            fit_days, fit_y, _ = self.fit_on
            values = forecast_series(family, cfg, coefs, fit_days, fit_y, self.ahead, self.ahead_hol)
            plausible = solvers.is_plausible(values, self.known)
            if plausible:
                forecast, failed = values, False
            if family in RECURSIVE:
                inside = fitted_series(family, cfg, coefs, fit_days, fit_y, self.hol)
                fitted = inside[((self.days - self.days[0]) / 7).astype(int)]
            elif plausible:
                fitted = fitted_series(family, cfg, coefs, self.days, self.y, self.hol)
        n = len(self.days) + len(self.ahead)
        return {
            "label": np.full(n, label, object), "unique_id": np.full(n, self.id, object),
            "ds": np.concatenate([self.days, self.ahead]), "IsHoliday": np.concatenate([self.hol, self.ahead_hol]) > 0,
            "is_train": np.arange(n) < len(self.days), "y": np.concatenate([self.y, self.actual]),
            "prediction": np.concatenate([fitted, forecast]), "used_fallback": np.full(n, failed),
        }


def _sweep(family: str, configs: list[tuple[str, dict]], rows, min_train: int) -> Iterator[dict[str, np.ndarray]]:
    """Every configuration on the series of one batch."""
    series = [_Series(row, family in RECURSIVE) for row in rows]
    able = [i for i, s in enumerate(series) if len(s.y) >= min_train and s.known.size]
    for label, cfg in configs:
        with np.errstate(all="ignore"):
            found = dict(zip(able, fit_series(family, cfg, [series[i].fit_on for i in able])))
            for i, s in enumerate(series):
                yield s.scored(family, cfg, label, found.get(i))


def frames(parts: Iterator[dict], rows: int = 20_000) -> Iterator[pd.DataFrame]:
    """Join the columns of many fits into frames of a few thousand rows."""
    held, size = [], 0

    def frame():
        out = pd.DataFrame({c: np.concatenate([h[c] for h in held]) for c in held[0]})
        return out.assign(ds=pd.to_datetime(out["ds"], unit="D"))

    for part in parts:
        held.append(part)
        size += len(part["ds"])
        if size >= rows:
            yield frame()
            held, size = [], 0
    if held:
        yield frame()


def null_missing(out: DataFrame) -> DataFrame:
    return out.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in ("y", "prediction") if c in out.columns})


def sweep_fit(
    long: DataFrame, cutoff: Column, family: str, configs: DataFrame, min_train: int = MIN_TRAIN
) -> DataFrame:
    """Out-of-fold and fitted rows of every (configuration, series) pair.

    A series that is too short or fails to fit forecasts its last value and is flagged.
    """
    # the configurations are a literal list: each task holds them and reads a series once
    listed = [(r.label, json.loads(r.params)) for r in configs.select("label", "params").collect()]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        return frames(part for batch in batches for part in _sweep(family, listed, batch.itertuples(index=False), min_train))

    return null_missing(pack_series(long, cutoff).mapInPandas(run, FITTED))


def _origins(row, step: int, horizon: int, min_train: int) -> Iterator[dict[str, np.ndarray]]:
    """Forecasts of one packed series from every cutoff, the sums of a prefix being those at its end."""
    days, y, _ = arrays(row, "train")
    week = ((days - days[0]) / 7).astype(int)
    seen = np.isfinite(y)
    value = np.full(week[-1] + 1, np.nan)
    value[week[seen]] = y[seen]
    x, known = np.arange(len(value), dtype=float), np.isfinite(value)
    v = np.where(known, value, 0.0)
    pair = np.r_[False, known[1:] & known[:-1]]
    before = np.r_[0.0, v[:-1]]
    sums = {k: np.cumsum(a) for k, a in (("n", known * 1.0), ("x", x * known), ("y", v), ("xx", x * x * known), ("xy", x * v),
                                         ("vv", before * v * pair), ("bb", before * before * pair))}
    last = np.maximum.accumulate(np.where(known, np.arange(len(value)), -1))
    for cutoff in range(step, len(value), step):
        n, sx, sy, sxx, sxy, vv, bb = (float(sums[k][cutoff - 1]) for k in ("n", "x", "y", "xx", "xy", "vv", "bb"))
        ahead = np.flatnonzero((week >= cutoff) & (week < cutoff + horizon))
        if n < min_train or not len(ahead):
            continue
        at, end = week[ahead], last[cutoff - 1]
        spread = n * sxx - sx * sx
        slope = (n * sxy - sx * sy) / spread if spread else 0.0
        values = {"trend": (sy - slope * sx) / n + slope * at, "ar1": v[end] * (vv / bb if bb else 0.0) ** (at - end)}
        for label, prediction in values.items():
            yield {"label": np.full(len(at), label, object), "unique_id": np.full(len(at), row.unique_id, object),
                   "cutoff": np.full(len(at), days[0] + 7 * cutoff), "ds": days[ahead], "y": y[ahead], "prediction": prediction}


def rolling_origin(long: DataFrame, step: int, horizon: int, min_train: int = MIN_TRAIN) -> DataFrame:
    """(label, unique_id, cutoff, ds, y, prediction): every series forecast from cutoffs ``step`` weeks apart.

    A straight line and a first-order autoregression are fitted to what lies before each cutoff, from
    sums that grow along the series, so all cutoffs cost one walk over a packed row.  Only known weeks
    count and no gap is filled, since a filled gap would see what comes after it; the autoregression
    uses neighbouring known weeks.  Prefixes with fewer than ``min_train`` known weeks give no rows.
    """
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for out in frames(part for batch in batches for row in batch.itertuples(index=False) for part in _origins(row, step, horizon, min_train)):
            yield out.assign(cutoff=pd.to_datetime(out["cutoff"], unit="D"))

    return null_missing(pack_series(long).mapInPandas(run, "label string, unique_id string, cutoff date, ds date, y double, prediction double"))


def css_profile(long: DataFrame, config: dict, coefs: list[list[float]]) -> DataFrame:
    """(unique_id, coefs, n, rmse): size of the one-step errors of every series at each of the given coefficients.

    Gap weeks are filled on a straight line; a series too short for the differences gives no rows.
    """
    reach = arma.Orders(config).reach + arma.Orders(config).d + arma.Orders(config).sd * arma.Orders(config).period

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for row in batch.itertuples(index=False):
                days, y, _ = arrays(row, "train")
                if not np.isfinite(y).any() or (days[-1] - days[0]) / 7 + 1 <= reach:
                    continue
                n, sums = arma.css(on_weekly_grid(days, y), coefs, config)
                out += [(row.unique_id, list(map(float, c)), n, float(np.sqrt(v / n))) for c, v in zip(coefs, sums)]
            yield pd.DataFrame(out, columns=["unique_id", "coefs", "n", "rmse"])

    return pack_series(long).mapInPandas(run, "unique_id string, coefs array<double>, n int, rmse double")


def sweep_report(fits: DataFrame, configs: DataFrame) -> DataFrame:
    """Ledger rows: errors, gap, status and number of fallback series per configuration."""
    return configs.select("label", "regime", "params").join(run_report(fits), "label", "left")


def final_refit(long: DataFrame, family: str, config: dict) -> DataFrame:
    """The chosen configuration on the whole history of every series -> model table rows.

    Weeks are densified and interpolated first; failures are kept with their status.
    """
    full = interpolate_linear(weekly_spine(long))
    label = config["label"]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            with np.errstate(all="ignore"):
                found = fit_series(family, config, [arrays(row, "train") for row in batch.itertuples(index=False)])
            yield pd.DataFrame({
                "label": label, "unique_id": batch["unique_id"], "coefs": [None if w is None else list(map(float, w)) for w in found],
                "status": ["failed" if w is None else "fitted" for w in found]})

    return pack_series(full).mapInPandas(run, STORED)


def forecast_models(models: DataFrame, long: DataFrame, family: str, config: dict, horizon: int) -> DataFrame:
    """Forecasts of stored coefficients for the ``horizon`` weeks after each series' end.

    Series without coefficients, and implausible forecasts, give no rows; fallbacks apply later.
    """
    history = pack_series(interpolate_linear(weekly_spine(long)))
    last_day = F.element_at("train_day", -1)
    days = F.sequence(last_day + 7, last_day + 7 * horizon, F.lit(7))
    jobs = history.join(models.select("unique_id", "coefs"), "unique_id").filter("coefs is not null")
    jobs = jobs.withColumn("ahead", days).withColumn(
        "ahead_holiday", F.expr(f"transform(ahead, d -> {holiday_code('date_from_unix_date(d)')})"))

    def ahead(row) -> dict[str, np.ndarray] | None:
        past, y, _ = arrays(row, "train")
        days = np.asarray(row.ahead, dtype=float)
        with np.errstate(all="ignore"):
            values = forecast_series(family, config, np.asarray(row.coefs, dtype=float), past, y, days, np.asarray(row.ahead_holiday, dtype=float))
        return {"unique_id": np.full(len(days), row.unique_id, object), "ds": days, "prediction": values} if solvers.is_plausible(values, y) else None

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        return frames(part for batch in batches for part in map(ahead, batch.itertuples(index=False)) if part is not None)

    return jobs.mapInPandas(run, FORECAST)
