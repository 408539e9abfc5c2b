"""Linear forecasters pooled over all series, whole grids from one scan.

Each task folds its series into sums of products of fixed size, Spark adds them up, and every
configuration of a grid is solved from the same sums.  The sums depend on the window, the horizon
and the covariates, never on the number of rows, so they and the solved maps may pass the driver.
"""

from collections.abc import Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.staging import write_once
from .grouped import FITTED, arrays, frames, null_missing, on_weekly_grid, pack_series, task_count

SUMS = "part string, i int, row array<double>"


def total(partial: DataFrame) -> dict[str, np.ndarray]:
    """Matrices by name, summed over all tasks; ``partial`` is (part, i, row), one row of one task's matrix each."""
    def add(key: tuple, pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"part": [key[0]], "i": [key[1]], "row": [np.sum(np.vstack(pdf["row"].to_numpy()), axis=0)]})

    out: dict[str, dict[int, np.ndarray]] = {}
    for r in partial.groupBy("part", "i").applyInPandas(add, SUMS).toLocalIterator():
        out.setdefault(r.part, {})[r.i] = np.array(r.row)
    return {k: np.vstack([v[i] for i in sorted(v)]) for k, v in out.items()}


def _emit(sums: dict[str, np.ndarray]) -> pd.DataFrame:
    rows = [(name, i, row) for name, m in sums.items() for i, row in enumerate(m)]
    return pd.DataFrame(rows, columns=["part", "i", "row"])


# the decomposed linear map

def scaled_series(row) -> tuple[np.ndarray, np.ndarray, float, float] | None:
    """(days, values, center, spread) of the training weeks: gaps filled on a straight line, scaled by median and IQR."""
    days, y, _ = arrays(row, "train")
    if not np.isfinite(y).any():
        return None
    filled = on_weekly_grid(days, y)
    low, center, high = np.percentile(filled, [25, 50, 75])
    spread = float(high - low) or 1.0
    return np.arange(days[0], days[-1] + 1, 7), (filled - center) / spread, float(center), spread


def lag_products(values: np.ndarray, sizes: list[int], horizon: int) -> Iterator[tuple[int, np.ndarray]]:
    """(size, sums of products) of the windows of one series, by how many weeks stand before them.

    A window belongs to the largest of ``sizes`` that fits before it.  Columns are 1, the weeks of
    that size, latest first, and the weeks ahead; rows are the columns without those ahead.
    """
    last = len(values) - horizon  # windows end before this place
    for size, following in zip(sizes, [*sizes[1:], None]):
        ends = np.arange(size, min(last, following - 1 if following else last) + 1)
        if not len(ends):
            continue
        wide = np.lib.stride_tricks.sliding_window_view(values, size + horizon)[ends - size]
        u = np.hstack([np.ones((len(ends), 1)), wide[:, size - 1::-1], wide[:, size:]])
        yield size, u[:, :size + 1].T @ u


def smoother(size: int, width: int) -> np.ndarray:
    """Centred moving average of ``width`` within a window of ``size`` weeks; the first and last week repeat beyond it."""
    left = (width - 1) // 2
    out = np.zeros((size, size))
    for j in range(size):
        np.add.at(out[j], np.clip(np.arange(j - left, j - left + width), 0, size - 1), 1.0 / width)
    return out


def solve_grid(sums: dict[int, np.ndarray], configs: Sequence[dict], horizon: int, ridge: float) -> dict[str, tuple[np.ndarray, np.ndarray]]:
    """(intercepts, map) of every configuration, the map from the scaled weeks of a window (oldest first) to the weeks ahead.

    Trend and remainder of a window are linear in its weeks, so their sums of products follow from
    those of the weeks; a shorter input takes part of every longer one.  ``ridge`` is relative to the
    mean of the diagonal.
    """
    out = {}
    for cfg in configs:
        size, width = cfg["input_size"], cfg["moving_avg_window"]
        gram, cross = np.zeros((size + 1, size + 1)), np.zeros((size + 1, horizon))
        for longest, m in sums.items():
            if longest >= size:
                gram += m[:size + 1, :size + 1]
                cross += m[:size + 1, longest + 1:]
        n = gram[0, 0]
        if n < 1:
            continue
        mean_x, mean_y = gram[0, 1:] / n, cross[0] / n
        inner, outer = gram[1:, 1:] - n * np.outer(mean_x, mean_x), cross[1:] - n * np.outer(mean_x, mean_y)
        trend = smoother(size, width)[::-1, ::-1]  # the sums have the latest week first
        parts = np.vstack([trend, np.eye(size) - trend])
        square = parts @ inner @ parts.T
        square += ridge * max(np.trace(square) / len(square), 1e-12) * np.eye(len(square))
        weights = parts.T @ np.linalg.lstsq(square, parts @ outer, rcond=1e-13)[0]
        out[cfg["label"]] = mean_y - mean_x @ weights, weights[::-1]
    return out


def decomposed_grid(long: DataFrame, cutoff: Column, horizon: int, configs: Sequence[dict], ridge: float = 1e-3) -> DataFrame:
    """Fitted and held-out rows of every configuration of the decomposed linear map, as a sweep has them.

    One map a configuration from the last ``input_size`` weeks to the next ``horizon``, pooled over
    series that are scaled by median and IQR; the trend is a centred moving average inside the
    window.  Series are packed by one shuffle and read twice, for the sums and for the forecasts.
    Fitted values are forecasts from cutoffs ``horizon`` weeks apart.  A series shorter than the input
    repeats its last value and is flagged; weeks that the map cannot reach have no value.
    """
    packed = write_once(pack_series(long, cutoff), "packed")
    sizes = sorted({c["input_size"] for c in configs})

    def fold(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for row in batch.itertuples(index=False):
                series = scaled_series(row) if len(row.train_day) else None
                for size, m in lag_products(series[1], sizes, horizon) if series else ():
                    sums[str(size)] = sums.get(str(size), 0) + m
        yield _emit(sums)

    sums = {int(k): m for k, m in total(packed.mapInPandas(fold, SUMS)).items()}
    maps = solve_grid(sums, configs, horizon, ridge)
    inputs = {c["label"]: c["input_size"] for c in configs}

    def score(row) -> Iterator[dict[str, np.ndarray]]:
        days, y, hol = arrays(row, "train")
        ahead, actual, ahead_hol = arrays(row, "valid")
        series = scaled_series(row) if len(days) else None
        n = len(days) + len(ahead)
        for label, size in inputs.items():
            prediction, failed = np.full(n, np.nan), True
            if series:
                grid, values, center, spread = series
                prediction[len(days):] = y[np.isfinite(y)][-1]
                if label in maps and len(values) >= size:
                    intercepts, weights = maps[label]
                    inside = np.full(len(values), np.nan)
                    for start in range(len(values) - horizon, size - 1, -horizon):
                        inside[start:start + horizon] = intercepts + values[start - size:start] @ weights
                    step = ((ahead - grid[-1]) / 7).astype(int) - 1
                    reached = (step >= 0) & (step < horizon)
                    following = (intercepts + values[-size:] @ weights)[np.clip(step, 0, horizon - 1)]
                    prediction[:len(days)] = inside[((days - grid[0]) / 7).astype(int)] * spread + center
                    prediction[len(days):] = np.where(reached, following * spread + center, np.nan)
                    failed = False
            yield {"label": np.full(n, label, object), "unique_id": np.full(n, row.unique_id, object), "ds": np.concatenate([days, ahead]),
                   "IsHoliday": np.concatenate([hol, ahead_hol]) > 0, "is_train": np.arange(n) < len(days), "y": np.concatenate([y, actual]),
                   "prediction": prediction, "used_fallback": np.full(n, failed)}

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        return frames(part for batch in batches for row in batch.itertuples(index=False) for part in score(row))

    return null_missing(packed.mapInPandas(run, FITTED))


def decomposed_linear(
    long: DataFrame, cutoff: Column, horizon: int, input_size: int = 52, moving_avg: int = 13, ridge: float = 1e-3,
) -> DataFrame:
    """Forecasts of one configuration for the ``horizon`` weeks after each series' last: (unique_id, ds, prediction)."""
    past = long.filter(F.col("ds") < cutoff).select("unique_id", "ds", "y")
    weeks = F.explode(F.sequence(F.date_add("last", 7), F.date_add("last", 7 * horizon), F.expr("interval 7 days")))
    ahead = past.where("y is not null").groupBy("unique_id").agg(F.max("ds").alias("last")).select(
        "unique_id", weeks.alias("ds"), F.lit(None).cast("double").alias("y"), F.lit(False).alias("past"))
    both = past.withColumn("past", F.lit(True)).union(ahead)
    config = {"label": "one", "input_size": input_size, "moving_avg_window": moving_avg}
    out = decomposed_grid(both, F.when(F.col("past"), F.date_add("ds", 1)).otherwise(F.col("ds")), horizon, [config], ridge)
    return out.filter(~F.col("is_train")).select("unique_id", "ds", "prediction")


# a base forecast with covariates

def pack_covariates(rows: DataFrame, covariates: Sequence[str]) -> DataFrame:
    """One row a series: days, values, training marks and a flat array of covariates, oldest week first."""
    given = [F.col(c).cast("double") for c in covariates]
    x = F.array(*[F.when(c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")), 0.0).otherwise(c) for c in given])
    item = F.struct(F.unix_date("ds").alias("day"), F.col("is_train").alias("past"), F.col("y").cast("double").alias("y"), x.alias("x"))
    packed = rows.select("unique_id", item.alias("r")).repartition(task_count(rows), "unique_id").groupBy("unique_id").agg(
        F.sort_array(F.collect_list("r")).alias("rows"))
    return packed.select("unique_id", F.col("rows.day").alias("day"), F.col("rows.past").alias("past"),
                         F.col("rows.y").alias("y"), F.flatten("rows.x").alias("x"))


class _Context:
    """The last ``weeks`` training weeks of a series, standardised on their own mean and deviation."""

    def __init__(self, row, n_x: int, weeks: int | None, base_weeks: int):
        self.day = np.asarray(row.day, float)
        self.past = np.asarray(row.past, bool)
        self.y = np.asarray(row.y, float)
        self.x = np.asarray(row.x, float).reshape(len(self.day), n_x)
        end = self.day[self.past].max(initial=-np.inf)
        self.inside = self.past & (self.day > end - 7 * weeks) if weeks else self.past
        self.known = self.inside & np.isfinite(self.y)
        seen = self.y[self.known]
        self.mean = float(seen.mean()) if len(seen) else np.nan
        self.dev = float(seen.std(ddof=1)) if len(seen) > 1 else 0.0
        self.dev = self.dev or 1.0
        self.z = np.where(self.known, (self.y - self.mean) / self.dev, np.nan)
        self.lag = 7 * base_weeks

    def base(self, values: np.ndarray) -> np.ndarray:
        """Same week a year before, if the context has it; ahead of the context else its last value, before its end else 0."""
        at = np.searchsorted(self.day, self.day - self.lag)
        same = np.full(len(values), np.nan)
        hit = (at < len(values)) & (self.day[np.minimum(at, len(values) - 1)] == self.day - self.lag)
        same[hit] = values[at[hit]]
        seen = values[np.isfinite(values)]
        rest = np.where(self.past, 0.0, seen[-1] if len(seen) else 0.0)
        return np.where(np.isfinite(same), same, rest)

    def target(self, order: str) -> np.ndarray:
        return self.z - self.base(self.z) if order == "base + xreg" else self.z


def ridge_path(gram: np.ndarray, moment: np.ndarray, ridges: Sequence[float], standard: bool) -> dict[float, np.ndarray]:
    """[intercept, weights...] for every ridge from one eigendecomposition.

    ``gram`` and ``moment`` have the intercept first.  With ``standard`` the penalty counts for
    covariates divided by their deviation, else for the covariates as they are.  A covariate that
    does not vary has no weight; directions without variation have none at a ridge of 0.
    """
    n = gram[0, 0]
    mean_x, mean_y = gram[0, 1:] / n, moment[0] / n
    inner, outer = gram[1:, 1:] - n * np.outer(mean_x, mean_x), moment[1:] - moment[0] * mean_x
    size = np.sqrt(np.maximum(np.diag(inner), 0) / n)
    varies = size > 1e-9 * np.sqrt(np.maximum(np.diag(gram)[1:] / n, 1e-300))
    unit = np.where(varies, size, np.inf) if standard else np.where(varies, 1.0, np.inf)
    values, vectors = np.linalg.eigh(inner / np.outer(unit, unit))
    turned = vectors.T @ (outer / unit)
    out = {}
    for ridge in ridges:
        bottom = values + ridge
        good = bottom > 1e-10 * max(values.max(initial=0), 1e-300)
        w = vectors[:, good] @ (turned[good] / bottom[good]) / unit
        out[ridge] = np.r_[mean_y - mean_x @ w, w]
    return out


def covariate_grid(
    rows: DataFrame, covariates: Sequence[str], configs: Sequence[dict], weeks: int = 52, standard: bool = True,
) -> DataFrame:
    """(label, unique_id, ds, is_train, y, prediction) of every configuration: a seasonal base with a pooled ridge on covariates.

    ``rows`` is (unique_id, ds, y, is_train, covariates...); a missing or infinite covariate reads 0.  A
    configuration has ``context_length`` (weeks before the end of a series' training that count, None
    for all), ``xreg_mode`` and ``ridge``.  ``xreg + base`` regresses the series and forecasts the
    residual with the base; ``base + xreg`` forecasts with the base and regresses what it leaves;
    None is the base alone.  Series are standardised on their context.  One scan gives the sums of
    products of every context and order; each pair is decomposed once for all its ridges.  A series
    without a known value has no prediction; nor has a week before the context.
    """
    n_x = len(covariates)
    packed = write_once(pack_covariates(rows, covariates), "packed")
    wanted = sorted({(c["context_length"] or 0, c["xreg_mode"]) for c in configs if c["xreg_mode"]})
    for _, order in wanted:
        if order not in ("xreg + base", "base + xreg"):
            raise ValueError(f"unknown order {order!r}")

    def fold(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums = {f"{c}|{order}": np.zeros((n_x + 1, n_x + 2)) for c, order in wanted}
        for batch in batches:
            for row in batch.itertuples(index=False):
                for length in {c for c, _ in wanted}:
                    ctx = _Context(row, n_x, length or None, weeks)
                    for order in (o for c, o in wanted if c == length):
                        goal = ctx.target(order)
                        use = ctx.inside & np.isfinite(goal)
                        x = np.column_stack([np.ones(use.sum()), ctx.x[use]])
                        sums[f"{length}|{order}"] += x.T @ np.column_stack([x, goal[use]])
        yield _emit(sums)

    sums = total(packed.mapInPandas(fold, SUMS)) if wanted else {}
    models = {}
    for key, m in sums.items():
        length, order = key.split("|")
        ridges = sorted({c["ridge"] for c in configs if c["xreg_mode"] == order and (c["context_length"] or 0) == int(length)})
        if m[0, 0] >= 1:
            for ridge, w in ridge_path(m[:, :-1], m[:, -1], ridges, standard).items():
                models[int(length), order, ridge] = w

    listed = [(c["label"], c["context_length"], c["xreg_mode"], c["ridge"]) for c in configs]

    def score(row) -> Iterator[dict[str, np.ndarray]]:
        for label, length, order, ridge in listed:
            ctx = _Context(row, n_x, length, weeks)
            if order is None:
                value = ctx.base(ctx.z)
            else:
                w = models.get((length or 0, order, ridge))
                reg = ctx.x @ w[1:] + w[0] if w is not None else np.zeros(len(ctx.day))
                value = reg + (ctx.base(ctx.z) if order == "base + xreg" else ctx.base(ctx.z - reg))
            value = np.where(ctx.inside | ~ctx.past, value * ctx.dev + ctx.mean, np.nan)
            n = len(ctx.day)
            yield {"label": np.full(n, label, object), "unique_id": np.full(n, row.unique_id, object), "ds": ctx.day,
                   "is_train": ctx.past, "y": ctx.y, "prediction": value}

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        return frames(part for batch in batches for row in batch.itertuples(index=False) for part in score(row))

    return null_missing(packed.mapInPandas(run, "label string, unique_id string, ds date, is_train boolean, y double, prediction double"))


def covariate_ridge(
    rows: DataFrame, covariates: Sequence[str], order: str = "xreg + base", ridge: float = 1.0, weeks: int = 52,
) -> DataFrame:
    """One configuration over the whole training history, the penalty on the covariates as they are."""
    config = {"label": "one", "context_length": None, "xreg_mode": order, "ridge": ridge}
    return covariate_grid(rows, covariates, [config], weeks, standard=False).drop("label")

