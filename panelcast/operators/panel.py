"""Reshaping between the fact table and one row per series and week."""

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.ids import series_id, split_series_id
from .clean import dedupe_first
from .joins import join_grid_covariates
from .rows import booleans_to_int, require_columns


def to_long(
    df: DataFrame, target: bool = True, covariates: Sequence[str] = (), strict: bool = True,
) -> DataFrame:
    """(unique_id, ds[, y][, covariates]) with booleans as 0/1.

    ``strict`` raises on a missing covariate, otherwise only those present are taken.
    """
    if strict:
        require_columns(df, covariates, "to_long")
    present = [c for c in covariates if c in df.columns]
    cols = [series_id().alias("unique_id"), F.col("Date").alias("ds")]
    if target:
        cols.append(F.col("Weekly_Sales").cast("double").alias("y"))
    return booleans_to_int(df.select(*cols, *present))


def to_static(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per series with its static covariates; the earliest row wins."""
    require_columns(df, columns, "to_static")
    order = ["Date"] if "Date" in df.columns else list(columns)
    slim = df.select(series_id().alias("unique_id"), *dict.fromkeys([*columns, *order]))
    return booleans_to_int(dedupe_first(slim, ["unique_id"], order).select("unique_id", *columns))


def weekly_spine(long: DataFrame, key: str = "unique_id", date: str = "ds") -> DataFrame:
    """Every week from the first to the last of each series; new rows have missing values.

    Each row is followed by the weeks up to the next row of its series, so one shuffle by series is
    all it takes and what follows by series needs none.  Dates stand whole weeks apart.  Rows
    without a series or a date are dropped.
    """
    following = F.lead(date).over(W.partitionBy(key).orderBy(date))
    # a repeated week, and the last one, stand alone
    weeks = F.when(following > F.col(date), F.sequence(F.col(date), F.date_sub(following, 1), F.expr("interval 7 days"))).otherwise(F.array(date))
    rest = [c for c in long.columns if c not in (key, date)]
    out = long.filter(F.col(key).isNotNull() & F.col(date).isNotNull()).withColumn("_weeks", weeks)
    out = out.select(key, F.explode("_weeks").alias("_week"), F.col(date).alias("_known"), *rest)
    return out.select(key, F.col("_week").alias(date), *[F.when(F.col("_week") == F.col("_known"), F.col(c)).alias(c) for c in rest])


def interpolate_linear(spine: DataFrame, target: str = "y", key: str = "unique_id", date: str = "ds") -> DataFrame:
    """Fill gaps on a straight line between the known neighbours; both ends take the nearest."""
    w = W.partitionBy(key).orderBy(date)
    past = w.rowsBetween(W.unboundedPreceding, W.currentRow)
    future = w.rowsBetween(W.currentRow, W.unboundedFollowing)
    known_day = F.when(F.col(target).isNotNull(), F.unix_date(date))
    out = spine.withColumn("_k", known_day).withColumns({
        "_y0": F.last(target, ignorenulls=True).over(past),
        "_d0": F.last("_k", ignorenulls=True).over(past),
        "_y1": F.first(target, ignorenulls=True).over(future),
        "_d1": F.first("_k", ignorenulls=True).over(future),
    })
    share = (F.unix_date(date) - F.col("_d0")) / (F.col("_d1") - F.col("_d0"))
    line = F.col("_y0") + (F.col("_y1") - F.col("_y0")) * share
    between = F.col("_d0").isNotNull() & F.col("_d1").isNotNull() & (F.col("_d0") < F.col("_d1"))
    value = F.when(between, line).otherwise(F.coalesce("_y0", "_y1"))
    return out.withColumn(target, F.coalesce(F.col(target), value)).drop("_k", "_y0", "_d0", "_y1", "_d1")


def tail_n(df: DataFrame, n: int, by: Sequence[str] = ("Store", "Dept"), date: str = "Date") -> DataFrame:
    """Last n rows of each series."""
    w = W.partitionBy(*by).orderBy(F.desc(date))
    return df.withColumn("_rn", F.row_number().over(w)).filter(F.col("_rn") <= n).drop("_rn")


def last_date(long: DataFrame, key: str = "unique_id", date: str = "ds") -> DataFrame:
    return long.groupBy(key).agg(F.max(date).alias("last_ds"))


def future_grid(long: DataFrame, horizon: int, key: str = "unique_id", date: str = "ds") -> DataFrame:
    """The ``horizon`` weeks after each series' last one."""
    last = last_date(long, key, date)
    weeks = F.sequence(F.date_add("last_ds", 7), F.date_add("last_ds", 7 * horizon), F.expr("interval 7 days"))
    return last.select(key, F.explode(weeks).alias(date))


def future_covariates(grid: DataFrame, store_dates: DataFrame) -> DataFrame:
    """Future grid with the covariates of the series' store."""
    store, _ = split_series_id()
    return join_grid_covariates(grid, store_dates, store)


def series_context(
    long: DataFrame, length: int, covariates: Sequence[str] = (), key: str = "unique_id", date: str = "ds",
) -> DataFrame:
    """Last ``length`` values of each series, oldest first, with matching covariate arrays.

    The arrays hold at most ``length`` weeks, so the collected group is bounded.
    """
    item = F.struct(F.col(date), F.col("y").cast("float").alias("y"),
                    *[F.col(c).cast("float").alias(c) for c in covariates])
    packed = tail_n(long, length, [key], date).groupBy(key).agg(
        F.sort_array(F.collect_list(item)).alias("_rows"), F.max(date).alias("last_ds"))
    return packed.select(
        key, F.col("_rows.y").alias("context"), "last_ds",
        *[F.col(f"_rows.{c}").alias(f"hist_{c}") for c in covariates])


def covariate_sequence(
    context: DataFrame, future: DataFrame, covariates: Sequence[str], key: str = "unique_id", date: str = "ds",
) -> DataFrame:
    """History covariates followed by the future ones, one array per covariate and series."""
    item = F.struct(F.col(date), *[F.col(c).cast("float").alias(c) for c in covariates])
    ahead = future.groupBy(key).agg(F.sort_array(F.collect_list(item)).alias("_next"))
    joined = context.join(ahead, key, "left")
    return joined.select(key, "last_ds", "context", *[
        F.concat(F.col(f"hist_{c}"), F.coalesce(F.col(f"_next.{c}"), F.array().cast("array<float>"))).alias(c)
        for c in covariates])


def robust_scale(long: DataFrame, method: str = "robust", key: str = "unique_id") -> DataFrame:
    """Scale each series by median/IQR (``robust``) or mean/deviation (``standard``).

    A zero or missing spread scales by 1.  Each group is one series, bounded by its weeks.
    """
    if method == "robust":
        stats = long.groupBy(key).agg(F.percentile("y", [0.25, 0.5, 0.75]).alias("_q"))
        stats = stats.select(key, F.col("_q")[1].alias("center"), (F.col("_q")[2] - F.col("_q")[0]).alias("spread"))
    elif method == "standard":
        stats = long.groupBy(key).agg(F.avg("y").alias("center"), F.stddev_samp("y").alias("spread"))
    else:
        raise ValueError(f"unknown scaling {method!r}")
    safe = F.coalesce(F.nullif(F.col("spread"), F.lit(0.0)), F.lit(1.0))
    out = long.join(stats, key, "left").withColumn("spread", safe)
    return out.withColumn("scaled", (F.col("y") - F.col("center")) / F.col("spread"))

