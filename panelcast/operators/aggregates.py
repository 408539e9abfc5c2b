"""Profiles and summaries of panels, splits and step metrics."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import is_infinite


def _unpivot(one_row: DataFrame, columns: Sequence[str], value: str) -> DataFrame:
    return one_row.unpivot([], list(columns), "column", value)


def null_share(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Missing percentage per column, highest first; one pass over the data."""
    shares = df.agg(*[(F.avg(F.col(c).isNull().cast("int")) * 100).alias(c) for c in columns])
    return _unpivot(shares, columns, "null_pct").orderBy(F.desc("null_pct"), "column")


def infinite_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    counts = df.agg(*[F.count_if(is_infinite(c)).alias(c) for c in columns])
    return _unpivot(counts, columns, "n_infinite")


def series_length(df: DataFrame, by: Sequence[str] = ("unique_id",)) -> DataFrame:
    return df.groupBy(*by).agg(F.count("*").alias("n"))


def series_length_summary(lengths: DataFrame) -> DataFrame:
    """count, mean, std, min, quartiles and max of the lengths.

    Quartiles run on the histogram of lengths, which has at most as many rows as there are weeks.
    """
    hist = lengths.groupBy("n").agg(F.count("*").alias("freq"))
    n, f = F.col("n").cast("double"), F.col("freq")
    total, mean = F.sum(f), F.sum(n * f) / F.sum(f)
    spread = F.sqrt((F.sum(n * n * f) - F.sum(n * f) * F.sum(n * f) / total) / F.nullif(total - 1, F.lit(0)))
    q = F.percentile("n", [0.25, 0.5, 0.75], F.col("freq"))
    return hist.agg(
        total.alias("series"), mean.alias("mean_len"), spread.alias("std_len"), F.min("n").alias("min_len"),
        q[0].alias("q25"), q[1].alias("q50"), q[2].alias("q75"), F.max("n").alias("max_len"))


def short_series_counts(lengths: DataFrame, input_size: int, horizon: int) -> DataFrame:
    """Series shorter than the input window, and shorter than input plus horizon."""
    return lengths.agg(
        F.count("*").alias("series"), F.count_if(F.col("n") < input_size).alias("below_input"),
        F.count_if(F.col("n") < input_size + horizon).alias("below_input_horizon"))


def distinct_count(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.agg(*[F.count_distinct(c).alias(f"n_{c}") for c in columns])


def date_bounds(df: DataFrame, part: Column, date: str = "Date") -> DataFrame:
    return df.groupBy(part.alias("part")).agg(F.min(date).alias("first"), F.max(date).alias("last"))


def last_value_by_series(long: DataFrame, key: str = "unique_id", date: str = "ds", target: str = "y") -> DataFrame:
    """Last known (not missing) target of each series."""
    known = long.filter(F.col(target).isNotNull() & ~F.isnan(target))
    return known.groupBy(key).agg(F.max_by(target, date).alias("last_y"))


def mean_by_series(long: DataFrame, key: str = "unique_id", target: str = "y") -> DataFrame:
    return long.groupBy(key).agg(F.avg(target).alias("mean_y"))


def regime_counts(configs: DataFrame) -> DataFrame:
    return configs.groupBy("regime").agg(F.count("*").alias("n_configs"))


def failure_counts(oof: DataFrame) -> DataFrame:
    """Series that fell back, per configuration."""
    return oof.groupBy("label").agg(
        F.count_distinct(F.when(F.col("used_fallback"), F.col("unique_id"))).alias("fallback_series"))


def holiday_rows(df: DataFrame, part: Column) -> DataFrame:
    return df.groupBy(part.alias("part")).agg(
        F.count("*").alias("n_rows"), F.count_if(F.col("IsHoliday").cast("boolean")).alias("n_holiday"))


def null_lag_share(df: DataFrame, part: Column, lag: str) -> DataFrame:
    return df.groupBy(part.alias("part")).agg(F.avg(F.col(lag).isNull().cast("int")).alias("null_share"))


def step_metric_summary(steps: DataFrame) -> DataFrame:
    """Summary of a training-step metric table; all zeros for an empty table."""
    def zero(c):
        return F.coalesce(c.cast("double"), F.lit(0.0))

    return steps.agg(
        F.count("*").cast("double").alias("grad_records"),
        zero(F.avg("grad_total_norm")).alias("grad_total_norm_mean"),
        zero(F.max("grad_total_norm")).alias("grad_total_norm_max"),
        zero(F.max_by("grad_total_norm", "step")).alias("grad_total_norm_last"),
        zero(F.max("grad_max_norm")).alias("grad_max_norm_max"),
        zero(F.sum("grad_nonfinite_count")).alias("grad_nonfinite_count_sum"))
