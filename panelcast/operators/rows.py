"""Projections, filters and row cleaning."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalars import is_infinite, replace_infinite


def require_columns(df: DataFrame, columns: Sequence[str], what: str = "input") -> DataFrame:
    """Fail at plan time with the list of missing columns."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"{what}: expected columns missing: {missing}")
    return df


def select_columns(df: DataFrame, required: Sequence[str], optional: Sequence[str] = ()) -> DataFrame:
    """Required columns in order, then the optional ones that exist."""
    require_columns(df, required, "select_columns")
    return df.select(*required, *[c for c in optional if c in df.columns])


def booleans_to_int(df: DataFrame) -> DataFrame:
    """Every boolean column becomes 0/1."""
    flags = {f.name: F.col(f.name).cast("int") for f in df.schema if f.dataType == T.BooleanType()}
    return df.withColumns(flags) if flags else df


def to_double(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("double") for c in columns})


def dropna_any(df: DataFrame, features: Sequence[str], target: str) -> DataFrame:
    """Drop rows with a missing target or a missing value in any feature that exists."""
    return df.dropna(how="any", subset=[c for c in features if c in df.columns] + [target])


def replace_infinities(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.withColumns({c: replace_infinite(c) for c in columns})


def cap_infinities(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Plus or minus infinity becomes the largest finite value of the column (0 if none).

    The maxima are one row, read back as a broadcast; the rows themselves are not shuffled.
    """
    caps = df.agg(*[
        F.coalesce(F.max(F.when(~is_infinite(c) & ~F.isnan(c), F.col(c))), F.lit(0.0)).alias(f"_cap_{c}")
        for c in columns
    ])
    out = df.crossJoin(F.broadcast(caps))
    out = out.withColumns({c: F.when(is_infinite(c), F.col(f"_cap_{c}")).otherwise(F.col(c)) for c in columns})
    return out.select(*df.columns)


def fill_zero(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Missing becomes 0 (no markdown, unknown test feature)."""
    return df.fillna({c: 0.0 for c in columns})


def tag_origin(df: DataFrame, flag: str, value: bool) -> DataFrame:
    return df.withColumn(flag, F.lit(value))


def any_missing(columns: Sequence[str]) -> Column:
    out = F.lit(False)
    for c in columns:
        out = out | F.col(c).isNull()
    return out


def missing_coverage(df: DataFrame, columns: Sequence[str], key: str = "unique_id") -> DataFrame:
    """Per series, the number of rows that lack one of the covariates (empty when covered)."""
    return df.filter(any_missing(columns)).groupBy(key).agg(F.count("*").alias("n_missing"))


def require_coverage(df: DataFrame, columns: Sequence[str], key: str = "unique_id") -> DataFrame:
    """Run the coverage check and fail naming the first five series."""
    gaps = missing_coverage(df, columns, key)
    sample = [r[0] for r in gaps.select(key).orderBy(key).limit(5).collect()]
    if sample:
        raise ValueError(f"missing covariates for {gaps.count()} series, e.g. {sample}")
    return df
