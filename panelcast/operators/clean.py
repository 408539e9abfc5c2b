"""Missing values, calendar features and the shared feature frame."""

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .. import schemas
from ..functions import calendar as cal
from ..functions.scalars import encode_holiday, one_hot
from .rows import fill_zero


def ffill_bfill(
    df: DataFrame,
    columns: Sequence[str],
    by: Sequence[str] = ("Store",),
    order: Sequence[str] = ("Date",),
) -> DataFrame:
    """Forward fill, then backward fill, inside each ``by`` group in ``order``.

    With one order column a group is a store's weeks, which the calendar bounds.  With several
    (department, then date) a group is a whole store's fact rows and may be huge, so it is cut
    into chunks by the leading order columns: the fill runs inside each chunk, and only one
    summary row per chunk (its first and last known value) is ordered across the store.
    """
    by, order, columns = list(by), list(order), list(columns)
    chunk = by + order[:-1]
    inside = W.partitionBy(*chunk).orderBy(order[-1])
    past = inside.rowsBetween(W.unboundedPreceding, W.currentRow)
    future = inside.rowsBetween(W.currentRow, W.unboundedFollowing)

    def near(c, window, pick):
        return pick(F.col(c), ignorenulls=True).over(window)

    if len(order) == 1:
        return df.withColumns({
            c: F.coalesce(near(c, past, F.last), near(c, future, F.first)) for c in columns})

    edges = df.groupBy(*chunk).agg(*[
        e for c in columns for e in (
            F.min_by(F.when(F.col(c).isNotNull(), F.col(c)),
                     F.when(F.col(c).isNotNull(), F.col(order[-1]))).alias(f"_first_{c}"),
            F.max_by(F.when(F.col(c).isNotNull(), F.col(c)),
                     F.when(F.col(c).isNotNull(), F.col(order[-1]))).alias(f"_last_{c}"))])
    across = W.partitionBy(*by).orderBy(*order[:-1])
    before = across.rowsBetween(W.unboundedPreceding, -1)
    after = across.rowsBetween(1, W.unboundedFollowing)
    carried = edges.select(*chunk, *[
        e for c in columns for e in (
            near(f"_last_{c}", before, F.last).alias(f"_prev_{c}"),
            near(f"_first_{c}", after, F.first).alias(f"_next_{c}"))])
    filled = df.join(carried, chunk, "left").withColumns({
        c: F.coalesce(near(c, past, F.last), F.col(f"_prev_{c}"),
                      near(c, future, F.first), F.col(f"_next_{c}"))
        for c in columns})
    return filled.select(*df.columns)


def handle_missing(df: DataFrame, order: Sequence[str] = ("Date",)) -> DataFrame:
    """Markdowns: missing is 0.  CPI and unemployment: filled per store."""
    out = fill_zero(df, [c for c in schemas.MARKDOWNS if c in df.columns])
    present = [c for c in schemas.FILLED_COVARIATES if c in df.columns]
    return ffill_bfill(out, present, ("Store",), order) if present else out


def add_calendar(df: DataFrame, events: Sequence[dt.date], date: str = "Date") -> DataFrame:
    """Year, month, ISO week and the distance to the nearest event on either side."""
    return df.withColumns({**cal.calendar_parts(date), **cal.event_distance(date, list(events))})


def one_hot_type(df: DataFrame) -> DataFrame:
    """Type becomes Type_A/Type_B/Type_C; unknown types get zeros."""
    flags = {f"Type_{t}": one_hot("Type", t) for t in schemas.STORE_TYPES}
    return df.withColumns(flags).drop("Type")


def shared_features(
    df: DataFrame, events: Sequence[dt.date], order: Sequence[str] = ("Date",)
) -> DataFrame:
    """All cleaning and calendar features in one call; applying it twice changes nothing.

    ``order`` is the row order of the per-store fill: ``("Date",)`` on covariates,
    ``("Dept", "Date")`` on a merged fact table.
    """
    out = handle_missing(df, order)
    if "Type" in out.columns:
        out = one_hot_type(out)
    if "IsHoliday" in out.columns:
        out = out.withColumn("IsHoliday", encode_holiday())
    return add_calendar(out, events)


def store_date_features(
    covariates: DataFrame, events: Sequence[dt.date], columns: Sequence[str] = tuple(schemas.FUTURE_COLUMNS)
) -> DataFrame:
    """Cleaned, dated covariates, one row per (Store, Date); the first row wins on duplicates.

    Exact copies are merged before the fill, on the map side first, so a store with many copies
    does not make one huge window group; copies are neighbours and cannot change the fill.
    """
    out = handle_missing(covariates.distinct())
    if "IsHoliday" in out.columns:
        out = out.withColumn("IsHoliday", encode_holiday())
    out = add_calendar(out, events)
    keep = ["Store", "Date"] + [c for c in columns if c in out.columns]
    tie = [c for c in keep if c not in ("Store", "Date")]
    return dedupe_first(out.select(*keep), ("Store", "Date"), tie)


def dedupe_first(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """First row per key in an explicit order.

    The row number limit is pushed below the shuffle by Spark, so copies of a hot key are thinned
    on the map side before they meet in one task.
    """
    w = W.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).filter("_rn = 1").drop("_rn")
