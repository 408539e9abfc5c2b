"""Lag and rolling features that cannot see past a cutoff.

Calendar lags look up "the same series, 52 weeks earlier"; positional lags count existing rows.
They differ as soon as a series has a gap.  Both are window expressions over one partitioning by
series, so a feature set costs one shuffle and one sort.  A series holds at most one row per week,
which bounds every window group by the calendar.
"""

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .. import schemas
from ..functions.scalars import holiday_weight
from .clean import shared_features
from .rows import dropna_any, fill_zero, replace_infinities, to_double

SERIES = ("Store", "Dept")


def lag_positional(
    df: DataFrame,
    lags: Sequence[int] = tuple(schemas.POSITIONAL_LAGS),
    by: Sequence[str] = SERIES, date: str = "Date", target: str = "Weekly_Sales",
) -> DataFrame:
    """``lag_k``: the value k existing rows earlier."""
    w = W.partitionBy(*by).orderBy(date)
    return df.withColumns({f"lag_{k}": F.lag(target, k).over(w) for k in lags})


def rolling_positional(
    df: DataFrame,
    windows: Sequence[int] = tuple(schemas.POSITIONAL_WINDOWS),
    shift: int = schemas.POSITIONAL_SHIFT,
    by: Sequence[str] = SERIES, date: str = "Date", target: str = "Weekly_Sales",
) -> DataFrame:
    """Mean and deviation of the w rows that end ``shift`` rows back; one value deviates by 0."""
    w = W.partitionBy(*by).orderBy(date)
    out = {}
    for size in windows:
        frame = w.rowsBetween(-(shift + size - 1), -shift)
        out[f"rolling_mean_{size}"] = F.avg(target).over(frame)
        out[f"rolling_std_{size}"] = F.coalesce(F.stddev_samp(target).over(frame), F.lit(0.0))
    return df.withColumns(out)


def lag_with_cutoff(
    df: DataFrame, lag: int, cutoff: dt.date | Column,
    by: Sequence[str] = SERIES, date: str = "Date", target: str = "Weekly_Sales",
) -> DataFrame:
    """Positional lag whose source rows on or after ``cutoff`` read as missing."""
    w = W.partitionBy(*by).orderBy(date)
    limit = F.lit(cutoff) if isinstance(cutoff, dt.date) else cutoff
    visible = F.when(F.col(date) < limit, F.col(target))
    return df.withColumn("_visible", visible).withColumn(
        f"lag_{lag}", F.lag("_visible", lag).over(w)).drop("_visible")


def calendar_lags(
    history: DataFrame,
    requests: DataFrame | None = None,
    weeks: int | Sequence[int] = schemas.LAG_WEEKS,
    roll: int = schemas.ROLL_WEEKS,
    cutoff: dt.date | Column | None = None,
    last_value: str | None = None,
    by: Sequence[str] = SERIES, date: str = "Date", target: str = "Weekly_Sales",
) -> DataFrame:
    """``lag_52`` with the trailing mean and deviation as of that week.

    Range frames over the day number read the calendar directly: a gap week yields a missing lag
    but a mean over the weeks that exist, and nothing is returned outside the first..last week of
    the series' history.  ``requests`` are rows to featurize that are not part of the history;
    without it the history itself is featurized.  ``cutoff`` hides history on or after a date.
    ``last_value`` names a column for the series' last known value, read in the same pass.
    """
    if requests is None:
        rows = history.withColumn("_request", F.lit(True))
        is_history = F.lit(True)
    else:
        rows = history.withColumn("_request", F.lit(False)).unionByName(
            requests.withColumn("_request", F.lit(True)), allowMissingColumns=True)
        is_history = ~F.col("_request")
    if cutoff is not None:
        is_history = is_history & (F.col(date) < (F.lit(cutoff) if isinstance(cutoff, dt.date) else cutoff))
    rows = rows.withColumn("_day", F.unix_date(date)).withColumns({
        "_y": F.when(is_history, F.col(target)), "_seen": F.when(is_history, F.col("_day"))})

    timed = W.partitionBy(*by).orderBy("_day")
    whole = timed.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    first, last = F.min("_seen").over(whole), F.max("_seen").over(whole)
    features = {}
    for k in [weeks] if isinstance(weeks, int) else weeks:
        trail = timed.rangeBetween(-7 * (k + roll - 1), -7 * k)
        ref = F.col("_day") - 7 * k
        within = (ref >= first) & (ref <= last)
        features[f"lag_{k}"] = F.max("_y").over(timed.rangeBetween(-7 * k, -7 * k))
        features[f"roll_mean_{roll}_lag{k}"] = F.when(within, F.avg("_y").over(trail))
        features[f"roll_std_{roll}_lag{k}"] = F.when(within, F.stddev_samp("_y").over(trail))
    if last_value:
        features[last_value] = F.last("_y", ignorenulls=True).over(whole)
    out = rows.withColumns(features)
    return out.filter("_request").drop("_request", "_y", "_day", "_seen")


def calendar_lookup(
    requests: DataFrame, spine: DataFrame, weeks: int = schemas.LAG_WEEKS, date: str = "Date",
) -> DataFrame:
    """The same lookup as an equi-join against a ready weekly spine
    (unique_id, Date, y, roll_mean_26, roll_std_26)."""
    shifted = spine.select(
        "unique_id", F.date_add("Date", 7 * weeks).alias(date),
        F.col("y").alias(f"lag_{weeks}"),
        F.col("roll_mean_26").alias(f"roll_mean_26_lag{weeks}"),
        F.col("roll_std_26").alias(f"roll_std_26_lag{weeks}"))
    return requests.join(shifted, ["unique_id", date], "left")


def rolling_calendar(spine: DataFrame, roll: int = schemas.ROLL_WEEKS, target: str = "y") -> DataFrame:
    """Trailing mean (at least one value) and deviation (at least two) on a weekly spine."""
    w = W.partitionBy("unique_id").orderBy("Date").rowsBetween(-(roll - 1), W.currentRow)
    return spine.withColumns({
        f"roll_mean_{roll}": F.avg(target).over(w),
        f"roll_std_{roll}": F.stddev_samp(target).over(w),
    })


def calendar_feature_frame(
    df: DataFrame, events, history: DataFrame | None = None,
    order: Sequence[str] = ("Dept", "Date"), cutoff=None, keep: Sequence[str] = (),
) -> DataFrame:
    """Model frame with calendar lags; infinities are missing.

    ``df`` is a merged fact frame.  With ``history`` (the training fact) the lags of ``df`` come
    from there, otherwise from ``df`` itself.
    """
    clean = shared_features(df, events, order)
    if history is None:
        lagged = calendar_lags(clean, cutoff=cutoff)
    else:
        past = history.select("Store", "Dept", "Date", "Weekly_Sales")
        lagged = calendar_lags(past, clean.drop("Weekly_Sales"), cutoff=cutoff)
    lagged = replace_infinities(lagged, ["DaysSinceLastHoliday", "DaysToNextHoliday"])
    extra = [c for c in keep if c not in schemas.CALENDAR_FEATURES]
    return lagged.select(*extra, *schemas.CALENDAR_FEATURES)


def positional_feature_frame(
    df: DataFrame, events, order: Sequence[str] = ("Dept", "Date"),
    cutoff: dt.date | Column | None = None, drop_missing: bool = True,
) -> DataFrame:
    """Model frame with positional lags, target and row weight.

    Without ``cutoff`` a lag may read any earlier row, also held-out ones; with it the lags of all
    rows see only targets before the cutoff.  Rows with missing values are dropped, or kept with
    ``drop_missing=False`` and 0 in place of missing features, as at serving time.
    """
    clean = shared_features(df, events, order)
    visible = F.col("Weekly_Sales")
    if cutoff is not None:
        visible = F.when(F.col("Date") < (F.lit(cutoff) if isinstance(cutoff, dt.date) else cutoff), visible)
    clean = clean.withColumn("_visible", visible)
    lagged = rolling_positional(lag_positional(clean, target="_visible"), target="_visible")
    frame = lagged.withColumn("weight", holiday_weight())
    if drop_missing:
        frame = dropna_any(frame, schemas.POSITIONAL_FEATURES, "Weekly_Sales")
    frame = to_double(frame, schemas.POSITIONAL_FEATURES)
    if not drop_missing:
        frame = fill_zero(frame, schemas.POSITIONAL_FEATURES)
    return frame.select("Date", *schemas.POSITIONAL_FEATURES, "Weekly_Sales", "weight")


def serve_positional_features(tail: DataFrame, requests: DataFrame) -> DataFrame:
    """Lags for request rows computed over the history tail plus the requests; missing is 0."""
    rows = tail.withColumn("_is_test", F.lit(False)).unionByName(
        requests.withColumns({"_is_test": F.lit(True), "Weekly_Sales": F.lit(None).cast("double")}),
        allowMissingColumns=True)
    lagged = rolling_positional(lag_positional(rows))
    out = lagged.filter("_is_test").drop("_is_test", "Weekly_Sales")
    return fill_zero(out, [c for c in schemas.POSITIONAL_FEATURES if c in out.columns])
