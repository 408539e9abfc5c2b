"""Row-level expressions."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# Weights of the error metric and the fit-status limits in percent.
HOLIDAY_WEIGHT = 5.0
REGULAR_WEIGHT = 1.0
OVERFIT_ABOVE = 25.0
UNDERFIT_BELOW = -10.0


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def nan_to_null(c) -> Column:
    """Missing is NULL everywhere in this package; apply at the scan boundary."""
    c = _col(c)
    return F.when(~F.isnan(c), c)


def one_hot(c, value: str) -> Column:
    """1 when equal, 0 otherwise, including unknown and missing values."""
    return F.when(_col(c) == value, 1).otherwise(0)


def encode_holiday(c="IsHoliday") -> Column:
    return _col(c).cast("int")


def holiday_weight(c="IsHoliday") -> Column:
    """5 in a holiday week, 1 otherwise; a missing flag counts as no holiday."""
    flag = F.coalesce(_col(c).cast("boolean"), F.lit(False))
    return F.when(flag, HOLIDAY_WEIGHT).otherwise(REGULAR_WEIGHT)


def abs_error(y, p) -> Column:
    return F.abs(_col(y) - _col(p))


def is_infinite(c) -> Column:
    return F.abs(_col(c)) == float("inf")


def replace_infinite(c) -> Column:
    """Plus or minus infinity becomes missing."""
    c = _col(c)
    return F.when(~is_infinite(c), c)


def clip_nonnegative(c) -> Column:
    """max(x, 0); a missing value stays missing (``greatest`` alone would turn it into 0)."""
    c = _col(c)
    return F.when(c.isNotNull(), F.greatest(c, F.lit(0.0)))


def fallback_chain(*choices) -> Column:
    """First value that is neither NULL nor NaN."""
    return F.coalesce(*[nan_to_null(c) for c in choices])


def gap_pct(train, val) -> Column:
    """Relative validation gap in percent; missing if the training error is missing or zero."""
    t, v = _col(train), _col(val)
    return (v - t) / F.nullif(t, F.lit(0.0)) * 100


def fit_status(gap) -> Column:
    g = _col(gap)
    return (
        F.when(g.isNull() | F.isnan(g), "unknown")
        .when(g > OVERFIT_ABOVE, "overfit")
        .when(g < UNDERFIT_BELOW, "underfit")
        .otherwise("good")
    )


def parse_int_list(c) -> Column:
    """A run parameter written as ``[3, 3]`` becomes ARRAY<INT>."""
    return F.from_json(_col(c), "array<int>")


def parse_string_list(c) -> Column:
    """A run parameter written as ``['trend', 'seasonality']`` becomes ARRAY<STRING>."""
    return F.from_json(_col(c), "array<string>", {"allowSingleQuotes": "true"})


def parse_nested_int_list(c) -> Column:
    """A run parameter written as ``[[512, 512], [512, 512]]`` becomes ARRAY<ARRAY<INT>>."""
    return F.from_json(_col(c), "array<array<int>>")
