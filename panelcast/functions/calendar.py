"""Calendar expressions: ISO parts, the holiday rule and distances to events.

All of it is plain Column arithmetic, so it runs inside code generation and never shuffles.
"""

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values: (event, month, first day, last day) of the Friday that ends the event's week.
HOLIDAY_RULE = [
    ("Super_Bowl", 2, 8, 14),
    ("Labor_Day", 9, 5, 11),
    ("Thanksgiving", 11, 23, 29),
    ("Christmas", 12, 25, 31),
]


def holiday_dates(first_year: int = 2010, last_year: int = 2013) -> list[tuple[str, dt.date]]:
    """(event, Friday) for every event and year; the default years are the reference period."""
    out = []
    for event, month, first_day, _ in HOLIDAY_RULE:
        for year in range(first_year, last_year + 1):
            start = dt.date(year, month, first_day)
            out.append((event, start + dt.timedelta(days=(4 - start.weekday()) % 7)))
    return out


def week_friday(date) -> Column:
    """The Friday of the ISO week that holds ``date``."""
    return F.date_add(date, 4 - F.weekday(date))


def holiday_case(date: str, results: list[str], otherwise: str) -> str:
    """SQL text: the result of the event whose week ends on this Friday."""
    hits = " ".join(
        f"WHEN month({date}) = {month} AND day({date}) BETWEEN {lo} AND {hi} THEN {result}"
        for (_, month, lo, hi), result in zip(HOLIDAY_RULE, results, strict=True))
    return f"CASE WHEN dayofweek({date}) <> 6 THEN {otherwise} {hits} ELSE {otherwise} END"


def holiday_name(date: str = "Date") -> Column:
    """Name of the event, or NULL."""
    return F.expr(holiday_case(date, [f"'{event}'" for event, *_ in HOLIDAY_RULE], "CAST(NULL AS STRING)"))


def holiday_code(date: str = "Date") -> str:
    """SQL text: 1..4 for the events in order, 0 otherwise."""
    return holiday_case(date, ["1", "2", "3", "4"], "0")


def is_rule_holiday(date: str = "Date") -> Column:
    return F.expr(f"{date} IS NOT NULL AND {holiday_code(date)} > 0")


def calendar_parts(date="Date") -> dict[str, Column]:
    """Calendar year and month with the ISO week number."""
    d = F.col(date)
    return {"Year": F.year(d), "Month": F.month(d), "WeekOfYear": F.weekofyear(d)}


def event_distance(date: str, events: list[dt.date]) -> dict[str, Column]:
    """Days since the latest and until the next event; infinity where there is none.

    The calendar is a short literal list, so each side is one unrolled ``greatest``/``least`` over
    the row's own date instead of a rows x events join.
    """
    days = sorted(set(events))

    def side(pick: str, holds: str) -> str:
        hits = ", ".join(f"IF({date} {holds} DATE'{e}', DATE'{e}', NULL)" for e in days)
        return f"{pick}(CAST(NULL AS DATE), CAST(NULL AS DATE){', ' if hits else ''}{hits})"

    def distance(days_between: str) -> Column:
        return F.expr(f"IF({date} IS NULL, NULL, coalesce(CAST({days_between} AS DOUBLE), DOUBLE('Infinity')))")

    return {
        "DaysSinceLastHoliday": distance(f"datediff({date}, {side('greatest', '>=')})"),
        "DaysToNextHoliday": distance(f"datediff({side('least', '<=')}, {date})"),
    }


def week_shift(date, weeks: int) -> Column:
    """``date`` moved by whole weeks (negative = back)."""
    return F.date_add(F.col(date) if isinstance(date, str) else date, 7 * weeks)
