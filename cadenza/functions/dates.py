"""Calendar expressions. "Today" is always an explicit ``as_of`` date."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from cadenza.constants import SEASON_MONTHS, WEEKDAYS
from cadenza.functions.numeric import first_match


def as_date(as_of: dt.date) -> Column:
    return F.lit(as_of).cast("date")


def dow(d: Column) -> Column:
    """Day of week, Sunday = 0."""
    return F.dayofweek(d) - 1


def is_weekend(day_of_week: Column) -> Column:
    return day_of_week.isin(0, 6)


def week_start(d: Column) -> Column:
    """Monday of the week."""
    return F.trunc(d, "week")


def month_start(d: Column) -> Column:
    return F.trunc(d, "month")


def day_name(day_of_week: Column) -> Column:
    return F.element_at(F.array(*[F.lit(n) for n in WEEKDAYS]), day_of_week + 1)


def day_name_order(name: Column) -> Column:
    """1 for Monday up to 7 for Sunday."""
    week = WEEKDAYS[1:] + WEEKDAYS[:1]
    return F.array_position(F.array(*[F.lit(n) for n in week]), name).cast("int")


def season(d: Column) -> Column:
    return first_match(
        [(F.month(d).isin(months), F.lit(name)) for name, months in SEASON_MONTHS.items()]
    )


def day_number(d: Column) -> Column:
    return F.unix_date(d)


def parse_date(text: Column, fmt: str = "yyyy-MM-dd") -> Column:
    """Date of a text; malformed text is an error, as for any required date."""
    return F.to_date(text, fmt)


def format_date(d: Column, fmt: str = "yyyy-MM-dd") -> Column:
    return F.date_format(d, fmt)


def look_back(as_of: dt.date, days: int = 7) -> tuple[Column, Column]:
    """(start, end) of the N days that end at ``as_of``."""
    end = as_date(as_of)
    return F.date_sub(end, days), end


def to_zone(ts: Column, zone: str = "Europe/Paris", source: str = "UTC") -> Column:
    """Wall-clock time in ``zone`` of a wall-clock time in ``source``."""
    return F.convert_timezone(F.lit(source), F.lit(zone), ts)


# Period name to (unit, count) back from as_of.
PERIODS = {
    "Last 2 weeks": ("weeks", 2),
    "Last 4 weeks": ("weeks", 4),
    "Last 3 months": ("months", 3),
    "Last 6 months": ("months", 6),
    "Last 12 months": ("months", 12),
}
ALL_TIME = "All time"


def period_start(period: str, as_of: dt.date) -> Column:
    """First day of the period; null where it has none, as for all time."""
    if period == ALL_TIME:
        return F.lit(None).cast("date")
    unit, n = PERIODS[period]
    end = as_date(as_of)
    return F.date_sub(end, 7 * n) if unit == "weeks" else F.add_months(end, -n)


def in_period(
    d: Column,
    period: str,
    as_of: dt.date,
    custom: tuple[dt.date, dt.date] | None = None,
) -> Column:
    """True inside the period; ``Custom`` takes its own closed range."""
    if period == "Custom":
        return d.between(as_date(custom[0]), as_date(custom[1]))
    if period == ALL_TIME:
        return d <= as_date(as_of)
    return d.between(period_start(period, as_of), as_date(as_of))
