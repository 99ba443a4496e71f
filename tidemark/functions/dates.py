"""Date arithmetic as column expressions: week grids, moving feasts, calendar parts."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

SEASON_WEEKS = 52


def _div(numerator: Column, divisor: int) -> Column:
    return F.floor(numerator / F.lit(divisor)).cast("int")


def week_ending(day: Column, weekday: str = "Fri") -> Column:
    """The first ``weekday`` on or after ``day``: the label of a weekly grid."""
    return F.next_day(F.date_sub(day.cast("date"), 1), weekday)


def _let(value: Column, body) -> Column:
    """Bind ``value`` once and use it many times, so expressions stay small."""
    return F.transform(F.array(value), body)[0]


def easter_sunday(year: Column) -> Column:
    """Easter Sunday by the anonymous Gregorian computus, in integer arithmetic."""

    def epact(y: Column) -> Column:
        century = _div(y, 100)
        correction = _div(century - _div(century + 8, 25) + 1, 3)
        return ((y % 19) * 19 + century - _div(century, 4) - correction + 15) % 30

    def weekday(y: Column, h: Column) -> Column:
        century, rest = _div(y, 100), y % 100
        return ((century % 4) * 2 + _div(rest, 4) * 2 + 32 - h - rest % 4) % 7

    def packed(y: Column, h: Column, d: Column) -> Column:
        return h + d - _div(y % 19 + h * 11 + d * 22, 451) * 7 + 114

    def date(y: Column, q: Column) -> Column:
        return F.make_date(y, _div(q, 31), q % 31 + 1)

    return _let(
        year,
        lambda y: _let(
            epact(y),
            lambda h: _let(weekday(y, h), lambda d: _let(packed(y, h, d), lambda q: date(y, q))),
        ),
    )


def nth_weekday(year: Column, month: int, nth: int, weekday: str) -> Column:
    """The ``nth`` given weekday of a month, for example the 4th Thursday."""
    first = F.next_day(F.date_sub(F.make_date(year, F.lit(month), F.lit(1)), 1), weekday)
    return F.date_add(first, 7 * (nth - 1))


def last_weekday(year: Column, month: int, weekday: str) -> Column:
    """The last given weekday of a month."""
    month_end = F.last_day(F.make_date(year, F.lit(month), F.lit(1)))
    return F.next_day(F.date_sub(month_end, 7), weekday)


def calendar_columns(ds: Column, season: int = SEASON_WEEKS) -> dict[str, Column]:
    """Year, month, ISO week, quarter, and the week as a point on a circle.

    Week 53 lands on the angle of week 1, which keeps neighbours adjacent.
    """
    week = F.weekofyear(ds)
    angle = week * F.lit(2 * math.pi / season)
    return {
        "year": F.year(ds),
        "month": F.month(ds),
        "week": week,
        "quarter": F.quarter(ds),
        "week_sin": F.sin(angle),
        "week_cos": F.cos(angle),
    }
