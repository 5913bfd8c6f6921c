"""Calendar columns and month bounds."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

from curbline import fixed

_ORDINALS = {"first": 0, "second": 1, "third": 2, "fourth": 3}


def parse_month(token: str) -> tuple[int, int]:
    """``'2023_10'`` as ``(2023, 10)``."""
    year, month = (int(part) for part in token.split("_"))
    if not 1 <= month <= 12:
        raise ValueError(f"no such month: {token}")
    return year, month


def month_start(year: int, month: int) -> datetime:
    return datetime(year, month, 1)


def month_after(year: int, month: int) -> datetime:
    """First instant of the following month."""
    return datetime(year + month // 12, month % 12 + 1, 1)


def ntz(moment: datetime) -> Column:
    """A timestamp literal without time zone."""
    return F.lit(moment.isoformat(sep=" ")).cast("timestamp_ntz")


def month_token(ts: Column) -> Column:
    """``yyyy_MM`` text of a timestamp."""
    return F.date_format(ts, "yyyy_MM")


def weekend_flag(ts: Column) -> Column:
    """True on Saturday and Sunday."""
    return F.dayofweek(ts).isin(1, 7)


def _day_of(year: Column, month: Column, day: Column) -> Column:
    """The date, or NULL when the calendar has no such day."""
    text = F.format_string("%04d-%02d-%02d", year, month, day)
    return F.when(year.isNotNull() & month.isNotNull() & day.isNotNull(), text.try_cast("date"))


def nth_weekday(year: Column, month: Column, rule: Column) -> Column:
    """The date a holiday rule names in one month.

    A rule is a day number, or an ordinal (first to fourth, last) and a weekday
    joined by ``_`` or a space. Anything else is NULL.
    """
    word = F.regexp_replace(F.lower(F.trim(rule)), r"\s+", "_")
    ordinal = F.split_part(word, F.lit("_"), F.lit(1))
    weekday = F.split_part(word, F.lit("_"), F.lit(2))
    first = _day_of(year, month, F.lit(1))

    weeks = F.lit(None).cast("int")
    for name, count in _ORDINALS.items():
        weeks = F.when(ordinal == name, F.lit(count)).otherwise(weeks)
    # Search from the day before the first day the answer can fall on.
    from_day = F.when(ordinal == "last", F.date_sub(F.last_day(first), 7)).otherwise(
        F.date_sub(first, 1)
    )
    found = F.call_function("next_day", from_day, weekday)
    floating = F.when(ordinal == "last", found).otherwise(F.date_add(found, weeks * 7))
    return F.when(
        word.rlike("^[0-9]+$"), _day_of(year, month, word.try_cast("int"))
    ).when(word.rlike(fixed.FLOATING_HOLIDAY_RULE), floating)
