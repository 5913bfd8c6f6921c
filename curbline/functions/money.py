"""Exact sums and averages of amounts, rounded half away from zero.

Amounts are stored as floats. Summing them as doubles would depend on the order
in which partitions are combined, and summing decimals is several times slower,
so an amount is summed as whole millionths in two 64-bit parts. The parts stay
exact up to 8 * 10^12 rows and 9 * 10^18 units per group; beyond that, and for
values that are no number, Spark raises.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_SHIFT = 20
_WHOLE = "decimal(28,0)"


def millionths(value: Column) -> Column:
    """The amount in whole millionths, halves away from zero."""
    number = value.cast("double")
    return (number * 1_000_000 + F.signum(number) * 0.5).cast("bigint")


def sum_parts(value: Column | str, name: str) -> list[Column]:
    """The two partial sums of an amount (aggregates), as ``<name>_high`` and ``_low``."""
    units = millionths(F.col(value) if isinstance(value, str) else value)
    return [
        F.sum(F.shiftright(units, _SHIFT)).alias(f"{name}_high"),
        F.sum(units.bitwiseAND((1 << _SHIFT) - 1)).alias(f"{name}_low"),
    ]


def joined_sum(name: str) -> Column:
    """The sum in millionths that two partial sums stand for."""
    high = F.col(f"{name}_high").cast("decimal(19,0)")
    return (high * F.lit(1 << _SHIFT).cast("decimal(7,0)") + F.col(f"{name}_low")).cast(_WHOLE)


def total_money(total: Column) -> Column:
    """A sum in millionths, to two decimals."""
    return F.round(total / 10_000, 0).cast("double") / 100


def mean_money(total: Column, count: Column) -> Column:
    """``total / count`` to two decimals; NULL when there is nothing to average."""
    return F.round(total / F.nullif(count, F.lit(0)) / 10_000, 0).cast("double") / 100


def round_money(value: Column) -> Column:
    """One amount to two decimals, half away from zero, as a double."""
    return F.round(value.cast("decimal(28,6)"), 2).cast("double")


def filtered_count(value: Column | str, condition: Column) -> Column:
    """``COUNT(value) FILTER (WHERE condition)`` (aggregate).

    A value that cannot be NULL is not even computed.
    """
    column = F.col(value) if isinstance(value, str) else value
    return F.count_if(condition & column.isNotNull())
