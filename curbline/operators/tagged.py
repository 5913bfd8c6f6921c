"""Two tables in one pass: a union whose rows carry their side, decided key by key.

Each input is read once and shuffled once, on the key. The choice is a rank with a limit, which Spark
also applies in every task before the shuffle, so that a key of many losing rows sends few of them.
A NULL in a key equals no other, as in a join: rows with one only meet rows of their own side.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

SIDE, ROW, RANK = "__side", "__row", "__rank"


def tagged(first: DataFrame, second: DataFrame) -> DataFrame:
    """Rows of both, in the columns of the first, with ``__side`` 0 or 1."""
    columns = first.columns
    return first.select(F.lit(0).alias(SIDE), *columns).unionByName(second.select(F.lit(1).alias(SIDE), *columns))


def _key(keys: Sequence[str]) -> list:
    """What rows must share to meet."""
    missing = F.lit(False)
    for key in keys:
        missing = missing | F.col(key).isNull()
    return [*keys, F.when(missing, F.col(SIDE))]


def preferred(
    first: DataFrame, second: DataFrame, keys: Sequence[str], one_first: bool = False, one_second: bool = False
) -> DataFrame:
    """The first table's rows, and those of the second whose key the first lacks.

    With ``one_first`` or ``one_second`` only the first row of each key, in column order, comes
    from that table; otherwise all do.
    """
    columns = first.columns
    both, order = tagged(first, second), [F.col(SIDE)]
    alone = [side for side, one in enumerate((one_first, one_second)) if one]
    if alone:
        # Rows that are not chosen among have no order, and so all come first.
        choose = F.col(SIDE).isin(alone)
        both = both.withColumn(ROW, F.when(choose, F.monotonically_increasing_id()))
        order += [F.when(choose, F.col(c)) for c in [*[c for c in columns if c not in set(keys)], ROW]]
    window = W.partitionBy(*_key(keys)).orderBy(*order)
    return both.withColumn(RANK, F.rank().over(window)).where(F.col(RANK) == 1).select(*columns)


def updated(target: DataFrame, updates: DataFrame, keys: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """All target rows, the listed columns taken from the key's update, and the updates of new keys.

    ``updates`` holds a key once.
    """
    columns, listed = target.columns, set(cols)
    both = tagged(updates.select(*columns), target)
    # The update, if there is one, is the first row of its key, and a target row is the last.
    window = W.partitionBy(*_key(keys)).orderBy(SIDE).rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    lead, last = F.first(F.struct(SIDE, *cols)).over(window), F.last(SIDE).over(window)
    seen = both.withColumns({"__lead": lead, "__last": last})
    changed = (F.col(SIDE) == 1) & (F.col(f"__lead.{SIDE}") == 0)
    return seen.where((F.col(SIDE) == 1) | (F.col("__last") == 0)).select(
        *[F.when(changed, F.col(f"__lead.{c}")).otherwise(F.col(c)).alias(c) if c in listed else F.col(c) for c in columns]
    )
