"""Row keys, duplicates and idempotent inserts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from curbline import fixed
from curbline.functions import text
from curbline.operators import joins, shape, tagged


def distinct_rows(df: DataFrame) -> DataFrame:
    """Exact duplicates removed; each task first removes its own."""
    return df.dropDuplicates()


def distinct_on(
    df: DataFrame, keys: Sequence[str], order: Sequence[str | Column] = ()
) -> DataFrame:
    """The first row of each key.

    The given order is completed with all other columns, so the winner never
    depends on how the data is partitioned. Spark keeps one row per key in every
    task before the shuffle, so a key that fills a third of the table still
    sends only one row per task.
    """
    rest = [F.col(c) for c in df.columns if c not in set(keys)]
    by = [F.col(c) if isinstance(c, str) else c for c in order] + rest
    if not by:
        return df.dropDuplicates(list(keys))
    window = W.partitionBy(*keys).orderBy(*by)
    return df.withColumn("__rank", F.row_number().over(window)).where("__rank = 1").drop("__rank")


def distinct_in_time(
    df: DataFrame, keys: Sequence[str], ts_col: str, order: Sequence[str | Column] = ()
) -> DataFrame:
    """As ``distinct_on``, by one shuffle that deals ranges of ``ts_col``, one of the keys, to the tasks.

    A table stored by time needs no further one. A key of many rows would be in one task; such keys are
    named by a sketch first, and their few first rows chosen apart.
    """
    code = F.xxhash64(*keys)
    hot = joins.hot_keys(df.select(code.alias("__code")), "__code")
    ranges = df.where(~code.isin(hot)) if hot else df
    ranges = ranges.repartitionByRange(ts_col, *[k for k in keys if k != ts_col])
    found = distinct_on(ranges, keys, order)
    return found.unionByName(distinct_on(df.where(code.isin(hot)), keys, order)) if hot else found


def dedup_by_key(
    df: DataFrame,
    keys: Sequence[str] = tuple(fixed.TRIP_KEY),
    order: Sequence[str | Column] = (),
) -> DataFrame:
    """One row per business key."""
    return distinct_on(df, keys, order)


def add_row_key(
    df: DataFrame,
    cols: Sequence[str] = tuple(fixed.TRIP_KEY),
    name: str = "dwid",
    n: int = fixed.ROW_KEY_LENGTH,
) -> DataFrame:
    """Add the hash key of the business columns as the first column."""
    return shape.move_first(df.withColumn(name, text.row_key(cols, n)), name)


def duplicate_report(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their counts."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("count")).where("count > 1")


def insert_if_absent(target: DataFrame, rows: DataFrame, key: Sequence[str]) -> DataFrame:
    """The target plus the rows whose key it lacks; running it twice adds nothing."""
    return tagged.preferred(target, rows.select(*target.columns), key, one_second=True)
