"""JDBC readers and the JDBC writer.

The option sets are plain functions, so they can be checked without a database.
"""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curbline import fixed
from curbline.functions import dates
from curbline.operators import clean


def table_options(url: str, table: str, extra: Mapping[str, str] | None = None) -> dict[str, str]:
    """Options of a whole-table or ``(subquery) alias`` scan."""
    return {"url": url, "dbtable": table, **(extra or {})}


def query_options(url: str, query: str, extra: Mapping[str, str] | None = None) -> dict[str, str]:
    """Options of a query the database runs."""
    return {"url": url, "query": query, **(extra or {})}


def range_options(
    url: str,
    table: str,
    column: str,
    bounds: tuple[datetime, datetime],
    num_partitions: int = 8,
    extra: Mapping[str, str] | None = None,
) -> dict[str, str]:
    """Options of a scan split evenly between two times."""
    return {
        **table_options(url, table, extra),
        "partitionColumn": column,
        "lowerBound": bounds[0].isoformat(sep=" "),
        "upperBound": bounds[1].isoformat(sep=" "),
        "numPartitions": str(num_partitions),
    }


def month_bounds_query(table: str, column: str, year: int, month: int) -> str:
    """First and last time of a month's rows."""
    start, end = dates.month_start(year, month), dates.month_after(year, month)
    return (
        f"SELECT MIN({column}) AS min_ts, MAX({column}) AS max_ts FROM {table} "
        f"WHERE {column} >= TIMESTAMP '{start}' AND {column} < TIMESTAMP '{end}'"
    )


def read_jdbc(
    spark: SparkSession, url: str, table: str, extra: Mapping[str, str] | None = None
) -> DataFrame:
    """A whole table or subquery."""
    return spark.read.format("jdbc").options(**table_options(url, table, extra)).load()


def pull_query(
    spark: SparkSession, url: str, query: str, extra: Mapping[str, str] | None = None
) -> DataFrame:
    """A projected query of another database."""
    return spark.read.format("jdbc").options(**query_options(url, query, extra)).load()


def read_jdbc_range(
    spark: SparkSession,
    url: str,
    table: str,
    col: str,
    year: int,
    month: int,
    num_partitions: int = 8,
    extra: Mapping[str, str] | None = None,
) -> DataFrame:
    """One month, read by several tasks that each take a slice of its time range.

    The month predicate is pushed to the database in every slice.
    """
    found = pull_query(spark, url, month_bounds_query(table, col, year, month), extra).first()
    bounds = (
        found.min_ts or dates.month_start(year, month),
        found.max_ts or dates.month_after(year, month),
    )
    options = range_options(url, table, col, bounds, num_partitions, extra)
    return spark.read.format("jdbc").options(**options).load().transform(
        clean.in_month, col, year, month
    )


def writer_count(rows: int, batch_size: int) -> int:
    """How many tasks write: one per started batch, at least one."""
    if batch_size < 1:
        raise ValueError("batch size must be positive")
    return max(1, math.ceil(rows / batch_size))


def spread(
    df: DataFrame,
    keys: Sequence[str],
    batch_size: int,
    rows: int | None = None,
    max_writers: int | None = None,
) -> DataFrame:
    """Rows dealt to the tasks that write them, by the whole key, which is unique: no task gets a hot share.

    A task has about one batch if the number of ``rows`` is known. Otherwise Spark sizes the tasks by the
    bytes that it has shuffled, and nothing is counted first. ``max_writers`` is for databases that
    take few connections; by default the session's cores are the limit.
    """
    columns = [F.col(k) for k in keys]
    if rows is None and max_writers is None:
        return df.hint("rebalance", *columns)
    total = df.count() if rows is None else rows
    writers = writer_count(total, batch_size)
    return df.repartition(writers if max_writers is None else min(writers, max_writers), *columns)


def write_jdbc(
    df: DataFrame,
    url: str,
    table: str,
    mode: str = "append",
    batch_size: int = 10000,
    max_writers: int | None = None,
    keys: Sequence[str] = tuple(fixed.PRIMARY_KEY),
    rows: int | None = None,
    extra: Mapping[str, str] | None = None,
) -> None:
    """Write a table in batches from several tasks (see ``spread``)."""
    if mode not in ("append", "overwrite"):
        raise ValueError(f"unknown mode: {mode}")
    options = {**table_options(url, table, extra), "batchsize": str(batch_size)}
    spread(df, keys, batch_size, rows, max_writers).write.format("jdbc").options(**options).mode(mode).save()
