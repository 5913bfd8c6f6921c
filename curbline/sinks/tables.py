"""Partitioned Parquet tables, CSV exports and summary tables.

Rows are brought together per partition with a ``rebalance`` hint before a
write: small partitions end in one file each, and adaptive execution splits a
partition that outgrows the advisory size over several tasks and files.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from curbline.functions import dates
from curbline.operators import clean, shape
from curbline.sources import files

MONTHS = ("year", "month")
#: Stored tables are read more than once and hold hashes, of which Snappy saves nothing.
PARQUET = {"compression": "zstd"}


def together(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Rows of a partition together."""
    return df.hint("rebalance", *[F.col(c) for c in cols])


def _in_order(df: DataFrame, cols: Sequence[str], ts_col: str | None) -> DataFrame:
    """A partition's rows in order of time: a day's filter then skips row groups."""
    return df if ts_col is None or ts_col not in df.columns else df.sortWithinPartitions(*cols, ts_col)


def _gathered(df: DataFrame, cols: Sequence[str], ts_col: str | None = None) -> DataFrame:
    return _in_order(together(df, cols), cols, ts_col)


def append_months(df: DataFrame, base: str, ts_col: str = "pickup_datetime") -> None:
    """Add ``year`` and ``month`` and append to the month partitions."""
    rows = _gathered(shape.add_year_month(df, ts_col), MONTHS, ts_col)
    rows.write.partitionBy(*MONTHS).mode("append").parquet(base)


def overwrite_months(df: DataFrame, base: str, ts_col: str = "pickup_datetime") -> None:
    """Replace the month partitions that occur in the frame and no others."""
    rows = _gathered(shape.add_year_month(df, ts_col), MONTHS, ts_col)
    (
        rows.write.partitionBy(*MONTHS)
        .options(**PARQUET)
        .option("partitionOverwriteMode", "dynamic")
        .mode("overwrite")
        .parquet(base)
    )


def write_image(
    df: DataFrame, path: str, cols: Sequence[str], ts_col: str = "pickup_datetime", dealt: bool = False
) -> DataFrame:
    """Write the partitions of a table image to a new path and read them back.

    ``dealt`` says that the rows of a partition are together already, in one task or a few.
    """
    rows = _in_order(df if dealt else together(df, cols), cols, ts_col)
    rows.write.partitionBy(*cols).options(**PARQUET).parquet(path)
    stored = T.StructType([*[f for f in df.schema.fields if f.name not in cols], *[df.schema[c] for c in cols]])
    return df.sparkSession.read.schema(stored).parquet(path)


def write_day_files(
    df: DataFrame, base: str, ts_col: str = "pickup_datetime", column: str = "partition_date"
) -> None:
    """One directory per calendar day that has rows, replacing the days written.

    A day is one file unless it outgrows the advisory partition size.
    """
    rows = _gathered(df.withColumn(column, F.to_date(ts_col)), [column], ts_col)
    (
        rows.write.partitionBy(column)
        .option("partitionOverwriteMode", "dynamic")
        .mode("overwrite")
        .parquet(base)
    )


def write_by_date(
    df: DataFrame, root: str, ts_col: str = "pickup_datetime", column: str = "partitioned_date"
) -> None:
    """Partition by ``yyyy-MM-dd`` text, replacing the whole table."""
    rows = _gathered(df.withColumn(column, F.date_format(ts_col, "yyyy-MM-dd")), [column])
    rows.write.partitionBy(column).mode("overwrite").parquet(root)


def write_missing_dates(df: DataFrame, root: str, date_col: str) -> None:
    """Append only the dates the target does not hold yet."""
    spark = df.sparkSession
    try:
        present = spark.read.parquet(root).select(F.col(date_col).cast("date")).distinct()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        present = None
    rows = df.withColumn(date_col, F.col(date_col).cast("date"))
    if present is not None:
        rows = rows.join(present, date_col, "left_anti")
    _gathered(rows, [date_col]).write.partitionBy(date_col).mode("append").parquet(root)


def write_table(df: DataFrame, path: str) -> DataFrame:
    """Write an intermediate table and read it back, which cuts the lineage."""
    df.write.mode("errorifexists").options(**PARQUET).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def export_csv(df: DataFrame, path: str) -> None:
    """CSV with header, one file per task."""
    df.write.options(**files.CSV_OPTIONS).mode("overwrite").csv(path)


_SQL_TYPES: Mapping[type, str] = {
    T.StringType: "VARCHAR",
    T.IntegerType: "INT",
    T.FloatType: "REAL",
    T.DoubleType: "DOUBLE PRECISION",
    T.TimestampType: "TIMESTAMP",
    T.TimestampNTZType: "TIMESTAMP",
}


def schema_ddl(df: DataFrame, table: str) -> str:
    """``CREATE TABLE`` for a frame's columns; other types raise."""
    parts = []
    for field in df.schema.fields:
        kind = _SQL_TYPES.get(type(field.dataType))
        if kind is None:
            raise TypeError(f"no SQL type for {field.name}: {field.dataType.simpleString()}")
        parts.append(f"{field.name} {kind}")
    return f"CREATE TABLE IF NOT EXISTS {table} ({', '.join(parts)})"


def refresh_table(df: DataFrame, name: str, path: str | None = None) -> DataFrame:
    """Create or fully replace a summary table and return it."""
    writer = df.write.mode("overwrite").format("parquet")
    if path is not None:
        writer = writer.option("path", path)
    writer.saveAsTable(name)
    return df.sparkSession.table(name)


def month_view(
    df: DataFrame, name: str, year: int, month: int, ts_col: str = "pickup_datetime"
) -> DataFrame:
    """A temporary view over one month."""
    clean.in_month(df, ts_col, year, month).createOrReplaceTempView(name)
    return df.sparkSession.table(name)


def table_view(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """A temporary view over a whole table."""
    df.createOrReplaceTempView(name)
    return spark.table(name)


def partition_catalog(df: DataFrame, table: str, ts_col: str = "pickup_datetime") -> DataFrame:
    """Each month that occurs: partition name, bounds and rows."""
    start = F.trunc(F.to_date(ts_col), "month")
    return (
        df.groupBy(start.alias("partition_start"))
        .agg(F.count(F.lit(1)).alias("row_count"))
        .select(
            F.concat(
                F.lit(f"{table}_"), dates.month_token(F.col("partition_start"))
            ).alias("partition_name"),
            "partition_start",
            F.add_months("partition_start", 1).alias("partition_end"),
            "row_count",
        )
    )
