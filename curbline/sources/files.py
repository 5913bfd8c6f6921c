"""Parquet and CSV readers. Partitions are chosen by filter, never by building paths."""

from __future__ import annotations

from collections.abc import Sequence

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from curbline.functions import dates
from curbline.operators import shape

# What a CSV export needs so that it reads back unchanged: microseconds, blanks
# around text, and quotes doubled inside quotes.
CSV_OPTIONS = {
    "header": "true",
    "timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
    "quote": '"',
    "escape": '"',
}


def _is_missing(error: AnalysisException) -> bool:
    return error.getCondition() in ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA")


def read_trip_files(
    spark: SparkSession, paths: str | Sequence[str], schema: T.StructType | None = None
) -> DataFrame:
    """Monthly Parquet files of one service."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(*([paths] if isinstance(paths, str) else paths))


def _merged_schema(spark: SparkSession, paths: Sequence[str]) -> T.StructType | None:
    """The one schema of several files, from all their footers at once; None if their types differ."""
    try:
        return spark.read.option("mergeSchema", "true").parquet(*paths).schema
    except PySparkException as error:
        if error.getCondition() == "CANNOT_MERGE_SCHEMAS":
            return None
        raise
    except Py4JJavaError as error:
        # Footers are read in tasks, whose errors come back as they are.
        if "CANNOT_MERGE_SCHEMAS" in str(error.java_exception):
            return None
        raise


def leaf_files(spark: SparkSession, paths: Sequence[str]) -> list[str]:
    """The Parquet files below some paths, by name; their contents aren't read."""
    return sorted(spark.read.schema("__none int").parquet(*paths).inputFiles())


def schema_groups(spark: SparkSession, paths: str | Sequence[str]) -> list[tuple[T.StructType, list[str]]]:
    """Files grouped so that every column has one physical type within a group.

    One job reads all footers; if they cannot be merged, the files, by name, are halved until
    they can. Neighbouring months mostly agree, so that takes a few jobs for each change of a type.
    Groups with equal types for all the columns they share come together again.
    """
    given = [paths] if isinstance(paths, str) else list(paths)
    schema = _merged_schema(spark, given)
    if schema is not None:
        return [(schema, given)]
    found: list[tuple[T.StructType, list[str]]] = []
    waiting = [leaf_files(spark, given)]
    while waiting:
        files = waiting.pop()
        schema = _merged_schema(spark, files)
        if schema is None:
            middle = len(files) // 2
            waiting += [files[middle:], files[:middle]]
            continue
        for k, (known, members) in enumerate(found):
            if (both := _together(known, schema)) is not None:
                found[k] = (both, members + files)
                break
        else:
            found.append((schema, files))
    return found


def _together(a: T.StructType, b: T.StructType) -> T.StructType | None:
    """All columns of two schemas, unless a shared one has two types."""
    types = {f.name.lower(): f.dataType for f in a.fields}
    if any(types.get(f.name.lower(), f.dataType) != f.dataType for f in b.fields):
        return None
    return T.StructType([*a.fields, *[f for f in b.fields if f.name.lower() not in types]])


def _widest(kinds: Sequence[T.DataType]) -> T.DataType:
    """The type for a column whose files disagree and that nothing declares."""
    if all(isinstance(k, T.IntegralType) for k in kinds):
        return T.LongType()
    if all(isinstance(k, T.NumericType) for k in kinds):
        return T.DoubleType()
    if all(isinstance(k, (T.TimestampType, T.TimestampNTZType, T.DateType)) for k in kinds):
        return T.TimestampNTZType()
    return T.StringType()


def read_drifting_files(
    spark: SparkSession, paths: str | Sequence[str], declared: T.StructType | None = None
) -> DataFrame:
    """Files of one service whose physical types or columns changed over time, as one table.

    Each group of files with the same types is scanned with its own schema. Only a column whose
    groups disagree is cast, to its declared type or else the widest, values that do not fit
    being NULL; filters on all others still reach every scan. A column that a group lacks
    is NULL there. Names are matched in any case and spelt as the first group has them.
    """
    groups = schema_groups(spark, paths)
    names: dict[str, str] = {}
    kinds: dict[str, list[T.DataType]] = {}
    for schema, _ in groups:
        for f in schema.fields:
            names.setdefault(f.name.lower(), f.name)
            kinds.setdefault(f.name.lower(), [])
            if f.dataType not in kinds[f.name.lower()]:
                kinds[f.name.lower()].append(f.dataType)
    wanted = {f.name.lower(): f.dataType for f in declared.fields} if declared is not None else {}
    target = T.StructType(
        [T.StructField(name, own[0] if len(own) == 1 else wanted.get(key) or _widest(own)) for (key, name), own in zip(names.items(), kinds.values(), strict=True)]
    )
    parts = []
    for schema, files in groups:
        spelt = T.StructType([T.StructField(names[f.name.lower()], f.dataType) for f in schema.fields])
        parts.append(shape.align_schema(spark.read.schema(spelt).parquet(*files), target))
    together = parts[0]
    for part in parts[1:]:
        together = together.unionByName(part)
    return together


def _table(spark: SparkSession, base: str, schema: T.StructType | None) -> DataFrame:
    """A partitioned table in a pinned schema.

    Unless it is given, that is the one all footers agree on, not one file's: columns that only some
    partitions have are kept, and a column with two types is an error.
    """
    pinned = schema if schema is not None else _merged_schema(spark, [base])
    if pinned is None:
        raise ValueError(f"the files of {base} store a column with different types: give a schema")
    return spark.read.schema(pinned).parquet(base)


def read_month_partition(
    spark: SparkSession, base: str, year: int, month: int, schema: T.StructType | None = None
) -> DataFrame:
    """One ``year=/month=`` partition; raises when it is absent or empty.

    The schema is pinned, so every file is read alike: the given one, or the one of all footers.
    """
    try:
        table = _table(spark, base, schema)
    except AnalysisException as error:
        if _is_missing(error):
            raise FileNotFoundError(f"no Parquet table at {base}") from error
        raise
    part = table.where((F.col("year") == year) & (F.col("month") == month))
    if part.isEmpty():
        raise FileNotFoundError(f"no rows for year={year}, month={month} at {base}")
    return part


def read_months(
    spark: SparkSession, base: str, first: str, last: str, schema: T.StructType | None = None
) -> DataFrame:
    """The ``year=/month=`` partitions from one ``yyyy_MM`` month to another."""
    (y0, m0), (y1, m1) = dates.parse_month(first), dates.parse_month(last)
    number = F.col("year") * 12 + F.col("month")
    table = _table(spark, base, schema)
    return table.where((number >= y0 * 12 + m0) & (number <= y1 * 12 + m1))


def read_day_partitions(
    spark: SparkSession,
    base: str,
    year: int,
    month: int,
    column: str = "partition_date",
    schema: T.StructType | None = None,
) -> DataFrame:
    """All day partitions of a month that exist."""
    token = f"{year:04d}_{month:02d}"
    return read_days(spark, base, token, token, column, schema)


def read_days(
    spark: SparkSession,
    base: str,
    first: str,
    last: str,
    column: str = "partition_date",
    schema: T.StructType | None = None,
) -> DataFrame:
    """All day partitions that exist from one ``yyyy_MM`` month to another."""
    start = dates.month_start(*dates.parse_month(first)).date()
    end = dates.month_after(*dates.parse_month(last)).date()
    day = F.col(column).cast("date")
    return _table(spark, base, schema).where((day >= F.lit(start)) & (day < F.lit(end)))


def read_partition_glob(
    spark: SparkSession, root: str, pattern: str, schema: T.StructType
) -> DataFrame:
    """Partitions whose directory matches a glob; a typed empty frame when none does."""
    try:
        return spark.read.schema(schema).option("basePath", root).parquet(f"{root}/{pattern}")
    except AnalysisException as error:
        if _is_missing(error):
            return shape.empty_frame(spark, schema)
        raise


def month_glob(column: str, year: int, month: int) -> str:
    """Glob over the day partitions of a month."""
    return f"{column}={year:04d}-{month:02d}-[0-3][0-9]"


def read_lookup(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A CSV lookup with header, quoted values and ``NULL`` literals."""
    return spark.read.schema(schema).csv(path, header=True, nullValue="NULL", quote='"', escape='"')


def load_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Typed CSV; the header must name the schema's columns, in order.

    An empty field is NULL, a quoted empty field is empty text. Spark tells them
    apart only when the text standing for NULL is not itself empty.
    """
    return (
        spark.read.schema(schema)
        .options(**CSV_OPTIONS, enforceSchema="false", mode="FAILFAST", nullValue="\u0000")
        .csv(path)
    )


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The table, or no rows of the given schema when there is none."""
    try:
        return shape.align_schema(read_drifting_files(spark, path, schema), schema)
    except AnalysisException as error:
        if _is_missing(error):
            return shape.empty_frame(spark, schema)
        raise
