"""Projections: casts, names, order and schema alignment."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from curbline import schemas


def empty_frame(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """No rows, typed; the optimizer drops it from any union."""
    return (
        spark.range(1)
        .where(F.lit(False))
        .select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields])
    )


def _as(found: T.StructField, wanted: T.DataType) -> Column:
    """A column in the wanted type; unchanged, and so still NOT NULL, if it has it."""
    column = F.col(found.name)
    return column if found.dataType == wanted else column.try_cast(wanted).alias(found.name)


def cast_to_schema(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Cast the declared columns that exist; a value that does not fit is NULL."""
    types = {f.name: f.dataType for f in schema.fields}
    return df.select(*[_as(f, types.get(f.name, f.dataType)) for f in df.schema.fields])


def rename_columns(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Rename the columns that exist, in whatever case the file spells them."""
    wanted = {old.lower(): new for old, new in mapping.items()}
    return df.select(*[F.col(c).alias(wanted.get(c.lower(), c)) for c in df.columns])


def drop_columns(df: DataFrame, *names: str) -> DataFrame:
    """Drop the columns that exist."""
    return df.drop(*names)


def move_first(df: DataFrame, name: str) -> DataFrame:
    """Put one column first, keeping the order of the rest."""
    return df.select(name, *[c for c in df.columns if c != name])


def add_year_month(df: DataFrame, ts_col: str = "pickup_datetime") -> DataFrame:
    """Integer ``year`` and ``month`` of a timestamp."""
    return df.withColumns({"year": F.year(ts_col), "month": F.month(ts_col)})


def normalize_names(df: DataFrame) -> DataFrame:
    """Lower-case column names with ``_`` for spaces."""
    return df.toDF(*[c.strip().lower().replace(" ", "_") for c in df.columns])


def rename_positional(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Name the columns by position; the width must agree."""
    if len(names) != len(df.columns):
        raise ValueError(f"{len(df.columns)} columns found, {len(names)} expected: {df.columns}")
    return df.toDF(*names)


def prefix_columns(df: DataFrame, prefix: str) -> DataFrame:
    """Prefix every column name."""
    return df.select(*[F.col(c).alias(prefix + c) for c in df.columns])


def align_schema(df: DataFrame, target: T.StructType) -> DataFrame:
    """The target's columns by name: missing ones NULL, extra ones dropped."""
    found = {f.name: f for f in df.schema.fields}
    return df.select(
        *[
            _as(found[f.name], f.dataType)
            if f.name in found
            else F.lit(None).cast(f.dataType).alias(f.name)
            for f in target.fields
        ]
    )


def conform_to_fact(df: DataFrame, service: schemas.Service | str) -> DataFrame:
    """One service's keyed trips in the fact schema.

    Fields the service does not record become typed NULLs.
    """
    name = service if isinstance(service, str) else service.name
    return align_schema(df.withColumn("cab_type", F.lit(name)), schemas.FACT)
