"""Lookup tables as inline rows, whose size Spark knows when it plans a join."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from curbline import fixed, schemas


def _literal(value: object) -> str:
    if isinstance(value, bool):
        return "true" if value else "false"
    if isinstance(value, str):
        return "'" + value.replace("'", "\\'") + "'"
    return str(value)


def inline(spark: SparkSession, rows: Sequence[tuple], schema: T.StructType) -> DataFrame:
    """Rows as an inline table."""
    values = ", ".join("(" + ", ".join(_literal(v) for v in row) + ")" for row in rows)
    names = ", ".join(schema.names)
    return spark.sql(f"SELECT * FROM VALUES {values} AS t({names})").to(schema)


def vendors(spark: SparkSession) -> DataFrame:
    return inline(spark, fixed.VENDORS, schemas.VENDOR)


def payment_types(spark: SparkSession) -> DataFrame:
    return inline(spark, fixed.PAYMENT_TYPES, schemas.PAYMENT_TYPE)


def rate_codes(spark: SparkSession) -> DataFrame:
    return inline(spark, fixed.RATE_CODE_NAMES, schemas.RATE_CODE)


def holidays(spark: SparkSession) -> DataFrame:
    return inline(spark, fixed.HOLIDAYS, schemas.HOLIDAY)
