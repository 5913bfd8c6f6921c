"""Schemas as ``StructType``s, and one profile per service."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

from curbline import fixed

_TYPES: dict[str, T.DataType] = {
    "int": T.IntegerType(),
    "float": T.FloatType(),
    "double": T.DoubleType(),
    "string": T.StringType(),
    "boolean": T.BooleanType(),
    "timestamp": T.TimestampNTZType(),
}


def struct(columns: list[tuple[str, str]]) -> T.StructType:
    """A nullable ``StructType`` from ``(name, short type)`` pairs."""
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in columns])


@dataclass(frozen=True)
class Service:
    """What differs between services before they share the fact schema."""

    name: str
    file_schema: T.StructType
    renames: dict[str, str]
    drops: tuple[str, ...] = ()

    @property
    def table_schema(self) -> T.StructType:
        return T.StructType(
            [
                T.StructField(self.renames.get(f.name, f.name), f.dataType)
                for f in self.file_schema.fields
            ]
        )


YELLOW = Service("yellow", struct(fixed.YELLOW_FILE_COLUMNS), fixed.YELLOW_RENAMES)
GREEN = Service(
    "green", struct(fixed.GREEN_FILE_COLUMNS), fixed.GREEN_RENAMES, drops=("ehail_fee",)
)
FHV = Service("fhv", struct(fixed.FHV_FILE_COLUMNS), fixed.FHV_RENAMES)
SERVICES = {s.name: s for s in (YELLOW, GREEN, FHV)}

FACT = struct(fixed.FACT_COLUMNS)

VENDOR = struct([("vendor_id", "int"), ("vendor_name", "string")])
PAYMENT_TYPE = struct([("payment_type_id", "int"), ("payment_type_description", "string")])
RATE_CODE = struct([("ratecode_id", "int"), ("rate_code_description", "string")])
HOLIDAY = struct(
    [
        ("holiday_id", "int"),
        ("holiday_name", "string"),
        ("month", "int"),
        ("day_or_rule", "string"),
        ("holiday_type", "string"),
        ("nyc_observance", "boolean"),
    ]
)
ZONE = struct(
    [
        ("location_id", "int"),
        ("borough", "string"),
        ("zone", "string"),
        ("service_zone", "string"),
        ("latitude", "double"),
        ("longitude", "double"),
        ("geolocation", "string"),
    ]
)
