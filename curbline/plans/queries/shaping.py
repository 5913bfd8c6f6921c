"""Projections, unions and limits."""

from __future__ import annotations

from pyspark.sql import functions as F

from curbline import fixed, schemas
from curbline.operators import sets, shape
from curbline.plans import standins
from curbline.plans.queries.registry import (
    FACT_COLUMNS,
    FHV_COLUMNS,
    GREEN_COLUMNS,
    YELLOW_COLUMNS,
    oracle,
    query,
)


def _as_file_names(columns, renames, source, casts=()):
    back = {new: old for old, new in renames.items()}
    items = [f'{c} AS "{back.get(c, c)}"' for c in columns]
    return oracle(f"SELECT {', '.join(items)} FROM {source}", source)


@query(_as_file_names(YELLOW_COLUMNS, fixed.YELLOW_RENAMES, "yellow"))
def cast_to_schema(spark, sf):
    return shape.cast_to_schema(standins.raw_yellow(spark, sf), schemas.YELLOW.file_schema)


@query(oracle(f"SELECT {', '.join(YELLOW_COLUMNS)} FROM yellow", "yellow"))
def rename_columns(spark, sf):
    cast = shape.cast_to_schema(standins.raw_yellow(spark, sf), schemas.YELLOW.file_schema)
    return shape.rename_columns(cast, schemas.YELLOW.renames)


@query(oracle(f"SELECT {', '.join(GREEN_COLUMNS)} FROM green", "green"))
def drop_columns(spark, sf):
    profile = schemas.GREEN
    return (
        shape.drop_columns(standins.raw_green(spark, sf), *profile.drops, "no_such_column")
        .transform(shape.cast_to_schema, profile.file_schema)
        .transform(shape.rename_columns, profile.renames)
    )


@query(oracle("SELECT dwid, pickup_datetime, dropoff_datetime FROM fhv_keyed", "fhv_keyed"))
def move_first(spark, sf):
    trips = standins.keyed(spark, sf, "fhv").select("pickup_datetime", "dropoff_datetime", "dwid")
    return shape.move_first(trips, "dwid")


@query(
    oracle(
        "SELECT *, CAST(year(pickup_datetime) AS INTEGER) AS year,"
        " CAST(month(pickup_datetime) AS INTEGER) AS month FROM green",
        "green",
    )
)
def add_year_month(spark, sf):
    return shape.add_year_month(standins.trips(spark, sf, "green"))


@query(
    """SELECT event_id AS event_id, event_type AS event_type, ts AS event_time FROM events"""
)
def normalize_names(spark, sf):
    odd = standins.table(spark, sf, "events").selectExpr(
        "event_id AS `Event ID`", "event_type AS `EVENT Type`", "ts AS `Event Time`"
    )
    return shape.normalize_names(odd)


@query("SELECT o_orderkey AS trip, o_custkey AS rider, o_orderdate AS pickup_datetime FROM orders")
def rename_positional(spark, sf):
    orders = standins.table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    return shape.rename_positional(orders, ["trip", "rider", "pickup_datetime"])


@query(oracle("SELECT * FROM fact", "fact"))
def conform_to_fact(spark, sf):
    return standins.fact(spark, sf)


@query(
    oracle(
        "SELECT CAST(NULL AS VARCHAR) AS dwid, CAST(NULL AS VARCHAR) AS cab_type, "
        + ", ".join(
            f"CAST(NULL AS {'FLOAT' if kind == 'float' else 'INTEGER'}) AS {c}"
            if c not in FHV_COLUMNS
            else c
            for c, kind in fixed.FACT_COLUMNS[2:]
        )
        + " FROM fhv",
        "fhv",
    )
)
def align_schema(spark, sf):
    return shape.align_schema(standins.trips(spark, sf, "fhv"), schemas.FACT)


@query(
    oracle(
        f"SELECT {', '.join(f'{c} AS st_{c}' for c in FHV_COLUMNS)} FROM fhv",
        "fhv",
    )
)
def prefix_columns(spark, sf):
    return shape.prefix_columns(standins.trips(spark, sf, "fhv"), "st_")


@query(oracle(f"SELECT {', '.join(FACT_COLUMNS)} FROM fact", "fact"))
def union_services(spark, sf):
    return sets.union_services(
        [standins.fact_part(spark, sf, name) for name in fixed.SERVICES]
    )


@query(
    oracle(
        """SELECT CAST(vendor_id AS INTEGER) AS vendor_id, CAST(pu_location_id AS INTEGER) AS pu_location_id,
            pickup_datetime, fare_amount FROM
        (SELECT vendor_id, pu_location_id, pickup_datetime, fare_amount FROM yellow
        UNION ALL SELECT 0, coalesce(pu_location_id, 0), pickup_datetime, NULL FROM fhv)""",
        "yellow",
        "fhv",
    )
)
def union_nonempty(spark, sf):
    wanted = [f for f in schemas.FACT.fields if f.name in _UNION_COLUMNS]
    yellow = standins.trips(spark, sf, "yellow")
    nothing = shape.empty_frame(spark, standins.trips(spark, sf, "green").schema)
    return sets.union_nonempty(
        [yellow, nothing, standins.trips(spark, sf, "fhv")],
        type(schemas.FACT)(wanted),
        ["vendor_id", "pu_location_id"],
    )


_UNION_COLUMNS = ("vendor_id", "pu_location_id", "pickup_datetime", "fare_amount")


@query(oracle("SELECT * FROM fact WHERE cab_type <> 'green'", "fact"))
def select_sources(spark, sf):
    parts = {name: standins.fact_part(spark, sf, name) for name in fixed.SERVICES}
    return sets.union_services(list(sets.select_sources(parts, ["yellow", "fhv"]).values()))


@query(oracle("SELECT DISTINCT CAST(year(pickup_datetime) AS INTEGER) AS year FROM fact", "fact"))
def distinct_years(spark, sf):
    return sets.distinct_years(standins.fact(spark, sf))


@query("SELECT DISTINCT c_mktsegment FROM customer")
def unique_values(spark, sf):
    return sets.unique_values(standins.table(spark, sf, "customer"), "c_mktsegment")


_PER_CUSTOMER = "SELECT c_nationkey, count(*) AS total_trips FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1"


def _per_nation(spark, sf):
    joined = standins.table(spark, sf, "orders").join(
        standins.table(spark, sf, "customer"), F.expr("o_custkey = c_custkey")
    )
    return joined.groupBy("c_nationkey").agg(F.count(F.lit(1)).alias("total_trips"))


@query(f"{_PER_CUSTOMER} ORDER BY total_trips DESC, c_nationkey DESC")
def order_summary(spark, sf):
    return sets.order_summary(_per_nation(spark, sf), ["total_trips", "c_nationkey"], descending=True)


@query(f"{_PER_CUSTOMER} ORDER BY total_trips DESC, c_nationkey LIMIT 5")
def top_k(spark, sf):
    return sets.top_k(_per_nation(spark, sf), "total_trips", 5, ["c_nationkey"])


_ORDER = ", ".join(f"{c} NULLS FIRST" for c in ["pickup_datetime", *FACT_COLUMNS])


@query(
    oracle(
        " UNION ALL ".join(
            f"(SELECT * FROM fact WHERE cab_type = '{s}' ORDER BY {_ORDER} LIMIT 10000)"
            for s in fixed.SERVICES
        ),
        "fact",
    )
)
def limit_each(spark, sf):
    """The first 10,000 trips of each service, as the reports sample them."""
    parts = [standins.fact_part(spark, sf, name) for name in fixed.SERVICES]
    order = ["pickup_datetime", *FACT_COLUMNS]
    return sets.limit_each(parts, 10000, order, F.to_date("pickup_datetime"))
