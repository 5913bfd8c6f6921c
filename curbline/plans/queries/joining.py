"""Joins with lookups and between keyed tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from curbline.operators import clean, joins
from curbline.plans import lookups, standins
from curbline.plans.queries.registry import oracle, query


@query(
    oracle(
        """SELECT f.*, p.payment_type_description FROM fact f
        LEFT JOIN payment_types p ON f.payment_type = p.payment_type_id""",
        "fact",
        "payment_types",
    )
)
def lookup_join(spark, sf):
    return joins.lookup_join(
        standins.fact(spark, sf), lookups.payment_types(spark), "payment_type", "payment_type_id"
    )


@query(
    oracle(
        """SELECT f.dwid, f.pu_location_id, f.do_location_id,
            p.borough AS borough_pickup, p.zone AS zone_pickup,
            d.borough AS borough_dropoff, d.zone AS zone_dropoff
        FROM fact f LEFT JOIN zones p ON f.pu_location_id = p.location_id
        LEFT JOIN zones d ON f.do_location_id = d.location_id""",
        "fact",
        "zones",
    )
)
def role_join(spark, sf):
    return joins.role_join(
        standins.fact(spark, sf).select("dwid", "pu_location_id", "do_location_id"),
        standins.zones(spark, sf),
        "location_id",
        {"pickup": "pu_location_id", "dropoff": "do_location_id"},
        ["borough", "zone"],
    )


UNIQUE_SIDES = {
    "truth": """SELECT dwid,
            CASE WHEN any_value(payment_type) = 3 THEN NULL ELSE min(pickup_datetime) END AS pickup_datetime,
            min(fare_amount) AS fare_amount,
            CASE WHEN count(*) = 1 THEN min(total_amount) END AS total_amount
        FROM fact WHERE cab_type = 'yellow' GROUP BY dwid""",
    "other": """SELECT dwid, min(pickup_datetime) AS pickup_datetime, max(fare_amount) AS fare_amount,
            max(total_amount) AS total_amount
        FROM fact WHERE cab_type <> 'fhv' GROUP BY dwid""",
}
# any_value differs between engines when a key has several payment types.
UNIQUE_SIDES["truth"] = UNIQUE_SIDES["truth"].replace("any_value", "min")


def unique_sides(spark, sf):
    """Two tables keyed by ``dwid`` that overlap; the first lacks some times and totals."""
    fact = standins.fact(spark, sf)
    truth = (
        fact.where(F.col("cab_type") == "yellow")
        .groupBy("dwid")
        .agg(
            F.min("pickup_datetime").alias("ts"),
            F.min("payment_type").alias("code"),
            F.min("fare_amount").alias("fare_amount"),
            F.min("total_amount").alias("total"),
            F.count(F.lit(1)).alias("n"),
        )
        .select(
            "dwid",
            F.expr("CASE WHEN code = 3 THEN NULL ELSE ts END").alias("pickup_datetime"),
            "fare_amount",
            F.expr("CASE WHEN n = 1 THEN total END").alias("total_amount"),
        )
    )
    other = (
        fact.where(F.col("cab_type") != "fhv")
        .groupBy("dwid")
        .agg(
            F.min("pickup_datetime").alias("pickup_datetime"),
            F.max("fare_amount").alias("fare_amount"),
            F.max("total_amount").alias("total_amount"),
        )
    )
    return truth, other


_SIDE_COLUMNS = ["dwid", "pickup_datetime", "fare_amount", "total_amount"]
_FULL = oracle(
    "SELECT "
    + ", ".join(f"t.{c} AS lh_{c}" for c in _SIDE_COLUMNS)
    + ", "
    + ", ".join(f"o.{c} AS st_{c}" for c in _SIDE_COLUMNS)
    + " FROM truth t FULL JOIN other o ON t.dwid = o.dwid",
    "fact",
    **UNIQUE_SIDES,
)


@query(_FULL)
def full_join(spark, sf):
    return joins.salted_full_join(*unique_sides(spark, sf), "dwid")


@query(_FULL)
def salted_full_join(spark, sf):
    return joins.salted_full_join(*unique_sides(spark, sf), "dwid", buckets=4)


@query(
    oracle(
        """SELECT * FROM fact WHERE pu_location_id IS NOT NULL
            AND pu_location_id NOT IN (SELECT location_id FROM zones)""",
        "fact",
        "zones",
    )
)
def orphans(spark, sf):
    return joins.orphans(
        standins.fact(spark, sf), standins.zones(spark, sf), "pu_location_id", "location_id"
    )


@query(
    oracle("SELECT * FROM fact WHERE pu_location_id IN (SELECT location_id FROM zones)", "fact", "zones")
)
def matched(spark, sf):
    return joins.matched(
        standins.fact(spark, sf), standins.zones(spark, sf), "pu_location_id", "location_id"
    )


@query(
    oracle(
        """SELECT 'filled' AS input, * FROM fact
        UNION ALL BY NAME SELECT 'empty' AS input, CAST(NULL AS VARCHAR) AS dwid, 'fhv' AS cab_type""",
        "fact",
    )
)
def empty_guard(spark, sf):
    fact = standins.fact(spark, sf)
    none = clean.in_month(fact, "pickup_datetime", 1970, 1)
    filled = joins.empty_guard(fact, {"cab_type": "fhv"})
    empty = joins.empty_guard(none, {"cab_type": "fhv"})
    return filled.select(F.lit("filled").alias("input"), "*").unionByName(
        empty.select(F.lit("empty").alias("input"), "*")
    )
