"""Duplicates, keys and idempotent inserts."""

from __future__ import annotations

from pyspark.sql import functions as F

from curbline import fixed
from curbline.operators import keys, summaries
from curbline.plans import standins
from curbline.plans.queries.registry import (
    FACT_COLUMNS,
    YELLOW_COLUMNS,
    first_rows,
    oracle,
    query,
)

@query(oracle("SELECT DISTINCT * FROM yellow", "yellow"))
def distinct_rows(spark, sf):
    return keys.distinct_rows(standins.trips(spark, sf, "yellow"))


@query(oracle(first_rows("yellow", fixed.TRIP_KEY, YELLOW_COLUMNS), "yellow"))
def dedup_by_key(spark, sf):
    return keys.dedup_by_key(standins.trips(spark, sf, "yellow"))


@query(
    oracle(first_rows("fact", fixed.PRIMARY_KEY, FACT_COLUMNS, ["cab_type"]), "fact")
)
def distinct_on(spark, sf):
    return keys.distinct_on(standins.fact(spark, sf), fixed.PRIMARY_KEY, ["cab_type"])


@query(oracle("SELECT * FROM yellow_keyed", "yellow_keyed"))
def add_row_key(spark, sf):
    return keys.add_row_key(standins.trips(spark, sf, "yellow"))


@query(
    oracle(
        f"SELECT {', '.join(fixed.TRIP_KEY)}, count(*) AS count FROM fact"
        f" GROUP BY ALL HAVING count(*) > 1",
        "fact",
    )
)
def duplicate_report(spark, sf):
    return keys.duplicate_report(standins.fact(spark, sf), fixed.TRIP_KEY)


_NEW = first_rows("fact", fixed.PRIMARY_KEY, FACT_COLUMNS)


@query(
    oracle(
        """SELECT * FROM target UNION ALL
        SELECT * FROM fresh f WHERE NOT EXISTS (SELECT 1 FROM target t WHERE t.dwid = f.dwid
            AND t.pickup_datetime = f.pickup_datetime AND t.dropoff_datetime = f.dropoff_datetime)""",
        "fact",
        target="SELECT * FROM fact WHERE cab_type = 'yellow'",
        fresh=_NEW,
    )
)
def insert_if_absent(spark, sf):
    fact = standins.fact(spark, sf)
    return keys.insert_if_absent(
        fact.where(F.col("cab_type") == "yellow"), fact, fixed.PRIMARY_KEY
    )


@query(
    oracle(
        """SELECT count(DISTINCT dwid) AS distinct_keys, count(*) AS total_rows,
            count(DISTINCT dwid) = count(*) AS is_unique FROM fact""",
        "fact",
    )
)
def key_uniqueness(spark, sf):
    return summaries.key_uniqueness(standins.fact(spark, sf), "dwid")
