"""Quality checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from curbline import fixed, schemas
from curbline.operators import clean
from curbline.operators import quality as checks
from curbline.plans import lookups, standins
from curbline.plans.queries.joining import UNIQUE_SIDES, unique_sides
from curbline.plans.queries.merging import _LOSS
from curbline.plans.queries.registry import FACT_COLUMNS, oracle, query
from curbline.session import scratch_path
from curbline.sinks import tables


def _rows(items: dict[str, str], source: str, label: str, value: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{name}' AS \"{label}\", {sql} AS {value} FROM {source}"
        for name, sql in items.items()
    )


_CHECKED = ["dwid", "fare_amount", "ratecode_id", "payment_type", "dispatching_base_num"]


@query(
    oracle(
        _rows(
            {c: f"count(*) FILTER (WHERE {c} IS NULL)" for c in _CHECKED},
            "(SELECT * FROM fact WHERE cab_type IN ('yellow', 'green'))",
            "column",
            "violations",
        ),
        "fact",
    )
)
def check_not_null(spark, sf):
    metered = F.col("cab_type").isin(fixed.METERED_SERVICES)
    return checks.check_not_null(standins.fact(spark, sf), _CHECKED, metered)


@query(
    oracle(
        "SELECT count(*) AS violations FROM (SELECT dwid FROM fact GROUP BY 1 HAVING count(*) > 1)",
        "fact",
    )
)
def check_unique(spark, sf):
    return checks.check_unique(standins.fact(spark, sf), ["dwid"])


@query(
    oracle(
        """SELECT payment_type, count(*) AS violations FROM fact
        WHERE payment_type NOT IN (1, 2, 3, 4) GROUP BY 1""",
        "fact",
    )
)
def check_accepted(spark, sf):
    return checks.check_accepted(standins.fact(spark, sf), "payment_type", [1, 2, 3, 4])


@query(
    oracle(
        """SELECT count(*) AS violations, count(DISTINCT ratecode_id) AS orphan_values FROM fact
        WHERE cab_type IN ('yellow', 'green') AND ratecode_id IS NOT NULL
            AND ratecode_id NOT IN (SELECT ratecode_id FROM rate_codes)""",
        "fact",
        "rate_codes",
    )
)
def check_relationship(spark, sf):
    return checks.check_relationship(
        standins.fact(spark, sf),
        "ratecode_id",
        lookups.rate_codes(spark),
        "ratecode_id",
        F.col("cab_type").isin(fixed.METERED_SERVICES),
    )


_RULES_SQL = {
    "pickup_zone_known": "pu_location_id IS NOT NULL",
    "dropoff_zone_known": "do_location_id IS NOT NULL",
    "distance_in_bounds": "trip_distance > 0 AND trip_distance <= 10000",
    "fare_in_bounds": "fare_amount > 0 AND fare_amount <= 100000",
    "has_passengers": "passenger_count > 0",
    "times_differ": "pickup_datetime <> dropoff_datetime",
}


@query(
    oracle(
        _rows(
            {
                name: f"count(*) FILTER (WHERE NOT coalesce({sql}, false))"
                for name, sql in _RULES_SQL.items()
            },
            "green",
            "rule",
            "violations",
        )
        + " UNION ALL SELECT 'no_duplicates', (SELECT count(*) FROM green)"
        " - (SELECT count(*) FROM (SELECT DISTINCT * FROM green))",
        "green",
    )
)
def check_ranges(spark, sf):
    return checks.check_ranges(
        standins.trips(spark, sf, "green"), clean.metered_rules(), duplicates=True
    )


@query(
    oracle(
        _rows(
            {
                name: f"count(*) FILTER (WHERE NOT coalesce({sql}, false))"
                for name, sql in {
                    "pickup_zone_known": "pu_location_id IS NOT NULL",
                    "dropoff_zone_known": "do_location_id IS NOT NULL",
                    "dropoff_after_pickup": "dropoff_datetime > pickup_datetime",
                    "flag_in_domain": "sr_flag IN (0, 1)",
                }.items()
            },
            "fhv",
            "rule",
            "violations",
        ),
        "fhv",
    )
)
def check_ranges_fhv(spark, sf):
    return checks.check_ranges(standins.trips(spark, sf, "fhv"), clean.fhv_rules())


@query(
    oracle(
        "SELECT count(*) AS row_count, 14 AS column_count, count(*) > 0 AS passed FROM fact", "fact"
    )
)
def check_not_empty(spark, sf):
    return checks.check_not_empty(standins.fact(spark, sf))


@query(
    oracle(
        """SELECT CAST(year(pickup_datetime) AS INTEGER) AS year,
            CAST(month(pickup_datetime) AS INTEGER) AS month, count(*) AS row_count
        FROM green GROUP BY 1, 2""",
        "green",
    )
)
def check_partitions(spark, sf):
    base = scratch_path(spark, "check_partitions")
    tables.overwrite_months(standins.trips(spark, sf, "green"), base)
    return checks.check_partitions(spark, base)


@query(
    """SELECT 'airport_fee' AS "column", 'missing' AS problem, 'float' AS expected, CAST(NULL AS VARCHAR) AS actual
    UNION ALL SELECT 'fare_amount', 'type', 'float', 'double'
    UNION ALL SELECT 'year', 'extra', NULL, 'int' UNION ALL SELECT 'month', 'extra', NULL, 'int'"""
)
def check_schema(spark, sf):
    """The stored schema of a written table against the expected one."""
    base = scratch_path(spark, "check_schema")
    odd = (
        standins.trips(spark, sf, "yellow")
        .drop("airport_fee")
        .withColumn("fare_amount", F.col("fare_amount").cast("double"))
    )
    tables.overwrite_months(odd, base)
    return checks.check_schema(spark.read.parquet(base), schemas.YELLOW.table_schema)


@query(
    oracle(_rows({c: f"count({c})" for c in FACT_COLUMNS}, "fact", "column", "non_null"), "fact")
)
def column_profile(spark, sf):
    return checks.column_profile(standins.fact(spark, sf))


@query(
    oracle(
        _LOSS.format(limit=10.0, rows="(SELECT pickup_datetime FROM other)"),
        "fact",
        **UNIQUE_SIDES,
    )
)
def check_loss(spark, sf):
    """A gate that lets the table through and reports its loss."""
    other = unique_sides(spark, sf)[1]
    return checks.check_loss(other, "pickup_datetime", "moderate")
