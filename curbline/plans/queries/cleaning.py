"""Filters and value cleaning."""

from __future__ import annotations

import functools
from datetime import date, datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curbline import fixed
from curbline.operators import clean
from curbline.plans import standins
from curbline.plans.queries.registry import FHV_COLUMNS, oracle, query


@query(
    oracle(
        "SELECT * FROM yellow WHERE pickup_datetime >= TIMESTAMP '1997-12-01'"
        " AND pickup_datetime < TIMESTAMP '1998-01-01'",
        "yellow",
    )
)
def in_month(spark, sf):
    return clean.in_month(standins.trips(spark, sf, "yellow"), "pickup_datetime", 1997, 12)


@query(oracle("SELECT * FROM fhv WHERE CAST(pickup_datetime AS DATE) = DATE '2024-01-15'", "fhv"))
def in_day(spark, sf):
    return clean.in_day(standins.trips(spark, sf, "fhv"), "pickup_datetime", date(2024, 1, 15))


@query(oracle("SELECT * FROM yellow WHERE strftime(pickup_datetime, '%Y_%m') <> '1997_12'", "yellow"))
def delete_month(spark, sf):
    return clean.delete_month(standins.trips(spark, sf, "yellow"), "pickup_datetime", "1997_12")


@query(
    oracle("SELECT * FROM fhv WHERE pu_location_id IS NOT NULL AND do_location_id IS NOT NULL", "fhv")
)
def drop_null_keys(spark, sf):
    return clean.drop_null_keys(
        standins.trips(spark, sf, "fhv"), ["pu_location_id", "do_location_id"]
    )


@query(
    oracle(
        "SELECT * FROM fhv WHERE "
        + " AND ".join(f"{c} IS NOT NULL" for c in FHV_COLUMNS if c != "sr_flag"),
        "fhv",
    )
)
def drop_any_null(spark, sf):
    return clean.drop_any_null(standins.trips(spark, sf, "fhv"), ["sr_flag"])


@query(oracle("SELECT * FROM green WHERE fare_amount > 0 AND fare_amount <= 100000", "green"))
def in_bounds(spark, sf):
    return clean.in_bounds(
        standins.trips(spark, sf, "green"), "fare_amount", 0, fixed.MAX_FARE_AMOUNT
    )


@query(
    oracle(
        "SELECT 'differs' AS mode, * FROM green WHERE pickup_datetime <> dropoff_datetime"
        " UNION ALL SELECT 'ordered' AS mode, * FROM green WHERE dropoff_datetime > pickup_datetime",
        "green",
    )
)
def valid_interval(spark, sf):
    trips = standins.trips(spark, sf, "green")
    parts = [
        clean.valid_interval(trips, "pickup_datetime", "dropoff_datetime", mode).select(
            F.lit(mode).alias("mode"), "*"
        )
        for mode in ("differs", "ordered")
    ]
    return parts[0].unionByName(parts[1])


@query(oracle("SELECT * FROM fhv WHERE sr_flag IN (0, 1)", "fhv"))
def in_domain(spark, sf):
    return clean.in_domain(standins.trips(spark, sf, "fhv"), "sr_flag", fixed.SR_FLAGS)


@query(
    oracle(
        """SELECT * REPLACE (coalesce(sr_flag, 0) AS sr_flag,
            coalesce(pu_location_id, 0) AS pu_location_id,
            coalesce(affiliated_base_number, 'UNKNOWN') AS affiliated_base_number) FROM fhv""",
        "fhv",
    )
)
def fill_defaults(spark, sf):
    return clean.fill_defaults(
        standins.trips(spark, sf, "fhv"),
        {
            "sr_flag": 0,
            "pu_location_id": fixed.UNKNOWN_LOCATION,
            "affiliated_base_number": fixed.UNKNOWN_BASE,
        },
    )


@query(
    """SELECT event_id,
        coalesce(CAST(trunc(TRY_CAST(CAST(value AS VARCHAR) AS DOUBLE)) AS BIGINT), 0) AS value_text,
        coalesce(CAST(trunc(TRY_CAST(event_type AS DOUBLE)) AS BIGINT), 0) AS event_type,
        coalesce(CAST(trunc(TRY_CAST(CASE WHEN user_id % 3 = 0 THEN '' ELSE user_id || '.0' END AS DOUBLE))
            AS BIGINT), 0) AS user_text
    FROM events"""
)
def coerce_int(spark, sf):
    odd = standins.table(spark, sf, "events").selectExpr(
        "event_id",
        "CAST(value AS STRING) AS value_text",
        "event_type",
        "CASE WHEN user_id % 3 = 0 THEN '' ELSE concat(user_id, '.0') END AS user_text",
    )
    return clean.coerce_int(odd, ["value_text", "event_type", "user_text"])


@query(
    oracle(
        """SELECT * REPLACE (
            CASE WHEN ratecode_id IN (1, 2, 3, 4, 5, 6) THEN ratecode_id END AS ratecode_id,
            CASE WHEN vendor_id IN (1, 2) THEN vendor_id END AS vendor_id) FROM yellow""",
        "yellow",
    )
)
def invalidate_codes(spark, sf):
    trips = standins.trips(spark, sf, "yellow")
    return clean.invalidate_codes(trips, "ratecode_id", fixed.RATE_CODES).transform(
        clean.invalidate_codes, "vendor_id", fixed.VENDOR_CODES
    )


@query(
    oracle(
        """SELECT * REPLACE (coalesce(nullif(trim(affiliated_base_number), ''), 'UNKNOWN')
            AS affiliated_base_number) FROM fhv""",
        "fhv",
    )
)
def blank_to_default(spark, sf):
    return clean.blank_to_default(
        standins.trips(spark, sf, "fhv"), "affiliated_base_number", fixed.UNKNOWN_BASE
    )


@query(
    oracle(
        """SELECT 'source' AS fact, count(*) AS n FROM fhv UNION ALL SELECT 'everything', count(*) FROM fhv
        UNION ALL SELECT 'strays', 0 UNION ALL SELECT 'drawn', least(1000, count(*)) FROM fhv
        UNION ALL SELECT 'drawn ' || strftime(pickup_datetime, '%Y_%m_%d'), least(40, count(*)) FROM fhv GROUP BY 1""",
        "fhv",
    )
)
def sample_to(spark, sf):
    """What holds for 1,000 trips drawn from all, and 40 of each day: none is foreign or drawn twice, no draw is short."""
    trips = standins.trips(spark, sf, "fhv")
    drawn = clean.sample_to(trips, 1000, seed=7)
    size = F.count(F.lit(1))
    parts = {
        "source": trips.agg(size.alias("n")),
        "everything": clean.sample_to(trips, 0).agg(size.alias("n")),
        "strays": drawn.exceptAll(trips).agg(size.alias("n")),
        "drawn": drawn.agg(size.alias("n")),
    }
    labelled = [part.select(F.lit(name).alias("fact"), "n") for name, part in parts.items()]
    day = F.date_format("pickup_datetime", "yyyy_MM_dd")
    each = clean.sample_each(trips, 40, day, seed=7).groupBy(F.concat(F.lit("drawn "), day).alias("fact")).agg(size.alias("n"))
    return functools.reduce(DataFrame.unionByName, [*labelled, each])


@query(
    oracle(
        """SELECT * FROM yellow WHERE pickup_datetime >
            (SELECT max(pickup_datetime) FROM green WHERE pickup_datetime < TIMESTAMP '2000-01-01')""",
        "yellow",
        "green",
    )
)
def since_high_watermark(spark, sf):
    loaded = clean.in_range(
        standins.trips(spark, sf, "green"),
        "pickup_datetime",
        datetime(1900, 1, 1),
        datetime(2000, 1, 1),
    )
    return clean.since_high_watermark(
        standins.trips(spark, sf, "yellow"), loaded, "pickup_datetime"
    )


@query(oracle("SELECT * REPLACE (store_and_fwd_flag[1:1] AS store_and_fwd_flag) FROM yellow", "yellow"))
def truncate_text(spark, sf):
    return clean.truncate_text(standins.trips(spark, sf, "yellow"), "store_and_fwd_flag", 1)


_METERED = """SELECT * REPLACE (store_and_fwd_flag[1:1] AS store_and_fwd_flag)
    FROM (SELECT DISTINCT * FROM {0})
    WHERE pu_location_id IS NOT NULL AND do_location_id IS NOT NULL
        AND trip_distance > 0 AND trip_distance <= 10000
        AND fare_amount > 0 AND fare_amount <= 100000
        AND passenger_count > 0 AND pickup_datetime <> dropoff_datetime"""

CLEAN_YELLOW = _METERED.format("yellow")
CLEAN_GREEN = _METERED.format("green")
CLEAN_FHV = """SELECT DISTINCT * FROM (SELECT * REPLACE (coalesce(sr_flag, 0) AS sr_flag) FROM fhv)
    WHERE pu_location_id IS NOT NULL AND do_location_id IS NOT NULL
        AND dropoff_datetime > pickup_datetime AND sr_flag IN (0, 1)"""


@query(oracle(CLEAN_YELLOW, "yellow"))
def clean_trips_yellow(spark, sf):
    return clean.clean_trips(standins.trips(spark, sf, "yellow"), "yellow")


@query(oracle(CLEAN_GREEN, "green"))
def clean_trips_green(spark, sf):
    return clean.clean_trips(standins.trips(spark, sf, "green"), "green")


@query(oracle(CLEAN_FHV, "fhv"))
def clean_trips_fhv(spark, sf):
    return clean.clean_trips(standins.trips(spark, sf, "fhv"), "fhv")


