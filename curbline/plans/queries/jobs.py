"""Whole jobs over the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from curbline import fixed
from curbline.operators import keys
from curbline.plans import jobs, standins
from curbline.plans.queries import cleaning
from curbline.plans.queries.registry import (
    FACT_COLUMNS,
    FHV_COLUMNS,
    GREEN_COLUMNS,
    YELLOW_COLUMNS,
    first_rows,
    oracle,
    query,
)
from curbline.plans.queries.storage import _YM, drifting_green
from curbline.plans.queries.calendars import TIME
from curbline.plans.queries.summarising import DAILY, FLOW, MONTHLY, PAYMENT, PIVOT, RATE_CODE, REGIONS, VENDOR, zone_summary
from curbline.session import scratch_path
from curbline.sinks import tables

# Months that hold every row of the test tables.
FIRST, LAST = "1990_01", "2030_12"

_KEY = (
    "substr(sha256(concat_ws('_', "
    + ", ".join(f"CAST({c} AS VARCHAR)" for c in fixed.TRIP_KEY)
    + ")), 1, 16) AS dwid"
)


def _lake(spark) -> jobs.Lake:
    return jobs.Lake(scratch_path(spark, "lake"))


def _landed(spark, sf, service) -> str:
    path = scratch_path(spark, f"landed_{service}")
    standins.raw(spark, sf, service).write.parquet(path)
    return path


def _dev(spark, sf, service, lake):
    return jobs.backfill(
        jobs.ingest_dev,
        FIRST,
        LAST,
        spark=spark,
        paths=_landed(spark, sf, service),
        service=service,
        lake=lake,
    )


@query(oracle(f"SELECT *, {_YM} FROM ({cleaning.CLEAN_YELLOW})", "yellow"))
def job_ingest_dev(spark, sf):
    return _dev(spark, sf, "yellow", _lake(spark))


def _staged(cleaned: str, columns: list[str]) -> dict[str, str]:
    return {"cleaned": cleaned, "staged": first_rows("cleaned", fixed.TRIP_KEY, columns)}


@query(
    oracle(
        f"SELECT {_KEY}, *, {_YM} FROM staged",
        "green",
        **_staged(f"SELECT DISTINCT * FROM ({cleaning.CLEAN_GREEN})", GREEN_COLUMNS),
    )
)
def job_load_stage(spark, sf):
    lake = _lake(spark)
    _dev(spark, sf, "green", lake)
    jobs.load_stage(spark, "green", FIRST, LAST, lake, overwrite=True)
    # Loading the same months again changes nothing.
    return jobs.load_stage(spark, "green", FIRST, LAST, lake)


@query(
    oracle(
        f"SELECT {_KEY}, *, {_YM} FROM staged",
        "yellow",
        **_staged(f"SELECT DISTINCT * FROM ({cleaning.CLEAN_YELLOW})", YELLOW_COLUMNS),
    )
)
def job_load_stage_yellow(spark, sf):
    lake = _lake(spark)
    _dev(spark, sf, "yellow", lake)
    return jobs.load_stage(spark, "yellow", FIRST, LAST, lake)


_FHV_STAGED = _staged(cleaning.CLEAN_FHV, FHV_COLUMNS)


def _fhv_days(spark, sf, lake):
    _dev(spark, sf, "fhv", lake)
    jobs.load_stage(spark, "fhv", FIRST, LAST, lake, overwrite=True)
    return jobs.publish_lakehouse(spark, "fhv", FIRST, LAST, lake)


@query(
    oracle(
        f"SELECT {_KEY}, *, CAST(pickup_datetime AS DATE) AS partition_date FROM staged",
        "fhv",
        **_FHV_STAGED,
    )
)
def job_publish_lakehouse(spark, sf):
    return _fhv_days(spark, sf, _lake(spark))


@query(
    oracle(
        f"SELECT {_KEY}, *, {_YM} FROM staged WHERE "
        + " AND ".join(f"{c} IS NOT NULL" for c in FHV_COLUMNS if c != "affiliated_base_number"),
        "fhv",
        **_FHV_STAGED,
    )
)
def job_publish_production(spark, sf):
    lake = _lake(spark)
    _fhv_days(spark, sf, lake)
    return jobs.publish_production(
        spark, "fhv", FIRST, LAST, lake, "very_strict", ["affiliated_base_number"]
    )


@query(
    oracle(
        f"SELECT {_KEY}, *, {_YM} FROM staged WHERE "
        + " AND ".join(f"{c} IS NOT NULL" for c in FHV_COLUMNS if c != "affiliated_base_number"),
        "fhv",
        cleaned=f"SELECT * FROM ({cleaning.CLEAN_FHV}) WHERE day(pickup_datetime) % 2 = 0",
        staged=first_rows("cleaned", fixed.TRIP_KEY, FHV_COLUMNS),
    )
)
def job_republish_after_removal(spark, sf):
    """All days are published, then a load without the odd days replaces them."""
    lake, path = _lake(spark), scratch_path(spark, "landed_even")
    trips = standins.raw(spark, sf, "fhv")
    trips.where(F.day("pickup_datetime") % 2 == 0).write.parquet(path)
    for landed in (_landed(spark, sf, "fhv"), path):
        jobs.ingest_dev(spark, landed, "fhv", FIRST, LAST, lake)
        jobs.load_stage(spark, "fhv", FIRST, LAST, lake, overwrite=True)
        jobs.publish_lakehouse(spark, "fhv", FIRST, LAST, lake)
        found = jobs.publish_production(
            spark, "fhv", FIRST, LAST, lake, "very_strict", ["affiliated_base_number"], overwrite=True
        )
    return found


def _clean_fact(source: str = "fact") -> str:
    base = """CASE WHEN cab_type = 'fhv' THEN coalesce(nullif(trim({0}), ''), 'UNKNOWN') ELSE {0} END AS {0}"""
    return f"""SELECT * REPLACE (
        CASE WHEN ratecode_id IN (1, 2, 3, 4, 5, 6) THEN ratecode_id END AS ratecode_id,
        CASE WHEN vendor_id IN (1, 2) THEN vendor_id END AS vendor_id,
        coalesce(payment_type, 5) AS payment_type,
        {base.format('dispatching_base_num')}, {base.format('affiliated_base_number')}) FROM {source}"""


@query(
    oracle(
        f"SELECT *, {_YM} FROM ("
        + first_rows("coded", fixed.PRIMARY_KEY, FACT_COLUMNS, ["cab_type"])
        + ")",
        "fact",
        coded=_clean_fact(),
    )
)
def job_build_fact(spark, sf):
    lake = _lake(spark)
    for service in fixed.SERVICES:
        tables.overwrite_months(
            standins.keyed(spark, sf, service), lake.zone("production", service)
        )
    return jobs.build_fact(spark, FIRST, LAST, lake)


#: For each summary the texts that name a row, and its numbers.
_OUTPUTS = {
    "payment_summary": (PAYMENT, ["payment_type_description"], ["total_trips", "total_fare", "avg_total_amount", "green_cab_trips"]),
    "rate_code_summary": (RATE_CODE, ["rate_code_description"], ["total_trips", "avg_fare", "avg_distance", "yellow_cab_trips"]),
    "vendor_summary": (VENDOR, ["vendor_name", "cab_type"], ["total_trips", "total_fare", "avg_fare", "avg_distance"]),
    "monthly_service_counts": (MONTHLY, ["cab_type"], ["year", "month", "total_trips"]),
    "daily_summary": (DAILY, ["holiday_name"], ["year", "month", "day", "total_trips", "total_fare", "total_distance", "avg_total_amount"]),
    "pickup_zone_summary": (zone_summary("pu_location_id", "pickup"), ["borough_pickup", "zone_pickup"], ["pu_location_id", "total_trips", "avg_fare", "avg_distance"]),
    "dropoff_zone_summary": (zone_summary("do_location_id", "dropoff"), ["borough_dropoff", "zone_dropoff"], ["do_location_id", "total_trips", "avg_fare", "avg_distance"]),
    "flow_matrix": (FLOW.format(fact="fact"), ["borough_pickup", "borough_dropoff"], ["total_trips"]),
    "flow_pivot": (PIVOT, ["borough_pickup"], [f'"{r}"' for r in REGIONS]),
    "time_dimension": (
        TIME,
        ["day_name"],
        ["year", "month", "day", "day_of_week", "quarter", "CAST(is_weekend AS INT)", "CAST(holiday_flag AS INT)"],
    ),
}


def _one_table(sources: dict[str, str], quote: str) -> str:
    """All summaries as rows of two texts and up to seven numbers; equal rows are counted."""
    arms = []
    for name, (_, texts, numbers) in _OUTPUTS.items():
        labels = [*texts, *["NULL"] * (2 - len(texts))]
        values = [f"CAST({n.replace(chr(34), quote)} AS DOUBLE)" for n in numbers] + ["NULL"] * (7 - len(numbers))
        columns = [f"CAST({c} AS STRING) AS label{k}" for k, c in enumerate(labels)]
        columns += [f"CAST({c} AS DOUBLE) AS n{k}" for k, c in enumerate(values)]
        arms.append(f"SELECT '{name}' AS summary, {', '.join(columns)} FROM {sources[name]}")
    return f"SELECT *, count(*) AS copies FROM ({' UNION ALL '.join(arms)}) GROUP BY ALL"


_TEN = _one_table({name: f"({sql})" for name, (sql, *_) in _OUTPUTS.items()}, '"')
_TEN_NEEDS = ["zones", "payment_types", "rate_codes", "vendors"]


def _as_one_table(spark, stored):
    assert set(stored) == set(_OUTPUTS)
    frames = {f"s{k}": stored[name] for k, name in enumerate(_OUTPUTS)}
    sql = _one_table({name: f"{{s{k}}}" for k, name in enumerate(_OUTPUTS)}, "`")
    return spark.sql(sql, **frames)


@query(oracle(_TEN, "fact", "day_names", *_TEN_NEEDS))
def job_build_summaries(spark, sf):
    """All ten summaries."""
    fact = tables.write_table(standins.fact(spark, sf), scratch_path(spark, "fact"))
    return _as_one_table(spark, jobs.build_summaries(fact, standins.zones(spark, sf), scratch_path(spark, "out"), csv=True))


_CHANGED = "SELECT * FROM fact WHERE cab_type <> 'yellow' OR strftime(pickup_datetime, '%Y_%m') <> '1997_12'"


@query(
    oracle(
        _TEN.replace("FROM fact", "FROM later").replace("fact f", "later f"),
        "fact",
        "day_names",
        *_TEN_NEEDS,
        later=_CHANGED,
    )
)
def job_refresh_summaries(spark, sf):
    """All ten summaries again, after the yellow trips of one month were removed: only that month is read."""
    fact, out = tables.write_table(standins.fact(spark, sf), scratch_path(spark, "fact")), scratch_path(spark, "out")
    zones = standins.zones(spark, sf)
    jobs.build_summaries(fact, zones, out)
    gone = (F.col("cab_type") == "yellow") & (F.date_format("pickup_datetime", "yyyy_MM") == "1997_12")
    return _as_one_table(spark, jobs.build_summaries(fact.where(~gone), zones, out, months=("1997_12", "1997_12")))


@query(
    oracle(
        f"""SELECT t.* REPLACE (CASE WHEN b.dwid IS NULL THEN t.fare_amount ELSE b.fare_amount END AS fare_amount,
                CASE WHEN b.dwid IS NULL THEN t.total_amount ELSE b.total_amount END AS total_amount),
            CASE WHEN b.dwid IS NOT NULL THEN b.cbd_fee END AS cbd_fee, {_YM.replace("pickup", "t.pickup")}
        FROM first t LEFT JOIN batch b USING (dwid, pickup_datetime, dropoff_datetime)
        UNION ALL BY NAME SELECT * EXCLUDE (known), {_YM} FROM batch WHERE NOT known""",
        "green_keyed",
        trips=first_rows("green_keyed", fixed.PRIMARY_KEY, ["dwid", *GREEN_COLUMNS]),
        first="SELECT * FROM trips WHERE payment_type < 5",
        batch="""SELECT dwid, pickup_datetime, dropoff_datetime, pu_location_id, do_location_id,
            CAST(fare_amount + 1 AS FLOAT) AS fare_amount, CAST(total_amount + 1 AS FLOAT) AS total_amount,
            CAST(passenger_count AS DOUBLE) / 2 AS cbd_fee, payment_type < 5 AS known
            FROM trips WHERE payment_type IN (2, 5)""",
    )
)
def job_upsert_after_schema_change(spark, sf):
    """A batch that lacks most stored columns and has a new one: nothing stored is lost."""
    path = scratch_path(spark, "changed")
    green = standins.keyed(spark, sf, "green").transform(keys.distinct_on, fixed.PRIMARY_KEY)
    jobs.publish(green.where("payment_type < 5"), path, FIRST, LAST, overwrite=True)
    batch = green.where("payment_type IN (2, 5)").selectExpr(
        "dwid", "pickup_datetime", "dropoff_datetime", "pu_location_id", "do_location_id",
        "CAST(fare_amount + 1 AS FLOAT) AS fare_amount", "CAST(total_amount + 1 AS FLOAT) AS total_amount",
        "passenger_count / 2D AS cbd_fee",
    )
    return jobs.publish(batch, path, FIRST, LAST, overwrite=False)


@query(oracle(f"SELECT *, {_YM} FROM ({cleaning.CLEAN_GREEN})", "green"))
def job_ingest_drifting_files(spark, sf):
    """The development zone from files whose types and columns differ."""
    landed = drifting_green(spark, sf, new_column=False)
    return jobs.ingest_dev(spark, landed, "green", FIRST, LAST, _lake(spark))


@query(oracle(f"SELECT *, {_YM} FROM ({cleaning.CLEAN_FHV})", "fhv"))
def job_backfill(spark, sf):
    return _dev(spark, sf, "fhv", _lake(spark))


@query(
    oracle(
        f"""SELECT *, {_YM} FROM (SELECT * FROM staged
            UNION ALL SELECT * FROM fact WHERE cab_type = 'yellow'
                AND strftime(pickup_datetime, '%Y_%m') <> '1997_12')""",
        "fact",
        month="SELECT * FROM fact WHERE cab_type = 'green' AND strftime(pickup_datetime, '%Y_%m') = '1997_12'",
        staged=first_rows("month", fixed.PRIMARY_KEY, FACT_COLUMNS),
    )
)
def job_reconcile_legacy(spark, sf):
    production = scratch_path(spark, "production")
    tables.overwrite_months(standins.fact_part(spark, sf, "yellow"), production)
    jobs.reconcile_legacy(spark, standins.fact_part(spark, sf, "green"), production, "1997_12")
    return spark.read.parquet(production)


@query(
    oracle(
        f"SELECT {_KEY}, CAST(pu_location_id AS BIGINT) AS pu_location_id,"
        " CAST(do_location_id AS BIGINT) AS do_location_id, CAST(sr_flag AS BIGINT) AS sr_flag,"
        " dispatching_base_num, pickup_datetime, dropoff_datetime, affiliated_base_number,"
        f" {_YM} FROM ({cleaning.CLEAN_FHV})",
        "fhv",
    )
)
def job_direct_load(spark, sf):
    return jobs.direct_load(
        spark,
        _landed(spark, sf, "fhv"),
        "fhv",
        FIRST,
        LAST,
        scratch_path(spark, "direct"),
        scratch_path(spark, "direct_csv"),
    )


_FILLED = """SELECT * REPLACE (coalesce(pu_location_id, 0) AS pu_location_id, coalesce(do_location_id, 0)
    AS do_location_id, coalesce(sr_flag, 0) AS sr_flag) FROM fhv"""


@query(
    oracle(
        f"""SELECT t.*, {_YM.replace("pickup", "t.pickup")} FROM target t
            LEFT JOIN (SELECT dwid, true AS hit FROM updates) u USING (dwid) WHERE u.hit IS NULL
        UNION ALL BY NAME SELECT *, {_YM} FROM updates""",
        "fhv_keyed",
        target="SELECT * REPLACE ('before' AS dispatching_base_num) FROM fhv_keyed",
        batch=f"SELECT {_KEY}, * FROM ({_FILLED})",
        updates=first_rows("batch", ["dwid"], ["dwid", *FHV_COLUMNS]),
    )
)
def job_merge_from_object_store(spark, sf):
    """Months of day partitions merged into a stored table."""
    root, table = scratch_path(spark, "store"), scratch_path(spark, "merged")
    trips = standins.trips(spark, sf, "fhv")
    tables.write_by_date(trips.toDF(*[f"c{i}" for i in range(len(trips.columns))]), root, "c1")
    file_schema = T.StructType(
        [T.StructField(f"c{i}", f.dataType) for i, f in enumerate(trips.schema.fields)]
    )
    before = trips.transform(keys.add_row_key).withColumn("dispatching_base_num", F.lit("before"))
    tables.overwrite_months(before, table)
    return jobs.merge_from_object_store(spark, root, "2023_12", "2024_12", file_schema, "fhv", table)
