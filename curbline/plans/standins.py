"""The test tables seen as trip files of the three services."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from curbline import fixed, schemas
from curbline.operators import clean, keys, sets, shape


_SCHEMAS: dict[str, T.StructType] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One test table; its schema is read from the file once and pinned."""
    path = f"{sf_dir}/{name}.parquet"
    if path not in _SCHEMAS:
        _SCHEMAS[path] = spark.read.parquet(path).schema
    return spark.read.schema(_SCHEMAS[path]).parquet(path)


def raw_yellow(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order lines: ordered is pickup, shipped is dropoff, nations are zones."""
    orders = table(spark, sf_dir, "orders").join(
        table(spark, sf_dir, "customer"), F.expr("o_custkey = c_custkey")
    )
    # Both sides grow with the data, so they are merged on the shuffled order key
    # whatever the size estimate says.
    lines = (
        table(spark, sf_dir, "lineitem")
        .join(orders.hint("merge"), F.expr("l_orderkey = o_orderkey"))
        .join(table(spark, sf_dir, "supplier"), F.expr("l_suppkey = s_suppkey"))
    )
    # Whole cents and percents: their product is exact in a double.
    total = """rint(l_extendedprice * 100) * (100 - rint(l_discount * 100))
        * (100 + rint(l_tax * 100)) / 1000000"""
    return lines.selectExpr(
        "l_suppkey % 3 AS VendorID",
        "o_orderdate AS tpep_pickup_datetime",
        "l_shipdate AS tpep_dropoff_datetime",
        "l_linenumber AS passenger_count",
        "l_quantity AS trip_distance",
        "l_linenumber AS RatecodeID",
        "concat(l_returnflag, l_linestatus) AS store_and_fwd_flag",
        "c_nationkey AS PULocationID",
        "s_nationkey AS DOLocationID",
        "l_linenumber % 7 AS payment_type",
        "l_extendedprice AS fare_amount",
        "l_discount AS extra",
        "l_tax AS mta_tax",
        "l_tax AS tip_amount",
        "l_discount AS tolls_amount",
        "l_tax AS improvement_surcharge",
        f"{total} AS total_amount",
        "CAST(NULL AS DOUBLE) AS congestion_surcharge",
        "CAST(l_linenumber AS DOUBLE) AS airport_fee",
    )


def raw_green(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders: some days later is dropoff."""
    orders = table(spark, sf_dir, "orders").join(
        table(spark, sf_dir, "customer"), F.expr("o_custkey = c_custkey")
    )
    return orders.selectExpr(
        "o_orderkey % 3 AS VendorID",
        "o_orderdate AS lpep_pickup_datetime",
        "o_orderdate + make_interval(0, 0, 0, CAST(o_orderkey % 5 AS INT)) AS lpep_dropoff_datetime",
        "o_orderkey % 6 AS passenger_count",
        "CAST(o_orderkey % 60 AS DOUBLE) AS trip_distance",
        "o_orderkey % 8 AS RatecodeID",
        "concat(o_orderstatus, 'X') AS store_and_fwd_flag",
        "c_nationkey AS PULocationID",
        "o_orderkey % 25 AS DOLocationID",
        "o_orderkey % 7 AS payment_type",
        "o_totalprice AS fare_amount",
        "CAST(o_orderkey % 3 AS DOUBLE) AS extra",
        "CAST(o_orderkey % 2 AS DOUBLE) AS mta_tax",
        "CAST(o_orderkey % 5 AS DOUBLE) AS tip_amount",
        "CAST(o_orderkey % 4 AS DOUBLE) AS tolls_amount",
        "CAST(NULL AS DOUBLE) AS ehail_fee",
        "CAST(o_orderkey % 2 AS DOUBLE) AS improvement_surcharge",
        "o_totalprice AS total_amount",
        "o_orderkey % 2 + 1 AS trip_type",
        "CAST(NULL AS DOUBLE) AS congestion_surcharge",
    )


def raw_fhv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events: some hours later is dropoff, users are zones."""
    return table(spark, sf_dir, "events").selectExpr(
        "event_type AS dispatching_base_num",
        "ts AS pickup_datetime",
        "ts + make_interval(0, 0, 0, 0, CAST(event_id % 4 AS INT)) AS dropOff_datetime",
        "nullif(user_id % 30, 29) AS PUlocationID",
        "event_id % 25 AS DOlocationID",
        "nullif(event_id % 5, 4) AS SR_Flag",
        "CASE WHEN event_id % 7 = 0 THEN ' ' WHEN event_id % 11 = 0 THEN NULL ELSE event_type END"
        " AS Affiliated_base_number",
    )


def raw(spark: SparkSession, sf_dir: str, service: str) -> DataFrame:
    return {"yellow": raw_yellow, "green": raw_green, "fhv": raw_fhv}[service](spark, sf_dir)


def trips(spark: SparkSession, sf_dir: str, service: str) -> DataFrame:
    """One service cast and renamed, not cleaned."""
    profile = schemas.SERVICES[service]
    return (
        raw(spark, sf_dir, service)
        .transform(shape.cast_to_schema, profile.file_schema)
        .transform(shape.drop_columns, *profile.drops)
        .transform(shape.rename_columns, profile.renames)
    )


def keyed(spark: SparkSession, sf_dir: str, service: str) -> DataFrame:
    """One service with its row key."""
    return trips(spark, sf_dir, service).transform(keys.add_row_key)


def fact_part(spark: SparkSession, sf_dir: str, service: str) -> DataFrame:
    """One service in the fact schema, rows with NULL keys dropped."""
    return (
        keyed(spark, sf_dir, service)
        .transform(clean.drop_null_keys, fixed.TRIP_KEY)
        .transform(shape.conform_to_fact, service)
    )


def fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The three services in the fact schema."""
    return sets.union_services([fact_part(spark, sf_dir, name) for name in fixed.SERVICES])


def zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nations as zones, regions as boroughs; the last two lack coordinates."""
    joined = table(spark, sf_dir, "nation").join(
        table(spark, sf_dir, "region"), F.expr("n_regionkey = r_regionkey")
    )
    lat = "CAST(40 + n_nationkey AS DECIMAL(8,2))"
    lon = "CAST(-74 - n_nationkey AS DECIMAL(8,2))"
    known = "n_nationkey < 23"
    return joined.selectExpr(
        "n_nationkey AS location_id",
        "r_name AS borough",
        "n_name AS zone",
        "CASE WHEN n_nationkey % 2 = 0 THEN 'Yellow Zone' ELSE 'Boro Zone' END AS service_zone",
        f"CASE WHEN {known} THEN CAST({lat} AS DOUBLE) END AS latitude",
        f"CASE WHEN {known} THEN CAST({lon} AS DOUBLE) END AS longitude",
        f"CASE WHEN {known} THEN concat('(', CAST({lat} AS STRING), ', ', CAST({lon} AS STRING), ')')"
        " ELSE '' END AS geolocation",
    )
