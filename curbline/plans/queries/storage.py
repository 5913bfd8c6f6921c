"""Sinks and sources: write whole tables, read them back."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F
from pyspark.sql import types as T

from curbline import schemas
from curbline.operators import quality, shape
from curbline.plans import jobs, standins
from curbline.plans.queries.registry import FHV_COLUMNS, oracle, query
from curbline.session import scratch_path
from curbline.sinks import tables
from curbline.sources import files

_YM = """CAST(year(pickup_datetime) AS INTEGER) AS year, CAST(month(pickup_datetime) AS INTEGER) AS month"""


@query(oracle("SELECT * FROM fact", "fact"))
def read_trip_files(spark, sf):
    """Several files of one service read as one table."""
    base = scratch_path(spark, "files")
    for service in ("yellow", "green", "fhv"):
        standins.fact_part(spark, sf, service).write.parquet(f"{base}/{service}")
    return files.read_trip_files(
        spark, [f"{base}/{s}" for s in ("yellow", "green", "fhv")], schemas.FACT
    )


_DRIFT = {
    0: [],
    # Counts as doubles, a column in another case, one that is gone.
    1: ["CAST(passenger_count AS DOUBLE) AS passenger_count", "CAST(RatecodeID AS DOUBLE) AS ratecodeid", None],
    # Narrower numbers, and a column that is new.
    2: ["CAST(payment_type AS INT) AS payment_type", "CAST(trip_type AS DOUBLE) AS trip_type", "passenger_count / 2D AS cbd_fee"],
}


def drifting_green(spark, sf, new_column: bool = True) -> list[str]:
    """Green trip files of three kinds, by month of the year: their types and columns differ."""
    base, raw, month = scratch_path(spark, "drift"), standins.raw(spark, sf, "green"), F.month("lpep_pickup_datetime") % 3
    for kind, changes in _DRIFT.items():
        changed = {c.split(" AS ")[-1].lower(): c for c in changes if c}
        kept = [changed.pop(c.lower(), c) for c in raw.columns if c != "congestion_surcharge" or kind != 1]
        added = changed.values() if new_column else []
        raw.where(month == kind).selectExpr(*kept, *added).write.parquet(f"{base}/{kind}")
    return [f"{base}/{kind}" for kind in _DRIFT]


@query(
    oracle(
        """SELECT *, CASE WHEN month(pickup_datetime) % 3 = 2 THEN CAST(passenger_count AS DOUBLE) / 2 END AS cbd_fee
        FROM green""",
        "green",
    )
)
def read_drifting_files(spark, sf):
    """Files whose column types, names' case and columns differ, as one table."""
    profile = schemas.SERVICES["green"]
    return (
        files.read_drifting_files(spark, drifting_green(spark, sf), profile.file_schema)
        .transform(shape.cast_to_schema, profile.file_schema)
        .transform(shape.drop_columns, *profile.drops)
        .transform(shape.rename_columns, profile.renames)
    )


@query(
    oracle(
        """SELECT strftime(m, '%Y_%m') AS year_month, CASE WHEN n.row_count IS NULL THEN 'missing' ELSE 'filled' END AS state,
            coalesce(n.row_count, 0) AS row_count, CASE WHEN n.row_count IS NULL THEN 1 ELSE 0 END AS violations
        FROM (SELECT unnest(generate_series(TIMESTAMP '1994-01-01', TIMESTAMP '1999-12-01', INTERVAL 1 MONTH)) AS m)
            LEFT JOIN (SELECT date_trunc('month', pickup_datetime) AS at, count(*) AS row_count FROM fact
                WHERE cab_type = 'green' GROUP BY ALL) n ON n.at = m""",
        "fact",
    )
)
def check_months(spark, sf):
    """Every expected month of a table, with those that are missing from it."""
    base = scratch_path(spark, "inventory")
    trips = standins.fact_part(spark, sf, "green")
    tables.overwrite_months(trips.where("pickup_datetime >= '1994-01-01' AND pickup_datetime < '2000-01-01'"), base)
    stored = T.StructType([*trips.schema.fields, T.StructField("year", T.IntegerType()), T.StructField("month", T.IntegerType())])
    return quality.check_months(spark, base, jobs.month_tokens("1994_01", "1999_12"), stored)


@query(oracle(f"SELECT *, {_YM} FROM fact WHERE cab_type <> 'fhv'", "fact"))
def append_months(spark, sf):
    base = scratch_path(spark, "append")
    tables.append_months(standins.fact_part(spark, sf, "yellow"), base)
    tables.append_months(standins.fact_part(spark, sf, "green"), base)
    return spark.read.parquet(base)


@query(
    oracle(
        """SELECT n.* FROM numbered n LEFT JOIN again a USING (year, month)
        WHERE n.cab_type = 'green' OR a.hit IS NULL""",
        "fact",
        numbered=f"SELECT *, {_YM} FROM fact WHERE cab_type <> 'fhv'",
        again="SELECT DISTINCT year, month, true AS hit FROM numbered WHERE cab_type = 'green'",
    )
)
def month_roundtrip(spark, sf):
    """Months that come again are replaced, the others stay."""
    base = scratch_path(spark, "months")
    tables.overwrite_months(standins.fact_part(spark, sf, "yellow"), base)
    tables.overwrite_months(standins.fact_part(spark, sf, "green"), base)
    return spark.read.parquet(base)


@query(
    oracle(
        f"SELECT *, {_YM} FROM green WHERE strftime(pickup_datetime, '%Y_%m') = '1997_12'", "green"
    )
)
def read_month_partition(spark, sf):
    base = scratch_path(spark, "month")
    tables.overwrite_months(standins.trips(spark, sf, "green"), base)
    return files.read_month_partition(spark, base, 1997, 12)


@query(oracle("SELECT *, CAST(pickup_datetime AS DATE) AS partition_date FROM fhv", "fhv"))
def day_files_roundtrip(spark, sf):
    base = scratch_path(spark, "days")
    tables.write_day_files(standins.trips(spark, sf, "fhv"), base)
    january = files.read_day_partitions(spark, base, 2024, 1)
    rest = [files.read_days(spark, base, first, last) for first, last in (("2000_01", "2023_12"), ("2024_02", "2040_12"))]
    return january.unionByName(rest[0]).unionByName(rest[1])


@query(oracle("SELECT *, CAST(pickup_datetime AS DATE) AS partitioned_date FROM fhv", "fhv"))
def by_date_roundtrip(spark, sf):
    base = scratch_path(spark, "by_date")
    tables.write_by_date(standins.trips(spark, sf, "fhv"), base)
    return spark.read.parquet(base)


@query(
    oracle(
        """SELECT * REPLACE (CASE WHEN pickup_datetime < TIMESTAMP '2024-01-11' THEN 'first'
            ELSE dispatching_base_num END AS dispatching_base_num),
            CAST(pickup_datetime AS DATE) AS pickup_date FROM fhv""",
        "fhv",
    )
)
def write_missing_dates(spark, sf):
    """Days already present keep their first version."""
    base = scratch_path(spark, "missing")
    trips = standins.trips(spark, sf, "fhv").withColumn("pickup_date", F.to_date("pickup_datetime"))
    early = trips.where("pickup_date < DATE '2024-01-11'").withColumn(
        "dispatching_base_num", F.lit("first")
    )
    tables.write_missing_dates(early, base, "pickup_date")
    tables.write_missing_dates(trips, base, "pickup_date")
    return spark.read.parquet(base)


@query(oracle(f"SELECT {', '.join(FHV_COLUMNS)} FROM fhv", "fhv"))
def partition_glob_roundtrip(spark, sf):
    """All months of object-store partitions, one glob for each, and a year that has none."""
    base = scratch_path(spark, "glob")
    trips = standins.trips(spark, sf, "fhv")
    tables.write_by_date(trips, base)
    globs = [files.month_glob("partitioned_date", year, month) for year in (2023, 2024, 2025) for month in range(1, 13)]
    found = files.read_partition_glob(spark, base, "{" + ",".join(globs) + "}", trips.schema)
    none = files.read_partition_glob(spark, base, files.month_glob("partitioned_date", 1970, 1), trips.schema)
    return found.select(*trips.columns).unionByName(none)


@query(
    oracle("SELECT * REPLACE (nullif(geolocation, '') AS geolocation) FROM zones", "zones")
)
def lookup_roundtrip(spark, sf):
    base = scratch_path(spark, "lookup")
    standins.zones(spark, sf).write.csv(base, header=True, nullValue="NULL", quoteAll=True, emptyValue="NULL")
    return files.read_lookup(spark, base, schemas.ZONE)


@query(oracle("SELECT * FROM fact", "fact"))
def csv_roundtrip(spark, sf):
    base = scratch_path(spark, "csv")
    fact = standins.fact(spark, sf)
    tables.export_csv(fact, base)
    return files.load_csv(spark, base, schemas.FACT)


@query(
    oracle("SELECT pu_location_id, count(*) AS total_trips FROM fact GROUP BY 1", "fact")
)
def refresh_table_roundtrip(spark, sf):
    """A summary table created, then refreshed with newer contents."""
    name = f"zone_trips_{uuid.uuid4().hex}"
    path = scratch_path(spark, "refresh")

    def count(frame):
        return frame.groupBy("pu_location_id").agg(F.count(F.lit(1)).alias("total_trips"))

    tables.refresh_table(count(standins.fact_part(spark, sf, "fhv")), name, path)
    return tables.refresh_table(count(standins.fact(spark, sf)), name, path)


@query(oracle("SELECT * FROM fact WHERE cab_type = 'green'", "fact"))
def read_or_empty(spark, sf):
    """A table that exists and one that does not."""
    base = scratch_path(spark, "maybe")
    standins.fact_part(spark, sf, "green").write.parquet(f"{base}/green")
    return files.read_or_empty(spark, f"{base}/green", schemas.FACT).unionByName(
        files.read_or_empty(spark, f"{base}/yellow", schemas.FACT)
    )


@query(oracle("SELECT * FROM fact WHERE strftime(pickup_datetime, '%Y_%m') = '1997_12'", "fact"))
def month_view(spark, sf):
    name = f"fact_1997_12_{uuid.uuid4().hex}"
    return tables.month_view(standins.fact(spark, sf), name, 1997, 12)


@query(
    oracle(
        """SELECT 'fact_' || strftime(partition_start, '%Y_%m') AS partition_name, partition_start,
            CAST(partition_start + INTERVAL 1 MONTH AS DATE) AS partition_end, row_count
        FROM (SELECT CAST(date_trunc('month', pickup_datetime) AS DATE) AS partition_start,
            count(*) AS row_count FROM fact GROUP BY 1)""",
        "fact",
    )
)
def partition_catalog(spark, sf):
    return tables.partition_catalog(standins.fact(spark, sf), "fact")


@query(oracle("SELECT * FROM yellow", "yellow"))
def schema_ddl(spark, sf):
    """The generated column list creates a table that takes the rows."""
    rows = standins.trips(spark, sf, "yellow")
    ddl = tables.schema_ddl(rows, "trips")
    columns = ddl[ddl.index("(") + 1 : -1].replace("TIMESTAMP", "TIMESTAMP_NTZ").replace("VARCHAR", "STRING")
    path = scratch_path(spark, "ddl")
    rows.write.parquet(path)
    names = [part.split()[0] for part in columns.split(", ")]
    return spark.read.schema(columns).parquet(path).select(*names)
