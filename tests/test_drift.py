"""Files whose types and columns change over time."""

from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from curbline.plans import jobs
from curbline.session import scratch_path
from curbline.sources import files, jdbc


@pytest.fixture
def landed(spark):
    base = scratch_path(spark, "drift")

    def write(month, *columns):
        spark.range(10).selectExpr(f"id + {month * 100} AS id", f"timestamp_ntz '2024-{month:02d}-05' AS ts", *columns).coalesce(1).write.parquet(f"{base}/m{month:02d}")

    write(1, "CAST(id AS LONG) AS passengers", "CAST(id AS INT) AS code")
    write(2, "CAST(id AS LONG) AS passengers", "CAST(id AS INT) AS code", "CAST(id AS DOUBLE) AS fee")
    write(3, "CAST(id AS DOUBLE) AS Passengers", "CAST(id AS INT) AS code")
    write(4, "CAST(id AS DOUBLE) AS passengers", "CAST(id AS LONG) AS code", "CAST(id AS DOUBLE) AS fee")
    write(5, "CAST(id AS LONG) AS passengers", "CAST(id AS INT) AS code")
    return [f"{base}/m{m:02d}" for m in range(1, 6)]


def test_groups_have_one_type_for_a_column(spark, landed):
    groups = files.schema_groups(spark, landed)
    months = sorted(sorted(int(p.split("/m")[1][:2]) for p in members) for _, members in groups)
    assert months == [[1, 2, 5], [3], [4]]
    assert len(files.schema_groups(spark, landed[:2])) == 1


def test_drifting_files_are_one_table(spark, landed):
    declared = T.StructType.fromDDL("id long, passengers int")
    df = files.read_drifting_files(spark, landed, declared)
    assert dict(df.dtypes) == {"id": "bigint", "ts": "timestamp_ntz", "passengers": "int", "code": "bigint", "fee": "double"}
    rows = df.collect()
    assert len(rows) == 50
    for r in rows:
        month, k = divmod(r.id, 100)
        assert (r.passengers, r.code, r.fee) == (k, k, float(k) if month in (2, 4) else None)
    assert dict(files.read_drifting_files(spark, landed).dtypes)["passengers"] == "double"


def test_filters_reach_every_scan(spark, landed):
    day = F.col("ts") >= F.lit(datetime(2024, 4, 1))
    plan = files.read_drifting_files(spark, landed).where(day)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts,2024-04-01T00:00)]") == 3


def test_files_that_agree_are_read_as_they_are(spark, landed):
    df = files.read_drifting_files(spark, landed[:2])
    assert "Union" not in df._jdf.queryExecution().optimizedPlan().toString()
    assert df.where("fee IS NULL").count() == 10


def test_ingest_takes_drifting_files(spark, frame):
    base = scratch_path(spark, "landed")
    trip = lambda m, flag: ("B1", datetime(2024, m, 1, 8), datetime(2024, m, 1, 9), 1, 2, flag, "A1")
    names = "dispatching_base_num string, pickup_datetime timestamp_ntz, dropOff_datetime timestamp_ntz, "
    frame(names + "PUlocationID long, DOlocationID long, SR_Flag long, Affiliated_base_number string", trip(1, 1)).write.parquet(f"{base}/1")
    frame(names + "PUlocationID double, DOlocationID double, SR_Flag double, Affiliated_base_number string", (*trip(2, 0)[:3], 1.0, 2.0, 0.0, "A1")).write.parquet(f"{base}/2")
    lake = jobs.Lake(scratch_path(spark, "lake"))
    dev = jobs.ingest_dev(spark, [f"{base}/1", f"{base}/2"], "fhv", "2024_01", "2024_02", lake)
    assert sorted((r.pickup_datetime.month, r.pu_location_id, r.sr_flag) for r in dev.collect()) == [(1, 1, 1), (2, 1, 0)]


def test_stored_tables_are_read_with_all_their_columns(spark):
    base = scratch_path(spark, "stored")
    spark.range(3).selectExpr("id").write.parquet(f"{base}/year=2024/month=1")
    spark.range(3).selectExpr("id", "'x' AS later").write.parquet(f"{base}/year=2024/month=2")
    found = files.read_months(spark, base, "2024_01", "2024_02")
    assert sorted(r.later or "" for r in found.collect()) == ["", "", "", "x", "x", "x"]
    assert files.read_month_partition(spark, base, 2024, 2).columns == ["id", "later", "year", "month"]
    spark.range(3).selectExpr("CAST(id AS STRING) AS id").write.parquet(f"{base}/year=2024/month=3")
    with pytest.raises(ValueError, match="different types"):
        files.read_months(spark, base, "2024_01", "2024_03")
    wanted = T.StructType.fromDDL("id int, later string, never double")
    assert sorted(r.id for r in files.read_or_empty(spark, base, wanted).collect()) == [0, 0, 0, 1, 1, 1, 2, 2, 2]


def test_writers_are_sized_without_counting(spark, monkeypatch):
    df = spark.range(1000).withColumn("k", F.col("id") % 7)
    plan = jdbc.spread(df, ["id"], 10)._jdf.queryExecution().optimizedPlan().toString()
    assert "RebalancePartitions" in plan
    assert jdbc.spread(df, ["id"], 10, rows=1000).rdd.getNumPartitions() == 100
    assert jdbc.spread(df, ["id"], 10, max_writers=4).rdd.getNumPartitions() == 4
