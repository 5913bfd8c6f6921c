from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from curbline import fixed, schemas
from curbline.operators import clean, keys, merge, quality
from curbline.plans import jobs, standins
from curbline.session import scratch_path
from curbline.sinks import tables

FHV_FILE = (
    "dispatching_base_num string, pickup_datetime timestamp_ntz, dropOff_datetime timestamp_ntz,"
    " PUlocationID long, DOlocationID long, SR_Flag long, Affiliated_base_number string"
)


def trip(day, hour=8, pu=1, base="B1", flag=None):
    return (base, datetime(2024, 1, day, hour), datetime(2024, 1, day, hour + 1), pu, 2, flag, "A1")


@pytest.fixture
def lake(spark):
    return jobs.Lake(scratch_path(spark, "lake"))


def land(spark, frame, *trips):
    path = scratch_path(spark, "landed")
    frame(FHV_FILE, *trips).write.parquet(path)
    return path


def test_from_files_to_fact(spark, frame, lake):
    month = {"first": "2024_01", "last": "2024_01"}
    path = land(spark, frame, trip(1), trip(1), trip(1, base="B2"), trip(2), trip(3, flag=7))
    dev = jobs.ingest_dev(spark, path, "fhv", lake=lake, **month)
    assert dev.count() == 3
    stage = jobs.load_stage(spark, "fhv", lake=lake, **month)
    assert stage.count() == 2 and stage.columns[0] == "dwid"
    assert jobs.publish_lakehouse(spark, "fhv", lake=lake, **month).count() == 2
    production = jobs.publish_production(spark, "fhv", lake=lake, level="very_strict", **month)
    assert production.count() == 2
    fact = jobs.build_fact(spark, lake=lake, **month)
    assert fact.drop("year", "month").columns == schemas.FACT.names
    assert {(r.cab_type, r.payment_type) for r in fact.collect()} == {("fhv", 5)}


def test_loading_again_changes_nothing_and_updates_win(spark, frame, lake):
    month = {"first": "2024_01", "last": "2024_01"}
    jobs.ingest_dev(spark, land(spark, frame, trip(1), trip(2)), "fhv", lake=lake, **month)
    first = jobs.load_stage(spark, "fhv", lake=lake, **month)
    before = sorted(map(tuple, first.collect()))
    again = jobs.load_stage(spark, "fhv", lake=lake, **month)
    assert sorted(map(tuple, again.collect())) == before
    jobs.ingest_dev(spark, land(spark, frame, trip(2, base="NEW"), trip(4)), "fhv", lake=lake, **month)
    third = jobs.load_stage(spark, "fhv", lake=lake, **month)
    assert sorted((r.pickup_datetime.day, r.dispatching_base_num) for r in third.collect()) == [
        (1, "B1"), (2, "NEW"), (4, "B1"),
    ]


def test_loss_stops_production(spark, frame, lake):
    month = {"first": "2024_01", "last": "2024_01"}
    jobs.ingest_dev(spark, land(spark, frame, *[trip(d) for d in range(1, 10)]), "fhv", lake=lake, **month)
    jobs.load_stage(spark, "fhv", lake=lake, **month)
    jobs.publish_lakehouse(spark, "fhv", lake=lake, **month)
    jobs.ingest_dev(spark, land(spark, frame, trip(20)), "fhv", lake=lake, **month)
    jobs.load_stage(spark, "fhv", lake=lake, **month)
    with pytest.raises(quality.QualityError, match="10.00 %"):
        jobs.publish_production(spark, "fhv", lake=lake, level="moderate", **month)


def test_wrong_files_are_refused(spark, frame, lake):
    path = scratch_path(spark, "landed")
    frame("pickup_datetime timestamp_ntz, other int", (datetime(2024, 1, 1), 1)).write.parquet(path)
    with pytest.raises(quality.QualityError, match="missing"):
        jobs.ingest_dev(spark, path, "fhv", "2024_01", "2024_01", lake)


def test_failed_check_leaves_the_table(spark, frame):
    path = scratch_path(spark, "table")
    df = frame("k int, pickup_datetime timestamp_ntz", (1, datetime(2024, 1, 1)))
    jobs.publish(df, path, "2024_01", "2024_01", overwrite=True, key=["k"])

    def refuse(image):
        raise quality.QualityError("no")

    with pytest.raises(quality.QualityError):
        jobs.publish(df.withColumn("k", F.lit(2)), path, "2024_01", "2024_01", True, ["k"], refuse)
    assert [r.k for r in spark.read.parquet(path).collect()] == [1]


def test_one_bad_month_stops_a_long_range(spark, frame):
    schema = "dwid string, pickup_datetime timestamp_ntz"
    other = frame(schema, *[(f"{m}-{k}", datetime(2023 + m // 12, m % 12 + 1, 1)) for m in range(24) for k in range(20)])
    truth = other.where("NOT (dwid LIKE '7-1%')")
    report = merge.reconcile_loss_by_month(truth, other, "moderate", ["dwid", "pickup_datetime"])
    assert {r.year_month: r.lost_rows for r in report.collect() if r.breached} == {"2023_08": 11}
    with pytest.raises(quality.QualityError, match="2023_08: 55.00 %"):
        quality.require_loss_below_limit(report)
    quality.require_loss_below_limit(merge.reconcile_loss(truth, other, "moderate"))


def test_trips_that_are_gone_from_the_files_leave_all_zones(spark, frame, lake):
    months = {"first": "2024_01", "last": "2024_02"}
    feb = ("B1", datetime(2024, 2, 3, 8), datetime(2024, 2, 3, 9), 1, 2, None, "A1")
    for landed in ([trip(1), trip(2), feb], [trip(1)]):
        dev = jobs.ingest_dev(spark, land(spark, frame, *landed), "fhv", lake=lake, **months)
        jobs.load_stage(spark, "fhv", lake=lake, overwrite=True, **months)
        days = jobs.publish_lakehouse(spark, "fhv", lake=lake, **months)
        production = jobs.publish_production(
            spark, "fhv", lake=lake, level="very_strict", may_be_null=["sr_flag"], overwrite=True, **months
        )
        assert dev.count() == days.count() == production.count() == len(landed)


def test_sampling_is_by_month(frame):
    df = frame("k int, ts timestamp_ntz", *[(k, datetime(2024, 1 + k % 2, 1)) for k in range(400)])
    drawn = clean.sample_each(df, 50, F.date_format("ts", "yyyy_MM"), 3)
    assert all(25 < r["count"] < 80 for r in drawn.groupBy(F.month("ts")).count().collect())
    assert clean.sample_each(df, 500, F.date_format("ts", "yyyy_MM")).count() == 400


def test_replacement_without_rows_for_a_stored_month_empties_it(spark, frame):
    path = scratch_path(spark, "table")
    schema = "k int, pickup_datetime timestamp_ntz"
    both = frame(schema, (1, datetime(2024, 1, 1)), (2, datetime(2024, 2, 1)))
    jobs.publish(both, path, "2024_01", "2024_02", overwrite=True, key=["k"])
    found = jobs.publish(frame(schema, (3, datetime(2024, 1, 1))), path, "2024_01", "2024_01", True, ["k"])
    assert [r.k for r in found.collect()] == [3]
    assert sorted(r.k for r in spark.read.parquet(path).collect()) == [2, 3]
    found = jobs.publish(frame(schema, (3, datetime(2024, 1, 1))), path, "2024_01", "2024_02", True, ["k"])
    assert [r.k for r in found.collect()] == [r.k for r in spark.read.parquet(path).collect()] == [3]
    assert jobs.publish(frame(schema), path, "2024_01", "2024_02", True, ["k"]).count() == 0


def test_backfill_runs_once_for_all_months():
    calls = []
    jobs.backfill(lambda first, last, x: calls.append((first, last, x)), "2022_11", "2023_02", x=1)
    assert calls == [("2022_11", "2023_02", 1)]
    assert jobs.month_tokens("2022_11", "2023_02") == ["2022_11", "2022_12", "2023_01", "2023_02"]
    with pytest.raises(ValueError):
        jobs.month_tokens("2023_02", "2023_01")


def test_unknown_summary(spark, frame):
    with pytest.raises(ValueError):
        jobs.build_summaries(None, None, "x", which=["nothing"])


def test_write_table_is_read_back(spark, frame, rows):
    df = frame("a int, b string", (1, "x"), (None, None))
    assert rows(tables.write_table(df, scratch_path(spark, "t"))) == rows(df)


@pytest.mark.parametrize("newer_first", [True, False])
def test_an_upsert_keeps_columns_that_only_some_months_have(spark, lake, newer_first):
    path = lake.zone("stage", "any")
    months = [("k int, ts timestamp_ntz, extra string", (1, datetime(2024, 2, 1), "keep")), ("k int, ts timestamp_ntz", (2, datetime(2024, 1, 1)))]
    for schema, row in months if newer_first else months[::-1]:
        part = spark.createDataFrame([row], schema)
        part.withColumns({"year": F.year("ts"), "month": F.month("ts")}).write.partitionBy("year", "month").mode("append").parquet(path)
    wanted = T.StructType.fromDDL("k int, ts timestamp_ntz, extra string")
    found = jobs._existing_months(spark, path, wanted, "2024_01", "2024_02")
    assert {(r.k, r.extra) for r in found.collect()} == {(1, "keep"), (2, None)}


def test_a_first_load_brings_rows_together_once(spark, tmp_path):
    """Nothing is stored yet: one shuffle by key serves unique rows and the merge, and repeats count as one."""
    schema = jobs.keyed_schema("fhv")
    row = {f.name: None for f in schema.fields} | {"dwid": "a", "pickup_datetime": datetime(2023, 1, 2), "dropoff_datetime": datetime(2023, 1, 3)}
    values = [{**row, "sr_flag": 2}, {**row, "sr_flag": 1}, {**row, "sr_flag": 1}, {**row, "dwid": None}, {**row, "dwid": None}]
    rows = spark.createDataFrame([tuple(v[f.name] for f in schema.fields) for v in values], schema)
    unique = keys.dedup_by_key(rows, fixed.PRIMARY_KEY)
    merged = jobs._upserted(unique, str(tmp_path / "stage"), "2023_01", "2023_01", fixed.PRIMARY_KEY)
    assert merged._jdf.queryExecution().executedPlan().toString().count("Exchange") == 1
    again = jobs._upserted(rows, str(tmp_path / "stage"), "2023_01", "2023_01", fixed.PRIMARY_KEY)
    assert sorted(str(r["dwid"]) + str(r["sr_flag"]) for r in again.collect()) == ["None" * 2, "a1"]


def test_stage_rows_need_no_removal_of_copies_first(spark, tmp_path, monkeypatch):
    """Exact copies, and rows that differ in the cut part of the flag only, are one trip of the stage."""
    lake, service = jobs.Lake(str(tmp_path)), "green"
    trips = standins.trips(spark, "/root/testdata/sf0.001", service).transform(clean.clean_trips, service)
    tables.overwrite_months(trips.union(trips), lake.zone("dev", service))
    wanted = keys.dedup_by_key(keys.add_row_key(trips), fixed.PRIMARY_KEY)
    monkeypatch.setattr(clean, "unique_trips", None)
    found = jobs.load_stage(spark, service, "1990_01", "2030_12", lake).drop("year", "month")
    assert found.count() == wanted.count() > 0 and found.exceptAll(wanted).count() == 0
