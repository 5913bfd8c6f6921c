"""The summary job: stored partial groups, only what is wanted, only what changed."""

from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from curbline import schemas
from curbline.operators import sets, summaries
from curbline.plans import jobs
from curbline.session import scratch_path
from curbline.sinks import tables

ZONES = "location_id int, borough string, zone string, service_zone string, latitude double, longitude double, geolocation string"


def trip(k, month, service="yellow", pu=1, do=2, fare=10.0):
    at = datetime(2024, month, 1 + k % 28, k % 24)
    return (f"d{k}", service, fare, fare + 1, 2.5, 1, 1, pu, do, at, at, 1, None, None)


@pytest.fixture
def zones(frame):
    return frame(ZONES, (1, "A", "a", "x", 1.0, 2.0, "g"), (2, "B", "b", "x", None, 2.0, ""), (3, "C", "c", "x", 1.0, None, ""))


@pytest.fixture
def fact(spark, frame):
    rows = [trip(k, 1 + k % 3, ["yellow", "green", "fhv"][k % 3], 1 + k % 3, 1 + k % 2, float(k)) for k in range(90)]
    return tables.write_table(spark.createDataFrame(rows, schemas.FACT), scratch_path(spark, "fact"))


def contents(stored):
    return {name: sorted(map(str, df.collect())) for name, df in stored.items()}


def test_one_changed_month_gives_what_building_all_gives(spark, fact, zones):
    out = scratch_path(spark, "out")
    jobs.build_summaries(fact, zones, out)
    changed = fact.where("NOT (month(pickup_datetime) = 2 AND fare_amount < 40)").unionByName(
        spark.createDataFrame([trip(200, 2, pu=3, do=3, fare=7.0)], schemas.FACT)
    )
    again = jobs.build_summaries(changed, zones, out, months=("2024_02", "2024_02"))
    assert list(again) == list(jobs.SUMMARIES) and len(again) == 10
    assert contents(again) == contents(jobs.build_summaries(changed, zones, scratch_path(spark, "new")))


def test_only_changed_months_are_read(spark, fact, zones):
    out = scratch_path(spark, "out")
    jobs.build_summaries(fact, zones, out)
    # Other months, if they were read, would change what is stored.
    poisoned = fact.withColumn("fare_amount", F.when(F.month("pickup_datetime") == 2, F.col("fare_amount")).otherwise(F.lit(1e6).cast("float")))
    before = contents(jobs.build_summaries(fact, zones, scratch_path(spark, "same")))
    assert contents(jobs.build_summaries(poisoned, zones, out, months=("2024_02", "2024_02"))) == before


def test_only_what_is_wanted_is_worked_out(spark, fact, zones, monkeypatch):
    monkeypatch.setattr(summaries, "code_partials", None)
    stored = jobs.build_summaries(fact, zones, scratch_path(spark, "out"), which=["flow_matrix", "flow_pivot"])
    assert list(stored) == ["flow_matrix", "flow_pivot"]
    pivot = {r["borough_pickup"]: r.asDict() for r in stored["flow_pivot"].collect()}
    for r in stored["flow_matrix"].collect():
        assert pivot[r["borough_pickup"]][r["borough_dropoff"]] == r["total_trips"]


def test_a_month_without_rows_leaves_the_summaries(spark, fact, zones):
    out = scratch_path(spark, "out")
    jobs.build_summaries(fact, zones, out)
    left = jobs.build_summaries(fact.where("month(pickup_datetime) <> 3"), zones, out, months=("2024_03", "2024_03"))
    assert {r["month"] for r in left["monthly_service_counts"].collect()} == {1, 2}
    assert {r["month"] for r in left["time_dimension"].collect()} == {1, 2}


def test_points_need_both_coordinates(fact, zones):
    found = summaries.with_point(summaries.pickup_zone_summary(fact, zones), "pickup")
    points = {r["pu_location_id"]: r["point_pickup"] for r in found.collect()}
    assert (points[1].lon, points[1].lat) == (2.0, 1.0) and points[2] is None and points[3] is None


def test_too_wide_a_matrix_is_refused(fact, spark, monkeypatch, zones):
    monkeypatch.setattr(summaries, "MOST_BOROUGHS", 2)
    with pytest.raises(ValueError, match="more than 2"):
        summaries.flow_pivot(fact, zones)


@pytest.mark.parametrize("n", [1, 500, 2999, 3000, 9000])
def test_ordered_limits_are_exact_without_a_window(spark, n):
    df = spark.range(3000).select((F.col("id") * 7 % 3000).alias("k"), F.when(F.col("id") % 100 > 0, F.col("id") * 7 % 3000 / 10).cast("int").alias("at"))
    found = sets.limit_each([df.repartition(6)], n, ["at", "k"], F.col("at"))
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert "Window" not in plan and "percentile_approx" in plan
    assert found.collect() == df.orderBy("at", "k").limit(n).collect()


def test_a_refresh_reads_the_fact_once(spark, fact, zones, monkeypatch):
    """Codes, zones and times of the changed months come from one read of the fact, however it is stored."""
    out = scratch_path(spark, "out")
    jobs.build_summaries(fact, zones, out)
    seen = spark.sparkContext.accumulator(0)
    read = F.udf(lambda k: seen.add(1) or k)
    counted = fact.withColumn("dwid", read("dwid"))
    sources = []
    monkeypatch.setattr(summaries, "code_partials", lambda df, own=summaries.code_partials: sources.append(df) or own(df))
    monkeypatch.setattr(summaries, "zone_partials_by_month", lambda df, own=summaries.zone_partials_by_month: sources.append(df) or own(df))
    again = jobs.build_summaries(counted, zones, out, months=("2024_02", "2024_02"))
    assert seen.value == fact.where("month(pickup_datetime) = 2").count()
    assert len(sources) == 2 and not any(f in source.inputFiles() for source in sources for f in fact.inputFiles())
    assert contents(again) == contents(jobs.build_summaries(fact, zones, scratch_path(spark, "new")))
