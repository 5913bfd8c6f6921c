"""Publishing: one write, renames from a journal, rules counted on the way."""

from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from curbline.operators import clean, quality
from curbline.plans import jobs
from curbline.session import scratch_path
from curbline.sinks import partitions, tables

SCHEMA = "k int, pickup_datetime timestamp_ntz, note string"


def at(month, day=1):
    return datetime(2024, month, day)


@pytest.fixture
def table(spark, frame):
    path = scratch_path(spark, "table")
    jobs.publish(frame(SCHEMA, (1, at(1), "old"), (2, at(2), "old"), (3, at(3), "old")), path, "2024_01", "2024_03", True, ["k"])
    return path


def stored(spark, path):
    return sorted((r.k, r.month, r.note) for r in spark.read.parquet(path).collect())


NEW = [(1, 1, "new"), (2, 2, "new")]


@pytest.mark.parametrize("moves", range(5))
def test_a_run_lost_between_renames_is_finished_by_the_next(spark, frame, table, monkeypatch, moves):
    batch = frame(SCHEMA, (1, at(1), "new"), (2, at(2), "new"))
    done, move = [], partitions.Store.move

    def lost(self, source, target):
        if "journal" not in target:
            if len(done) == moves:
                raise KeyboardInterrupt
            done.append(target)
        move(self, source, target)

    with monkeypatch.context() as m:
        m.setattr(partitions.Store, "move", lost)
        with pytest.raises(KeyboardInterrupt):
            jobs.publish(batch, table, "2024_01", "2024_03", True, ["k"])
    assert len(done) == moves
    partitions.recover(spark, table)
    assert stored(spark, table) == NEW
    assert [n for n in partitions.Store(spark, table).names() if n.startswith("_")] == []
    partitions.recover(spark, table)
    assert stored(spark, table) == NEW


def test_a_run_lost_before_its_journal_changes_nothing(spark, frame, table, monkeypatch):
    before = stored(spark, table)
    with monkeypatch.context() as m:
        m.setattr(partitions, "put_in_place", lambda *a: (_ for _ in ()).throw(KeyboardInterrupt))
        with pytest.raises(KeyboardInterrupt):
            jobs.publish(frame(SCHEMA, (1, at(1), "new")), table, "2024_01", "2024_03", True, ["k"])
    assert stored(spark, table) == before
    found = jobs.publish(frame(SCHEMA, (9, at(2), "later")), table, "2024_02", "2024_02", False, ["k"])
    assert sorted(r.k for r in found.collect()) == [2, 9]
    assert [n for n in partitions.Store(spark, table).names() if n.startswith("_")] == []


def test_rules_are_counted_during_the_only_write(spark, frame, table, monkeypatch):
    before, images = stored(spark, table), []
    write = tables.write_image
    monkeypatch.setattr(tables, "write_image", lambda *a, **b: images.append(a[1]) or write(*a, **b))
    rules = {"even": F.col("k") % 2 == 0, "noted": F.col("note").isNotNull()}
    with pytest.raises(quality.QualityError, match=r"'even': 2, 'noted': 1"):
        jobs.publish(frame(SCHEMA, (1, at(1), None), (3, at(1), "x"), (4, at(1), "x")), table, "2024_01", "2024_01", True, ["k"], rules=rules)
    assert stored(spark, table) == before and len(images) == 1
    jobs.publish(frame(SCHEMA, (4, at(1), "x")), table, "2024_01", "2024_01", True, ["k"], rules=rules)
    assert len(images) == 2 and stored(spark, table)[-1] == (4, 1, "x")


def test_observed_rows(spark, frame):
    seen = quality.Observed({"big": F.col("v") > 2})
    seen.watch(frame("v int", (1,), (3,), (None,), (5,))).where("v > 2").write.format("noop").mode("overwrite").save()
    assert seen.rows == 4 and seen.broken == {"big": 2}
    seen.require_kept(2, 0.5, "x")
    with pytest.raises(quality.QualityError, match="2 of 4 rows rejected"):
        seen.require_kept(2, 0.4, "x")
    with pytest.raises(quality.QualityError, match="4 of 4"):
        seen.require_kept(0, 1.0, "x")


def test_ingest_stops_when_everything_is_rejected(spark, frame):
    path, lake = scratch_path(spark, "landed"), jobs.Lake(scratch_path(spark, "lake"))
    schema = (
        "dispatching_base_num string, pickup_datetime timestamp_ntz, dropOff_datetime timestamp_ntz,"
        " PUlocationID long, DOlocationID long, SR_Flag long, Affiliated_base_number string"
    )
    frame(schema, ("B", at(1), at(1), 1, 2, 7, "A"), ("B", at(1), at(2), 1, 2, 7, "A")).write.parquet(path)
    with pytest.raises(quality.QualityError, match="2 of 2 rows rejected.*'dropoff_after_pickup': 1.*'flag_in_domain': 2"):
        jobs.ingest_dev(spark, path, "fhv", "2024_01", "2024_01", lake)


@pytest.mark.parametrize("batch_has_more", [True, False])
def test_an_upsert_keeps_columns_that_only_one_side_has(spark, frame, batch_has_more):
    path = scratch_path(spark, "table")
    short, wide = "k int, pickup_datetime timestamp_ntz, v int", "k int, pickup_datetime timestamp_ntz, v int, extra string"
    first = frame(short, (1, at(1), 1), (2, at(1), 2)) if batch_has_more else frame(wide, (1, at(1), 1, "a"), (2, at(1), 2, "b"))
    batch = frame(wide, (2, at(1), 20, "B"), (3, at(1), 30, "C")) if batch_has_more else frame(short, (2, at(1), 20), (3, at(1), 30))
    jobs.publish(first, path, "2024_01", "2024_01", True, ["k"])
    found = jobs.publish(batch, path, "2024_01", "2024_01", False, ["k"])
    rows = sorted((r.k, r.v, r.extra) for r in found.collect())
    assert rows == ([(1, 1, None), (2, 20, "B"), (3, 30, "C")] if batch_has_more else [(1, 1, "a"), (2, 20, "b"), (3, 30, None)])
    assert sorted((r.k, r.v, r.extra) for r in spark.read.parquet(path).collect()) == rows


def test_an_upsert_with_another_type_stops(spark, frame, table):
    with pytest.raises(quality.QualityError, match=r"\['note'\]"):
        jobs.publish(frame("k int, pickup_datetime timestamp_ntz, note int", (1, at(1), 5)), table, "2024_01", "2024_01", False, ["k"])
    assert stored(spark, table)[0] == (1, 1, "old")


def test_months_that_are_missing_empty_or_without_rows_are_found(spark, frame, table):
    gone = frame(SCHEMA, (8, at(5), "x")).where("k < 0").drop("pickup_datetime").coalesce(1)
    gone.write.parquet(f"{table}/year=2024/month=5")
    (spark.sparkContext._jvm.java.io.File(f"{table}/year=2024/month=6")).mkdirs()
    tables.append_months(frame(SCHEMA, (9, datetime(2023, 12, 1), "x")), table)
    months = jobs.month_tokens("2024_01", "2024_06")
    report = quality.check_months(spark, table, months, T.StructType.fromDDL(SCHEMA + ", year int, month int"))
    found = {r.year_month: (r.state, r.row_count, r.violations) for r in report.collect()}
    assert found == {
        "2024_01": ("filled", 1, 0), "2024_02": ("filled", 1, 0), "2024_03": ("filled", 1, 0), "2024_04": ("missing", 0, 1),
        "2024_05": ("filled", 0, 1), "2024_06": ("empty", 0, 1), "2023_12": ("unexpected", 1, 1),
    }
    with pytest.raises(quality.QualityError, match="4 checks failed"):
        quality.gate(report, "table")
    none = quality.check_months(spark, scratch_path(spark, "none"), months[:2])
    assert [r.state for r in none.collect()] == ["missing", "missing"]


def test_a_days_filter_skips_row_groups(spark):
    import pyarrow.parquet as pq

    path = scratch_path(spark, "layout")
    minutes = spark.range(40_000, numPartitions=4).select(
        (F.lit(at(1)).cast("timestamp_ntz") + F.make_dt_interval(mins=F.pmod(F.col("id") * 7919, F.lit(43_200)))).alias("pickup_datetime"),
        F.sha2(F.col("id").cast("string"), 256).alias("filler"),
    )
    spark.sparkContext._jsc.hadoopConfiguration().set("parquet.block.size", str(128 << 10))
    try:
        tables.overwrite_months(minutes, path)
    finally:
        spark.sparkContext._jsc.hadoopConfiguration().unset("parquet.block.size")
    files = [f.removeprefix("file:") for f in spark.read.parquet(path).inputFiles()]
    spans = []
    for file in files:
        meta = pq.ParquetFile(file.replace("//", "/")).metadata
        for k in range(meta.num_row_groups):
            column = next(meta.row_group(k).column(c) for c in range(meta.num_columns) if meta.row_group(k).column(c).path_in_schema == "pickup_datetime")
            spans.append((column.statistics.min, column.statistics.max))
    touched = [s for s in spans if s[0] < at(1, 11) and s[1] >= at(1, 10)]
    assert len(spans) >= 8 and len(touched) <= max(2, len(spans) // 4)
    assert clean.in_day(spark.read.parquet(path), "pickup_datetime", at(1, 10).date()).count() > 1000
