from __future__ import annotations

import os
from datetime import date, datetime
from glob import glob

import pytest
from pyspark.sql import functions as F

from curbline import schemas
from curbline.operators import clean, quality
from curbline.session import scratch_path
from curbline.sinks import tables
from curbline.sources import files, jdbc

TRIPS = "id int, pickup_datetime timestamp_ntz, note string"


@pytest.fixture
def base(spark):
    return scratch_path(spark, "test")


def local(path):
    return path.removeprefix("file:")


def test_reports_and_gate(frame, rows):
    df = frame("a int, b int", (1, None), (None, None), (1, 1), (1, 1))
    assert rows(quality.check_not_null(df, ["a", "b"])) == [("a", 1), ("b", 2)]
    assert rows(quality.check_not_null(df, ["b"], F.col("a").isNull())) == [("b", 1)]
    assert rows(quality.check_unique(df, ["a"])) == [(1,)]
    assert rows(quality.check_accepted(df, "a", [2])) == [(1, 3)]
    assert rows(quality.check_relationship(df, "a", frame("k int", (2,)), "k")) == [(3, 1)]
    assert rows(quality.check_relationship(df, "a", frame("k int", (1,)), "k")) == [(0, 0)]
    assert rows(quality.column_profile(df)) == [("a", 3), ("b", 2)]
    with pytest.raises(quality.QualityError, match="a"):
        quality.gate(quality.check_not_null(df, ["a"]), "demo")
    quality.gate(quality.check_not_null(df, ["a"], F.col("a").isNotNull()), "demo")


def test_range_report_counts_null_as_broken_and_copies(frame, rows):
    df = frame("v int", (1,), (None,), (5,), (5,), (5,))
    assert rows(quality.check_ranges(df, {"small": F.col("v") < 3}, duplicates=True)) == [
        ("no_duplicates", 2), ("small", 4),
    ]


def test_schema_differences(frame, rows):
    df = frame("a int, b double, x string")
    expected = schemas.struct([("a", "int"), ("b", "float"), ("c", "string")])
    assert rows(quality.check_schema(df, expected)) == [
        ("b", "type", "float", "double"), ("c", "missing", "string", None), ("x", "extra", None, "string"),
    ]
    assert quality.check_schema(df, df.schema).count() == 0


def test_not_empty(frame):
    assert quality.check_not_empty(frame("a int, b int", (1, 1))).first().asDict() == {
        "row_count": 1, "column_count": 2, "passed": True,
    }
    assert not quality.check_not_empty(frame("a int")).first().passed


def test_overwriting_leaves_other_months(frame, spark, base):
    tables.overwrite_months(frame(TRIPS, (1, datetime(2023, 12, 1), "old"), (2, datetime(2024, 1, 1), "old")), base)
    tables.overwrite_months(frame(TRIPS, (3, datetime(2024, 1, 2), "new")), base)
    assert sorted(r.id for r in spark.read.parquet(base).collect()) == [1, 3]
    tables.append_months(frame(TRIPS, (4, datetime(2024, 1, 3), "more")), base)
    assert sorted(r.id for r in spark.read.parquet(base).collect()) == [1, 3, 4]
    assert sorted(map(tuple, quality.check_partitions(spark, base).collect())) == [(2023, 12, 1), (2024, 1, 2)]


def test_month_partition_read_prunes_and_fails_when_absent(frame, spark, base):
    with pytest.raises(FileNotFoundError):
        files.read_month_partition(spark, base, 2024, 1)
    tables.overwrite_months(frame(TRIPS, (1, datetime(2023, 12, 1), "x"), (2, datetime(2024, 1, 1), "x")), base)
    part = files.read_month_partition(spark, base, 2023, 12)
    assert [r.id for r in part.collect()] == [1]
    assert "PartitionFilters: [isnotnull(year" in part._jdf.queryExecution().executedPlan().toString()
    with pytest.raises(FileNotFoundError):
        files.read_month_partition(spark, base, 2022, 1)
    assert sorted(r.id for r in files.read_months(spark, base, "2023_12", "2024_01").collect()) == [1, 2]


def test_one_file_per_day_and_none_for_empty_days(frame, spark, base):
    days = [(i, datetime(2024, 2, 27 + i % 3, i % 24), "x") for i in range(90) if i % 3 != 1]
    tables.write_day_files(frame(TRIPS, *days).repartition(8), base)
    found = sorted(os.path.basename(p) for p in glob(f"{local(base)}/partition_date=*"))
    assert found == ["partition_date=2024-02-27", "partition_date=2024-02-29"]
    assert all(len(glob(f"{local(base)}/{d}/*.parquet")) == 1 for d in found)
    assert files.read_day_partitions(spark, base, 2024, 2).count() == 60
    assert files.read_day_partitions(spark, base, 2024, 3).count() == 0


def test_glob_reads_one_month_or_nothing(frame, spark, base):
    df = frame(TRIPS, (1, datetime(2024, 1, 31), "x"), (2, datetime(2024, 2, 1), "x"))
    tables.write_by_date(df, base)
    jan = files.read_partition_glob(spark, base, files.month_glob("partitioned_date", 2024, 1), df.schema)
    assert [r.id for r in jan.collect()] == [1]
    none = files.read_partition_glob(spark, base, files.month_glob("partitioned_date", 2025, 1), df.schema)
    assert none.count() == 0 and none.schema.names == df.columns


def test_missing_dates_are_written_once(frame, spark, base):
    first = frame("id int, day date", (1, date(2024, 1, 1)))
    second = frame("id int, day date", (2, date(2024, 1, 1)), (3, date(2024, 1, 2)))
    for batch in (first, second, second):
        tables.write_missing_dates(batch, base, "day")
    assert sorted(r.id for r in spark.read.parquet(base).collect()) == [1, 3]


def test_csv_returns_what_was_written(frame, spark, base, rows):
    df = frame(
        "a int, b string, ts timestamp_ntz, f float",
        (1, 'say "hi", ok', datetime(2024, 1, 1, 1, 2, 3, 456789), 1.5),
        (2, " padded ", datetime(2024, 1, 1), None),
        (3, None, None, 0.1),
        (4, "", None, -0.0),
        (None, "NULL", None, 3.0e7),
    )
    tables.export_csv(df, base)
    assert rows(files.load_csv(spark, base, df.schema)) == rows(df)


def test_csv_with_swapped_columns_is_refused(frame, spark, base):
    tables.export_csv(frame("ratecode_id int, vendor_id int", (1, 2)), base)
    swapped = schemas.struct([("vendor_id", "int"), ("ratecode_id", "int")])
    with pytest.raises(Exception, match="header|schema"):
        files.load_csv(spark, base, swapped).collect()


def test_lookup_csv(spark, base, tmp_path):
    path = tmp_path / "zones.csv"
    path.write_text(
        '"location_id","borough","zone","service_zone","latitude","longitude","geolocation"\n'
        '4,"M","Alphabet City","Yellow Zone","40.7","-73.9","(40.7, -73.9)"\n'
        '264,"Unknown","N/A","N/A",NULL,NULL,"N/A"\n'
        '5,"Q","Say ""Q"", twice","N/A",NULL,NULL,"N/A"\n'
    )
    found = {r.location_id: r for r in files.read_lookup(spark, str(path), schemas.ZONE).collect()}
    assert found[4].latitude == 40.7 and found[4].geolocation == "(40.7, -73.9)"
    assert found[264].latitude is None and found[264].borough == "Unknown"
    assert found[5].zone == 'Say "Q", twice'


def test_table_that_does_not_exist_is_empty(frame, spark, base):
    assert files.read_or_empty(spark, base, schemas.FACT).count() == 0
    frame("dwid string, more int", ("a", 1)).write.parquet(base)
    found = files.read_or_empty(spark, base, schemas.FACT)
    assert found.schema.names == schemas.FACT.names and found.first().dwid == "a"


def test_refresh_replaces(frame, spark, base):
    name = f"t_{os.path.basename(base).replace('-', '_')}"
    tables.refresh_table(frame("a int", (1,), (2,)), name, base)
    assert [r.a for r in tables.refresh_table(frame("a int", (3,)), name, base).collect()] == [3]


def test_views(frame, spark):
    df = frame(TRIPS, (1, datetime(2024, 1, 31), "x"), (2, datetime(2024, 2, 1), "x"))
    tables.month_view(df, "january", 2024, 1)
    assert spark.sql("SELECT count(*) FROM january").first()[0] == 1
    tables.table_view(spark, df, "everything")
    assert spark.sql("SELECT count(*) FROM everything").first()[0] == 2


def test_catalog(frame, rows):
    df = frame(TRIPS, (1, datetime(2023, 12, 31), "x"), (2, datetime(2023, 12, 1), "x"), (3, datetime(2024, 2, 29), "x"))
    assert rows(tables.partition_catalog(df, "trips")) == [
        ("trips_2023_12", date(2023, 12, 1), date(2024, 1, 1), 2),
        ("trips_2024_02", date(2024, 2, 1), date(2024, 3, 1), 1),
    ]


def test_ddl(frame):
    df = frame("a int, b string, c float, d double, e timestamp_ntz, f timestamp")
    assert tables.schema_ddl(df, "t") == (
        "CREATE TABLE IF NOT EXISTS t (a INT, b VARCHAR, c REAL, d DOUBLE PRECISION, e TIMESTAMP, f TIMESTAMP)"
    )
    with pytest.raises(TypeError, match="boolean"):
        tables.schema_ddl(frame("a boolean"), "t")


def test_scratch_lies_in_the_session_folder(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    one, two = scratch_path(spark, "x"), scratch_path(spark, "x")
    assert one.startswith(root) and one != two


def test_jdbc_options():
    bounds = (datetime(2023, 12, 1), datetime(2023, 12, 31, 23, 59, 59))
    options = jdbc.range_options("jdbc:x", "trips", "pickup_datetime", bounds, extra={"user": "u"})
    assert options == {
        "url": "jdbc:x", "dbtable": "trips", "user": "u", "partitionColumn": "pickup_datetime",
        "lowerBound": "2023-12-01 00:00:00", "upperBound": "2023-12-31 23:59:59", "numPartitions": "8",
    }
    assert "TIMESTAMP '2024-01-01 00:00:00'" in jdbc.month_bounds_query("trips", "ts", 2023, 12)
    assert jdbc.query_options("jdbc:x", "SELECT 1") == {"url": "jdbc:x", "query": "SELECT 1"}
    assert [jdbc.writer_count(n, 100) for n in (0, 1, 100, 101)] == [1, 1, 1, 2]
    with pytest.raises(ValueError):
        jdbc.writer_count(1, 0)
    with pytest.raises(ValueError):
        jdbc.write_jdbc(None, "jdbc:x", "t", mode="merge")


def test_rules_are_named_alike_for_gate_and_filter():
    assert set(clean.service_rules("yellow")) == set(clean.metered_rules())
    assert set(clean.service_rules("fhv")) == set(clean.fhv_rules())
