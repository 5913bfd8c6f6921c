from __future__ import annotations

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from curbline.operators import clean

TS = "id int, ts timestamp_ntz"


def ids(df):
    return sorted(r.id for r in df.collect())


def test_month_is_half_open(frame):
    df = frame(
        TS,
        (1, datetime(2023, 11, 30, 23, 59, 59, 999999)),
        (2, datetime(2023, 12, 1)),
        (3, datetime(2023, 12, 31, 23, 59, 59, 500000)),
        (4, datetime(2024, 1, 1)),
        (5, None),
    )
    assert ids(clean.in_month(df, "ts", 2023, 12)) == [2, 3]
    assert ids(clean.in_months(df, "ts", "2023_11", "2023_12")) == [1, 2, 3]
    assert ids(clean.delete_month(df, "ts", "2023_12")) == [1, 4, 5]


def test_day_keeps_its_last_fraction(frame):
    df = frame(
        TS,
        (1, datetime(2024, 2, 29)),
        (2, datetime(2024, 2, 29, 23, 59, 59, 500000)),
        (3, datetime(2024, 3, 1)),
    )
    assert ids(clean.in_day(df, "ts", date(2024, 2, 29))) == [1, 2]


def test_month_filter_reaches_the_scan(spark):
    events = spark.read.parquet("/root/testdata/sf0.001/events.parquet")
    plan = clean.in_month(events, "ts", 2024, 1)._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(ts," in plan and "LessThan(ts," in plan


def test_bounds_exclude_low_include_high_and_null(frame):
    df = frame("id int, v float", (1, 0.0), (2, 0.1), (3, 10000.0), (4, 10000.5), (5, None))
    assert ids(clean.in_bounds(df, "v", 0, 10000)) == [2, 3]
    assert ids(clean.in_bounds(df, "v", 0)) == [2, 3, 4]
    assert ids(clean.in_bounds(df, "v")) == [1, 2, 3, 4, 5]


def test_interval_modes(frame):
    a, b = datetime(2024, 1, 1), datetime(2024, 1, 2)
    df = frame("id int, s timestamp_ntz, e timestamp_ntz", (1, a, b), (2, b, a), (3, a, a), (4, None, a))
    assert ids(clean.valid_interval(df, "s", "e")) == [1, 2]
    assert ids(clean.valid_interval(df, "s", "e", "ordered")) == [1]
    with pytest.raises(ValueError):
        clean.valid_interval(df, "s", "e", "other")


def test_null_rules(frame):
    df = frame("id int, a int, b int", (1, 1, 1), (2, None, 1), (3, 1, None), (4, None, None))
    assert ids(clean.drop_null_keys(df, ["a"])) == [1, 3]
    assert ids(clean.drop_any_null(df)) == [1]
    assert ids(clean.drop_any_null(df, ["b"])) == [1, 3]
    assert ids(clean.drop_any_null(df, ["id", "a", "b"])) == [1, 2, 3, 4]


def test_lenient_numbers(frame):
    df = frame("id int, v string", (1, "1.0"), (2, "7"), (3, ""), (4, "x"), (5, None), (6, "2.9"), (7, "-2.9"), (8, "1e12"), (9, "3000000000"), (10, "9007199254740993"))
    found = {r.id: r.v for r in clean.coerce_int(df, ["v"]).collect()}
    assert found == {1: 1, 2: 7, 3: 0, 4: 0, 5: 0, 6: 2, 7: -2, 8: 10**12, 9: 3 * 10**9, 10: 9007199254740993}


def test_codes_and_blanks(frame):
    df = frame("id int, c string", (1, "1"), (2, " 6 "), (3, "7"), (4, ""), (5, None), (6, "99"))
    codes = {r.id: r.c for r in clean.invalidate_codes(df, "c", [1, 2, 3, 4, 5, 6]).collect()}
    assert codes == {1: 1, 2: 6, 3: None, 4: None, 5: None, 6: None}
    filled = {r.id: r.c for r in clean.blank_to_default(df, "c", "UNKNOWN").collect()}
    assert filled == {1: "1", 2: "6", 3: "7", 4: "UNKNOWN", 5: "UNKNOWN", 6: "99"}


def test_fill_defaults_keeps_types_and_ignores_unknown_columns(frame):
    df = frame("a int, b string", (None, None), (2, "x"))
    filled = clean.fill_defaults(df, {"a": 0, "b": "UNKNOWN", "c": 1})
    assert filled.schema == df.schema or [f.dataType for f in filled.schema] == [
        f.dataType for f in df.schema
    ]
    assert sorted(map(tuple, filled.collect())) == [(0, "UNKNOWN"), (2, "x")]


def test_watermark_with_and_without_target_rows(frame):
    df = frame(TS, (1, datetime(2024, 1, 1)), (2, datetime(2024, 1, 2)), (3, datetime(2024, 1, 3)))
    target = df.where("id <= 2")
    assert ids(clean.since_high_watermark(df, target, "ts")) == [3]
    assert ids(clean.since_high_watermark(df, df.where("id > 9"), "ts")) == [1, 2, 3]


def test_sample_never_asks_for_more_than_all(frame):
    df = frame("id int", *[(i,) for i in range(50)])
    assert clean.sample_to(df, 1000, seed=1).count() == 50
    assert clean.sample_to(df, 0).count() == 50
    assert 0 < clean.sample_to(df, 25, seed=1).count() < 50


TRIP = (
    "pickup_datetime timestamp_ntz, dropoff_datetime timestamp_ntz, passenger_count int,"
    " trip_distance float, store_and_fwd_flag string, pu_location_id int, do_location_id int,"
    " fare_amount float, year int, month int"
)


def test_metered_rules_then_shortened_flag(frame):
    a, b = datetime(2024, 1, 1, 8), datetime(2024, 1, 1, 9)
    good = (a, b, 1, 2.0, "YES", 1, 2, 10.0, 2024, 1)
    other_flag = (a, b, 1, 2.0, "YEP", 1, 2, 10.0, 2024, 1)
    bad = [
        (a, a, 1, 2.0, "N", 1, 2, 10.0, 2024, 1),
        (a, b, 0, 2.0, "N", 1, 2, 10.0, 2024, 1),
        (a, b, None, 2.0, "N", 1, 2, 10.0, 2024, 1),
        (a, b, 1, 0.0, "N", 1, 2, 10.0, 2024, 1),
        (a, b, 1, 2.0, "N", None, 2, 10.0, 2024, 1),
        (a, b, 1, 2.0, "N", 1, 2, 100000.5, 2024, 1),
    ]
    cleaned = clean.clean_trips(frame(TRIP, good, good, other_flag, *bad), "yellow")
    assert "year" not in cleaned.columns and "month" not in cleaned.columns
    assert [r.store_and_fwd_flag for r in cleaned.collect()] == ["Y", "Y"]


def test_fhv_rules(frame):
    df = frame(
        "id int, pickup_datetime string, dropoff_datetime string, pu_location_id int,"
        " do_location_id int, sr_flag int",
        (1, "2024-01-01 08:00:00", "2024-01-01 09:00:00", 1, 2, None),
        (2, "2024-01-01 08:00:00", "2024-01-01 08:00:00", 1, 2, 1),
        (3, "2024-01-01 08:00:00", "2024-01-01 09:00:00", 1, 2, 3),
        (4, "broken", "2024-01-01 09:00:00", 1, 2, 1),
        (5, "2024-01-01 08:00:00", "2024-01-01 09:00:00", 1, None, 1),
    )
    found = clean.clean_trips(df, "fhv").collect()
    assert [(r.id, r.sr_flag) for r in found] == [(1, 0)]
    assert found[0].pickup_datetime == datetime(2024, 1, 1, 8)


def test_empty_input(spark, frame):
    empty = frame(TRIP)
    assert clean.clean_trips(empty, "green").count() == 0
    assert clean.clean_trips(empty.withColumn("sr_flag", F.lit(0)), "fhv").count() == 0


@pytest.mark.parametrize("n", [1, 7, 25, 199, 200, 1000])
def test_samples_are_exact_and_the_same_each_time(spark, frame, rows, n):
    # A third of the rows are copies of one.
    values = [(k % 3, 0 if k % 3 == 0 else k) for k in range(600)]
    df = frame("g int, v int", *values)
    for parts in (1, 5):
        drawn = clean.sample_each(df.repartition(parts), n, F.col("g"), 4)
        counts = {r["g"]: r["count"] for r in drawn.groupBy("g").count().collect()}
        assert counts == dict.fromkeys(range(3), min(n, 200))
        assert rows(drawn) == rows(clean.sample_each(df, n, F.col("g"), 4))
    assert set(rows(drawn)) <= set(values)
    if n == 25:
        assert rows(clean.sample_each(df, n, F.col("g"), 5)) != rows(drawn)
    assert clean.sample_to(df, n, 4).count() == min(n, 600)


def test_samples_of_no_rows_and_null_groups(frame):
    df = frame("g int, v int", *[(None, k) for k in range(30)], *[(1, k) for k in range(3)])
    assert clean.sample_each(df, 5, F.col("g")).groupBy("g").count().orderBy("g").collect() == [(None, 5), (1, 3)]
    assert clean.sample_to(df.where("v > 99"), 5).count() == 0
