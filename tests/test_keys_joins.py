from __future__ import annotations

import hashlib
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from curbline.operators import joins, keys, sets, shape
from curbline import schemas


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_row_key_is_the_hash_of_the_text(frame):
    df = frame(
        "pickup_datetime timestamp_ntz, dropoff_datetime timestamp_ntz, pu_location_id int, do_location_id int",
        (datetime(2024, 1, 1, 8, 0, 0, 500000), datetime(2024, 1, 1, 9), 4, 7),
    )
    text = "2024-01-01 08:00:00.5_2024-01-01 09:00:00_4_7"
    keyed = keys.add_row_key(df)
    assert keyed.columns[0] == "dwid"
    assert keyed.first().dwid == hashlib.sha256(text.encode()).hexdigest()[:16]


def test_row_key_skips_nulls(frame):
    df = frame("a int, b int, c int", (1, None, 2), (1, 2, None))
    assert len({r.k for r in keys.add_row_key(df, ["a", "b", "c"], "k").collect()}) == 1


def test_first_row_does_not_depend_on_partitions(frame):
    df = frame("k int, a int, b string", *[(i % 3, i % 7, f"v{i:03d}") for i in range(200)])
    wanted = {(0, 0, "v000"), (1, 0, "v007"), (2, 0, "v014")}
    for parts in (1, 3, 8):
        assert set(map(tuple, keys.distinct_on(df.repartition(parts), ["k"]).collect())) == wanted


def test_hot_keys_are_reduced_before_the_shuffle(frame):
    df = frame("k int, a int", (1, 2), (1, 3))
    text = plan(keys.distinct_on(df, ["k"]))
    assert text.index("Final") < text.index("Exchange") < text.index("Partial")


def test_explicit_order_wins(frame, rows):
    df = frame("k int, a int, b int", (1, 1, 9), (1, 2, 8), (1, 3, None))
    assert rows(keys.distinct_on(df, ["k"], [F.col("a").desc()])) == [(1, 3, None)]
    assert rows(keys.distinct_on(df, ["k"], ["b"])) == [(1, 3, None)]
    assert rows(keys.distinct_on(df.select("k"), ["k"])) == [(1,)]


def test_duplicate_report_counts_null_keys_too(frame, rows):
    df = frame("a int, b int", (1, 1), (1, 1), (None, 1), (None, 1), (2, 2))
    assert rows(keys.duplicate_report(df, ["a", "b"])) == [(1, 1, 2), (None, 1, 2)]


def test_insert_if_absent_twice_adds_nothing(frame, rows):
    target = frame("id int, name string", (1, "a"))
    new = frame("id int, name string", (1, "other"), (2, "b"), (2, "c"))
    once = keys.insert_if_absent(target, new, ["id"])
    assert rows(once) == [(1, "a"), (2, "b")]
    assert rows(keys.insert_if_absent(once, new, ["id"])) == rows(once)


def test_lookup_keeps_unmatched_and_null(frame, rows):
    df = frame("id int, code int", (1, 1), (2, 9), (3, None))
    dim = frame("code int, name string", (1, "one"))
    assert rows(joins.lookup_join(df, dim, "code", "code")) == [(1, 1, "one"), (2, 9, None), (3, None, None)]


def test_two_holidays_on_a_date_do_not_multiply_trips(frame):
    trips = frame("pickup_datetime timestamp_ntz", (datetime(2024, 7, 4, 5),), (datetime(2024, 7, 5),))
    days = frame("holiday_date date, holiday_name string", (datetime(2024, 7, 4).date(), "b"), (datetime(2024, 7, 4).date(), "a"))
    found = {r.pickup_datetime.day: r.holiday_name for r in joins.calendar_join(trips, days).collect()}
    assert found == {4: "a", 5: None}
    assert joins.calendar_join(trips, days).count() == 2


@pytest.mark.parametrize("buckets", [1, 5])
def test_full_join_matches_brute_force(frame, rows, buckets):
    a_rows = [("x", i) for i in range(30)] + [("y", 1), (None, 2), ("only_a", 3)]
    b_rows = [("x", i) for i in range(4)] + [("y", 8), (None, 9), ("only_b", 1), ("only_b", 1)]
    expected = [(k, v, k, w) for k, v in a_rows for j, w in b_rows if k is not None and k == j]
    keys_a, keys_b = {k for k, _ in a_rows if k}, {k for k, _ in b_rows if k}
    expected += [(k, v, None, None) for k, v in a_rows if k not in keys_b]
    expected += [(None, None, k, v) for k, v in b_rows if k not in keys_a]
    joined = joins.salted_full_join(
        frame("key string, v int", *a_rows), frame("key string, v int", *b_rows), "key", buckets=buckets
    )
    assert rows(joined) == sorted(expected, key=lambda r: tuple(map(str, r)))


def test_orphans_and_matched_split_the_non_null_rows(frame, rows):
    df = frame("id int, fk int", (1, 1), (2, 9), (3, None))
    dim = frame("pk int", (1,), (1,), (2,))
    assert rows(joins.orphans(df, dim, "fk", "pk")) == [(2, 9)]
    assert rows(joins.matched(df, dim, "fk", "pk")) == [(1, 1)]


def test_empty_guard(frame, rows):
    df = frame("a int, b string", (1, "x"))
    assert rows(joins.empty_guard(df, {"b": "fhv"})) == [(1, "x")]
    assert rows(joins.empty_guard(df.where("a > 5"), {"b": "fhv"})) == [(None, "fhv")]


def test_no_operator_uses_a_broadcast_hint():
    import pathlib

    for path in (pathlib.Path(__file__).parents[1] / "curbline").rglob("*.py"):
        # The optional corpus part has its own rule and test.
        if "llm" not in path.parts:
            assert "broadcast(" not in path.read_text(), path


def test_sources_that_are_not_enabled_lose_rows_not_columns(frame):
    frames = {"a": frame("x int", (1,)), "b": frame("x int", (2,))}
    chosen = sets.select_sources(frames, ["a"])
    assert chosen["b"].schema == frames["b"].schema and chosen["b"].count() == 0
    with pytest.raises(ValueError):
        sets.select_sources(frames, ["c"])


def test_union_of_only_empty_inputs(frame):
    schema = schemas.struct([("x", "int"), ("y", "string")])
    assert sets.union_nonempty([frame("x int"), frame("y string")], schema, ["x"]).count() == 0
    with pytest.raises(ValueError):
        sets.union_nonempty([], schema)


def test_top_k_breaks_ties_by_name(frame):
    df = frame("name string, n int", ("c", 5), ("a", 5), ("b", 5), ("d", 9))
    assert [r.name for r in sets.top_k(df, "n", 3, ["name"]).collect()] == ["d", "a", "b"]
    assert "TakeOrderedAndProject" in plan(sets.top_k(df, "n", 3, ["name"]))


def test_limit_each_with_and_without_coarse_value(frame, rows):
    df = frame("v int, name string", *[(i % 7, f"n{i:02d}") for i in range(40)], (None, "first"))
    for n in (0, 1, 2, 7, 20, 41, 100):
        plain = rows(sets.limit_each([df, df], n, ["v", "name"]))
        assert len(plain) == 2 * min(n, 41)
        assert rows(sets.limit_each([df, df], n, ["v", "name"], F.col("v"))) == plain
        assert rows(sets.limit_each([df, df], n, ["v", "name"], F.floor(F.col("v") / 2))) == plain


def test_cast_turns_bad_values_into_null(frame, rows):
    df = frame("a string, b string", ("1", "x"), ("y", "z"))
    schema = schemas.struct([("a", "int"), ("missing", "float")])
    cast = shape.cast_to_schema(df, schema)
    assert cast.columns == ["a", "b"] and rows(cast) == [(1, "x"), (None, "z")]


def test_names(frame):
    df = frame("`Pick Up` int, VendorID int", (1, 2))
    assert shape.normalize_names(df).columns == ["pick_up", "vendorid"]
    assert shape.rename_columns(df, {"vendorid": "vendor_id"}).columns == ["Pick Up", "vendor_id"]
    assert shape.rename_positional(df, ["a", "b"]).columns == ["a", "b"]
    with pytest.raises(ValueError):
        shape.rename_positional(df, ["a"])
    assert shape.drop_columns(df, "VendorID", "none").columns == ["Pick Up"]
    assert shape.prefix_columns(df, "lh_").columns == ["lh_Pick Up", "lh_VendorID"]


def test_align_by_name_not_position(frame, rows):
    df = frame("vendor_id int, ratecode_id int, extra int", (1, 5, 0))
    target = schemas.struct([("ratecode_id", "int"), ("vendor_id", "int"), ("fare_amount", "float")])
    assert rows(shape.align_schema(df, target)) == [(5, 1, None)]


def test_distinct_in_time_shuffles_once_and_keeps_hot_keys_apart(spark):
    df = spark.range(6000).selectExpr(
        "IF(id % 3 = 0, 'hot', concat('k', id % 1999)) AS dwid",
        "timestamp_ntz'2024-01-01' + make_dt_interval(IF(id % 3 = 0, 0, CAST(id % 1999 % 60 AS INT))) AS at",
        "IF(id % 5 = 0, NULL, CAST(id * 7 % 6000 AS INT)) AS v",
    ).repartition(5)
    found = keys.distinct_in_time(df, ["dwid", "at"], "at")
    wanted = keys.distinct_on(df, ["dwid", "at"])
    assert found.count() == wanted.count() == 2000 and found.exceptAll(wanted).count() == 0
    # The hot key's rows are cut down in every task before they are shuffled.
    hot = found._jdf.queryExecution().executedPlan().toString()
    assert "__code" not in found.columns and hot.count("Exchange hashpartitioning") == 1
    cool = spark.range(3000).selectExpr("concat('k', id) AS dwid", "timestamp_ntz'2024-01-01' + make_dt_interval(CAST(id % 60 AS INT)) AS at", "id AS v")
    plan = keys.distinct_in_time(cool, ["dwid", "at"], "at")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "Exchange rangepartitioning" in plan
