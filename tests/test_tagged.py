"""Merges by a tagged union: results against plain rules, and each input scanned once."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from curbline.operators import joins, keys, merge, tagged
from curbline.session import scratch_path

SCHEMA = "k int, l int, v int, note string"


def some_rows(seed, n):
    rng = random.Random(seed)
    pick = lambda high: rng.choice([None, *range(high)]) if rng.random() < 0.2 else rng.randrange(high)
    return [(pick(6), pick(3), pick(4), rng.choice("ab")) for _ in range(n)]


def first_in_order(rows):
    return min(rows, key=lambda r: [(c is not None, c or 0) if not isinstance(c, str) else (True, c) for c in r[2:]])


def by_key(rows):
    out = {}
    for r in rows:
        out.setdefault(r[:2], []).append(r)
    return out


def expected(kind, target, batch):
    whole = lambda key: None not in key
    old, new = by_key(target), by_key(batch)
    if kind == "insert":
        return target + [first_in_order(own) for key, own in new.items() if not (whole(key) and key in old)]
    if kind == "columns":
        value = {key: first_in_order(own)[2] for key, own in new.items() if whole(key)}
        changed = [(*r[:2], value.get(r[:2], r[2]), r[3]) for r in target]
        return changed + [first_in_order(own) for key, own in new.items() if not (whole(key) and key in old)]
    kept = [r for r in target if not (whole(r[:2]) and r[:2] in new)]
    return kept + ([first_in_order(own) for own in new.values()] if kind == "merge" else batch)


OPERATORS = {
    "merge": lambda t, b: merge.merge_by_key(t, b, ["k", "l"]),
    "replace": lambda t, b: merge.replace_by_key(t, b, ["k", "l"]),
    "insert": lambda t, b: keys.insert_if_absent(t, b, ["k", "l"]),
    "columns": lambda t, b: merge.upsert_columns(t, b, ["k", "l"], ["v"]),
}


@pytest.mark.parametrize("kind", OPERATORS)
@pytest.mark.parametrize(("seed", "sizes"), [(1, (40, 30)), (2, (5, 60)), (3, (0, 12)), (4, (12, 0))])
def test_repeated_and_null_keys(frame, kind, seed, sizes):
    target, batch = some_rows(seed, sizes[0]), some_rows(seed + 50, sizes[1])
    found = OPERATORS[kind](frame(SCHEMA, *target).repartition(3), frame(SCHEMA, *batch).repartition(3))
    assert sorted(map(str, map(tuple, found.collect()))) == sorted(map(str, expected(kind, target, batch)))


def scans(df):
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    return plan.count("Relation [")


def stored(spark, n, salt):
    path = scratch_path(spark, "side")
    spark.range(n).selectExpr("cast(id as int) k", "1 l", f"cast(id % 7 + {salt} as int) v", "'x' note").write.parquet(path)
    return spark.read.parquet(path)


def test_every_input_is_scanned_once(spark):
    target, batch = stored(spark, 50, 0), stored(spark, 30, 1)
    for operator in OPERATORS.values():
        assert scans(operator(target, batch)) == 2
    assert scans(merge.reconcile(target, batch, "k", "v", mode="coalesce")) == 2
    assert scans(joins.salted_full_join(target, batch, "k")) == 2
    assert scans(joins.salted_full_join(target, batch, "k", buckets=4)) == 2


def test_losing_rows_of_a_hot_key_are_dropped_before_the_shuffle(spark):
    target, batch = stored(spark, 50, 0), stored(spark, 30, 1)
    plan = merge.merge_by_key(target, batch, ["k"])._jdf.queryExecution().executedPlan().toString()
    assert plan.index("WindowGroupLimit") < plan.index("Exchange hashpartitioning") < plan.rindex("WindowGroupLimit")


@pytest.mark.parametrize("hot_side", ["left", "right", "both"])
def test_full_join_of_hot_keys(frame, rows, hot_side):
    cold = [(f"c{k}", k) for k in range(300)]
    hot = [("hot", k) for k in range(120)] + [("none", k) for k in range(40)]
    few = [("hot", 1), ("hot", 2), (None, 3), (None, 3)]
    sides = {"left": (cold + hot, cold[:20] + few), "right": (cold[:20] + few, cold + hot), "both": (cold + hot[:9], cold + hot)}
    a, b = (frame("key string, v int", *side) for side in sides[hot_side])
    assert "hot" in joins.hot_keys(a if hot_side == "left" else b, "key")
    found = joins.salted_full_join(a, b, "key", buckets=4)
    assert rows(found) == rows(joins.salted_full_join(a, b, "key"))
    assert "explode" in found._jdf.queryExecution().optimizedPlan().toString()


def test_hot_keys_are_all_found(spark):
    df = spark.range(200_000).select(F.when(F.col("id") % 50 == 0, "a").when(F.col("id") % 20 == 1, "b").otherwise(F.col("id").cast("string")).alias("k"))
    assert sorted(joins.hot_keys(df.repartition(7), "k")) == ["a", "b"]
    assert joins.hot_keys(df.where("k = 'zz'"), "k") == []


def test_tagged_union_keeps_the_column_order(frame):
    both = tagged.tagged(frame("a int, b int", (1, 2)), frame("b int, a int", (3, 4)))
    assert both.columns == ["__side", "a", "b"] and sorted(map(tuple, both.collect())) == [(0, 1, 2), (1, 4, 3)]
