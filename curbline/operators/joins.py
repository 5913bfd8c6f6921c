"""Joins with lookups, orphan checks and the full join.

No join here carries a broadcast hint. Spark broadcasts a side only when its
size, estimated before and measured at run time, is below
``spark.sql.autoBroadcastJoinThreshold``; beyond that it sorts and merges, and
adaptive execution splits hot keys. All joins are written in the forms whose
hot side it can split (left outer, left anti, left semi).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curbline.operators import shape


def lookup_join(
    df: DataFrame, dim: DataFrame, fk: str, pk: str, attributes: Sequence[str] | None = None
) -> DataFrame:
    """Add a lookup's attributes; rows without a match keep NULLs."""
    wanted = list(attributes) if attributes is not None else [c for c in dim.columns if c != pk]
    side = dim.select(F.col(pk).alias("__pk"), *wanted)
    return df.join(side, F.col(fk) == F.col("__pk"), "left").drop("__pk")


def role_join(
    df: DataFrame, dim: DataFrame, pk: str, roles: Mapping[str, str], attributes: Sequence[str]
) -> DataFrame:
    """Join one lookup several times: ``roles`` maps a suffix to its foreign key."""
    for suffix, fk in roles.items():
        renamed = dim.select(pk, *[F.col(a).alias(f"{a}_{suffix}") for a in attributes])
        df = lookup_join(df, renamed, fk, pk)
    return df


def calendar_join(
    df: DataFrame, holidays: DataFrame, ts_col: str = "pickup_datetime"
) -> DataFrame:
    """Add ``holiday_name`` by date; two holidays on one date give one row."""
    per_date = holidays.groupBy("holiday_date").agg(F.min("holiday_name").alias("holiday_name"))
    return df.join(per_date, F.to_date(ts_col) == F.col("holiday_date"), "left").drop(
        "holiday_date"
    )


def hot_keys(df: DataFrame, key: str, share: float = 0.01, tracked: int = 10_000) -> list:
    """Keys that hold at least ``share`` of the rows, by a sketch of frequent items.

    Every task adds up ``tracked`` candidates and the sketches are merged, so neither a shuffle of the
    keys nor the driver's memory grows with the table. All keys of that share are found.
    """
    most = int(1 / share) + 1
    found = df.agg(F.count(key).alias("n"), F.expr(f"approx_top_k(`{key}`, {most}, {tracked})").alias("top")).first()
    return [item["item"] for item in found["top"] or [] if item["count"] >= share * found["n"]]


def salted_full_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    prefixes: tuple[str, str] = ("lh_", "st_"),
    buckets: int = 1,
    share: float = 0.01,
) -> DataFrame:
    """Full outer join on one key, each side's columns prefixed.

    A full outer join cannot be split where one key is hot. With ``buckets > 1`` the keys that hold
    ``share`` of a side's rows are found first: their rows are spread over that many salts, and only
    the other side's rows of those keys are repeated once per salt. Each side is joined once.
    """
    lp, rp = prefixes
    lkey, rkey = F.col(lp + key), F.col(rp + key)
    a, b = shape.prefix_columns(left, lp), shape.prefix_columns(right, rp)
    hot_left = hot_keys(left, key, share) if buckets > 1 else []
    hot_right = [k for k in hot_keys(right, key, share) if k not in hot_left] if buckets > 1 else []
    if not hot_left and not hot_right:
        return a.join(b, lkey == rkey, "full")
    spread, repeated = lkey.isin(hot_left), lkey.isin(hot_right)
    a = a.withColumn("__lsalt", _salts(a, lkey, hot_left, hot_right, buckets)).withColumn("__left", F.lit(True))
    b = b.withColumn("__rsalt", _salts(b, rkey, hot_right, hot_left, buckets)).withColumn("__right", F.lit(True))
    both = a.join(b, (lkey == rkey) & (F.col("__lsalt") == F.col("__rsalt")), "full")
    # A repeated row has a partner in some salt; in the others it stands alone for nothing.
    spurious = (F.col("__left").isNull() & rkey.isin(hot_left)) | (F.col("__right").isNull() & repeated & ~spread)
    return both.where(~F.coalesce(spurious, F.lit(False))).drop("__lsalt", "__rsalt", "__left", "__right")


def _salts(df: DataFrame, key: Column, spread: list, repeated: list, buckets: int) -> Column:
    """A row's salt, or all of them. Rows without a key have no partner and are spread, too."""
    # A hash of the whole row, so that a task run again gives the same salt.
    own = F.pmod(F.xxhash64(*df.columns), F.lit(buckets)).cast("int")
    every = F.sequence(F.lit(0), F.lit(buckets - 1))
    return F.explode(
        F.when(key.isNull() | key.isin(spread), F.array(own)).when(key.isin(repeated), every).otherwise(F.array(F.lit(0)))
    )


def orphans(df: DataFrame, dim: DataFrame, fk: str, pk: str) -> DataFrame:
    """Rows whose foreign key is set but has no parent."""
    parents = dim.select(F.col(pk).alias("__pk")).distinct()
    return df.where(F.col(fk).isNotNull()).join(parents, F.col(fk) == F.col("__pk"), "left_anti")


def matched(df: DataFrame, dim: DataFrame, fk: str, pk: str) -> DataFrame:
    """Rows whose foreign key has a parent."""
    parents = dim.select(F.col(pk).alias("__pk"))
    return df.join(parents, F.col(fk) == F.col("__pk"), "left_semi")


def empty_guard(df: DataFrame, fallback: Mapping[str, object]) -> DataFrame:
    """The frame itself, or one fallback row when it has no rows."""
    row = df.sparkSession.range(1).select(
        *[F.lit(fallback.get(f.name)).cast(f.dataType).alias(f.name) for f in df.schema.fields]
    )
    return df.unionByName(row.where(~df.limit(1).exists()))
