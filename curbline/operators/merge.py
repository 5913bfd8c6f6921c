"""Merges and upserts: each returns the new image of the target, and reads target and batch once.

Parquet tables have no MERGE. The caller writes the image over the touched
partitions only (see ``sinks.tables.overwrite_months``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curbline import fixed
from curbline.functions import dates
from curbline.operators import clean, tagged
from curbline.operators import keys as row_keys


def merge_by_key(target: DataFrame, updates: DataFrame, key: Sequence[str]) -> DataFrame:
    """Matched rows take the update, unmatched updates are inserted.

    Several updates of one key count as one: the first in column order.
    """
    return tagged.preferred(updates.select(*target.columns), target, key, one_first=True)


def replace_by_key(target: DataFrame, batch: DataFrame, key: Sequence[str]) -> DataFrame:
    """Target rows whose key is in the batch go; the whole batch comes in."""
    return tagged.preferred(batch.select(*target.columns), target, key)


def upsert_month(
    target: DataFrame,
    updates: DataFrame,
    year: int,
    month: int,
    keys: Sequence[str] = tuple(fixed.PRIMARY_KEY),
    ts_col: str = "pickup_datetime",
) -> DataFrame:
    """The new image of one month; rows of other months are left out."""
    return merge_by_key(
        clean.in_month(target, ts_col, year, month),
        clean.in_month(updates, ts_col, year, month),
        keys,
    )


def upsert_columns(
    target: DataFrame, updates: DataFrame, keys: Sequence[str], cols: Sequence[str]
) -> DataFrame:
    """As a merge, but matched rows take only the listed columns."""
    return tagged.updated(target, row_keys.distinct_on(updates.select(*target.columns), keys), keys, cols)


def reconcile(
    truth: DataFrame,
    other: DataFrame,
    key: str = "dwid",
    ts_col: str = "pickup_datetime",
    mode: str = "truth_only",
) -> DataFrame:
    """Truth-preferred merge of two keyed tables.

    ``truth_only`` keeps the truth side's rows that have a time; rows known only
    to the other side count as loss (see ``reconcile_loss``). That needs no
    join at all. ``coalesce`` also takes the other side's rows, and its values
    where the truth has none.
    """
    if mode == "truth_only":
        return truth.where(F.col(ts_col).isNotNull())
    if mode != "coalesce":
        raise ValueError(f"unknown mode: {mode}")
    shared = [c for c in truth.columns if c in other.columns]
    side = other.select(*[F.col(c).alias(f"__other_{c}") for c in shared])
    # Keys are unique on both sides, so no key is hot and one full join reads each side once.
    return (
        truth.join(side, F.col(key) == F.col(f"__other_{key}"), "full")
        .select(*[F.coalesce(F.col(c), F.col(f"__other_{c}")).alias(c) if c in shared else F.col(c) for c in truth.columns])
        .where(F.col(ts_col).isNotNull())
    )


def reconcile_loss(
    truth: DataFrame,
    other: DataFrame,
    level: str,
    key: str = "dwid",
    ts_col: str = "pickup_datetime",
) -> DataFrame:
    """Loss report of a ``truth_only`` merge, from the two key columns alone."""
    times = truth.select(key, ts_col)
    missing = other.select(key).join(times.select(key).distinct(), key, "left_anti")
    all_rows = times.select(ts_col).unionByName(
        missing.select(F.lit(None).cast(truth.schema[ts_col].dataType).alias(ts_col))
    )
    return loss_report(all_rows, ts_col, level)


def reconcile_loss_by_month(
    truth: DataFrame,
    other: DataFrame,
    level: str,
    keys: Sequence[str] = ("dwid",),
    ts_col: str = "pickup_datetime",
) -> DataFrame:
    """``reconcile_loss`` for each month, so that one bad month isn't hidden by good ones.

    A lost row counts in the month of its time on the other side; a truth row without a
    time in the month NULL.
    """
    month = F.date_format("__at", "yyyy_MM").alias("year_month")
    known = truth.select(*keys, F.col(ts_col).alias("__at"))
    missing = other.select(*keys, F.col(ts_col).alias("__at")).join(
        known.select(*keys).distinct(), list(keys), "left_anti"
    )
    absent = F.lit(None).cast(truth.schema[ts_col].dataType).alias(ts_col)
    all_rows = known.select(month, F.col("__at").alias(ts_col)).unionByName(missing.select(month, absent))
    return loss_report(all_rows, ts_col, level, by=["year_month"])


def loss_percent(total: Column, lost: Column) -> Column:
    return F.when(total == 0, F.lit(0.0)).otherwise(
        lost.cast("double") / F.nullif(total, F.lit(0)).cast("double") * 100
    )


def loss_report(df: DataFrame, ts_col: str, level: str, by: Sequence[str] = ()) -> DataFrame:
    """One row (or one per group of ``by``): rows, rows without a time, their percentage, and whether it is too high.

    The limit itself is already too high; an empty input never is.
    """
    if level not in fixed.LOSS_LIMITS:
        raise ValueError(f"unknown level {level!r}; choose from {sorted(fixed.LOSS_LIMITS)}")
    limit = fixed.LOSS_LIMITS[level]
    counts = df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(F.col(ts_col).isNull()).alias("lost_rows"),
    )
    percent = loss_percent(F.col("total_rows"), F.col("lost_rows"))
    return counts.select(
        *by,
        "total_rows",
        "lost_rows",
        percent.alias("loss_percent"),
        F.lit(limit).alias("limit_percent"),
        ((F.col("lost_rows") > 0) & (percent >= limit)).alias("breached"),
    )


def reload_month(
    target: DataFrame, rows: DataFrame, year_month: str, ts_col: str = "pickup_datetime"
) -> DataFrame:
    """The target with one month replaced by the given rows of that month."""
    fresh = clean.in_month(rows, ts_col, *dates.parse_month(year_month))
    return clean.delete_month(target, ts_col, year_month).unionByName(
        fresh.select(*target.columns)
    )
