"""Unions, distinct values, ordering and limits."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from curbline.operators import clean, shape


def union_services(frames: Sequence[DataFrame]) -> DataFrame:
    """UNION ALL by column name."""
    return reduce(DataFrame.unionByName, frames)


def union_nonempty(
    frames: Sequence[DataFrame],
    schema: T.StructType,
    int_cols: Sequence[str] = (),
) -> DataFrame:
    """Union of frames aligned to one schema, with id columns made whole numbers.

    Empty inputs are typed, so they need no skipping: the optimizer drops them.
    """
    if not frames:
        raise ValueError("no frames to union")
    together = union_services([shape.align_schema(f, schema) for f in frames])
    return clean.coerce_int(together, [c for c in int_cols if c in together.columns], kind="int")


def select_sources(frames: Mapping[str, DataFrame], enabled: Sequence[str]) -> dict[str, DataFrame]:
    """Every source by name; the ones not enabled keep their schema and lose their rows."""
    unknown = set(enabled) - set(frames)
    if unknown:
        raise ValueError(f"unknown sources: {sorted(unknown)}")
    return {
        name: frame if name in enabled else shape.empty_frame(frame.sparkSession, frame.schema)
        for name, frame in frames.items()
    }


def distinct_years(df: DataFrame, ts_col: str = "pickup_datetime") -> DataFrame:
    """The years that occur."""
    return df.select(F.year(ts_col).alias("year")).distinct()


def unique_values(df: DataFrame, col: str) -> DataFrame:
    """The distinct values of one column."""
    return df.select(col).distinct()


def order_summary(df: DataFrame, by: Sequence[str], descending: bool = False) -> DataFrame:
    """Sorted by the given columns."""
    return df.orderBy(*[F.col(c).desc() if descending else F.col(c).asc() for c in by])


def top_k(df: DataFrame, measure: str, k: int, tiebreak: Sequence[str]) -> DataFrame:
    """The ``k`` rows with the largest measure; equal rows by the tiebreak columns.

    Each task keeps its own ``k`` rows, so nothing is sorted as a whole.
    """
    return df.orderBy(F.col(measure).desc(), *[F.col(c).asc() for c in tiebreak]).limit(k)


def limit_each(
    frames: Sequence[DataFrame], n: int, order: Sequence[str], coarse: Column | None = None
) -> DataFrame:
    """The first ``n`` rows of each frame, then their union.

    ``coarse`` is a value that grows with the first order column, such as its
    date. A sketch of it tells where the ``n``-th row lies, so that only rows up
    to there are ordered; without it every task would hand ``n`` rows to the one
    task that merges them.
    """
    return union_services(
        [
            (f if coarse is None else _up_to_row(f, n, coarse)).orderBy(*order).limit(n)
            for f in frames
        ]
    )


#: The quantiles that place a cut-off, and the error of their ranks, which is far below their distance.
_STEPS, _ACCURACY = 1000, 10_000


def _up_to_row(df: DataFrame, n: int, coarse: Column) -> DataFrame:
    """Rows up to a value that is sure to have ``n`` rows at or before it, and not many more.

    The value comes from a quantile sketch, which every task fills and which are merged, with the
    count in the same pass. Its ranks are at most a step too low, so the cut-off lies two steps on.
    """
    quantiles = F.percentile_approx(coarse, [k / _STEPS for k in range(1, _STEPS + 1)], _ACCURACY)
    step = F.ceil(F.lit(n) * _STEPS / F.greatest(F.count(coarse), F.lit(1))) + 2
    cutoff = df.agg(F.get(quantiles, F.least(step, F.lit(_STEPS)).cast("int") - 1).alias("at")).scalar()
    return df.where(F.coalesce(coarse <= cutoff, F.lit(True)))
