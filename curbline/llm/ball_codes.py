"""Vector codes by ball k-means: every part of a vector becomes the index of a codebook entry.

Vectors are cut into equal consecutive parts, and every part position has a codebook of its own.
An entry and the parts assigned to it form a ball. After a round, each entry's radius (the
farthest of its parts, moved on by the entry's own shift) names its neighbours: only entries
nearer than twice the radius can take a part from it. A part nearer to its entry than half the
way to the nearest neighbour lies in the stable core and is not compared at all. For one outside,
the ring in which it lies, between half the ways to two consecutive neighbours, says how many of
the nearest neighbours can be as near as its entry; only those are measured. Everything is integer
arithmetic, so ties and results are exact: the same as comparing every part with every entry.

A round is one pass over a written table of vectors and owners; what goes through the driver is
one row of counts, sums and radius per part and entry, whatever the number of vectors.

Defined results: vectors that are NULL or empty, or hold a NULL or non-finite component, are left
out; others of different lengths, of a length that the parts don't divide, or too large for exact
arithmetic raise ValueError. The first codebooks are the vectors of the smallest ids, NULL ids last,
ties by the vector; with fewer vectors there are fewer entries. An entry that nothing uses stays. A
NULL id is coded like any other, repeated rows keep their multiplicity, NULL labels form one
group, an empty table gives an empty table, and further columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curbline.llm.common import scratch
from curbline.llm.vectors import as_lists, as_matrix, on_grid
from curbline.session import remove_path

PARTS = 16
ENTRIES = 64
ROUNDS = 2
SCALE = 256.0


class Codebooks(NamedTuple):
    """``entries`` by part position, entry, and place within the part."""

    entries: np.ndarray

    def sha256(self) -> str:
        """Of all components as decimal integers, joined by commas."""
        return hashlib.sha256(",".join(map(str, self.entries.ravel().tolist())).encode()).hexdigest()

    def decode(self, codes: np.ndarray) -> np.ndarray:
        """The grid vectors that rows of codes stand for."""
        parts = [self.entries[p, codes[:, p]] for p in range(len(self.entries))]
        return np.concatenate(parts, axis=1)


class Compressed(NamedTuple):
    """``rows``: id, label, ``code`` (one byte a part), ``error`` and ``label_error``."""

    rows: DataFrame
    codebooks: Codebooks


class Neighbours(NamedTuple):
    """For each entry of one codebook its neighbours, nearest first, and the squared ways to them.

    Places behind the last neighbour hold a way that no ring reaches.
    """

    entries: np.ndarray
    ways: np.ndarray


_NEVER = np.iinfo(np.int64).max


def nearest(x: np.ndarray, book: np.ndarray) -> np.ndarray:
    """The nearest entry of every part, compared with all; ties go to the lower index."""
    entries = book.astype(np.float64)
    return np.argmin((entries**2).sum(1) - 2 * (x.astype(np.float64) @ entries.T), axis=1)


def squared(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return ((a - b) ** 2).sum(-1)


def neighbours(book: np.ndarray, radii: np.ndarray) -> Neighbours:
    """Entries that can take a part from each entry, whose parts lie within ``radii`` of it."""
    k = len(book)
    ways = squared(book[:, None], book[None])
    # Rounding must not lose one that lies exactly on the border.
    reach = 4 * (radii * (1 + 1e-9) + 1e-6) ** 2
    ways = np.where((ways <= reach[:, None]) & ~np.eye(k, dtype=bool), ways, _NEVER)
    order = np.argsort(ways, axis=1, kind="stable")
    return Neighbours(order, np.take_along_axis(ways, order, axis=1))


def moved(x: np.ndarray, owners: np.ndarray, book: np.ndarray, near: Neighbours) -> tuple[np.ndarray, np.ndarray, int]:
    """New owners of parts and the squared distances to them, and how many distances were measured."""
    own = squared(x, book[owners])
    # Ties go to the lower index, so an entry exactly as near still counts.
    rings = (near.ways[owners] <= 4 * own[:, None]).sum(1)
    outside = np.flatnonzero(rings)
    if not len(outside):
        return owners, own, len(x)
    counts = rings[outside]
    edges = np.cumsum(counts) - counts
    row = np.repeat(outside, counts)
    other = near.entries[owners[row], np.arange(len(row)) - np.repeat(edges, counts)]
    k = np.int64(len(book))
    best = np.minimum.reduceat(squared(x[row], book[other]) * k + other, edges)
    best = np.minimum(best, own[outside] * k + owners[outside])
    owners, own = owners.copy(), own.copy()
    owners[outside], own[outside] = best % k, best // k
    return owners, own, len(x) + len(row)


def _sums(width: int) -> list[str]:
    return [f"s{i}" for i in range(width)]


def _entry_stats(assigned: DataFrame, books: np.ndarray) -> DataFrame:
    """Per part position and entry: its parts, their sums, and the farthest's squared distance."""
    n_parts, k, width = books.shape
    names = ["part", "entry", "n", "reach", *_sums(width)]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((n_parts, k, 2 + width), np.int64)
        for batch in batches:
            x = as_matrix(batch.column(0)).reshape(batch.num_rows, n_parts, width)
            owners = _owners(batch.column(1), n_parts)
            for p in range(n_parts if len(x) else 0):
                own = owners[:, p]
                total[p, :, 0] += np.bincount(own, minlength=k)
                np.maximum.at(total[p, :, 1], own, squared(x[:, p], books[p][own]))
                for i in range(width):
                    np.add.at(total[p, :, 2 + i], own, x[:, p, i])
        part, entry = np.nonzero(total[:, :, 0])
        found = total[part, entry]
        yield pa.RecordBatch.from_arrays([pa.array(c) for c in (part, entry, *found.T)], names=names)

    partial = assigned.select("x", "owners").mapInArrow(work, ", ".join(f"{n} long" for n in names))
    sums = [F.sum(c).alias(c) for c in ["n", *_sums(width)]]
    return partial.groupBy("part", "entry").agg(*sums, F.max("reach").alias("reach"))


def _owners(column: pa.Array, parts: int) -> np.ndarray:
    """Codes of one byte a part, as a matrix."""
    raw = b"".join(column.to_pylist())
    return np.frombuffer(raw, np.uint8).reshape(len(column), parts).astype(np.int64)


def _codes(owners: np.ndarray) -> pa.Array:
    raw = owners.astype(np.uint8)
    return pa.array([row.tobytes() for row in raw], pa.binary())


def _renewed(books: np.ndarray, stats: list) -> tuple[np.ndarray, np.ndarray]:
    """Codebooks of the parts' means, rounded down, and the entries' radii around the new places."""
    new, radii = books.copy(), np.zeros(books.shape[:2])
    for r in stats:
        sums = np.array([r[c] for c in _sums(books.shape[2])], np.int64)
        new[r["part"], r["entry"]] = sums // r["n"]
        radii[r["part"], r["entry"]] = np.sqrt(r["reach"])
    return new, radii + np.sqrt(squared(new, books))


def compress(
    df: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
    scale: float = SCALE,
) -> Compressed:
    """Codes of all vectors, after ``rounds`` of assignment and renewal and a last assignment.

    ``error`` is the squared distance between a vector and what its code stands for, on the grid
    of ``floor(scale * x)``; ``label_error`` its sum over the rows of the same label.
    """
    if not 0 < entries <= 256:
        raise ValueError("a code has one byte a part: choose 1 to 256 entries")
    if rounds < 1:
        raise ValueError("at least one round is needed")
    spark = df.sparkSession
    source = df.select(
        F.col(id_col).cast("long").alias("id"), F.col(label_col).alias("label"), F.col(vector_col).alias("v")
    )
    label_type = source.schema["label"].dataType.simpleString()

    def to_grid(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            whole, grid = on_grid(batch.column(1), scale)
            ids = batch.column(0).filter(pa.array(whole))
            yield pa.RecordBatch.from_arrays([ids, as_lists(grid)], names=["id", "x"])

    first = (
        source.select("id", "v").mapInArrow(to_grid, "id long, x array<int>").orderBy(F.asc_nulls_last("id"), "x").limit(entries).collect()
    )
    if not first:
        rows = source.limit(0).select("id", "label", F.lit(b"").alias("code"), F.lit(0).cast("long").alias("error"))
        return Compressed(_named(rows.withColumn("label_error", F.col("error")), id_col, label_col), Codebooks(np.zeros((parts, 0, 0), np.int64)))
    length = len(first[0]["x"])
    if length % parts:
        raise ValueError(f"{parts} equal parts can't be cut from {length} components")
    width = length // parts
    books = np.array([r["x"] for r in first], np.int64).reshape(len(first), parts, width).transpose(1, 0, 2)

    def begin(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            whole, grid = on_grid(batch.column(2), scale, length)
            kept = batch.filter(pa.array(whole))
            x = grid.reshape(len(grid), parts, width)
            owners = np.stack([nearest(x[:, p], books[p]) for p in range(parts)], axis=1)
            yield pa.RecordBatch.from_arrays(
                [kept.column(0), kept.column(1), as_lists(grid), _codes(owners)], names=["id", "label", "x", "owners"]
            )

    table = f"id long, label {label_type}, x array<int>, owners binary"
    assigned, path = scratch(source.mapInArrow(begin, table), "codes")
    for number in range(1, rounds + 1):
        books, radii = _renewed(books, _entry_stats(assigned, books).collect())
        step = _reassign(books, [neighbours(b, r) for b, r in zip(books, radii, strict=True)], number == rounds)
        after = f"id long, label {label_type}, code binary, error long" if number == rounds else table
        before = path
        assigned, path = scratch(assigned.mapInArrow(step, after), "codes")
        remove_path(spark, before)

    by_label = assigned.groupBy(F.col("label").alias("__label")).agg(F.sum("error").alias("label_error"))
    rows = assigned.join(by_label, F.col("label").eqNullSafe(F.col("__label"))).drop("__label")
    return Compressed(_named(rows, id_col, label_col), Codebooks(books))


def _reassign(books: np.ndarray, near: list[Neighbours], last: bool):
    """One pass over vectors and owners; the last one leaves codes and errors."""
    parts, _, width = books.shape

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = as_matrix(batch.column(2)).reshape(batch.num_rows, parts, width)
            owners = _owners(batch.column(3), parts)
            error = np.zeros(len(x), np.int64)
            for p in range(parts):
                owners[:, p], own, _ = moved(x[:, p], owners[:, p], books[p], near[p])
                error += own
            if last:
                columns = [batch.column(0), batch.column(1), _codes(owners), pa.array(error)]
                yield pa.RecordBatch.from_arrays(columns, names=["id", "label", "code", "error"])
            else:
                columns = [*batch.columns[:3], _codes(owners)]
                yield pa.RecordBatch.from_arrays(columns, names=["id", "label", "x", "owners"])

    return work


def _named(rows: DataFrame, id_col: str, label_col: str) -> DataFrame:
    return rows.withColumnsRenamed({"id": id_col, "label": label_col})
