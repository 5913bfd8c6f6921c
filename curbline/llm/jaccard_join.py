"""Exact Jaccard self-join of documents on word shingles, as a metric-space join.

Distance is one minus Jaccard similarity, a metric; two documents link within ``RADIUS``.

1. *Sets.* Documents with equal shingle sets are one node, known by a digest of the set.
   Counts of all shingles, in a table of fixed size, give an order in which frequent shingles
   come last; only that order depends on it, never a result.
2. *Pivots and regions.* Each set shows its first shingles in this order: as many as a partner can
   lack, and a tenth of its size more. Two sets within the radius then share that tenth among what
   they show. Of the sets that show a shingle, the one with the least digest is its pivot, and the
   pivot's region holds them all: both sets of any link lie in a common region, and a set at the
   border of several regions is in each of them. Sets that share too few shingles to have a
   partner, in all or in a region, leave.
3. *Recursive join.* In a region all distances to the pivot are computed. Sets within the radius
   are linked to it, and so need no comparison with each other. By the triangle inequality a set
   can only link to sets whose distance to the pivot differs by the radius at most: sets outside
   the inner ball, and the inner ones within that window of them, form the next region, with a
   new pivot, until none is left outside.
4. A region too large for a task first gets its distances to the pivot from a join, in as many tasks as
   there are; then only what is outside the inner ball is dealt in blocks against the blocks of
   the window.
5. Components of the links give each document's class.

Nothing is capped, and no pair is skipped but those the inequality excludes or that are known to
be in one component already.

Defined results: NULL, empty and blank texts have no shingles, link with nothing and keep their
own id as class. Ids are expected to be unique and not NULL; rows with a NULL id are returned
with a NULL class and link with nothing; rows repeated under one id are one document if their
texts are equal. An empty table gives an empty table; further columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curbline.llm.common import scratch, slices
from curbline.llm.components import connected_components
from curbline.llm.words import SHINGLE, common, shingle_sets

#: Sets link when 100 * intersection >= PERCENT * union.
PERCENT = 75
#: Slots of the table of shingle counts; half a MB, whatever the corpus.
COUNT_SLOTS = 1 << 16
#: Sets that one task joins at once; larger regions are dealt in blocks.
REGION_SETS = 1024


def linked(a: np.ndarray, b: np.ndarray, percent: int = PERCENT) -> tuple[bool, float]:
    """Whether two sets link, and their distance."""
    both = common(a, b)
    union = len(a) + len(b) - both
    return 100 * both >= percent * union, 1 - both / union


def shared_size(n: int) -> int:
    """How many first shingles, at least, sets of ``n`` and more show in common when they link."""
    return 1 + n // 10


def prefix_size(n: int, percent: int = PERCENT) -> int:
    """How many shingles a set of ``n`` shows: as many as a partner can lack, and the shared ones."""
    return n - -(-n * percent // 100) + shared_size(n)


class Region:
    """The sets of one region, and the forest of links found among them."""

    def __init__(self, sets: list[np.ndarray], percent: int) -> None:
        self.sizes = np.array([len(s) for s in sets])
        self.starts = np.cumsum(self.sizes) - self.sizes
        names, self.flat = np.unique(np.concatenate(sets), return_inverse=True)
        self._marked = np.zeros(len(names), bool)
        self.percent = percent
        self.parent = np.arange(len(sets))
        self.links: list[tuple[int, int]] = []

    def distances(self, i: int) -> tuple[np.ndarray, np.ndarray]:
        """Which sets link to set ``i``, and all distances to it."""
        own = self.flat[self.starts[i] : self.starts[i] + self.sizes[i]]
        self._marked[own] = True
        both = np.add.reduceat(self._marked[self.flat], self.starts, dtype=np.int64)
        self._marked[own] = False
        union = self.sizes + self.sizes[i] - both
        return 100 * both >= self.percent * union, 1 - both / union

    def add(self, i: int, others: np.ndarray) -> None:
        """Tie ``i`` to those others that are not in its component yet."""
        for j in others.tolist():
            if self.parent[i] != self.parent[j]:
                low, high = sorted((self.parent[i], self.parent[j]))
                self.parent[self.parent == high] = low
                self.links.append((i, j))


def join_region(sets: list[np.ndarray], outside: list[bool] | None = None, percent: int = PERCENT) -> list[tuple[int, int]]:
    """A forest with the components of all links that have at least one end ``outside`` (default: both).

    No set is empty.
    """
    n, reach = len(sets), 1 - percent / 100 + 1e-9
    region, rows, pivots = Region(sets, percent), [], []
    out = np.ones(n, bool) if outside is None else np.array(outside, bool)
    window, rest = np.ones(n, bool), out.copy()
    # Pivots, until each outside set is one or is linked to one.
    while rest.any():
        pivot = int(np.argmax(rest))
        near, far = region.distances(pivot)
        window[pivot] = rest[pivot] = False
        rows.append(np.where(window, far, np.nan))
        rows[-1][pivot] = 0
        pivots.append(pivot)
        region.add(pivot, np.flatnonzero(near & window))
        rest &= ~near
        if rest.any():
            window &= rest | ((far >= far[rest].min() - reach) & (far <= far[rest].max() + reach))
    if (region.parent == region.parent[0]).all():
        return region.links
    # Sets of different components that no pivot tells apart.
    known = np.array(rows)
    for i in range(n - 1):
        left = (region.parent != region.parent[i]) & (out | out[i])
        left[: i + 1] = False
        at = np.flatnonzero(left)
        for k in range(0, len(known), 16):
            if not len(at):
                break
            at = at[~(np.abs(known[k : k + 16, at] - known[k : k + 16, i : i + 1]) > reach).any(axis=0)]
        if len(at):
            near, _ = region.distances(i)
            region.add(i, at[near[at]])
    return region.links


def _nodes(df: DataFrame) -> DataFrame:
    """(doc_id, n_shingles, node, digest) per row, and per task the counts of its shingles.

    ``node`` is half of the digest and only narrows searches; ``digest`` decides equality.
    """
    schema = pa.schema(
        [
            ("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("node", pa.int64()), ("digest", pa.binary()),
            ("part", pa.int32()), ("counts", pa.list_(pa.int32())),
        ]
    )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(COUNT_SLOTS, np.int64)
        for batch in batches:
            for piece in slices(batch, "text"):
                sets = shingle_sets(piece.column(1))
                flat = np.concatenate(sets)
                counts += np.bincount((flat & np.uint64(COUNT_SLOTS - 1)).astype(np.int64), minlength=COUNT_SLOTS)
                digests = [xxhash.xxh3_128_digest(s.tobytes()) for s in sets]
                n = len(sets)
                yield pa.RecordBatch.from_arrays(
                    [
                        piece.column(0).cast(pa.int64()),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array(np.frombuffer(b"".join(d[:8] for d in digests), np.int64)),
                        pa.array(digests, pa.binary()),
                        pa.nulls(n, pa.int32()),
                        pa.nulls(n, pa.list_(pa.int32())),
                    ],
                    schema=schema,
                )
        rows = counts.astype(np.int32).reshape(64, -1)
        yield pa.RecordBatch.from_pylist([{"part": k, "counts": row} for k, row in enumerate(rows)], schema)

    return df.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        work, "doc_id long, n_shingles long, node long, digest binary, part int, counts array<int>"
    )


def _order(nodes: DataFrame) -> np.ndarray:
    """A class by frequency, 0 to 255, for each slot of the count table."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for part, counts in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                values = counts.values.to_numpy().astype(np.int64)
                sums[part] = sums[part] + values if part in sums else values
        rows = [{"part": p, "counts": c} for p, c in sums.items()]
        yield pa.RecordBatch.from_pylist(rows, pa.schema([("part", pa.int32()), ("counts", pa.list_(pa.int64()))]))

    tables = nodes.where(F.col("part").isNotNull()).select("part", "counts").repartition("part")
    total = np.zeros((64, COUNT_SLOTS // 64), np.int64)
    for row in tables.mapInArrow(add, "part int, counts array<long>").collect():
        total[row["part"]] += np.array(row["counts"], np.int64)
    return np.minimum(255, 8 * np.log2(np.maximum(1, total.ravel()))).astype(np.uint64)


def _first_shingles(df: DataFrame, order: np.ndarray, percent: int) -> DataFrame:
    """(key, node): each set's first shingles; frequency leads the key."""
    ranks = df.sparkSession.sparkContext.broadcast(order)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        classes = ranks.value << np.uint64(56)
        for batch in batches:
            for piece in slices(batch, "text"):
                keys, nodes, counts = [], [], []
                for s in shingle_sets(piece.column(0)):
                    if not len(s):
                        continue
                    key = classes[(s & np.uint64(COUNT_SLOTS - 1)).astype(np.int64)] | (s >> np.uint64(8))
                    k = min(len(s), prefix_size(len(s), percent))
                    keys.append(np.partition(key, k - 1)[:k])
                    nodes.append(np.frombuffer(xxhash.xxh3_128_digest(s.tobytes())[:8], np.int64))
                    counts.append(k)
                if keys:
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(np.concatenate(keys).view(np.int64)),
                            pa.array(np.repeat(np.concatenate(nodes), counts)),
                        ],
                        names=["key", "node"],
                    )

    return df.select("text").mapInArrow(work, "key long, node long")


def _distances(pairs: DataFrame, percent: int) -> DataFrame:
    """(a, b, near, far) of pairs with both texts."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in slices(batch, "text_b"):
                found = [
                    linked(a, b, percent)
                    for a, b in zip(shingle_sets(piece.column(2)), shingle_sets(piece.column(3)), strict=True)
                ]
                yield pa.RecordBatch.from_arrays(
                    [
                        piece.column(0), piece.column(1),
                        pa.array([n for n, _ in found], pa.bool_()), pa.array([f for _, f in found], pa.float64()),
                    ],
                    names=["a", "b", "near", "far"],
                )

    return pairs.select("a", "b", "text_a", "text_b").mapInArrow(work, "a long, b long, near boolean, far double")


def _join_regions(rows: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) within each ``region`` of (region, doc_id, outside, text)."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, ids, sets, outside = None, [], [], []
        out: list[tuple[int, int]] = []

        def close() -> None:
            order = np.argsort(ids, kind="stable")
            found = join_region([sets[i] for i in order], [outside[i] for i in order], percent)
            out.extend((ids[order[i]], ids[order[j]]) for i, j in found)

        for batch in batches:
            for piece in slices(batch, "text"):
                columns = [c.to_pylist() for c in piece.columns[:3]]
                for region, doc, out_of, s in zip(*columns, shingle_sets(piece.column(3)), strict=True):
                    if region != now:
                        if now is not None:
                            close()
                        now, ids, sets, outside = region, [], [], []
                    ids.append(doc)
                    sets.append(s)
                    outside.append(out_of)
            yield pa.RecordBatch.from_pylist([{"a": a, "b": b} for a, b in out], _LINKS)
            out.clear()
        if now is not None:
            close()
        yield pa.RecordBatch.from_pylist([{"a": a, "b": b} for a, b in out], _LINKS)

    dealt = rows.select("region", "doc_id", "outside", "text").repartition("region")
    return dealt.sortWithinPartitions("region").mapInArrow(work, "a long, b long")


_LINKS = pa.schema([("a", pa.int64()), ("b", pa.int64())])


def jaccard_links(df: DataFrame, nodes: DataFrame, heads: DataFrame, percent: int, region_sets: int) -> DataFrame:
    """Links (a, b) between the ids of ``heads``: a forest with the components of all links."""
    keys, _ = scratch(_first_shingles(df, _order(nodes), percent), "first-shingles")
    pivots = (
        keys.groupBy("key")
        .agg(F.min("node").alias("pivot"), F.max("node").alias("last"))
        .where(F.col("pivot") != F.col("last"))
    )
    # Written before they are joined back, so that only one of both shuffles takes room at a time.
    pivots, _ = scratch(pivots.select("key", "pivot"), "pivots")
    found = keys.join(pivots, "key").groupBy("pivot", "node").agg(F.count(F.lit(1)).alias("keys"))
    met, _ = scratch(found, "regions")
    # Two linked sets share so many first shingles, at least, that one of their common
    # regions holds the mean number of them for each: a set leaves the regions below that.
    named = heads.select("node", "head", "n_shingles")
    own = met.groupBy("node").agg(F.sum("keys").alias("all_keys"), F.count(F.lit(1)).alias("regions"))
    least = F.expr(f"1 + ((n_shingles * {percent} + 99) div 100) div 10")
    able = own.join(named, "node").withColumn("least", least).where(F.col("all_keys") >= F.col("least"))
    members = (
        met.join(able, "node")
        .where(F.col("keys") * F.col("regions") >= F.col("least"))
        .select(F.col("pivot").alias("region"), F.col("head").alias("doc_id"))
        .distinct()
    )
    sizes = members.groupBy("region").agg(F.count(F.lit(1)).alias("size"))
    alone = F.col("size") > 1
    members, _ = scratch(members.join(sizes.where(alone), "region"), "members")
    wanted = members.select("doc_id").distinct()
    texts, _ = scratch(df.join(wanted.hint("merge"), "doc_id", "left_semi").dropDuplicates(["doc_id"]), "texts")

    small = members.where(F.col("size") <= region_sets)
    links = _join_regions(
        small.join(texts, "doc_id").select("region", "doc_id", F.lit(True).alias("outside"), "text"), percent
    )
    hot = members.where(F.col("size") > region_sets)
    # The pivot itself may have left: any member serves as one.
    centres = hot.groupBy("region").agg(F.min("doc_id").alias("a"))
    pairs = hot.join(centres, "region").select("a", F.col("doc_id").alias("b")).where("a != b").distinct()
    for side in "ab":
        pairs = pairs.join(texts.withColumnsRenamed({"doc_id": side, "text": f"text_{side}"}), side)
    spread, _ = scratch(_distances(pairs, percent), "distances")
    links = links.union(spread.where("near").select("a", "b"))

    # What is outside the inner ball, in blocks against the blocks of its window.
    radius, slack = 1 - percent / 100, 1e-9
    outer = spread.where("not near").groupBy("a").agg(
        F.min("far").alias("least"), F.max("far").alias("most"), F.count(F.lit(1)).alias("outer")
    )
    window = spread.join(outer, "a").where(
        ~F.col("near") | F.col("far").between(F.col("least") - radius - slack, F.col("most") + radius + slack)
    )
    width = window.groupBy("a").agg(F.count(F.lit(1)).alias("all"))
    window = window.join(width, "a")
    blocks = lambda c: F.ceil(F.col(c) / (region_sets // 2)).cast("int")
    place = F.pmod(F.xxhash64("b"), F.lit(1 << 30)).cast("int")
    upto = lambda c: F.sequence(F.lit(0), blocks(c) - 1)
    left = window.where("not near").select("a", "b", (place % blocks("outer")).alias("i"), F.explode(upto("all")).alias("j"))
    right = window.select("a", "b", F.explode(upto("outer")).alias("i"), (place % blocks("all")).alias("j"))
    dealt = (
        left.withColumn("outside", F.lit(True))
        .unionByName(right.withColumn("outside", F.lit(False)))
        .groupBy("a", "i", "j", "b")
        .agg(F.max("outside").alias("outside"))
        .select(F.xxhash64("a", "i", "j").alias("region"), F.col("b").alias("doc_id"), "outside")
    )
    return links.union(_join_regions(dealt.join(texts, "doc_id"), percent))


def jaccard_classes(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    percent: int = PERCENT,
    region_sets: int = REGION_SETS,
) -> DataFrame:
    """One row per row of ``df``: its id, ``n_shingles``, ``component_id``."""
    docs = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    nodes, _ = scratch(_nodes(docs), "nodes")
    rows = nodes.where(F.col("part").isNull()).select("doc_id", "n_shingles", "node", "digest")
    real = rows.where((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull())
    heads, _ = scratch(real.groupBy("digest", "node").agg(F.min("doc_id").alias("head"), F.first("n_shingles").alias("n_shingles")), "heads")
    known = docs.where(F.col("doc_id").isNotNull())
    links, _ = scratch(jaccard_links(known, nodes, heads, percent, region_sets), "jaccard-links")
    classes = connected_components(links)
    by_set = heads.join(classes.withColumnRenamed("node", "head"), "head", "left").select(
        "digest", F.coalesce("component", "head").alias("component")
    )
    return rows.join(by_set, "digest", "left").select(
        "doc_id",
        "n_shingles",
        # A NULL id links with nothing, though an equal text may have a class.
        F.when((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull(), F.col("component"))
        .otherwise(F.col("doc_id"))
        .alias("component_id"),
    )
