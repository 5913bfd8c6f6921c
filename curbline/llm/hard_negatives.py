"""Hard negatives from an R-tree that is packed by sort-tile-recursive and spread over tasks.

The upper levels of the tree are its regions. A sample of vectors is cut into tiles, slab by slab
along the widest coordinate; all vectors are then ordered by tile, by a coordinate within it and by
id, and packed into regions of about ``REGION_ROWS`` rows, so that equal vectors, however many,
fill regions of their own. A task that works on a region packs its rows into a tree of boxes (see
``str_tree``) and answers queries by a best-first queue.

A search takes two passes. In the first, every query visits the region that holds it, which gives
a floor: the k-th best score there. In the second it visits the regions whose boxes can still hold
a score in its windows that is not strictly below that floor. What tasks know of other
regions are the boxes of at most ``SHELVES`` shelves of neighbouring regions, whatever the table's
size. Queries travel to regions in blocks; of a region many queries visit, there are as many
copies as there are blocks of ``QUERY_ROWS`` queries. Nothing is cut off: results are exact.

Defined results: rows with a NULL label, a NULL or empty vector, or a NULL or non-finite component
take no part; vectors of different lengths, or too large for exact arithmetic, raise ValueError.
Of equal scores the smaller id comes first, a NULL id last (the largest 64-bit number stands for
it and must not be an id); a NULL id is never an anchor. A row with the anchor's own id is not
another row. Repeated rows count each, as anchors and as candidates. An empty table, or one without anchors,
gives an empty table. Further columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from curbline.llm import str_tree
from curbline.llm.common import scratch
from curbline.llm.vectors import as_lists, as_matrix, on_grid
from curbline.session import remove_path

POSITIVES, NEGATIVES = 5, 3
#: A negative's score lies between these percentages of the positive's.
LOW, HIGH = 50, 95
SCALE = 256.0
REGION_ROWS = 4096
#: Rows whose places choose the tiles; every row is indexed.
SAMPLE_ROWS = 8192
SHELVES = 1024
#: Queries that share one copy of a region.
QUERY_ROWS = 1 << 16

_FAR = 1 << 62
_NO_FLOOR = -_FAR
_RESULT = "ids array<long>, scores array<long>"


def _index(df: DataFrame, anchors: Column, id_col: str, vector_col: str, label_col: str, scale: float):
    """The rows that take part, on the grid, with region and uid; also their number of regions."""
    spark = df.sparkSession
    source = df.where(F.col(label_col).isNotNull()).select(
        F.coalesce(F.col(id_col).cast("long"), F.lit(str_tree.NO_ID)).alias("id"),
        F.col(label_col).cast("long").alias("label"),
        F.coalesce(anchors & F.col(id_col).isNotNull(), F.lit(False)).alias("anchor"),
        F.col(vector_col).alias("v"),
    )
    names = ["id", "label", "anchor", "x"]

    def to_grid(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            whole, grid = on_grid(batch.column(3), scale)
            kept = batch.filter(pa.array(whole))
            yield pa.RecordBatch.from_arrays([*kept.columns[:3], as_lists(grid)], names=names)

    grid, grid_path = scratch(source.mapInArrow(to_grid, "id long, label long, anchor boolean, x array<int>"), "grid")
    grid = grid.withColumn("uid", F.monotonically_increasing_id())
    rows, narrow, wide = grid.agg(F.count(F.lit(1)), F.min(F.size("x")), F.max(F.size("x"))).first()
    if narrow != wide:
        raise ValueError(f"vectors of one length are needed, not of {narrow} to {wide}")
    regions = max(1, -(-rows // REGION_ROWS))
    chosen = F.pmod(F.xxhash64("uid"), F.lit(max(rows, 1))) < SAMPLE_ROWS
    sample = as_matrix(grid.where(chosen).select("x").limit(2 * SAMPLE_ROWS).toArrow().column(0).combine_chunks())
    tiles = str_tree.tiles_of(sample, min(regions, SHELVES))

    def tile(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = as_matrix(batch.column(3))
            number = str_tree.tile_numbers(x, tiles)
            along = x[np.arange(len(x)), number % max(1, x.shape[1])]
            columns = [*batch.columns, pa.array(number), pa.array(along)]
            yield pa.RecordBatch.from_arrays(columns, names=[*names, "uid", "tile", "along"])

    kinds = "id long, label long, anchor boolean, x array<int>, uid long, tile long, along long"
    dealt = grid.mapInArrow(tile, kinds).repartitionByRange(regions, "tile", "along", "id", "uid")
    packed = dealt.select("uid", "id", "label", "anchor", "x", F.spark_partition_id().alias("region"))
    index, path = scratch(packed, "rtree")
    remove_path(spark, grid_path)
    number = (index.agg(F.max("region")).first()[0] or 0) + 1
    return index, path, number


def _shelves(index: DataFrame, regions: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Boxes of the shelves that hold rows, and the number of each."""
    count = min(regions, SHELVES)

    def boxes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, shelf = as_matrix(batch.column(1)), np.asarray(batch.column(0)).astype(np.int64) * count // regions
            for own in np.unique(shelf):
                part = x[shelf == own]
                columns = [np.full(x.shape[1], own), np.arange(x.shape[1]), part.min(0), part.max(0)]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names=["shelf", "place", "lo", "hi"])

    parts = index.select("region", "x").mapInArrow(boxes, "shelf long, place long, lo long, hi long")
    found = parts.groupBy("shelf", "place").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi")).toArrow()
    shelf, place, lo, hi = (found.column(c).to_numpy() for c in ("shelf", "place", "lo", "hi"))
    order = np.lexsort((place, shelf))
    numbers, width = np.unique(shelf), int(place.max(initial=-1)) + 1
    box = lambda values: values[order].reshape(len(numbers), width).astype(np.float64)
    return numbers, box(lo), box(hi)


def _padded(column: pa.Array, missing: int) -> np.ndarray:
    """Lists of different lengths as a matrix."""
    lengths = column.value_lengths().to_numpy()
    out = np.full((len(column), max(1, int(lengths.max(initial=1)))), missing, np.int64)
    out[np.arange(out.shape[1]) < lengths[:, None]] = column.flatten().to_numpy()
    return out


_QUERY = ["uid", "id", "label", "x", "low", "high", "floor"]


def _queries(batch: pa.RecordBatch) -> str_tree.Queries:
    column = dict(zip(batch.schema.names, batch.columns, strict=True))
    low, high = _padded(column["low"], _FAR).astype(np.float64), _padded(column["high"], -_FAR).astype(np.float64)
    # A window that holds no score asks for nothing.
    floor = np.where(low > high, np.inf, _padded(column["floor"], _NO_FLOOR)[:, : low.shape[1]])
    x = as_matrix(column["x"]).astype(np.float64)
    return str_tree.Queries(x, np.asarray(column["id"]), np.asarray(column["label"]), low, high, floor)


def _visited(index: DataFrame, visits: DataFrame, blocks: int, k: int, same: bool) -> DataFrame:
    """What every query finds in every region it visits: ``uid``, ``ids``, ``scores``, window by window."""
    none = F.lit(None).cast("array<long>")
    block = F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))) if blocks > 1 else F.lit(0)
    rows = index.select("region", block.alias("block"), F.lit(0).alias("kind"), "uid", "id", "label", "x", *[none.alias(c) for c in ("low", "high", "floor")])
    asked = visits.select("region", F.pmod(F.xxhash64("uid"), F.lit(blocks)).cast("int").alias("block"), F.lit(1).alias("kind"), *_QUERY)
    key = ["region", "block", "kind"]
    together = rows.unionByName(asked).repartition("region", "block").sortWithinPartitions(*key)

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        place, held, tree = None, [], None
        for batch in batches:
            region, blocked, kind = (np.asarray(batch.column(i)).astype(np.int64) for i in range(3))
            turns = np.flatnonzero((np.diff(region) != 0) | (np.diff(blocked) != 0) | (np.diff(kind) != 0)) + 1
            edges = [0, *turns.tolist(), batch.num_rows]
            for start, stop in zip(edges[:-1], edges[1:], strict=True):
                if start == stop:
                    continue
                part, here = batch.slice(start, stop - start), (region[start], blocked[start])
                if here != place:
                    place, held, tree = here, [], None
                if kind[start] == 0:
                    held.append(part)
                    continue
                if tree is None and held:
                    tree, held = _tree(held), []
                for at in range(0, part.num_rows if tree else 0, str_tree.TOGETHER):
                    asking = part.slice(at, str_tree.TOGETHER)
                    scores, ids = str_tree.search(tree, _queries(asking), k, same)
                    hit = np.flatnonzero((scores > -np.inf).any((1, 2)))
                    if len(hit):
                        yield _answers(asking.column(3).take(pa.array(hit)), scores[hit], ids[hit])

    return together.mapInArrow(answer, f"uid long, {_RESULT}")


def _tree(parts: list[pa.RecordBatch]) -> str_tree.Tree:
    ids, labels, x = (pa.concat_arrays([p.column(i) for p in parts]) for i in (4, 5, 6))
    return str_tree.build(as_matrix(x), np.asarray(ids), np.asarray(labels))


def _answers(uids: pa.Array, scores: np.ndarray, ids: np.ndarray) -> pa.RecordBatch:
    """Windows behind one another; a missing candidate is NULL."""
    n = len(uids)
    missing = scores.reshape(n, -1) == -np.inf
    edges = pa.array(np.arange(n + 1, dtype=np.int32) * missing.shape[1], pa.int32())
    lists = [
        pa.ListArray.from_arrays(edges, pa.array(values.reshape(-1), pa.int64(), mask=missing.reshape(-1)))
        for values in (ids, np.where(scores == -np.inf, 0, scores).astype(np.int64))
    ]
    return pa.RecordBatch.from_arrays([uids, *lists], names=["uid", "ids", "scores"])


def _best(found: DataFrame, k: int) -> DataFrame:
    """(uid, window, rank, id, score) of the best ``k`` of each query and window over all regions."""
    each = found.select("uid", F.posexplode(F.arrays_zip("ids", "scores")).alias("at", "one")).where("one.ids IS NOT NULL")
    flat = each.select("uid", F.floor(F.col("at") / k).cast("int").alias("window"), F.col("one.ids").alias("id"), F.col("one.scores").alias("score"))
    by = W.partitionBy("uid", "window").orderBy(F.desc("score"), "id")
    return flat.withColumn("rank", F.row_number().over(by)).where(F.col("rank") <= k)


def _search(index: DataFrame, queries: DataFrame, regions: int, shelves, k: int, same: bool, windows: int) -> tuple[DataFrame, list[str]]:
    """The best ``k`` candidates of every query and window, from two passes over the regions."""
    blocks = max(1, -(-queries.count() // QUERY_ROWS))
    open_floor = F.transform("low", lambda _: F.lit(_NO_FLOOR).cast("long"))
    # In the first pass a query visits its own region only.
    near, near_path = scratch(_visited(index, queries.withColumn("floor", open_floor), blocks, k, same), "near")
    # The k-th score of a window is there only if the window is full.
    kth = F.transform(
        F.sequence(F.lit(0), F.lit(windows - 1)),
        lambda w: F.coalesce(F.get("scores", w * k + (k - 1)), F.lit(_NO_FLOOR).cast("long")),
    )
    floors = near.select("uid", kth.alias("floor"))
    asking = queries.join(floors, "uid", "left").withColumn("floor", F.coalesce("floor", open_floor))
    numbers, lo, hi = shelves
    count = min(regions, SHELVES)
    first, last = -(-numbers * regions // count), -(-(numbers + 1) * regions // count)

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, str_tree.TOGETHER):
                part = batch.slice(at, str_tree.TOGETHER)
                q = _queries(part)
                least, most = str_tree.intervals(q.x, lo, hi)
                open_ = np.zeros(least.shape, bool)
                for w in range(q.low.shape[1]):
                    open_ |= str_tree.useful(q.low[:, w, None], q.high[:, w, None], q.floor[:, w, None], least, most) > -np.inf
                lists = [np.concatenate([np.arange(a, b) for a, b in zip(first[row], last[row], strict=True)]) if row.any() else [] for row in open_]
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(lists, pa.list_(pa.int32()))], names=[*part.schema.names, "regions"])

    carried = asking.select(*_QUERY, F.col("region").alias("home"))
    kinds = ", ".join(f"{c} {t}" for c, t in carried.dtypes)
    routed = carried.mapInArrow(route, f"{kinds}, regions array<int>")
    visits = routed.withColumn("region", F.explode("regions")).where("region <> home")
    far = _visited(index, visits, blocks, k, same)
    return _best(near.unionByName(far), k), [near_path]


def mine(
    df: DataFrame,
    anchors: Column,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    low: int = LOW,
    high: int = HIGH,
    scale: float = SCALE,
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    Scores are inner products on the grid of ``floor(scale * x)``. An anchor is a row for which
    ``anchors`` holds; its positives are its best-scored rows of the same label. Of the rows of
    other labels whose score lies from ``low`` to ``high`` percent of a positive's, the best come back.
    """
    spark = df.sparkSession
    index, index_path, regions = _index(df, anchors, id_col, vector_col, label_col, scale)
    shelves = _shelves(index, regions)
    one = lambda value: F.array(F.lit(value).cast("long"))
    asked = index.where("anchor").select("uid", "id", "label", "x", "region", one(-_FAR).alias("low"), one(_FAR).alias("high"))
    found, paths = _search(index, asked, regions, shelves, positives, True, 1)

    chosen = found.groupBy("uid").agg(F.sort_array(F.collect_list(F.struct("rank", "id", "score"))).alias("positives"))
    # In whole numbers: the remainder goes first, so that nothing is rounded.
    hundred, div = F.lit(100), lambda a: F.call_function("div", a, F.lit(100))
    down = lambda p: div(p["score"] * high - F.pmod(p["score"] * high, hundred))
    up = lambda p: div(p["score"] * low + F.pmod(-p["score"] * low, hundred))
    second = asked.drop("low", "high").join(chosen, "uid").withColumns(
        {"low": F.transform("positives", up), "high": F.transform("positives", down)}
    )
    stored, stored_path = scratch(second, "anchors")
    for path in paths:
        remove_path(spark, path)
    found, _ = _search(index, stored, regions, shelves, negatives, False, positives)
    pairs = stored.select("uid", F.col("id").alias("anchor_id"), F.posexplode("positives").alias("window", "positive"))
    known = lambda c: F.nullif(c, F.lit(str_tree.NO_ID))
    return pairs.join(found, ["uid", "window"]).select(
        "anchor_id",
        known(F.col("positive.id")).alias("positive_id"),
        F.col("rank").cast("int").alias("rank"),
        known(F.col("id")).alias("negative_id"),
        F.col("positive.score").alias("positive_score"),
        F.col("score").alias("negative_score"),
    )
