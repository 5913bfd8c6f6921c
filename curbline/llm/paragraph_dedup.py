"""Repeated passages, also with small edits, by MinHash banding of paragraphs.

1. *Paragraphs.* A line is a paragraph, whatever its length. One of more than ``LINE_WORDS`` words is also cut
   into pieces, each a paragraph, where the hash of two neighbouring words is the least within ``REACH`` words on both
   sides. Cuts depend on the words around them alone, so a passage is cut alike wherever it stands.
2. *Bands.* Paragraphs with equal words are one node. The MinHash signature of a node's word shingles is cut into
   ``BANDS`` bands of ``ROWS`` values: two nodes of similarity s collide in one with probability
   1 - (1 - s^ROWS)^BANDS, 0.96 at 0.75 and 0.99 at 0.85.
3. *Verification.* Colliding nodes are joined to their band's least node, and the exact Jaccard
   similarity of their shingle sets decides. A band whose other nodes these links leave in more than one component is then
   compared within itself, in salted blocks of about ``BLOCK_NODES``: pairs of different components that share one of
   the shingles of which similar sets must share one are verified too. So every colliding pair is verified or connected.
4. *Clusters* are the components of the verified links. The earliest paragraph of a cluster (smallest id, then first
   word, then fewest words) stays, and so does what overlaps it; later ones repeat. Neighbouring or overlapping repeats
   that cover ``RUN_WORDS`` words or more in all are removed.

A band that very many nodes share is an aggregate with map-side combining, joined back by key, so it is never
gathered; neither are the places of a paragraph that very many documents hold.

Defined results: NULL, empty and blank texts have no paragraphs, and paragraphs of fewer than ``LEAST_WORDS`` words
are never repeats. A NULL id comes before all ids. Ids name documents: rows repeated with one id and one text count as
one document. An empty table gives an empty table; further columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curbline.llm.common import scratch, slices, text_bytes
from curbline.llm.components import connected_components
from curbline.llm.words import common, mix, shingle_hashes, word_hashes
from curbline.session import remove_path

LINE_WORDS = 24
REACH = 5
LEAST_WORDS = 6
BANDS, ROWS = 4, 2
PERCENT = 75
RUN_WORDS = 20
#: Nodes of one band that are compared with each other in one task.
BLOCK_NODES = 256
#: Words whose shingles are sorted at once.
SET_WORDS = 1 << 16
_NO_ID = -(1 << 63)
_SEEDS = mix(np.arange(1, BANDS * ROWS + 1, dtype=np.uint64)) | np.uint64(1)


def _least_near(values: np.ndarray, reach: int) -> np.ndarray:
    """Whether a value is the least within ``reach`` places on both sides."""
    padded = np.concatenate([np.full(reach, ~np.uint64(0)), values, np.full(reach, ~np.uint64(0))])
    least = padded[: len(values)]
    for k in range(1, 2 * reach + 1):
        least = np.minimum(least, padded[k : k + len(values)])
    return values == least


def paragraphs(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Word hashes of all texts, the marks of the texts in words, and those of their lines and of their pieces."""
    words, marks = word_hashes(texts)
    if not len(words):
        return words, marks, np.zeros(1, np.int64), np.zeros(1, np.int64)
    raw, ends = text_bytes(texts)
    blank = np.isin(raw, np.frombuffer(b" \t\n\v\f\r", np.uint8))
    first = ~blank
    first[1:] &= blank[:-1]
    inner = ends[:-1][ends[:-1] < len(raw)]
    first[inner] = ~blank[inner]
    before = np.concatenate([[0], np.cumsum(first)])
    lines = np.unique(np.concatenate([before[np.flatnonzero(raw == 10)], marks]))
    pairs = mix(words + np.roll(words, 1) * np.uint64(3))
    cuts = np.flatnonzero(_least_near(pairs, REACH))
    line = np.searchsorted(lines, cuts, side="right") - 1
    line = np.minimum(line, len(lines) - 2)
    cuts = cuts[lines[line + 1] - lines[line] > LINE_WORDS]
    return words, marks, lines, np.unique(np.concatenate([lines, cuts]))


def _places(docs: DataFrame) -> DataFrame:
    """(doc, first, words, node, keys) of every paragraph that is long enough."""
    schema = pa.schema(
        [("doc", pa.int64()), ("first", pa.int32()), ("words", pa.int32()), ("node", pa.int64()), ("keys", pa.list_(pa.int64(), BANDS))]
    )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                words, marks, lines, pieces = paragraphs(part.column(1))
                # Lines that aren't cut are among the pieces.
                for edges, least in ((pieces, LEAST_WORDS), (lines, LINE_WORDS + 1)):
                    long = np.diff(edges) >= least
                    if long.any():
                        yield placed(part.column(0), words, marks, edges, long)

    def placed(docs: pa.Array, words: np.ndarray, marks: np.ndarray, edges: np.ndarray, long: np.ndarray) -> pa.RecordBatch:
        hashes, bounds = shingle_hashes(words, edges)
        node = _paragraph_hashes(words, edges)
        keys = []
        for band in range(BANDS):
            key = np.full(len(node), band + 1, np.uint64)
            for seed in _SEEDS[band * ROWS : (band + 1) * ROWS]:
                key = mix(key + np.minimum.reduceat(hashes * seed, bounds[:-1]))
            keys.append(key)
        at = edges[:-1][long]
        doc = np.searchsorted(marks, at, side="right") - 1
        flat = np.stack(keys, axis=1)[long].ravel().view(np.int64)
        return pa.RecordBatch.from_arrays(
            [
                docs.take(pa.array(doc)),
                pa.array((at - marks[doc]).astype(np.int32)),
                pa.array(np.diff(edges)[long].astype(np.int32)),
                pa.array(node[long].view(np.int64)),
                pa.FixedSizeListArray.from_arrays(pa.array(flat), BANDS).cast(pa.list_(pa.int64())),
            ],
            names=schema.names,
        )

    return docs.mapInArrow(work, "doc long, first int, words int, node long, keys array<long>")


def _paragraph_hashes(words: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """A hash of each paragraph's words in their order."""
    sizes = np.diff(edges)
    place = np.arange(len(words)) - np.repeat(edges[:-1], sizes)
    odd = mix(place.astype(np.uint64) + np.uint64(1)) | np.uint64(1)
    return mix(np.add.reduceat(words * odd, edges[:-1]) + sizes.astype(np.uint64))


def _distinct_shingles(words: np.ndarray, start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The shingles of each range of words, every one once and in the order of signed numbers, in which all later
    steps read them; and the marks of the ranges.
    """
    marks = np.concatenate([[0], np.cumsum(size)])
    at = np.arange(marks[-1]) + np.repeat(start - marks[:-1], size)
    hashes, edges = shingle_hashes(words[at], marks)
    # Small numbers are sorted in linear time.
    numbers = np.arange(len(size), dtype=np.uint16 if len(size) < 1 << 16 else np.int64)
    hashes, row = hashes.view(np.int64), np.repeat(numbers, np.diff(edges))
    order = np.argsort(hashes)
    order = order[np.argsort(row[order], kind="stable")]
    hashes, row = hashes[order], row[order]
    new = np.ones(len(row), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (row[1:] != row[:-1])
    return hashes[new], np.concatenate([[0], np.cumsum(np.bincount(row[new], minlength=len(size)))])


def _shingles(met: DataFrame) -> DataFrame:
    """(node, shingles) of the paragraphs listed with each text."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                words, marks = word_hashes(part.column(0))
                listed = part.column(1)
                first, size, node = (listed.flatten().field(k).to_numpy().astype(np.int64) for k in range(3))
                # An id with two texts has places that only one of them holds.
                start = np.minimum(first + np.repeat(marks[:-1], listed.value_lengths().to_numpy()), len(words))
                size = np.minimum(start + size, len(words)) - start
                # As many paragraphs at once as hold about this many words.
                block = (np.cumsum(size) - size) // SET_WORDS
                edges = np.append(np.flatnonzero(np.diff(block, prepend=-1)), len(size)).tolist()
                for a, b in zip(edges[:-1], edges[1:], strict=True):
                    flat, ends = _distinct_shingles(words, start[a:b], size[a:b])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(node[a:b]), pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), pa.array(flat))],
                        names=["node", "shingles"],
                    )

    return met.select("text", "listed").mapInArrow(work, "node long, shingles array<long>")


def _sets(column: pa.Array) -> list[np.ndarray]:
    """The sorted shingles of every row."""
    edges = np.concatenate([[0], np.cumsum(column.value_lengths().to_numpy())]).tolist()
    flat = column.flatten().to_numpy()
    return [flat[a:b] for a, b in zip(edges[:-1], edges[1:], strict=True)]


def _verified(pairs: DataFrame, percent: int) -> DataFrame:
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            near = []
            for a, b in zip(_sets(batch.column(2)), _sets(batch.column(3)), strict=True):
                # Sets whose sizes are too far apart can't be similar.
                both = common(a, b) if 100 * min(len(a), len(b)) >= percent * max(len(a), len(b)) else 0
                near.append(100 * both >= percent * (len(a) + len(b) - both))
            yield batch.select(["a", "b"]).filter(pa.array(near, pa.bool_()))

    return pairs.select("a", "b", "set_a", "set_b").mapInArrow(work, "a long, b long")


def _open_members(collisions: DataFrame, links: DataFrame) -> DataFrame:
    """(key, lo, hi, own, head, node): the nodes of bands that hold several components, dealt to pairs of blocks.

    The nodes connected to the band's least one, which may be very many, need no comparison with each other: their
    blocks meet only those of the others. ``own`` is the node's block, ``head`` its component.
    """
    heads = connected_components(links)
    known = collisions
    for side in ("node", "pivot"):
        named = heads.withColumnsRenamed({"node": side, "component": f"{side}_head"})
        known = known.join(named, side, "left").withColumn(f"{side}_head", F.coalesce(f"{side}_head", side))
    known = known.select("key", "node", F.col("node_head").alias("head"), (F.col("node_head") != F.col("pivot_head")).alias("minor"))
    known, _ = scratch(known, "band-nodes")
    blocks = lambda n: F.ceil(n / BLOCK_NODES).cast("int")
    sizes = (
        known.groupBy("key")
        .agg(F.min("head").alias("low"), F.max("head").alias("high"), F.count_if("minor").alias("minors"), F.count("*").alias("n"))
        .where("low != high")
        .select("key", blocks(F.col("minors")).alias("inner"), blocks(F.col("n") - F.col("minors")).alias("outer"))
    )
    spread = F.xxhash64("node")
    own = F.when(F.col("minor"), F.pmod(spread, "inner")).otherwise(F.col("inner") + F.pmod(spread, "outer")).cast("int")
    met = F.when(F.col("minor"), F.col("inner") + F.col("outer")).otherwise(F.col("inner"))
    dealt = known.join(sizes, "key").withColumn("own", own).withColumn("other", F.explode(F.sequence(F.lit(0), met - 1)))
    return dealt.select("key", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"), "own", "head", "node")


def _near_in_groups(group: np.ndarray, own: np.ndarray, head: np.ndarray, sets: list[np.ndarray], one_block: np.ndarray, percent: int) -> list[tuple[int, int]]:
    """Similar rows of one group but of different heads; of different blocks unless ``one_block``.

    Heads that rows found before have connected need no other link: there are fewer links than rows.
    """
    # The least shingles of two sets as similar as this share one, if as many are left out as must be common, less one.
    sizes = np.array([len(s) for s in sets])
    firsts = sizes - -(-percent * sizes // 100) + 1
    row = np.repeat(np.arange(len(sets)), firsts)
    shingle = np.concatenate([s[:n] for s, n in zip(sets, firsts.tolist(), strict=True)])
    order = np.lexsort((shingle, group[row]))
    row, shingle = row[order], shingle[order]
    new = np.ones(len(row), bool)
    new[1:] = (shingle[1:] != shingle[:-1]) | (group[row[1:]] != group[row[:-1]])
    edges = np.append(np.flatnonzero(new), len(row))
    tried: set[tuple[int, int]] = set()
    out = []
    names, place = np.unique(head, return_inverse=True)
    parent = list(range(len(names)))
    place = place.tolist()

    def root(row: int) -> int:
        k = place[row]
        while parent[k] != k:
            parent[k] = parent[parent[k]]
            k = parent[k]
        return k

    for k in np.flatnonzero(np.diff(edges) > 1):
        rows = np.sort(row[edges[k] : edges[k + 1]])
        if len({root(r) for r in rows.tolist()}) == 1:
            continue
        a, b = (rows[x] for x in np.triu_indices(len(rows), 1))
        apart = (head[a] != head[b]) & (one_block[a] | (own[a] != own[b]))
        apart &= 100 * np.minimum(sizes[a], sizes[b]) >= percent * np.maximum(sizes[a], sizes[b])
        for i, j in zip(a[apart].tolist(), b[apart].tolist(), strict=True):
            one, other = root(i), root(j)
            if one == other or (i, j) in tried:
                continue
            tried.add((i, j))
            both = common(sets[i], sets[j])
            if 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                out.append((i, j))
                parent[other] = one
    return out


def _verified_in_blocks(members: DataFrame, percent: int) -> DataFrame:
    """(a, b) of similar nodes of different components in one pair of blocks, of members with ``shingles``."""
    names = ["key", "lo", "hi"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def links(part: pa.Table) -> pa.RecordBatch:
            key, lo, hi, own, head, node = (part.column(k).to_numpy() for k in range(6))
            sets = _sets(part.column(6).combine_chunks())
            group = np.cumsum(np.concatenate([[0], (key[1:] != key[:-1]) | (lo[1:] != lo[:-1]) | (hi[1:] != hi[:-1])]))
            near = np.array(_near_in_groups(group, own, head, sets, lo == hi, percent), np.int64).reshape(-1, 2)
            return pa.RecordBatch.from_arrays([pa.array(node[near[:, 0]]), pa.array(node[near[:, 1]])], names=["a", "b"])

        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(batch)
            last = [batch.column(k)[batch.num_rows - 1].as_py() for k in range(3)]
            first = [held[0].column(k)[0].as_py() for k in range(3)]
            if last == first:
                continue
            # The last group may go on in the next batch.
            same = np.logical_and.reduce([batch.column(k).to_numpy() == last[k] for k in range(3)])
            stop = batch.num_rows - int(same.sum())
            yield links(pa.Table.from_batches([*held[:-1], batch.slice(0, stop)]))
            held = [batch.slice(stop)]
        if held:
            yield links(pa.Table.from_batches(held))

    dealt = members.repartition(*names).sortWithinPartitions(*names)
    return dealt.select(*names, "own", "head", "node", "shingles").mapInArrow(work, "a long, b long")


def _runs(listed: DataFrame, run_words: int) -> DataFrame:
    """Runs of neighbouring repeats, of (doc, repeats): structs of first, words, kept."""
    names = ["doc_id", "first_word", "n_words", "n_paragraphs", "kept_doc_id"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for doc, repeats in zip(*[c.to_pylist() for c in batch.columns], strict=True):
                run: list[dict] = []
                end = 0
                for r in [*sorted(repeats, key=lambda r: (r["first"], -r["words"])), None]:
                    if r and run and r["first"] <= end:
                        run.append(r)
                    else:
                        if run and end - run[0]["first"] >= run_words:
                            rows.append((doc, run[0]["first"], end - run[0]["first"], len(run), run[0]["kept"]))
                        run, end = ([r], 0) if r else ([], 0)
                    end = max(end, r["first"] + r["words"]) if r else 0
            columns = list(zip(*rows, strict=True)) or [[]] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=names)

    return listed.mapInArrow(work, ", ".join(f"{n} long" for n in names))


def repeated_passages(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT, run_words: int = RUN_WORDS
) -> DataFrame:
    """One row per removed run: ``doc_id, first_word, n_words, n_paragraphs, kept_doc_id``.

    ``kept_doc_id`` holds the run's first paragraph, or one similar to it, earlier. Documents
    without repeats have no row.
    """
    docs = df.select(F.coalesce(F.col(id_col).cast("long"), F.lit(_NO_ID)).alias("doc"), F.col(text_col).alias("text"))
    places, _ = scratch(_places(docs), "paragraphs")
    keys = places.select("node", F.explode("keys").alias("key"))
    # Written before they are joined back, so that only one of both shuffles takes room at a time.
    pivots = keys.groupBy("key").agg(F.min("node").alias("pivot"), F.max("node").alias("last")).where("pivot != last")
    pivots, _ = scratch(pivots.select("key", "pivot"), "pivots")
    collided = keys.join(pivots, "key").where("node != pivot").select("key", "node", "pivot").distinct()
    collided, collided_path = scratch(collided, "band-collisions")
    pairs = collided.select(F.col("node").alias("a"), F.col("pivot").alias("b")).distinct()
    pairs, pairs_path = scratch(pairs, "collisions")
    wanted = pairs.select(F.col("a").alias("node")).union(pairs.select(F.col("b").alias("node"))).distinct()
    slim = places.select("node", "doc", "first", "words")
    one = slim.join(wanted, "node").groupBy("node").agg(F.min(F.struct("doc", "first", "words")).alias("at"))
    listed = one.groupBy("at.doc").agg(F.collect_list(F.struct("at.first", "at.words", "node")).alias("listed"))
    sets, sets_path = scratch(_shingles(docs.join(listed.hint("merge"), "doc")), "paragraph-sets")
    sets = sets.dropDuplicates(["node"])
    for side in "ab":
        pairs = pairs.join(sets.withColumnsRenamed({"node": side, "shingles": f"set_{side}"}), side)
    links, _ = scratch(_verified(pairs, percent), "passage-links")
    remove_path(df.sparkSession, pairs_path)
    members, members_path = scratch(_open_members(collided, links), "open-bands")
    remove_path(df.sparkSession, collided_path)
    more, _ = scratch(_verified_in_blocks(members.join(sets, "node"), percent).distinct(), "passage-links")
    for path in (members_path, sets_path):
        remove_path(df.sparkSession, path)
    links = links.union(more)
    named = slim.join(connected_components(links), "node", "left").withColumn("cluster", F.coalesce("component", "node"))
    place = F.struct("doc", "first", "words")
    first = named.groupBy("cluster").agg(F.min(place).alias("kept"), F.max(place).alias("last")).where(F.col("kept") != F.col("last"))
    # A line and a piece of it may be alike: what overlaps the paragraph that stays is no repeat.
    within = (F.col("doc") == F.col("kept.doc")) & (F.col("first") < F.col("kept.first") + F.col("kept.words"))
    later = named.join(first.select("cluster", "kept"), "cluster").where((place > F.col("kept")) & ~within)
    listed = later.groupBy("doc").agg(
        F.collect_set(F.struct("first", "words", F.col("kept.doc").alias("kept"))).alias("repeats")
    )
    real = lambda c: F.when(F.col(c) != _NO_ID, F.col(c)).alias(c)
    return _runs(listed, run_words).select(
        real("doc_id"), "first_word", "n_words", "n_paragraphs", real("kept_doc_id")
    )
