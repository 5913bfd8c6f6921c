"""Exact removal of repeated substrings, by sorting the suffixes that can repeat.

A byte goes if a string of ``LENGTH`` bytes that covers it also starts earlier: in a document with a
smaller id, or further ahead in its own. Strings never cross documents and are judged on the input.

1. *Anchors.* In each string the grams of ``GRAM`` bytes with the least hash are selected, so equal strings
   have an anchor at the same place. An anchor's context is every string that has it.
2. *Classes.* Anchors with equal context are one class: in all but its earliest member, each string of
   the context repeats. Classes that share no gram with another need nothing more.
3. *Suffixes.* The earliest members of classes that do share one may share strings still. The strings
   around them are narrowed by the core that neighbouring strings have in common, and those whose core
   occurs again are dealt by it and sorted as suffixes, deep-shallow: multikey quicksort to ``SHALLOW``
   characters of eight bytes, then a blind trie for each group with a longer common prefix. Of equal strings
   all but the earliest repeat. A core with more rows than ``CORE_ROWS`` is not sorted in one task:
   its strings are grouped by their bytes, with map-side combining.
4. The union of all repeated strings is cut out of each document.

Shuffled rows are hashes and places; groups are aggregated before they are joined back, so no group of
copies meets in one task. Texts are shuffled twice, to meet their anchors and their cuts.

Defined results: a NULL text has no bytes; texts shorter than ``LENGTH`` lose none. A NULL id comes before
all ids. Ids name documents: rows repeated with one id and one text count as one document, each with its
result; different texts under one id are not supported. An empty table gives an empty table; further columns
are not read.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curbline.llm.common import give_back_memory, scratch, slices, text_bytes
from curbline.llm.words import mix
from curbline.session import remove_path

LENGTH = 100
GRAM = 32
#: Strings of which each contains an anchor's gram at another place.
SPAN = LENGTH - GRAM + 1
SHALLOW = 4
CORE_ROWS = 4096
#: Ranges of an anchor's place in a string; strings of one range share a core.
RANGES = [(0, 17), (18, 35), (36, 52), (53, SPAN - 1)]
_NO_ID = -(1 << 63)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_BACK = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_BYTES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1B54A32D192ED03))


@functools.lru_cache(maxsize=2)
def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    both = [np.full(n, b, np.uint64) for b in (_BASE, _BASE_BACK)]
    for p in both:
        p[0] = 1
    return np.cumprod(both[0]), np.cumprod(both[1])


class RangeHashes:
    """Hashes of any ranges of a byte array, from sums over its prefixes."""

    def __init__(self, raw: np.ndarray) -> None:
        up, self.down = _powers(1 << (len(raw) + 1).bit_length())
        self.sums = np.zeros(len(raw) + 1, np.uint64)
        np.cumsum(_BYTES[raw] * up[: len(raw)], out=self.sums[1:])

    def of(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        lengths = (stop - start).astype(np.uint64)
        return mix((self.sums[stop] - self.sums[start]) * self.down[start] + lengths)


def _sliding(values: np.ndarray, width: int, least: bool) -> np.ndarray:
    """Least or greatest of each ``width`` neighbours."""
    pick, size = (np.minimum if least else np.maximum), 1
    while 2 * size <= width:
        values = pick(values[:-size], values[size:])
        size *= 2
    return pick(values[: len(values) - (width - size)], values[width - size :]) if width > size else values


def anchors(raw: np.ndarray, marks: np.ndarray, hashes: RangeHashes) -> tuple[np.ndarray, np.ndarray]:
    """Places of all selected grams in the array, and their hashes."""
    n = len(raw)
    if n < LENGTH:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    at = np.arange(n - GRAM + 1)
    grams = mix((hashes.sums[GRAM:] - hashes.sums[: n - GRAM + 1]) * hashes.down[: n - GRAM + 1])
    least = _sliding(grams, SPAN, True)
    # Strings that don't lie in one document select nothing.
    starts = np.zeros(n, bool)
    for a, b in zip(marks[:-1].tolist(), marks[1:].tolist(), strict=True):
        if b - a >= LENGTH:
            starts[a : b - LENGTH + 1] = True
    least[~starts[: len(least)]] = 0
    padded = np.concatenate([np.zeros(SPAN - 1, np.uint64), least, np.zeros(SPAN - 1, np.uint64)])
    chosen = at[(_sliding(padded, SPAN, False)[: len(at)] == grams) & (grams > 0)]
    return chosen, grams[chosen]


_ANCHORS = "gram long, context long, doc long, pos int"


def _find_anchors(docs: DataFrame) -> DataFrame:
    names = [c.split()[0] for c in _ANCHORS.split(", ")]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                raw, marks = text_bytes(part.column(1))
                hashes = RangeHashes(raw)
                at, grams = anchors(raw, marks, hashes)
                row = np.searchsorted(marks, at, side="right") - 1
                low = np.maximum(marks[row], at - (SPAN - 1))
                high = np.minimum(marks[row + 1], at + LENGTH)
                context = mix(hashes.of(low, high) + (at - low).astype(np.uint64))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(grams.view(np.int64)),
                        pa.array(context.view(np.int64)),
                        part.column(0).take(pa.array(row)),
                        pa.array((at - marks[row]).astype(np.int32)),
                    ],
                    names=names,
                )

    return docs.mapInArrow(work, _ANCHORS)


_AROUND = (
    "doc long, starts array<int>, stops array<int>, pos int, low int, around binary,"
    + ", ".join(f" core{k} long" for k in range(len(RANGES)))
)


def _around(met: DataFrame) -> DataFrame:
    """For (doc, text, later, shared): the spans repeated for certain, and the surroundings of ``shared`` anchors."""
    names = [c.split()[0] for c in _AROUND.split(",")]
    spans = pa.list_(pa.int32())

    def certain(docs: pa.Array, sizes: np.ndarray, later: pa.ListArray) -> pa.RecordBatch:
        rows, starts, stops = [], [], []
        places, edges = later.flatten().to_numpy().astype(np.int64), _edges(later)
        for row in np.flatnonzero(np.diff(edges)).tolist():
            own = places[edges[row] : edges[row + 1]]
            a, b = merged(np.maximum(0, own - (SPAN - 1)), np.minimum(sizes[row], own + LENGTH))
            rows.append(row)
            starts.append(a)
            stops.append(b)
        nulls = [pa.nulls(len(rows), kind) for kind in [pa.int32(), pa.int32(), pa.binary()] + [pa.int64()] * len(RANGES)]
        found = [docs.take(pa.array(rows, pa.int64())), pa.array(starts, spans), pa.array(stops, spans)]
        return pa.RecordBatch.from_arrays([*found, *nulls], names=names)

    def surroundings(docs: pa.Array, raw: np.ndarray, marks: np.ndarray, shared: pa.ListArray) -> pa.RecordBatch:
        row = np.repeat(np.arange(len(docs)), np.diff(_edges(shared)))
        pos = shared.flatten().to_numpy().astype(np.int64)
        begin, end = marks[row], marks[row + 1]
        at = begin + pos
        low, high = np.maximum(begin, at - (SPAN - 1)), np.minimum(end, at + LENGTH)
        hashes, cores = RangeHashes(raw), []
        for first, last in RANGES:
            start, stop = at - first, at + LENGTH - last
            there = (start >= begin) & (stop <= end)
            value = hashes.of(np.where(there, start, 0), np.where(there, stop, 0)).view(np.int64)
            cores.append(pa.array(value, mask=~there))
        nulls = [pa.nulls(len(row), spans)] * 2
        places = [pa.array(v.astype(np.int32)) for v in (pos, low - begin)]
        found = [docs.take(pa.array(row)), *nulls, *places, _pieces(raw, low, high), *cores]
        return pa.RecordBatch.from_arrays(found, names=names)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                raw, marks = text_bytes(part.column(1))
                later, shared = (_filled(part.column(k)) for k in (2, 3))
                yield certain(part.column(0), np.diff(marks), later)
                if len(shared.flatten()):
                    yield surroundings(part.column(0), raw, marks, shared)

    return met.select("doc", "text", "later", "shared").mapInArrow(work, _AROUND)


def _filled(lists: pa.ListArray) -> pa.ListArray:
    """NULL lists as empty ones."""
    sizes = np.asarray(lists.value_lengths().fill_null(0), dtype=np.int32)
    return pa.ListArray.from_arrays(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32), lists.flatten())


def _edges(lists: pa.ListArray) -> np.ndarray:
    return lists.offsets.to_numpy().astype(np.int64)


def _spread(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """All places of ranges, one range behind the other."""
    ends = np.cumsum(sizes)
    return np.repeat(starts - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)


def _pieces(raw: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> pa.Array:
    """Ranges of a byte array as a column of bytes."""
    sizes = stops - starts
    edges = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
    data = raw[_spread(starts, sizes)]
    return pa.Array.from_buffers(pa.binary(), len(sizes), [None, pa.py_buffer(edges), pa.py_buffer(data)])


def merged(starts: np.ndarray, stops: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The union of spans, as spans that don't touch."""
    if not len(starts):
        return starts, stops
    order = np.argsort(starts, kind="stable")
    starts, reach = starts[order], np.maximum.accumulate(stops[order])
    fresh = np.concatenate([[True], starts[1:] > reach[:-1]])
    return starts[fresh], reach[np.append(np.flatnonzero(fresh)[1:] - 1, len(reach) - 1)]


# ---------------------------------------------------------------- deep-shallow sorting


class BlindTrie:
    """Strings of equal length in order, by the bytes at which they part."""

    def __init__(self, first: bytes, tag: int) -> None:
        self.root: list = [first, [tag]]  # a leaf: string and tags; a fork: place and branches by byte

    def insert(self, string: bytes, tag: int) -> None:
        node = self.root
        while isinstance(node[0], int):
            node = node[1].get(string[node[0]]) or next(iter(node[1].values()))
        known = node[0]
        if known == string:
            node[1].append(tag)
            return
        # The first byte that differs, found in one comparison with the leaf.
        at = len(string) - ((int.from_bytes(known) ^ int.from_bytes(string)).bit_length() + 7) // 8
        node = self.root
        while isinstance(node[0], int) and node[0] < at:
            node = node[1][string[node[0]]]
        if isinstance(node[0], int) and node[0] == at:
            node[1][string[at]] = [string, [tag]]
        else:
            node[0], node[1] = at, {known[at]: [node[0], node[1]], string[at]: [string, [tag]]}

    def groups(self) -> Iterator[list[int]]:
        """Tags of equal strings, strings in order."""
        stack = [self.root]
        while stack:
            node = stack.pop()
            if isinstance(node[0], int):
                stack += [node[1][b] for b in sorted(node[1], reverse=True)]
            else:
                yield node[1]


def deep_shallow(flat: np.ndarray, at: np.ndarray, shallow: int = SHALLOW, width: int = LENGTH) -> Iterator[list[int]]:
    """Numbers of equal strings that aren't single, strings in order: the strings of ``width`` bytes of ``flat`` from ``at`` on.

    The quicksort goes over all groups of a depth at once, a character of eight bytes at a time; strings
    alone in their group leave. Those that are left share ``shallow`` characters and go to blind tries.
    """
    rows, group = np.arange(len(at)), np.zeros(len(at), np.int64)
    for depth in range(min(shallow, -(-width // 8))):
        own = min(8, width - 8 * depth)
        values = np.zeros(len(rows), np.uint64)
        for k in range(own):
            values = (values << np.uint64(8)) | flat[at[rows] + 8 * depth + k]
        order = np.argsort(values, kind="quicksort")
        order = order[np.argsort(group[order], kind="stable")]
        rows, values, before = rows[order], values[order], group[order]
        fresh = np.append(True, (values[1:] != values[:-1]) | (before[1:] != before[:-1]))[: len(rows)]
        group = np.cumsum(fresh) - 1
        many = np.bincount(group)[group] > 1 if len(rows) else np.zeros(0, bool)
        rows, group = rows[many], group[many]
        if not len(rows):
            return
    whole = flat.tobytes()
    edges = np.flatnonzero(np.append(True, group[1:] != group[:-1])).tolist()
    listed, places = rows.tolist(), at[rows].tolist()
    for low, high in zip(edges, [*edges[1:], len(listed)], strict=True):
        own = listed[low:high]
        texts = [whole[p : p + width] for p in places[low:high]]
        if texts.count(texts[0]) == len(texts):
            yield own
            continue
        trie = BlindTrie(texts[0], own[0])
        for text, r in zip(texts[1:], own[1:], strict=True):
            trie.insert(text, r)
        yield from (g for g in trie.groups() if len(g) > 1)


def _sort_cores(rows: DataFrame) -> DataFrame:
    """Repeated strings (doc, start) among (core, doc, start, around): every string within ``around``."""

    names = ["doc", "start"]

    def repeats(rows: pa.RecordBatch) -> pa.RecordBatch:
        flat, edges = text_bytes(rows.column(3))
        sizes = np.diff(edges)
        counts = sizes - LENGTH + 1
        at = _spread(edges[:-1], counts)
        docs = np.repeat(rows.column(1).to_numpy(), counts)
        starts = _spread(rows.column(2).to_numpy().astype(np.int64), counts)
        # Each string once, in the order of the corpus.
        order = np.lexsort((starts, docs))
        docs, starts, at = docs[order], starts[order], at[order]
        fresh = np.append(True, (docs[1:] != docs[:-1]) | (starts[1:] != starts[:-1]))
        docs, starts, at = docs[fresh], starts[fresh], at[fresh]
        out: list[int] = []
        for group in deep_shallow(flat, at):
            group.sort()
            out += group[1:]
        return pa.RecordBatch.from_arrays([pa.array(docs[out]), pa.array(starts[out].astype(np.int32))], names=names)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Rows of one core stay together: the last core of a part waits for the next part.
        held: list[pa.RecordBatch] = []
        for batch in batches:
            for at in range(0, batch.num_rows, CORE_ROWS):
                part = batch.slice(at, CORE_ROWS)
                core = part.column(0).to_numpy()
                if held and core[0] != held[-1].column(0)[-1].as_py():
                    yield repeats(_joined(held))
                    held = []
                last = int(np.searchsorted(core, core[-1]))
                if last:
                    yield repeats(_joined([*held, part.slice(0, last)]))
                    held = []
                held.append(part.slice(last))
        if held:
            yield repeats(_joined(held))
        give_back_memory()

    dealt = rows.select("core", "doc", "start", "around").repartition("core").sortWithinPartitions("core")
    return dealt.mapInArrow(work, "doc long, start int")


def _joined(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
    if len(parts) == 1:
        return parts[0]
    columns = [pa.concat_arrays([p.column(k) for p in parts]) for k in range(parts[0].num_columns)]
    return pa.RecordBatch.from_arrays(columns, names=parts[0].schema.names)


def _cut(met: DataFrame) -> DataFrame:
    """The result for (doc, text, starts, stops), with spans that may overlap."""
    names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                rows = []
                for doc, text, starts, stops in zip(*part.columns, strict=True):
                    data = (text.as_py() or "").encode("utf-8", "surrogatepass")
                    spans = [np.array(x.as_py() or [], dtype=np.int64) for x in (starts, stops)]
                    a, b = (x.tolist() for x in merged(*spans))
                    digest = hashlib.sha256()
                    for start, stop in zip([0, *b], [*a, len(data)], strict=True):
                        digest.update(memoryview(data)[start:stop])
                    rows.append((doc.as_py(), len(data), sum(b) - sum(a), len(a), digest.hexdigest()))
                kinds = [pa.int64()] * 4 + [pa.string()]
                columns = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)

    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    return met.select("doc", "text", "starts", "stops").mapInArrow(work, schema)


def repeated_spans(docs: DataFrame) -> DataFrame:
    """(doc, starts, stops): the spans of (doc, text) that repeat, several rows for a document."""
    spark = docs.sparkSession
    found, found_path = scratch(_find_anchors(docs), "anchors")
    # Most grams occur once: the rest alone is classified.
    often = found.groupBy("gram").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("gram")
    often, _ = scratch(often, "frequent-grams")
    live, live_path = scratch(found.join(often, "gram"), "live-anchors")
    remove_path(spark, found_path)
    place = F.struct("doc", "pos")
    classes, classes_path = scratch(
        live.groupBy("gram", "context").agg(F.min(place).alias("first"), F.max(place).alias("last")), "classes"
    )
    again = classes.where(F.col("first") != F.col("last"))
    later = live.join(again, ["gram", "context"]).where(place > F.col("first")).select("doc", "pos", F.lit(True).alias("later"))
    kinds = classes.groupBy("gram").agg(F.min("context").alias("a"), F.max("context").alias("b")).where("a != b")
    shared = classes.join(kinds.select("gram"), "gram").select("first.doc", "first.pos", F.lit(False).alias("later"))
    listed = later.union(shared).groupBy("doc").agg(
        F.collect_list(F.when(F.col("later"), F.col("pos"))).alias("later"),
        F.collect_list(F.when(~F.col("later"), F.col("pos"))).alias("shared"),
    )
    around, _ = scratch(_around(docs.join(listed, "doc")), "surroundings")
    for path in (live_path, classes_path):
        remove_path(spark, path)
    sure = around.where(F.col("starts").isNotNull()).select("doc", "starts", "stops")

    # Each range of places in which an anchor's strings share a core, with the bytes of those strings.
    ranges = F.array(
        *[
            F.struct(
                F.lit(first).alias("first"), F.lit(last).alias("last"), F.lit(r).alias("range"), F.col(f"core{r}").alias("value")
            )
            for r, (first, last) in enumerate(RANGES)
        ]
    )
    single = around.where(F.col("pos").isNotNull()).select("doc", "pos", "low", "around", F.explode(ranges).alias("r"))
    single = single.where(F.col("r.value").isNotNull()).select(
        F.xxhash64("r.range", "r.value").alias("core"), "doc", "low",
        F.greatest("low", F.col("pos") - F.col("r.last")).alias("start"),
        (F.col("pos") + LENGTH - F.col("r.first")).alias("stop"),
        "around",
    )
    counts = single.groupBy("core").agg(F.count(F.lit(1)).alias("rows")).where("rows > 1")
    narrowed, _ = scratch(
        single.join(counts, "core").select(
            "core", "rows", "doc", "start",
            F.expr("substring(around, start - low + 1, stop - start)").alias("around"),
        ),
        "cores",
    )
    sorted_ = _sort_cores(narrowed.where(F.col("rows") <= CORE_ROWS))
    strings = narrowed.where(F.col("rows") > CORE_ROWS).select(
        "doc",
        "start",
        F.posexplode(
            F.transform(
                F.sequence(F.lit(1), F.length("around") - LENGTH + 1), lambda i: F.substring("around", i, F.lit(LENGTH))
            )
        ).alias("k", "string"),
    )
    strings = strings.select("doc", (F.col("start") + F.col("k")).alias("start"), "string")
    where = F.struct("doc", "start")
    first = strings.groupBy("string").agg(F.min(where).alias("first"), F.max(where).alias("last"))
    hot = strings.join(first.where(F.col("first") != F.col("last")), "string").where(where > F.col("first")).select("doc", "start")
    rest = sorted_.union(hot).groupBy("doc").agg(F.collect_set("start").alias("starts"))
    return sure.union(rest.select("doc", "starts", F.transform("starts", lambda s: s + LENGTH).alias("stops")))


def remove_repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document ``doc_id, n_bytes, n_removed, n_spans, kept_sha256``."""
    docs = df.select(F.coalesce(F.col(id_col).cast("long"), F.lit(_NO_ID)).alias("doc"), F.col(text_col).alias("text"))
    spans = repeated_spans(docs).groupBy("doc").agg(
        F.flatten(F.collect_list("starts")).alias("starts"), F.flatten(F.collect_list("stops")).alias("stops")
    )
    spans, _ = scratch(spans, "repeats")
    done = _cut(docs.join(spans, "doc", "left"))
    return done.withColumn("doc_id", F.when(F.col("doc_id") != _NO_ID, F.col("doc_id")))
