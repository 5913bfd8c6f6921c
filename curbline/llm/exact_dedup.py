"""Exact duplicates by Grace hashing: partition to spill files, then open addressing.

Texts are compared without the characters of ``[\\x20\\x09-\\x0D]``. Each map task first
groups the rows of its own split, so one copy of a text per task is shuffled, however
many copies there are; the shuffle partitions those copies by digest, and each reduce
task groups them again. Both use ``grace``: records go to an open-addressing table that
compares complete contents, and when the table outgrows its budget everything is
partitioned by further digest bits to spill files, which are grouped one by one.

Spill files are unnamed files of the running task attempt, as Spark's own spills are: they
vanish with it, and a retried task starts over. Nothing else is kept outside Spark's
shuffle and the shared scratch folder.

Defined results: a NULL text counts as empty; all empty texts are one group. Of equal texts
the row with the most code points in the original text stays, then the smallest id (a
NULL id comes before all). Rows repeated under one id are counted each and share the
decision on that id. An empty table gives an empty table; further columns of the input are
not read.
"""

from __future__ import annotations

import hashlib
import tempfile
from array import array
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curbline.llm.common import scratch

#: Bytes of distinct contents that a task holds at once.
TABLE_BYTES = 64 << 20
FANOUT_BITS = 4
_BLANKS = b" \t\n\v\f\r"
#: Stands for a NULL id inside tasks: smaller than every id.
_NO_ID = -(1 << 63)


class Group:
    """One distinct text: its best row, its row count and what belongs to it."""

    __slots__ = ("best_id", "content", "count", "digest", "members", "points")

    def __init__(self, digest: bytes, content: bytes) -> None:
        self.digest, self.content = digest, content
        self.points, self.best_id, self.count, self.members = -1, 0, 0, array("q")

    def add(self, points: int, best_id: int, count: int, members: Iterable[int]) -> None:
        if (-points, best_id) < (-self.points, self.best_id):
            self.points, self.best_id = points, best_id
        self.count += count
        self.members.extend(members)


class OpenTable:
    """Linear probing over a power-of-two array of group numbers."""

    def __init__(self) -> None:
        self.groups: list[Group] = []
        self.bytes = 0
        self._slots = array("q", [-1]) * 1024

    def find(self, digest: bytes, content: bytes) -> Group:
        slots, mask = self._slots, len(self._slots) - 1
        at = int.from_bytes(digest[-8:], "little") & mask
        while (n := slots[at]) >= 0:
            group = self.groups[n]
            if group.digest == digest and group.content == content:
                return group
            at = (at + 1) & mask
        slots[at] = len(self.groups)
        self.groups.append(group := Group(digest, content))
        self.bytes += len(content) + 256
        if 2 * len(self.groups) > len(slots):
            self._grow()
        return group

    def _grow(self) -> None:
        slots = array("q", [-1]) * (2 * len(self._slots))
        mask = len(slots) - 1
        for n, group in enumerate(self.groups):
            at = int.from_bytes(group.digest[-8:], "little") & mask
            while slots[at] >= 0:
                at = (at + 1) & mask
            slots[at] = n
        self._slots = slots


Record = tuple[bytes, bytes, int, int, int, Iterable[int]]


def grace(records: Iterable[Record], budget: int = TABLE_BYTES, depth: int = 0) -> Iterator[Group]:
    """The groups of equal contents among (digest, content, points, id, count, members).

    Only distinct contents use up the budget, so a group of many copies is never
    partitioned on and on. Different contents with equal digests stay together to the last
    level, where they are grouped whatever their size.
    """
    table = OpenTable()
    files: list = []
    levels = 8 * 16 // FANOUT_BITS

    def spill(record: Record) -> None:
        digest, content, points, best, count, members = record
        bits = int.from_bytes(digest[:16], "big") >> (128 - FANOUT_BITS * (depth + 1))
        held = members if isinstance(members, array) else array("q", members)
        head = array("q", [len(content), points, best, count, len(held)])
        file = files[bits & ((1 << FANOUT_BITS) - 1)]
        file.write(head.tobytes() + digest + content)
        held.tofile(file)

    for record in records:
        if files:
            spill(record)
            continue
        digest, content, points, best, count, members = record
        table.find(digest, content).add(points, best, count, members)
        if table.bytes > budget and depth < levels:
            files = [tempfile.TemporaryFile() for _ in range(1 << FANOUT_BITS)]
            for g in table.groups:
                spill((g.digest, g.content, g.points, g.best_id, g.count, g.members))
            table = OpenTable()
    yield from table.groups
    for file in files:
        with file:
            file.seek(0)
            yield from grace(_read_back(file), budget, depth + 1)


def _read_back(file) -> Iterator[Record]:
    while head := file.read(40):
        size, points, best, count, n = array("q", head)
        digest, content, members = file.read(32), file.read(size), array("q")
        members.frombytes(file.read(8 * n))
        yield digest, content, points, best, count, members


_LOCAL = (
    "local_id long, sha binary, content binary, points long, best_id long, rows long,"
    " members array<long>"
)


def _batches(groups: Iterator[Group], row, schema: pa.Schema, limit: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    rows, size = [], 0
    for group in groups:
        rows.extend(row(group))
        size += len(group.content) + 8 * len(group.members) + 100
        if size > limit:
            yield pa.RecordBatch.from_pylist(rows, schema)
            rows, size = [], 0
    if rows:
        yield pa.RecordBatch.from_pylist(rows, schema)


def exact_groups(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", budget: int = TABLE_BYTES) -> DataFrame:
    """One row per row of ``df``: its id, ``keep_id``, ``group_size``, ``kept``, ``text_sha256``."""

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # Numbers of groups are unique over all tasks that write this table.
        number = iter(range(TaskContext.get().partitionId() << 32, 1 << 62))

        def records() -> Iterator[Record]:
            for batch in batches:
                for doc, text in zip(batch.column(0), batch.column(1), strict=True):
                    text = text.as_py() or ""
                    content = text.encode("utf-8", "surrogatepass").translate(None, _BLANKS)
                    doc = _NO_ID if doc.as_py() is None else doc.as_py()
                    yield hashlib.sha256(content).digest(), content, len(text), doc, 1, (doc,)

        def row(g: Group) -> list[dict]:
            return [
                {
                    "local_id": next(number), "sha": g.digest, "content": g.content, "points": g.points,
                    "best_id": g.best_id, "rows": g.count, "members": g.members,
                }
            ]

        schema = pa.schema(
            [
                ("local_id", pa.int64()), ("sha", pa.binary()), ("content", pa.binary()), ("points", pa.int64()),
                ("best_id", pa.int64()), ("rows", pa.int64()), ("members", pa.list_(pa.int64())),
            ]
        )
        yield from _batches(grace(records(), budget), row, schema)

    def overall(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def records() -> Iterator[Record]:
            for batch in batches:
                columns = [c.to_pylist() for c in batch.columns]
                for local_id, sha, content, points, best, rows in zip(*columns, strict=True):
                    yield sha, content, points, best, rows, (local_id,)

        def row(g: Group) -> list[dict]:
            return [{"local_id": m, "keep_id": g.best_id, "group_size": g.count} for m in g.members]

        schema = pa.schema([("local_id", pa.int64()), ("keep_id", pa.int64()), ("group_size", pa.int64())])
        yield from _batches(grace(records(), budget), row, schema)

    source = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    groups, _ = scratch(source.mapInArrow(local, _LOCAL), "exact-local")
    sent = groups.select("local_id", "sha", "content", "points", "best_id", "rows").repartition("sha")
    decided = sent.mapInArrow(overall, "local_id long, keep_id long, group_size long")
    # Each side has a local group once: a hot text is spread over as many keys as tasks saw it.
    listed = groups.select("local_id", "sha", "members").join(decided, "local_id")
    rows = listed.select(
        F.explode("members").alias("doc"),
        F.col("keep_id").alias("best"),
        "group_size",
        F.lower(F.hex("sha")).alias("text_sha256"),
    )
    real = lambda c: F.when(c != F.lit(_NO_ID), c)
    return rows.select(
        real(F.col("doc")).alias("doc_id"),
        real(F.col("best")).alias("keep_id"),
        "group_size",
        (F.col("doc") == F.col("best")).alias("kept"),
        "text_sha256",
    )
