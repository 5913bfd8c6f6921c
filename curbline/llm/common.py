"""What several corpus operators share: scratch tables, Arrow columns, text order."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curbline.session import scratch_path

#: Parquet tables that a later stage rereads; zstd halves them against snappy.
SCRATCH_OPTIONS = {"compression": "zstd"}

#: Spark's own removal of a finished write's shuffle files.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

#: Texts are worked on in pieces of about this many bytes, whatever the batch size.
SLICE_BYTES = 4 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch(df: DataFrame, label: str) -> tuple[DataFrame, str]:
    """``df`` written once to the shared folder and reread; also its path.

    Cuts the lineage: tasks lost later reread the files.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    # Once the table is written its shuffles are of no more use.
    before = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        df.write.options(**SCRATCH_OPTIONS).parquet(path)
    finally:
        spark.conf.set(_CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path), path


def slices(batch: pa.RecordBatch, column: str, size: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in consecutive row ranges of about ``size`` bytes of ``column``.

    A longer text is a range of its own. Behind the last range, free memory is given back.
    """
    texts = batch.column(column)
    if batch.num_rows == 0:
        return
    lengths = np.asarray(pa.compute.binary_length(texts).fill_null(0), dtype=np.int64)
    ends = np.cumsum(lengths)
    start = 0
    while start < batch.num_rows:
        base = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, base + size, side="right")))
        yield batch.slice(start, stop - start)
        start = stop
    give_back_memory()


def give_back_memory() -> None:
    """Return to the system what Arrow and the C library hold free.

    Workers outlive their stage: what they hold, the next stage's tasks on the executor lack.
    """
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All texts of a column as one UTF-8 byte array, and the n+1 offsets of its rows."""
    column = column.fill_null("") if column.null_count else column
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, offsets, data = column.buffers()
    marks = np.frombuffer(offsets, kind)[column.offset : column.offset + len(column) + 1]
    if data is None:
        return np.zeros(0, np.uint8), marks.astype(np.int64)
    raw = np.frombuffer(data, np.uint8)[marks[0] : marks[-1]]
    return raw, (marks - marks[0]).astype(np.int64)


def null_first(name: str):
    """A sort value for an id column that puts NULL before every id."""
    return F.struct(F.col(name).isNotNull(), F.col(name))
