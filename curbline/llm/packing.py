"""Packing by powers of two: no sequence crosses a document, and none is padded.

A document's ids, with an end id behind them, are cut into full sequences of
``max_tokens`` and then into pieces as long as the binary digits of what is left, longest
first. Pieces of equal length form a bucket; each piece is a sequence of its own, so its
offset is 0 and a batch from one bucket needs no padding.

Ids are those of the tokenizer on the whole text (see ``word_ids``).

Defined results: a NULL or empty text is the end id alone; a NULL ``doc_id`` stays NULL;
repeated rows are packed each; an empty table gives an empty table; further columns of the
input are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curbline.llm.common import scratch, slices
from curbline.llm.word_ids import WORD_SLICE, with_end, worker_words

MAX_TOKENS = 4096
END_ID = 2


def pieces_of(n: int, max_tokens: int = MAX_TOKENS) -> np.ndarray:
    """The lengths into which ``n`` ids are cut."""
    digits = [1 << b for b in reversed(range(max_tokens.bit_length() - 1)) if n % max_tokens >> b & 1]
    return np.array([max_tokens] * (n // max_tokens) + digits, dtype=np.int64)


_PIECES = "doc_id long, start long, length long, doc_tokens long, ids_crc32 long, ids array<int>"


def digests(ids: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """The crc32 of each run of ids, as unsigned 32-bit little-endian numbers."""
    raw = memoryview(ids.astype("<u4").tobytes())
    at = (4 * edges).tolist()
    return np.array([zlib.crc32(raw[a:b]) for a, b in zip(at[:-1], at[1:], strict=True)], np.int64)


def pack(
    df: DataFrame,
    tokenizer_path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    max_tokens: int = MAX_TOKENS,
    end_id: int = END_ID,
    with_ids: bool = True,
) -> DataFrame:
    """One row per piece: ``doc_id, start, length, doc_tokens, ids_crc32, sequence_id, offset``
    and, unless they are not wanted, its ``ids``.

    ``length`` is the bucket: a power of two up to ``max_tokens``. ``sequence_id`` is unique.
    """
    names = [c.split()[0] for c in _PIECES.split(", ")]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = worker_words(tokenizer_path)
        for batch in batches:
            for part in slices(batch, "text", WORD_SLICE):
                ids, marks = with_end(*words.encode(part.column(1)), end_id)
                totals = np.diff(marks)
                each = [pieces_of(n, max_tokens) for n in totals.tolist()]
                counts = [len(sizes) for sizes in each]
                sizes = np.concatenate(each)
                edges = np.concatenate([[0], np.cumsum(sizes)])
                columns = [
                    np.repeat(np.arange(len(totals)), counts),
                    edges[:-1] - np.repeat(marks[:-1], counts),
                    sizes,
                    np.repeat(totals, counts),
                    digests(ids, edges),
                ]
                docs = part.column(0).take(pa.array(columns[0]))
                kept = pa.nulls(len(sizes), pa.list_(pa.int32()))
                if with_ids:
                    kept = pa.ListArray.from_arrays(edges.astype(np.int32), ids.astype(np.int32))
                numbers = [pa.array(c, pa.int64()) for c in columns[1:]]
                yield pa.RecordBatch.from_arrays([docs, *numbers, kept], names=names)

    source = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    # Written once, so that a piece's number cannot change between two readings.
    pieces, _ = scratch(source.mapInArrow(cut, _PIECES), "pieces")
    numbered = pieces.select(
        "*", F.monotonically_increasing_id().alias("sequence_id"), F.lit(0).cast("long").alias("offset")
    )
    return numbered if with_ids else numbered.drop("ids")
