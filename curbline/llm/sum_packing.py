"""Best-fit packing by sums of squares: documents fill sequences of a fixed length, uncut if they fit.

A document's ids, with an end id behind them, are one piece, unless it is longer than a sequence:
then it is cut into full sequences and a rest. Every other piece is placed where the sum, over
all residual gaps, of the squared number of open sequences with that gap becomes smallest; a new
sequence is one of the choices, a full one is no longer open. Ties go to the smallest gap, an open
sequence before a new one. Keeping those counts even leaves a fitting gap for nearly every length.

Pieces are dealt by a hash into groups of about ``GROUP_PIECES``; a group's lengths are all that
its task holds. It places its pieces longest first, then empties the sequences that are left with
more than ``LOOSE`` free places and places what they held anew, ``ROUNDS`` times, keeping
whichever is fewer. Groups and places depend on the pieces alone. Ids never leave their own table:
lengths are dealt out, and each piece's place is joined back to it.

Defined results: a NULL or empty text is the end id alone; a NULL ``doc_id`` stays NULL; repeated
rows are packed each; an empty table gives an empty table; further columns of the input are
not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curbline.llm.common import scratch, slices
from curbline.llm.packing import digests
from curbline.llm.word_ids import WORD_SLICE, with_end, worker_words

MAX_TOKENS = 2048
END_ID = 0
GROUP_PIECES = 1 << 14
LOOSE = 2
ROUNDS = 5

_NEVER = np.iinfo(np.int64).max
_PIECES = "uid long, doc_id long, piece int, start long, length long, ids_crc32 long, ids array<int>"


def place(lengths: np.ndarray, size: int = MAX_TOKENS) -> tuple[np.ndarray, np.ndarray]:
    """The sequence (from 0) and the offset in it of every piece, placed in the order given."""
    open_ = np.zeros(size + 1, np.int64)
    stacks: list[list[int]] = [[] for _ in range(size + 1)]
    sequences, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    used = 0
    for i, n in enumerate(lengths.tolist()):
        # By how much the sum grows for every gap from n on; the gap that is left counts unless it is 0.
        before = open_[n:size]
        grows = np.where(before > 0, 1 - 2 * before, _NEVER)
        grows[1:] += np.where(before[1:] > 0, 2 * open_[1 : size - n] + 1, 0)
        best = int(np.argmin(grows)) if len(grows) else -1
        fresh = 2 * open_[size - n] + 1 if n < size else 0
        if best >= 0 and grows[best] != _NEVER and grows[best] <= fresh:
            gap = n + best
            sequences[i] = stacks[gap].pop()
            open_[gap] -= 1
        else:
            gap, sequences[i] = size, used
            used += 1
        offsets[i] = size - gap
        if gap > n:
            open_[gap - n] += 1
            stacks[gap - n].append(int(sequences[i]))
    return sequences, offsets


def place_group(lengths: np.ndarray, size: int = MAX_TOKENS, rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """All pieces longest first; then those of loosely filled sequences anew, as long as that saves any."""
    order = np.argsort(-lengths, kind="stable")
    sequences, offsets = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    sequences[order], offsets[order] = place(lengths[order], size)
    shuffled = np.random.default_rng(len(lengths))
    for turn in range(rounds):
        filled = np.bincount(sequences, weights=lengths).astype(np.int64)
        loose = filled < size - LOOSE
        again = np.flatnonzero(loose[sequences])
        if not len(again) or int(loose.sum()) == -(-int(lengths[again].sum()) // size):
            break
        # By turns in any order and longest first.
        again = shuffled.permutation(again) if turn % 2 == 0 else again[np.argsort(-lengths[again], kind="stable")]
        new, at = place(lengths[again], size)
        if new.max() + 1 <= loose.sum():
            numbers = np.flatnonzero(loose)
            sequences[again], offsets[again] = numbers[new], at
            # A sequence left over is no longer used: number the others without holes.
            sequences = np.unique(sequences, return_inverse=True)[1]
    return sequences, offsets


def pack(
    df: DataFrame,
    tokenizer_path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    max_tokens: int = MAX_TOKENS,
    end_id: int = END_ID,
) -> DataFrame:
    """One row per piece: ``doc_id, piece, start, length, ids_crc32, ids, sequence_id, offset``.

    ``start`` and ``piece`` are its place in the document, ``sequence_id`` and ``offset`` where it is packed.
    """
    names = [c.split()[0] for c in _PIECES.split(", ")]

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = worker_words(tokenizer_path)
        # The same number each time the task is run.
        uid = TaskContext.get().partitionId() << 40
        for batch in batches:
            for part in slices(batch, "text", WORD_SLICE):
                ids, marks = with_end(*words.encode(part.column(1)), end_id)
                totals = np.diff(marks)
                counts = -(-totals // max_tokens)
                doc = np.repeat(np.arange(len(totals)), counts)
                number = np.arange(len(doc)) - np.repeat(np.cumsum(counts) - counts, counts)
                starts = number * max_tokens
                sizes = np.minimum(totals[doc] - starts, max_tokens)
                edges = np.concatenate([[0], np.cumsum(sizes)])
                columns = [
                    pa.array(uid + np.arange(len(doc))),
                    part.column(0).take(pa.array(doc)),
                    pa.array(number, pa.int32()),
                    pa.array(starts),
                    pa.array(sizes),
                    pa.array(digests(ids, edges)),
                    pa.ListArray.from_arrays(edges.astype(np.int32), ids.astype(np.int32)),
                ]
                uid += len(doc)
                yield pa.RecordBatch.from_arrays(columns, names=names)

    def place_all(table: pa.Table) -> pa.Table:
        table = table.sort_by("uid")
        group = int(table.column("group")[0].as_py())
        sequences, offsets = place_group(table.column("length").to_numpy(), max_tokens)
        return pa.table({"uid": table.column("uid"), "sequence_id": sequences + (group << 32), "offset": offsets})

    source = df.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    pieces, _ = scratch(source.mapInArrow(cut, _PIECES), "pieces")
    short = pieces.where(F.col("length") < max_tokens)
    groups = max(1, -(-short.count() // GROUP_PIECES))
    dealt = short.select("uid", "length", F.pmod(F.xxhash64("uid"), F.lit(groups)).alias("group"))
    placed = dealt.groupBy("group").applyInArrow(place_all, "uid long, sequence_id long, offset long")
    # A full piece is a sequence of its own, numbered below 0.
    whole = F.col("length") == max_tokens
    return (
        pieces.join(placed, "uid", "left")
        .withColumn("sequence_id", F.when(whole, -1 - F.col("uid")).otherwise(F.col("sequence_id")))
        .withColumn("offset", F.when(whole, F.lit(0).cast("long")).otherwise(F.col("offset")))
        .drop("uid")
    )
