"""Document quality from a linear-chain conditional random field over lines.

Every line is good or bad. Its features are shares of kinds of characters and words, and
those of the lines before and behind; transitions tie neighbouring labels. The labels of
training are the documents': each line of a document has its document's label. A document's raw
quality is the mean of its lines' marginals, from the forward-backward recursion, weighted by
their length; a logistic curve, fitted on the same rows, turns it into a probability.

The model is fitted on a sample of labelled rows, bounded by ``SAMPLE_DOCS`` documents of at
most ``SAMPLE_LINES`` lines, drawn by a hash of the id. Every document is scored, on its whole
text, from its text alone.

Defined results: NULL, empty and blank texts have no lines and get the share of label 1 in the
sample (``NO_LABELS`` without any). Labels other than 0 and 1 are left out; a document
labelled twice counts with its lower label. A NULL id is scored like any other, and not held
out. Without labels of both kinds every text gets that share. Repeated rows keep their
multiplicity; an empty table gives an empty table; further columns are kept by ``keep_good``
and not read by ``score``.
"""

from __future__ import annotations

import pickle
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curbline.llm.common import give_back_memory, slices, text_bytes
from curbline.llm.words import split_words

SAMPLE_DOCS = 3000
SAMPLE_LINES = 400
THRESHOLD = 0.3
NO_LABELS = 0.5
#: Labelled rows whose hash of the id has this remainder are held out.
FOLDS, HELD_OUT = 5, 0
_ROUNDS = 120

_KINDS = 8


def _kind_tables() -> np.ndarray:
    """For each byte, its kind as a count in one of two halves of four 64-bit numbers."""
    kinds = [
        range(65, 91), range(97, 123), range(48, 58), b".,;:?-'\"()", b"!", b"|", b"#$%&*@^~+=<>{}[]\\/_`", range(128, 256),
    ]
    tables = np.zeros((_KINDS // 2, 256), np.uint64)
    for k, kind in enumerate(kinds):
        tables[k // 2, list(kind)] += np.uint64(1 << 32 * (k % 2))
    return tables


_TABLES = _kind_tables()
#: Features of one line; with both neighbours three times as many, and whether there are any.
LINE_FEATURES = _KINDS + 6
FEATURES = 3 * LINE_FEATURES + 2


class Lines(NamedTuple):
    features: np.ndarray
    lengths: np.ndarray
    marks: np.ndarray  # of the documents, n+1


def line_features(texts: pa.Array) -> Lines:
    raw, marks = text_bytes(texts)
    n = len(marks) - 1
    ends = np.unique(np.concatenate([np.flatnonzero(raw == 10) + 1, marks]))
    starts, stops = ends[:-1], ends[1:]
    blank = np.zeros(256, bool)
    blank[[9, 10, 11, 12, 13, 32]] = True
    gaps = blank[raw]
    first = ~gaps
    first[1:] &= gaps[:-1]
    first[marks[:-1][marks[:-1] < len(raw)]] = ~gaps[marks[:-1][marks[:-1] < len(raw)]]
    if not len(starts):
        return Lines(np.zeros((0, FEATURES), np.float32), np.zeros(0), np.zeros(n + 1, np.int64))
    words = np.add.reduceat(first, starts, dtype=np.int64)
    # Words that repeat the one before, or the one before that, in their line.
    coded = split_words(texts)[0].dictionary_encode().indices.to_numpy(zero_copy_only=False)
    line = np.repeat(np.arange(len(starts)), words)
    again = np.zeros((2, len(coded)), bool)
    for k in (1, 2):
        again[k - 1, k:] = (coded[k:] == coded[:-k]) & (line[k:] == line[:-k])
    repeats = [np.bincount(line[again[k]], minlength=len(starts)) for k in (0, 1)]
    columns = []
    for table in _TABLES:
        both = np.add.reduceat(table[raw], starts)
        columns += [both & np.uint64(0xFFFFFFFF), both >> np.uint64(32)]
    full = words > 0
    size = (stops - starts)[full].astype(np.float64)
    words, counts = words[full], [c[full].astype(np.float64) for c in columns]
    upper, lower = counts[0], counts[1]
    letters = upper + lower + counts[7] + 1
    own = np.stack(
        [upper / letters, lower / letters, *[c / size for c in counts[2:]]]
        + [r[full] / words for r in repeats]
        + [counts[6] / words, counts[4] / words, np.log1p(words) / 5, size / words / 10],
        axis=1,
    )
    inside = np.searchsorted(starts[full], marks)
    edge_first, edge_last = np.zeros(len(own), bool), np.zeros(len(own), bool)
    some = inside[1:] > inside[:-1]
    edge_first[inside[:-1][some]] = True
    edge_last[inside[1:][some] - 1] = True
    before, behind = np.roll(own, 1, axis=0), np.roll(own, -1, axis=0)
    before[edge_first], behind[edge_last] = 0, 0
    features = np.concatenate([own, before, behind, edge_first[:, None], edge_last[:, None]], axis=1)
    return Lines(features.astype(np.float32), size, inside)


class Model(NamedTuple):
    centre: np.ndarray
    scale: np.ndarray
    weights: np.ndarray  # of label good, the bias last
    steps: np.ndarray  # 2 x 2, log potentials of neighbouring labels
    slope: float
    shift: float
    share: float


def _chains(marks: np.ndarray) -> list[np.ndarray]:
    """The k-th lines of all documents that have one, for k = 0, 1, ..., documents by length."""
    sizes = np.diff(marks)
    order = np.argsort(-sizes, kind="stable")
    starts, sizes = marks[:-1][order], sizes[order]
    longest = int(sizes[0]) if len(sizes) else 0
    counts = np.searchsorted(-sizes, -np.arange(longest), side="left")
    return [starts[:c] + k for k, c in enumerate(counts)]


def marginals(odds: np.ndarray, marks: np.ndarray, steps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The probability of good for each line, and the summed probabilities of neighbouring labels."""
    scores = np.stack([np.zeros_like(odds), odds], axis=1)
    ahead, back = np.zeros_like(scores), np.zeros_like(scores)
    chains = _chains(marks)
    for k, now in enumerate(chains):
        ahead[now] = scores[now]
        if k:
            ahead[now] += np.logaddexp(*(ahead[now - 1][:, a, None] + steps[a] for a in (0, 1)))
    for now in chains[:0:-1]:
        after = scores[now] + back[now]
        back[now - 1] = np.logaddexp(*(after[:, b, None] + steps[:, b] for b in (0, 1)))
    both = ahead + back
    total = np.logaddexp(both[:, 0], both[:, 1])
    pairs = np.zeros((2, 2))
    later = np.concatenate(chains[1:]) if len(chains) > 1 else np.zeros(0, np.int64)
    for a in (0, 1):
        for b in (0, 1):
            pairs[a, b] = np.exp(
                ahead[later - 1, a] + steps[a, b] + scores[later, b] + back[later, b] - total[later]
            ).sum()
    return np.exp(both[:, 1] - total), pairs


def _raw_quality(lines: Lines, model: Model) -> np.ndarray:
    """Log-odds of the length-weighted mean marginal; NaN for documents without lines."""
    odds = ((lines.features - model.centre) / model.scale) @ model.weights[:-1] + model.weights[-1]
    good, _ = marginals(odds.astype(np.float64), lines.marks, model.steps)
    sums = lambda v: np.diff(np.concatenate([[0], np.cumsum(v)])[lines.marks])
    with np.errstate(invalid="ignore", divide="ignore"):
        mean = np.clip(sums(good * lines.lengths) / sums(lines.lengths), 1e-6, 1 - 1e-6)
    return np.log(mean / (1 - mean))


def predict(texts: pa.Array, model: Model) -> np.ndarray:
    """A score between 0 and 1 per text."""
    raw = _raw_quality(line_features(texts), model)
    score = 1 / (1 + np.exp(-(model.slope * raw + model.shift)))
    return np.where(np.isnan(raw), model.share, score)


def _all_lines(texts: pa.Array) -> Lines:
    """Features of many texts, worked out slice by slice."""
    batch = pa.RecordBatch.from_arrays([texts], names=["text"])
    found = [line_features(part.column(0)) for part in slices(batch, "text")]
    if not found:
        return line_features(texts)
    counts = np.concatenate([np.diff(lines.marks) for lines in found])
    marks = np.concatenate([[0], np.cumsum(counts)])
    return Lines(np.concatenate([f.features for f in found]), np.concatenate([f.lengths for f in found]), marks)


def fit(texts: list[str], labels: list[int]) -> Model:
    """Weights by gradient ascent on the penalised likelihood, then the curve for whole documents."""
    y = np.array(labels, dtype=np.float64)
    share = float(y.mean()) if len(y) else NO_LABELS
    lines = _all_lines(pa.array(texts, pa.string()))
    some = np.diff(lines.marks) > 0
    if not 0 < y[some].sum() < some.sum():
        ones = np.ones(FEATURES)
        return Model(0 * ones, ones, np.zeros(FEATURES + 1), np.zeros((2, 2)), 0.0, float(np.log((share + 1e-3) / (1 - share + 1e-3))), share)
    centre, scale = lines.features.mean(axis=0), lines.features.std(axis=0) + 1e-3
    x = np.hstack([(lines.features - centre) / scale, np.ones((len(lines.features), 1), np.float32)])
    sizes = np.diff(lines.marks)
    target = np.repeat(y, sizes)
    seen = np.array([[((1 - y) * np.maximum(sizes - 1, 0)).sum(), 0], [0, (y * np.maximum(sizes - 1, 0)).sum()]])
    theta = np.zeros(FEATURES + 1 + 4)
    first, second = np.zeros_like(theta), np.zeros_like(theta)
    for k in range(1, _ROUNDS + 1):
        good, pairs = marginals(x @ theta[: FEATURES + 1], lines.marks, theta[-4:].reshape(2, 2))
        slope = np.concatenate([(target - good) @ x, (seen - pairs).ravel()]) / len(x) - 1e-3 * theta
        first = 0.9 * first + 0.1 * slope
        second = 0.99 * second + 0.01 * slope**2
        theta += 0.1 * (first / (1 - 0.9**k)) / (np.sqrt(second / (1 - 0.99**k)) + 1e-8)
    model = Model(centre, scale, theta[: FEATURES + 1], theta[-4:].reshape(2, 2), 1.0, 0.0, share)
    raw, y = _raw_quality(lines, model)[some], y[some]
    line = np.zeros(2)
    for _ in range(30):  # Newton steps of a logistic regression on one value
        p = 1 / (1 + np.exp(-(line[0] * raw + line[1])))
        z = np.stack([raw, np.ones_like(raw)])
        line += np.linalg.solve((z * p * (1 - p)) @ z.T + 1e-2 * np.eye(2), z @ (y - p) - 1e-2 * line)
    return model._replace(slope=float(line[0]), shift=float(line[1]))


def held_out(id_col: str = "doc_id"):
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % FOLDS == HELD_OUT, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, sample_docs: int = SAMPLE_DOCS, sample_lines: int = SAMPLE_LINES) -> Model:
    """A model from a bounded sample of the labelled documents that aren't held out."""
    marked = (
        labels.where(F.col("quality").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out())
        .groupBy("doc_id")
        .agg(F.min("quality").alias("quality"))
    )
    drawn = marked.orderBy(F.xxhash64("doc_id"), "doc_id").limit(2 * sample_docs)
    short = F.size(F.split(F.coalesce("text", F.lit("")), "\n")) <= sample_lines
    # As few rows as the parameter says: safe to send to every task.
    sample = (
        docs.select("doc_id", "text")
        .join(F.broadcast(drawn), "doc_id")
        .where(short)
        .orderBy(F.xxhash64("doc_id"), "doc_id", "text")
        .limit(sample_docs)
        .select("quality", "text")
    )

    def fitted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts = list(batches)
        texts = [t or "" for part in parts for t in part.column(1).to_pylist()]
        model = fit(texts, [label for part in parts for label in part.column(0).to_pylist()])
        give_back_memory()
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(tuple(model))], pa.binary())], names=["model"])

    # The sample meets in one task; only the weights go to the driver.
    found = sample.coalesce(1).mapInArrow(fitted, "model binary").collect()
    return Model(*pickle.loads(found[0][0])) if found else fit([], [])


def score(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, held_out, score, predicted`` per document."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:2], pa.array(predict(part.column(2), sent.value), pa.float64())],
                    names=["doc_id", "held_out", "score"],
                )

    source = docs.select(F.col("doc_id").cast("long"), held_out().alias("held_out"), "text")
    scored = source.mapInArrow(work, "doc_id long, held_out boolean, score double")
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def keep_good(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """The rows whose score reaches the threshold, as they are."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text"):
                yield part.filter(pc.greater_equal(pa.array(predict(part.column("text"), sent.value)), threshold))

    return docs.mapInArrow(work, docs.schema)
