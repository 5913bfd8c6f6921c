"""Words and word shingles of Arrow text columns as 64-bit hashes, many texts at a time."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

SHINGLE = 5
#: Odd multipliers of a shingle's words, by place.
_PLACES = np.array([xxhash.xxh64_intdigest(bytes([k])) | 1 for k in range(64)], np.uint64)


def mix(h: np.ndarray) -> np.ndarray:
    """Spread every bit of 64-bit values over all bits (the finisher of splitmix64)."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def split_words(texts: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The words ``[^\\x20\\x09-\\x0D]+`` of all texts, A-Z lower-cased, and the n+1 marks of the texts."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(texts.fill_null("")))
    words = lists.flatten()
    marks = np.asarray(lists.offsets).astype(np.int64)
    marks -= marks[0]
    # Blanks at either end of a text leave empty strings.
    full = np.asarray(pc.not_equal(pc.binary_length(words), 0).cast(pa.int8()))
    if len(full) and not full.all():
        before = np.concatenate([[0], np.cumsum(full, dtype=np.int64)])
        return words.filter(pa.array(full.astype(bool))), before[marks]
    return words, marks


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """One hash per word, and the marks of the texts."""
    words, marks = split_words(texts)
    coded = words.dictionary_encode()
    names = coded.dictionary.to_pylist()
    each = np.fromiter((xxhash.xxh64_intdigest(w) for w in names), np.uint64, len(names))
    return (each[np.asarray(coded.indices)] if len(names) else each), marks


def shingle_hashes(words: np.ndarray, marks: np.ndarray, k: int = SHINGLE) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of every run of ``k`` words; a text with fewer has its whole sequence, one without words none."""
    sizes = np.diff(marks)
    counts = np.where(sizes >= k, sizes - k + 1, np.minimum(sizes, 1))
    edges = np.concatenate([[0], np.cumsum(counts)])
    at = np.arange(edges[-1]) + np.repeat(marks[:-1] - edges[:-1], counts)
    left = np.repeat(sizes, counts)
    total = np.repeat(np.minimum(sizes, k).astype(np.uint64), counts)
    for j in range(k):
        here = np.take(words, np.minimum(at + j, max(0, len(words) - 1)), mode="clip") if len(words) else words
        total = total + np.where(left > j, here * _PLACES[j], np.uint64(0))
    return mix(total), edges


def shingle_sets(texts: pa.Array, k: int = SHINGLE) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of every text."""
    hashes, edges = shingle_hashes(*word_hashes(texts), k)
    return [np.unique(hashes[a:b]) for a, b in zip(edges[:-1], edges[1:], strict=True)]


def common(a: np.ndarray, b: np.ndarray) -> int:
    """Size of the intersection of two sorted distinct arrays."""
    if len(a) > len(b):
        a, b = b, a
    if not len(a):
        return 0
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    return int(np.count_nonzero(b[at] == a))
