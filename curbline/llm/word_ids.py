"""Token ids of whole texts, each different word tokenized once per worker.

The tokenizer's pre-tokenizer never joins words over white space, so texts are cut at ASCII
white space and a word's ids are looked up. Words of printable ASCII are cut further, where
the pre-tokenizer cuts, and go to the merge model directly; all others pass through the whole
tokenizer. Memory is bounded for texts of any length: the words known, and one slice of texts.
"""

from __future__ import annotations

import functools
import os
import re
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Words a Python worker remembers; when there are more, it starts anew.
CACHE_WORDS = 1_000_000
#: Texts are looked up in slices of about this many bytes.
WORD_SLICE = 8 << 20
#: Where the pre-tokenizer cuts a lower-cased word of printable ASCII, a fixed pattern.
_CUTS = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^a-z0-9]+")
#: A digit is a token of its own, so it can stand between words that hold none.
_BETWEEN = "7"
_PLAIN = r"^[!-~]*$"


class WordIds:
    """Ids of words, each tokenized once."""

    def __init__(self, tokenizer_path: str, cache_words: int = CACHE_WORDS) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(tokenizer_path)
        self.between = self._whole(_BETWEEN)
        if len(self.between) != 1:
            raise ValueError("the tokenizer must give a digit an id of its own")
        self.cache_words = cache_words
        self._clear()

    def _clear(self) -> None:
        self.known = pa.array([], pa.string())
        # Flat sequences of numbers only: the garbage collector has little to walk through.
        self.parts: dict[str, tuple[int, ...]] = {}
        self.ids = np.zeros(0, np.uint16)
        self.starts = np.zeros(0, np.int64)
        self.sizes = np.zeros(0, np.int64)

    def _whole(self, text: str) -> list[int]:
        return self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids

    def _plain(self, words: list[str]) -> tuple[list[int], list[int]]:
        """Ids of words of printable ASCII behind one another, and how many each word has."""
        parts, model, cuts = self.parts, self.tokenizer.model, _CUTS.findall
        flat: list[int] = []
        ends = []
        for word in words:
            for part in cuts(word.lower()):
                own = parts.get(part)
                if own is None:
                    own = parts[part] = tuple([t.id for t in model.tokenize(part)])
                flat += own
            ends.append(len(flat))
        return flat, np.diff(ends, prepend=0).tolist()

    def _other(self, words: list[str]) -> tuple[list[int], list[int]]:
        """The same of words that hold neither the digit between them nor a special token."""
        flat: list[int] = []
        sizes: list[int] = []
        for k in range(0, len(words), 2000):
            ids = np.array(self._whole(f" {_BETWEEN} ".join(words[k : k + 2000])))
            marks = np.flatnonzero(ids == self.between[0])
            sizes += (np.diff(marks, prepend=-1, append=len(ids)) - 1).tolist()
            flat += ids[ids != self.between[0]].tolist()
        return flat, sizes

    def _learn(self, words: pa.Array) -> pa.Array:
        """Learn new words; they are numbered in the order in which they come back."""
        special = pc.match_substring(words, "<|")
        plain = pc.and_(pc.match_substring_regex(words, _PLAIN), pc.invert(special))
        odd = pc.and_(pc.invert(plain), pc.or_(pc.match_substring(words, _BETWEEN), special))
        rest = pc.invert(pc.or_(plain, odd))
        alone = lambda several: [(ids, [len(ids)]) for ids in map(self._whole, several)]
        kinds = [words.filter(mask) for mask in (plain, rest, odd)]
        texts = [kind.to_pylist() for kind in kinds]
        learnt = [self._plain(texts[0]), self._other(texts[1]) if texts[1] else ([], []), *alone(texts[2])]
        sizes = np.array([n for _, own in learnt for n in own], np.int64)
        self.known = pa.concat_arrays([self.known, *kinds])
        self.starts = np.concatenate([self.starts, len(self.ids) + np.cumsum(sizes) - sizes])
        self.sizes = np.concatenate([self.sizes, sizes])
        self.ids = np.concatenate([self.ids, *[np.array(flat, np.uint16) for flat, _ in learnt]])
        return pa.concat_arrays(kinds)

    def _numbers(self, words: pa.Array) -> np.ndarray:
        """The place of every word among those known; new ones are learnt."""
        found = pc.index_in(words, value_set=self.known)
        if not found.null_count:
            return found.to_numpy()
        new = words.filter(found.is_null()).unique()
        if len(self.known) and len(self.known) + len(new) > self.cache_words:
            self._clear()
            return self._numbers(words)
        base = len(self.known)
        numbers = found.fill_null(-1).to_numpy()
        learnt = self._learn(new)
        missing = numbers < 0
        numbers = np.where(missing, 0, numbers)
        numbers[missing] = base + pc.index_in(words.filter(pa.array(missing)), value_set=learnt).to_numpy()
        return numbers

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All texts' ids behind one another, and the n+1 marks of the texts."""
        texts = texts.fill_null("").cast(pa.string())
        # The tokenizer lower-cases all but its special tokens, which hold "<|".
        texts = pc.if_else(pc.match_substring(texts, "<|"), texts, pc.ascii_lower(texts))
        words = pc.ascii_split_whitespace(texts)
        numbers = self._numbers(words.flatten())
        sizes = self.sizes[numbers]
        ends = np.cumsum(sizes)
        places = np.repeat(self.starts[numbers] - (ends - sizes), sizes)
        places += np.arange(len(places))
        marks = np.concatenate([[0], ends])[np.asarray(words.offsets) - words.offsets[0].as_py()]
        return self.ids[places], marks


@functools.cache
def worker_words(tokenizer_path: str) -> WordIds:
    """One for all tasks of a worker."""
    return WordIds(tokenizer_path)


def with_end(ids: np.ndarray, marks: np.ndarray, end_id: int) -> tuple[np.ndarray, np.ndarray]:
    """Each text's ids with the end id behind them."""
    return np.insert(ids, marks[1:], end_id), marks + np.arange(len(marks))
