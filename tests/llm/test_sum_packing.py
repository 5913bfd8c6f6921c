"""Packing by sums of squares: the rule against its definition, and round trips of whole texts."""

from __future__ import annotations

import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest

from curbline.llm import queries, sum_packing

SF_DIR = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, uid long, length string, group int"


def brute(lengths, size):
    """Each piece where the sum of squares becomes smallest, by trying every choice."""
    filled, out = [], []
    cost = lambda state: sum(c * c for gap, c in Counter(size - f for f in state).items() if gap)
    for n in lengths:
        choices = []
        for gap in {size - f for f in filled if size - f >= n}:
            own = next(k for k in range(len(filled)) if size - filled[k] == gap)
            choices.append((cost([f + n if k == own else f for k, f in enumerate(filled)]), gap))
        choices.append((cost([*filled, n]), size + 1))
        gap = min(choices)[1]
        # Of sequences with that gap, the one that got it last.
        out.append((None if gap > size else gap))
        if gap > size:
            filled.append(n)
        else:
            own = next(k for k in range(len(filled)) if size - filled[k] == gap)
            filled[own] += n
    return out, sorted(filled)


@pytest.mark.parametrize("seed", range(6))
def test_rule_equals_its_definition(seed):
    rng = np.random.default_rng(seed)
    size = [12, 30, 7][seed % 3]
    lengths = rng.integers(1, size + 1, 70)
    sequences, offsets = sum_packing.place(lengths, size)
    filled, gaps = defaultdict(int), []
    for n, s, offset in zip(lengths.tolist(), sequences.tolist(), offsets.tolist(), strict=True):
        assert offset == filled[s]
        gaps.append(size - filled[s] if filled[s] else None)
        filled[s] += n
    assert (gaps, sorted(filled.values())) == brute(lengths.tolist(), size)


@pytest.mark.parametrize("seed", range(3))
def test_groups_are_packed_without_gaps_and_tightly(seed):
    rng = np.random.default_rng(seed)
    lengths = np.minimum(2047, rng.lognormal(6, 1, 3000).astype(int) + 1)
    sequences, offsets = sum_packing.place_group(lengths)
    inside = defaultdict(list)
    for n, s, at in zip(lengths.tolist(), sequences.tolist(), offsets.tolist(), strict=True):
        inside[s].append((at, n))
    for own in inside.values():
        ends = np.cumsum([n for _, n in sorted(own)])
        assert [at for at, _ in sorted(own)] == [0, *ends[:-1]] and ends[-1] <= 2048
    assert sorted(inside) == list(range(len(inside)))
    assert len(inside) <= -(-lengths.sum() // 2048) * 1.002 + 1


def test_round_trip(spark, monkeypatch):
    from tokenizers import Tokenizer

    monkeypatch.setattr(sum_packing, "GROUP_PIECES", 60)
    tokenizer = Tokenizer.from_file(queries.tokenizer_path())
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id", "text").collect()
    long = " ".join(f"w{k % 977}x{k % 31}" for k in range(9000))
    rows = [(r[0], r[1]) for r in docs] + [(-1, None), (-2, ""), (-3, " \n"), (-4, long), (None, "one two"), (-6, "a " * 2047), (-7, "a " * 2048)]
    frame = spark.createDataFrame([(i, t, 7, "clash", 1) for i, t in rows], SCHEMA)
    packed = sum_packing.pack(frame.repartition(3), queries.tokenizer_path()).collect()
    by_doc, inside = defaultdict(list), defaultdict(list)
    for r in packed:
        by_doc[r["doc_id"]].append(r)
        inside[r["sequence_id"]].append((r["offset"], r["length"]))
        assert len(r["ids"]) == r["length"] and r["ids_crc32"] == zlib.crc32(np.array(r["ids"], "<u4").tobytes())
    assert set(by_doc) == {i for i, _ in rows}
    for doc, text in rows:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
        own = sorted(by_doc[doc], key=lambda r: r["piece"])
        assert sum((list(r["ids"]) for r in own), []) == ids
        assert [r["length"] for r in own] == [2048] * (len(ids) // 2048) + [len(ids) % 2048] * (len(ids) % 2048 > 0)
        assert [(r["piece"], r["start"]) for r in own] == [(k, 2048 * k) for k in range(len(own))]
    for own in inside.values():
        ends = np.cumsum([n for _, n in sorted(own)])
        assert [at for at, _ in sorted(own)] == [0, *ends[:-1]] and ends[-1] <= 2048
    assert sum_packing.pack(frame.limit(0), queries.tokenizer_path()).count() == 0


def test_repeated_rows_are_packed_each(spark):
    frame = spark.createDataFrame([(1, "one two", 0, "", 0)] * 3, SCHEMA)
    rows = sum_packing.pack(frame, queries.tokenizer_path()).collect()
    assert sorted(r["offset"] for r in rows) == [0, 3, 6] and len({r["sequence_id"] for r in rows}) == 1


def test_query_packs_every_document_once(spark):
    found = queries.op13_sum_packing(spark, SF_DIR)
    assert found.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    rows = found.collect()
    total = sum(r["length"] for r in rows)
    assert len({r["sequence_id"] for r in rows}) <= -(-total // 2048) * 1.01 + 1
    assert {r["doc_id"] for r in rows} == {r[0] for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("doc_id").collect()}
