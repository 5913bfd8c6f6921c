"""Every corpus operator against SQL or a brute-force version, and its edge cases."""

from __future__ import annotations

import base64
import hashlib
import io
import re
import zlib
from itertools import combinations

import numpy as np
import pyarrow as pa
import pytest
from compare import connect, difference
from pyspark.sql import functions as F

import corpus_pipeline
from curbline.llm import (
    decontaminate,
    exact_dedup,
    jaccard_join,
    line_dedup,
    packing,
    paragraph_dedup,
    quality_crf,
    queries,
    suffix_dedup,
    url_filter,
    warc,
)
from curbline.llm.components import connected_components
from curbline.llm.word_ids import WordIds

SF_DIR = "/root/testdata/sf0.001"
EXTRA = "doc_id long, text string, host string, keep_id long"


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_oracle(spark, name):
    assert difference(queries.QUERIES[name](spark, SF_DIR), connect(SF_DIR), queries.ORACLES[name]) is None


@pytest.fixture(scope="module")
def texts():
    return dict(connect(SF_DIR).execute("SELECT doc_id, text FROM documents").fetchall())


# A NULL text, empty and blank ones, copies, a tie, a long one, and columns with names of results.
LONG = " ".join(f"w{k % 977}x{k % 31}" for k in range(4000))
EDGE = [
    (1, None, "a", 1), (2, "", "a", None), (3, " \n\t ", None, 2), (4, "one two", "a", 1), (5, "one  two", "b", 1),
    (6, LONG, "a", 1), (7, LONG, "a", 1), (8, "ONE two", "a", 1), (None, "one two", "a", 1), (9, LONG + " end", "c", 3),
]


@pytest.fixture
def edge(spark):
    return spark.createDataFrame(EDGE, EXTRA)


@pytest.fixture
def nothing(spark):
    return spark.createDataFrame([], EXTRA)


# ---------------------------------------------------------------- op1


def test_passages_shared_by_documents_are_found(spark):
    rng = np.random.default_rng(5)
    words = lambda n: " ".join(f"v{w}" for w in rng.integers(0, 5000, n))
    passages = [words(55) for _ in range(40)]
    rows = []
    for k, passage in enumerate(passages):
        rows += [(10 * k, f"{words(80)} {passage} {words(60)}"), (10 * k + 1, f"{words(33)} {passage}\n{words(90)}"), (10 * k + 2, words(150))]
    found = paragraph_dedup.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    hit = {r["doc_id"] for r in found}
    assert not {d for d in hit if d % 10 in (0, 2)}
    assert len(hit) >= 38
    assert all(r["kept_doc_id"] == r["doc_id"] - 1 for r in found)


def test_similar_lines_cluster(spark):
    line = " ".join(f"a{k}" for k in range(23))
    rows = [(1, line), (2, line.replace("a11", "zz")), (3, line.replace("a22", "zz")), (4, line[:60])]
    found = paragraph_dedup.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    # One changed word at the end leaves 18 of 20 shingles, one in the middle 14 of 24.
    assert {(r["doc_id"], r["kept_doc_id"]) for r in found} == {(3, 1)}


def brute_passages(rows, percent=75):
    """Components of all colliding pairs that are similar, by node."""
    import pyarrow as pa

    from curbline.llm.words import shingle_hashes, word_hashes

    nodes = {}
    for _, text in rows:
        words, marks = word_hashes(pa.array([text]))
        hashes, _ = shingle_hashes(words, marks)
        keys = {(k // 2, tuple(int((hashes * s).min()) for s in paragraph_dedup._SEEDS[k : k + 2])) for k in range(0, 8, 2)}
        nodes[text] = (set(hashes.tolist()), keys)
    root = {t: t for t in nodes}
    for a, b in combinations(nodes, 2):
        both = len(nodes[a][0] & nodes[b][0])
        if nodes[a][1] & nodes[b][1] and 100 * both >= percent * len(nodes[a][0] | nodes[b][0]):
            root = {t: root[a] if r == root[b] else r for t, r in root.items()}
    return root


@pytest.mark.parametrize("block", [3, 256])
def test_every_colliding_pair_is_compared(spark, block, monkeypatch):
    monkeypatch.setattr(paragraph_dedup, "BLOCK_NODES", block, raising=False)
    # Boilerplate at the start, own words behind it: bands are full of dissimilar lines.
    start = " ".join(f"s{k}" for k in range(12))
    rows = []
    for k in range(60):
        own = [f"x{k}y{j}" for j in range(12)]
        rows += [(3 * k, f"{start} {' '.join(own)}"), (3 * k + 1, f"{start} {' '.join([*own[:-1], 'end'])}"), (3 * k + 2, f"{start} {' '.join([*own[:-2], 'other', 'end'])}")]
    found = paragraph_dedup.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    clusters: dict = {}
    root = brute_passages(rows)
    for doc, text in rows:
        clusters.setdefault(root[text], []).append(doc)
    want = {(d, min(c)) for c in clusters.values() for d in c if d != min(c)}
    assert len(want) > 60
    assert {(r["doc_id"], r["kept_doc_id"]) for r in found} == want


def test_shingles_of_many_paragraphs_at_once(spark, monkeypatch):
    """As the set of each paragraph by itself, whatever is sorted together; a place past the text is cut."""
    from curbline.llm.words import shingle_hashes, word_hashes

    texts = [" ".join(f"w{(k * k + d) % 13}" for k in range(40 * d)) for d in range(5)]
    words, marks = word_hashes(pa.array(texts))
    places = [(d, first, size) for d in range(1, 5) for first, size in ((0, 40 * d), (3, 9), (5, 2), (1, 30))] + [(4, 150, 40)]
    alone = []
    for d, first, size in places:
        own = words[marks[d] + first : marks[d] + first + size]
        alone.append(np.unique(shingle_hashes(own, np.array([0, len(own)]))[0].view(np.int64)).tolist())
    start = np.array([marks[d] + first for d, first, _ in places])
    size = np.minimum(start + [p[2] for p in places], len(words)) - start
    flat, ends = paragraph_dedup._distinct_shingles(words, start, size)
    assert [flat[a:b].tolist() for a, b in zip(ends[:-1], ends[1:], strict=True)] == alone
    listed = [(texts[d], [(f, n, k) for k, (e, f, n) in enumerate(places) if e == d]) for d in range(5)]
    met = spark.createDataFrame(listed, "text string, listed array<struct<first int, words int, node long>>").coalesce(1)
    for together in (1, 50, 1 << 16):
        monkeypatch.setattr(paragraph_dedup, "SET_WORDS", together)
        found = {r["node"]: r["shingles"] for r in paragraph_dedup._shingles(met).collect()}
        assert [found[k] for k in range(len(places))] == alone


def test_edited_lines_of_any_length_are_removed_whole(spark):
    rng = np.random.default_rng(8)
    words = lambda n: [f"v{w}" for w in rng.integers(0, 50_000, n)]
    shingles = lambda ws: {tuple(ws[k : k + 5]) for k in range(len(ws) - 4)}
    rows, sizes = [], {}
    for size, edits in ((25, 0), (30, 1), (40, 1), (60, 1), (80, 2), (100, 2), (150, 4), (200, 5)):
        for _ in range(60):
            line, doc = words(size), 2 * len(sizes)
            copy = list(line)
            for k in range(edits):
                copy[(2 * k + 1) * size // (2 * edits)] = "edited"
            if size == 30:
                copy = [*line[:-2], "edited", "end"]
            assert 4 * len(shingles(line) & shingles(copy)) >= 3 * len(shingles(line) | shingles(copy))
            rows += [(doc, "\n".join(" ".join(x) for x in (words(30), line, words(40)))), (doc + 1, "\n".join(" ".join(x) for x in (words(50), copy)))]
            sizes[doc + 1] = size
    found = {r["doc_id"]: r for r in paragraph_dedup.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert set(found) <= set(sizes)
    for size in set(sizes.values()):
        whole = [found[d]["first_word"] == 50 and found[d]["n_words"] == size for d, n in sizes.items() if n == size and d in found]
        assert sum(whole) >= 0.9 * 60, (size, sum(whole))


def test_a_line_does_not_repeat_its_own_piece(spark):
    rng = np.random.default_rng(9)
    rows = [(k, " ".join(f"v{w}" for w in rng.integers(0, 5000, n))) for k, n in enumerate(rng.integers(25, 32, 600).tolist())]
    assert paragraph_dedup.repeated_passages(spark.createDataFrame(rows, "doc_id long, text string")).count() == 0


# ---------------------------------------------------------------- op2


def test_url_rules(spark):
    rules = [*queries.SITE_RULES, url_filter.Rule("a.net", "", "allow"), url_filter.Rule("x.org", "/de", "block"), url_filter.Rule("x.org", "/de/ok", "allow")]
    urls = [
        "http://b.net/q", "http://b.net", "http://a.net", "https://www.EXAMPLE.net/en/1?x#y", "http://badexample.com/de/1",
        "http://x.org/design", "http://x.org/de/okay", "http://x.org/e", "ftp://u@h:1/p?://", "no url", "", None, "http://b.net/q",
    ]
    df = spark.createDataFrame([(k, u, "old") for k, u in enumerate(urls)], "page_id long, url string, rule string")
    by_trie = sorted(map(tuple, url_filter.judge_urls(df, rules).collect()))
    assert [r[4] for r in by_trie[:8]] == ["net/", None, "a.net", "example.net/en/", None, "x.org/de", "x.org/de/ok", None]
    assert by_trie[8][2:4] == ("u@h:1", "/p") and by_trie[11][2:] == ("", "", None, "allow")
    by_join = sorted(map(tuple, url_filter.judge_urls(df, rules, max_trie_bytes=0).select(url_filter.judge_urls(df, rules).columns).collect()))
    assert by_trie == by_join
    assert url_filter.judge_urls(df.limit(0), rules).count() == 0


# ---------------------------------------------------------------- op3


def test_exact_groups_of_edge_cases(spark, edge, nothing):
    rows = {r["doc_id"]: r for r in exact_dedup.exact_groups(edge).collect()}
    assert {rows[d]["keep_id"] for d in (1, 2, 3)} == {3} and rows[1]["group_size"] == 3
    assert rows[4]["keep_id"] == rows[None]["keep_id"] == 5 and rows[5]["kept"]
    assert rows[7]["keep_id"] == 6 and not rows[7]["kept"]
    assert exact_dedup.exact_groups(nothing).count() == 0


def test_spilling_changes_nothing():
    records = [(hashlib.sha256(t).digest(), t, len(t), k, 1, (k,)) for k, t in enumerate(f"{n % 300}".encode() * 20 for n in range(1000))]
    plain = {g.content: (g.best_id, g.count, sorted(g.members)) for g in exact_dedup.grace(iter(records))}
    spilled = {g.content: (g.best_id, g.count, sorted(g.members)) for g in exact_dedup.grace(iter(records), budget=2000)}
    assert plain == spilled and len(plain) == 300


# ---------------------------------------------------------------- op4


def test_line_runs(spark, nothing):
    rows = [
        (1, "a\nb\nc\nd", "s"), (2, "x\na\nb\n\nc \ny", "s"), (3, "a\nb", "s"), (4, None, "s"), (5, "", None), (6, "q\nq\nq\nq\nq", "s"),
        (7, "z\na\nb\nc\nd\nz", "s"), (None, "d\ne\nf", "s"), (8, "d\ne\nf", "s"), (8, "d\ne\nf", "s"),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string, n_lines string")
    out = line_dedup.remove_repeated_runs(df)
    got = sorted([(r["doc_id"], r["text"]) for r in out.collect() if r["doc_id"]], key=str)
    assert got == [(1, "a\nb\nc\nd"), (2, "x\n\ny"), (3, "a\nb"), (4, None), (5, ""), (6, "q"), (7, "z\nz"), (8, ""), (8, "")]
    assert line_dedup.remove_repeated_runs(nothing).count() == 0


def test_long_passages_of_few_lines(spark):
    words = lambda name, n: " ".join(f"{name}{k}" for k in range(n))
    one, two, short, tail = words("a", 52), words("b", 30), words("c", 49), words("d", 20)
    rows = [
        (1, f"x\n{one}\ny"), (2, f"z\n{one} \nq"), (3, one), (4, f"{two}\n{tail}\nr"), (5, f"s\n{two}\n\n{tail}"),
        (6, f"{short}\nt"), (7, f"u\n{short}"), (8, f"{two}\nv\n{tail}"), (9, f"{tail}\n{two}"), (10, f"{one}\n{one}"),
    ]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    want = {**dict(rows), 2: "z\nq", 3: "", 5: "s\n", 10: ""}
    out = line_dedup.remove_repeated_runs(df, run_words=50)
    assert {r["doc_id"]: r["text"] for r in out.collect()} == want
    docs = df.withColumn("n_chars", F.length("text").cast("long"))
    kept = {r["doc_id"]: r["text"] for r in corpus_pipeline.without_repeated_lines(spark, docs, SF_DIR).collect()}
    assert kept == {d: t for d, t in want.items() if t}


# ---------------------------------------------------------------- op5


def test_quality_on_held_out_rows(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    scored = quality_crf.score(docs, quality_crf.train(docs, labels)).where("held_out").join(labels, "doc_id")
    rows = scored.select("predicted", "quality").collect()
    assert len(rows) > 50
    assert sum(r["predicted"] == r["quality"] for r in rows) >= 0.95 * len(rows)


def test_quality_of_edge_cases(spark, edge, nothing):
    labels = spark.createDataFrame([(6, 1, 0), (4, 0, None), (4, 1, 0), (None, 1, 0), (7, 5, 0)], "doc_id long, quality int, toxic int")
    for model in (quality_crf.train(edge, labels), quality_crf.train(nothing, labels)):
        rows = quality_crf.score(edge, model).collect()
        assert len(rows) == len(EDGE) and all(0 <= r["score"] <= 1 for r in rows)
        assert quality_crf.keep_good(edge, model, 0.0).count() == len(EDGE)
        assert quality_crf.score(nothing, model).count() == 0


# ---------------------------------------------------------------- op6


def brute_leaks(docs, items, share=0.6):
    found = set()
    for (d, text), (i, item) in ((a, b) for a in docs for b in items):
        words, own = (text or "").lower().split(), item.lower().split()
        for k in range(0, max(1, len(words) - len(own) + 1)):
            row = [0] * (len(own) + 1)
            for w in words[k : k + len(own)]:
                last = row[:]
                for j, o in enumerate(own):
                    row[j + 1] = last[j] + 1 if w == o else max(row[j], last[j + 1])
            if row[-1] >= share * len(own):
                found.add((d, i))
                break
    return found


def test_leaks_against_brute_force(spark):
    con = connect(SF_DIR)
    docs = [(d, t) for d, t in con.execute("SELECT doc_id, text FROM documents WHERE length(text) < 1500").fetchall()][:60]
    items = con.execute("SELECT item_id, text FROM benchmark").fetchall()[:20]
    words = items[3][1].split()
    docs += [(901, f"some words {items[0][1]} and more"), (902, " ".join(docs[0][1].split()[:30] + words[:5] + ["other"] + words[6:])), (903, None), (904, "")]
    frame = spark.createDataFrame(docs, "doc_id long, text string")
    bench = spark.createDataFrame([*items, (None, None), (77, "too short")], "item_id long, text string")
    found = {(r["doc_id"], r["item_id"]) for r in decontaminate.contaminated(frame, bench).collect()}
    want = brute_leaks(docs, items)
    assert {(901, items[0][0]), (902, items[3][0])} <= found
    assert len(want & found) >= 0.9 * len(want)
    left = {r["doc_id"] for r in decontaminate.drop_contaminated(frame, bench).collect()}
    assert left == {d for d, _ in docs} - {d for d, _ in found}


def test_only_texts_with_enough_of_an_items_words_are_aligned(spark, monkeypatch):
    """One word many times over is no more of an item than the item has of it; what is found stays."""
    words = [f"w{k}" for k in range(40)]
    # Half of the item's words, one of them often, and the item itself.
    texts = [" ".join(words[:20] + [words[0]] * 5), "before " + " ".join(words) + " after"]
    others = [" ".join(f"x{k * d % 97}" for k in range(50)) for d in range(30)]
    docs = spark.createDataFrame(list(enumerate(texts + others)), "doc_id long, text string")
    bench = spark.createDataFrame([(7, " ".join(words))], "item_id long, text string")
    indexes = decontaminate.build_indexes(docs, next(decontaminate.read_items(bench)))
    aligned, lcs = [], decontaminate.lcs
    monkeypatch.setattr(decontaminate, "lcs", lambda a, b: aligned.append(len(b)) or lcs(a, b))
    assert decontaminate.search(pa.array(texts[:1]), indexes) == [] and aligned == []
    assert [(m.doc, m.item_id, m.lcs_share) for m in decontaminate.search(pa.array(texts), indexes)] == [(1, 7, 1.0)]


@pytest.mark.parametrize("n_items,n_words", [(224, 640), (1, 20000)])
def test_long_items_are_found(spark, n_items, n_words):
    rng = np.random.default_rng(7)
    words = lambda n: " ".join(f"w{w}" for w in rng.integers(0, 3000, n))
    items = [(k, words(n_words)) for k in range(n_items)]
    docs = [(k, f"{words(90)} {text} {words(70)}") for k, text in items[:40]] + [(1000 + k, words(800)) for k in range(20)]
    frame = spark.createDataFrame(docs, "doc_id long, text string").repartition(8)
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = [(r["doc_id"], r["item_id"]) for r in decontaminate.contaminated(frame, bench).collect()]
    assert sorted(found) == [(k, k) for k, _ in items[:40]]


def test_blocks_are_bounded_by_pieces(spark):
    sizes = [20, 9000, 6000, 64, 65, 20000, 30]
    bench = spark.createDataFrame([(k, "w " * n) for k, n in enumerate(sizes)], "item_id long, text string")
    blocks = [[i.item_id for i in b] for b in decontaminate.read_items(bench)]
    assert blocks == [[0, 1], [2, 3, 4], [5], [6]]


def test_lcs():
    a, b = np.array([1, 2, 3, 4, 5], np.uint64), np.array([9, 1, 3, 2, 4, 4, 5], np.uint64)
    assert decontaminate.lcs(a, b) == 4 and decontaminate.lcs(a, b[:0]) == 0


# ---------------------------------------------------------------- op7


def sets_of(texts):
    out = {}
    for d, text in texts.items():
        words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        out[d] = {tuple(words[k : k + 5]) for k in range(len(words) - 4)} if len(words) >= 5 else {tuple(words)} - {()}
    return out


def brute_classes(texts):
    sets = sets_of(texts)
    root = {d: d for d in sets}
    changed = True
    pairs = [(a, b) for a, b in combinations(sorted(sets), 2) if sets[a] and 100 * len(sets[a] & sets[b]) >= 75 * len(sets[a] | sets[b])]
    while changed:
        changed = False
        for a, b in pairs:
            low = min(root[a], root[b])
            changed |= root[a] != low or root[b] != low
            root[a] = root[b] = low
    return {d: (len(sets[d]), root[d]) for d in sets}


@pytest.mark.parametrize("region_sets", [4, 1024])
def test_classes_against_brute_force(spark, texts, region_sets):
    base = texts[0].split()[:60]
    more = {5000 + k: " ".join(base[:k] + [f"n{k}"] + base[k + 1 :]) for k in range(0, 40, 3)}
    rows = {**texts, **more, 6000: None, 6001: "", 6002: "a b", 6003: "A  b"}
    df = spark.createDataFrame(list(rows.items()), "doc_id long, text string")
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard_join.jaccard_classes(df, region_sets=region_sets).collect()}
    assert got == brute_classes(rows)


def test_region_join_is_exact():
    rng = np.random.default_rng(3)
    for _ in range(60):
        core = rng.integers(0, 60, 40)
        sets = [np.unique(np.where(rng.random(40) < rng.uniform(0, 0.3), rng.integers(0, 200, 40), core)).astype(np.uint64) for _ in range(12)]
        want = {(i, j) for i, j in combinations(range(12), 2) if jaccard_join.linked(sets[i], sets[j])[0]}
        root = list(range(12))
        for links in (jaccard_join.join_region(sets),):
            assert {tuple(sorted(x)) for x in links} <= want
            for i, j in links:
                root = [min(root[i], root[j]) if r in (root[i], root[j]) else r for r in root]
        assert all(root[i] == root[j] for i, j in want)


def test_components(spark):
    links = [(k, k + 1) for k in range(30)] + [(100, 99), (99, 98), (7, 7)]
    found = connected_components(spark.createDataFrame(links, "a long, b long"))
    assert {r["node"]: r["component"] for r in found.collect()} == {**{k: 0 for k in range(31)}, 98: 98, 99: 98, 100: 98}


def test_rows_without_an_id_have_no_class(spark):
    text = " ".join(f"w{k}" for k in range(30))
    df = spark.createDataFrame([(2, text), (None, text), (3, text), (None, "")], "doc_id long, text string")
    rows = sorted(((r["doc_id"], r["n_shingles"], r["component_id"]) for r in jaccard_join.jaccard_classes(df).collect()), key=str)
    assert rows == [(2, 26, 2), (3, 26, 2), (None, 0, None), (None, 26, None)]


# ---------------------------------------------------------------- op8


def test_warc_round_trip(spark, tmp_path):
    pages = [(1, "http://a/ b", "<p>x</p>"), (2, None, None), (3, "http://c", ""), (9, "http://d", "<p>x</p>"), (None, "http://e", "é\n\r\n\r\n"), (4, "http://f", "WARC/1.1\r\n\r\n")]
    df = spark.createDataFrame([(*p, 5) for p in pages], "page_id long, url string, html string, digest long")
    for version in (1, 2):
        warc.write_arc(df, f"{tmp_path}/arc{version}", version, records_per_file=2)
        warc.convert(spark, f"{tmp_path}/arc{version}", f"{tmp_path}/warc{version}")
        rows = warc.with_referred_page(warc.read_warcs(spark, f"{tmp_path}/warc{version}")).collect()
        got = {r["page_id"]: (r["record_type"], r["refers_to"], r["payload_bytes"], r["payload_digest"]) for r in rows}
        sha1 = lambda t: base64.b32encode(hashlib.sha1(t.encode()).digest()).decode()
        assert got[1] == ("revisit", 9, 8, sha1("<p>x</p>")) and got[9][0] == "response"
        assert got[2][:3] == ("revisit", 3, 0) and got[3][0] == "response"
        assert got[None][2:] == (7, sha1("é\n\r\n\r\n")) and all(r["intact"] for r in rows) and len(rows) == 6
        assert {r["uri"] for r in rows} == {"http://a/%20b", None, "http://c", "http://d", "http://e", "http://f"}


def test_arc_header_lines():
    body = b"2 0 x\n" + warc.ARC_FIELDS[2].encode() + b"\n"
    data = f"filedesc://f 0.0.0.0 20000101 text/plain 200 - - 0 f {len(body)}\n".encode() + body
    data += b"\nhttp://u 1.2.3.4 19991231 text/html; charset=x 200 - - 7 f 3\nabc\n"
    (record,) = warc.read_arc(io.BytesIO(data))
    assert record.block == b"abc" and record.fields["Content-type"] == "text/html; charset=x"
    assert warc.iso_date(record.fields["Archive-date"]) == "1999-12-31T00:00:00Z"
    with pytest.raises(ValueError):
        list(warc.read_arc(io.BytesIO(data[:-3])))


def test_archives_of_all_pages_equal_brute_force(spark):
    rows = connect(SF_DIR).execute("SELECT page_id, html FROM pages").fetchall()
    payloads = {page: (html or "").encode() for page, html in rows}
    best: dict = {}
    for page, payload in payloads.items():
        best[payload] = max(page, best.get(payload, page))
    want = set()
    for page, payload in payloads.items():
        digest = base64.b32encode(hashlib.sha1(payload).digest()).decode()
        first = best[payload] == page
        want.add((page, len(payload), digest, "response" if first else "revisit", None if first else best[payload]))
    found = queries.op8_warc(spark, SF_DIR).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()
    assert len(found) == len(rows) and {tuple(r) for r in found} == want


def test_sizes_of_foreign_revisits_and_cut_records():
    head = b"WARC/1.1\r\nWARC-Record-ID: <urn:uuid:1>\r\nContent-Length: "
    ((fields, block),) = warc.read_warc(io.BytesIO(head + b"5\r\n\r\nabcde\r\n\r\n"))
    assert block == b"abcde" and fields["warc-record-id"] == "<urn:uuid:1>"
    with pytest.raises(ValueError, match="declares 9 bytes, 5 are left"):
        list(warc.read_warc(io.BytesIO(head + b"9\r\n\r\nabcde")))


# ---------------------------------------------------------------- op9


def test_packing_round_trip(spark, edge, nothing):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(queries.tokenizer_path())
    odd = [(20, "It's <|startoftext|> <|ENDOFTEXT|> İstanbul ΟΔΟΣ <|endoftext|>!!a'sb", "x", 1)]
    rows = packing.pack(edge.union(spark.createDataFrame(odd, EXTRA)), queries.tokenizer_path()).collect()
    by_doc: dict = {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append(r)
    assert len({r["sequence_id"] for r in rows}) == len(rows) and {r["offset"] for r in rows} == {0}
    for doc, text, *_ in EDGE + odd:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]
        pieces = sorted(by_doc[doc], key=lambda r: r["start"])
        assert sum((list(r["ids"]) for r in pieces), []) == ids
        assert all(r["length"] & (r["length"] - 1) == 0 and r["length"] <= 4096 and r["doc_tokens"] == len(ids) for r in pieces)
        assert all(r["ids_crc32"] == zlib.crc32(np.array(r["ids"], "<u4").tobytes()) for r in pieces)
    assert packing.pack(nothing, queries.tokenizer_path()).count() == 0


def test_digests_are_those_of_the_packed_ids(spark):
    packed = packing.pack(spark.read.parquet(f"{SF_DIR}/documents.parquet"), queries.tokenizer_path()).collect()
    place = lambda r: (r["doc_id"], r["start"], r["length"], r["doc_tokens"])
    ids = {place(r): r["ids"] for r in packed}
    rows = queries.op9_packing(spark, SF_DIR).collect()
    assert len(rows) == len(ids) and "ids" not in rows[0].asDict()
    assert all(r["ids_crc32"] == zlib.crc32(np.array(ids[place(r)], "<u4").tobytes()) for r in rows)


def test_word_ids_are_the_tokenizers():
    from tokenizers import Tokenizer

    tokenizer, words = Tokenizer.from_file(queries.tokenizer_path()), WordIds(queries.tokenizer_path(), cache_words=500)
    rng = np.random.default_rng(3)
    parts = [*"aBcdeZ09 7'.,<|>\n\t\x0b\x1c\x7f\x00\u00e9\u00c9\u00df\u0130\u0131\u212a\u6f22\u00bd\u0663\u00a0\u2028\u0085\ufb01\u03a3\u03c2", "'s", "'LL", "<|startoftext|>", " 7 ", "the"]
    for _ in range(4):
        texts = ["".join(rng.choice(parts, rng.integers(0, 16))) for _ in range(1500)] + [None]
        ids, marks = words.encode(pa.array(texts))
        for k, text in enumerate(texts):
            assert ids[marks[k] : marks[k + 1]].tolist() == tokenizer.encode(text or "", add_special_tokens=False).ids


# ---------------------------------------------------------------- op10


def brute_repeats(texts):
    seen, out = set(), {}
    for d in sorted(texts):
        data = (texts[d] or "").encode()
        gone = np.zeros(len(data) + 1, bool)
        for k in range(len(data) - 99):
            if data[k : k + 100] in seen:
                gone[k : k + 100] = True
            seen.add(data[k : k + 100])
        kept = bytes(b for b, g in zip(data, gone) if not g)
        out[d] = (len(data), int(gone.sum()), int((gone[1:] < gone[:-1]).sum()), hashlib.sha256(kept).hexdigest())
    return out


@pytest.mark.parametrize("core_rows", [2, 4096])
def test_repeats_against_brute_force(spark, texts, core_rows, monkeypatch):
    monkeypatch.setattr(suffix_dedup, "CORE_ROWS", core_rows)
    text = texts[0]
    rows = {**texts, 7000: None, 7001: "", 7002: "x" * 99, 7003: "x" * 350, 7004: "y" + "x" * 100, 7005: text[50:151], 7006: "é" * 60 + text[:99] + "é" * 60}
    df = spark.createDataFrame(list(rows.items()), "doc_id long, text string")
    got = {r[0]: tuple(r[1:]) for r in suffix_dedup.remove_repeats(df).collect()}
    assert got == brute_repeats(rows)


def test_deep_shallow_groups():
    rng = np.random.default_rng(2)
    strings = np.zeros((400, 100), np.uint8)
    strings[:, rng.integers(0, 100, 12)] = rng.integers(0, 2, (400, 12))
    want: dict = {}
    for k, row in enumerate(strings):
        want.setdefault(row.tobytes(), []).append(k)
    got = [sorted(g) for g in suffix_dedup.deep_shallow(strings.ravel(), 100 * np.arange(400))]
    assert sorted(got) == sorted(g for g in want.values() if len(g) > 1)
    firsts = [strings[g[0]].tobytes() for g in got]
    assert firsts == sorted(firsts)


# ---------------------------------------------------------------- all


@pytest.mark.parametrize(
    "operator",
    [
        lambda df: paragraph_dedup.repeated_passages(df),
        lambda df: jaccard_join.jaccard_classes(df),
        lambda df: suffix_dedup.remove_repeats(df),
        lambda df: line_dedup.remove_repeated_runs(df),
    ],
)
def test_edge_cases_run(edge, nothing, operator):
    operator(edge).collect()
    assert operator(nothing).count() == 0


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    columns, before = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = spark.createDataFrame(stage(spark, docs, SF_DIR).collect(), docs.schema)
        assert docs.columns == columns
        assert docs.count() <= before
        before = docs.count()
    rows = corpus_pipeline.run(spark, SF_DIR)
    assert rows.select("doc_id").distinct().count() == before
    left = {r["doc_id"]: r["text"] for r in docs.collect()}
    assert all(d == c for d, (_, c) in brute_classes(left).items())
    assert rows.agg(F.max("length")).first()[0] <= 4096


def test_pipeline_keeps_the_ids_of_sequences(spark):
    name, stage = corpus_pipeline.STAGES[-1]
    rows = stage(spark, spark.read.parquet(f"{SF_DIR}/documents.parquet"), SF_DIR).collect()
    assert name == "packing" and rows
    assert all(len(r["ids"]) == r["length"] and zlib.crc32(np.array(r["ids"], "<u4").tobytes()) == r["ids_crc32"] for r in rows)


def test_only_a_bounded_sample_is_sent_whole_in_a_join():
    import pathlib

    hints = [p.name for p in pathlib.Path(queries.__file__).parent.glob("*.py") for _ in re.findall(r"F\.broadcast\(", p.read_text())]
    assert hints == ["quality_crf.py"]  # of ids that SAMPLE_DOCS bounds
