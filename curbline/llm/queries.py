"""Registered queries of the corpus operators, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from curbline.llm import (
    ball_codes,
    decontaminate,
    exact_dedup,
    hard_negatives,
    jaccard_join,
    line_dedup,
    packing,
    paragraph_dedup,
    quality_crf,
    suffix_dedup,
    sum_packing,
    url_filter,
    warc,
)
from curbline.llm.common import table
from curbline.session import scratch_path

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def register(fn):
        QUERIES[fn.__name__] = fn
        if sql is not None:
            ORACLES[fn.__name__] = sql
        return fn

    return register


def all_queries():
    return dict(QUERIES)


def all_oracles():
    return dict(ORACLES)


def tokenizer_path() -> str:
    import public_tokenizers

    return str(public_tokenizers.path("word_bpe_49k.json"))


#: The site list of the url query, fixed values.
SITE_RULES = [
    url_filter.Rule("net", "/", "block"),
    url_filter.Rule("example.net", "/en/", "allow"),
    url_filter.Rule("example.com", "/de/", "block"),
    url_filter.Rule("org", "/fr/", "allow"),
]


@query()
def op1_paragraph_dedup(spark, sf_dir):
    return paragraph_dedup.repeated_passages(table(spark, sf_dir, "documents"))


@query("""
WITH parts AS (
    SELECT page_id, CASE WHEN strpos(url, '://') > 0
        THEN regexp_extract(substr(url, strpos(url, '://') + 3), '^[^?#]*') ELSE '' END AS rest
    FROM pages),
split AS (
    SELECT page_id, translate(regexp_extract(coalesce(rest, ''), '^[^/]*'),
            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
        regexp_replace(coalesce(rest, ''), '^[^/]*', '') AS path
    FROM parts),
ruled AS (
    SELECT *, CASE
        WHEN '.' || host LIKE '%.example.net' AND path LIKE '/en/%' THEN 'example.net/en/'
        WHEN '.' || host LIKE '%.example.com' AND path LIKE '/de/%' THEN 'example.com/de/'
        WHEN '.' || host LIKE '%.net' AND path LIKE '/%' THEN 'net/'
        WHEN '.' || host LIKE '%.org' AND path LIKE '/fr/%' THEN 'org/fr/' END AS rule
    FROM split)
SELECT page_id, host, path, rule,
    CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' ELSE 'allow' END AS verdict
FROM ruled""")
def op2_url_filter(spark, sf_dir):
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return url_filter.judge_urls(pages, SITE_RULES).drop("url")


@query("""
WITH texts AS (
    SELECT doc_id, coalesce(text, '') AS body,
        regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]', '', 'g') AS bare FROM documents),
ranked AS (
    SELECT doc_id, bare, first_value(doc_id) OVER w AS keep_id,
        count(*) OVER (PARTITION BY bare) AS group_size
    FROM texts WINDOW w AS (PARTITION BY bare ORDER BY length(body) DESC, doc_id
        ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING))
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(bare) AS text_sha256
FROM ranked""")
def op3_exact_dedup(spark, sf_dir):
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents"))


@query("""
WITH lines AS (
    SELECT doc_id, i, trim(line, ' ' || chr(9) || chr(11) || chr(12) || chr(13)) AS line, line AS whole
    FROM (SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
        generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS i FROM documents)),
seen AS (SELECT *, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS p FROM lines WHERE line <> ''),
runs AS (
    SELECT doc_id, p, [line, lead(line, 1) OVER w, lead(line, 2) OVER w] AS run FROM seen
    WINDOW w AS (PARTITION BY doc_id ORDER BY p) QUALIFY lead(line, 2) OVER w IS NOT NULL),
later AS (
    SELECT doc_id, p FROM runs QUALIFY row_number() OVER (PARTITION BY run ORDER BY doc_id, p) > 1),
gone AS (SELECT DISTINCT doc_id, p + k AS p FROM later, (VALUES (0), (1), (2)) AS v(k)),
kept AS (
    SELECT l.doc_id, string_agg(l.whole, chr(10) ORDER BY l.i) FILTER (g.p IS NULL) AS text,
        count(s.p) AS n_lines, count(g.p) AS n_removed
    FROM lines l LEFT JOIN seen s ON s.doc_id = l.doc_id AND s.i = l.i
        LEFT JOIN gone g ON g.doc_id = s.doc_id AND g.p = s.p
    GROUP BY l.doc_id)
SELECT doc_id, n_lines, n_removed, sha256(coalesce(text, '')) AS text_sha256 FROM kept""")
def op4_line_dedup(spark, sf_dir):
    kept = line_dedup.remove_repeated_runs(table(spark, sf_dir, "documents").select("doc_id", "text"))
    digest = F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256)
    return kept.select("doc_id", "n_lines", "n_removed", digest.alias("text_sha256"))


@query()
def op5_quality_crf(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    model = quality_crf.train(docs, table(spark, sf_dir, "labels"))
    return quality_crf.score(docs, model)


@query()
def op6_decontaminate(spark, sf_dir):
    return decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query()
def op7_jaccard_join(spark, sf_dir):
    return jaccard_join.jaccard_classes(table(spark, sf_dir, "documents"))


@query()
def op8_warc(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    arcs, warcs = scratch_path(spark, "arc"), scratch_path(spark, "warc")
    for version in warc.ARC_FIELDS:
        half = F.pmod(F.coalesce("page_id", F.lit(0)), F.lit(2)) == version - 1
        warc.write_arc(pages.where(half), f"{arcs}/v{version}", version)
    warc.convert(spark, arcs, warcs)
    found = warc.with_referred_page(warc.read_warcs(spark, warcs))
    return found.select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "record_id", "uri", "intact"
    )


@query()
def op9_packing(spark, sf_dir):
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer_path()).drop("ids")


@query()
def op10_suffix_dedup(spark, sf_dir):
    return suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"))


def _assigned(vectors: str, entries: str) -> str:
    """SQL for the nearest entry of every part: (vec_id, p, x, e, d)."""
    return f"""(SELECT vec_id, p, any_value(x) AS x, min(d * 64 + e) % 64 AS e, min(d * 64 + e) // 64 AS d
        FROM (SELECT v.vec_id, v.p, v.x, c.e, (v.x[1] - c.c[1]) ** 2 + (v.x[2] - c.c[2]) ** 2
            + (v.x[3] - c.c[3]) ** 2 + (v.x[4] - c.c[4]) ** 2 AS w, CAST(w AS BIGINT) AS d
            FROM {vectors} v JOIN {entries} c ON c.p = v.p) GROUP BY vec_id, p)"""


def _renewed(entries: str, assigned: str) -> str:
    """SQL for the entries moved to the means of their parts."""
    means = ", ".join(f"CAST(floor(sum(x[{i}])::DECIMAL(38, 0) / count(*)) AS BIGINT)" for i in range(1, 5))
    return f"""(SELECT c.p, c.e, coalesce(m.c, c.c) AS c FROM {entries} c
        LEFT JOIN (SELECT p, e, [{means}] AS c FROM {assigned} GROUP BY p, e) m ON m.p = c.p AND m.e = c.e)"""


@query(f"""
WITH kept AS (
    SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(256 * x::DOUBLE) AS BIGINT)) AS v
    FROM embeddings
    WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
parts AS (SELECT vec_id, p, v[4 * p + 1 : 4 * p + 4] AS x FROM kept, range(16) AS r(p)),
first AS (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS e FROM kept ORDER BY vec_id LIMIT 64),
c0 AS (SELECT p, e, x AS c FROM parts JOIN first USING (vec_id)),
a0 AS {_assigned("parts", "c0")}, c1 AS {_renewed("c0", "a0")},
a1 AS {_assigned("parts", "c1")}, c2 AS {_renewed("c1", "a1")},
a2 AS {_assigned("parts", "c2")},
coded AS (SELECT vec_id, string_agg(printf('%02x', e), '' ORDER BY p) AS code, CAST(sum(d) AS BIGINT) AS error
    FROM a2 GROUP BY vec_id),
labelled AS (SELECT label, CAST(sum(error) AS BIGINT) AS label_error FROM coded JOIN kept USING (vec_id) GROUP BY label),
digest AS (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM c2)
SELECT vec_id, code, error, label_error, codebooks_sha256
FROM coded JOIN kept USING (vec_id) JOIN labelled l ON l.label IS NOT DISTINCT FROM kept.label, digest""")
def op11_ball_codes(spark, sf_dir):
    found = ball_codes.compress(table(spark, sf_dir, "embeddings"))
    return found.rows.select(
        "vec_id",
        F.lower(F.hex("code")).alias("code"),
        "error",
        "label_error",
        F.lit(found.codebooks.sha256()).alias("codebooks_sha256"),
    )


@query("""
WITH kept AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
        list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
    FROM embeddings
    WHERE label IS NOT NULL AND len(embedding) > 0
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
    SELECT a.vec_id AS anchor_id, o.vec_id AS other_id, o.label = a.label AS same,
        CAST(list_dot_product(a.v, o.v) AS BIGINT) AS score
    FROM kept a JOIN kept o ON o.vec_id <> a.vec_id WHERE a.vec_id % 50 = 0),
positives AS (
    SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM scored WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5)
SELECT p.anchor_id, p.positive_id, CAST(row_number() OVER w AS INTEGER) AS rank, s.other_id AS negative_id,
    p.positive_score, s.score AS negative_score
FROM positives p JOIN scored s ON s.anchor_id = p.anchor_id AND NOT s.same
    AND 100 * s.score BETWEEN 50 * p.positive_score AND 95 * p.positive_score
WINDOW w AS (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.other_id)
QUALIFY row_number() OVER w <= 3""")
def op12_hard_negatives(spark, sf_dir):
    changed = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding", changed.alias("label"))
    return hard_negatives.mine(rows, F.col("vec_id") % 50 == 0)


@query()
def op13_sum_packing(spark, sf_dir):
    return sum_packing.pack(table(spark, sf_dir, "documents"), tokenizer_path()).drop("ids")
