"""Allow and block lists for URLs: a trie over reversed host labels and path segments.

A rule names a host and a path prefix. It fits a URL whose host is the rule's or a
subdomain of it and whose path starts with the rule's. Of the rules that fit, the one
with the longest host wins, then the one with the longest path. Hosts of fitting rules
are suffixes of one host and paths prefixes of one path, so lengths decide alone; of two
rules for the same host and path the blocking one wins.

The trie is sent to every task. Its size is checked: beyond ``MAX_TRIE_BYTES`` of rule
text the rules stay a table, and URLs are joined to it on every host suffix they have
(a handful each, so the join is linear in the URLs).

Defined results: a NULL URL, or one without ``://``, has an empty host and path, fits no
rule and gets the default verdict. A rule whose path is empty fits every path. Repeated
rows keep their multiplicity, an empty table gives an empty table, and columns of the
input named like a result column are replaced.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Rule text that is sent to every task at most.
MAX_TRIE_BYTES = 32 << 20

_ADDED = ("host", "path", "rule", "verdict")


class Rule(NamedTuple):
    host: str
    path: str
    verdict: str

    @property
    def text(self) -> str:
        return self.host + self.path


class _Node:
    """A point of the trie: labels of a host, or, below ``paths``, segments of a path.

    ``tails`` holds the rules that end here inside a segment, longest first.
    """

    __slots__ = ("next", "paths", "tails")

    def __init__(self) -> None:
        self.next: dict[str, _Node] = {}
        self.paths: _Node | None = None
        self.tails: list[tuple[str, Rule]] = []


def build_trie(rules: Iterable[Rule]) -> _Node:
    root = _Node()
    for rule in rules:
        node = root
        for label in reversed(rule.host.lower().split(".")):
            node = node.next.setdefault(label, _Node())
        if node.paths is None:
            node.paths = _Node()
        node = node.paths
        *whole, tail = rule.path.split("/")
        for segment in whole:
            node = node.next.setdefault(segment, _Node())
        node.tails.append((tail, rule))
        node.tails.sort(key=lambda x: (-len(x[0]), x[1].verdict != "block"))
    return root


def _longest_path(node: _Node, path: str) -> Rule | None:
    found = None
    segments = path.split("/")
    for k, segment in enumerate(segments):
        # A tail may go on over this segment only, as longer ones descend further.
        for tail, rule in node.tails:
            if segment.startswith(tail):
                found = rule
                break
        node = node.next.get(segment) if k + 1 < len(segments) else None
        if node is None:
            break
    return found


def match(root: _Node, host: str, path: str) -> Rule | None:
    found, node = None, root
    for label in reversed(host.split(".")):
        node = node.next.get(label)
        if node is None:
            break
        if node.paths is not None:
            found = _longest_path(node.paths, path) or found
    return found


_UPPER = {c: c + 32 for c in range(65, 91)}


def split_url(url: str | None) -> tuple[str, str]:
    """Host (A-Z lower-cased) and path of a URL; both empty without ``://``."""
    _, mark, rest = (url or "").partition("://")
    if not mark:
        return "", ""
    end = min((i for i in map(rest.find, "?#") if i >= 0), default=len(rest))
    rest = rest[:end]
    slash = rest.find("/")
    host, path = (rest, "") if slash < 0 else (rest[:slash], rest[slash:])
    return host.translate(_UPPER), path


def judge_urls(
    df: DataFrame,
    rules: Iterable[Rule],
    url: str = "url",
    default: str = "allow",
    max_trie_bytes: int = MAX_TRIE_BYTES,
) -> DataFrame:
    """``df`` with ``host``, ``path``, ``rule`` (its text or NULL) and ``verdict``."""
    rules = list(rules)
    kept = df.drop(*[c for c in df.columns if c in _ADDED])
    if sum(len(r.text) + 64 for r in rules) > max_trie_bytes:
        return _judge_by_join(kept, rules, url, default)
    schema = T.StructType([*kept.schema.fields, *[T.StructField(c, T.StringType()) for c in _ADDED]])
    trie = build_trie(rules)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[], [], [], []]
            for text in batch.column(url).to_pylist():
                host, path = split_url(text)
                rule = match(trie, host, path)
                found = (rule.text, rule.verdict) if rule else (None, default)
                for column, value in zip(out, (host, path, *found), strict=True):
                    column.append(value)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, *[pa.array(c, pa.string()) for c in out]],
                names=[*batch.schema.names, *_ADDED],
            )

    return kept.mapInArrow(judge, schema)


def host_and_path(url: Column) -> tuple[Column, Column]:
    """``split_url`` as columns."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.regexp_extract(F.substr(url, at + 3), r"^[^?#]*", 0)).otherwise("")
    rest = F.coalesce(rest, F.lit(""))
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    host = F.translate(F.regexp_extract(rest, r"^[^/]*", 0), upper, lower)
    return host, F.regexp_extract(rest, r"^[^/]*(.*)$", 1)


def _judge_by_join(df: DataFrame, rules: list[Rule], url: str, default: str) -> DataFrame:
    """The same result with the rules as a table, for lists of any size.

    Distinct (host, path) pairs are joined on the host suffix; then the best rule of each
    pair is joined back.
    """
    spark = df.sparkSession
    listed = spark.createDataFrame(
        [(r.host.lower(), r.path, r.text, r.verdict) for r in rules],
        "rule_host string, rule_path string, rule string, verdict string",
    )
    host, path = host_and_path(F.col(url))
    parsed = df.withColumns({"host": host, "path": path})
    labels = F.split("host", r"\.")
    suffixes = F.transform(
        F.sequence(F.lit(1), F.size(labels)),
        lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."),
    )
    pairs = parsed.select("host", "path").distinct()
    order = F.struct(
        F.length("rule_host"), F.length("rule_path"), (F.col("verdict") == "block").alias("blocks")
    )
    best = (
        pairs.withColumn("rule_host", F.explode(suffixes))
        .join(listed, "rule_host")
        .where(F.expr("startswith(path, rule_path)"))
        .groupBy("host", "path")
        .agg(F.max_by(F.struct("rule", "verdict"), order).alias("best"))
    )
    return (
        parsed.join(best, ["host", "path"], "left")
        .select(
            *[F.col(f"`{c}`") for c in df.columns],
            "host",
            "path",
            F.col("best.rule").alias("rule"),
            F.coalesce("best.verdict", F.lit(default)).alias("verdict"),
        )
    )
