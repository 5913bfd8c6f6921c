"""Repeated runs of lines: winnowed line hashes, extended to whole runs, later ones deleted.

A document is the sequence of its lines, trimmed of ASCII white space; blank lines are no
part of it and always stay. Every ``gram`` neighbouring lines are hashed, and of the hashes
in each window the least is selected (the last of equal ones). A run of ``run_lines`` lines
spans a whole window, so two equal runs have selected the same fingerprint at the same place.

1. Only the selected minima are written, once, each with its position and the runs in whose window it is
   the least: most lines' hashes are never shuffled.
2. A fingerprint that has one position in the corpus is dropped; the positions of the others are joined.
3. From each position left the match is extended to both sides, to the lines of its runs before and
   behind. Of the runs that agree in all, the earliest (smallest id, then first line) stays; all lines of
   later ones go. Longer repeats are overlapping runs, so they go from end to end. Runs are judged on
   the input, not on what is left.

With ``run_words``, fewer lines are a run too if they have that many words in all: every stretch of fewer than
``run_lines`` lines that reaches it is a fingerprint of its own, compared by two independent hashes.

Everything is DataFrame expressions. Searches are aggregates with map-side combining, joined on keys
that occur once on one side, so a line that a third of the corpus has can be split; texts are shuffled
once, to meet their own lines' fate.

Defined results: a NULL text stays NULL; an empty one stays empty; a document of fewer than
``run_lines`` lines is unchanged unless ``run_words`` is given. A NULL id comes before all ids. Rows equal in id and text
are one document: each gets that document's result. Further columns are kept as they are, but for
those with the names of the counts, which a caller can choose; columns that start with ``_ld_`` are reserved.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from curbline.llm.common import scratch
from curbline.session import remove_path

RUN_LINES = 3
GRAM = 2
#: Words of a passage, for callers whose documents have whole paragraphs in a line.
PASSAGE_WORDS = 50


#: ASCII white space but for the end of a line.
_BLANKS = " \t\x0b\f\r"


def _trimmed(line: Column) -> Column:
    return F.trim(line, F.lit(_BLANKS))


def _sequence(text: Column) -> Column:
    """The lines that aren't blank, trimmed."""
    return F.filter(F.transform(F.split(text, "\n", -1), _trimmed), lambda line: line != "")


def _range(start: int, stop: Column) -> Column:
    """start, ..., stop - 1; empty if there is none."""
    return F.when(stop > start, F.sequence(F.lit(start), stop - 1)).otherwise(F.array().cast("array<int>"))


def _whole(column: str, p: Column, n: int) -> Column:
    """One hash of ``n`` neighbouring elements."""
    return F.xxhash64(*[F.col(column)[p + k] for k in range(n)])


def _fingerprint(f: Column, pos: Column, runs: Column) -> Column:
    """A selected hash, its position, and the runs (first line, number of lines, hash) that it stands for."""
    return F.struct(f.alias("f"), pos.alias("pos"), runs.alias("runs"))


def _short_runs(n: int, run_words: int) -> Column:
    """The stretches of ``n`` lines that have ``run_words`` words, each with a hash of its own."""
    enough = lambda p: sum((F.col("w")[p + k] for k in range(n)), F.lit(0)) >= run_words
    run = lambda p: F.struct(p.alias("start"), F.lit(n).alias("lines"), _whole("m", p, n).alias("run"))
    alone = lambda p: _fingerprint(_whole("h", p, n), p, F.array(run(p)))
    return F.transform(F.filter(_range(0, F.size("h") - n + 1), enough), alone)


def _minima(docs: DataFrame, run_lines: int, gram: int, run_words: int | None) -> DataFrame:
    """(``_ld_id``, ``_ld_text``, ``f``, ``pos``, ``runs``): the selected fingerprints of each document."""
    width = run_lines - gram + 1
    hashes = {"h": F.transform("s", lambda line: F.xxhash64(line))}
    if run_words is not None:
        hashes["m"] = F.transform("s", lambda line: F.hash(line))
        hashes["w"] = F.transform("s", lambda line: F.size(F.split(line, f"[{_BLANKS}]+")))
    hashed = docs.select("_ld_id", "_ld_text", *[c.alias(name) for name, c in hashes.items()])
    # Documents without a run have nothing to compare.
    least = run_lines if run_words is None else 1
    grams = hashed.where(F.size("h") >= least).withColumn(
        "g", F.transform(_range(0, F.size("h") - gram + 1), lambda p: _whole("h", p, gram))
    )
    # The place of the least hash of each window; ties go to the last.
    pick = lambda p: F.array_min(
        F.array(*[F.struct(F.col("g")[p + k].alias("f"), (-(p + k)).alias("at")) for k in range(width)])
    )["at"]
    picked = grams.withColumn("picks", F.transform(_range(0, F.size("g") - width + 1), lambda p: -pick(p)))

    def selected(pos: Column) -> Column:
        around = F.sequence(F.greatest(pos - (width - 1), F.lit(0)), F.least(pos, F.size("picks") - 1))
        own = F.filter(around, lambda p: F.col("picks")[p] == pos)
        run = lambda p: F.struct(p.alias("start"), F.lit(run_lines).alias("lines"), _whole("h", p, run_lines).alias("run"))
        return _fingerprint(F.col("g")[pos], pos, F.transform(own, run))

    found = F.transform(F.array_distinct("picks"), selected)
    if run_words is not None:
        found = F.concat(found, *[_short_runs(n, run_words) for n in range(1, run_lines)])
    return picked.select("_ld_id", "_ld_text", F.inline(found))


def _place(at: str) -> Column:
    return F.struct(F.col("_ld_id").isNotNull(), F.col("_ld_id"), F.col("_ld_text"), F.col(at))


def _later_runs(docs: DataFrame, run_lines: int, gram: int, run_words: int | None) -> DataFrame:
    """(``_ld_id``, ``_ld_text``, ``start``, ``lines``) of every run that an earlier one equals."""
    spark = docs.sparkSession
    minima, path = scratch(_minima(docs, run_lines, gram, run_words), "minima")
    places = minima.groupBy("f").agg(F.min(_place("pos")).alias("first"), F.max(_place("pos")).alias("last"))
    repeated = places.where(F.col("first") != F.col("last")).select("f")
    # A fingerprint's place in its run is part of what must agree.
    extended = minima.join(repeated, "f").select("_ld_id", "_ld_text", "f", "pos", F.inline("runs"))
    key = F.struct("f", (F.col("pos") - F.col("start")).alias("k"), "lines", "run")
    runs, _ = scratch(extended.select("_ld_id", "_ld_text", "start", "lines", key.alias("key")), "runs")
    remove_path(spark, path)
    first = (
        runs.groupBy("key")
        .agg(F.min(_place("start")).alias("first"), F.max(_place("start")).alias("last"))
        .where(F.col("first") != F.col("last"))
        .select("key", "first")
    )
    return runs.join(first, "key").where(_place("start") > F.col("first")).select("_ld_id", "_ld_text", "start", "lines")


def remove_repeated_runs(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    run_lines: int = RUN_LINES,
    gram: int = GRAM,
    run_words: int | None = None,
    counts: tuple[str, str] = ("n_lines", "n_removed"),
) -> DataFrame:
    """``df`` without later repeated runs of lines, and with two counts of lines: all, and those removed.

    A run has ``run_lines`` lines or, if ``run_words`` is given, fewer lines of that many words in all. ``counts``
    names the two new columns; columns of ``df`` with these names are replaced.
    """
    if not 1 <= gram <= run_lines:
        raise ValueError("gram must be between 1 and run_lines")
    text = F.coalesce(F.col(text_col), F.lit(""))
    own = [F.col(id_col).cast("long").alias("_ld_id"), F.xxhash64(text).alias("_ld_text")]
    later = _later_runs(df.select(*own, _sequence(text).alias("s")), run_lines, gram, run_words)
    removed = later.groupBy("_ld_id", "_ld_text").agg(F.collect_set(F.struct("start", "lines")).alias("starts"))
    hit = removed.select(
        F.col("_ld_id").alias("_ld_id2"),
        F.col("_ld_text").alias("_ld_text2"),
        F.array_distinct(
            F.flatten(F.transform("starts", lambda s: F.sequence(s["start"], s["start"] + s["lines"] - 1)))
        ).alias("_ld_gone"),
    )
    kept = [c for c in df.columns if c not in counts]
    met = df.select(*[F.col(f"`{c}`") for c in kept], *own).join(
        hit, F.col("_ld_id").eqNullSafe(F.col("_ld_id2")) & (F.col("_ld_text") == F.col("_ld_text2")), "left"
    )
    # Numbers of the lines that aren't blank. Nothing but the line itself is looked at for each: a filter on the
    # counts is pushed below the split, and must not repeat it line by line.
    marked = F.transform(F.split(text, "\n", -1), lambda line, i: F.struct(i.alias("i"), (_trimmed(line) != "").alias("full")))
    lines = met.withColumns(
        {
            "_ld_lines": F.split(text, "\n", -1),
            "_ld_at": F.transform(F.filter(marked, lambda x: x["full"]), lambda x: x["i"]),
        }
    )
    every = F.sequence(F.lit(0), F.size("_ld_lines") - 1)
    gone = F.transform("_ld_gone", lambda p: F.col("_ld_at")[p])
    left = F.array_join(F.transform(F.array_except(every, gone), lambda i: F.col("_ld_lines")[i]), "\n")
    rest = F.when(F.col("_ld_gone").isNull(), F.col(f"`{text_col}`")).otherwise(left)
    total, lost = counts
    return lines.select(
        *[rest.alias(c) if c == text_col else F.col(f"`{c}`") for c in kept],
        F.when(F.col(f"`{text_col}`").isNull(), 0).otherwise(F.size("_ld_at")).cast("long").alias(total),
        F.when(F.col("_ld_gone").isNull(), 0).otherwise(F.size("_ld_gone")).cast("long").alias(lost),
    )
