"""Connected components of a table of links, by alternating large and small stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from curbline.llm.common import scratch
from curbline.session import remove_path


def _stars(links: DataFrame, large: bool) -> DataFrame:
    """Each node's larger (or smaller) neighbours are tied to its least neighbour instead.

    The least neighbour is an aggregate with map-side combining and is once per node in
    the join, so Spark can split the links of a node that has very many.
    """
    both = links.select(F.col("a").alias("u"), F.col("b").alias("v"))
    if large:
        both = both.union(links.select(F.col("b").alias("u"), F.col("a").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    tied = both.join(least, "u")
    if large:
        pairs = tied.where(F.col("v") > F.col("u")).select(F.col("v").alias("a"), F.col("m").alias("b"))
    else:
        pairs = tied.select(F.col("v").alias("a"), F.col("m").alias("b")).union(
            least.select(F.col("u").alias("a"), F.col("m").alias("b"))
        )
    return pairs.where(F.col("a") != F.col("b")).distinct()


def connected_components(links: DataFrame) -> DataFrame:
    """(node, component) for every node of ``links`` (a, b); the component is its least node.

    Every round is written to the shared folder. The rounds end when one changes nothing;
    their number grows with the logarithm of the longest path.
    """
    tidy = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    now, path = scratch(tidy.where(F.col("a") != F.col("b")).distinct(), "links")
    check = [F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))]
    seen = now.agg(*check).first()
    while True:
        stars, stars_path = scratch(_stars(_stars(now, large=True), large=False), "links")
        remove_path(links.sparkSession, path)
        now, path, before = stars, stars_path, seen
        seen = now.agg(*check).first()
        if seen == before:
            break
    members = now.select(F.col("a").alias("node"), F.col("b").alias("component"))
    heads = now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    return members.union(heads)
