"""Connected components of a graph given as links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docgraph.plans import storage


def _stars(links: DataFrame, large: bool) -> DataFrame:
    """One step: the neighbours of every node are linked to its least neighbour or itself."""
    both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select(
        F.col("a").alias("u"), F.least("a", "m").alias("m"))
    seen = both.filter("b > a") if large else both.filter("b < a")
    out = seen.join(least, seen["a"] == least["u"]).select("m", "b")
    if not large:
        out = out.unionByName(least.filter("m < u").select("m", F.col("u").alias("b")))
    return out.filter("m <> b").select(F.least("m", "b").alias("a"),
                                       F.greatest("m", "b").alias("b")).distinct()


def connected(links: DataFrame) -> DataFrame:
    """node and component (its least node) of every node of ``links`` (columns a, b).

    Large and small stars alternate until nothing changes, which takes a number of rounds that
    grows with the logarithm of the nodes. Every round is written to the shared folder.
    """
    links = storage.stored(links.filter("a <> b").select(
        F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "links")
    before = None
    while True:
        links = storage.stored(_stars(_stars(links, True), False), "stars")
        now = tuple(links.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
        if now == before:
            break
        before = now
    roots = links.select(F.col("a").alias("node"), F.col("a").alias("component")).distinct()
    return links.select(F.col("b").alias("node"), F.col("a").alias("component")).unionByName(roots)
