"""The document graph: reverse index, degrees, chains, subgraphs.

Edges have the columns ``src``, ``dst`` and ``rel``.
"""

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docgraph.functions import fixed
from docgraph.operators import rank
from docgraph.plans import paging, storage


def renamed(rel: Column, names: dict[str, str] | None = None) -> Column:
    """Name of a relation as its target lists it."""
    pairs = F.create_map(*[F.lit(x) for p in (names or fixed.REVERSE_NAMES).items() for x in p])
    return F.try_element_at(pairs, rel)


def reverse(edges: DataFrame) -> DataFrame:
    """Both views of every edge: outbound at its source, inbound and renamed at its target."""
    out = edges.select(F.col("src").alias("node"), F.lit("out").alias("direction"),
                       F.col("rel").alias("section"), F.col("dst").alias("other"))
    back = edges.select(F.col("dst").alias("node"), F.lit("in").alias("direction"),
                        renamed(F.col("rel")).alias("section"), F.col("src").alias("other"))
    return out.unionByName(back).filter("node is not null")


def pages(views: DataFrame, size: int = 1000) -> DataFrame:
    """Sorted listings per node and section, in pages of about ``size`` entries."""
    return paging.paged(views, ["node", "direction", "section"], "other", F.col("other"), size)


def degree(edges: DataFrame, rels: list[str]) -> DataFrame:
    """In and out degree per node, in all and by relation."""
    view = (edges.select(F.col("src").alias("node"), "rel", F.lit(1).alias("out"), F.lit(0).alias("in"))
            .unionByName(edges.select(F.col("dst").alias("node"), "rel", F.lit(0).alias("out"),
                                      F.lit(1).alias("in")))).filter("node is not null")
    by_rel = []
    for r in rels:
        is_r = F.col("rel") == r
        by_rel += [F.sum(F.when(is_r, F.col("out")).otherwise(0)).alias(f"out_{r}"),
                   F.sum(F.when(is_r, F.col("in")).otherwise(0)).alias(f"in_{r}")]
    return view.groupBy("node").agg(F.sum("out").alias("out_degree"),
                                    F.sum("in").alias("in_degree"), *by_rel)


def mirror(views: DataFrame) -> DataFrame:
    """Entries of one direction without their mirror image; none for a sound index.

    Both directions are signed and summed by edge in one aggregation.
    """
    back = {v: k for k, v in fixed.REVERSE_NAMES.items()}
    inbound = F.col("direction") == "in"
    edge = views.select(
        F.when(inbound, F.col("other")).otherwise(F.col("node")).alias("src"),
        F.when(inbound, F.col("node")).otherwise(F.col("other")).alias("dst"),
        F.when(inbound, renamed(F.col("section"), back)).otherwise(F.col("section")).alias("rel"),
        F.when(inbound, 1).otherwise(-1).alias("_sign"))
    sums = edge.groupBy("src", "dst", "rel").agg(F.sum("_sign").alias("surplus"))
    return sums.filter("surplus <> 0")


#: Relations along which a document develops out of an earlier one.
EVOLUTION = ("iterates", "supersedes")


def _steps(edges: DataFrame, rels: tuple[str, ...] | None) -> DataFrame:
    own = edges.filter("src is not null and dst is not null and src <> dst")
    return (own.filter(F.col("rel").isin(*rels)) if rels else own).select("src", "dst").distinct()


def heads(edges: DataFrame, rels: tuple[str, ...] | None = EVOLUTION) -> DataFrame:
    """Nodes that begin a chain: they lead to another one, and none leads to them."""
    steps = _steps(edges, rels)
    return steps.select("src").distinct().join(steps.select(F.col("dst").alias("src")), "src", "left_anti")


def chain(edges: DataFrame, starts: DataFrame, rels: tuple[str, ...] | None = EVOLUTION,
          max_depth: int | None = None) -> DataFrame:
    """What each start node (``src``) reaches, with the least number of steps.

    Only the given nodes are expanded, so from the head of a chain of n nodes there are n - 1 rows
    and no closure of the whole graph. Round i joins all that was reached with the jumps of 2**i
    steps, which are the jumps of the round before joined with themselves: a chain of n steps takes
    log2(n) rounds. A node is not listed as reached from itself; ``lineage`` names cycles.
    """
    jump = storage.cut(_steps(edges, rels))
    reached = starts.select("src").distinct().select("src", F.col("src").alias("dst"), F.lit(0).cast("long").alias("depth"))
    width = 1
    while True:
        hop = jump.select(F.col("src").alias("dst"), F.col("dst").alias("_next"))
        further = reached.join(hop, "dst").select("src", F.col("_next").alias("dst"), (F.col("depth") + width).alias("depth"))
        if max_depth is not None:
            further = further.filter(F.col("depth") <= max_depth)
        known = reached.withColumn("_new", F.lit(0)).unionByName(further.withColumn("_new", F.lit(1)))
        merged = storage.cut(known.groupBy("src", "dst").agg(F.min("depth").alias("depth"), F.min("_new").alias("_new")))
        reached = merged.drop("_new")
        if merged.filter("_new = 1").isEmpty():
            return reached.filter("depth > 0")
        width *= 2
        jump = storage.cut(jump.join(hop, "dst").select("src", F.col("_next").alias("dst")).distinct())


def lineage(edges: DataFrame, rels: tuple[str, ...] | None = EVOLUTION) -> DataFrame:
    """Where each document's chain begins: its oldest ancestor and the number of steps.

    Follows one predecessor per document (the least) by pointer doubling: a chain of n steps
    takes log2(n) joins, and there is one row per document. ``cyclic`` marks documents on or before
    a cycle; they have no root.
    """
    active = storage.cut(_steps(edges, rels).groupBy(F.col("src").alias("node")).agg(
        F.min("dst").alias("root"), F.lit(1).cast("long").alias("depth")))
    nodes, reach, done = active.count(), 1, []
    while True:
        hop = active.select(F.col("node").alias("root"), F.col("root").alias("_next"),
                            F.col("depth").alias("_more"))
        if done:  # pointers that are complete already lead on as well
            hop = hop.unionByName(reduce(DataFrame.unionByName, done).select(
                F.col("node").alias("root"), F.col("root").alias("_next"), F.col("depth").alias("_more")))
        step = storage.cut(active.join(hop, "root", "left"))
        done.append(step.filter("_next is null").select("node", "root", "depth"))
        active = step.filter("_next is not null").select(
            "node", F.col("_next").alias("root"), (F.col("depth") + F.col("_more")).alias("depth"))
        if active.isEmpty():
            break
        reach *= 2
        if reach >= 2 * nodes:  # a chain would have ended, and been found complete, by now
            lost = active.select("node", F.lit(None).cast(active.schema["root"].dataType).alias("root"),
                                 F.lit(None).cast("long").alias("depth"))
            done.append(lost)
            break
    return reduce(DataFrame.unionByName, done).withColumn("cyclic", F.col("root").isNull())


def isolated(nodes: DataFrame, key: str, edges: DataFrame) -> DataFrame:
    """Nodes with no edge in either direction."""
    ends = edges.select(F.col("src").alias(key)).union(edges.select("dst"))
    return nodes.join(ends, key, "left_anti")


def most_cited(edges: DataFrame, k: int) -> DataFrame:
    """The ``k`` nodes cited most, per relation."""
    counts = edges.filter("dst is not null").groupBy("rel", F.col("dst").alias("node")).agg(
        F.count(F.lit(1)).alias("citations"))
    return rank.topk(counts, ["rel"], [F.desc("citations"), F.col("node")], k)


def subgraph(edges: DataFrame, members: DataFrame, theme: str, key: str) -> DataFrame:
    """Per theme the edges with at least one end in it; an edge inside counts once."""
    by_src = edges.join(members.select(theme, F.col(key).alias("src")), "src")
    by_dst = edges.join(members.select(theme, F.col(key).alias("dst")), "dst")
    return by_src.select(theme, "src", "dst", "rel").union(
        by_dst.select(theme, "src", "dst", "rel")).distinct()
