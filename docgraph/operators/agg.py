"""Distributions, cross tables, coverage ratios."""

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F



def distribution(df: DataFrame, column: str) -> DataFrame:
    """Count and percent of total per class; the total is a count that reads no column."""
    counts = df.groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    total = df.agg(F.count(F.lit(1))).scalar()
    return counts.withColumn("pct", F.round(100.0 * F.col("n") / total, 1))


def buckets(df: DataFrame, column: str, edges: list[tuple[str, float]], rest: str) -> DataFrame:
    """Histogram over named buckets with lower edges, highest first; all buckets are listed."""
    value = F.col("_v")
    name = reduce(lambda acc, e: acc.when(value >= e[1], e[0]), edges[1:],
                  F.when(value >= edges[0][1], edges[0][0])).otherwise(rest)
    # Null compares as unknown, so it would fall into the last bucket; it is a class of its own.
    marked = df.select(F.col(column).alias("_v")).select(
        F.when(F.col("_v").isNotNull(), name).alias("bucket"))
    return zero_filled(marked, "bucket", [e[0] for e in edges] + [rest])


#: Stands for a missing value where the value names a row or a key.
NONE = "(none)"


def named(column: str) -> Column:
    """A value that can be the key of a map."""
    return F.coalesce(F.col(column).cast("string"), F.lit(NONE))


def zero_filled(df: DataFrame, column: str, values: list[str]) -> DataFrame:
    """Counts for every allowed value, zero where it does not occur.

    Values that are not allowed, and missing ones as ``(none)``, follow where they occur.
    """
    counts = df.groupBy(named(column).alias(column)).agg(F.count(F.lit(1)).alias("_n"))
    cells = [F.coalesce(F.sum(F.when(F.col(column) == v, F.col("_n"))), F.lit(0)).alias(v)
             for v in values]
    listed = counts.agg(*cells).unpivot([], values, column, "n")
    return listed.unionByName(counts.filter(~F.col(column).isin(values)).select(column, F.col("_n").alias("n")))


def crosstab(df: DataFrame, row: str, column: str, values: list[str]) -> DataFrame:
    """Counts of row class by given column values, with the row total."""
    cells = [F.count_if(F.col(column) == v).alias(v) for v in values]
    return df.groupBy(row).agg(*cells, F.count(F.lit(1)).alias("total"))


def scenarios(df: DataFrame, column: str, drops: dict[str, list[str]]) -> DataFrame:
    """What remains if sets of classes are dropped; all scenarios in one pass."""
    sums = [F.count_if(~F.col(column).isin(values)).alias(name) for name, values in drops.items()]
    wide = df.agg(F.count(F.lit(1)).alias("total"), *sums)
    return wide.unpivot("total", list(drops), "scenario", "remaining").withColumn(
        "pct", F.round(100.0 * F.col("remaining") / F.col("total"), 1))


def region_rollup(df: DataFrame, level: str, name: str) -> DataFrame:
    """Counts by level and name, by level, and overall."""
    return df.rollup(level, name).agg(F.count(F.lit(1)).alias("n"),
                                      F.grouping_id().cast("int").alias("depth"))


def nested_counts(df: DataFrame, level: str, name: str) -> DataFrame:
    """The same as one map per level; a missing name is ``(none)``."""
    cells = df.groupBy(level, named(name).alias(name)).agg(F.count(F.lit(1)).alias("n"))
    return cells.groupBy(level).agg(F.map_from_entries(
        F.sort_array(F.collect_list(F.struct(name, "n")))).alias("names"))


def edge_types(edges: DataFrame, rel: str, types: list[str]) -> DataFrame:
    """Edges per relation type, zero rows for absent types."""
    return zero_filled(edges, rel, types)


def density(edges: DataFrame, nodes: DataFrame) -> DataFrame:
    """Edges per thousand possible directed edges."""
    n = nodes.agg(F.count(F.lit(1))).scalar()
    sums = edges.agg(F.count(F.lit(1)).alias("edges")).withColumn("nodes", n)
    possible = F.col("nodes") * (F.col("nodes") - 1)
    return sums.withColumn(
        "per_mille", F.round(F.try_divide(F.col("edges") * 1000.0, possible), 6))


def entity_usage(tags: DataFrame, dim: DataFrame, entity: str, key: str) -> DataFrame:
    """Documents per registry entity, zero for unused ones."""
    used = tags.groupBy(entity).agg(F.count_distinct(key).alias("documents"))
    return dim.select(entity).distinct().join(used, entity, "left").fillna(0, ["documents"])


def coverage(df: DataFrame, checks: dict[str, Column]) -> DataFrame:
    """Share of rows that satisfy each check, in one pass."""
    names = list(checks)
    wide = df.agg(F.count(F.lit(1)).alias("total"),
                  *[F.count_if(c).alias(n) for n, c in checks.items()])
    return wide.unpivot("total", names, "metric", "covered").withColumn(
        "ratio", F.round(F.try_divide(F.col("covered"), F.col("total")), 6))


def sketched(df: DataFrame, keys: list[str], source: str, size: int = 12) -> DataFrame:
    """A mergeable sketch of the distinct sources per key, such as group and day; store it once.

    ``size`` is the base-2 logarithm of the sketch's buckets: 12 gives a standard error of 1.6 %.
    """
    return df.groupBy(*keys).agg(F.hll_sketch_agg(source, size).alias("sketch"))


def united(sketches: DataFrame, keys: list[str]) -> DataFrame:
    """Distinct sources per coarser key, from stored sketches alone."""
    return sketches.groupBy(*keys).agg(
        F.hll_sketch_estimate(F.hll_union_agg("sketch")).alias("sources"))


def sources(df: DataFrame, group: str, source: str, approx: bool = False) -> DataFrame:
    """Distinct sources per group, exact or as an estimate."""
    count = F.approx_count_distinct(source) if approx else F.count_distinct(source)
    return df.groupBy(group).agg(count.alias("sources"))


