"""Report tables."""

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docgraph.operators import rank


def global_index(tables: dict[str, tuple[DataFrame, dict[str, Column]]]) -> DataFrame:
    """Corpus totals as (metric, value): each table is scanned once for all its figures."""
    parts = []
    for df, metrics in tables.values():
        wide = df.agg(*[c.cast("double").alias(n) for n, c in metrics.items()])
        parts.append(wide.unpivot([], list(metrics), "metric", "value"))
    return reduce(DataFrame.unionByName, parts)


def band(score: Column) -> Column:
    return F.when(score >= 4, "strong").when(score == 3, "medium").otherwise("weak")


def monthly(df: DataFrame, date: str, score: str) -> DataFrame:
    """Documents per month and band, with the change against the calendar month before.

    Every month from a band's first to the last of all bands has a row, so that a band that falls
    to zero shows it. Undated documents are not reported.
    """
    counts = df.filter(F.col(date).isNotNull()).groupBy(
        F.trunc(date, "month").alias("month"), band(F.col(score)).alias("band")).agg(
        F.count(F.lit(1)).alias("n"))
    end = counts.agg(F.max("month")).scalar()
    months = counts.groupBy("band").agg(F.min("month").alias("_from")).select("band", F.explode(
        F.sequence("_from", end, F.expr("interval 1 month"))).alias("month"))
    by_band = Window.partitionBy("band").orderBy("month")  # one row per month
    filled = months.join(counts, ["band", "month"], "left").fillna(0, ["n"])
    return filled.withColumn("previous", F.coalesce(F.lag("n").over(by_band), F.lit(0))).withColumn(
        "change", F.col("n") - F.col("previous")).select("month", "band", "n", "previous", "change")


def cards(df: DataFrame, date: str, score: str, hit: str, key: str, k: int = 4) -> DataFrame:
    """Decision cards: per month at most ``k`` important documents with a business hit."""
    top = df.filter((F.col(score) >= 4) & F.col(hit)).withColumn("month", F.trunc(date, "month"))
    return rank.topk(top, ["month"], [F.desc(score), F.col(date), F.col(key)], k)


def listing(df: DataFrame, date: str, score: str) -> DataFrame:
    """The month's documents in three bands."""
    return df.withColumn("month", F.trunc(date, "month")).withColumn("band", band(F.col(score)))
