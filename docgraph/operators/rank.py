"""Ordering, top-k and bounded listings with total orders."""

from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def topk(df: DataFrame, part: list[str], order: list[Column], k: int, name: str = "rank") -> DataFrame:
    """The first ``k`` rows per group; ``order`` must end in a unique column.

    Spark pushes ``row_number <= k`` below the shuffle, so a task sends k rows per group at most.
    """
    number = F.row_number().over(Window.partitionBy(*part).orderBy(*order))
    # The cast comes after the filter: only the bare row number is pushed down.
    return df.withColumn(name, number).filter(F.col(name) <= k).withColumn(
        name, F.col(name).cast("long"))


def recent(df: DataFrame, ingested: str, as_of: date, days: int, order: list[Column], k: int) -> DataFrame:
    """The ``k`` best rows ingested in the ``days`` days up to ``as_of``."""
    until = F.lit(as_of).cast("date")
    window = (F.col(ingested) > F.date_sub(until, days)) & (F.col(ingested) <= until)
    return df.filter(window).orderBy(*order).limit(k)


def frequent(df: DataFrame, column: str, n: int) -> DataFrame:
    """The ``n`` most frequent values, ties by value."""
    counts = df.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("n"))
    return counts.orderBy(F.desc("n"), column).limit(n)


def frequent_approx(df: DataFrame, column: str, n: int, tracked: int = 100_000) -> DataFrame:
    """The same for key spaces too large to count: a sketch of ``tracked`` keys, with estimates.

    A key appears only if its count stands out of the sketch's error.
    """
    top = df.agg(F.expr(f"approx_top_k({column}, {n}, {tracked})").alias("_top"))
    return top.select(F.inline("_top")).withColumnsRenamed({"item": column, "count": "n"})


def tracked(df: DataFrame, keys: list[str], column: str, size: int = 10_000) -> DataFrame:
    """A mergeable sketch of the frequent values per key, such as a day; store it once."""
    return df.groupBy(*keys).agg(F.expr(f"approx_top_k_accumulate(`{column}`, {size})").alias("sketch"))


def combined(sketches: DataFrame, keys: list[str], column: str, n: int, size: int = 10_000) -> DataFrame:
    """The ``n`` most frequent values per coarser key with estimated counts, from stored sketches.

    Estimates are exact while a key has at most three quarters of ``size`` distinct values.
    """
    top = sketches.groupBy(*keys).agg(F.expr(
        f"approx_top_k_estimate(approx_top_k_combine(sketch, {size}), {n})").alias("_top"))
    return top.select(*keys, F.inline("_top")).withColumnsRenamed({"item": column, "count": "n"})


def bounded(df: DataFrame, part: list[str], order: list[Column], n: int) -> DataFrame:
    """The first ``n`` rows per group and how many more there are."""
    totals = df.groupBy(*part).agg(F.count(F.lit(1)).alias("total"))
    listed = topk(df, part, order, n)
    return listed.join(totals, part).withColumn("more", F.greatest(F.col("total") - n, F.lit(0)))
