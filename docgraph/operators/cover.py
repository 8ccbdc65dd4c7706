"""Regional coverage, gaps and diffusion."""

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F



def matrix(docs: DataFrame, region: str, score: str, issuer: str, date: str, high: int = 4) -> DataFrame:
    """Documents, high scores, main issuer, first and last date per region.

    Two steps, region and issuer first; ties of the main issuer go to the least name.
    """
    cells = docs.groupBy(region, issuer).agg(
        F.count(F.lit(1)).alias("_n"), F.count_if(F.col(score) >= high).alias("_high"),
        F.min(date).alias("_first"), F.max(date).alias("_last"))
    return cells.groupBy(region).agg(
        F.sum("_n").alias("documents"), F.sum("_high").alias("high"),
        F.min_by(issuer, F.struct(-F.col("_n"), F.col(issuer))).alias("main_issuer"),
        F.min("_first").alias("first_date"), F.max("_last").alias("last_date"))


def summary(docs: DataFrame, level: str, region: str, regions: DataFrame) -> DataFrame:
    """Per level the documents and how many of all regions are covered."""
    total = regions.agg(F.count_distinct(region)).scalar()
    found = docs.groupBy(level).agg(F.count(F.lit(1)).alias("documents"),
                                    F.count_distinct(region).alias("covered"))
    return found.withColumn("regions", total).withColumn(
        "pct", F.round(100.0 * F.col("covered") / F.col("regions"), 1))


def gaps(docs: DataFrame, theme: str, themes: DataFrame, region: str, regions: DataFrame,
         macro: str) -> DataFrame:
    """Regions without a document on a theme, by theme and macro-region.

    A registry lists every region of its macro-region, so per theme the present ones are
    taken off that list: no product of themes and regions is built.
    """
    whole = regions.groupBy(macro).agg(F.array_sort(F.collect_set(region)).alias("_all"))
    listed = whole.agg(F.collect_list(F.struct(macro, "_all"))).scalar()
    present = docs.select(theme, region).distinct().groupBy(theme).agg(
        F.collect_set(region).alias("_present"))  # bounded by the region registry
    rows = themes.select(theme).distinct().join(present, theme, "left").withColumn(
        "_macros", listed)
    out = rows.select(theme, "_present", F.inline("_macros"))
    empty = F.array().cast(regions.select(F.array(region)).schema[0].dataType)
    return (out.withColumn("missing", F.array_except("_all", F.coalesce("_present", empty)))
            .withColumn("n_missing", F.size("missing")).withColumn("n_regions", F.size("_all"))
            .filter("n_missing > 0").select(theme, macro, "n_missing", "n_regions", "missing"))


def diffusion(docs: DataFrame, theme: str, region: str, date: str) -> DataFrame:
    """Cumulative number of regions that have taken up a theme, by date of first document."""
    first = docs.groupBy(theme, region).agg(F.min(date).alias("adopted"))
    steps = first.groupBy(theme, "adopted").agg(F.count(F.lit(1)).alias("new_regions"))
    running = Window.partitionBy(theme).orderBy("adopted")  # one row per theme and date
    return steps.withColumn("regions", F.sum("new_regions").over(running))


