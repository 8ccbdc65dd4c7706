"""Per-theme tables."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docgraph.operators import agg, rank
from docgraph.plans import paging


def stats(docs: DataFrame, theme: str, date: str, score: str, high: int = 4) -> DataFrame:
    """Total, high share, mean, busiest year (ties to the earlier) and counts per year.

    Undated documents count in the totals; they have no year.
    """
    years = docs.groupBy(theme, F.year(date).alias("year")).agg(
        F.count(F.lit(1)).alias("_n"), F.count_if(F.col(score) >= high).alias("_high"),
        F.sum(score).alias("_sum"))
    return years.groupBy(theme).agg(
        F.sum("_n").alias("documents"), F.sum("_high").alias("high"),
        F.round(100.0 * F.sum("_high") / F.sum("_n"), 1).alias("high_pct"),
        F.round(F.sum("_sum") / F.sum("_n"), 2).alias("mean_importance"),
        F.min_by("year", F.when(F.col("year").isNotNull(), F.struct(-F.col("_n"), F.col("year")))).alias("busiest_year"),
        F.map_from_entries(F.sort_array(F.collect_list(F.when(
            F.col("year").isNotNull(), F.struct("year", "_n"))))).alias("years"))


def timeline(docs: DataFrame, theme: str, level: str, date: str, key: str, score: str,
             floor: int = 4) -> DataFrame:
    """Important documents in page order: theme, level, date, key (a range-partitioned sort)."""
    return docs.filter(F.col(score) >= floor).orderBy(theme, level, date, key)


def bundle(docs: DataFrame, edges: DataFrame, theme: str, key: str, level: str, region: str,
           issuer: str, score: str, k: int = 5) -> DataFrame:
    """One nested row of figures per theme: sizes, maps of regions and issuers, best documents.

    The row nests what the registries or ``k`` bound; documents and relations, which grow with
    the corpus, are nested by ``bundle_pages``. Missing levels, regions and issuers are ``(none)``.
    """
    docs = docs.withColumns({c: agg.named(c) for c in (level, region, issuer)})
    sizes = docs.groupBy(theme).agg(F.count(F.lit(1)).alias("documents"))
    cells = docs.groupBy(theme, level, region).agg(F.count(F.lit(1)).alias("n"))
    levels = cells.groupBy(theme, level).agg(F.map_from_entries(
        F.sort_array(F.collect_list(F.struct(region, "n")))).alias("names"))
    regions = levels.groupBy(theme).agg(F.map_from_entries(
        F.collect_list(F.struct(F.col(level).cast("string"), F.col("names")))
    ).alias("region_distribution"))
    by_issuer = docs.groupBy(theme, issuer).agg(F.count(F.lit(1)).alias("n"))
    issuers = rank.topk(by_issuer, [theme], [F.desc("n"), F.col(issuer)], k).groupBy(theme).agg(
        F.map_from_entries(F.transform(
            F.sort_array(F.collect_list(F.struct("rank", issuer, "n"))),
            lambda s: F.struct(s[issuer], s["n"]))).alias("top_issuers"))
    best = rank.topk(docs, [theme], [F.desc(score), F.col(key)], k).groupBy(theme).agg(
        F.transform(F.sort_array(F.collect_list(F.struct("rank", key, score))),
                    lambda s: F.struct(s[key], s[score])).alias("top"))
    links = edges.groupBy(theme).agg(F.count(F.lit(1)).alias("relations"))
    return reduce(lambda a, b: a.join(b, theme, "left"),
                  [sizes, regions, issuers, best, links]).fillna(0, ["relations"])


def bundle_pages(docs: DataFrame, edges: DataFrame, theme: str, key: str, cols: list[str],
                 size: int = 1000) -> tuple[DataFrame, DataFrame]:
    """The documents and the relations of each theme as nested pages."""
    policies = paging.paged(docs, [theme], key, F.struct(key, *cols), size)
    relations = paging.paged(edges, [theme], "src", F.struct("src", "dst", "rel"), size)
    return policies, relations


def overlap(tags: DataFrame, themes: str) -> DataFrame:
    """How many documents carry both themes, for every pair of themes that occurs.

    Pairs are formed within a document's own short list, so nothing is joined.
    """
    listed = F.array_sort(F.array_distinct(themes))
    pairs = F.flatten(F.transform(listed, lambda a: F.transform(
        F.filter(listed, lambda b: b > a), lambda b: F.struct(a.alias("a"), b.alias("b")))))
    return tags.select(F.inline(pairs)).groupBy("a", "b").agg(F.count(F.lit(1)).alias("documents"))
