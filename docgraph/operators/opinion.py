"""Stances: consensus, disagreement, matrix per document."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docgraph.functions import fixed, text


def normalize_aspect(stances: DataFrame, synonyms: DataFrame | None = None) -> DataFrame:
    """One spelling per aspect: a synonym if listed, else its distinct words in order."""
    words = F.array_join(F.array_sort(F.array_distinct(text.words("aspect"))), " ")
    rows = stances.withColumn("_key", F.when(words == "", F.trim("aspect")).otherwise(words))
    if synonyms is None:
        return rows.withColumn("aspect_norm", F.col("_key")).drop("_key")
    dim = synonyms.select(F.col("aspect").alias("_aspect"), F.col("canonical").alias("_canonical"))
    joined = rows.join(dim, rows["_key"] == dim["_aspect"], "left")
    return joined.withColumn("aspect_norm", F.coalesce("_canonical", "_key")).drop(
        "_key", "_aspect", "_canonical")


def consensus(stances: DataFrame, doc: str, aspect: str, polarity: str, source: str,
              n: int = fixed.CONSENSUS_SOURCES) -> DataFrame:
    """Same aspect and polarity from at least ``n`` distinct sources."""
    return stances.groupBy(doc, aspect, polarity).agg(
        F.count_distinct(source).alias("sources"), F.count(F.lit(1)).alias("stances")
    ).filter(F.col("sources") >= n)


def conflict(stances: DataFrame, keys: list[str], polarity: str, source: str, pro: str, con: str,
             n: int = 2) -> DataFrame:
    """Aspects with opposite polarities from at least ``n`` distinct sources together."""
    side = lambda p: F.max((F.col(polarity) == p).cast("long"))
    both = stances.filter(F.col(polarity).isin(pro, con))
    by_source = both.groupBy(*keys, source).agg(side(pro).alias("_pro"), side(con).alias("_con"))
    return by_source.groupBy(*keys).agg(
        F.sum("_pro").alias("pro"), F.sum("_con").alias("con"), F.count(source).alias("sources")
    ).filter((F.col("pro") > 0) & (F.col("con") > 0) & (F.col("sources") >= n))


def matrix(stances: DataFrame, doc: str, polarity: str, source: str, polarities: list[str]) -> DataFrame:
    """Totals by polarity and distinct sources per document."""
    cells = [F.count_if(F.col(polarity) == p).alias(p) for p in polarities]
    return stances.groupBy(doc).agg(F.count(F.lit(1)).alias("total"), *cells,
                                    F.count_distinct(source).alias("sources"))


def watch(stances: DataFrame, polarity: str, neutral: str, follow_up: Column) -> DataFrame:
    """Neutral observations and stances marked for follow-up."""
    listing = F.when(F.col(polarity) == neutral, "neutral").when(follow_up, "follow_up")
    return stances.withColumn("listing", listing).filter("listing is not null")
