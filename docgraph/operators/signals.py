"""Signal feeds."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def union(feeds: dict[str, DataFrame]) -> DataFrame:
    """Feeds with differing columns under one another; the feed's name is kept."""
    out = None
    for kind, feed in feeds.items():
        rows = feed.withColumn("source_kind", F.lit(kind))
        out = rows if out is None else out.unionByName(rows, allowMissingColumns=True)
    return out
