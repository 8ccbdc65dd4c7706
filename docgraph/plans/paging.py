"""Lists of a group in pages, so that no task collects the list of a hot group."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docgraph.plans import slices


def paged(df: DataFrame, keys: list[str], order: str, entry: Column, size: int = 1000) -> DataFrame:
    """Sorted ``entries`` per group and page; the pages of a group follow each other in ``order``.

    Every page but a group's last has ``size`` entries. Entries should sort by ``order`` first.
    """
    rows = df.select(*keys, F.col(order).alias("_order"), entry.alias("_entry"))
    placed = slices.sliced(rows, keys, ["_order", "_entry"], ordinal="_nth")
    page = F.floor((F.col("_nth") - 1) / size).cast("long").alias("page")
    return placed.groupBy(*keys, page).agg(
        F.count(F.lit(1)).alias("n"), F.sort_array(F.collect_list("_entry")).alias("entries"))
