"""Costly expressions that filters and later columns refer to."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def computed(df: DataFrame, cols: dict[str, Column]) -> DataFrame:
    """Add columns that are evaluated once per row.

    The optimizer substitutes a projected expression into every filter on it and pushes the filter
    to the scan, so a parse would run once per mention, before the rows are dealt out. A generated
    column stops that; filters on other columns still pass.
    """
    row = F.struct(*[c.alias(n) for n, c in cols.items()])
    return df.select("*", F.inline(F.array(row)))
