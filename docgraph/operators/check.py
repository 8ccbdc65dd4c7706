"""Claims of being first, checked against the corpus."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docgraph.plans import slices


def ordinal_claims(docs: DataFrame, key: str, kind: list[str], date: str, claim: Column) -> DataFrame:
    """True place of every claiming document among its kind, by date then key.

    The predecessors of the n-th document are the rows of its kind with a smaller ordinal; the
    row names the first and the nearest, so a late claim does not repeat a long list.
    """
    rows = docs.withColumn("_claim", claim)
    rows = slices.sliced(rows, kind, [date, key], ordinal="ordinal", previous={key: "predecessor"}, first={key: "first"})
    return rows.filter("_claim").drop("_claim").withColumn("holds", F.col("ordinal") == 1)
