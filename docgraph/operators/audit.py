"""Rule stage of the commentary audit."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docgraph.plans import once

UNDECIDED = ("?", 0.4, "no rule")


def classify(df: DataFrame, rules: list[tuple[Column, str, float, str]]) -> DataFrame:
    """Type, confidence and reason by the first rule (condition, type, confidence, reason)."""
    verdict = lambda t, c, r: F.struct(F.lit(t).alias("type"), F.lit(c).alias("confidence"),
                                       F.lit(r).alias("reason"))
    tried = [F.when(condition, verdict(t, c, r)) for condition, t, c, r in rules]
    rows = once.computed(df, {"_verdict": F.coalesce(*tried, verdict(*UNDECIDED))})
    return rows.select("*", "_verdict.*").drop("_verdict")


def borderline(df: DataFrame, threshold: float = 0.7) -> DataFrame:
    """Verdicts to be looked at by a person."""
    return df.filter(F.col("confidence") < threshold)
