"""Score records: formula, classes, gates, relevance signals, cohorts."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docgraph.functions import scores as S


def scored(df: DataFrame) -> DataFrame:
    """Importance, action class and archive flag from D1 to D6."""
    d = {n: F.col(n) for n in ("D1", "D2", "D3", "D4", "D5", "D6")}
    return (df.withColumn("importance", S.importance(d["D1"], d["D2"], d["D3"]))
            .withColumn("action_class", S.action_class(d["D4"], d["D5"], d["D6"]))
            .withColumn("archive", S.archive_flag(F.col("importance"))))


def issuer_level(df: DataFrame, issuer: str, score: str, dim: DataFrame) -> DataFrame:
    """Records whose issuer level differs from the lookup; ``dim`` has ``issuer`` and ``level``."""
    want = dim.select(F.col("issuer").alias(issuer), F.col("level").alias("expected"))
    return df.join(want, issuer).filter(F.col(score) != F.col("expected"))


def gate_audit(df: DataFrame, declared: Column, stored: Column) -> DataFrame:
    """Declared rule against stored flag: counts of the four cases."""
    return df.select(declared.alias("declared"), stored.alias("stored")).groupBy(
        "declared", "stored").agg(F.count(F.lit(1)).alias("n"))


def matrix2x2(df: DataFrame, x: str, y: str, cut: int = 4) -> DataFrame:
    """Counts in the four quadrants of two scores; empty quadrants are listed."""
    marked = df.select(S.high_low(F.col(x), cut).alias("x"), S.high_low(F.col(y), cut).alias("y"))
    cells = {f"{a}|{b}": F.count_if((F.col("x") == a) & (F.col("y") == b))
             for a in ("high", "low") for b in ("high", "low")}
    wide = marked.agg(*[c.alias(n) for n, c in cells.items()]).unpivot([], list(cells), "_cell", "n")
    return wide.select(F.split_part("_cell", F.lit("|"), F.lit(1)).alias("x"),
                       F.split_part("_cell", F.lit("|"), F.lit(2)).alias("y"), "n")


def signals(docs: DataFrame, key: str, words: Column, region: Column, rules: DataFrame) -> DataFrame:
    """Relevance of documents by rules (term, business, weight, evidence, region).

    A document's words meet the rule terms in an equi join. A suppressing rule lowers, a high rule
    raises, and a medium rule raises only in its region. A rule without evidence never lowers a
    document: it goes to review. Rule tables are small and broadcast when counted so.
    """
    terms = docs.select(key, region.alias("_region"), F.explode(F.array_distinct(words)).alias("term"))
    hits = terms.join(rules, "term")
    is_weight = lambda w: F.max((F.col("weight") == w).cast("int"))
    local = (F.col("weight") == "medium") & (F.col("region") == F.col("_region"))
    flags = hits.groupBy(key, "business").agg(
        F.count(F.lit(1)).alias("hits"), is_weight("high").alias("_high"),
        is_weight("suppress").alias("_low"), is_weight("medium").alias("_medium"),
        F.max(local.cast("int")).alias("_local"),
        F.max(F.col("evidence").isNull().cast("int")).alias("_blank"))
    level = (F.when((F.col("_high") == 1) | (F.col("_local") == 1), "high")
             .when(F.col("_blank") == 1, "review")
             .when(F.col("_low") == 1, "low")
             .otherwise("medium"))
    return flags.select(key, "business", "hits", level.alias("relevance"))


def evidence(df: DataFrame, level: str, score: str, linkage: str) -> DataFrame:
    """Local evidence: below national level, and important or linked."""
    return df.filter((F.col(level) > 0) & ((F.col(score) >= 4) | F.col(linkage).isNotNull()))


def cohorts(df: DataFrame, cohort: str, score: str, has_theme: Column, distance: float = 0.5) -> DataFrame:
    """Score distribution per scorer or profile; cohorts far from the overall mean are flagged."""
    value = F.col(score).cast("double")
    rows = df.groupBy(cohort).agg(
        F.count(F.lit(1)).alias("n"), F.sum(value).alias("_sum"),
        F.sum(value * value).alias("_squares"), F.count_if(has_theme).alias("_themed"))
    overall = df.agg(F.avg(value)).scalar()
    mean = F.col("_sum") / F.col("n")
    variance = F.greatest(F.col("_squares") / F.col("n") - mean * mean, F.lit(0.0))
    return rows.select(
        cohort, "n", F.round(mean, 6).alias("mean"), F.round(F.sqrt(variance), 6).alias("stddev"),
        F.round(F.col("_themed") / F.col("n"), 6).alias("themed_share"),
        (F.abs(mean - overall) > distance).alias("incomparable"))
