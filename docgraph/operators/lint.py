"""Quality rules. Each yields rows of violations; ``report`` brings them together."""

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docgraph.functions import fixed, text


def field_whitelist(fields: DataFrame, allowed: list[str], forbidden: list[str],
                    legacy: list[str]) -> DataFrame:
    """Status of each header field (column ``field``): allowed, legacy, forbidden, unknown."""
    f = F.col("field")
    status = (F.when(f.isin(forbidden), "forbidden").when(f.isin(legacy), "legacy")
              .when(f.isin(allowed), "allowed").otherwise("unknown"))
    return fields.withColumn("status", status)


def required(df: DataFrame, cols: list[str]) -> DataFrame:
    """Names of the missing fields per row; rows with none missing are left out."""
    lacking = F.array_compact(F.array(*[
        F.when(text.blank_to_null(F.col(c).cast("string")).isNull(), c) for c in cols]))
    return df.withColumn("missing", lacking).filter(F.size("missing") > 0)


def body_sections(df: DataFrame, sections: Column, allowed: list[str]) -> DataFrame:
    """Headings that are not permitted, one row each."""
    extra = F.array_except(F.array_distinct(sections), F.array(*[F.lit(a) for a in allowed]))
    return df.withColumn("section", F.explode(extra))


def low_quality(df: DataFrame, body: str, floor: int = fixed.LOW_QUALITY_CHARS) -> DataFrame:
    """Texts too short to be a full capture."""
    return df.withColumn("body_len", F.length(body)).filter(F.col("body_len") < floor)


def immutable(old: DataFrame, new: DataFrame, key: str, cols: list[str],
              whitelist: list[str]) -> DataFrame:
    """Changed, added and removed rows between two snapshots, one row per changed field.

    Long fields are hashed before the shuffle, so the join moves digests and not texts.
    """
    checked = [c for c in cols if c not in whitelist]

    def digest(df, side):
        return df.select(key, F.lit(True).alias(f"_{side}"), *[
            F.xxhash64(F.coalesce(F.col(c).cast("string"), F.lit("\x00"))).alias(f"{c}_{side}")
            for c in checked])

    both = digest(old, "old").join(digest(new, "new"), key, "full")
    kinds = F.array_compact(F.array(
        F.when(F.col("_new").isNull(), F.struct(F.lit("*").alias("field"), F.lit("removed").alias("change"))),
        *[F.when(F.col("_old") & F.col("_new") & (F.col(f"{c}_old") != F.col(f"{c}_new")),
                 F.struct(F.lit(c).alias("field"), F.lit("changed").alias("change"))) for c in checked]))
    return both.select(key, F.inline(kinds))


def id_year(df: DataFrame, key: str, date: str, this_year: int) -> DataFrame:
    """Ids whose year is a placeholder, in the future, or not that of the date."""
    year = F.regexp_extract(key, r"^P_(\d{4})_", 1).try_cast("int")
    problem = (F.when(year.isNull(), "no year").when(year == fixed.PLACEHOLDER_YEAR, "placeholder")
               .when(year > this_year, "future").when(year != F.year(date), "mismatch"))
    return df.withColumn("problem", problem).filter("problem is not null")


def orphans(edges: DataFrame, nodes: DataFrame, key: str) -> DataFrame:
    """Edges whose source or target has no row in ``nodes``, with the missing end."""
    parts = []
    for end in ("src", "dst"):
        known = nodes.select(F.col(key).alias(end))
        parts.append(edges.filter(F.col(end).isNotNull()).join(known, end, "left_anti").select(
            "src", "dst", "rel", F.lit(end).alias("missing_end")))
    parts.append(edges.filter("dst is null").select("src", "dst", "rel",
                                                    F.lit("unresolved").alias("missing_end")))
    return reduce(DataFrame.unionByName, parts)


def terms(df: DataFrame, key: str, body: str, words: list[str]) -> DataFrame:
    """Occurrences of listed terms per document, all terms in one pass over the text."""
    return df.select(key, F.explode(text.term_hits(body, words)).alias("term")).groupBy(
        key, "term").agg(F.count(F.lit(1)).alias("n"))


def diff_pairs(needed: DataFrame, present: DataFrame, keys: list[str]) -> DataFrame:
    """Required version pairs without a comparison, and comparisons nobody requires."""
    missing = needed.join(present, keys, "left_anti").withColumn("status", F.lit("missing"))
    extra = present.join(needed, keys, "left_anti").withColumn("status", F.lit("extra"))
    return missing.select(*keys, "status").unionByName(extra.select(*keys, "status"))


def set_diff(expected: DataFrame, present: DataFrame) -> DataFrame:
    """Rows of either side without counterpart, with their multiplicity, in one aggregation."""
    cols = expected.columns
    signed = expected.select(*cols, F.lit(1).alias("_s")).unionByName(
        present.select(*cols, F.lit(-1).alias("_s")))
    sums = signed.groupBy(*cols).agg(F.sum("_s").alias("_n")).filter("_n <> 0")
    return sums.select(*cols, F.when(F.col("_n") > 0, "missing").otherwise("extra").alias("status"),
                       F.abs("_n").alias("n"))


def report(results: dict[str, tuple[str, DataFrame]]) -> DataFrame:
    """All rules' violations as (rule, severity, payload)."""
    parts = [df.select(F.lit(rule).alias("rule"), F.lit(severity).alias("severity"),
                       F.to_json(F.struct("*")).alias("payload"))
             for rule, (severity, df) in results.items()]
    return reduce(DataFrame.unionByName, parts)


def totals(findings: DataFrame) -> DataFrame:
    return findings.groupBy("rule", "severity").agg(F.count(F.lit(1)).alias("n"))


def daily(findings: DataFrame) -> DataFrame:
    """One row: counts by severity and the verdict. Warnings do not fail a day."""
    sums = findings.agg(*[F.count_if(F.col("severity") == s).alias(f"{s}s")
                          for s in ("error", "warning", "info")])
    return sums.withColumn("lint_pass", F.col("errors") == 0)


