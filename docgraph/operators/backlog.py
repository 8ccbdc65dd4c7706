"""Backlog of references that resolve to nothing."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def build(unresolved: DataFrame, title: str, ref: str, ts: str, kind: str | None = None,
          evidence: str | None = None, tie: list[str] | None = None) -> DataFrame:
    """Per title first and last sighting, distinct referring documents, sightings.

    With ``kind``, the ``linkage_type`` seen most often (ties to the least); with ``evidence``, the
    ``evidence_sample`` of the first sighting that has one (ties by ``tie``, then the least).
    Titles and kinds are counted first, so a hot title costs one row per kind.
    """
    kinds = [kind] if kind else []
    proof = F.struct(ts, *(tie or []), evidence) if evidence else None
    cells = [F.min(F.when(F.col(evidence).isNotNull(), proof)).alias("_proof")] if evidence else []
    parts = unresolved.groupBy(title, *kinds).agg(
        F.min(ts).alias("_first"), F.max(ts).alias("_last"), F.count(F.lit(1)).alias("_n"), *cells)
    most = [F.min_by(kind, F.when(F.col(kind).isNotNull(), F.struct(-F.col("_n"), F.col(kind)))).alias("linkage_type")] if kind else []
    sample = [F.min("_proof")[evidence].alias("evidence_sample")] if evidence else []
    refs = unresolved.groupBy(title).agg(F.count_distinct(ref).alias("ref_count"))
    out = parts.groupBy(title).agg(F.min("_first").alias("first_seen"), F.max("_last").alias("last_seen"),
                                   F.sum("_n").alias("sightings"), *most, *sample)
    rows, counts = out.alias("o"), refs.withColumnRenamed(title, "_title")
    return rows.join(counts, F.col(title).eqNullSafe(F.col("_title"))).drop("_title")


def references(unresolved: DataFrame, title: str, ref: str) -> DataFrame:
    """The referring documents themselves, one row each: a title may have any number."""
    return unresolved.select(title, ref).distinct()


def merge(stored: DataFrame, fresh: DataFrame, title: str) -> DataFrame:
    """Fold a batch of backlog rows without reference counts into the stored ones."""
    return stored.unionByName(fresh).groupBy(title).agg(
        F.min("first_seen").alias("first_seen"), F.max("last_seen").alias("last_seen"),
        F.sum("sightings").alias("sightings"))
