"""From raw documents to token ids: quality, lines, near copies, benchmarks, pieces.

Every stage takes the documents its predecessor kept and returns documents with the same columns,
but for the last one, which returns their encoding.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docgraph.llm import decontaminate, jaccard, linededup, pieces, quality
from docgraph.plans import storage


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and lie in the perplexity band of their language."""
    return quality.passing(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines of repeated three-line windows; n_chars follows the text.

    A document of which nothing is left but white space is dropped if lines were removed.
    """
    done = linededup.deduplicated(docs)
    done = done.filter("n_removed < n_lines or n_removed = 0")
    values = {"text": F.col("clean_text"), "n_chars": F.when(
        F.col("n_removed") > 0, F.length("clean_text")).otherwise(F.col("doc.n_chars"))}
    return done.select(*[values.get(c, F.col(f"doc.`{c}`")).cast(docs.schema[c].dataType).alias(c)
                         for c in docs.columns])


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near copies: least id (nulls last), then text hash, then row number.

    Repeated rows are copies of each other; a text without words is nobody's copy.
    """
    rows = storage.stored(docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"),
        F.monotonically_increasing_id().alias("row")), "rows")
    groups = jaccard.join(rows.select("row", F.col("doc.text").alias("text")), n=5, num=4, den=5, id_col="row").select(
        F.col("doc_id").alias("row"), "component_id", "class")
    keyed = groups.join(rows.select("row", F.struct(
        F.col("doc.doc_id").isNull().alias("last"), F.col("doc.doc_id").alias("doc_id"),
        F.xxhash64("doc.text").alias("hash"), "row").alias("key")), "row")
    first = keyed.filter("class is not null").groupBy("component_id").agg(
        F.min("key").alias("key")).select("key.row")
    kept = first.unionByName(groups.filter("class is null").select("row"))
    return rows.join(kept, "row", "left_semi").select("doc.*")


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item."""
    return decontaminate.clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def sentencepiece_encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, ids, their number and digest, and whether decoding gives the text back."""
    return pieces.round_trip(docs)


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("ngram_jaccard_join", near_copies),
    ("benchmark_decontamination", benchmark_decontamination),
    ("sentencepiece", sentencepiece_encoding),
]

#: Perplexity bands, string tiling and Viterbi paths have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in order over the documents; each one's result is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = storage.stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
