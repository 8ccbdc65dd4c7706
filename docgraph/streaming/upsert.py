"""Keyed tables that a stream keeps up to date, without state in the stream.

Keys are dealt to a fixed number of buckets. A batch rewrites only the buckets that it touches,
each into a folder of its own, and ends with a commit: the list of the folder that holds each
bucket now. That list has one row per bucket at most, and a reader needs nothing else. A batch that
broke off has no commit and is done again over its own folders; a batch that is repeated after its
commit changes nothing. Folders that no kept commit names are dropped, so the table holds each key
about once, however long the stream runs.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from docgraph.sources.sink import existing

#: One row per bucket: the batch whose folder holds it.
COMMIT = StructType([StructField("bucket", IntegerType()), StructField("version", LongType()),
                     StructField("batch", LongType())])

Merge = Callable[[DataFrame, DataFrame | None], DataFrame]


def newest(keys: list[str], order: list[str]) -> Merge:
    """Of the rows of a key the one that is last in ``order``, whatever arrived first."""

    def merge(batch: DataFrame, held: DataFrame | None) -> DataFrame:
        rows = batch if held is None else held.unionByName(batch)
        best = rows.groupBy(*keys).agg(F.max_by(F.struct("*"), F.struct(*order)).alias("_row"))
        return best.select("_row.*")

    return merge


def summed(keys: list[str], cells: dict[str, Callable[[Column], Column]]) -> Merge:
    """One row per key whose cells are combined, such as a least, a greatest or a sum.

    The batch has the columns of the table: what a single row adds to each cell.
    """

    def merge(batch: DataFrame, held: DataFrame | None) -> DataFrame:
        rows = batch if held is None else held.unionByName(batch)
        return rows.groupBy(*keys).agg(*[f(F.col(c)).alias(c) for c, f in cells.items()])

    return merge


def _root(path: str) -> str:
    return path.rstrip("/")


def commits(spark: SparkSession, path: str) -> DataFrame:
    return existing(spark, f"{_root(path)}/commits", COMMIT)


def _current(spark: SparkSession, path: str) -> tuple[int | None, dict[int, int]]:
    """The last committed batch, and the batch that holds each bucket."""
    log = commits(spark, path)
    last = log.agg(F.max("batch")).first()[0]
    if last is None:
        return None, {}
    return last, {r.bucket: r.version for r in log.filter(F.col("batch") == last).collect() if r.bucket is not None}


def _read(spark: SparkSession, path: str, schema: StructType, versions: dict[int, int]) -> DataFrame | None:
    folders = [f"{_root(path)}/rows/bucket={b}/version={v}" for b, v in sorted(versions.items())]
    return spark.read.schema(schema).parquet(*folders) if folders else None


def table(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The rows as of the last commit."""
    rows = _read(spark, path, schema, _current(spark, path)[1])
    return spark.createDataFrame([], schema) if rows is None else rows


def upsert(batch: DataFrame, batch_id: int, path: str, keys: list[str], merge: Merge, buckets: int = 64,
           keep: int = 2) -> bool:
    """Merge a batch into the table at ``path``; False if it was committed before.

    ``buckets`` is fixed for the life of a table; choose it so that a bucket is rewritten in one
    task or a few. ``keep`` commits stay readable, older ones and what only they name are dropped.
    Keys that hold a large share of the rows are merged on the way in, before the shuffle.
    """
    spark = batch.sparkSession
    last, versions = _current(spark, path)
    if last is not None and batch_id <= last:
        return False
    bucket = F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int")
    merged_in = merge(batch, None)
    touched = sorted(r[0] for r in merged_in.select(bucket.alias("b")).distinct().collect())  # ``buckets`` at most
    root = _root(path)
    if touched:
        held = _read(spark, path, batch.schema, {b: versions[b] for b in touched if b in versions})
        rows = merge(merged_in, held).withColumns({"bucket": bucket, "version": F.lit(batch_id).cast("long")})
        # Rows of a bucket go together; what a broken run of this batch left is overwritten.
        (rows.hint("rebalance", F.col("bucket")).write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("bucket", "version").parquet(f"{root}/rows"))
        versions |= {b: batch_id for b in touched}
    listed = [(b, v) for b, v in versions.items()] or [(None, None)]
    spark.createDataFrame(listed, "bucket int, version long").coalesce(1).write.mode("overwrite").parquet(
        f"{root}/commits/batch={batch_id}")
    compact(spark, path, keep)
    return True


def compact(spark: SparkSession, path: str, keep: int = 2) -> None:
    """Drop all commits but the last ``keep``, and the folders that none of these names."""
    log = commits(spark, path)
    batches = sorted(r[0] for r in log.select("batch").distinct().collect())
    kept = set(batches[-keep:])
    named = {(r.bucket, r.version) for r in log.filter(F.col("batch").isin(*kept)).collect()}
    for batch in batches[:-keep]:
        _drop(spark, f"{_root(path)}/commits/batch={batch}")
    for folder in _folders(spark, f"{_root(path)}/rows/bucket=*/version=*"):
        bucket, version = (int(x.partition("=")[2]) for x in folder.split("/")[-2:])
        # A folder above the last commit belongs to a run that broke off; its batch comes again.
        if (bucket, version) not in named and version <= max(kept):
            _drop(spark, folder)


def _folders(spark: SparkSession, pattern: str) -> list[str]:
    path = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path)
    return [s.getPath().toString() for s in found or []]


def _drop(spark: SparkSession, folder: str) -> None:
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def run(rows: DataFrame, path: str, checkpoint: str, keys: list[str], merge: Merge, buckets: int = 64,
        keep: int = 2) -> None:
    """Merge what has arrived and stop; the next call goes on from the checkpoint."""

    def write(batch: DataFrame, batch_id: int) -> None:
        upsert(batch, batch_id, path, keys, merge, buckets, keep)

    (rows.writeStream.option("checkpointLocation", checkpoint).trigger(availableNow=True)
     .foreachBatch(write).start().awaitTermination())
