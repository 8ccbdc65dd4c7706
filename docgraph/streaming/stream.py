"""Incremental intake, daily counts, review gate, backlog and version upkeep.

State is kept per key (or per open day), outputs are append-only: each batch writes the rows it
changed into its own folder, and a repeated batch overwrites that folder, so a restarted query
does no harm. ``current`` reads the newest row per key from such a change log.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def arriving(spark: SparkSession, path: str, schema: StructType, files_per_batch: int | None = None) -> DataFrame:
    """Files as they arrive in a folder and its subfolders."""
    reader = spark.readStream.schema(schema).option("recursiveFileLookup", "true")
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def intake(rows: DataFrame, keys: list[str], ts: str, delay: str) -> DataFrame:
    """Drop rows whose keys already came within ``delay``."""
    return rows.withWatermark(ts, delay).dropDuplicatesWithinWatermark(keys)


def daily(rows: DataFrame, ts: str, delay: str) -> DataFrame:
    """Rows per day; a day is final, and emitted, once the watermark has passed it.

    Rows later than that are dropped. The days not yet passed stay in state.
    """
    # Group by the window itself: its start alone would lose the watermark.
    return rows.withWatermark(ts, delay).groupBy(F.window(ts, "1 day").alias("day")).agg(
        F.count(F.lit(1)).alias("n"))


def gate(rows: DataFrame, queue: DataFrame, key: str) -> DataFrame:
    """Rows whose key does not wait in the review queue; the queue is read anew per batch."""
    return rows.join(queue.select(key), key, "left_anti")


def backlog(rows: DataFrame, title: str, ref: str, ts: str) -> DataFrame:
    """First and last sighting per title and referring document (update mode).

    Keeping the reference in the key makes the number of distinct references exact.
    """
    return rows.groupBy(title, ref).agg(F.min(ts).alias("first_seen"), F.max(ts).alias("last_seen"),
                                        F.count(F.lit(1)).alias("sightings"))


def backlog_totals(current_rows: DataFrame, title: str) -> DataFrame:
    """The backlog by title from the rows by title and reference."""
    return current_rows.groupBy(title).agg(
        F.min("first_seen").alias("first_seen"), F.max("last_seen").alias("last_seen"),
        F.count(F.lit(1)).alias("ref_count"), F.sum("sightings").alias("sightings"))


def latest(rows: DataFrame, key: str, order: list[str]) -> DataFrame:
    """The newest row per key, whatever the order of arrival (update mode)."""
    best = rows.groupBy(key).agg(F.max_by(F.struct("*"), F.struct(*order)).alias("_row"))
    return best.select("_row.*")


def run(rows: DataFrame, path: str, checkpoint: str, mode: str = "append") -> None:
    """Process what has arrived and stop; the next call goes on from the checkpoint."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    query = (rows.writeStream.outputMode(mode).option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).foreachBatch(write).start())
    query.awaitTermination()


def emitted(spark: SparkSession, path: str) -> DataFrame:
    """All rows of the change log with their batch."""
    return spark.read.parquet(path)


def current(spark: SparkSession, path: str, keys: list[str]) -> DataFrame:
    """The newest row per key."""
    log = emitted(spark, path)
    best = log.groupBy(*keys).agg(F.max_by(F.struct("*"), "batch_id").alias("_row"))
    return best.select("_row.*").drop("batch_id")
