"""Writers: append-only raw tables, rewritten derived tables, archive split."""

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DecimalType, LongType, StringType, StructField, StructType

from docgraph.plans import storage


def existing(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The table at ``path``, empty with ``schema`` if nothing was written yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def unseen(df: DataFrame, table: DataFrame, key: str) -> DataFrame:
    """Rows whose key is not stored yet; of rows sharing a new key, the least by all columns."""
    rest = [c for c in df.columns if c != key]
    new = df.join(table.select(key), key, "left_anti")
    one = new.groupBy(key).agg(F.min(F.struct(*rest)).alias("_row"))
    return one.select(key, "_row.*").select(*df.columns)


def append_new(df: DataFrame, path: str, key: str, partition: str | None = None) -> None:
    """Append the rows with new keys; what is stored is never touched, so repeats are harmless."""
    new = unseen(df, existing(df.sparkSession, path, df.schema), key)
    _write(new, path, "append", [partition] if partition else [])


#: Folders of an append table with a manifest.
ROWS, REJECTS, COMMITS = "rows", "rejects", "commits"


def _folder(path: str, part: str, batch: str) -> str:
    return f"{path.rstrip('/')}/{part}/batch={batch}"


def commits(spark: SparkSession, path: str) -> DataFrame:
    """The manifest: a row per batch that was written in full, with its numbers and a checksum."""
    return existing(spark, f"{path.rstrip('/')}/{COMMITS}", MANIFEST)


MANIFEST = StructType([
    StructField("batch", StringType()), StructField("added", LongType()), StructField("rejected", LongType()),
    StructField("repeated", LongType()), StructField("checksum", DecimalType(38, 0))])


def _committed(spark: SparkSession, path: str, part: str, schema: StructType) -> DataFrame:
    """The rows of committed batches; what a broken run left behind is not read."""
    full = StructType([*schema.fields, StructField("batch", StringType())])
    rows = existing(spark, f"{path.rstrip('/')}/{part}", full)
    return rows.join(commits(spark, path).select("batch"), "batch", "left_semi")


def stored_rows(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """What the table holds, with the batch that brought it."""
    return _committed(spark, path, ROWS, schema)


def rejected_rows(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """What was not taken, with ``reason`` and batch."""
    return _committed(spark, path, REJECTS, StructType([*schema.fields, StructField("reason", StringType())]))


def append_batch(df: DataFrame, path: str, key: str, batch: str) -> bool:
    """Append a batch of raw rows; what is stored is never touched. False if it is in already.

    A key with the content that is stored, or the same row twice in a batch, is a repeat and adds
    nothing. Rows without a key, with a stored key but other content, or with a key that comes with
    several contents in the batch are put aside with the reason; none of them is guessed right.
    Rows are written before rejects, and the commit record last, so a run that broke off is
    repeated under its name and overwrites what it left; a run repeated after its commit adds nothing.
    Batches of one table must not run at the same time.
    """
    spark = df.sparkSession
    if not commits(spark, path).filter(F.col("batch") == batch).isEmpty():
        return False
    rest = [f"`{c}`" for c in df.columns if c != key]
    digest = F.sha2(F.to_json(F.struct(*rest), {"ignoreNullFields": "false"}), 256)
    rows = df.withColumn("_hash", digest)
    held = stored_rows(spark, path, df.schema).withColumn("_hash", digest).select(key, F.col("_hash").alias("_held"))
    # One row per content of a key; a repeated key is counted before it meets what is stored.
    one = rows.filter(F.col(key).isNotNull()).groupBy(key, "_hash").agg(
        F.first(F.struct(*rest)).alias("_row"), F.count(F.lit(1)).alias("_times"))
    many = one.groupBy(key).agg(F.count(F.lit(1)).alias("_contents"))
    judged = one.join(many, key).join(held, key, "left").withColumn("reason", F.when(
        F.col("_held").isNotNull(), F.when(F.col("_held") == F.col("_hash"), "repeat").otherwise("other content is stored"))
        .when(F.col("_contents") > 1, "several contents").otherwise("new"))
    judged = storage.stored(judged.select(key, "_row.*", "_times", "reason", F.xxhash64("_hash").alias("_sum")), "judged")
    added = judged.filter("reason = 'new'")
    aside = judged.filter("reason in ('other content is stored', 'several contents')").select(*df.columns, "reason")
    nameless = df.filter(F.col(key).isNull()).withColumn("reason", F.lit("no key"))
    added.select(df.columns).write.mode("overwrite").parquet(_folder(path, ROWS, batch))
    aside.unionByName(nameless).write.mode("overwrite").parquet(_folder(path, REJECTS, batch))
    is_new, is_repeat = F.col("reason") == "new", F.col("reason") == "repeat"
    record = judged.agg(
        F.count_if(is_new).alias("added"), F.count_if(~is_new & ~is_repeat).alias("rejected"),
        F.coalesce(F.sum(F.when(is_repeat, F.col("_times")).when(is_new, F.col("_times") - 1)), F.lit(0)).alias("repeated"),
        F.coalesce(F.sum(F.when(is_new, F.col("_sum").cast("decimal(38,0)"))), F.lit(0)).cast("decimal(38,0)").alias("checksum"))
    lost = nameless.agg(F.count(F.lit(1)).alias("_n")).scalar()
    record = record.withColumn("rejected", F.col("rejected") + lost)
    record.coalesce(1).write.mode("overwrite").parquet(_folder(path, COMMITS, batch))
    return True


def rewrite(df: DataFrame, path: str, partition: list[str]) -> None:
    """Replace the partitions present in ``df``, or the whole table without partition columns."""
    _write(df, path, "overwrite", partition)


def _write(df: DataFrame, path: str, mode: str, partition: list[str]) -> None:
    if partition:
        # Rows of one partition go together, but AQE cuts a large one into several files.
        df = df.hint("rebalance", *[F.col(c) for c in partition])
    (df.write.mode(mode).option("partitionOverwriteMode", "dynamic")
     .partitionBy(*partition).parquet(path))


def disposition(df: DataFrame, rules: dict[str, Column]) -> DataFrame:
    """Mark each row kept or dropped; the first rule that holds gives the reason."""
    reason = F.coalesce(*[F.when(rule, name) for name, rule in rules.items()])
    return df.withColumn("reason", F.coalesce(reason, F.lit("none"))).withColumn(
        "disposition", F.when(F.col("reason") == "none", "kept").otherwise("dropped"))


def split_archive(df: DataFrame, rules: dict[str, Column], path: str) -> None:
    """Write kept and dropped rows in one pass, one folder per disposition and reason."""
    rewrite(disposition(df, rules), path, ["disposition", "reason"])
