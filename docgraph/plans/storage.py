"""Shared storage for lineage cuts and intermediate tables."""

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

TIDY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def shared_root(spark: SparkSession) -> str:
    """The folder all executors can reach, as the session names it.

    Only a session that runs in one machine (tests) may fall back to a temporary folder;
    a cluster without the setting is an error, because lost executors could not recover.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root:
        return root
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    root = tempfile.mkdtemp(prefix="docgraph-")
    spark.sparkContext.setCheckpointDir(root)
    return root


def work_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_root(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def cut(df: DataFrame) -> DataFrame:
    """Materialise reliably and drop the lineage, for loops that build on their own result."""
    root = shared_root(df.sparkSession)
    if df.sparkSession.sparkContext.getCheckpointDir() is None:
        df.sparkSession.sparkContext.setCheckpointDir(root)
    return df.checkpoint(eager=True)


@contextmanager
def tidy(spark: SparkSession):
    """What is written inside leaves no shuffle files behind; else they stay until the driver collects its garbage."""
    before = spark.conf.get(TIDY, None)
    spark.conf.set(TIDY, "true")
    try:
        yield
    finally:
        spark.conf.unset(TIDY) if before is None else spark.conf.set(TIDY, before)


def stored(df: DataFrame, name: str, compression: str | None = None) -> DataFrame:
    """Write once as Parquet in the shared folder and read back, for results used several times."""
    path = work_path(df.sparkSession, name)
    df.write.parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)
