"""Registry of queries and their SQL counterparts."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from docgraph.plans.spread import spread

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


class Tables:
    """Lazy access to the given tables: ``t.documents`` reads documents.parquet."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path

    @property
    def texts(self) -> DataFrame:
        """The documents, dealt out to all cores for work on their texts."""
        return spread(self.documents)

    def __getattr__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.path}/{name}.parquet")


def query(name: str, sql: str | None = None):
    """Register ``fn(tables) -> DataFrame`` under ``name``."""

    def register(fn):
        def run(spark: SparkSession, path: str) -> DataFrame:
            spark.conf.set("spark.sql.session.timeZone", "UTC")
            return fn(Tables(spark, path))

        QUERIES[name] = run
        if sql:
            ORACLES[name] = sql
        return fn

    return register
