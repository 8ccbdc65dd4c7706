"""Versions of a re-fetched document."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docgraph.plans import slices


def history(df: DataFrame, key: str, ts: str, tie: str) -> DataFrame:
    """``valid_from``/``valid_to`` of every version; the open one is live, the others archived."""
    out = slices.sliced(df, [key], [ts, tie], following={ts: "valid_to"})
    return (out.withColumn("valid_from", F.col(ts))
            .withColumn("live", F.col("valid_to").isNull()))


def latest(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    """The newest row per key; aggregates before the shuffle, so copies of a key travel little."""
    best = df.groupBy(key).agg(F.max_by(F.struct("*"), F.struct(*order)).alias("_row"))
    return best.select("_row.*")


def as_of(facts: DataFrame, versions: DataFrame, key: str, ts: str, version: str,
          tie: str) -> DataFrame:
    """For each fact the version in force at its time (null: a vacuum, none in force yet).

    ``versions`` has ``key``, ``ts`` (its start) and the value ``version``. A version that starts
    at the very time of the fact applies; of versions with one start the greatest does. Facts and
    versions are laid into one ordered stream per key and the last version is carried forward, so
    no range join and no pair is built.
    """
    start = versions.select(key, ts, F.struct(F.col(ts).alias("valid_from"),
                                              F.col(version).alias("version")).alias("_start"),
                            F.lit(0).alias("_side"), F.col(version).alias("_pick"))
    rows = (facts.withColumn("_side", F.lit(1)).withColumn("_tie", F.col(tie))
            .unionByName(start, allowMissingColumns=True))
    out = slices.sliced(rows, [key], [ts, "_side", "_tie", "_pick"],
                        latest=(F.col("_start"), "_in_force"))
    return (out.filter("_side = 1")
            .withColumn("valid_from", F.col("_in_force.valid_from"))
            .withColumn("version", F.col("_in_force.version"))
            .withColumn("vacuum", F.col("_in_force").isNull())
            .drop("_in_force", "_start", "_side", "_tie", "_pick"))
