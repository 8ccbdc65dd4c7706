"""Gates in front of the published tables."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def exclude(df: DataFrame, verdicts: DataFrame, key: str) -> DataFrame:
    """Rows whose key carries no excluding verdict."""
    return df.join(verdicts.select(key), key, "left_anti")


def review(signals: DataFrame, queues: dict[str, DataFrame]) -> DataFrame:
    """Signals none of whose keys waits for review; ``queues`` maps a column to its queue.

    One anti join per key, not one with OR: each stays a hash or merge join.
    """
    for key, queue in queues.items():
        waiting = queue.select(F.col(key).alias("_waiting"))
        signals = signals.join(waiting, signals[key] == F.col("_waiting"), "left_anti")
    return signals
