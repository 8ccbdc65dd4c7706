"""Parallelism for inputs with fewer splits than cores."""

from pyspark.sql import DataFrame


def spread(scan: DataFrame) -> DataFrame:
    """Deal the rows of a plain scan out to all cores if it has fewer splits than cores.

    For heavy work per row, such as tokenising, on a file with few row groups. A table with as
    many splits as cores, which is every large one, is left as it is. Planning alone decides.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan if scan.rdd.getNumPartitions() >= cores else scan.repartition(cores)
