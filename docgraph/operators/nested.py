"""Nested columns: flattening, wide and long forms, maps, JSON."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def flatten(df: DataFrame, struct: str | None = None, array: str | None = None) -> DataFrame:
    """Struct fields to columns named ``struct_field``, array items to rows."""
    if struct:
        fields = df.schema[struct].dataType.fieldNames()
        df = df.withColumns({f"{struct}_{f}": F.col(struct)[f] for f in fields}).drop(struct)
    if array:
        df = df.withColumn(array, F.explode_outer(array))
    return df


def scores_long(df: DataFrame, key: str, dims: list[str]) -> DataFrame:
    return df.unpivot(key, dims, "dimension", "score")


def scores_wide(df: DataFrame, key: str, dims: list[str]) -> DataFrame:
    return df.groupBy(key).agg(*[F.max(F.when(F.col("dimension") == d, F.col("score"))).alias(d)
                                 for d in dims])


def impact(df: DataFrame, key: str, column: str, allowed: list[str]) -> tuple[DataFrame, DataFrame]:
    """Rows per business line of a text map, and the keys that are not allowed."""
    rows = df.select(key, F.explode(column).alias("line", "content"))
    extra = F.array_except(F.map_keys(column), F.array(*[F.lit(a) for a in allowed]))
    return rows, df.select(key, F.explode(extra).alias("line"))


def shared(pairs: DataFrame, items: DataFrame, key: str, array: str) -> DataFrame:
    """Items both ends of a pair (``src``, ``dst``) have in common."""
    a = items.select(F.col(key).alias("src"), F.col(array).alias("_a"))
    b = items.select(F.col(key).alias("dst"), F.col(array).alias("_b"))
    both = pairs.join(a, "src").join(b, "dst")
    return both.withColumn("shared", F.array_sort(F.array_intersect("_a", "_b"))).drop("_a", "_b")


def parse(df: DataFrame, column: str, schema: StructType, name: str = "parsed") -> DataFrame:
    return df.withColumn(name, F.from_json(column, schema))


def dump(value: Column) -> Column:
    return F.to_json(value)
