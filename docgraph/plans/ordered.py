"""Total orders over range partitions, for keys of any type that Spark can sort.

Rows are dealt out by ranges of the order, so that a hot key spreads over as many partitions as
its rows need, sorted within them and written once. What runs across partitions is computed from
one summary row per partition.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructType, VariantType

from docgraph.plans import storage

#: Place of a row: the partition in the upper bits, the row's number within it in the lower 33.
AT = "_at"
BITS = 33


def part() -> Column:
    """The partition of a row that ``laid`` has placed."""
    return F.shiftright(AT, BITS)


def _hashable(kind: DataType) -> bool:
    if isinstance(kind, StructType):
        return all(_hashable(f.dataType) for f in kind)
    if isinstance(kind, ArrayType):
        return _hashable(kind.elementType)
    return not isinstance(kind, (MapType, VariantType))


def laid(df: DataFrame, order: list[str | Column], name: str = "ordered",
         parts: int | None = None) -> DataFrame:
    """Write the rows in ``order`` and add ``_at``, which ascends along it without ties.

    Ties are settled by a hash of the row, so they split over partitions too; only rows that are
    equal in all columns stay together. The number of partitions is the session's number of
    shuffle partitions unless ``parts`` is given.
    """
    cols = [f"`{f.name}`" for f in df.schema if _hashable(f.dataType)]
    keys = [*order, F.xxhash64(*cols)] if cols else list(order)
    dealt = df.repartitionByRange(parts, *keys) if parts else df.repartitionByRange(*keys)
    rows = dealt.sortWithinPartitions(*keys).withColumn(AT, F.monotonically_increasing_id())
    return storage.stored(rows, name)


def numbered(df: DataFrame, order: list[str | Column], number: str, name: str = "ordered",
             parts: int | None = None) -> DataFrame:
    """Add ``number``, the place of every row in the whole order, from 0.

    The counts per partition are as many rows as there are shuffle partitions; they alone run
    through one task and are broadcast.
    """
    rows = laid(df, order, name, parts).withColumn("_part", part())
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = rows.groupBy("_part").agg(F.count(F.lit(1)).alias("_n")).select(
        "_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    place = F.col("_start") + F.col(AT).bitwiseAND(F.lit((1 << BITS) - 1))
    return rows.join(F.broadcast(starts), "_part").select(
        *[f"`{c}`" for c in df.columns], place.cast("long").alias(number))
