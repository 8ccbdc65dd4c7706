"""Sharding by a hierarchical weighted hash tree.

Every shard hangs below a rack and a region. A document draws an exponential variate for every
shard, ``-ln(u) / weight``, from a hash of its id and the shard's name. The draw of a rack or a
region is the least draw below it, which is again exponential with the sum of the weights below.
A document descends to the region, the rack and the shard with the least draw. A changed weight
changes only that shard's draws, so a heavier or a new shard only takes documents into itself,
a lighter one only gives some away, and no other subtree exchanges documents.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docgraph.plans.once import computed
from docgraph.plans.slices import sliced


@dataclass(frozen=True)
class Leaf:
    region: int
    rack: int
    shard: int
    weight: float = 1.0


def topology(shards: int, per_rack: int = 4, racks: int = 2) -> list[Leaf]:
    """Shards 0 to n-1 of equal weight, filled rack by rack and region by region."""
    return [Leaf(s // (per_rack * racks), s // per_rack, s) for s in range(shards)]


def _draw(key: Column, leaf: Leaf) -> Column:
    bits = F.shiftrightunsigned(F.xxhash64(key, F.lit(f"shard {leaf.shard}")), 11)
    return -F.log((bits.cast("double") + 0.5) / F.lit(float(1 << 53))) / F.lit(leaf.weight)


def _least(choices: list[tuple[Column, int]]) -> Column:
    return F.array_min(F.array(*[F.struct(d.alias("d"), F.lit(i).alias("i"))
                                 for d, i in choices]))["i"]


def placed(df: DataFrame, key: str, leaves: list[Leaf], name: str) -> DataFrame:
    """Add ``name``, ``name_rack`` and ``name_region``.

    Shards of weight zero or less get nothing. A null key is a key like any other.
    """
    live = [x for x in leaves if x.weight > 0]
    if not live:
        raise ValueError("no shard has a weight")
    df = computed(df, {"_draws": F.array(*[_draw(F.col(key), x) for x in live])})
    at = {x: F.col("_draws")[i] for i, x in enumerate(live)}

    def lowest(own: list[Leaf]) -> Column:
        return F.least(*[at[x] for x in own]) if len(own) > 1 else at[own[0]]

    def level(own: list[Leaf], attr: str) -> list[tuple[Column, int]]:
        return [(lowest([x for x in own if getattr(x, attr) == i]), i)
                for i in sorted({getattr(x, attr) for x in own})]

    def within(parent: str, attr: str, column: str) -> Column:
        choice = None
        for i in sorted({getattr(x, parent) for x in live}):
            least = _least(level([x for x in live if getattr(x, parent) == i], attr))
            hit = F.col(column) == i
            choice = F.when(hit, least) if choice is None else choice.when(hit, least)
        return choice

    region, rack = f"{name}_region", f"{name}_rack"
    return (df.withColumn(region, _least(level(live, "region")))
            .withColumn(rack, within("region", "rack", region))
            .withColumn(name, within("rack", "shard", rack))
            .drop("_draws"))


def slots(df: DataFrame, shard: str, key: str, tie: list[str], rows: int = 65_536) -> DataFrame:
    """Number the rows of each shard from 0 without gaps, in tasks of about ``rows`` rows.

    The order is a hash bucket of the key, then the key, then ``tie``; equal rows are
    interchangeable. The number of buckets follows from the number of rows.
    """
    buckets = max(1, -(-df.count() // rows))
    df = df.withColumn("_bucket", F.pmod(F.xxhash64(key, *tie), F.lit(buckets)))
    out = sliced(df, [shard], ["_bucket", key, *tie], F.col("_bucket"), ordinal="slot")
    return out.withColumn("slot", F.col("slot") - 1).drop("_bucket")


def shards(docs: DataFrame, n: int = 16, id_col: str = "doc_id", text_col: str = "text",
           leaves: list[Leaf] | None = None, grown: list[Leaf] | None = None) -> DataFrame:
    """One row per document: doc_id, size, text_crc32, law, shard, slot, grown_shard, rack, region.

    ``grown_shard`` is the place after the change of the tree to ``grown`` (one more shard by
    default). Null texts count as empty, null ids share one place, repeated rows get slots of
    their own, an empty table gives an empty result. Other columns are not read.
    """
    leaves = leaves or topology(n)
    grown = grown or topology(n + 1)
    text = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    base = docs.select(F.col(id_col).cast("long").alias("doc_id"),
                       (F.length(text) + 1).cast("long").alias("size"),
                       F.crc32(text).alias("text_crc32"))
    out = placed(placed(base, "doc_id", leaves, "shard"), "doc_id", grown, "grown_shard")
    out = slots(out, "shard", "doc_id", ["text_crc32", "size"])
    return out.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot",
                      "grown_shard", F.col("shard_rack").alias("rack"),
                      F.col("shard_region").alias("region"))
