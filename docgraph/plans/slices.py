"""Ordered-group calculations that survive a group holding a third of all rows.

A plain ``Window.partitionBy(key)`` sends a whole group to one task. Here every group is cut
into slices along its order. Rows are shuffled by (key, slice); each slice is summarised to one
row, the summaries run through the window by key, and what they carry over the slice borders is
joined back by (key, slice), on which the rows already lie.

Slices are range partitions of (key, order), so they hold equal shares of the rows whatever the
types of the keys and however many rows share a key or a date; a group has at most as many slices
as there are shuffle partitions. A caller who knows a cheaper cut can give it.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docgraph.plans import ordered

SLICE = "_sl_key"


def sliced(df: DataFrame, keys: list[str], order: list[str], grain: Column | None = None, *,
           ordinal: str | None = None, size: str | None = None,
           previous: dict[str, str] | None = None, following: dict[str, str] | None = None,
           first: dict[str, str] | None = None,
           latest: tuple[Column, str] | None = None) -> DataFrame:
    """Window columns over ordered groups, any of them in one pass.

    Rows with a null key form a group, as in a window. Without ``grain`` rows are laid out by
    ranges of (keys, order) and ties are settled once and for all; a given ``grain`` must not
    decrease along ``order``, and the order then has to be unique.

    ordinal, size: names for the row number and the number of rows of the group.
    previous, following: columns of the row before or after, source to new name.
    first: columns of the first row of the group, source to new name.
    latest: a value and the name for its last non-null occurrence up to the row itself.
    """
    columns = df.columns
    if grain is None:
        df, order, grain = ordered.laid(df, [*keys, *order], "slices"), [ordered.AT], ordered.part()
    # One struct as key: structs with null fields compare as equal, so the join keeps them, and
    # the same column partitions the window, the summary and the join.
    rows = df.withColumn(SLICE, F.struct(*keys, grain.alias("_grain")))
    inside = Window.partitionBy(SLICE).orderBy(*order)
    group = Window.partitionBy(*[F.col(SLICE)[k] for k in keys])
    across = group.orderBy(F.col(SLICE)["_grain"])
    earlier = across.rowsBetween(Window.unboundedPreceding, -1)
    place = F.struct(*order)

    in_slice: dict[str, Column] = {}
    summary: dict[str, Column] = {}
    carried: dict[str, Column] = {}
    result: dict[str, Column] = {}

    if ordinal or size:
        summary["_sl_n"] = F.count(F.lit(1))
        if ordinal:
            in_slice["_sl_row"] = F.row_number().over(inside)
            carried["_sl_before"] = F.coalesce(F.sum("_sl_n").over(earlier), F.lit(0))
            result[ordinal] = (F.col("_sl_before") + F.col("_sl_row")).cast("long")
        if size:
            carried["_sl_size"] = F.sum("_sl_n").over(group)
            result[size] = F.col("_sl_size").cast("long")
    for tag, cols, near, edge, far in (
            ("p", previous, F.lag, F.max_by, F.lag), ("f", following, F.lead, F.min_by, F.lead)):
        if not cols:
            continue
        value = F.struct(*[F.col(c).alias(f"c{i}") for i, c in enumerate(cols)])
        in_slice[f"_sl_{tag}near"] = near(value).over(inside)
        summary[f"_sl_{tag}edge"] = edge(value, place)
        carried[f"_sl_{tag}far"] = far(f"_sl_{tag}edge").over(across)
        hit = F.coalesce(f"_sl_{tag}near", f"_sl_{tag}far")
        result.update({new: hit[f"c{i}"] for i, new in enumerate(cols.values())})
    if first:
        value = F.struct(*[F.col(c).alias(f"c{i}") for i, c in enumerate(first)])
        summary["_sl_first"] = F.min_by(value, place)
        carried["_sl_head"] = F.first("_sl_first").over(
            across.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
        result.update({new: F.col("_sl_head")[f"c{i}"] for i, new in enumerate(first.values())})
    if latest:
        value, name = latest
        rows = rows.withColumn("_sl_value", value)
        known = F.col("_sl_value").isNotNull()
        in_slice["_sl_lnear"] = F.last("_sl_value", ignorenulls=True).over(
            inside.rowsBetween(Window.unboundedPreceding, 0))
        summary["_sl_ledge"] = F.max_by("_sl_value", F.when(known, place))
        carried["_sl_lfar"] = F.last("_sl_ledge", ignorenulls=True).over(earlier)
        result[name] = F.coalesce("_sl_lnear", "_sl_lfar")

    carry = (rows.groupBy(SLICE).agg(*[c.alias(n) for n, c in summary.items()])
             .select(SLICE, *[c.alias(n) for n, c in carried.items()]))
    joined = rows.withColumns(in_slice).join(carry, SLICE)
    return joined.select(*columns, *[c.alias(n) for n, c in result.items()])
