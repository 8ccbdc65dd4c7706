"""Identity of documents: ids, collisions, aliases, recomputed fields."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docgraph.functions import fixed, text
from docgraph.plans import slices


def make_id(date: Column, issuer: Column, number: Column, title: Column) -> Column:
    """``P_<year>_<issuer>_<number or hash>``.

    No date gives the placeholder year. No number gives a hash of date and title, and no issuer
    gives OTHER with four hash digits, so that both stay stable when the row is read again.
    """
    day = F.coalesce(date.cast("string"), F.lit(""))
    seed = F.sha2(F.concat_ws("|", day, F.coalesce(title, F.lit(""))), 256)
    year = F.coalesce(F.year(date), F.lit(fixed.PLACEHOLDER_YEAR)).cast("string")
    who = F.coalesce(text.blank_to_null(issuer),
                     F.concat(F.lit("OTHER"), F.upper(F.substring(seed, 9, 4))))
    tail = F.coalesce(text.blank_to_null(number), F.substring(seed, 1, 8))
    return F.concat_ws("_", F.lit("P"), year, who, tail)


def number_tail(official_number: Column) -> Column:
    """The trailing number of an official document number."""
    return F.nullif(F.regexp_extract(official_number, r"(\d+)\s*号?\s*$", 1), F.lit(""))


def suffix(df: DataFrame, key: str, order: str, name: str = "unique_id") -> DataFrame:
    """Colliding ids get ``_a``, ``_b`` … by ``order`` (then ``_aa``); single ids stay."""
    ranked = slices.sliced(df, [key], [order], ordinal="_n", size="_size")
    index = F.col("_n") - 1
    letter = lambda i: F.char(F.lit(97) + i)
    # Letters count like spreadsheet columns; beyond two places the plain number keeps ids unique.
    tail = (F.when(index < 26, letter(index))
            .when(index < 702, F.concat(letter(F.floor(index / 26) - 1), letter(index % 26)))
            .otherwise(F.col("_n").cast("string")))
    plain = F.col(key).cast("string")
    unique = F.when(F.col("_size") == 1, plain).otherwise(F.concat_ws("_", plain, tail))
    return ranked.withColumn(name, unique).drop("_n", "_size")


def resolve(refs: DataFrame, ref: str, current: DataFrame, key: str, aliases: str) -> DataFrame:
    """Re-point references from former ids to current ids; unknown ids stay as they are.

    An alias that several entries claim is not unique, so it is left alone and counted.
    """
    alias = (current.select(key, F.explode(aliases).alias("_alias")).distinct()
             .groupBy("_alias").agg(F.min(key).alias("_current"),
                                    F.count(F.lit(1)).alias("_owners")))
    joined = refs.join(alias, refs[ref] == alias["_alias"], "left")
    ok = F.col("_owners") == 1
    return (joined.withColumn("resolved", F.coalesce(F.when(ok, F.col("_current")), F.col(ref)))
            .withColumn("status", F.when(F.col("_owners").isNull(), "unknown").when(~ok, "ambiguous")
                        .when(F.col("_current") == F.col(ref), "current").otherwise("moved"))
            .drop("_alias", "_current", "_owners"))


def recompute(df: DataFrame, field: str, candidates: dict[str, tuple[Column, float]],
              at: Column) -> DataFrame:
    """Replace a field by the first candidate found; keep old value, method, time, confidence."""
    tried = [F.when(value.isNotNull(), F.struct(value.alias("value"), F.lit(method).alias("method"),
                                                F.lit(conf).alias("confidence")))
             for method, (value, conf) in candidates.items()]
    rows = df.withColumn("_new", F.coalesce(*tried))
    changed = F.col("_new").isNotNull() & ~F.col("_new.value").eqNullSafe(F.col(field))
    return (rows
            .withColumn(f"{field}_fixed_from", F.when(changed, F.col(field)))
            .withColumn(f"{field}_fixed_method", F.when(changed, F.col("_new.method")))
            .withColumn(f"{field}_fix_confidence", F.when(changed, F.col("_new.confidence")))
            .withColumn(f"{field}_fixed_at", F.when(changed, at))
            .withColumn(field, F.when(changed, F.col("_new.value")).otherwise(F.col(field)))
            .drop("_new"))


def reidentify(df: DataFrame, key: str, aliases: str, new_id: Column, method: str, at: Column,
               confidence: float = 1.0) -> DataFrame:
    """Recompute the id; ``aliases`` then holds what it held, the former id and the current one.

    The audit columns of ``recompute`` tell what changed, how and when. Without a new id, or with
    the same, the id stays; it is listed among its aliases all the same.
    """
    before = df.withColumn("_former", F.col(key))
    rows = recompute(before, key, {method: (new_id, confidence)}, at)
    known = F.concat(F.coalesce(F.col(aliases), F.array().cast("array<string>")),
                     F.array("_former", key))
    return rows.withColumn(aliases, F.array_sort(F.array_distinct(F.array_compact(known)))).drop("_former")


def renamed(renames: DataFrame, old: str, new: str, at: str) -> DataFrame:
    """Former ids with their current one after any number of recomputes.

    ``renames`` are the audit rows (former id, id given, time); of several renames of one id the
    latest counts. Pointer doubling compresses the paths in a logarithmic number of joins.
    ``status`` is ``moved``, or ``cycle`` where ids lead in a circle; those have no current id.
    """
    from docgraph.operators import graph

    last = renames.filter(F.col(old).isNotNull() & F.col(new).isNotNull()).groupBy(F.col(old).alias("src")).agg(
        F.max_by(new, F.struct(at, new)).alias("dst")).withColumn("rel", F.lit("renamed"))
    paths = graph.lineage(last, None)
    return paths.select(F.col("node").alias("former"), F.col("root").alias("current"), F.col("depth").alias("steps"),
                        F.when(F.col("cyclic"), "cycle").otherwise("moved").alias("status"))


def with_former_ids(docs: DataFrame, key: str, aliases: str, paths: DataFrame) -> DataFrame:
    """Documents under their current ids, with all former ids of the way among ``aliases``."""
    sure = paths.filter("status = 'moved'")
    former = sure.groupBy("current").agg(F.collect_set("former").alias("_ways"))  # one document's ids
    rows = docs.join(sure.select(F.col("former").alias(key), F.col("current").alias("_now")), key, "left")
    rows = rows.withColumn(key, F.coalesce("_now", key)).join(
        former.withColumnRenamed("current", key), key, "left")
    empty = F.array().cast(docs.schema[aliases].dataType)
    known = F.concat(F.coalesce(F.col(aliases), empty), F.coalesce("_ways", empty), F.array(key))
    return rows.withColumn(aliases, F.array_sort(F.array_distinct(F.array_compact(known)))).select(docs.columns)
