"""Candidate edges between documents.

None of these builds the pairs of a group. Where a document relates to all earlier documents of
its theme, the row names the nearest of them and counts the others, over a table aggregated to
days; so a theme with a third of all documents costs one row per day.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docgraph.functions import fixed
from docgraph.plans import once, slices, storage


REPEAL = "废止|失效|停止执行"


def references(mention_rows: DataFrame, src: str, mark: str, docs: DataFrame, dst: str,
               repeal: str = REPEAL) -> DataFrame:
    """Resolve cited marks to documents; ``docs`` has ``mark`` and ``dst``.

    ``repeals``: whether the snippet of any occurrence (``hits``), not only of the first, has a
    repeal marker; ``opening``, likewise, whether any lies in the opening of the text.
    """
    any_hit = lambda test: F.coalesce(F.max(F.exists("_hits", test)), F.lit(False))
    # The list is cut from the text, so it is made once for both tests.
    cited = once.computed(mention_rows, {"_hits": F.col("hits")}).groupBy(src, mark).agg(
        any_hit(lambda h: h["snippet"].rlike(repeal)).alias("repeals"),
        any_hit(lambda h: h["location"] == "opening").alias("opening"),
        F.sum("evidence_count").alias("evidence_count"), F.min("pos").alias("pos"),
        F.min_by("snippet", F.struct("pos", "snippet")).alias("evidence"),
        F.min_by("location", F.struct("pos", "snippet")).alias("location"))
    return (cited.join(docs.select(mark, dst), mark, "left")
            .withColumn("rel", F.lit("references"))
            .withColumn("resolved", F.col(dst).isNotNull()))


def supersedes(refs: DataFrame) -> DataFrame:
    """References of which a mention carries a repeal marker."""
    return refs.filter("repeals").withColumn("rel", F.lit("supersedes"))


def cites_basis(refs: DataFrame, verdicts: DataFrame, src: str, mark: str) -> DataFrame:
    """References in the opening, with the semantic verdict on the same edge where one exists.

    Several verdicts on an edge are one: the least.
    """
    given = verdicts.groupBy(src, mark).agg(F.min("semantic").alias("semantic"))
    return (refs.filter("opening").join(given, [src, mark], "left")
            .withColumn("rel", F.lit("cites_basis")))


def clarifies(docs: DataFrame, key: str, scope: str, stem: Column, detail: Column) -> DataFrame:
    """Detail rules and the document they detail: same stem of the title, same scope.

    Several candidates are one row: the least key, and how many there are.
    """
    rows = docs.select(key, scope, stem.alias("stem"), detail.alias("_detail"))
    bases = rows.filter(~F.col("_detail")).groupBy(scope, "stem").agg(
        F.min(key).alias("dst"), F.count(F.lit(1)).alias("candidates"))
    return (rows.filter("_detail").join(bases, [scope, "stem"])
            .select(F.col(key).alias("src"), "dst", scope, "stem", "candidates"))


def iterates(docs: DataFrame, key: str, blocks: list[str], title: str, date: str,
             distance: int = 5) -> DataFrame:
    """Each document and the one before it with the same title stem and issuer."""
    chained = slices.sliced(docs, blocks, [date, key], previous={key: "dst", title: "_before", date: "dst_date"})
    near = once.computed(chained.filter("dst is not null"),
                         {"distance": F.levenshtein(title, "_before", distance)})
    return (near.filter("distance >= 0")
            .select(F.col(key).alias("src"), "dst", F.col(date).alias("src_date"), "dst_date",
                    "distance"))


def extends(docs: DataFrame, key: str, theme: str, level: str, date: str, levels: int = 4) -> DataFrame:
    """Wider documents with the nearest earlier narrower one on the theme (pilot to general).

    Level 0 is the widest. ``earlier`` counts all earlier narrower documents.
    """
    inner = range(1, levels)
    days = docs.groupBy(theme, date).agg(
        *[F.max(F.when(F.col(level) >= n, F.struct(F.col(date), F.col(key)))).alias(f"_last{n}")
          for n in inner],
        *[F.count_if(F.col(level) >= n).alias(f"_n{n}") for n in inner])
    before = Window.partitionBy(theme).orderBy(date).rowsBetween(Window.unboundedPreceding, -1)
    prior = days.select(
        theme, date,
        F.array(*[F.last(f"_last{n}", ignorenulls=True).over(before) for n in inner]).alias("_last"),
        F.array(*[F.sum(f"_n{n}").over(before) for n in inner]).alias("_count"))
    rows = docs.filter(F.col(level) < levels - 1).join(prior, [theme, date])
    near = F.get("_last", F.col(level))
    return rows.select(
        theme, F.col(key).alias("src"), near[key].alias("dst"), F.col(date).alias("src_date"),
        near[date].alias("dst_date"), F.get("_count", F.col(level)).alias("earlier")
    ).filter("dst is not null")


def aligns(docs: DataFrame, key: str, theme: str, issuer: str) -> DataFrame:
    """Documents with documents of other issuers on the theme: how many, and the first.

    Works on one row per (theme, issuer): the first document of another issuer is the theme's
    first, or the first of the second issuer where the theme's first is one's own.
    """
    cells = docs.groupBy(theme, issuer).agg(F.count(F.lit(1)).alias("_own"), F.min(key).alias("_first"))
    order = Window.partitionBy(theme).orderBy("_first", issuer)
    ranked = cells.withColumn("_rank", F.row_number().over(order)).filter("_rank <= 2")
    tops = ranked.groupBy(theme).agg(
        F.max(F.when(F.col("_rank") == 1, F.struct(issuer, "_first"))).alias("_one"),
        F.max(F.when(F.col("_rank") == 2, F.struct(issuer, "_first"))).alias("_two"))
    totals = cells.groupBy(theme).agg(F.sum("_own").alias("_all"))
    sides = cells.select(theme, issuer, "_own").join(tops.join(totals, theme), theme)
    other = F.when(F.col("_one")[issuer] == F.col(issuer), F.col("_two._first")).otherwise(
        F.col("_one._first"))
    sides = sides.select(theme, issuer, other.alias("dst"), (F.col("_all") - F.col("_own")).alias("aligned"))
    return (docs.select(F.col(key).alias("src"), theme, issuer)
            .join(sides, [theme, issuer]).filter("dst is not null"))


def aligns_centroid(vectors: DataFrame, key: str, theme: str, vector: str, threshold: float) -> DataFrame:
    """Documents whose vector lies close to their theme's mean vector (cosine).

    Means are aggregated by (theme, dimension); the table of means is one row per theme.
    """
    parts = vectors.select(theme, F.posexplode(vector).alias("_d", "_x"))
    means = parts.groupBy(theme, "_d").agg(F.avg(F.col("_x").cast("double")).alias("_m"))
    centroid = means.groupBy(theme).agg(
        F.transform(F.sort_array(F.collect_list(F.struct("_d", "_m"))), lambda s: s["_m"]).alias("_c"))
    total = lambda arr: F.aggregate(arr, F.lit(0.0), lambda a, x: a + x)
    rows = vectors.join(centroid, theme).withColumn(
        "_v", F.transform(vector, lambda x: x.cast("double")))
    dot = total(F.zip_with("_v", "_c", lambda a, b: a * b))
    norm = lambda c: F.sqrt(total(F.transform(c, lambda x: x * x)))
    return rows.select(key, theme, (dot / (norm("_v") * norm("_c"))).alias("cosine")).filter(
        F.col("cosine") >= threshold)


def conflict_pairs(docs: DataFrame, key: str, theme: str, date: str, score: str, stance: str,
                   floor: int = 4) -> DataFrame:
    """High-scoring documents against the nearest one before them on the theme with another stance.

    ``earlier`` is the number of earlier high-scoring documents of the theme with another stance,
    that is the size of the full candidate list of the row. Documents without stance take no part.
    The nearest one of another stance is the one just before the own run of equal stances.
    """
    top = storage.stored(docs.select(key, theme, date, score, stance).filter(
        (F.col(score) >= floor) & F.col(stance).isNotNull()), "top")  # read several times below
    place = slices.sliced(top, [theme], [date, key], ordinal="_n",
                          previous={key: "_key", stance: "_stance"})
    turn = F.when(F.col("_stance") != F.col(stance), F.struct("_key", "_stance"))
    place = slices.sliced(place, [theme], [date, key], latest=(turn, "_other"))
    place = slices.sliced(place, [theme, stance], [date, key], ordinal="_own")
    return place.filter("_other is not null").select(
        theme, F.col(key).alias("src"), F.col("_other._key").alias("dst"),
        F.col(stance).alias("src_stance"), F.col("_other._stance").alias("dst_stance"),
        (F.col("_n") - F.col("_own")).alias("earlier"))


def derives(docs: DataFrame, sources: DataFrame, key: str, theme: str, date: str,
            lag: tuple[int, int] = (180, 365)) -> DataFrame:
    """Documents with the sources dated ``lag`` days before them, and those of the same month.

    Sources of the same month count as parallel, never as an origin; a document that is itself a
    source is not its own parallel. Per day of a theme the sources are summarised once; the band
    is a range frame over those days. Undated documents have neither.
    """
    given = sources.select(theme, F.to_date(date).alias("_day"), F.col(key).alias("_src"))
    asked = docs.select(theme, F.to_date(date).alias("_day"),
                        F.lit(None).cast(given.schema["_src"].dataType).alias("_src"))
    days = asked.unionByName(given).filter("_day is not null").groupBy(theme, "_day").agg(
        F.count("_src").alias("_n"), F.min("_src").alias("_first"), F.max("_src").alias("_last"))
    days = days.withColumn("_num", F.datediff("_day", F.lit("1970-01-01").cast("date")))
    seen = F.when(F.col("_n") > 0, F.col("_num"))
    band = Window.partitionBy(theme).orderBy("_num").rangeBetween(-lag[1], -lag[0])
    month = Window.partitionBy(theme, F.trunc("_day", "month"))
    found = days.select(
        theme, "_day", F.sum("_n").over(band).alias("origins"),
        F.min_by("_first", seen).over(band).alias("first_origin"),
        F.max_by("_last", seen).over(band).alias("last_origin"),
        F.sum("_n").over(month).alias("_month"))
    # A source's own rows in its month: one row per source, so the join adds none.
    own = given.withColumn("_start", F.trunc("_day", "month")).filter("_start is not null").groupBy(
        theme, "_start", F.col("_src").alias(key)).agg(F.count(F.lit(1)).alias("_own"))
    rows = docs.withColumn("_day", F.to_date(date)).withColumn("_start", F.trunc("_day", "month"))
    rows = rows.join(found, [theme, "_day"], "left").join(own, [theme, "_start", key], "left")
    return rows.select(
        F.col(key).alias("src"), theme, F.coalesce("origins", F.lit(0)).alias("origins"),
        "first_origin", "last_origin",
        (F.coalesce("_month", F.lit(0)) - F.coalesce("_own", F.lit(0))).alias("parallel"))


#: Columns that edges of every relation share.
EDGE = ["src", "dst", "rel", "evidence", "confidence", "source", "detail"]


def edge_table(parts: dict[str, DataFrame], src: str = "src", dst: str = "dst",
               confidence: dict[str, float] | None = None, source: dict[str, str] | None = None) -> DataFrame:
    """The edges of all relations under common columns; ids become texts.

    ``evidence`` is taken from a part that has it, else null; what else a relation has goes to
    ``detail`` as JSON. ``confidence`` and ``source`` (how the edge was found) are given per relation.
    Several rows of one edge are one: that with evidence first, then the least. Edges without target
    are unresolved and belong to the backlog. Write the result with ``sink.rewrite`` by ``rel``.
    """
    out = None
    for rel, df in parts.items():
        rest = [F.col(f"`{c}`") for c in df.columns if c not in (src, dst, "rel", "evidence")]
        own = df.filter(F.col(dst).isNotNull() & F.col(src).isNotNull()).select(
            F.col(src).cast("string").alias("src"), F.col(dst).cast("string").alias("dst"), F.lit(rel).alias("rel"),
            (F.col("evidence") if "evidence" in df.columns else F.lit(None)).cast("string").alias("evidence"),
            F.lit((confidence or {}).get(rel)).cast("double").alias("confidence"),
            F.lit((source or {}).get(rel)).cast("string").alias("source"),
            (F.to_json(F.struct(*rest)) if rest else F.lit(None)).cast("string").alias("detail"))
        out = own if out is None else out.unionByName(own)
    order = F.struct(F.col("evidence").isNull(), "evidence", "detail")
    best = out.groupBy("src", "dst", "rel").agg(F.min_by(F.struct(*EDGE[3:]), order).alias("_row"))
    return best.select("src", "dst", "rel", "_row.*")


def linkage_class(df: DataFrame, column: str, classes: dict[str, str] | None = None) -> DataFrame:
    """Old link labels to evidence classes; unknown labels become null."""
    pairs = F.create_map(*[F.lit(x) for p in (classes or fixed.LINKAGE_CLASSES).items() for x in p])
    return df.withColumn("evidence_class", F.try_element_at(pairs, F.col(column)))
