"""Links between documents and registries, and between commentary and documents."""

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docgraph.functions import text
from docgraph.plans import once, storage


def channel(docs: DataFrame, url: str, channels: DataFrame) -> DataFrame:
    """Issuer and region of a document from the host of its address."""
    return docs.withColumn("host", text.host(url)).join(channels, "host", "left")


def issuer_misses(docs: DataFrame, key: str, issuers: Column, aliases: DataFrame,
                  samples: int = 20) -> DataFrame:
    """Issuer strings no registry alias knows: how often, and the first documents.

    Documents are ranked only up to ``samples`` per string, which Spark limits before the shuffle.
    """
    from docgraph.operators import rank

    parts = docs.select(key, F.explode(issuers).alias("name")).select(
        key, text.blank_to_null("name").alias("name")).filter("name is not null")
    missed = parts.join(aliases.select(F.col("alias").alias("name")), "name",
                        "left_anti")
    counts = missed.groupBy("name").agg(F.count(F.lit(1)).alias("n"))
    first = rank.topk(missed.distinct(), ["name"], [F.col(key)], samples, "_rank")
    listed = first.groupBy("name").agg(F.sort_array(F.collect_list(key)).alias("documents"))
    return counts.join(listed, "name")


# -- dictionary tagging -------------------------------------------------------------------

#: Characters of a piece, or fewer for a shorter run.
PIECE = 3


def _pieces(c: Column, lengths: list[int]) -> Column:
    """The distinct stretches of characters of the given lengths (1 to ``PIECE``)."""
    cut = [F.regexp_extract_all(c, F.lit(rf"(?s)(?=(.{{{n}}}))"), F.lit(1)) for n in lengths]
    return F.array_distinct(F.concat(*cut))


#: Runs of an alias that are tried as its anchor, longest first; more would only be slower.
CANDIDATES = 4


def _runs(c: Column | str) -> Column:
    """What lies between blanks and line ends."""
    return F.split(F.replace(F.col(c) if isinstance(c, str) else c, F.lit("\n"), F.lit(" ")), " ")


def _candidates(aliases: DataFrame) -> DataFrame:
    """Runs (``_token``) of which every text that contains the alias has all: as a run of its own
    (``_whole``), or within one.

    The runs inside of an alias are whole in the text, the outer ones may be cut there. Those are taken
    where there are none inside; an alias of blanks lies within any run.
    """
    runs = _runs("alias")
    longest = lambda c: F.slice(F.sort_array(F.transform(F.filter(F.array_distinct(c), lambda w: w != ""), lambda w: F.struct(
        F.length(w).alias("n"), w.alias("w"))), asc=False), 1, CANDIDATES)["w"]
    inner = longest(F.slice(runs, F.lit(2), F.greatest(F.size(runs) - 2, F.lit(0))))
    outer = longest(F.array(runs[0], F.element_at(runs, -1)))
    outer = F.when(F.size(inner) > 0, F.array().cast("array<string>")).when(
        F.size(outer) == 0, F.array(F.lit(""))).otherwise(outer)
    marked = lambda c, whole: F.transform(c, lambda w: F.struct(w.alias("_token"), F.lit(whole).alias("_whole")))
    return aliases.select("*", F.inline(F.concat(marked(inner, True), marked(outer, False))))


def _within(runs: DataFrame, tokens: DataFrame) -> DataFrame:
    """Which of the distinct runs contain which token (``_token``), by the token's rarest piece."""
    starts = F.sequence(F.lit(1), F.greatest(F.length("_token") - (PIECE - 1), F.lit(1)))
    cut = storage.stored(tokens.filter("_token <> ''").select("_token", F.explode(F.array_distinct(F.transform(
        starts, lambda i: F.substring(F.col("_token"), i, F.lit(PIECE))))).alias("_piece")), "pieces")
    lengths = sorted(r[0] for r in cut.select(F.length("_piece")).distinct().collect())  # ``PIECE`` at most
    every = runs.crossJoin(tokens.filter("_token = ''"))
    if not lengths:
        return every
    pieces = storage.stored(runs.select("_run", "_n", F.explode(_pieces(F.col("_run"), lengths)).alias("_piece"))
                            .join(cut.select("_piece").distinct(), "_piece", "left_semi"), "met")
    rated = cut.join(pieces.groupBy("_piece").agg(F.count(F.lit(1)).alias("_many")), "_piece")
    best = storage.stored(rated.groupBy("_token").agg(F.min(F.struct("_many", "_piece"))["_piece"].alias("_piece")), "best")
    met = pieces.join(best, "_piece").filter(F.contains("_run", "_token"))
    return met.select("_run", "_n", "_token").unionByName(every)


def _asked(docs: DataFrame, content: str, aliases: DataFrame, entity: str) -> DataFrame:
    """The distinct runs of all texts that are or contain an alias's anchor, with these aliases
    (``_pairs``). The anchor is the candidate that occurs least often."""
    wanted = storage.stored(_candidates(aliases), "candidates")
    runs = storage.stored(docs.select(F.explode(_runs(content)).alias("_run")).groupBy("_run").agg(
        F.count(F.lit(1)).alias("_n")), "runs")
    tokens = lambda whole: wanted.filter(F.col("_whole") == whole).select("_token").distinct()
    same = runs.join(tokens(True).withColumn("_run", F.col("_token")), "_run").select("_run", "_n", "_token")
    inside = _within(runs, tokens(False))
    links = storage.stored(same.withColumn("_whole", F.lit(True)).unionByName(inside.withColumn("_whole", F.lit(False))), "links")
    counts = links.groupBy("_token", "_whole").agg(F.sum("_n").alias("_n"))
    # An alias of which a candidate occurs nowhere is nowhere; the others have all of them.
    rated = wanted.join(counts, ["_token", "_whole"], "left").withColumn("_n", F.coalesce("_n", F.lit(0)))
    anchors = rated.groupBy(entity, "alias").agg(F.min(F.struct("_n", "_token", "_whole")).alias("_best")).filter(
        "_best._n > 0").select(entity, "alias", "_best._token", "_best._whole")
    anchors = storage.stored(anchors, "anchors")
    # A run's list is as long as the registry at most.
    return storage.stored(links.join(anchors, ["_token", "_whole"]).groupBy("_run").agg(
        F.collect_list(F.struct(entity, "alias")).alias("_pairs")), "asked")


def present(docs: DataFrame, key: str, content: str, aliases: DataFrame, entity: str) -> DataFrame:
    """Registry aliases in texts: one row (``key``, ``content``, ``entity``, ``alias``) per document and
    alias that its text contains.

    Of an alias's runs the one that occurs least often in all texts is its anchor. Aliases are searched
    in the distinct runs of all texts; texts meet what was found there in an equi join of runs, and only
    these meetings are checked by a search in the text. Texts are shuffled at most once, and not at all
    where the meetings are few enough for Spark to broadcast. Where a script has no blanks, runs are as
    long as what lies between line ends, and there are as many as the texts have.
    """
    dim = aliases.select(entity, "alias").filter("length(alias) >= 1").distinct()
    asked = _asked(docs, content, dim, entity)
    met = docs.select(F.col(key).alias("_key"), F.explode(F.array_distinct(_runs(content))).alias("_run")).join(asked, "_run")
    # A document's list is as long as the registry at most.
    pairs = met.select("_key", F.explode("_pairs").alias("_pair")).groupBy("_key").agg(F.collect_set("_pair").alias("_pairs"))
    rows = docs.select(key, content).join(pairs, F.col(key).eqNullSafe(F.col("_key"))).select(
        key, content, F.inline("_pairs"))
    return rows.filter(F.contains(content, "alias"))


def mentions(docs: DataFrame, key: str, content: str, aliases: DataFrame, entity: str) -> DataFrame:
    """Registry aliases in texts: one row per document and alias with all its occurrences.

    ``aliases`` has the columns ``entity`` and ``alias`` (one character or more). ``hits`` lists
    position, snippet and location of every occurrence (not overlapping); ``pos``, ``snippet`` and
    ``location`` are those of the first, ``evidence_count`` is their number. Texts and aliases meet
    as in ``present``.
    """
    body, alias = F.col(content), F.col("alias")
    rows = once.computed(present(docs, key, content, aliases, entity), {"_at": _positions(body, alias), "_size": F.length(body)})
    width = F.length(alias)
    snippet = lambda pos: text.snippet_at(body, pos, width)
    place = lambda pos: text.location(pos, F.col("_size"))
    first = F.col("_at")[0]
    return rows.select(
        key, entity, "alias", first.cast("long").alias("pos"), F.size("_at").cast("long").alias("evidence_count"),
        snippet(first).alias("snippet"), place(first).alias("location"),
        F.transform("_at", lambda pos: F.struct(pos.cast("long").alias("pos"), snippet(pos).alias("snippet"),
                                                place(pos).alias("location"))).alias("hits"))


def _positions(body: Column, alias: Column) -> Column:
    """Where an alias begins in a text that contains it, from 1; occurrences do not overlap."""
    quoted = F.concat(F.lit(r"\Q"), F.replace(alias, F.lit(r"\E"), F.lit(r"\E\\E\Q")), F.lit(r"\E"))
    seen = lambda between: F.aggregate(
        F.slice(between, F.lit(1), F.size(between) - 1),
        F.struct(F.lit(1).alias("at"), F.array().cast("array<int>").alias("all")),
        lambda done, part: F.struct((done["at"] + F.length(part) + F.length(alias)).alias("at"),
                                    F.array_append(done["all"], done["at"] + F.length(part)).alias("all")))
    # The parts are bound to a lambda variable: named twice they would be split twice.
    return F.transform(F.array(F.split(body, quoted, -1)), seen)[0]["all"]


def numbers(docs: DataFrame, key: str, content: str, issuers: list[str] | None = None,
            mark: str = "mark") -> DataFrame:
    """Official numbers cited in texts, in the form of ``mentions``: a row per document and number.

    ``mark`` is the number in its normal form; spellings that mean the same number are one row.
    """
    body = F.col(content)
    rows = once.computed(docs.select(key, content), {"_raw": F.array_distinct(
        F.regexp_extract_all(body, F.lit(text.DOC_NUMBER), F.lit(1)))})
    rows = rows.select(key, content, F.explode("_raw").alias("alias"))
    rows = once.computed(rows, {mark: F.get(text.doc_numbers("alias", issuers), F.lit(0)), "_at": _positions(body, F.col("alias"))})
    width, size = F.length("alias"), F.length(body)
    hits = rows.filter(F.col(mark).isNotNull()).select(key, mark, F.transform("_at", lambda pos: F.struct(
        pos.cast("long").alias("pos"), text.snippet_at(body, pos, width).alias("snippet"),
        text.location(pos, size).alias("location"))).alias("hits"))
    # The spellings of a number in one text.
    one = hits.groupBy(key, mark).agg(F.sort_array(F.flatten(F.collect_list("hits"))).alias("hits"))
    first = F.col("hits")[0]
    return one.select(key, mark, F.col(mark).alias("alias"), first["pos"].alias("pos"), F.size("hits").cast("long").alias("evidence_count"),
                      first["snippet"].alias("snippet"), first["location"].alias("location"), "hits")


def occurrences(mention_rows: DataFrame, key: str, entity: str) -> DataFrame:
    """One row per occurrence: ``nth`` from 1, position, snippet, location."""
    return mention_rows.select(key, entity, "alias", F.posexplode("hits").alias("_i", "_hit")).select(
        key, entity, "alias", (F.col("_i") + 1).cast("long").alias("nth"), "_hit.*")


def tags(mention_rows: DataFrame, key: str, entity: str) -> DataFrame:
    """Multi-label tags: one row per document and entity with the number of hits."""
    return mention_rows.groupBy(key, entity).agg(F.sum("evidence_count").alias("hits"))


def primary(tag_rows: DataFrame, key: str, entity: str) -> DataFrame:
    """The entity with most hits, ties to the least entity, and the number of entities."""
    return tag_rows.groupBy(key).agg(
        F.min_by(entity, F.struct(-F.col("hits"), F.col(entity))).alias("primary"),
        F.count(F.lit(1)).alias("n_themes"), F.sum("hits").alias("hits"))


# -- fuzzy titles and the cascade ---------------------------------------------------------

def _segment(length: Column, i: int, distance: int) -> tuple[Column, Column]:
    """Where segment ``i`` of ``distance`` + 1 even ones begins (from 0), and its length."""
    parts = distance + 1
    short, wide = F.floor(length / parts).cast("int"), (length % parts).cast("int")
    longer = F.greatest(F.lit(0), F.lit(i - parts) + wide)
    size = F.when(F.lit(i) >= parts - wide, short + 1).otherwise(short)
    return short * i + longer, size


def _key(length: Column, i: int, title: Column, start: Column, size: Column) -> Column:
    return F.xxhash64(length, F.lit(i), F.substring(title, start + 1, size))


def _segments(title: Column, distance: int) -> Column:
    """The keys of a title's own segments."""
    n = F.length(title)
    cuts = [_segment(n, i, distance) for i in range(distance + 1)]
    return F.array_distinct(F.array(*[_key(n, i, title, start, size) for i, (start, size) in enumerate(cuts)]))


def _probes(title: Column, distance: int) -> Column:
    """The keys that a segment of any title within the distance would have.

    Of ``distance`` + 1 segments one stays whole, and not far from its place: if segment ``i`` is the
    first that does, at most ``i`` edits are before it and ``distance - i`` behind it.
    """
    keys = []
    n = F.length(title)
    for more in range(-distance, distance + 1):
        length = n - more  # of the other title
        for i in range(distance + 1):
            start, size = _segment(length, i, distance)
            for shift in range(-i, i + 1):
                if abs(shift - more) > distance - i:
                    continue
                at = start + shift
                inside = (length >= 0) & (at >= 0) & (at + size <= n)
                keys.append(F.when(inside, _key(length, i, title, at, size)))
    return F.array_distinct(F.array_compact(F.array(*keys)))


def fuzzy_title(left: DataFrame, right: DataFrame, distance: int = 2) -> DataFrame:
    """For each distinct title on the left the closest title on the right, ``distance`` at most.

    Titles on the right are cut into ``distance`` + 1 even segments. A title within the distance
    has one of them whole, near its place, so an equi join of segments with places finds all; the
    edit distance itself decides. The index has ``distance`` + 1 rows per title, and a title asks
    a number of times that does not depend on its length. Both sides need one column ``title``;
    equal titles are left to the exact match.
    """
    ask = left.select("title").filter("title is not null").distinct()
    give = right.select(F.col("title").alias("match")).filter("match is not null").distinct()
    asked = ask.select("title", F.explode(_probes(F.col("title"), distance)).alias("_key"))
    given = give.select("match", F.explode(_segments(F.col("match"), distance)).alias("_key"))
    pairs = asked.join(given, "_key").filter("title <> match")
    scored = pairs.withColumn("distance", F.levenshtein("title", "match", distance)).filter(
        "distance >= 0")
    return scored.groupBy("title").agg(F.min(F.struct("distance", "match")).alias("_best")).select(
        "title", "_best.match", "_best.distance")


def by_title(rows: DataFrame, key: str, title: str, registry: DataFrame, target: str,
             distance: int = 0) -> DataFrame:
    """A stage of the cascade: rows with the registry entry of the same title, or of the closest one
    within ``distance``; of entries with one title the least ``target``."""
    known = registry.filter(F.col(title).isNotNull()).groupBy(title).agg(F.min(target).alias("target"))
    if distance:
        near = fuzzy_title(rows.select(F.col(title).alias("title")), known.select(F.col(title).alias("title")), distance)
        known = near.join(known.withColumnRenamed(title, "match"), "match").select(
            F.col("title").alias(title), "target")
    return rows.join(known, title).select(key, "target")


def cascade(comments: DataFrame, key: str,
            stages: dict[str, Callable[[DataFrame], DataFrame]]) -> DataFrame:
    """Match in stages, cheapest first; a stage sees only what the stages before left over.

    Each stage maps the remaining rows to (key, target); the least target counts.
    """
    rest, found = comments, []
    for method, match in stages.items():
        hit = match(rest).groupBy(key).agg(F.min("target").alias("target"))
        hit = storage.stored(hit, "stage")  # read by every later stage and by the result
        found.append(hit.withColumn("method", F.lit(method)))
        rest = rest.join(hit.select(key), key, "left_anti")
    none = rest.select(key, F.lit(None).cast(found[0].schema["target"].dataType).alias("target"),
                       F.lit("none").alias("method"))
    return reduce(DataFrame.unionByName, [*found, none])


def covered(docs: DataFrame, facts: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """Documents with at least one fact, and those without."""
    keys = facts.select(key)
    return docs.join(keys, key, "left_semi"), docs.join(keys, key, "left_anti")
