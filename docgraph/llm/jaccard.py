"""N-gram Jaccard join by vertical partitioning.

All n-grams have one global order: n-grams that stand at the head of many sets come last, the
rest follow their hashes. A pair of sets that reaches the threshold shares an n-gram among the
first ones of each (the prefix filter), whatever the order is, so no link is lost. The order is
cut into fragments. For a candidate pair the overlap is counted in every fragment for itself, in
rows that hold one fragment of each set, and the partial counts are summed per pair.

Equal sets are one class from the start. In a group of many near copies the class with the
fewest unusual n-grams leads: the others are compared with it first. Classes that are still in
different components after that and share an n-gram of their prefixes are cut into more parts, by
hash, than a linked pair can differ in: linked sets agree in a whole part, so classes with an
equal part are candidates. Unlike sets seldom agree in one, however common their n-grams are.
Sizes and a 128-bit parity signature, from which the symmetric difference is bounded
from below, rule out most of them; a wide signature, as long as the set asks for, rules out most
of the others. For some rounds every class is compared with its nearest candidate only, which
joins a dense group without comparing all its pairs; then all candidates that are still in
different components are compared. If there are fewer of them than classes, all are at once.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docgraph.llm import kernel as K
from docgraph.llm.components import connected
from docgraph.llm.frames import each, pair
from docgraph.plans import storage

#: Fragments of the global order.
FRAGMENTS = 8
#: N-grams that are put last: how many, and from how many heads on. They only change the order.
LAST, HEADS = 1 << 17, 16
#: Bytes of text handled at once.
CHUNK = 1 << 19
#: Rounds in which every class is compared with its nearest candidate, before all others are.
ROUNDS = 2
#: Partners of one class that are compared with one copy of it.
CELL = 64
#: Least bits of the wide signature, by which pairs are tested before their fragments are counted;
#: larger sets have half as many bits as n-grams or more, a power of two.
BITS = 1024
#: Columns of the wide signature folded to 256 bits, by which candidates are tested where they meet.
FOLDED = tuple(f"w{i}" for i in range(4))
#: Pairs whose ids and row hashes are broadcast to fetch the texts (24 bytes each); with more, the
#: texts are shuffled.
FETCHED = 1 << 20


def _prefix(n: np.ndarray, num: int, den: int) -> np.ndarray:
    """Length of the prefix of a set of n for the threshold num/den."""
    return np.where(n > 0, n - -(-n * num // den) + 1, 0)


def _sets(chunk: K.Chunk, n: int) -> tuple[np.ndarray, np.ndarray]:
    return K.distinct(*K.grams(K.words(chunk), n, short=True))


def crowded(texts: DataFrame, n: int, num: int, den: int) -> np.ndarray:
    """The n-grams that stand in the prefixes (by hash) of many sets, at most LAST, in order.

    Batches report n-grams they meet twice or more, so the counts are low estimates. Any subset
    of n-grams gives right results; this one keeps common passages out of the prefixes.
    """

    def heads(batch):
        found = []
        for chunk in K.chunks(batch["text"], CHUNK):
            values, offsets = _sets(chunk, n)
            size = _prefix(np.diff(offsets), num, den)
            found.append(values[_runs(offsets[:-1], size)])
        gram, count = np.unique(np.concatenate(found) if found else np.zeros(0, K.U),
                                return_counts=True)
        often = count > 1
        yield {"gram": gram[often].view(np.int64), "n": count[often]}

    rows = (each(texts.select("text"), heads, "gram long, n long").groupBy("gram")
            .agg(F.sum("n").alias("n")).filter(F.col("n") >= HEADS)
            .orderBy(F.desc("n"), "gram").limit(LAST).select("gram").toArrow())
    return np.sort(rows["gram"].to_numpy().astype(np.int64).view(K.U))


def _runs(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    before = np.cumsum(lengths) - lengths
    return np.repeat(starts - before, lengths) + np.arange(int(lengths.sum()))


def members(texts: DataFrame, n: int, num: int, den: int) -> DataFrame:
    """Per document: doc_id, class (digest of the set), n_grams, usual (grams put last), the
    parity signature and the prefix."""
    last = crowded(texts, n, num, den)
    shared = texts.sparkSession.sparkContext.broadcast(last)

    def work(batch):
        last = shared.value
        for chunk in K.chunks(batch["text"], CHUNK):
            values, offsets = _sets(chunk, n)
            size = np.diff(offsets)
            doc = np.repeat(np.arange(chunk.n), size)
            late = np.zeros(len(values), bool)
            if len(last):
                at = np.minimum(np.searchsorted(last, values), len(last) - 1)
                late = last[at] == values
            order = np.lexsort((late, doc))  # stable: by hash within both parts
            lead = values[order][_runs(offsets[:-1], _prefix(size, num, den))]
            lead_at = np.concatenate(([0], np.cumsum(_prefix(size, num, den))))
            bit = (values >> K.U(40)) & K.U(127)
            parts = []
            for half in (0, 1):
                own = (bit >> K.U(6)) == half
                flat = np.bincount(doc[own] * 64 + (bit[own] & K.U(63)).astype(np.int64),
                                   minlength=chunk.n * 64).reshape(chunk.n, 64) & 1
                parts.append((flat.astype(K.U) << np.arange(64, dtype=K.U)).sum(axis=1, dtype=K.U))
            bits = np.maximum(BITS, 1 << np.ceil(np.log2(np.maximum(size, 2) / 2)).astype(np.int64))
            bits_at = np.concatenate(([0], np.cumsum(bits)))
            place = bits_at[doc] + (values >> K.U(20)).astype(np.int64) % bits[doc]
            odd = (np.bincount(place, minlength=bits_at[-1]) & 1).astype(np.uint8)
            wide = np.packbits(odd, bitorder="little").view("<i8")
            one = [K.sums(K.mixed(values ^ K.U(salt)).view(np.int64), offsets) for salt in (1, 2)]
            digest = np.stack(one, axis=1).astype("<i8")
            part = batch.slice(chunk.first, chunk.n)
            yield {"doc_id": part["doc_id"], "row": part["row"],
                   "class": [d.tobytes() if k else None for d, k in zip(digest, size)],
                   "n_grams": size, "usual": K.sums(late.astype(np.int64), offsets),
                   "s0": parts[0].view(np.int64), "s1": parts[1].view(np.int64),
                   "prefix": K.lists(lead, lead_at),
                   "wide": K.lists(wide, bits_at // 64)}

    return each(_keyed(texts), work, "doc_id long, row long, class binary, n_grams long, usual long, s0 long, "
                             "s1 long, prefix array<long>, wide array<long>")


def _possible(x: str, y: str, num: int, den: int, signs: tuple[str, ...] = ("s0", "s1")) -> Column:
    """Whether sizes and signatures leave room for a link of two rows."""
    nx, ny = F.col(f"{x}.n_grams"), F.col(f"{y}.n_grams")
    apart = F.lit(0)
    for s in signs:
        apart = apart + F.bit_count(F.col(f"{x}.{s}").bitwiseXOR(F.col(f"{y}.{s}")))
    return (den * F.least(nx, ny) >= num * F.greatest(nx, ny)) & _room(nx, ny, apart, num, den)


def _folded(wide: Column, i: int) -> Column:
    """The i-th 64 bits of a wide signature folded to the length of FOLDED."""
    return F.aggregate(F.filter(wide, lambda _, at: at % len(FOLDED) == i), F.lit(0).cast("long"),
                       lambda a, b: a.bitwiseXOR(b))


def _room(nx: Column, ny: Column, apart: Column, num: int, den: int) -> Column:
    """Whether sets whose symmetric difference has at least ``apart`` elements can be linked.

    |A n B| <= (|A| + |B| - apart) / 2, and a link needs (num + den) |A n B| >= num (|A| + |B|).
    """
    return (nx + ny - apart) * (num + den) >= 2 * num * (nx + ny)


def _bands(most: int, num: int, den: int) -> np.ndarray:
    """Least sizes of bands: the sizes of a linked pair lie in one band or in two that follow."""
    least = [1]
    while least[-1] <= most:
        least.append(den * least[-1] // num + 1)
    return np.array(least + [den * least[-1] // num + 1], np.int64)


def part_keys(values: np.ndarray, offsets: np.ndarray, num: int, den: int) -> tuple[np.ndarray, np.ndarray]:
    """Sets and keys such that any two linked sets share a key.

    A pair whose smaller set is in a band differs in d n-grams at most, so of m > d parts at least
    m - d are equal, and one of these is not empty if fewer than m - d parts of either set are.
    Sets with more empty parts also meet by their prefixes. A set has keys for its own band, and
    for the one below, in which a smaller partner may be.
    """
    size = np.diff(offsets)
    doc = np.repeat(np.arange(len(size)), size)
    least = _bands(int(size.max(initial=0)), num, den)
    apart = (least[1:-1] + least[2:] - 2) * (den - num) // (den + num)
    parts = apart + 1 + apart // 8
    own = np.searchsorted(least, size, "right") - 1
    content = K.mixed(values ^ K.U(3))
    owners, keys = [], []
    for band in (own, own - 1):
        fits = np.flatnonzero((size > 0) & (band >= 0))
        m = np.zeros(len(size), np.int64)
        m[fits] = parts[band[fits]]
        begin = np.concatenate(([0], np.cumsum(m)))
        inside = np.flatnonzero(m[doc])
        at = doc[inside]
        place = begin[at] + ((values[inside] >> K.U(20)) % m[at].astype(K.U)).astype(np.int64)
        sums = np.zeros(begin[-1], K.U)
        np.add.at(sums, place, content[inside])
        filled = np.bincount(place, minlength=begin[-1]) > 0
        owner = np.repeat(np.arange(len(size)), m)
        label = (band[owner].astype(K.U) << K.U(32)) + (np.arange(begin[-1]) - begin[owner]).astype(K.U)
        keys.append(K.mixed(sums ^ K.mixed(label + K.U(1)))[filled])
        owners.append(owner[filled])
        empty = m - np.bincount(owner[filled], minlength=len(size))
        bare = fits[empty[fits] >= m[fits] - apart[band[fits]]]
        length = _prefix(size[bare], num, den)
        head = values[_runs(offsets[:-1][bare], length)]
        owners.append(np.repeat(bare, length))
        keys.append(K.mixed(head ^ K.mixed((np.repeat(band[bare], length).astype(K.U) << K.U(32)) + K.U(0xFFFFFFFF))))
    return np.concatenate(owners), np.concatenate(keys)


def met(texts: DataFrame, open_: DataFrame, n: int, num: int, den: int) -> DataFrame:
    """Pairs (a, b) of classes of different components that can be linked.

    ``open_`` has the classes in question: id, row, component, n_grams and the signature FOLDED.
    """
    def cut(batch):
        for chunk in K.chunks(batch["text"], CHUNK):
            owner, key = part_keys(*_sets(chunk, n), num, den)
            part = batch.slice(chunk.first, chunk.n)
            at = pa.array(owner)
            yield {"key": key.view(np.int64), "id": part["id"].take(at), "component": part["component"].take(at)}

    own = open_.select("row", "id", "component")
    own = F.broadcast(own) if open_.count() <= FETCHED else own
    keys = storage.stored(each(_keyed(texts).join(own, "row").select("id", "component", "text"), cut,
                               "key long, id long, component long"), "parts")
    mixed = keys.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).filter(
        "lo < hi").select("key")
    about = open_.select("id", "n_grams", *FOLDED)
    shared = keys.join(mixed, "key").join(about, "id").select("key", F.struct(
        "id", "component", "n_grams", *FOLDED).alias("x"))
    return shared.join(shared.select("key", F.col("x").alias("y")), "key").filter(
        (F.col("x.id") < F.col("y.id")) & (F.col("x.component") != F.col("y.component"))
        & _possible("x", "y", num, den, FOLDED)).select(F.col("x.id").alias("a"), F.col("y.id").alias("b")).distinct()


def _apart(x: str, y: str) -> Column:
    """A lower bound of the symmetric difference, from two wide signatures.

    A place is a hash modulo the length, so the halves of a signature make the one of half its
    length. Lengths that are further apart tell nothing.
    """
    def folded(c, other):
        half = F.floor(F.size(c) / 2).cast("int")
        return F.when(F.size(c) <= F.size(other), F.col(c)).otherwise(F.zip_with(
            F.slice(c, F.lit(1), half), F.slice(c, half + 1, half), lambda a, b: a.bitwiseXOR(b)))

    odd = F.aggregate(F.zip_with(folded(x, y), folded(y, x), lambda a, b: F.coalesce(
        F.bit_count(a.bitwiseXOR(b)), F.lit(0))), F.lit(0), lambda n, v: n + v)
    small, large = F.least(F.size(x), F.size(y)), F.greatest(F.size(x), F.size(y))
    return F.when(large <= 2 * small, odd).otherwise(0)


def _near(pairs: DataFrame, classes: DataFrame, num: int, den: int) -> DataFrame:
    """The pairs of classes (a, b) that the wide signatures leave open: sizes na and nb, and
    ``apart``, the bound of the symmetric difference."""
    about = classes.select("id", "n_grams", "wide")
    pairs = pairs.join(about.toDF("a", "na", "wa"), "a").join(about.toDF("b", "nb", "wb"), "b")
    pairs = pairs.withColumn("apart", _apart("wa", "wb"))
    return storage.stored(pairs.filter(_room(F.col("na"), F.col("nb"), F.col("apart"), num, den))
                          .select("a", "b", "na", "nb", "apart"), "pairs")


def _overlaps(pairs: DataFrame, texts: DataFrame, classes: DataFrame, n: int, num: int,
              den: int) -> DataFrame:
    """Of pairs of classes (a, b) with their sizes, those that reach the threshold.

    The fragments of a travel to those of b. A class b with many partners is copied, once for
    every ``CELL`` of them, so that no task gets all partners of one class.
    """
    cells = storage.stored(pairs.groupBy("b").agg(
        F.ceil(F.count(F.lit(1)) / CELL).cast("long").alias("cells")), "cells")
    routes = pairs.select("a", "b").join(cells, "b").select(
        "a", "b", F.pmod(F.xxhash64("a"), "cells").alias("cell"))
    copies = cells.select("b", F.explode(F.sequence(F.lit(0).cast("long"), F.col("cells") - 1)).alias("cell"))
    small = pairs.count() <= FETCHED

    def bounded(df):
        return F.broadcast(df) if small else df  # at most one row of three numbers per pair

    def fragments(ids):
        own = bounded(ids.distinct().join(classes.select("id", "row"), "id"))
        return each(_keyed(texts).join(own, "row").select("id", "text"), cut,
                    "id long, fragment long, grams array<long>")

    def cut(batch):
        for chunk in K.chunks(batch["text"], CHUNK):
            values, offsets = _sets(chunk, n)
            doc = np.repeat(np.arange(chunk.n), np.diff(offsets))
            fragment = (values >> K.U(64 - FRAGMENTS.bit_length() + 1)).astype(np.int64)
            new = np.flatnonzero(np.concatenate(([True], (np.diff(doc) != 0) | (
                np.diff(fragment) != 0)))) if len(values) else np.zeros(0, int)
            part = batch["id"].slice(chunk.first, chunk.n)
            yield {"id": part.take(pa.array(doc[new])), "fragment": fragment[new],
                   "grams": K.lists(values, np.append(new, len(values)))}

    left = fragments(pairs.select(F.col("a").alias("id"))).toDF("a", "fragment", "x")
    right = fragments(pairs.select(F.col("b").alias("id"))).toDF("b", "fragment", "y")
    place = ["b", "cell", "fragment"]
    shared = (left.join(bounded(routes), "a").join(right.join(bounded(copies), "b"), place)
              .select("a", *place, F.size(F.array_intersect("x", "y")).alias("shared"))
              .groupBy("a", *place).agg(F.max("shared").alias("shared"))  # repeated rows
              .groupBy("a", "b").agg(F.sum("shared").alias("shared")))
    return (shared.join(pairs, ["a", "b"])
            .filter((num + den) * F.col("shared") >= num * (F.col("na") + F.col("nb")))
            .select("a", "b"))


def _keyed(texts: DataFrame) -> DataFrame:
    """Texts with a hash of id and text, by which the text of a class is fetched again."""
    return texts.select(F.xxhash64("doc_id", "text").alias("row"), "doc_id", "text")


def join(docs: DataFrame, n: int = 5, num: int = 4, den: int = 5, id_col: str = "doc_id",
         text_col: str = "text") -> DataFrame:
    """Per document: doc_id, n_shingles, component_id, class (null without words).

    Two documents are linked when den * |A n B| >= num * |A u B| for their sets of n-word
    shingles (with fewer than n words the whole sequence is the only one). component_id is the
    least id that links reach. Null and empty texts have no shingle, are linked with nothing and
    have their own id as component. Null ids count last; repeated rows are in one class; an
    empty table gives an empty result.
    """
    texts = pair(docs, id_col, text_col)
    rows = storage.stored(members(texts, n, num, den), "sets")
    sets = ["n_grams", "usual", "s0", "s1", "prefix", "wide"]
    classes = (rows.filter("class is not null").groupBy("class")
               .agg(F.min("doc_id").alias("least"), F.min("row").alias("row"),
                    *[F.first(c).alias(c) for c in sets])
               .withColumn("id", F.monotonically_increasing_id()))
    classes = storage.stored(classes, "classes")
    heads = classes.select("id", F.explode("prefix").alias("gram"))
    grams = heads.groupBy("gram").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("gram")
    about = classes.select("id", "n_grams", "s0", "s1",
                           (F.col("n_grams") - F.col("usual")).alias("unusual"))
    heads = storage.stored(heads.join(grams, "gram").join(about, "id"), "heads")
    lead = heads.groupBy("gram").agg(
        F.min(F.struct("unusual", "id", "n_grams", "s0", "s1")).alias("y"))

    led = heads.select("gram", F.struct("id", "n_grams", "s0", "s1").alias("x")).join(lead, "gram")
    # Every class is compared with the leader that it shares most heads with.
    first = (led.filter((F.col("x.id") != F.col("y.id")) & _possible("x", "y", num, den))
             .groupBy(F.col("x.id").alias("a"), F.col("y.id").alias("b"))
             .agg(F.count(F.lit(1)).alias("n"))
             .groupBy("a").agg(F.max_by("b", F.struct("n", -F.col("b"))).alias("b")))
    groups = connected(_overlaps(_near(first, classes, num, den), texts, classes, n, num, den))

    # Classes that share a head with a class of another component stay in play.
    own = heads.select("gram", "id").join(groups.toDF("id", "component"), "id", "left").select(
        "gram", "id", F.coalesce("component", "id").alias("component"))
    mixed = own.groupBy("gram").agg(F.min("component").alias("lo"),
                                    F.max("component").alias("hi")).filter("lo < hi").select("gram")
    apart = own.join(mixed, "gram").select("id", "component").distinct()
    signs = [_folded(F.col("wide"), i).alias(c) for i, c in enumerate(FOLDED)]
    apart = storage.stored(apart.join(classes.select("id", "row", "n_grams", *signs), "id"), "apart")
    open_ = _near(met(texts, apart, n, num, den), classes, num, den)
    many = classes.count()
    for turn in range(ROUNDS + 1):
        left, right = groups.toDF("a", "ca"), groups.toDF("b", "cb")
        open_ = storage.stored(open_.join(left, "a", "left").join(right, "b", "left").filter(
            F.coalesce("ca", "a") != F.coalesce("cb", "b")).drop("ca", "cb"), "open")
        left_over = open_.count()
        if not left_over:
            break
        chosen = open_
        if turn < ROUNDS and left_over > many:
            ends = open_.select("a", "b", "apart").unionByName(open_.select(
                F.col("b").alias("a"), F.col("a").alias("b"), "apart"))
            best = ends.groupBy("a").agg(F.min(F.struct("apart", "b")).alias("y")).select(
                F.least("a", "y.b").alias("a"), F.greatest("a", "y.b").alias("b")).distinct()
            chosen = storage.stored(open_.join(best, ["a", "b"]), "chosen")
        more = _overlaps(chosen, texts, classes, n, num, den)
        forest = groups.toDF("b", "a").select("a", "b")
        groups = connected(forest.unionByName(more))
        if chosen is open_:
            break
        open_ = open_.join(chosen.select("a", "b"), ["a", "b"], "left_anti")

    groups = groups.toDF("id", "component")
    labels = classes.select("class", "id", "least").join(groups, "id", "left").withColumn(
        "component", F.coalesce("component", "id"))
    least = labels.groupBy("component").agg(F.min("least").alias("component_id"))
    named = labels.join(least, "component").select("class", "component_id")
    return rows.join(named, "class", "left").select(
        "doc_id", F.col("n_grams").alias("n_shingles"),
        F.when(F.col("class").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
        .alias("component_id"), F.hex("class").alias("class"))
