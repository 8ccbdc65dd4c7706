"""Toxicity by the nearest labelled examples.

A bounded sample of labelled documents is the index. Its vocabulary are the words that tell the
labels apart (chi-square), its vectors are TF-IDF weights of unit length. The inverted index
keeps, for every word and block of examples, the largest weight; a document's upper bound per
block is the sum of its weights times these. Blocks are scored in the order of their bounds until
the bound of the next one is below the k-th best cosine, so the k nearest examples are exact.
Their votes, weighted by squared cosine, are calibrated on labelled documents outside the index.
The neighbours are the evidence.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docgraph.llm import kernel as K
from docgraph.llm.decontaminate import SPLIT
from docgraph.llm.frames import each, pair
from docgraph.plans import storage

#: Bounds of the sample of labelled rows, by label, and of the vocabulary.
SAMPLE = {1: 1_500, 0: 4_500}
FEATURES = 512
#: Least chi-square of a word (by example, and at all), and least number of examples that have it.
CHI, CHI_AT_ALL, DOCUMENTS = 0.002, 10.83, 5
#: Bytes of text whose documents are scored side by side.
CHUNK = 1 << 19
NEAREST, BLOCK = 15, 128
#: Mass of the prior in a vote.
PRIOR = 0.05


def fold(id_col: Column) -> Column:
    """crc32 of the id as text, modulo 5; a null id counts as an empty text."""
    return (F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")) % 5).cast("int")


def _terms(chunk: K.Chunk) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct words of every document (hashes), how often, and offsets."""
    w = K.words(chunk, split=SPLIT, fold=None)
    terms, counts, sizes = [], [], np.zeros(chunk.n + 1, np.int64)
    for d in range(chunk.n):
        t, n = np.unique(w.hash[w.first[d]:w.first[d + 1]], return_counts=True)
        terms.append(t)
        counts.append(n)
        sizes[d + 1] = len(t)
    return np.concatenate(terms), np.concatenate(counts), np.cumsum(sizes)


def _chunks(column: pa.Array):
    return K.chunks(pc.utf8_lower(column), CHUNK)


def sample(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str, label_col: str):
    """Texts of the sampled labelled rows of folds 1 to 4, and the number of rows per label."""
    known = (labels.select(F.col(id_col).cast("long").alias("doc_id"),
                           F.col(label_col).cast("int").alias("y"))
             .filter("doc_id is not null and y in (0, 1)").withColumn("fold", fold(F.col("doc_id")))
             .filter("fold <> 0").groupBy("doc_id", "fold").agg(F.max("y").alias("y")))
    rows = {r["y"]: r["n"] for r in known.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    taken = None
    for y, n in SAMPLE.items():
        part = known.filter(F.col("y") == y).orderBy(F.xxhash64("doc_id"), "doc_id").limit(n)
        taken = part if taken is None else taken.unionByName(part)
    texts = pair(docs, id_col, text_col).join(F.broadcast(taken), "doc_id")
    return storage.stored(texts.select("doc_id", "text", "fold", "y"), "labelled"), rows


def vocabulary(examples: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the telling words in order, and the chi-square of each; folds 2 to 4 only."""

    def work(batch):
        y = batch["y"].to_numpy()
        for chunk in _chunks(batch["text"]):
            terms, _, offsets = _terms(chunk)
            own = np.repeat(y[chunk.first:chunk.first + chunk.n], np.diff(offsets))
            seen, at = np.unique(terms, return_inverse=True)
            yield {"term": seen.view(np.int64), "n1": np.bincount(at, own, len(seen)).astype(int),
                   "n": np.bincount(at, minlength=len(seen))}

    train = examples.filter("fold <> 1")
    size = train.agg(F.sum("y").alias("n1"), F.count(F.lit(1)).alias("n")).first()
    n, n1 = size["n"], size["n1"] or 0
    if not 0 < n1 < n:
        return np.zeros(0, K.U), np.zeros(0)
    count = (each(train.select("text", "y"), work, "term long, n1 long, n long")
             .groupBy("term").agg(F.sum("n1").alias("a"), F.sum("n").alias("m"))
             .filter((F.col("m") >= DOCUMENTS) & (F.col("m") < n)))
    a, m = F.col("a").cast("double"), F.col("m").cast("double")
    chi = (n * F.pow(a * (n - n1) - (m - a) * n1, 2)) / (m * (n - m) * n1 * (n - n1))
    best = (count.withColumn("chi", chi).filter(F.col("chi") >= max(CHI * n, CHI_AT_ALL))
            .orderBy(F.desc("chi"), "term").limit(FEATURES).toPandas())
    terms = best["term"].to_numpy(np.int64).view(K.U)
    order = np.argsort(terms)
    return terms[order], best["chi"].to_numpy(float)[order]


def _features(chunk: K.Chunk, vocab: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places in the vocabulary, 1 + ln(tf), and offsets, per document."""
    terms, counts, offsets = _terms(chunk)
    if not len(vocab):
        return np.zeros(0, np.int64), np.zeros(0), np.zeros(chunk.n + 1, np.int64)
    at = np.minimum(np.searchsorted(vocab, terms), len(vocab) - 1)
    hit = vocab[at] == terms
    inside = np.concatenate(([0], np.cumsum(hit)))
    return at[hit], 1 + np.log(counts[hit]), inside[offsets]


def _spread(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """starts[0], starts[0]+1, ... for every run, end to end."""
    before = np.cumsum(lengths) - lengths
    return np.repeat(starts - before, lengths) + np.arange(int(lengths.sum()))


@dataclass
class Index:
    """Examples in blocks: postings by word and block, block maxima, ids and labels."""

    vocab: np.ndarray
    idf: np.ndarray
    cells: np.ndarray  # offsets of the postings of (word, block)
    example: np.ndarray
    weight: np.ndarray
    maxima: np.ndarray  # words x blocks
    ids: np.ndarray
    y: np.ndarray

    def unit(self, place: np.ndarray, tf: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """TF-IDF weights of unit length per document."""
        q = tf * self.idf[place]
        norm = np.sqrt(K.sums(q * q, offsets))
        return q / np.repeat(np.where(norm > 0, norm, 1.0), np.diff(offsets))

    def _cosines(self, chosen: np.ndarray, place: np.ndarray, q: np.ndarray, offsets: np.ndarray):
        """Exact cosines of every document with all examples of its chosen blocks."""
        doc, block = np.nonzero(chosen)
        count = chosen.sum(axis=1)
        first = np.cumsum(count) - count
        owner = np.repeat(np.arange(len(count)), np.diff(offsets))
        term = np.repeat(np.arange(len(place)), count[owner])
        pair = _spread(first[owner], count[owner])
        cell = place[term] * chosen.shape[1] + block[pair]
        size = self.cells[cell + 1] - self.cells[cell]
        at = _spread(self.cells[cell], size)
        target = np.repeat(pair, size) * BLOCK + self.example[at] % BLOCK
        score = np.bincount(target, self.weight[at] * np.repeat(q[term], size), len(doc) * BLOCK)
        hit = np.flatnonzero(score)
        return doc[hit // BLOCK], block[hit // BLOCK] * BLOCK + hit % BLOCK, np.round(score[hit], 9)

    def nearest(self, place: np.ndarray, tf: np.ndarray, offsets: np.ndarray, k: int = NEAREST):
        """The k examples with the largest positive cosine of every document (ties: the first):
        documents, examples and cosines, in order."""
        n = len(offsets) - 1
        q = self.unit(place, tf, offsets)
        if not len(place) or not len(self.y):
            return np.zeros(0, int), np.zeros(0, int), np.zeros(0)
        total = np.vstack((np.zeros(self.maxima.shape[1]),
                           np.cumsum(self.maxima[place] * q[:, None], axis=0)))
        bound = total[offsets[1:]] - total[offsets[:-1]]
        positive = bound > 1e-12
        ahead = np.zeros_like(positive)
        best = np.argsort(-bound, axis=1, kind="stable")[:, :2]
        np.put_along_axis(ahead, best, True, axis=1)
        one = self._cosines(ahead & positive, place, q, offsets)
        order = np.lexsort((one[1], -one[2], one[0]))
        begin = np.searchsorted(one[0][order], np.arange(n + 1))
        theta = np.zeros(n)
        full = np.diff(begin) >= k
        theta[full] = one[2][order][begin[:-1][full] + k - 1]
        rest = positive & ~ahead & (bound >= theta[:, None] - 1e-8)
        two = self._cosines(rest, place, q, offsets)
        doc, example, cosine = (np.concatenate(x) for x in zip(one, two))
        order = np.lexsort((example, -cosine, doc))
        doc, example, cosine = doc[order], example[order], cosine[order]
        rank = np.arange(len(doc)) - np.searchsorted(doc, doc)
        keep = (rank < k) & (cosine > 0)
        return doc[keep], example[keep], cosine[keep]


def indexed(vocab: np.ndarray, vectors: list[tuple[int, int, np.ndarray, np.ndarray]]) -> Index:
    """An index of (id, label, places, tf) examples; like examples lie in the same blocks."""
    vectors = sorted((v for v in vectors if len(v[2])),
                     key=lambda v: (v[1], int(v[2][0]), len(v[2]), v[0]))
    n = len(vectors)
    df = np.bincount(np.concatenate([v[2] for v in vectors]) if n else np.zeros(0, int),
                     minlength=len(vocab))
    idf = np.log((n + 1) / (df + 0.5))
    rows = []
    for i, (_, _, place, tf) in enumerate(vectors):
        q = tf * idf[place]
        rows.append((place, np.full(len(place), i), q / max(np.sqrt((q * q).sum()), 1e-12)))
    place, example, weight = ((np.concatenate(x) for x in zip(*rows)) if rows else
                              (np.zeros(0, int), np.zeros(0, int), np.zeros(0)))
    order = np.lexsort((example, place))
    place, example, weight = place[order], example[order], weight[order]
    blocks = -(-n // BLOCK)
    maxima = np.zeros((len(vocab), blocks))
    np.maximum.at(maxima, (place, example // BLOCK), weight)
    cells = np.searchsorted(place * blocks + example // BLOCK, np.arange(len(vocab) * blocks + 1))
    return Index(vocab, idf, cells, example, weight, maxima, np.array([v[0] for v in vectors], np.int64),
                 np.array([v[1] for v in vectors], np.int64))


def votes(index: Index, place: np.ndarray, tf: np.ndarray, offsets: np.ndarray):
    """The weighted share of toxic neighbours per document, and the neighbours."""
    n = len(offsets) - 1
    doc, example, cosine = index.nearest(place, tf, offsets)
    weight = cosine ** 2
    toxic = np.bincount(doc, weight * index.y[example], n) if len(doc) else np.zeros(n)
    return toxic / (np.bincount(doc, weight, n) + PRIOR), (doc, example, cosine)


def isotonic(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Knots of the increasing step function nearest to (x, y), to be interpolated."""
    order = np.argsort(x, kind="stable")
    blocks: list[list[float]] = []  # weight, sum of y, sum of x
    for a, b, c in zip(x[order], y[order], w[order]):
        blocks.append([c, c * b, c * a])
        while len(blocks) > 1 and blocks[-2][1] * blocks[-1][0] >= blocks[-1][1] * blocks[-2][0]:
            last = blocks.pop()
            blocks[-1] = [p + q for p, q in zip(blocks[-1], last)]
    total = np.array(blocks)
    mass = total[:, 0] + 0.02
    return total[:, 2] / total[:, 0], np.clip((total[:, 1] + 0.01) / mass, 0.0, 1.0)


@dataclass
class Model:
    index: Index
    knots: tuple[np.ndarray, np.ndarray]

    def score(self, votes: np.ndarray) -> np.ndarray:
        """Calibrated probability, with a slight slope so that larger votes stay larger."""
        flat = np.interp(votes, *self.knots)
        return np.clip(0.999 * flat + 0.001 * votes, 0.0, 1.0)


def fitted(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
           label_col: str = "toxic") -> Model:
    """Index (folds 2 to 4) and calibration (fold 1) from the labelled rows outside fold 0."""
    examples, rows = sample(docs, labels, id_col, text_col, label_col)
    vocab, _ = vocabulary(examples)

    def vectors(batch):
        for chunk in _chunks(batch["text"]):
            place, tf, offsets = _features(chunk, vocab)
            part = batch.slice(chunk.first, chunk.n)
            yield {"doc_id": part["doc_id"], "fold": part["fold"], "y": part["y"],
                   "place": K.lists(place, offsets), "tf": K.lists(tf, offsets, pa.float64())}

    got = each(examples, vectors, "doc_id long, fold int, y int, place array<long>, tf array<double>")
    got = [(r["doc_id"], r["y"], np.array(r["place"], int), np.array(r["tf"]), r["fold"])
           for r in got.collect()]
    index = indexed(vocab, [r[:4] for r in got if r[4] != 1])
    taken = {y: sum(1 for r in got if r[1] == y) for y in (0, 1)}
    held = [r for r in got if r[4] == 1]
    if not held:
        rate = rows.get(1, 0) / max(1, sum(rows.values()))
        return Model(index, (np.array([0.0, 1.0]), np.array([rate, max(rate, 0.9)])))
    offsets = np.cumsum([0] + [len(r[2]) for r in held])
    x = np.zeros(len(held))
    for a in range(0, len(held), 200):
        own = offsets[a:a + 201]
        place, tf = (np.concatenate([r[c] for r in held[a:a + 200]]) for c in (2, 3))
        x[a:a + 200] = votes(index, place, tf, own - own[0])[0]
    y = np.array([float(r[1]) for r in held])
    w = np.array([rows[r[1]] / taken[r[1]] for r in held])
    return Model(index, isotonic(x, y, w))


def scored(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
           label_col: str = "toxic") -> DataFrame:
    """doc_id, held_out, score, predicted and the neighbours (doc_id, label, cosine).

    Null and empty texts and texts without a telling word have no neighbours and get the score of
    such texts. Without labels of both kinds every score is the rate of label 1. Repeated rows
    are scored alike; an empty table gives an empty result.
    """
    shared = docs.sparkSession.sparkContext.broadcast(
        fitted(docs, labels, id_col, text_col, label_col))
    kind = pa.list_(pa.struct([("doc_id", pa.int64()), ("label", pa.int32()),
                               ("cosine", pa.float64())]))

    def work(batch):
        model = shared.value
        index = model.index
        for chunk in _chunks(batch["text"]):
            place, tf, offsets = _features(chunk, index.vocab)
            share, (doc, example, cosine) = votes(index, place, tf, offsets)
            near = pa.StructArray.from_arrays(
                [pa.array(index.ids[example], pa.int64()), pa.array(index.y[example], pa.int32()),
                 pa.array(cosine)], fields=list(kind.value_type))
            score = model.score(share)
            part = batch.slice(chunk.first, chunk.n)
            yield {"doc_id": part["doc_id"], "held_out": part["held_out"], "score": score,
                   "predicted": (score >= 0.5).astype(np.int32),
                   "neighbours": pa.ListArray.from_arrays(
                       pa.array(np.searchsorted(doc, np.arange(chunk.n + 1)), pa.int32()), near)}

    slim = pair(docs, id_col, text_col).withColumn("held_out", fold(F.col("doc_id")) == 0)
    return each(slim, work, "doc_id long, held_out boolean, score double, predicted int, "
                "neighbours array<struct<doc_id long, label int, cosine double>>")
