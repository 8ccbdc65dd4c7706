"""Quality rules: word statistics and perplexity bands of a modified Kneser-Ney model.

Spark counts the byte trigrams of the whole corpus per language; every byte is a symbol of its own.
A language has as many trigrams as its texts use, at most 256**3, whatever the size of the corpus;
the model of a language is two sorted arrays (trigrams and their histories). Documents are
rejected whose mean log-probability lies outside their language's band; the bands are the median
and a multiple of the median absolute deviation of all documents of the language. Before that, a
document outside its band is heard block by block, each block by the language that fits it best,
so that a clean text in two languages, or under a wrong language tag, stays; nearly all blocks must
lie in the band of that language's blocks. Languages of few documents share a model, which is not
heard, and a band needs as many documents.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docgraph.llm import kernel as K
from docgraph.llm.frames import each

#: Symbols of the models: the bytes, and one that stands before a text.
SYMBOLS = 257
BOUNDARY = 256
#: Languages with a model of their own, by number of documents; all others share one model.
LANGUAGES = 200
OTHER = "(other)"
#: Least number of documents of a model and of a band.
DOCUMENTS = 100
#: Half width of a band in median absolute deviations, and the least half width (nats per byte).
WIDTH, LEAST = 5.0, 0.12
#: Bytes of a block in the second hearing.
BLOCK = 64
#: Share of the blocks that must fit in the second hearing.
NEARLY = 0.95
#: Step of the histogram from which median and deviation are taken.
STEP = 0.005
#: Rows that are judged and handed over at a time where whole documents pass through.
SLICE = 1024
#: Fixed values of the contract.
MARKS = b"#*$%&|<>"
MIN_WORDS, WINDOW, MAX_REPEAT_PERCENT = 20, 8, 30


LINE_END = np.zeros(256, bool)
LINE_END[10] = True
MARK = np.zeros(256, bool)
MARK[list(MARKS)] = True


def _codes(chunk: K.Chunk) -> tuple[np.ndarray, np.ndarray]:
    """Trigram codes of a chunk, two per-document boundary symbols before the first byte."""
    n = len(chunk.data)
    s = np.full(n + 2 * chunk.n, BOUNDARY, np.int32)
    at = np.arange(n) + 2 * (1 + np.repeat(np.arange(chunk.n), np.diff(chunk.starts)))
    s[at] = chunk.data
    return (s[at - 2] * SYMBOLS + s[at - 1]) * SYMBOLS + s[at], chunk.starts


def _language(lang: Column) -> Column:
    return F.coalesce(lang.cast("string"), F.lit(OTHER))


def _counts(known: list[str]):
    def work(batch: pa.RecordBatch):
        langs = np.array([own.get(x, other) for x in batch["lang"].to_pylist()])
        total: dict[int, list] = {}
        for chunk in K.chunks(batch["text"]):
            codes, starts = _codes(chunk)
            mine = langs[chunk.first:chunk.first + chunk.n]
            for lang in set(mine.tolist()):
                part = codes[np.repeat(mine == lang, np.diff(starts))]
                total.setdefault(lang, []).append(np.unique(part, return_counts=True))
        for lang, parts in total.items():
            seen, at = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
            count = np.bincount(at, np.concatenate([p[1] for p in parts]), len(seen)).astype(np.int64)
            yield {"lang": np.full(len(seen), lang, np.int32), "gram": seen, "n": count}

    own = {x: i for i, x in enumerate(known)}
    other = own.get(OTHER, len(known))
    return work


@dataclass
class Model:
    """Log-probabilities of the seen trigrams, and back-off parts, in arrays sorted by code."""

    symbols: int
    grams: np.ndarray
    logp: np.ndarray
    histories: np.ndarray
    gamma: np.ndarray
    lower: np.ndarray  # probability of the symbol after its last predecessor, symbols**2

    def table(self, codes: np.ndarray) -> np.ndarray:
        """Log-probabilities of distinct trigram codes."""
        at = np.minimum(np.searchsorted(self.grams, codes), len(self.grams) - 1)
        history = codes // self.symbols
        back = np.minimum(np.searchsorted(self.histories, history), len(self.histories) - 1)
        gamma = np.where(self.histories[back] == history, self.gamma[back], 1.0)
        unseen = np.log(gamma * self.lower[codes % self.symbols ** 2])
        return np.where(self.grams[at] == codes, self.logp[at], unseen)


def _discounts(counts: np.ndarray) -> np.ndarray:
    """Modified Kneser-Ney discounts for counts of 1, 2 and 3 or more."""
    n = [float((counts == k).sum()) for k in range(1, 5)]
    if n[0] == 0 or n[1] == 0:
        return np.array([0.0, 0.5, 0.5, 0.5])
    y = n[0] / (n[0] + 2 * n[1])
    d = [1 - 2 * y * n[1] / n[0], 2 - 3 * y * n[2] / n[1],
         3 - 4 * y * n[3] / n[2] if n[2] else 3 - 2 * y]
    return np.array([0.0] + [min(max(x, 0.05), k + 0.95) for k, x in enumerate(d)])


def _interpolated(counts: np.ndarray, history: np.ndarray, size: int, lower: np.ndarray):
    """Probability of every entry and the back-off weight of every history."""
    d = _discounts(counts)
    total = np.bincount(history, counts, size)
    cut = np.bincount(history, d[np.minimum(counts, 3)], size)
    gamma = np.where(total > 0, cut / np.maximum(total, 1), 1.0)
    return (counts - d[np.minimum(counts, 3)]) / total[history] + gamma[history] * lower, gamma


def fitted(grams: np.ndarray, counts: np.ndarray, s: int = 64) -> Model:
    """A model from the sorted codes of all seen trigrams of ``s`` symbols and their counts."""
    pairs, tails = np.unique(grams % s ** 2, return_counts=True)
    symbol = np.bincount(pairs % s, minlength=s).astype(float)
    unigram = (symbol + 0.5) / (symbol.sum() + 0.5 * s)
    p2, gamma2 = _interpolated(tails, pairs // s, s, unigram[pairs % s])
    lower = gamma2[np.arange(s * s) // s] * unigram[np.arange(s * s) % s]
    lower[pairs] = p2
    p3, gamma3 = _interpolated(counts, grams // s, s * s, lower[grams % s ** 2])
    histories = np.unique(grams // s)
    return Model(s, grams, np.log(p3), histories, gamma3[histories], lower.astype(np.float32))


def models(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> dict[str, Model]:
    """A model per language, counted over all documents.

    The driver gets the distinct trigrams of each language, 16 bytes each, and every task all models.
    """
    slim = _slim(docs, text_col, lang_col)
    top = (slim.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
           .orderBy(F.desc("n"), "lang").limit(LANGUAGES).collect())
    known = [r["lang"] for r in top if r["n"] >= DOCUMENTS]
    counts = each(slim, _counts(known), "lang int, gram int, n long")
    rows = counts.groupBy("lang", "gram").agg(F.sum("n").alias("n")).toArrow()
    lang, gram, n = (rows[c].to_numpy() for c in ("lang", "gram", "n"))
    out = {}
    for i, name in enumerate([*known, OTHER]):
        at = np.flatnonzero(lang == i)
        at = at[np.argsort(gram[at])]
        if len(at):
            out[name] = fitted(gram[at], n[at], SYMBOLS)
    return out


def _statistics(chunk: K.Chunk) -> dict[str, np.ndarray]:
    w = K.words(chunk, fold=None)
    own = np.diff(w.first)
    heads = np.concatenate(([0], np.cumsum((chunk.data & 0xC0) != 0x80)))
    chars = K.sums(heads[w.end] - heads[w.start], w.first)
    marks = K.sums(MARK[chunk.data].astype(np.int64), chunk.starts)
    lines = K.words(chunk, split=LINE_END, fold=None)
    filled = np.searchsorted(w.start, lines.end) > np.searchsorted(w.start, lines.start)
    line_doc = lines.doc()[filled]
    first = np.searchsorted(line_doc, np.arange(chunk.n + 1))
    distinct, at = K.distinct(lines.hash[filled], first)
    grams, offsets = K.grams(w, WINDOW)
    twice = K.repeated(grams, offsets)
    begin = np.repeat(w.first[:-1], np.diff(offsets)) + (
        np.arange(len(grams)) - np.repeat(offsets[:-1], np.diff(offsets)))
    cover = np.zeros(len(w.hash) + WINDOW + 1, np.int64)
    np.add.at(cover, begin[twice], 1)
    np.add.at(cover, begin[twice] + WINDOW, -1)
    covered = (np.cumsum(cover)[:len(w.hash)] > 0).astype(np.int64)
    return {"n_words": own, "word_chars": chars, "n_symbols": marks,
            "n_dup_lines": np.diff(first) - np.diff(at),
            "n_repeat_words": K.sums(covered, w.first)}


def _looked_up(codes: np.ndarray, model: Model) -> np.ndarray:
    """Log-probabilities of trigram codes, from a table with a row for each history that occurs."""
    size = SYMBOLS
    seen = np.unique(codes)
    history = seen // size
    own = np.unique(history)
    row = np.zeros(size * size, np.int32)
    row[own] = np.arange(len(own)) * size
    table = np.zeros(len(own) * size)
    table[row[history] + seen % size] = model.table(seen)
    history = codes // size
    return table[row[history] + (codes - history * size)]


def _scores(chunk: K.Chunk, langs: np.ndarray, fit: dict[str, Model]) -> tuple[np.ndarray, np.ndarray]:
    """Mean log-probability of each document's bytes (0 for an empty text), and every byte's."""
    codes, starts = _codes(chunk)
    logp = np.zeros(len(codes))
    for lang in set(langs):
        mine = np.repeat(langs == lang, np.diff(starts))
        if mine.any():
            logp[mine] = _looked_up(codes[mine], fit[lang])
    return K.sums(logp, starts) / np.maximum(np.diff(starts), 1), logp


def _blocks(starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First byte and document of every block; a document's last block takes what is left."""
    size = np.diff(starts)
    n = np.where(size > 0, np.maximum(size // BLOCK, 1), 0)
    doc = np.repeat(np.arange(len(size)), n)
    return starts[doc] + (np.arange(len(doc)) - (np.cumsum(n) - n)[doc]) * BLOCK, doc


def _means(logp: np.ndarray, begin: np.ndarray) -> np.ndarray:
    return (np.add.reduceat(logp, begin) / np.diff(np.append(begin, len(logp)))
            if len(begin) else np.zeros(0))


def _base_failed(own: dict[str, np.ndarray]) -> np.ndarray:
    return (own["n_words"] < MIN_WORDS) | (
        100 * own["n_repeat_words"] > MAX_REPEAT_PERCENT * own["n_words"])


COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def measured(batch: pa.RecordBatch, fit: dict[str, Model]) -> dict[str, np.ndarray]:
    """The word statistics, ``base_failed`` and ``logp`` of the rows of a batch (text, lang)."""
    langs = np.array([x if x in fit else OTHER for x in batch["lang"].to_pylist()])
    parts = [_statistics(c) | {"logp": _scores(c, langs[c.first:c.first + c.n], fit)[0]}
             for c in K.chunks(batch["text"])]
    out = {k: np.concatenate([p[k] for p in parts]) if parts else np.zeros(0)
           for k in [*COUNTS, "logp"]}
    out["base_failed"] = _base_failed(out)
    out["lang"] = langs
    return out


def _band(part) -> tuple[float, float]:
    part = part.sort_values("bin")
    value, n = part["bin"].to_numpy() * STEP, part["n"].to_numpy()
    middle = value[np.searchsorted(np.cumsum(n), n.sum() / 2)]
    off = np.abs(value - middle)
    order = np.argsort(off, kind="stable")
    spread = off[order][np.searchsorted(np.cumsum(n[order]), n.sum() / 2)]
    half = max(LEAST, WIDTH * spread)
    return float(middle - half), float(middle + half)


def bands(scored: DataFrame) -> dict[str, tuple[float, float, float, float]]:
    """Lower and upper log-probability of documents, and of blocks, per language, from all
    documents that pass the base rules. A language of too few of them has no band; if all have
    too few, the one of most documents has.

    The driver gets two histograms per language: log-probabilities per byte lie between 0 and
    about -12, so a language has a few thousand bins at most.
    """
    bins = scored.groupBy("model", "block", "bin").agg(F.sum("n").alias("n")).toPandas()
    parts = {lang: (part[~part["block"]], part[part["block"]]) for lang, part in bins.groupby("model")}
    size = {lang: int(own["n"].sum()) for lang, (own, _) in parts.items()}
    known = [x for x in size if size[x] >= DOCUMENTS] or sorted(size, key=lambda x: -size[x])[:1]
    return {x: (*_band(parts[x][0]), *_band(parts[x][1])) for x in known}


def scored(docs: DataFrame, fit: dict[str, Model], text_col: str = "text",
           lang_col: str = "lang") -> DataFrame:
    """Numbers of documents that pass the base rules, and of their blocks, by language of the
    model and step of the log-probability."""

    def work(batch):
        langs = np.array([x if x in fit else OTHER for x in batch["lang"].to_pylist()])
        for chunk in K.chunks(batch["text"]):
            own = langs[chunk.first:chunk.first + chunk.n]
            passed = ~_base_failed(_statistics(chunk))
            mean, logp = _scores(chunk, own, fit)
            begin, doc = _blocks(chunk.starts)
            means = _means(logp, begin)
            for lang in set(own[passed]):
                mine = passed & (own == lang)
                for block, value in ((False, mean[mine]), (True, means[mine[doc]])):
                    bin_, n = np.unique(np.round(value / STEP).astype(np.int64), return_counts=True)
                    yield {"model": [lang] * len(n), "block": [block] * len(n), "bin": bin_, "n": n}

    return each(_slim(docs, text_col, lang_col), work, "model string, block boolean, bin long, n long")


def _slim(docs: DataFrame, text_col: str, lang_col: str) -> DataFrame:
    return docs.select(F.col(f"`{text_col}`").alias("text"),
                       _language(F.col(f"`{lang_col}`")).alias("lang"))


def _heard(text: bytes, fit: dict[str, Model],
           limits: dict[str, tuple[float, float, float, float]]) -> bool:
    """Whether nearly all blocks of a text lie in the band of blocks, and their median in the band
    (wider for few blocks), of the language that gives them the highest probability."""
    data = np.frombuffer(text, np.uint8)
    langs = [x for x in limits if x != OTHER] or list(limits)
    codes, _ = _codes(K.Chunk(0, data, np.array([0, len(data)])))
    seen, at = np.unique(codes, return_inverse=True)
    begin, _ = _blocks(np.array([0, len(codes)]))
    mean = np.array([_means(fit[x].table(seen)[at], begin) for x in langs])
    low, high, least, most = np.array([limits[x] for x in langs]).T
    best = mean.argmax(axis=0)
    mean = mean[best, np.arange(len(begin))]
    off = float(np.median(((low + high)[best] / 2 - mean) / ((high - low)[best] / 2)))
    fits = (mean >= least[best]) & (mean <= most[best])
    return abs(off) <= 1 + 0.5 / np.sqrt(len(begin)) and fits.mean() >= NEARLY


def judged(batch: pa.RecordBatch, fit: dict[str, Model],
           limits: dict[str, tuple[float, float, float, float]]) -> dict[str, np.ndarray]:
    """``measured`` with the band of each row (low, high) and ``kept``."""
    own = measured(batch, fit)
    edge = np.array([limits.get(x, (np.inf, -np.inf))[:2] for x in own["lang"]]).reshape(-1, 2)
    own["low"], own["high"] = edge[:, 0], edge[:, 1]
    own["kept"] = ~own["base_failed"] & (own["logp"] >= own["low"]) & (own["logp"] <= own["high"])
    for i in np.flatnonzero(~own["kept"] & ~own["base_failed"]):
        own["kept"][i] = _heard(batch["text"][int(i)].as_py().encode(), fit, limits)
    return own


def verdicts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             lang_col: str = "lang") -> DataFrame:
    """The statistics, ``base_failed``, ``kept`` and the perplexity with its band, per document.

    Null and empty texts have no words and fail the base rules; null languages share the model of
    the rare ones; repeated rows are judged alike; an empty table gives an empty result.
    """
    fit = models(docs, text_col, lang_col)
    limits = bands(scored(docs, fit, text_col, lang_col))
    slim = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"),
                       F.col(f"`{text_col}`").alias("text"),
                       _language(F.col(f"`{lang_col}`")).alias("lang"))

    def work(batch):
        own = judged(batch, fit, limits)
        yield {"doc_id": batch["doc_id"], **{k: own[k] for k in COUNTS},
               "base_failed": own["base_failed"], "kept": own["kept"],
               "perplexity": np.exp(-own["logp"]), "lower_perplexity": np.exp(-own["high"]),
               "upper_perplexity": np.exp(-own["low"])}

    return each(slim, work, "doc_id long, " + ", ".join(f"{c} long" for c in COUNTS)
                + ", base_failed boolean, kept boolean, perplexity double, "
                  "lower_perplexity double, upper_perplexity double")


def passing(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The documents that are kept, with all their columns."""
    fit = models(docs, text_col, lang_col)
    limits = bands(scored(docs, fit, text_col, lang_col))
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"),
                        _language(F.col(f"`{lang_col}`")).alias("lang"))
    at = docs.columns.index(text_col)

    def work(batches):
        for batch in batches:
            for first in range(0, batch.num_rows, SLICE):
                part = batch.slice(first, SLICE)
                doc = part["doc"]
                slim = pa.RecordBatch.from_arrays([doc.flatten()[at], part["lang"]], names=["text", "lang"])
                keep = pa.array(judged(slim, fit, limits)["kept"])
                yield pa.RecordBatch.from_arrays([doc], names=["doc"]).filter(keep)

    return whole.mapInArrow(work, whole.select("doc").schema).select("doc.*")
