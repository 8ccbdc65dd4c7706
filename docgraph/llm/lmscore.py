"""Language-model scores by stupid backoff over word bigrams, as joins of count tables.

Every word counts as itself, by its 64-bit hash. The common words, those that make up at least one
in ``COMMON`` of all, are kept with their counts in every task; there are at most COMMON of them,
whatever the size of the corpus. A bigram of two common words is a 40-bit key of their ids, any
other one is the pair of hashes. The counts of words off the list are looked up in the table of all
words: what a document needs of them goes to the word's bucket with its factor, the number of back-offs
to the word (and of documents that begin with it) less the number of seen bigrams that begin with it.

The bigrams of a chunk of documents go, as one array per hash bucket, to the bucket's task. There
they are counted (the count table of the bucket), joined to the same bigrams of each document, and
summed per document; the sums of a chunk's documents meet again by chunk. A bigram that the corpus has at least ``SEEN`` times scores ln(c(ab) / c(a)); any
other backs off to ln(0.4 * c(b) / N). The first word of a document scores ln(c(a) / N).

A frequent bigram would bring a row of nearly every document into one bucket. Bigrams that are
frequent in some batch are therefore counted apart, with sums before the shuffle, and scored
where the text is read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docgraph.llm import kernel as K
from docgraph.llm.frames import each, pair
from docgraph.plans import storage

#: The least share of a common word. Ids of common words have as many bits.
BITS = 20
COMMON = 1 << BITS
BACKOFF, SEEN = 0.4, 2
#: Bigrams counted apart: their number, and the share of a batch that makes one a candidate.
FREQUENT, SHARE = 4_096, 1 / 4_096
#: Bigrams in a bucket on average.
BUCKET = 4_000_000
#: Different words off the list in a bucket on average.
WORDS = 1 << 16


def _counts(batch: pa.RecordBatch):
    """Counts of a batch's words."""
    found = [K.words(c).hash for c in K.chunks(batch["text"])]
    word, n = np.unique(np.concatenate(found) if found else np.zeros(0, K.U), return_counts=True)
    yield {"word": word.view(np.int64), "n": n}


def vocabulary(texts: DataFrame) -> tuple[np.ndarray, np.ndarray, int, DataFrame]:
    """Sorted hashes of the common words, their counts, the number of all words, and the others."""
    table = storage.stored(each(texts.select("text"), _counts, "word long, n long")
                           .groupBy("word").agg(F.sum("n").alias("n")), "words")
    total = table.agg(F.sum("n").alias("n")).first()["n"] or 0
    rows = table.filter(F.col("n") * COMMON >= total).toPandas()
    word = rows["word"].to_numpy(np.int64).view(K.U)
    order = np.argsort(word)
    return (word[order], rows["n"].to_numpy(np.int64)[order], int(total),
            table.filter(F.col("n") * COMMON < total))


def _ids(hashes: np.ndarray, vocab: np.ndarray) -> np.ndarray:
    """Places in the list of common words, -1 for all others."""
    if not len(vocab):
        return np.full(len(hashes), -1)
    at = np.minimum(np.searchsorted(vocab, hashes), len(vocab) - 1)
    return np.where(vocab[at] == hashes, at, -1)


def _bigrams(chunk: K.Chunk, vocab: np.ndarray):
    """Words and their ids; place of the first word, document and key of every bigram (key -1:
    not of two common words)."""
    w = K.words(chunk)
    ids = _ids(w.hash, vocab)
    count = np.maximum(np.diff(w.first) - 1, 0)
    left = np.repeat(w.first[:-1] - np.cumsum(count) + count, count) + np.arange(count.sum())
    a, b = ids[left], ids[left + 1]
    key = np.where((a >= 0) & (b >= 0), (a << BITS) | b, -1)
    return w, ids, left, np.repeat(np.arange(chunk.n), count), key


def frequent(texts: DataFrame, vocab: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Keys of the most frequent bigrams of common words in order, and their exact counts (FREQUENT at most)."""

    def candidates(batch):
        keys = [_bigrams(c, vocab)[4] for c in K.chunks(batch["text"])]
        key, n = np.unique(np.concatenate(keys) if keys else np.zeros(0, int), return_counts=True)
        often = (key >= 0) & (n >= max(2, n.sum() * SHARE))
        yield {"key": key[often], "n": n[often]}

    rows = (each(texts.select("text"), candidates, "key long, n long").groupBy("key")
            .agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "key").limit(FREQUENT).collect())
    keys = np.array(sorted(r["key"] for r in rows), np.int64)
    if not len(keys):
        return keys, np.zeros(0, np.int64)

    def exact(batch):
        total = np.zeros(len(keys), np.int64)
        for chunk in K.chunks(batch["text"]):
            own = _bigrams(chunk, vocab)[4]
            at = np.minimum(np.searchsorted(keys, own), len(keys) - 1)
            total += np.bincount(at[keys[at] == own], minlength=len(keys))
        yield {"key": keys, "n": total}

    rows = (each(texts.select("text"), exact, "key long, n long").groupBy("key")
            .agg(F.sum("n").alias("n")).collect())
    count = {r["key"]: r["n"] for r in rows}
    return keys, np.array([count.get(int(k), 0) for k in keys], np.int64)


def _logs(count: np.ndarray, total: int) -> np.ndarray:
    return np.log(np.maximum(count, 1) / max(total, 1))


def _score(a: np.ndarray, b: np.ndarray, n: np.ndarray, logs: np.ndarray, total: int):
    """Score of bigrams (word ids) that the corpus has n times, without what words off the list
    (-1) add to it, and whether they back off."""
    logs = np.append(logs, 0.0)
    seen = n >= SEEN
    return np.where(seen, _logs(n, total) - logs[a], np.log(BACKOFF) + logs[b]), ~seen


def scores(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words, n_backoff, log_score (sum) and score (mean per word) of every document.

    Null and empty texts have no words, log_score 0 and no score (null). Every row is a document
    of its own, also where ids repeat or are null. An empty table gives an empty result.
    """
    texts = pair(docs, id_col, text_col)
    vocab, count, total, others = vocabulary(texts)
    keys, often = frequent(texts, vocab)
    logs = _logs(count, total)
    buckets = max(1, -(-total // BUCKET))
    n_others = others.count()
    shelves = max(1, -(-n_others // WORDS))
    shared = docs.sparkSession.sparkContext.broadcast((vocab, logs, keys, often))

    def emit(batches):
        """Per chunk one row with what is known here (bucket -1), and rows per bucket: bigrams
        of common words, other bigrams, and first words off the list (below -1)."""
        vocab, logs, keys, often = shared.value
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            for chunk in K.chunks(batch["text"]):
                number += 1
                w, ids, left, doc, key = _bigrams(chunk, vocab)
                known = np.zeros(chunk.n)
                filled = np.flatnonzero(np.diff(w.first) > 0)
                known[filled] = np.append(logs, 0.0)[ids[w.first[filled]]]
                new = filled[ids[w.first[filled]] < 0]
                if len(new):
                    yield _shelved(w.hash[w.first[new]].view(np.int64), np.ones(len(new), int),
                                   np.full(len(new), number), new, shelves, lambda s: (-2 - s, number))
                other = key < 0
                a, b = w.hash[left[other]], w.hash[left[other] + 1]
                if len(a):
                    bucket = (_pair(a, b) % K.U(buckets)).astype(np.int64) + buckets
                    yield from _dealt(bucket, number, doc[other],
                                      np.stack((a.view(np.int64), b.view(np.int64)), axis=1))
                key, doc = key[~other], doc[~other]
                at = np.minimum(np.searchsorted(keys, key), max(len(keys) - 1, 0))
                rest = keys[at] != key if len(keys) else np.ones(len(key), bool)
                own = key[~rest]
                value, back = _score(own >> BITS, own & ((1 << BITS) - 1), often[at[~rest]], logs, total)
                known += np.bincount(doc[~rest], value, chunk.n)
                backs = np.bincount(doc[~rest], back, chunk.n)
                yield _rows([-1], [number], [number], np.arange(chunk.n), [0, chunk.n], None,
                            batch["doc_id"].slice(chunk.first, chunk.n), np.diff(w.first), backs, known)
                key, doc = key[rest], doc[rest]
                bucket = (K.mixed(key.astype(K.U)) % K.U(buckets)).astype(np.int64)
                yield from _dealt(bucket, number, doc, key[:, None])

    def join(rows: pa.Table) -> pa.Table:
        """Count the bigrams of a bucket and sum their scores per row and document."""
        number = rows["bucket"][0].as_py()
        if number == -1:
            return rows
        if number < -1:
            return rows.set_column(0, "bucket", pa.array(np.full(len(rows), -2 - number))).set_column(
                1, "part", pa.array(np.zeros(len(rows), np.int64)))
        vocab, logs, _, _ = shared.value
        offsets, doc = _flat(rows["docs"])
        _, key = _flat(rows["keys"])
        row = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
        if number < buckets:
            a, b = key >> BITS, key & ((1 << BITS) - 1)
        else:
            words = key.reshape(-1, 2)
            key = _pair(words[:, 0].view(K.U), words[:, 1].view(K.U))
            a, b = (_ids(words[:, i].view(K.U), vocab) for i in (0, 1))
        _, at, n = np.unique(key, return_inverse=True, return_counts=True)
        value, back = _score(a, b, n[at], logs, total)
        chunk = rows["chunk"].to_numpy()
        out = [_sums(chunk, row, doc, back.astype(np.int64), value)]
        if number >= buckets:
            less, more = np.flatnonzero(~back & (a < 0)), np.flatnonzero(back & (b < 0))
            if len(less) + len(more):
                at = np.concatenate((less, more))
                out.append(_shelved(np.concatenate((words[less, 0], words[more, 1])),
                                    np.repeat([-1, 1], (len(less), len(more))),
                                    chunk[row[at]], doc[at], shelves, lambda s: (s, 0)))
        return pa.Table.from_batches(out)

    def look(rows: pa.Table, table: pa.Table) -> pa.Table:
        """Score what documents need of the words of a bucket."""
        if not len(rows) or rows["bucket"][0].as_py() < 0:
            return rows
        word, n = _flat(table["words"])[1], _flat(table["counts"])[1]
        order = np.argsort(word)
        word, n = word[order], n[order]
        value = _flat(rows["factors"])[1] * _logs(n[np.searchsorted(word, _flat(rows["keys"])[1])], total)
        chunk, doc = _flat(rows["chunks"])[1], _flat(rows["docs"])[1]
        order = np.lexsort((doc, chunk))
        numbers, row = np.unique(chunk[order], return_inverse=True)
        return pa.Table.from_batches(
            [_sums(numbers, row, doc[order], np.zeros(len(doc), np.int64), value[order])])

    def pack(batch):
        """Words and counts as one pair of arrays per bucket."""
        word = batch["word"].to_numpy()
        shelf = word % shelves
        order = np.argsort(shelf, kind="stable")
        met, begin = np.unique(shelf[order], return_index=True)
        edges = np.append(begin, len(word))
        yield {"bucket": met, "part": np.zeros(len(met), np.int64),
               "words": K.lists(word[order], edges), "counts": K.lists(batch["n"].to_numpy()[order], edges)}

    def meet(rows: pa.Table) -> pa.Table:
        """The sums of a chunk's documents."""
        ids = next(x for x in rows["ids"] if x.is_valid).values
        words = next(x for x in rows["n_words"] if x.is_valid).values
        _, doc = _flat(rows["docs"])
        known = np.bincount(doc, _flat(rows["known"])[1], len(ids))
        backs = np.bincount(doc, _flat(rows["backs"])[1], len(ids)).astype(np.int64)
        return pa.table({"doc_id": ids, "n_words": words, "n_backoff": backs, "log_score": known})

    kind = ", ".join(f"{k} {v}" for k, v in ROW.items())
    rows = texts.mapInArrow(emit, kind).groupBy("bucket", "part").applyInArrow(join, kind)
    if n_others:
        table = each(others, pack, "bucket long, part long, words array<long>, counts array<long>")
        rows = rows.groupBy("bucket", "part").cogroup(table.groupBy("bucket", "part")).applyInArrow(
            look, kind)
    return (rows.select("chunk", "docs", "ids", "n_words", "backs", "known")
            .groupBy("chunk").applyInArrow(
                meet, "doc_id long, n_words long, n_backoff long, log_score double")
            .withColumn("score", F.when(F.col("n_words") > 0,
                                        F.round(F.col("log_score") / F.col("n_words"), 6)))
            .withColumn("log_score", F.round("log_score", 4)))


#: Columns of the rows between the steps: bigrams or words of a bucket, or sums of a chunk.
ROW = {"bucket": "long", "part": "long", "keys": "array<long>", "chunk": "long",
       "docs": "array<int>", "ids": "array<long>", "n_words": "array<long>",
       "backs": "array<long>", "known": "array<double>", "chunks": "array<long>",
       "factors": "array<long>"}


def _pair(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return K.mixed(a * K.BASE + b)


def _flat(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and values of a list column."""
    lists = pa.concat_arrays(column.chunks)
    offsets = lists.offsets.to_numpy().astype(np.int64)
    return offsets - offsets[0], lists.values.to_numpy(zero_copy_only=False)[offsets[0]:offsets[-1]]


def _dealt(bucket: np.ndarray, number: int, doc: np.ndarray, keys: np.ndarray):
    """One row per bucket of a chunk; ``keys`` has one or two numbers per bigram."""
    order = np.argsort(bucket, kind="stable")
    met, begin = np.unique(bucket[order], return_index=True)
    yield _rows(met, np.zeros(len(met)), np.full(len(met), number), doc[order],
                np.append(begin, len(bucket)), keys[order])


def _shelved(word, factor, chunk, doc, shelves: int, address):
    """One row per bucket of words; ``address`` gives bucket and part."""
    shelf = word % shelves
    order = np.argsort(shelf, kind="stable")
    met, begin = np.unique(shelf[order], return_index=True)
    edges = np.append(begin, len(word))
    bucket, part = address(met)
    return _rows(bucket, np.full(len(met), part), np.zeros(len(met)), doc[order], edges, word[order, None],
                 chunks=K.lists(chunk[order], edges), factors=K.lists(factor[order], edges))


def _sums(chunk, row, doc, back, value):
    """Per row (chunk) the sums per document; rows and their documents come in order."""
    new = np.flatnonzero((np.diff(row, prepend=-1) != 0) | (np.diff(doc, prepend=-1) != 0))
    edges = np.append(np.searchsorted(row[new], np.arange(len(chunk))), len(new))
    return _rows(np.full(len(chunk), -1), chunk, chunk, doc[new], edges, None, None, None,
                 np.add.reduceat(back, new), np.add.reduceat(value, new))


def _rows(bucket, part, chunk, docs, offsets, keys, ids=None, words=None, backs=None, known=None,
          chunks=None, factors=None):
    n = len(bucket)
    offsets = np.asarray(offsets)
    edge = pa.array(offsets.astype(np.int32))
    none = pa.nulls(n, pa.list_(pa.int64()))
    return pa.RecordBatch.from_arrays(
        [pa.array(np.asarray(bucket), pa.int64()), pa.array(np.asarray(part).astype(np.int64)),
         none if keys is None else K.lists(keys.ravel(), offsets * keys.shape[1]),
         pa.array(np.asarray(chunk).astype(np.int64)),
         K.lists(docs.astype(np.int32), offsets, pa.int32()),
         none if ids is None else pa.ListArray.from_arrays(edge, ids),
         none if words is None else K.lists(words, offsets),
         none if backs is None else K.lists(backs.astype(np.int64), offsets),
         pa.nulls(n, pa.list_(pa.float64())) if known is None
         else K.lists(known, offsets, pa.float64()),
         none if chunks is None else chunks, none if factors is None else factors],
        names=list(ROW))
