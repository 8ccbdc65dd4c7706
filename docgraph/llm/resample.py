"""Importance resampling of documents towards a target distribution.

Every n-gram of a document falls into one of ``buckets`` hash buckets. How much likelier a bucket
is among the target texts than among all documents is its gain; a document's weight is the mean
gain of its n-grams. Weight plus a Gumbel variate, drawn from a hash of the document's id, is the
score, and the highest scores are the sample: a draw without replacement in proportion to the
exponentials of the weights.

The cutoff is found by bracketing. A mergeable quantile sketch proposes two scores around it;
exact counts of the rows outside validate the bracket or widen it; only the rows inside are
sorted. Then the drawn rows alone are ordered to number them.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docgraph.llm.kernel import LOWER, Chunk, chunks, words
from docgraph.plans import ordered, storage

BUCKETS = 10_000
PERCENT = 25
LEAST_WORDS = 20
SEED = 7

#: Of the quantile sketch: its size, which gives a rank error below a thousandth, and the first
#: bracket's half width as a share of the rows.
SKETCH = 4096
HALF_WIDTH = 0.002

#: Bytes that are not part of a word; A-Z never reach the test, as they are lower-cased before.
SPLIT = np.zeros(256, bool)
SPLIT[0x00:0x30] = SPLIT[0x3A:0x41] = SPLIT[0x5B:0x61] = SPLIT[0x7B:0x80] = True

#: Words of more bytes are hashed one at a time.
SHORT = 64


def _crc_tables() -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """CRC-32 is affine over bits, so it can be put together from parts.

    byte: change of the register by one byte. ahead[j, b]: what byte b does to the result when j
    bytes follow. zeros[n]: the checksum of n zero bytes. moved[n, i, v]: byte i of a checksum,
    with value v, after n more bytes.
    """
    byte = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        byte = np.where(byte & 1, (byte >> 1) ^ np.uint32(0xEDB88320), byte >> 1)
    step = lambda v: byte[v & 0xFF] ^ (v >> 8)
    ahead = np.zeros((SHORT, 256), np.uint32)
    ahead[0] = byte
    for j in range(1, SHORT):
        ahead[j] = step(ahead[j - 1])
    moved = np.zeros((SHORT + 1, 4, 256), np.uint32)
    moved[0] = np.arange(256, dtype=np.uint32)[None, :] << np.array([[0], [8], [16], [24]], np.uint32)
    for n in range(1, SHORT + 1):
        moved[n] = step(moved[n - 1])
    zeros = np.array([zlib.crc32(bytes(n)) for n in range(SHORT + 1)], np.uint32)
    return byte, ahead, zeros, moved


BYTE, AHEAD, ZEROS, MOVED = _crc_tables()


def word_crcs(data: np.ndarray, start: np.ndarray, length: np.ndarray) -> np.ndarray:
    """CRC-32 of byte ranges that are not empty."""
    if not len(start):
        return np.zeros(0, np.uint32)
    size = np.minimum(length, SHORT)
    head = np.concatenate(([0], np.cumsum(size)[:-1]))
    place = np.arange(size.sum()) - np.repeat(head, size)
    letters = data[np.repeat(start, size) + place]
    out = np.bitwise_xor.reduceat(AHEAD[np.repeat(size, size) - 1 - place, letters], head) ^ ZEROS[size]
    for i in np.flatnonzero(length > SHORT):
        out[i] = zlib.crc32(data[start[i]:start[i] + length[i]].tobytes())
    return out


def joined_crcs(first: np.ndarray, second: np.ndarray, data: np.ndarray, start: np.ndarray,
                length: np.ndarray) -> np.ndarray:
    """CRC-32 of ``first``'s bytes, a space and the byte ranges whose checksum is ``second``."""
    full = np.uint32(0xFFFFFFFF)
    state = first ^ full
    spaced = (BYTE[(state ^ 0x20) & 0xFF] ^ (state >> 8)) ^ full
    n = np.minimum(length, SHORT)
    out = second ^ MOVED[n, 0, spaced & 0xFF] ^ MOVED[n, 1, (spaced >> 8) & 0xFF] \
        ^ MOVED[n, 2, (spaced >> 16) & 0xFF] ^ MOVED[n, 3, spaced >> 24]
    for i in np.flatnonzero(length > SHORT):
        out[i] = zlib.crc32(data[start[i]:start[i] + length[i]].tobytes(), int(spaced[i]))
    return out


@dataclass
class Features:
    """Buckets of a chunk's words, of its word pairs, and the document of each."""

    word: np.ndarray
    word_doc: np.ndarray
    pair: np.ndarray
    pair_doc: np.ndarray


def features(chunk: Chunk, buckets: int) -> Features:
    """Hash buckets of all runs of one and two consecutive words, repeats counted."""
    own = Chunk(chunk.first, LOWER[chunk.data], chunk.starts)
    w = words(own, SPLIT, None)
    length, doc = w.end - w.start, w.doc()
    crc = word_crcs(own.data, w.start, length)
    same = np.flatnonzero(doc[1:] == doc[:-1])
    pair = joined_crcs(crc[same], crc[same + 1], own.data, w.start[same + 1], length[same + 1])
    return Features(crc % buckets, doc, pair % buckets, doc[same])


def counts(texts: DataFrame, text_col: str, buckets: int) -> np.ndarray:
    """Features per bucket over all texts; at most ``buckets`` rows of each task are summed."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for chunk in chunks(batch["text"]):
                own = features(chunk, buckets)
                total += np.bincount(own.word, minlength=buckets)
                total += np.bincount(own.pair, minlength=buckets)
        seen = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int64()), pa.array(total[seen])],
                                         names=["bucket", "n"])

    found = texts.select(F.col(f"`{text_col}`").alias("text")).mapInArrow(work, "bucket long, n long")
    out = np.zeros(buckets, np.int64)
    for bucket, n in found.groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[bucket] = n
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln) of the smoothed ratio of shares, per bucket."""
    wide, near, k = int(source.sum()), int(target.sum()), len(source)
    return np.array([math.floor(1000 * math.log(((t + 1.0) * (wide + k)) / ((s + 1.0) * (near + k))))
                     for s, t in zip(source.tolist(), target.tolist())], np.int64)


def weighted(docs: DataFrame, gain: np.ndarray, id_col: str, text_col: str) -> DataFrame:
    """doc_id, n_words, n_features and weight, the floored mean gain (0 without features)."""
    buckets = len(gain)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, many, total = (np.zeros(batch.num_rows, np.int64) for _ in range(3))
            for chunk in chunks(batch["text"]):
                own, at = features(chunk, buckets), slice(chunk.first, chunk.first + chunk.n)
                n[at] = np.bincount(own.word_doc, minlength=chunk.n)
                many[at] = n[at] + np.bincount(own.pair_doc, minlength=chunk.n)
                np.add.at(total[at], own.word_doc, gain[own.word])
                np.add.at(total[at], own.pair_doc, gain[own.pair])
            weight = total // np.maximum(many, 1)
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], *map(pa.array, (n, many, weight))],
                names=["doc_id", "n_words", "n_features", "weight"])

    slim = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    kind = slim.schema["doc_id"].dataType.simpleString()
    return slim.mapInArrow(work, f"doc_id {kind}, n_words long, n_features long, weight long")


def noise(key: str, seed: int) -> Column:
    """1000 times a Gumbel variate, floored, from a hash of the seed and the key."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(key).cast("string"), F.lit(""))), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0)))).cast("long")


@dataclass(frozen=True)
class Bracket:
    """Scores around a cutoff, and how many rows lie above, and at or above its lower end."""

    low: int
    high: int
    above: int
    reached: int


def bracket(scores: DataFrame, score: str, k: int, n: int, sketch: int = SKETCH,
            half_width: float = HALF_WIDTH) -> Bracket:
    """Two scores between which the k-th highest of n rows lies (1 <= k <= n).

    A sketch proposes them; rows outside are counted exactly. While the k-th row is not inside,
    the bracket widens fourfold, in the end to all rows.
    """
    drawn = scores.agg(F.kll_sketch_agg_bigint(score, F.lit(sketch)).alias("s"))
    width = half_width
    while True:
        ranks = [max(0.0, 1 - k / n - width), min(1.0, 1 - k / n + width)]
        low, high = drawn.select(*[F.kll_sketch_get_quantile_bigint("s", F.lit(r)) for r in ranks]).first()
        if ranks == [0.0, 1.0]:
            low, high = scores.agg(F.min(score), F.max(score)).first()
        above, reached = scores.agg(F.count_if(F.col(score) > high), F.count_if(F.col(score) >= low)).first()
        if above < k <= reached:
            return Bracket(low, high, above, reached)
        width *= 4


def resampled(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text",
              target_col: str = "text", buckets: int = BUCKETS, percent: int = PERCENT,
              least_words: int = LEAST_WORDS, seed: int = SEED, sketch: int = SKETCH,
              half_width: float = HALF_WIDTH) -> DataFrame:
    """All documents with n_words, n_features, weight, score and rank (null: not drawn).

    ``percent`` of the documents with at least ``least_words`` words are drawn, rounded down.
    Ties go to the smaller id, null ids last, then to either of two rows equal in both. Null and
    empty texts have no features and weight 0; null ids hash like an empty id; a repeated row is
    a row of its own; empty tables give an empty result, an empty target only its smoothing.
    Ids may have any type that can be ordered; other columns are not read.
    """
    gain = gains(counts(docs, text_col, buckets), counts(target, target_col, buckets))
    rows = weighted(docs, gain, id_col, text_col).withColumn("score", F.col("weight") + noise("doc_id", seed))
    rows = storage.stored(rows.withColumn("row", F.monotonically_increasing_id()), "weighted")
    fit = rows.filter(F.col("n_words") >= least_words)
    n = fit.count()
    k = percent * n // 100
    if k == 0:
        return rows.withColumn("rank", F.lit(None).cast("long")).drop("row")
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("row").asc()]
    found = bracket(fit.select("score"), "score", k, n, sketch, half_width)
    inside = fit.select("score", "doc_id", "row").filter(F.col("score").between(found.low, found.high))
    last = ordered.numbered(inside, order, "place", "bracket").filter(
        F.col("place") == k - found.above - 1).first()
    at = F.lit(last.doc_id).cast(rows.schema["doc_id"].dataType)
    tie_row = F.col("row") <= last.row
    if last.doc_id is None:
        tie = F.col("doc_id").isNotNull() | tie_row
    else:
        tie = F.coalesce((F.col("doc_id") < at) | ((F.col("doc_id") == at) & tie_row), F.lit(False))
    chosen = (F.col("n_words") >= least_words) & (
        (F.col("score") > last.score) | ((F.col("score") == last.score) & tie))
    drawn = ordered.numbered(rows.filter(chosen), order, "rank", "drawn").withColumn("rank", F.col("rank") + 1)
    rest = rows.filter(~chosen).withColumn("rank", F.lit(None).cast("long"))
    return drawn.unionByName(rest).drop("row")
