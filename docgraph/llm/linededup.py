"""Line dedup by overlapping windows of three lines.

The non-blank lines of a document, stripped of outer ASCII white space, form windows of three
consecutive lines. Of all occurrences of a window the first, by document id, then text digest,
then position, stays; the lines that later occurrences cover are removed, where overlapping
occurrences merge. Blank lines stay. A document of fewer than three lines has no window.
"""

from __future__ import annotations

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docgraph.llm.frames import each, pair
from docgraph.plans import storage

LINES = 3
WHITE = " \t\r\x0b\x0c"


def _lines(text: str | None) -> list[tuple[int, bytes]]:
    """Number and stripped bytes of the non-blank lines."""
    return [(i, line) for i, raw in enumerate((text or "").split("\n"))
            if (line := raw.strip(WHITE).encode())]


def _digest(text: Column) -> Column:
    return F.unhex(F.md5(F.coalesce(text, F.lit(""))))


def _windows(n: int):
    def work(batch: pa.RecordBatch):
        ids, digests, places, keys = [], [], [], []
        for doc, digest, text in zip(batch["doc_id"].to_pylist(), batch["digest"], batch["text"]):
            own = _lines(text.as_py())
            for k in range(len(own) - n + 1):
                ids.append(doc)
                digests.append(digest.as_py())
                places.append(k)
                keys.append(xxhash.xxh3_128_digest(b"\n".join(x for _, x in own[k:k + n])))
        yield {"doc_id": ids, "digest": digests, "place": places, "window": keys}

    return work


def covered(docs: DataFrame, n: int = LINES, id_col: str = "doc_id",
            text_col: str = "text") -> DataFrame:
    """doc_id, digest and the windows of the document that occurred before (their numbers)."""
    texts = pair(docs, id_col, text_col).withColumn("digest", _digest(F.col("text")))
    windows = each(texts, _windows(n), "doc_id long, digest binary, place int, window binary")
    windows = storage.stored(windows, "line-windows")
    place = F.struct("doc_id", "digest", "place")
    first = (windows.groupBy("window").agg(F.count(F.lit(1)).alias("n"), F.min(place).alias("first"))
             .filter("n > 1").select("window", "first"))
    later = windows.join(first, "window").filter(~place.eqNullSafe(F.col("first")))
    return later.groupBy("doc_id", "digest").agg(F.collect_set("place").alias("places"))


def deduplicated(docs: DataFrame, n: int = LINES, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """All rows and columns of ``docs`` as struct ``doc``, with clean_text, n_lines, n_removed.

    Null texts stay null and have no lines. Rows equal in id and text are one occurrence and get
    the same result. An empty table gives an empty result.
    """
    places = covered(docs, n, id_col, text_col).select(
        F.col("doc_id").alias("_id"), F.col("digest").alias("_digest"), "places")
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"),
                        F.col(f"`{id_col}`").cast("long").alias("doc_id"),
                        F.col(f"`{text_col}`").alias("text"))
    marked = whole.withColumn("digest", _digest(F.col("text")))
    joined = marked.join(places, marked["doc_id"].eqNullSafe(F.col("_id"))
                         & (F.col("digest") == F.col("_digest")), "left")
    joined = joined.select("doc", "text", "places")

    def rebuild(batches):
        for batch in batches:
            clean, lines, removed = [], [], []
            for text, places in zip(batch["text"], batch["places"].to_pylist()):
                text = text.as_py()
                own = _lines(text)
                lines.append(len(own))
                gone = {own[p + k][0] for p in places or () for k in range(n)}
                removed.append(len(gone))
                clean.append(text if not gone else "\n".join(
                    x for i, x in enumerate(text.split("\n")) if i not in gone))
            yield pa.RecordBatch.from_arrays(
                [batch["doc"], pa.array(clean, pa.string()), pa.array(lines, pa.int64()),
                 pa.array(removed, pa.int64())],
                names=["doc", "clean_text", "n_lines", "n_removed"])

    out = (joined.select("doc").schema.add("clean_text", "string")
           .add("n_lines", "long").add("n_removed", "long"))
    return joined.mapInArrow(rebuild, out)
