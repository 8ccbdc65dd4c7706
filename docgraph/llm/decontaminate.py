"""Benchmark decontamination by greedy string tiling.

Benchmark items and documents are compared as sequences of lower-cased words (runs of letters,
digits and non-ASCII characters). Runs of ``least`` words that an item shares with a document
seed the search. Per document and item the longest common run of unmarked words is marked on
both sides, again and again, until none of ``least`` words is left; seeds and runs are equal
rolling (Karp-Rabin) hashes of word hashes, compared word by word. The share of an item's words
that is marked is its coverage; a passage whose parts were reordered keeps its coverage.

The benchmark is taken in blocks of bounded size, each of which goes to all tasks as sorted
arrays; the documents are never shuffled, so a passage that a third of them carry is no hot key.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docgraph.llm import kernel as K
from docgraph.llm.frames import pair
from docgraph.plans import storage

#: Words of the shortest tile, and the least share of an item's words.
LEAST, COVERAGE = 4, 0.5
#: Words of benchmark items in one block (16 bytes each and some more).
BLOCK_WORDS = 2_000_000

SPLIT = np.ones(256, bool)
SPLIT[48:58] = SPLIT[65:91] = SPLIT[97:123] = False
SPLIT[128:] = False


def _words(column: pa.Array) -> list[tuple[K.Chunk, K.Words]]:
    return [(c, K.words(c, split=SPLIT, fold=None)) for c in K.chunks(pc.utf8_lower(column))]


@dataclass
class Block:
    """Benchmark items: their words, and the hashes of their seeds in order."""

    least: int
    ids: list[int]
    words: list[np.ndarray]
    sizes: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]  # seed length: hash, item, place


def block(items: list[tuple[int, str]], least: int) -> Block:
    ids, words, seeds = [], [], {}
    texts = pa.array([t or "" for _, t in items], pa.string())
    for chunk, w in _words(texts):
        for d in range(chunk.n):
            own = w.hash[w.first[d]:w.first[d + 1]]
            if not len(own):
                continue
            size = min(least, len(own))
            part = K.Words(own, own, own, np.array([0, len(own)]))
            h, _ = K.grams(part, size)
            rows = seeds.setdefault(size, ([], [], []))
            rows[0].append(h)
            rows[1].append(np.full(len(h), len(ids)))
            rows[2].append(np.arange(len(h)))
            ids.append(items[chunk.first + d][0])
            words.append(own)
    sizes = {}
    for size, rows in seeds.items():
        h, item, place = (np.concatenate(x) for x in rows)
        order = np.argsort(h, kind="stable")
        sizes[size] = h[order], item[order], place[order]
    return Block(least, ids, words, sizes)


def tiles(item: np.ndarray, doc: np.ndarray, hits: list[tuple[int, int]],
          least: int) -> list[tuple[int, int, int]]:
    """Greedy tiling from seed hits (item place, document place): (item, document, length)."""
    heap, done = [], {}
    for i, j in sorted(hits):
        if done.get(j - i, -1) >= i:
            continue
        n = 0
        while i + n < len(item) and j + n < len(doc) and item[i + n] == doc[j + n]:
            n += 1
        done[j - i] = i + n - least
        if n >= least:
            heap.append((-n, i, j))
    heapq.heapify(heap)
    item_free, doc_free = np.ones(len(item), bool), np.ones(len(doc), bool)
    out = []
    while heap:
        n, i, j = heapq.heappop(heap)
        n = -n
        free = item_free[i:i + n] & doc_free[j:j + n]
        if free.all():
            item_free[i:i + n] = doc_free[j:j + n] = False
            out.append((i, j, n))
            continue
        edge = np.flatnonzero(np.diff(np.concatenate(([0], free.astype(np.int8), [0]))))
        for a, b in zip(edge[::2], edge[1::2]):
            if b - a >= least:
                heapq.heappush(heap, (-int(b - a), int(i + a), int(j + a)))
    return out


def coverages(column: pa.Array, own: Block) -> list[list[tuple[int, float, int]]]:
    """Per text the items that share a seed: (item, coverage, words of the longest tile)."""
    out: list[list[tuple[int, float, int]]] = [[] for _ in range(len(column))]
    for chunk, w in _words(column):
        found: dict[tuple[int, int], list[tuple[int, int]]] = {}
        for size, (hashes, item, place) in own.sizes.items():
            h, offsets = K.grams(w, size)
            at = np.minimum(np.searchsorted(hashes, h), len(hashes) - 1)
            hit = np.flatnonzero(hashes[at] == h)
            doc = np.searchsorted(offsets, hit, "right") - 1
            for g, d in zip(hit, doc):
                k = at[g]
                while k < len(hashes) and hashes[k] == h[g]:
                    found.setdefault((int(d), int(item[k])), []).append(
                        (int(place[k]), int(g - offsets[d])))
                    k += 1
        for (d, i), hits in found.items():
            words = own.words[i]
            marked = tiles(words, w.hash[w.first[d]:w.first[d + 1]], hits,
                           min(own.least, len(words)))
            if marked:
                out[chunk.first + d].append((own.ids[i], sum(n for *_, n in marked) / len(words),
                                             max(n for *_, n in marked)))
    return out


def blocks(benchmark: DataFrame, least: int, id_col: str = "item_id", text_col: str = "text"):
    """The benchmark in blocks of bounded size; the driver holds one at a time."""
    items, size = [], 0
    rows = benchmark.select(F.col(id_col).cast("long"), F.col(text_col))
    for item, text in rows.toLocalIterator():
        items.append((item, text))
        size += 1 + len(text or "") // 2
        if size >= BLOCK_WORDS:
            yield block(items, least)
            items, size = [], 0
    yield block(items, least)


ITEMS = "items array<struct<item_id long, coverage double, longest long>>"


def _searched(df: DataFrame, benchmark: DataFrame, least: int, coverage: float) -> DataFrame:
    """Add ``items`` to rows with a column ``text``, block by block.

    A benchmark of one block needs one pass; with more, the rows are written between passes, so
    that a task holds one block only.
    """
    df = df.withColumn("items", F.expr(f"cast(array() as {ITEMS.split(' ', 1)[1]})"))
    schema = df.schema

    def passed(own: Block):
        def work(batches):
            for batch in batches:
                found = coverages(batch["text"], own)
                items = [old + [dict(zip(("item_id", "coverage", "longest"), x))
                                for x in sorted(new, key=lambda x: (x[0] is None, x[0] or 0, x[1:]))
                                if x[1] >= coverage]
                         for old, new in zip(batch["items"].to_pylist(), found)]
                at = batch.schema.get_field_index("items")
                yield batch.set_column(at, "items", pa.array(items, batch["items"].type))

        return work

    for k, own in enumerate(blocks(benchmark, least)):
        df = (storage.stored(df, "searched") if k else df).mapInArrow(passed(own), schema)
    return df


def hits(docs: DataFrame, benchmark: DataFrame, least: int = LEAST, coverage: float = COVERAGE,
         id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: doc_id, items (id, coverage, longest tile) over the threshold, n_items,
    max_coverage and contaminated.

    Null and empty texts and items match nothing; a null item id comes last. Items shorter than ``least`` words match as a
    whole. Repeated rows are judged alike; without items no document is contaminated; an empty
    table gives an empty result.
    """
    found = _searched(pair(docs, id_col, text_col), benchmark, least, coverage)
    return found.select("doc_id", "items", F.size("items").cast("long").alias("n_items"),
                        F.coalesce(F.array_max(F.col("items.coverage")), F.lit(0.0))
                        .alias("max_coverage"), (F.size("items") > 0).alias("contaminated"))


def clean(docs: DataFrame, benchmark: DataFrame, least: int = LEAST, coverage: float = COVERAGE,
          text_col: str = "text") -> DataFrame:
    """The documents that contain no benchmark item, with all their columns."""
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("doc"),
                        F.col(f"`{text_col}`").alias("text"))
    return _searched(whole, benchmark, least, coverage).filter("size(items) = 0").select("doc.*")
