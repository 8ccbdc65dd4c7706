"""Best-two-fit packing of tokenised documents into sequences of a fixed length.

A sequence is filled greedily, longest document first. Then its smallest document makes way for
the two unpacked documents that fill the widened gap best, if any two do better than it.

Documents of equal length are interchangeable, so what there is to pack is a histogram with one
count per length, which never has more rows than a sequence has tokens. The packing of the
histogram is a list of patterns (lengths of a sequence) with the number of sequences that follow
them. On the rows only two things are left to do, both distributed: number the documents of
each length, and look up the pattern, sequence and offset that belong to the number.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docgraph.plans import ordered, storage

LENGTH = 2048
END = 0

#: Tokens after which a task hands over a batch of pieces.
BATCH_TOKENS = 1 << 20


@lru_cache(maxsize=2)
def encoding(path: str) -> tiktoken.Encoding:
    """The byte-level BPE of a tokenizer file, merged by ranks.

    Ids of such a file are the ranks of its merges, so both libraries give the same ids; merging
    by ranks takes less than half the time.
    """
    from public_tokenizers import PATTERN
    from tokenizers.pre_tokenizers import ByteLevel

    with open(path, encoding="utf-8") as f:
        model = json.load(f)
    special = {x["content"]: x["id"] for x in model["added_tokens"]}
    shown = sorted(ByteLevel.alphabet())
    # Bytes that print stand for themselves, the others for the letters from U+0100 on, in order.
    plain = {ord(c): c for c in shown if ord(c) < 256}
    others = iter(c for c in shown if ord(c) >= 256)
    byte_of = {plain.get(b) or next(others): b for b in range(256)}
    ranks = {bytes(byte_of[c] for c in piece): i for piece, i in model["model"]["vocab"].items()
             if piece not in special}
    return tiktoken.Encoding("file", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=special)


def tokenizer_file() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def pieces(docs: DataFrame, length: int = LENGTH, path: str | None = None, end: int = END,
           id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, piece, start, length, ids (little-endian unsigned 32-bit) of every document.

    A document's ids are followed by ``end``. One of more than ``length`` ids is cut so that only
    its first piece is shorter. Null and empty texts are the end id alone.
    """
    path = path or tokenizer_file()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoding(path)
        for batch in batches:
            rows: list[tuple[int, int, int, int, bytes]] = []
            held = 0
            for i, text in enumerate(batch["text"]):
                ids = np.append(encode.encode(text.as_py() or "", allowed_special="all"), end).astype("<u4")
                at, cut = 0, len(ids) % length or length
                if len(ids) <= length:
                    cut = len(ids)
                for k in range(-(-len(ids) // length)):
                    rows.append((i, k, at, cut - at, ids[at:cut].tobytes()))
                    held += cut - at
                    at, cut = cut, cut + length
                    if held >= BATCH_TOKENS:
                        yield _batch(batch, rows)
                        rows, held = [], 0
            if rows:
                yield _batch(batch, rows)

    slim = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    kind = slim.schema["doc_id"].dataType.simpleString()
    return slim.mapInArrow(work, f"doc_id {kind}, piece int, start long, length long, ids binary")


def _batch(batch: pa.RecordBatch, rows: list[tuple[int, int, int, int, bytes]]) -> pa.RecordBatch:
    at, piece, start, length, ids = zip(*rows)
    return pa.RecordBatch.from_arrays(
        [batch["doc_id"].take(pa.array(at, pa.int64())), pa.array(piece, pa.int32()),
         pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(ids, pa.binary())],
        names=["doc_id", "piece", "start", "length", "ids"])


Pattern = list[tuple[int, int]]


def patterns(counts: np.ndarray, size: int, swap: bool = True) -> list[tuple[Pattern, int]]:
    """Best-two-fit over a histogram: (lengths with their copies, number of sequences) in order.

    ``counts[x]`` documents have length x. A pattern holds for as many sequences as there are
    documents for it, as the same choice would be made again; so the list is short even for
    large counts. Ties go to the pair with the longer document.
    """
    left = np.array(counts, np.int64)
    out: list[tuple[Pattern, int]] = []
    values = np.arange(size + 1)
    while left.any():
        upto = np.maximum.accumulate(np.where(left > 0, values, 0))
        used: dict[int, int] = {}
        gap, x = size, int(upto[size])
        while x:
            n = min(int(left[x]), gap // x)
            used[x] = n
            gap -= n * x
            x = int(upto[min(gap, x - 1)])
        if swap and gap and sum(used.values()) > 1:
            smallest = min(used)
            free = left.copy()
            for x, n in used.items():
                free[x] -= n
            pair = _pair(free, gap + smallest, smallest)
            if pair:
                used[smallest] -= 1
                for x in pair:
                    used[x] = used.get(x, 0) + 1
        pattern = sorted(((x, n) for x, n in used.items() if n), reverse=True)
        times = min(int(left[x]) // n for x, n in pattern)
        for x, n in pattern:
            left[x] -= n * times
        out.append((pattern, times))
    return out


def fewest(counts: np.ndarray, size: int) -> list[tuple[Pattern, int]]:
    """Best-two-fit, or its greedy first step alone where the swaps have cost a sequence.

    Swaps use short documents up early, which may leave a gap in the last few sequences.
    """
    plans = [patterns(counts, size, swap) for swap in (True, False)]
    return min(plans, key=lambda plan: sum(times for _, times in plan))


def _pair(free: np.ndarray, room: int, least: int) -> tuple[int, int] | None:
    """The two unpacked lengths of the largest sum over ``least`` and up to ``room``."""
    upto = np.maximum.accumulate(np.where(free > 0, np.arange(len(free)), 0))
    long = np.flatnonzero(free[:room])
    if not len(long):
        return None
    other = upto[np.minimum(room - long, long)]
    alone = (other == long) & (free[long] < 2)
    other[alone] = upto[long[alone] - 1]
    total = np.where(other > 0, long + other, 0)
    best = len(total) - 1 - int(np.argmax(total[::-1]))
    return (int(long[best]), int(other[best])) if total[best] > least else None


@dataclass
class Places:
    """Ranges of numbers per length, ascending, with what a range's documents share.

    Numbers are below 2**44.
    """

    length: np.ndarray
    first: np.ndarray
    sequence: np.ndarray
    copies: np.ndarray
    offset: np.ndarray

    def of(self, length: np.ndarray, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Sequence and offset of the documents with these numbers among those of their length."""
        at = np.searchsorted(self.length << 44 | self.first, length << 44 | number, "right") - 1
        nth = number - self.first[at]
        return (self.sequence[at] + nth // self.copies[at],
                self.offset[at] + nth % self.copies[at] * length)


def places(plan: list[tuple[Pattern, int]]) -> Places:
    """Deal the numbers of each length out to the patterns in order."""
    rows, taken, sequence = [], {}, 0
    for pattern, times in plan:
        offset = 0
        for x, n in pattern:
            rows.append((x, taken.get(x, 0), sequence, n, offset))
            taken[x] = taken.get(x, 0) + n * times
            offset += n * x
        sequence += times
    table = np.array(sorted(rows), np.int64).reshape(-1, 5)
    return Places(*(np.ascontiguousarray(c) for c in table.T))


def placed(cut: DataFrame, length: int = LENGTH) -> DataFrame:
    """Add sequence_id and offset to pieces with a ``length`` column.

    The histogram has at most ``length`` rows. The pieces of a length are numbered by their places in
    the whole order by length, so one very common length is spread over many tasks.
    """
    counts = np.zeros(length + 1, np.int64)
    for x, n in cut.groupBy("length").count().collect():
        counts[x] = n
    where = places(fewest(counts, length))
    before = np.concatenate(([0], np.cumsum(counts)))
    rows = ordered.numbered(cut, ["length"], "_number", "lengths")
    schema = f"{', '.join(f'`{f.name}` {f.dataType.simpleString()}' for f in cut.schema)}, " \
             "sequence_id long, offset long"

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size = batch["length"].to_numpy()
            sequence, offset = where.of(size, batch["_number"].to_numpy() - before[size])
            yield pa.RecordBatch.from_arrays(
                [*(batch[c] for c in batch.schema.names if c != "_number"), pa.array(sequence), pa.array(offset)],
                names=[*(c for c in batch.schema.names if c != "_number"), "sequence_id", "offset"])

    return rows.mapInArrow(work, schema)


def packed(docs: DataFrame, length: int = LENGTH, path: str | None = None, end: int = END,
           id_col: str = "doc_id", text_col: str = "text", with_ids: bool = True) -> DataFrame:
    """Every piece with its ids and its place: doc_id, piece, start, length, ids, ids_crc32,
    sequence_id, offset (gapless from 0 in every sequence). Without ``with_ids`` ids stay behind.

    Repeated rows are packed like different ones; null ids are kept; an empty table gives an empty
    result; a text longer than a sequence is cut. Ids may have any type; other columns are not read.
    """
    cut = pieces(docs, length, path, end, id_col, text_col)
    cut = cut.withColumns({"ids_crc32": F.crc32("ids"), "_row": F.monotonically_increasing_id()})
    cut = storage.stored(cut, "pieces")
    out = placed(cut.drop("ids"), length)
    if with_ids:
        out = out.join(cut.select("_row", "ids"), "_row")
    return out.drop("_row")


def sequences(rows: DataFrame) -> DataFrame:
    """sequence_id, its ids end to end and their number; a group has at most ``length`` pieces."""
    inside = F.sort_array(F.collect_list(F.struct("offset", "ids")))
    ids = F.aggregate(inside, F.lit(b""), lambda done, x: F.concat(done, x["ids"]))
    return rows.groupBy("sequence_id").agg(F.sum("length").alias("length"), ids.alias("ids"))
