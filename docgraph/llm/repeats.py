"""Removal of long repeated byte strings, by suffix arrays.

Every window of ``size`` bytes (400) picks the 8-byte gram with the least hash in it as anchor,
so equal windows pick the same place. Windows are grouped by the distance from their start to the
anchor, in bins, and by the bytes that all windows of a bin have in common, the core. Equal windows
are in one group, and inside a group only the few bytes before and after the core differ. Windows
of one document that follow each other in a group form one string: flank, core, flank.

Equal strings of a group collapse to one with its number. The strings of a group, the core
written as one symbol, are sorted by a suffix array; windows are the substrings of equal length
around the core, and one is repeated if a neighbour in the array shares it. The array is built
without renaming: suffixes are grouped by their Lyndon prefix, groups are refined in descending
order through the pointers to the previous smaller suffix, and then emitted in ascending order.

A group of many different strings (a common passage with as many surroundings) is not gathered:
its windows are counted by their hashes.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docgraph.llm import kernel as K
from docgraph.llm.frames import each, pair
from docgraph.plans import storage

SIZE = 400
#: Distances from a window to its anchor that share a bin. 120 took a little less CPU and a tenth more disk.
BIN = 80
GRAM = 8
#: Different strings of a group that one suffix array takes.
STRINGS = 256
#: Bytes of text handled at once.
CHUNK = 1 << 20

ODD = int(K.BASE)
INVERSE = K.U(pow(ODD, -1, 1 << 64))
#: Bits of a place next to a hash; longer data are worked through in overlapping pieces.
PLACE = 24


def _anchors(data: np.ndarray, size: int) -> np.ndarray:
    """The anchor of the window at every place: the first least gram hash among its grams."""
    step = (1 << PLACE) - size + 1
    return np.concatenate([_near_anchors(data[at:at + step + size - 1], size) + at
                           for at in range(0, len(data) - size + 1, step)])


def _near_anchors(data: np.ndarray, size: int) -> np.ndarray:
    """The anchors of data of at most 2**PLACE bytes."""
    n = len(data) - size + 1
    wide = np.zeros(len(data) + 8, np.uint8)
    wide[:len(data)] = data
    v = wide[:-7].astype(K.U)
    for shift in range(1, 8):
        v |= wide[shift:len(wide) - 7 + shift].astype(K.U) << K.U(8 * shift)
    grams = len(data) - GRAM + 1
    # Upper bits: the hash; lower bits: the place, so that ties fall to the first.
    h = (K.mixed(v[:grams]) >> K.U(PLACE) << K.U(PLACE)) | np.arange(grams, dtype=K.U)
    span = size - GRAM + 1
    blocks = -(-grams // span) * span
    padded = np.full(blocks, np.iinfo(np.uint64).max, K.U)
    padded[:grams] = h
    rows = padded.reshape(-1, span)
    ahead = np.minimum.accumulate(rows, axis=1).ravel()
    behind = np.minimum.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    start = np.arange(n)
    least = np.minimum(behind[start], ahead[start + span - 1])
    return (least & K.U((1 << PLACE) - 1)).astype(np.int64)


class _Hashes:
    """Hashes of substrings of a chunk, from running sums of bytes times powers."""

    def __init__(self, data: np.ndarray):
        self.total = np.zeros(len(data) + 1, K.U)
        np.cumsum(K.BYTE[data] * K.powers(len(data)), out=self.total[1:])
        back = np.full(len(data) + 1, INVERSE, K.U)
        back[0] = 1
        self.back = np.multiply.accumulate(back)

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return K.mixed((self.total[end] - self.total[start]) * self.back[start])


def _strings(chunk: K.Chunk, size: int, bin_: int) -> dict[str, np.ndarray]:
    """Runs of windows of one bin and anchor: document, first and last window, core, hashes."""
    data = chunk.data
    none = {k: np.zeros(0, np.int64) for k in ("doc", "lo", "hi", "core", "key", "whole")}
    if len(data) < size:
        return none
    anchor = _anchors(data, size)
    start = np.arange(len(anchor))
    doc = np.searchsorted(chunk.starts, start, "right") - 1
    inside = start + size <= chunk.starts[doc + 1]
    slot = (anchor - start) // bin_
    new = np.ones(len(start), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (slot[1:] != slot[:-1]) | (doc[1:] != doc[:-1])
    new[1:] |= inside[1:] != inside[:-1]
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(start)) - 1
    first, last = first[inside[first]], last[inside[first]]
    if not len(first):
        return none
    core = anchor[first] - slot[first] * bin_  # the last window of the bin begins here
    end = core - (bin_ - 1) + size  # the first window of the bin ends here
    hashes = _Hashes(data)
    key = K.mixed(hashes.of(core, end) + slot[first].astype(K.U) * K.BASE)
    whole = K.mixed(hashes.of(first, last + size) + (core - first).astype(K.U) * K.BASE
                    + (last - first + 1).astype(K.U))
    own = chunk.starts[doc[first]]
    return {"doc": doc[first], "lo": first - own, "hi": last - own, "core": core - own,
            "key": key.view(np.int64), "whole": whole.view(np.int64)}


def suffix_array(s: list[int]) -> list[int]:
    """Suffix array of symbols above 0, in two phases over groups of equal Lyndon prefixes."""
    s = [*s, 0]  # an end that is before every symbol
    n = len(s)
    # Groups in ascending order, at first by the first symbol.
    order = sorted(range(n), key=s.__getitem__)
    sa, isa = order[:], [0] * n
    start, length = [0] * n, [0] * n
    i = 0
    while i < n:
        j = i
        while j < n and s[order[j]] == s[order[i]]:
            j += 1
        for k in range(i, j):
            isa[order[k]] = k
            start[order[k]] = i
        length[i] = j - i
        i = j
    prev = [-2] * n  # -2: not known yet; -1: none
    # Phase one: from the highest group to the lowest.
    hi = n - 1
    while hi >= 0:
        g = start[sa[hi]]
        size = length[g]
        members = sa[g:g + size]
        # The previous smaller suffix of each member lies in a lower group.
        found: dict[int, list[int]] = {}
        by_prev: dict[int, int] = {}
        for m in sorted(members):
            p = m - 1
            while p >= 0 and start[p] >= g:
                if start[p] == g and p in by_prev:
                    p = by_prev[p]
                else:
                    p = prev[p] if prev[p] != -2 else p - 1
            by_prev[m] = p
            prev[m] = p
            if p >= 0:
                found.setdefault(p, []).append(m)
        # Suffixes p that are followed by k members of this group grow by them; those of one
        # group with equal k stay together, larger k behind.
        split: dict[tuple[int, int], list[int]] = {}
        for p, own in found.items():
            split.setdefault((start[p], len(own)), []).append(p)
        for (group, _), own in sorted(split.items(), key=lambda x: (x[0][0], -x[0][1])):
            rest = length[group] - len(own)
            at = group + rest
            for k, p in enumerate(own):
                q, place = sa[at + k], isa[p]
                if q != p:
                    sa[place], isa[q] = q, place
                    sa[at + k], isa[p] = p, at + k
            for k in range(at, at + len(own)):
                start[sa[k]] = at
            length[at] = len(own)
            if rest:
                length[group] = rest
        hi = g - 1
    # Phase two: the suffixes whose Lyndon prefix ends where a settled suffix begins are next.
    out = [0] * n
    front = list(range(n))
    placed = [False] * n
    out[0] = n - 1
    for k in range(n):
        p = out[k] - 1
        while p >= 0 and not placed[p]:
            g = start[p]
            out[front[g]] = p
            front[g] += 1
            placed[p] = True
            p = prev[p]
    return out[1:]


def repeated_windows(strings: list[tuple[bytes, bytes, int]], width: int) -> list[list[bool]]:
    """Which windows of the strings of a group occur twice.

    A string is (bytes before the core, bytes behind it, number of copies); its windows take
    ``width`` bytes around the core, the first one as many as possible before it. All strings, the
    core as one symbol and an end each, share one suffix array; equal windows are neighbours.
    """
    text: list[int] = []
    where: dict[int, tuple[int, int]] = {}
    out = []
    for i, (left, right, _) in enumerate(strings):
        windows = len(left) + len(right) - width + 1
        out.append([False] * windows)
        for k in range(windows):
            where[len(text) + k] = (i, k)
        text += [c + 3 for c in left]
        text.append(2)
        text += [c + 3 for c in right]
        text.append(1)
    length = width + 1
    before: list[int] | None = None
    group: list[tuple[int, int]] = []

    def close():
        if len(group) > 1 or (group and strings[group[0][0]][2] > 1):
            for i, k in group:
                out[i][k] = True

    for p in suffix_array(text):
        if p not in where:
            continue
        own = text[p:p + length]
        if own != before:
            close()
            group, before = [], own
        group.append(where[p])
    close()
    return out


def _window_hashes(left: bytes, right: bytes, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit hashes of every window around the core: its bytes and how many lie before it."""
    data = np.frombuffer(left + right, np.uint8)
    views = np.lib.stride_tricks.sliding_window_view(data, width)
    before = K.BYTE[0] * np.arange(len(left), len(left) - len(views), -1).astype(K.U)
    weight = K.mixed(np.arange(1, 2 * width + 1, dtype=K.U)) | K.U(1)
    letters = K.BYTE[views]
    return tuple(K.mixed((K.mixed(letters + K.U(i)) * weight[i * width:(i + 1) * width]).sum(axis=1, dtype=K.U)
                         + before) for i in range(2))


def covered(docs: DataFrame, size: int = SIZE, bin_: int = BIN, id_col: str = "doc_id",
            text_col: str = "text") -> DataFrame:
    """row (hash of id and text) and spans: arrays of first and last repeated windows."""
    texts = pair(docs, id_col, text_col).select(
        F.xxhash64("doc_id", "text").alias("row"), F.xxhash64("text").alias("same"), "text")

    def cut(batch):
        for chunk in K.chunks(batch["text"], CHUNK):
            found = _strings(chunk, size, bin_)
            part = batch["row"].slice(chunk.first, chunk.n)
            yield {"row": part.take(pa.array(found["doc"])), "key": found["key"],
                   "whole": found["whole"], "lo": found["lo"], "hi": found["hi"],
                   "core": found["core"]}

    rows = each(texts.select("row", "text"), cut,
                "row long, key long, whole long, lo int, hi int, core int")
    keys = rows.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.min("whole").alias("a"),
                                   F.max("whole").alias("b")).filter("n > 1")
    shared = storage.stored(rows.join(keys.select("key", (F.col("a") == F.col("b")).alias("equal")),
                                      "key"), "shared")
    # One string only, twice or more: its order is trivial, all its windows are repeated.
    sure = shared.filter("equal").select("row", "lo", "hi")

    # The others: flanks of the strings, from the texts of their documents.
    spans = (shared.filter("not equal").groupBy("row").agg(F.collect_set(
        F.struct("key", "whole", "lo", "hi", "core")).alias("strings")))
    # Equal rows are worked through once, each string with the number of rows as its copies.
    times = texts.groupBy("row").agg(F.count(F.lit(1)).alias("times")).filter("times > 1")
    spans = spans.join(times, "row", "left")
    flanked = texts.select("row", "text").join(spans, "row").dropDuplicates(["row"])
    width = bin_ - 1  # bytes of a window outside the core

    def flanks(batch):
        for i in range(batch.num_rows):
            data = (batch["text"][i].as_py() or "").encode()
            own = batch["strings"][i].as_py()
            yield {"row": [batch["row"][i].as_py()] * len(own),
                   "times": [batch["times"][i].as_py() or 1] * len(own),
                   **{k: [s[k] for s in own] for k in ("key", "whole", "lo", "hi")},
                   "left": [data[s["lo"]:s["core"]] for s in own],
                   "right": [data[s["core"] - width + size:s["hi"] + size] for s in own]}

    open_ = storage.stored(each(flanked, flanks, "row long, key long, whole long, lo int, hi int, "
                                                 "times long, left binary, right binary"), "flanks")
    different = open_.groupBy("key", "whole").agg(
        F.sum("times").alias("copies"), F.first("left").alias("left"),
        F.first("right").alias("right"))
    many = different.groupBy("key").agg(F.count(F.lit(1)).alias("n"))
    different = storage.stored(different.join(many, "key"), "strings")

    def sort(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        hits = repeated_windows([(r["left"], r["right"], r["copies"]) for r in rows], width)
        return pa.Table.from_pylist(
            [{"key": r["key"], "whole": r["whole"], "hits": h} for r, h in zip(rows, hits)],
            schema=pa.schema([("key", pa.int64()), ("whole", pa.int64()),
                              ("hits", pa.list_(pa.bool_()))]))

    small = different.filter(F.col("n") <= STRINGS).groupBy("key").applyInArrow(
        sort, "key long, whole long, hits array<boolean>")

    def windows(batch):
        for r in batch.to_pylist():
            hashes = _window_hashes(r["left"], r["right"], width)
            n = len(hashes[0])
            yield {"key": [r["key"]] * n, "whole": [r["whole"]] * n, "place": np.arange(n),
                   "one": hashes[0].view(np.int64), "two": hashes[1].view(np.int64), "copies": [r["copies"]] * n}

    crowd = each(different.filter(F.col("n") > STRINGS).select("key", "whole", "left", "right",
                                                               "copies"),
                 windows, "key long, whole long, place int, one long, two long, copies long")
    same = ["key", "one", "two"]
    twice = crowd.groupBy(*same).agg(F.sum("copies").alias("n")).filter("n > 1")
    large = (crowd.join(twice.select(*same), same)
             .groupBy("key", "whole").agg(F.collect_set("place").alias("places")))
    large = large.select("key", "whole", F.transform(
        F.sequence(F.lit(0), F.array_max("places")),
        lambda i: F.array_contains("places", i)).alias("hits"))

    hits = small.unionByName(large)
    found = (open_.select("row", "key", "whole", "lo", "hi").join(hits, ["key", "whole"])
             .select("row", "lo", F.posexplode("hits").alias("at", "hit")).filter("hit")
             .select("row", (F.col("lo") + F.col("at")).alias("lo"),
                     (F.col("lo") + F.col("at")).alias("hi")))
    return sure.unionByName(found).groupBy("row").agg(
        F.collect_set(F.struct("lo", "hi")).alias("spans"))


def removed(docs: DataFrame, size: int = SIZE, bin_: int = BIN, id_col: str = "doc_id",
            text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans, kept_sha256 and kept (the remaining bytes).

    Null texts count as empty; texts shorter than ``size`` bytes lose nothing; repeated rows are
    repeats of each other; an empty table gives an empty result.
    """
    spans = covered(docs, size, bin_, id_col, text_col)
    texts = pair(docs, id_col, text_col).withColumn("row", F.xxhash64("doc_id", "text"))
    joined = texts.join(spans, "row", "left").select("doc_id", "text", "spans")

    def rebuild(batch):
        out: dict[str, list] = {k: [] for k in ("n_bytes", "n_removed", "n_spans", "kept_sha256",
                                                "kept")}
        for text, spans in zip(batch["text"], batch["spans"]):
            data = np.frombuffer((text.as_py() or "").encode(), np.uint8)
            cover = np.zeros(len(data) + 1, np.int64)
            own = spans.values
            if own is not None and len(own):
                np.add.at(cover, own.field("lo").to_numpy(), 1)
                np.add.at(cover, own.field("hi").to_numpy() + size, -1)
            gone = np.cumsum(cover)[:len(data)] > 0
            kept = data[~gone].tobytes()
            out["n_bytes"].append(len(data))
            out["n_removed"].append(int(gone.sum()))
            out["n_spans"].append(int((np.diff(gone.astype(np.int8), prepend=0) > 0).sum()))
            out["kept_sha256"].append(hashlib.sha256(kept).hexdigest())
            out["kept"].append(kept)
        yield {"doc_id": batch["doc_id"], **out}

    return each(joined, rebuild, "doc_id long, n_bytes long, n_removed long, n_spans long, "
                                 "kept_sha256 string, kept binary")
