"""Vector codes by product quantisation, with k-means sped up by metric trees.

Vectors are cut into parts; every part position has a codebook. Vectors are dealt to blocks, and
for each block and position an anchors hierarchy is built once: about sqrt(n) anchors take the
points nearest to them (in the middle), anchors are split into smaller ones (down) and merged
pair by pair into a root (up). Every ball caches the count and the sum of its points.

A round goes down each tree with a list of the entries that can still be nearest to some point of
a ball. An entry leaves the list when another one is nearer to the whole ball, and children
inherit what is left. A ball with one entry left is owned by it and adds its cached count and sum;
only points of small balls without an owner are compared with the entries left to them. Entries
are dropped only when the difference is beyond the rounding error, and points are compared in
integers, so the result is that of comparing everything.
"""

from __future__ import annotations

import hashlib
import io
import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docgraph.plans import storage

PARTS = 16
ENTRIES = 64
ROUNDS = 2
SCALE = 256

#: Vectors of a block; a tree per block and position.
BLOCK = 4096

#: Of distances, relative: far above the rounding error of doubles.
MARGIN = 1e-9


@dataclass
class Tree:
    """Balls of one block and position: leaves first, then anchors, then merged balls up to the root."""

    points: np.ndarray  # (n, width), in the order of the leaves
    order: np.ndarray  # place of each of them in the block
    leaf: np.ndarray  # leaf of each of them
    parent: np.ndarray
    depth: np.ndarray
    count: np.ndarray
    total: np.ndarray
    radius: np.ndarray


def _distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.sqrt(((a - b) ** 2).sum(-1))


def _anchors(x: np.ndarray, k: int) -> np.ndarray:
    """Owner of every point among up to k anchors.

    Each new anchor is the point furthest from the anchor of largest radius. It cannot take a point
    that is nearer to its anchor than half the distance of the two anchors.
    """
    owner = np.zeros(len(x), np.int64)
    d = _distance(x, x[0])
    pivots = [x[0]]
    while len(pivots) < k:
        new = x[int(d.argmax())]
        if d.max() == 0:
            break
        half = _distance(np.array(pivots), new) / 2
        near = np.flatnonzero(d >= half[owner])
        own = _distance(x[near], new)
        take = own < d[near]
        owner[near[take]], d[near[take]] = len(pivots), own[take]
        pivots.append(new)
    return np.unique(owner, return_inverse=True)[1]


def _split(x: np.ndarray, group: np.ndarray) -> np.ndarray:
    """Owner of every point after each group (ascending) got anchors of its own, sqrt of its size.

    All groups gain one anchor at a time: their point furthest from its anchor.
    """
    start = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1])))
    size = np.diff(np.append(start, len(group)))
    wanted = np.ceil(np.sqrt(size)).astype(np.int64)
    nth = np.zeros(len(x), np.int64)
    d = _distance(x, x[start][group])
    for k in range(1, int(wanted.max())):
        far = np.maximum.reduceat(d, start)
        grows = (wanted > k) & (far > 0)
        if not grows.any():
            break
        hit = np.flatnonzero(d == far[group])
        new = hit[np.unique(group[hit], return_index=True)[1]]
        own = _distance(x, x[new][group])
        take = grows[group] & (own < d)
        nth[take], d[take] = k, own[take]
    return np.unique(group * len(x) + nth, return_inverse=True)[1]


def _merge(count: np.ndarray, total: np.ndarray, radius: np.ndarray):
    """Merge balls, each time the two whose common ball is smallest; parent of each, and new balls."""
    k = len(count)
    n = 2 * k - 1
    c, s, r = np.zeros(n), np.zeros((n, total.shape[1])), np.zeros(n)
    c[:k], s[:k], r[:k] = count, total, radius
    parent = np.full(n, -1, np.int64)
    cost = np.full((n, n), np.inf)

    def common(i: int, js: np.ndarray) -> np.ndarray:
        center = (s[i] + s[js]) / (c[i] + c[js])[:, None]
        return np.maximum(_distance(center, s[i] / c[i]) + r[i],
                          _distance(center, s[js] / c[js][:, None]) + r[js])

    live = np.zeros(n, bool)
    for i in range(k):
        js = np.flatnonzero(live)
        if len(js):
            cost[i, js] = cost[js, i] = common(i, js)
        live[i] = True
    for new in range(k, n):
        i, j = divmod(int(cost.argmin()), n)
        r[new] = cost[i, j] * (1 + MARGIN)
        c[new], s[new] = c[i] + c[j], s[i] + s[j]
        parent[[i, j]] = new
        live[[i, j]] = False
        cost[[i, j], :] = cost[:, [i, j]] = np.inf
        js = np.flatnonzero(live)
        if len(js):
            cost[new, js] = cost[js, new] = common(new, js)
        live[new] = True
    return parent, r[k:]


def tree(points: np.ndarray) -> Tree:
    """The hierarchy over integer points (n, width), n > 0."""
    x = points.astype(np.float64)
    anchor = _anchors(x, math.ceil(math.sqrt(len(x))))
    order = np.argsort(anchor, kind="stable")
    leaf = _split(x[order], anchor[order])
    again = np.argsort(leaf, kind="stable")
    order, leaf = order[again], leaf[again]
    anchor, points, x = anchor[order], points[order], x[order]

    def balls(group: np.ndarray):
        start = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1])))
        count = np.diff(np.append(start, len(group)))
        total = np.add.reduceat(points, start, axis=0)
        away = _distance(x, (total / count[:, None])[group])
        return start, count, total, np.maximum.reduceat(away, start) * (1 + MARGIN)

    begin, n1, t1, r1 = balls(leaf)
    _, n2, t2, r2 = balls(anchor)
    leaves, mids = len(n1), len(n2)
    up, r3 = _merge(n2, t2, r2)
    parent = np.concatenate((leaves + anchor[begin], np.where(up < 0, -1, up + leaves)))
    count = np.concatenate((n1, n2, np.zeros(mids - 1, np.int64)))
    total = np.concatenate((t1, t2, np.zeros((mids - 1, points.shape[1]), np.int64)))
    depth = np.zeros(len(parent), np.int64)
    for i in range(leaves, len(parent)):  # a ball comes before the one it is merged into
        if parent[i] >= 0:
            count[parent[i]] += count[i]
            total[parent[i]] += total[i]
    for i in range(len(parent) - 2, leaves - 1, -1):
        depth[i] = depth[parent[i]] + 1
    depth[:leaves] = depth[parent[:leaves]] + 1
    return Tree(points, order, leaf, parent, depth, count, total, np.concatenate((r1, r2, r3)))


@dataclass
class Owners:
    """Owner of every point (in leaf order), and the topmost owned balls with theirs."""

    point: np.ndarray
    ball: np.ndarray
    ball_owner: np.ndarray
    compared: np.ndarray  # points without an owned ball


def owners(t: Tree, entries: np.ndarray) -> Owners:
    """Nearest entry of every point, ties to the lower index."""
    e = entries.astype(np.float64)
    apart = _distance(e[:, None], e[None])
    first = np.unique(entries, axis=0, return_index=True)[1]
    lists = np.zeros((len(t.parent), len(e)), bool)
    owner = np.full(len(t.parent), -1, np.int64)
    top = np.zeros(len(t.parent), bool)
    center = t.total / t.count[:, None]
    for level in range(int(t.depth.max()) + 1):
        at = np.flatnonzero(t.depth == level)
        up = t.parent[at]
        if level == 0:
            lists[np.ix_(at, first)] = True  # of equal entries only the first can win
        else:
            owner[at] = owner[up]
            lists[at] = lists[up]
        at = at[owner[at] < 0]
        if not len(at):
            continue
        d = ((center[at][:, None] - e[None]) ** 2).sum(-1)
        best = np.where(lists[at], d, np.inf).argmin(1)
        least = d[np.arange(len(at)), best][:, None]
        # The difference of two squared distances is linear, and over a ball at least that at its
        # center less twice the radius times the distance of the two entries.
        beyond = 2 * t.radius[at][:, None] * apart[best] + MARGIN * (1 + d + least)
        lists[at] &= d - least <= beyond
        single = lists[at].sum(1) == 1
        owner[at[single]] = lists[at[single]].argmax(1)
        top[at[single]] = True
    point = owner[t.leaf]
    open_ = np.flatnonzero(point < 0)
    if len(open_):
        row, entry = np.nonzero(lists[t.leaf[open_]])
        d = ((t.points[open_[row]] - entries[entry]) ** 2).sum(1)
        start = np.flatnonzero(np.concatenate(([True], row[1:] != row[:-1])))
        hit = np.flatnonzero(d == np.minimum.reduceat(d, start)[row])
        point[open_] = entry[hit[np.unique(row[hit], return_index=True)[1]]]
    ball = np.flatnonzero(top)
    return Owners(point, ball, owner[ball], open_)


def _pack(trees: list[Tree]) -> bytes:
    out = io.BytesIO()
    np.savez(out, **{f"{f}{p}": v for p, t in enumerate(trees) for f, v in vars(t).items()})
    return out.getvalue()


def _unpack(data: bytes, parts: int) -> list[Tree]:
    with np.load(io.BytesIO(data)) as held:
        return [Tree(**{f: held[f"{f}{p}"] for f in Tree.__dataclass_fields__}) for p in range(parts)]


def usable(vectors: DataFrame, id_col: str, vector_col: str, label_col: str, parts: int) -> DataFrame:
    """vec_id, label and vector (doubles) of the rows that can be coded.

    Left out are null vectors, those with null or non-finite components, and those whose length is
    not that of the smallest id's vector or cannot be cut into equal parts.
    """
    rows = vectors.select(
        F.col(f"`{id_col}`").alias("vec_id"), F.col(f"`{label_col}`").alias("label"),
        F.col(f"`{vector_col}`").cast("array<double>").alias("vector"))
    sound = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = rows.filter(F.col("vector").isNotNull() & sound & (F.size("vector") > 0)
                       & (F.size("vector") % parts == 0))
    least = rows.orderBy(F.col("vec_id").asc_nulls_last()).select(F.size("vector").alias("n")).first()
    return rows.filter(F.size("vector") == (least.n if least else 0))


def integers(vector: np.ndarray, scale: int, width: int) -> np.ndarray:
    """floor(scale * x), held to where a part's squared distances fit 64 bits (2**29 for width 4)."""
    limit = math.isqrt((1 << 60) // width)
    return np.clip(np.floor(scale * vector), -limit, limit).astype(np.int64)


def _blocks(rows: DataFrame, dim: int, parts: int, scale: int, block: int) -> DataFrame:
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    width = dim // parts

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, block):
                own = batch.slice(at, block)
                x = integers(own["vector"].flatten().to_numpy(), scale, width).reshape(-1, parts, width)
                ends = pa.array([0, own.num_rows], pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [pa.ListArray.from_arrays(ends, own["vec_id"]), pa.ListArray.from_arrays(ends, own["label"]),
                     pa.array([_pack([tree(x[:, p]) for p in range(parts)])], pa.binary())],
                    names=["ids", "labels", "trees"])

    return rows.mapInArrow(work, f"ids array<{kinds['vec_id']}>, labels array<{kinds['label']}>, trees binary")


def seeds(rows: DataFrame, parts: int, entries: int, scale: int) -> np.ndarray:
    """Codebooks (parts, entries, width) of the smallest ids; of equal ids the least vector counts."""
    first = rows.filter("vec_id is not null").select("vec_id").distinct().orderBy("vec_id").limit(entries)
    found = rows.join(F.broadcast(first), "vec_id", "left_semi").groupBy("vec_id").agg(
        F.min("vector").alias("vector")).orderBy("vec_id").collect()
    x = np.array([r.vector for r in found])
    width = x.shape[1] // parts if len(found) else 0
    return integers(x, scale, width).reshape(len(x), parts, width).transpose(1, 0, 2) if len(found) else x


def _improved(blocks: DataFrame, books: np.ndarray) -> np.ndarray:
    """Codebooks of the floored means; what comes back has a row per component of the codebooks."""
    parts, entries, width = books.shape

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, total = np.zeros((parts, entries), np.int64), np.zeros(books.shape, np.int64)
        for batch in batches:
            for data in batch["trees"]:
                for p, t in enumerate(_unpack(data.as_py(), parts)):
                    own = owners(t, books[p])
                    np.add.at(count[p], own.ball_owner, t.count[own.ball])
                    np.add.at(total[p], own.ball_owner, t.total[own.ball])
                    np.add.at(count[p], own.point[own.compared], 1)
                    np.add.at(total[p], own.point[own.compared], t.points[own.compared])
        p, e = np.nonzero(count)
        cell = ((p * entries + e)[:, None] * width + np.arange(width)).ravel()
        yield pa.RecordBatch.from_arrays(
            [pa.array(cell, pa.int64()), pa.array(np.repeat(count[p, e], width)), pa.array(total[p, e].ravel())],
            names=["cell", "n", "total"])

    sums = blocks.select("trees").mapInArrow(work, "cell long, n long, total long").groupBy("cell").agg(
        F.sum("n").alias("n"), F.sum(F.col("total").cast("decimal(38,0)")).alias("total"))
    out = books.copy()
    flat = out.reshape(-1)
    for cell, n, total in sums.collect():
        flat[cell] = int(total) // n
    return out


def _coded(blocks: DataFrame, books: np.ndarray, kinds: dict[str, str]) -> DataFrame:
    parts = len(books)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                ids, labels = batch["ids"].slice(i, 1).flatten(), batch["labels"].slice(i, 1).flatten()
                code = np.zeros((len(ids), parts), np.uint8)
                error = np.zeros(len(ids), np.int64)
                for p, t in enumerate(_unpack(batch["trees"][i].as_py(), parts)):
                    own = owners(t, books[p]).point
                    code[t.order, p] = own
                    error[t.order] += ((t.points - books[p][own]) ** 2).sum(1)
                text = code.tobytes().hex()
                yield pa.RecordBatch.from_arrays(
                    [ids, labels, pa.array([text[k:k + 2 * parts] for k in range(0, len(text), 2 * parts)]),
                     pa.array(error)], names=["vec_id", "label", "code", "error"])

    return blocks.mapInArrow(work, f"vec_id {kinds['vec_id']}, label {kinds['label']}, code string, error long")


@dataclass
class Codes:
    """Coded vectors (vec_id, label, code, error) and the codebooks (parts, entries, width)."""

    rows: DataFrame
    books: np.ndarray


def coded(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
          label_col: str = "label", parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS,
          scale: int = SCALE, block: int = BLOCK) -> Codes:
    """Learn codebooks from all vectors and code all of them.

    ``entries`` is at most 256 (two hex digits). With fewer ids than entries the codebooks are
    shorter. Repeated rows count as often as they occur; null ids are coded but are no seeds; rows
    left out are described in ``usable``; an empty table gives no rows and an empty codebook.
    """
    if not 1 <= entries <= 256:
        raise ValueError("a code has two hex digits: 1 to 256 entries")
    rows = usable(vectors, id_col, vector_col, label_col, parts)
    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    books = seeds(rows, parts, entries, scale)
    if not books.size:
        none = rows.filter("false").select(
            "vec_id", "label", F.lit("").alias("code"), F.lit(0).cast("long").alias("error"))
        return Codes(none, np.zeros((parts, 0, 0), np.int64))
    dim = parts * books.shape[2]
    blocks = storage.stored(_blocks(rows, dim, parts, scale, block), "blocks")
    for _ in range(rounds):
        books = _improved(blocks, books)
    return Codes(storage.stored(_coded(blocks, books, kinds), "codes"), books)


def digest(books: np.ndarray) -> str:
    """SHA-256 of all components by part, entry and place, joined by commas."""
    return hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()


def with_label_error(codes: Codes) -> DataFrame:
    """vec_id, code, error, label_error (the sum over the label's vectors; nulls are one label;
    null where it passes 64 bits) and the codebooks' digest."""
    sums = codes.rows.groupBy("label").agg(F.try_sum("error").alias("label_error"))
    rows, sums = codes.rows.alias("v"), sums.alias("s")
    return rows.join(sums, F.col("v.label").eqNullSafe(F.col("s.label"))).select(
        "vec_id", "code", "error", "label_error", F.lit(digest(codes.books)).alias("codebooks_sha256"))
