"""Vector codes: trees against comparing everything, codebooks against plain k-means on integers."""

import hashlib
import math
import random

import numpy as np
import pytest
from docgraph.llm import codes

SCHEMA = "vec_id long, embedding array<float>, label int, code string, ids int"


def brute(rows, parts, entries, rounds):
    """(vec_id, code, error, label_error, digest) of usable rows of one length."""
    kept = [(i, [math.floor(256 * x) for x in v], y) for i, v, y in rows]
    width = len(kept[0][1]) // parts
    cut = lambda v, p: v[p * width:(p + 1) * width]
    far = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    first = {}
    for i, v, _ in sorted((r for r in kept if r[0] is not None), key=lambda r: (r[0], r[1])):
        first.setdefault(i, v)
    books = [[cut(first[i], p) for i in sorted(first)[:entries]] for p in range(parts)]
    near = lambda v, p: min((far(cut(v, p), e), k) for k, e in enumerate(books[p]))
    for _ in range(rounds):
        fresh = []
        for p in range(parts):
            own = [near(v, p)[1] for _, v, _ in kept]
            fresh.append([e if k not in own else [
                sum(cut(v, p)[j] for (_, v, _), o in zip(kept, own) if o == k) // own.count(k)
                for j in range(width)] for k, e in enumerate(books[p])])
        books = fresh
    out = [(i, "".join(f"{near(v, p)[1]:02x}" for p in range(parts)),
            sum(near(v, p)[0] for p in range(parts)), y) for i, v, y in kept]
    text = ",".join(str(x) for b in books for e in b for x in e)
    total = {}
    for _, _, e, y in out:
        total[y] = total.get(y, 0) + e
    return sorted(((i, c, e, total[y], hashlib.sha256(text.encode()).hexdigest()) for i, c, e, y in out), key=str)


def result(df):
    return sorted((tuple(r) for r in df.select(
        "vec_id", "code", "error", "label_error", "codebooks_sha256").collect()), key=str)


def vectors(seed, n, dim):
    rng = random.Random(seed)
    hot = [rng.gauss(0, 0.2) for _ in range(dim)]
    rows = [(i, hot if rng.random() < 0.3 else [rng.gauss(0, 0.2) for _ in range(dim)],
             rng.choice([None, 1, 2])) for i in range(n)]
    return [(i, np.array(v, np.float32).tolist(), y) for i, v, y in rows]


def frame(spark, rows):
    return spark.createDataFrame([(i, v, y, "x", 1) for i, v, y in rows], SCHEMA)


@pytest.mark.parametrize("n,dim,parts,entries", [(150, 8, 2, 8), (40, 12, 4, 64), (1, 4, 2, 4), (120, 3, 3, 256)])
def test_codes_equal_brute_force(spark, n, dim, parts, entries):
    rows = vectors(n, n, dim)
    rows += [(None, rows[0][1], 1), rows[0], (0, rows[-1][1], None)]
    got = codes.with_label_error(codes.coded(frame(spark, rows).repartition(3), parts=parts, entries=entries, block=50))
    assert result(got) == brute(rows, parts, entries, 2)


def test_unusable_rows_are_left_out(spark):
    rows = vectors(2, 30, 8)
    odd = [(-1, None, 1), (-2, [], 1), (-3, [float("nan")] * 8, 1), (-4, [float("inf")] * 8, 1),
           (-5, [None] + [1.0] * 7, 1), (100, [0.5] * 4, 1), (101, [0.5] * 3, 2)]
    got = codes.with_label_error(codes.coded(frame(spark, rows + odd), parts=4, entries=5))
    assert result(got) == brute(rows, 4, 5, 2)


def test_empty_and_huge(spark):
    assert codes.with_label_error(codes.coded(frame(spark, []))).collect() == []
    got = codes.coded(frame(spark, [(i, [3e38, -3e38] * 16, 1) for i in range(3)])).rows.collect()
    assert [r.error for r in got] == [0, 0, 0]


@pytest.mark.parametrize("spread", [1, 5, 40, 3000])
def test_trees_lose_no_tie(spread):
    rng = np.random.default_rng(spread)
    points = np.concatenate([rng.integers(-spread, spread + 1, (700, 4)), np.full((300, 4), 2)])
    entries = np.concatenate([rng.integers(-spread, spread + 1, (30, 4)), points[:3], points[:3]])
    t = codes.tree(points)
    own = codes.owners(t, entries)
    want = ((t.points[:, None] - entries[None]) ** 2).sum(2).argmin(1)
    assert (own.point == want).all() and (points[t.order] == t.points).all()
    inside = np.bincount(own.point, minlength=len(entries))
    cached = np.zeros(len(entries), int)
    np.add.at(cached, own.ball_owner, t.count[own.ball])
    np.add.at(cached, own.point[own.compared], 1)
    assert (cached == inside).all()


def test_far_balls_need_no_comparison():
    rng = np.random.default_rng(0)
    points = np.concatenate([rng.integers(-3, 4, (500, 4)) + c for c in (0, 1000, 5000)])
    entries = np.array([[0] * 4, [1000] * 4, [5000] * 4])
    own = codes.owners(codes.tree(points), entries)
    assert len(own.compared) == 0 and len(own.ball) < 40


def test_balls_hold_their_points():
    rng = np.random.default_rng(4)
    t = codes.tree(rng.integers(-50, 50, (400, 3)))
    node = t.leaf.copy()
    while (node >= 0).any():
        at = node >= 0
        away = np.sqrt(((t.points[at] - t.total[node[at]] / t.count[node[at]][:, None]) ** 2).sum(1))
        assert (away <= t.radius[node[at]] + 1e-9).all()
        node[at] = t.parent[node[at]]
    assert t.count[-1] == 400 and (t.total[-1] == t.points.sum(0)).all()
