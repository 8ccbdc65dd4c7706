"""Candidates of the n-gram Jaccard join: few among unlike texts, none lost among like ones."""

import random

import numpy as np
import pytest

from docgraph.llm import jaccard
from docgraph.llm import kernel as K


@pytest.mark.parametrize("num,den", [(4, 5), (9, 10), (1, 1)])
def test_linked_sets_share_a_key(num, den):
    rng = np.random.default_rng(1)
    links = 0
    for size in [*range(1, 40), 100, 300]:
        base = K.mixed(rng.integers(0, 1 << 62, size).astype(K.U))
        sets = [np.unique(base)]
        for _ in range(12):
            change = int(rng.integers(0, size * (den - num) // den + 2))
            kept = rng.permutation(base)[:max(1, size - int(rng.integers(0, change + 1)))]
            new = K.mixed(rng.integers(0, 1 << 62, int(rng.integers(0, change + 1))).astype(K.U))
            sets.append(np.unique(np.concatenate((kept, new))))
        owner, key = jaccard.part_keys(np.concatenate(sets), np.cumsum([0] + [len(s) for s in sets]), num, den)
        keys = [set(key[owner == i].tolist()) for i in range(len(sets))]
        for i in range(len(sets)):
            for j in range(i):
                a, b = set(sets[i].tolist()), set(sets[j].tolist())
                if den * len(a & b) >= num * len(a | b):
                    links += 1
                    assert keys[i] & keys[j]
    assert links > 40


def test_unlike_texts_of_common_words_are_no_candidates(spark, monkeypatch):
    rng = random.Random(3)
    words = [f"w{i}" for i in range(30)]
    rows = [(i, " ".join(rng.choice(words) for _ in range(800))) for i in range(150)]
    seen, near = [], jaccard._near

    def counted(pairs, *rest):
        seen.append(pairs.count())
        return near(pairs, *rest)

    monkeypatch.setattr(jaccard, "_near", counted)
    got = jaccard.join(spark.createDataFrame(rows, "doc_id long, text string"), 3, 9, 10).collect()
    assert all(r.doc_id == r.component_id for r in got)
    assert max(seen) <= 150
