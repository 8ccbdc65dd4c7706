"""The quality models tell all bytes apart."""

import random

import numpy as np
import pyarrow as pa

from docgraph.llm import kernel, quality

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def prose(rng, n, letters):
    return " ".join("".join(rng.choice(letters) for _ in range(rng.randrange(1, 6))) for _ in range(n))


def test_each_byte_is_a_symbol():
    chunk = next(kernel.chunks(pa.array([bytes(range(256)), b"ab", b"", b"b"], pa.binary())))
    codes, _ = quality._codes(chunk)
    size = quality.SYMBOLS
    assert sorted(codes[:256] % size) == list(range(256)) and len(set(codes.tolist())) == 259
    start = quality.BOUNDARY
    assert [(c // size ** 2, c // size % size, c % size) for c in codes[256:]] == [
        (start, start, 97), (start, 97, 98), (start, start, 98)]


def test_model_of_bytes_is_a_distribution():
    rng = np.random.default_rng(1)
    size = quality.SYMBOLS
    codes = np.unique(rng.integers(0, size ** 3, 3_000))
    model = quality.fitted(codes, rng.integers(1, 6, len(codes)), size)
    for history in (codes[0] // size, codes[500] // size, 4_000):
        assert abs(np.exp(model.table(history * size + np.arange(size))).sum() - 1) < 1e-6
    asked = rng.choice(np.concatenate([codes, rng.integers(0, size ** 3, 3_000)]), 9_000)
    assert np.array_equal(quality._looked_up(asked, model), model.table(asked))


def test_texts_that_mix_letters_are_rejected(spark):
    """Capitals whose places in the alphabet differ by eights, and large among small Cyrillic letters."""
    rng = random.Random(8)
    for letters, others in (("ETAOIN", "MLQGYF"), ("абвгд", "АБВГД")):
        rows = [(i, prose(rng, 200, letters), "xx", "s", 1) for i in range(200)]
        rows += [(500 + i, prose(rng, 200, letters + others), "xx", "s", 1) for i in range(5)]
        rows += [(600, None, None, "s", 1), (601, "", "xx", "s", 1)]
        got = {r.doc_id: r for r in quality.verdicts(spark.createDataFrame(rows, SCHEMA)).collect()}
        assert not any(got[i].base_failed for i in range(500, 505))
        assert not any(got[i].kept for i in (*range(500, 505), 600, 601))
        assert sum(got[i].kept for i in range(200)) >= 198
