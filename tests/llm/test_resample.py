"""Importance resampling against brute force in plain Python."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from docgraph.llm import resample
from pyspark.sql import functions as F

SCHEMA = "doc_id long, text string, lang string, score double, rank int"


def features(text):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    ws = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text)
    return len(ws), [zlib.crc32(x.encode()) % 10000 for x in ws + [f"{a} {b}" for a, b in zip(ws, ws[1:])]]


def expected(rows, target, percent=25, least=20):
    """Rows of (doc_id, n_features, weight, score, rank); rows equal in score and id share ranks."""
    own, near = [(i, *features(t)) for i, t in rows], [features(t)[1] for t in target]
    s, t = Counter(x for _, _, f in own for x in f), Counter(x for f in near for x in f)
    wide, close = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[i] + 1) * (wide + 10000) / ((s[i] + 1) * (close + 10000))))
            for i in range(10000)]
    out = []
    for i, n, f in own:
        weight = sum(gain[x] for x in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"7:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        out.append([i, len(f), weight, score, None, n])
    fit = sorted((r for r in out if r[5] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for rank, r in enumerate(fit[:percent * len(fit) // 100], 1):
        r[4] = rank
    return sorted((tuple(r[:5]) for r in out), key=str)


def result(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_features", "weight", "score", "rank").collect()),
                  key=str)


def words(rng, n):
    return " ".join("".join(rng.choice("abcdefgh") for _ in range(rng.randint(1, 4))) for _ in range(n))


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(5)
    texts = [words(rng, rng.randint(5, 80)) for _ in range(120)]
    texts += [None, "", " \n", "Öl straße ÉTÉ 東京 タワー " * 9, "x" * 300 + " " + "y" * 65 + " z " * 20,
              words(rng, 20_000), "no,punct;in-words " * 12, "a\x00b\x7fc " * 15]
    return list(enumerate(texts)) + [(None, words(rng, 40)), (3, texts[3]), (3, texts[3])]


@pytest.fixture(scope="module")
def target():
    rng = random.Random(6)
    return [words(rng, 30), None, "", "Öl straße"]


@pytest.mark.parametrize("half_width", [0.002, 1e-9, 0.5])
def test_resampling(spark, rows, target, half_width):
    docs = spark.createDataFrame([(i, t, "en", 1.5, 2) for i, t in rows], SCHEMA).repartition(5)
    near = spark.createDataFrame([(t,) for t in target], "text string")
    got = resample.resampled(docs, near, half_width=half_width)
    assert result(got) == expected(rows, target)


def test_ties_go_to_the_smaller_id(spark):
    scores = spark.createDataFrame([(x,) for x in [5] * 60 + [9] * 3 + [1] * 37], "score long")
    for k in (1, 3, 4, 50, 63, 64, 100):
        b = resample.bracket(scores, "score", k, 100)
        assert b.above < k <= b.reached


def test_empty_tables(spark, rows, target):
    docs = spark.createDataFrame([(i, t, "en", 1.5, 2) for i, t in rows], SCHEMA)
    near = spark.createDataFrame([(t,) for t in target], "text string")
    assert resample.resampled(docs.filter("false"), near).collect() == []
    assert result(resample.resampled(docs, near.filter("false"))) == expected(rows, [])
    few = docs.filter("doc_id < 3")
    assert all(r["rank"] is None for r in resample.resampled(few, near).collect())


def test_other_id_types(spark, rows, target):
    docs = spark.createDataFrame([(i, t, "en", 1.5, 2) for i, t in rows if i is not None], SCHEMA)
    near = spark.createDataFrame([(t,) for t in target], "text string")
    named = docs.withColumn("doc_id", F.col("doc_id").cast("string"))
    a = {str(r.doc_id): r.score for r in resample.resampled(docs, near).collect()}
    assert a == {r.doc_id: r.score for r in resample.resampled(named, near).collect()}


def test_checksums_are_those_of_the_bytes():
    rng = random.Random(8)
    parts = [bytes(rng.randrange(256) for _ in range(rng.choice([1, 2, 5, 63, 64, 65, 200])))
             for _ in range(300)]
    data = np.frombuffer(b"".join(parts), np.uint8)
    length = np.array([len(p) for p in parts])
    start = np.cumsum(length) - length
    crc = resample.word_crcs(data, start, length)
    assert crc.tolist() == [zlib.crc32(p) for p in parts]
    both = resample.joined_crcs(crc[:-1], crc[1:], data, start[1:], length[1:])
    assert both.tolist() == [zlib.crc32(a + b" " + b) for a, b in zip(parts, parts[1:])]
