"""Near copies: what is written while they are found."""

import glob
import os
import random
import time
from itertools import combinations

from docgraph.operators import dedup
from docgraph.plans import storage


def size(path):
    return sum(os.path.getsize(f) for f in glob.glob(f"{path}/*.parquet"))


def edited(rng, words, n):
    out = list(words)
    for _ in range(n):
        out[rng.randrange(len(out))] = f"new{rng.randrange(10 ** 6)}"
    return out


def test_whole_sets_are_not_written(spark, monkeypatch, tmp_path):
    rng = random.Random(4)
    texts = [" ".join(f"word{rng.randrange(5_000)}" for _ in range(250)) for _ in range(3_000)]
    texts += [x + " tail" for x in texts[:30]]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, text string")
    df.write.parquet(str(tmp_path / "texts"))
    written, real = [], storage.work_path
    monkeypatch.setattr(storage, "work_path", lambda s, name: written.append(real(s, name)) or written[-1])
    got = {r.id: r.original for r in dedup.near(df, "id", "text").collect()}
    assert got == {3_000 + i: i for i in range(30)}
    assert sum(map(size, written)) < 2 * size(tmp_path / "texts")


def test_similar_texts_share_a_bucket(spark):
    """Also where more than one of the first runs must be shared, and at low thresholds."""
    rng = random.Random(6)
    texts = []
    for _ in range(25):
        base = [f"w{rng.randrange(300)}" for _ in range(rng.randrange(1, 400))]
        texts += [" ".join(edited(rng, base, n)[:len(base) - rng.randrange(1 + len(base) // 9)]) for n in (0, 1, len(base) // 60, len(base) // 25)]
    runs = [{tuple(w[i:i + 3]) for i in range(max(len(w) - 2, 1))} for w in map(str.split, texts)]
    held = dedup._texts(spark.createDataFrame(list(enumerate(texts)), "id long, text string"), "id", "text", 3)
    classes, rows = dedup._classes(held, "id")
    own = {r.id: r._class for r in rows.collect()}
    for threshold in (0.8, 0.3):
        met = {}
        for r in dedup._buckets(dedup._first(held, classes, 3, threshold), threshold).collect():
            met.setdefault(r._class, set()).add(r._bucket)
        alike = [(a, b) for a, b in combinations(range(len(texts)), 2) if own[a] != own[b]
                 and len(runs[a] & runs[b]) >= threshold * len(runs[a] | runs[b])]
        assert len(alike) > 30 and all(met[own[a]] & met[own[b]] for a, b in alike)


def test_writes_leave_no_shuffle_files(spark):
    folders = list(spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirsString())
    files = lambda: {f for d in folders for f in glob.glob(f"{d}/*/shuffle_*.data")}
    before = files()
    with storage.tidy(spark):
        held = storage.stored(spark.range(10_000).repartition(4, "id"), "numbers")
    end = time.time() + 20
    while files() - before and time.time() < end:
        time.sleep(0.2)
    assert not files() - before and held.count() == 10_000
    assert spark.conf.get(storage.TIDY) == "false"
