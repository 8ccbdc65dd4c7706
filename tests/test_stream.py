"""Streams: splitting the input differently changes nothing; late rows; repeated batches."""

import os

import pytest
from pyspark.sql import functions as F

from docgraph.streaming import stream, upsert

ROWS = [(i, f"2024-01-{1 + i // 4:02d} {i % 4 * 6:02d}:00:00", i % 7) for i in range(80)]


def batches(spark, tmp_path, split, build, mode="append"):
    df = spark.createDataFrame(ROWS, "id long, t string, k long").select("id", F.to_timestamp("t").alias("ts"), "k")
    for i, ids in enumerate(split):
        df.filter(F.col("id").isin(ids)).coalesce(1).write.parquet(str(tmp_path / "in" / str(i)))
        source = stream.arriving(spark, str(tmp_path / "in"), df.schema)
        stream.run(build(source), str(tmp_path / "out"), str(tmp_path / "cp"), mode)
    return str(tmp_path / "out")


def test_latest_does_not_depend_on_arrival(spark, tmp_path):
    build = lambda s: stream.latest(s, "k", ["ts", "id"])
    ids = list(range(80))
    one = batches(spark, tmp_path / "a", [ids], build, "update")
    many = batches(spark, tmp_path / "b", [ids[50:], ids[:20], ids[20:50]], build, "update")
    got = [{(r.k, r.id) for r in stream.current(spark, p, ["k"]).collect()} for p in (one, many)]
    assert got[0] == got[1] and len(got[0]) == 7


def test_backlog_counts_references_once(spark, tmp_path):
    build = lambda s: stream.backlog(s.withColumn("title", F.lit("x")), "title", "k", "ts")
    out = batches(spark, tmp_path, [list(range(0, 80, 2)), list(range(1, 80, 2))], build, "update")
    row = stream.backlog_totals(stream.current(spark, out, ["title", "k"]), "title").first()
    assert (row.ref_count, row.sightings) == (7, 80)


def test_late_rows_inside_the_delay_count(spark, tmp_path):
    late_ok, too_late = 75, 3  # 75 is of the last but one day, 3 of the first
    rest = [i for i in range(80) if i not in (late_ok, too_late)]
    out = batches(spark, tmp_path, [rest, [late_ok, too_late]], lambda s: stream.daily(s, "ts", "2 days"))
    days = {str(r.day.start)[:10]: r.n for r in stream.emitted(spark, out).collect()}
    assert days["2024-01-01"] == 3
    assert max(days) == "2024-01-17" and "2024-01-19" not in days


def test_intake_drops_repeats(spark, tmp_path):
    out = batches(spark, tmp_path, [[0, 1, 2], [2, 3], [0, 4]], lambda s: stream.intake(s, ["id"], "ts", "40 days"))
    assert sorted(r.id for r in stream.emitted(spark, out).collect()) == [0, 1, 2, 3, 4]


SCHEMA = "k long, at long, v string"


def put(spark, path, batch_id, rows, **options):
    df = spark.createDataFrame(rows, SCHEMA)
    return upsert.upsert(df, batch_id, path, ["k"], upsert.newest(["k"], ["at", "v"]), **options)


def rows_of(spark, path):
    return sorted((r.k, r.at, r.v) for r in upsert.table(spark, path, spark.createDataFrame([], SCHEMA).schema).collect())


def folders(path):
    return sorted(f"{b}/{v}" for b in os.listdir(f"{path}/rows") if "=" in b for v in os.listdir(f"{path}/rows/{b}"))


def test_upsert_keeps_the_newest_and_rewrites_touched_buckets_only(spark, tmp_path):
    path = str(tmp_path / "t")
    put(spark, path, 0, [(i, 5, "a") for i in range(40)], buckets=8)
    before = folders(path)
    put(spark, path, 1, [(3, 6, "b"), (4, 4, "late"), (99, 1, "new")], buckets=8)
    assert rows_of(spark, path) == sorted([(i, 5, "a") for i in range(40) if i != 3] + [(3, 6, "b"), (99, 1, "new")])
    assert 1 <= len(set(folders(path)) - set(before)) <= 3


def test_repeated_and_broken_batches(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    put(spark, path, 0, [(1, 1, "a"), (2, 1, "a")], buckets=2)
    assert not put(spark, path, 0, [(1, 9, "never")], buckets=2)
    real = upsert.compact

    def lost(*args):
        raise OSError("lost")

    real_frame = type(spark).createDataFrame
    rows = spark.createDataFrame([(1, 2, "b"), (3, 1, "c")], SCHEMA)
    monkeypatch.setattr(type(spark), "createDataFrame", lost)  # the commit is not written
    with pytest.raises(OSError):
        upsert.upsert(rows, 1, path, ["k"], upsert.newest(["k"], ["at", "v"]), 2)
    monkeypatch.setattr(type(spark), "createDataFrame", real_frame)
    assert rows_of(spark, path) == [(1, 1, "a"), (2, 1, "a")]
    monkeypatch.setattr(upsert, "compact", lost)  # committed, but the clean-up is not done
    with pytest.raises(OSError):
        upsert.upsert(rows, 1, path, ["k"], upsert.newest(["k"], ["at", "v"]), 2)
    monkeypatch.setattr(upsert, "compact", real)
    assert not upsert.upsert(rows, 1, path, ["k"], upsert.newest(["k"], ["at", "v"]), 2)
    assert rows_of(spark, path) == [(1, 2, "b"), (2, 1, "a"), (3, 1, "c")]


def test_sums_count_every_batch_once(spark, tmp_path):
    path = str(tmp_path / "t")
    merge = upsert.summed(["k"], {"at": F.max, "n": F.sum})
    for batch_id in (0, 1, 1, 2, 0):
        df = spark.createDataFrame([(1, batch_id, 1), (1, batch_id, 1), (batch_id, 7, 1)], "k long, at long, n long")
        upsert.upsert(df, batch_id, path, ["k"], merge, 4)
    got = {r.k: (r.at, r.n) for r in upsert.table(spark, path, df.schema).collect()}
    assert got == {0: (7, 1), 1: (7, 7), 2: (7, 1)}


def test_the_table_does_not_grow_with_the_batches(spark, tmp_path):
    path = str(tmp_path / "t")
    for batch_id in range(9):
        put(spark, path, batch_id, [(k, batch_id, "x") for k in range(batch_id % 3, 30, 3)], buckets=4)
    put(spark, path, 9, [], buckets=4)
    assert len(rows_of(spark, path)) == 30 and len(folders(path)) <= 4 * 2 + 4
    assert len([f for f in os.listdir(f"{path}/commits") if "=" in f]) == 2


def test_a_stream_restarts_where_it_was(spark, tmp_path):
    df = spark.createDataFrame(ROWS, "id long, t string, k long").select("id", F.to_timestamp("t").alias("ts"), "k")
    merge = upsert.newest(["k"], ["ts", "id"])
    for i, ids in enumerate([range(50, 80), range(0, 20), range(20, 50)]):
        df.filter(F.col("id").isin(list(ids))).coalesce(1).write.parquet(str(tmp_path / "in" / str(i)))
        source = stream.arriving(spark, str(tmp_path / "in"), df.schema)
        for _ in range(2):  # the second run finds nothing new
            upsert.run(source, str(tmp_path / "t"), str(tmp_path / "cp"), ["k"], merge, 4)
    got = {r.k: r.id for r in upsert.table(spark, str(tmp_path / "t"), df.schema).collect()}
    assert got == {k: max(i for i, _, x in ROWS if x == k) for k in range(7)}
