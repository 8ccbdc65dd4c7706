"""Reading header-and-body files and writing tables."""

import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql import types as T

from docgraph.sources import ingest, sink

POLICY = """---
id: P_2031_HARB_42              # remark
aliases:
  - P_2031_HARB_42
  - 'P_1900_HARB_42'
title: "港口岸电：价格与 \u2018开放\u2019 办法"
official_number: ~
issuer:
  - 港务署
  - Amt für Häfen
date: '2031-07-19'
region:
  level: 市
  code: '090909'
  name: 临海
provenance:
  url: https://harbour.example/rules/42.html
  fetched_at: '2032-02-03T04:05:06'
  confidence: 0.75
dup_aliases: []
tags: [a, 'b']
---
## 政策原文

第一条 内容: 值
---
末段
"""

S = T.StringType()
SCHEMA = T.StructType([
    T.StructField("id", S), T.StructField("aliases", T.ArrayType(S)), T.StructField("title", S),
    T.StructField("official_number", S), T.StructField("issuer", T.ArrayType(S)),
    T.StructField("date", T.DateType()),
    T.StructField("region", T.StructType([T.StructField("level", S), T.StructField("code", S),
                                          T.StructField("name", S)])),
    T.StructField("provenance", T.StructType([
        T.StructField("url", S), T.StructField("fetched_at", T.TimestampType()),
        T.StructField("confidence", T.DoubleType())])),
    T.StructField("dup_aliases", T.ArrayType(S)), T.StructField("tags", T.ArrayType(S)),
    T.StructField("subtype", S)])


def test_documents_from_files(spark, tmp_path):
    (tmp_path / "a.md").write_text(POLICY)
    (tmp_path / "b.md").write_text("no header at all")
    (tmp_path / "c.md").write_text("---\nid: X\n---\nbody")
    good, bad = ingest.documents(spark, str(tmp_path), SCHEMA, ("id", "title"))
    row = good.collect()
    assert len(row) == 1
    row = row[0]
    assert (row.file, row.id, row.title) == ("a.md", "P_2031_HARB_42", "港口岸电：价格与 ‘开放’ 办法")
    assert row.aliases == ["P_2031_HARB_42", "P_1900_HARB_42"]
    assert row.issuer == ["港务署", "Amt für Häfen"]
    assert row.date == dt.date(2031, 7, 19)
    assert tuple(row.region) == ("市", "090909", "临海")
    assert row.provenance.confidence == 0.75 and row.provenance.url.startswith("https://")
    assert row.official_number is None and row.subtype is None
    assert row.dup_aliases == [] and row.tags == ["a", "b"]
    assert row.body == "## 政策原文\n\n第一条 内容: 值\n---\n末段\n"
    assert {(r.file, r.reason) for r in bad.collect()} == {("b.md", "no header"), ("c.md", "missing: title")}


def test_windows_line_ends_and_block_without_struct(spark):
    df = spark.createDataFrame([("---\r\nid: A\r\ntitle: t\r\n---\r\nx\r\n",)], "value string")
    good, _ = ingest.parse_documents(df, SCHEMA, "value", ("id",))
    row = good.first()
    assert (row.id, row.title, row.region, row.body) == ("A", "t", None, "x\n")


def test_quoted_values_keep_their_hash_signs(spark):
    df = spark.createDataFrame([("---\nid: 'A # b'   # remark\ntitle: it''s # cut\nsubtype: # none\n---\n",)], "value string")
    row = ingest.parse_documents(df, SCHEMA, "value", ("id",))[0].first()
    assert (row.id, row.title, row.subtype) == ("A # b", "it''s", None)


def test_jsonl_keeps_broken_lines(spark, tmp_path):
    (tmp_path / "x.jsonl").write_text('{"id": "a", "region": {"level": "市"}, "ids": ["p"]}\n{broken\n{"id": "b"}\n')
    schema = T.StructType([T.StructField("id", S), T.StructField("region", T.StructType([T.StructField("level", S)])),
                           T.StructField("ids", T.ArrayType(S))])
    good, bad = ingest.jsonl(spark, str(tmp_path), schema)
    assert [(r.id, r.region and r.region.level, r.ids) for r in good.orderBy("id").collect()] == [
        ("a", "市", ["p"]), ("b", None, None)]
    assert bad.collect()[0][0] == "{broken"


def test_registry_collisions(spark):
    reg = spark.createDataFrame([("quay", ["Q", "岸线"]), ("dock", ["坞", "岸线", ""]), ("e", [])],
                                "id string, aliases array<string>")
    got = {(r.id, r.alias, r.owners) for r in ingest.registry(reg, "id").collect()}
    assert got == {("quay", "Q", 1), ("quay", "岸线", 2), ("dock", "坞", 1), ("dock", "岸线", 2),
                   ("dock", None, 0), ("e", None, 0)}


def test_append_is_idempotent_and_never_changes_stored_rows(spark, tmp_path):
    path = str(tmp_path / "raw")
    first = spark.createDataFrame([(1, "a", 2024), (2, "b", 2025)], "id long, text string, year int")
    again = spark.createDataFrame([(2, "changed", 2025), (3, "d", 2025), (3, "c", 2025)], first.schema)
    sink.append_new(first, path, "id", "year")
    sink.append_new(again, path, "id", "year")
    sink.append_new(again, path, "id", "year")
    got = {(r.id, r.text) for r in spark.read.parquet(path).collect()}
    assert got == {(1, "a"), (2, "b"), (3, "c")}


def test_rewrite_replaces_only_its_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    sink.rewrite(spark.createDataFrame([(1, "a"), (2, "b")], "x int, p string"), path, ["p"])
    sink.rewrite(spark.createDataFrame([(9, "b")], "x int, p string"), path, ["p"])
    assert {(r.x, r.p) for r in spark.read.parquet(path).collect()} == {(1, "a"), (9, "b")}


def test_first_rule_gives_the_reason(spark):
    df = spark.range(6)
    out = sink.disposition(df, {"even": F.col("id") % 2 == 0, "small": F.col("id") < 2})
    assert [(r.id, r.disposition, r.reason) for r in out.orderBy("id").collect()][:3] == [
        (0, "dropped", "even"), (1, "dropped", "small"), (2, "dropped", "even")]


RAW = "id long, text string, year int"


def held(spark, path):
    return sorted((r.id, r.text, r.batch) for r in sink.stored_rows(spark, path, spark.createDataFrame([], RAW).schema).collect())


def aside(spark, path):
    return sorted(((r.id, r.text, r.reason) for r in sink.rejected_rows(
        spark, path, spark.createDataFrame([], RAW).schema).collect()), key=str)


def test_batches_tell_repeats_from_clashes(spark, tmp_path):
    path = str(tmp_path / "t")
    first = spark.createDataFrame([(1, "a", 1), (2, None, 1), (2, None, 1), (None, "x", 1)], RAW)
    second = spark.createDataFrame([(1, "a", 1), (2, "b", 1), (3, "c", 1), (3, "d", 1), (4, "e", None), (4, "e", None),
                                    (None, "y", 1), (None, "y", 1)], RAW)
    assert sink.append_batch(first, path, "id", "b1") and sink.append_batch(second, path, "id", "b2")
    assert not sink.append_batch(first, path, "id", "b2")  # a name counts once
    assert held(spark, path) == [(1, "a", "b1"), (2, None, "b1"), (4, "e", "b2")]
    assert aside(spark, path) == sorted([
        (None, "x", "no key"), (2, "b", "other content is stored"), (3, "c", "several contents"),
        (3, "d", "several contents"), (None, "y", "no key"), (None, "y", "no key")], key=str)
    got = {r.batch: (r.added, r.rejected, r.repeated) for r in sink.commits(spark, path).collect()}
    assert got == {"b1": (2, 1, 1), "b2": (1, 5, 2)}


def test_a_broken_batch_is_not_read_and_is_done_again(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    rows = spark.createDataFrame([(1, "a", 1), (2, "b", 1)], RAW)
    sink.append_batch(rows.limit(1), path, "id", "b1")
    real = sink._folder

    def broken(path, part, batch):
        if part == sink.COMMITS:
            raise OSError("lost")
        return real(path, part, batch)

    monkeypatch.setattr(sink, "_folder", broken)
    before = held(spark, path)
    try:
        sink.append_batch(rows, path, "id", "b2")
    except OSError:
        pass
    assert held(spark, path) == before
    monkeypatch.setattr(sink, "_folder", real)
    for _ in range(2):
        sink.append_batch(rows, path, "id", "b2")
    assert [x[:2] for x in held(spark, path)] == [(1, "a"), (2, "b")]
    sums = {r.checksum for r in sink.commits(spark, path).collect()}
    assert len(sums) == 2


def test_a_batch_without_rows(spark, tmp_path):
    path = str(tmp_path / "t")
    assert sink.append_batch(spark.createDataFrame([], RAW), path, "id", "b0")
    assert held(spark, path) == [] and sink.commits(spark, path).first().added == 0
