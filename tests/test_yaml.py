"""YAML records to JSON and to typed rows."""

import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docgraph.functions import yaml
from docgraph.sources import ingest

CASES = {
    "": None,
    "# nothing": None,
    "a: 1": {"a": 1},
    "---\na: 1\nb: -2.5e3\nc: 007\nd: true\ne: ~\nf:\ng: null": {
        "a": 1, "b": -2500.0, "c": "007", "d": True, "e": None, "f": None, "g": None},
    "a:\n  b:\n    c: x\n  d: y\ne: z": {"a": {"b": {"c": "x"}, "d": "y"}, "e": "z"},
    "a:\n- 1\n- two\nb:\n  - x\n  -   y z": {"a": [1, "two"], "b": ["x", "y z"]},
    "- a: 1\n  b: 2\n- a: 3\n  c:\n  - p\n  - q\n": [{"a": 1, "b": 2}, {"a": 3, "c": ["p", "q"]}],
    "- - 1\n  - 2\n- - 3\n": [[1, 2], [3]],
    "-\n  a: 1\n-\n- b": [{"a": 1}, None, "b"],
    "a: one\n  two\n\n  three # remark\nb: x": {"a": "one two\nthree", "b": "x"},
    "a: 'it''s # not a remark'  # a remark\nb: \"x\\ty \\u00e9 \\\"q\\\"\"\n": {
        "a": "it's # not a remark", "b": 'x\ty é "q"'},
    "a: 'one\n\n  two\n  three'\nb: \"p\n  q\"": {"a": "one\ntwo three", "b": "p q"},
    "a: |\n  x\n    y: - z\n\n  # w\nb: >\n  p\n  q\n\n  r\nc: |-\n  s\n\nd: |+\n  t\n\ne: |\n": {
        "a": "x\n  y: - z\n\n# w\n", "b": "p q\nr\n", "c": "s", "d": "t\n\n", "e": ""},
    "a: [x, 'y, z', \"w\", 3]\nb: []\nc: {}\nd: {p: 1, q: two}   # remark\ne: [ ]": {
        "a": ["x", "y, z", "w", 3], "b": [], "c": {}, "d": {"p": 1, "q": "two"}, "e": []},
    "u: http://h/a:b#c\n'k: 1': v\n\"5-4\": w\n中文 键: 值:不是键\n?x: -y\n": {
        "u": "http://h/a:b#c", "k: 1": "v", "5-4": "w", "中文 键": "值:不是键", "?x": "-y"},
    "a:\n  # remark\n  - x\n\n  - y\n# end\nb: 1\n": {"a": ["x", "y"], "b": 1},
    "a: x\r\nb:\r\n  - y\r\n": {"a": "x", "b": ["y"]},
    "plain text\n  of two lines": "plain text of two lines",
    "- 'a: b'\n- c:d\n- - x\n  - y: 1\n    z: 2\n": ["a: b", "c:d", ["x", {"y": 1, "z": 2}]],
    "a:\n    - b:\n        - c: 1\n          d:\n            e: f\n      g: h\n": {
        "a": [{"b": [{"c": 1, "d": {"e": "f"}}], "g": "h"}]},
    "a:\n  - x\n    y\n  - |\n    l1\n    l2\n  - 'q\n    r'\nb: 2": {"a": ["x y", "l1\nl2\n", "q r"], "b": 2},
}
BROKEN = {
    "a: 1\n   b: 2": "a key within a value", "a: 'open": "not closed", "a: &x 1": "not plain", "a: 1\n---\nb: 2": "several",
    "a:\n    b: 1\n  c: 2": "indent", "\ta: 1": "tab", "a: [x, [y]]": "brackets", "a: 1\n- b": "indent",
    "a: 1\nb": "neither",
}


def test_values(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(CASES)], "i int, t string").repartition(3)
    got = {r.i: (r.y.json, r.y.reason) for r in df.select("i", yaml.to_json(F.col("t")).alias("y")).collect()}
    for i, (text, want) in enumerate(CASES.items()):
        assert got[i][1] is None, (text, got[i])
        assert json.loads(got[i][0]) == want, text


def test_what_is_not_read_says_why(spark):
    df = spark.createDataFrame([(t,) for t in BROKEN], "t string")
    for r in df.select("t", yaml.to_json(F.col("t")).alias("y")).collect():
        assert r.y.json is None and BROKEN[r.t] in r.y.reason, (r.t, r.y)


SCHEMA = T.StructType([
    T.StructField("pid", T.StringType()), T.StructField("themes", T.ArrayType(T.StringType())),
    T.StructField("scores", T.MapType(T.StringType(), T.IntegerType())),
    T.StructField("impact", T.MapType(T.StringType(), T.StringType())),
    T.StructField("on", T.DateType()), T.StructField("deep", T.BooleanType())])
RECORD = """pid: P_2031_ABC_9
themes:
- harbour
- rail_freight
scores:
  D1: 3
  D2: 4
impact:
  ports: long text that goes
    on in a second line
  rail: 'first

    second'
on: '2031-02-03'
deep: true
"""


def test_records_and_bad_rows(spark):
    df = spark.createDataFrame([("a", RECORD), ("b", "pid: x\nscores: [1"), ("c", "pid: y"), ("d", None),
                                ("e", "- pid: z")], "file string, value string")
    good, bad = ingest.records(df, SCHEMA, required=("pid",))
    rows = {r.file: r for r in good.collect()}
    a = rows["a"]
    assert (a.pid, a.themes, a.scores, a.deep, str(a.on)) == (
        "P_2031_ABC_9", ["harbour", "rail_freight"], {"D1": 3, "D2": 4}, True, "2031-02-03")
    assert a.impact == {"ports": "long text that goes on in a second line", "rail": "first\nsecond"}
    assert set(rows) == {"a", "c"} and rows["c"].themes is None
    reasons = {r.file: r.reason for r in bad.collect()}
    assert set(reasons) == {"b", "d", "e"} and "brackets" in reasons["b"] and reasons["d"] == "empty"


def test_registry_of_maps(spark):
    text = "# head\nitems:\n- id: a\n  names: [x, y]\n- id: b\n  place:\n    level: city\n    code: '010'\n"
    schema = T.StructType([T.StructField("items", T.ArrayType(T.StructType([
        T.StructField("id", T.StringType()), T.StructField("names", T.ArrayType(T.StringType())),
        T.StructField("place", T.MapType(T.StringType(), T.StringType()))])))])
    good, _ = ingest.records(spark.createDataFrame([(text,)], "value string"), schema)
    rows = good.select(F.inline("items")).collect()
    assert [(r.id, r.names, r.place) for r in rows] == [("a", ["x", "y"], None), ("b", None, {"level": "city", "code": "010"})]


def test_variant_of_any_shape(spark):
    df = spark.createDataFrame([("a:\n- b: {c: 2}\n",)], "value string")
    v = F.parse_json(yaml.to_json(F.col("value"))["json"])
    assert df.select(F.variant_get(v, "$.a[0].b.c", "int")).first()[0] == 2
