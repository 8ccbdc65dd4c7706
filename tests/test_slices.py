"""The sliced windows equal plain windows, also with a key that holds a third of the rows."""

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from docgraph.operators import version
from docgraph.plans import ordered, paging, slices


@pytest.fixture(scope="module")
def hot(spark):
    rng = random.Random(7)
    data = []
    for i in range(3000):
        key = 0 if rng.random() < 0.35 else rng.choice([None, *range(1, 40)])
        # Few distinct times: many ties, settled by the id.
        data.append((i, key, rng.randrange(0, 300), rng.choice([None, i])))
    return spark.createDataFrame(data, "id long, k long, t long, v long").cache()


@pytest.mark.parametrize("key,given", [("long", True), ("long", False), ("string", False), ("struct", False)])
def test_all_columns_equal_plain_windows(hot, key, given):
    """Slices given by the caller, and range partitions of any key type."""
    ids = {"string": F.concat(F.lit("P_"), F.lpad(F.col("id").cast("string"), 5, "0")),
           "struct": F.struct(F.lpad(F.col("id").cast("string"), 5, "0").alias("a"))}
    hot = hot.withColumn("id", ids.get(key, F.col("id")))
    got = slices.sliced(hot, ["k"], ["t", "id"], F.shiftright("t", 4) if given else None, ordinal="n", size="s",
                        previous={"id": "p"}, following={"id": "f"}, first={"id": "h"}, latest=(F.col("v"), "l"))
    w = Window.partitionBy("k").orderBy("t", "id")
    want = hot.select(
        "*", F.row_number().over(w).cast("long").alias("n"),
        F.count(F.lit(1)).over(Window.partitionBy("k")).alias("s"), F.lag("id").over(w).alias("p"),
        F.lead("id").over(w).alias("f"), F.first("id").over(w).alias("h"),
        F.last("v", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0)).alias("l"))
    assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.collect()), key=str)


def test_plan_has_no_window_over_the_raw_group(hot):
    out = slices.sliced(hot, ["k"], ["t", "id"], F.shiftright("t", 4), ordinal="n")
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    raw = [line for line in plan.splitlines() if "Window [row_number()" in line]
    assert raw and all(f"[{slices.SLICE}#" in line for line in raw)


def test_a_hot_key_at_one_moment_is_dealt_to_all_partitions(spark):
    """Two thirds of all rows share key and order; no range has much more than its share."""
    df = spark.range(9000).select(F.when(F.col("id") < 6000, "hot").otherwise(F.concat(F.lit("k"), F.col("id"))).alias("k"),
                                  F.lit("2024-01-01 10:00").alias("t"), F.col("id").cast("string").alias("id"))
    laid = ordered.laid(df, ["k", "t"], parts=12)
    per = laid.groupBy(ordered.part().alias("p")).count().collect()
    assert len(per) >= 10 and max(r["count"] for r in per) < 3 * 9000 / 12
    out = slices.sliced(df, ["k"], ["t"], ordinal="n", size="s").filter("k = 'hot'")
    assert sorted(r.n for r in out.collect()) == list(range(1, 6001))
    assert out.filter("s <> 6000").isEmpty()


def test_numbers_of_the_whole_order(spark):
    df = spark.range(500).select(F.md5(F.col("id").cast("string")).alias("h"), (F.col("id") % 3).alias("g"),
                                 F.create_map(F.lit("a"), "id").alias("m"))
    got = ordered.numbered(df, [F.col("g").desc(), "h"], "n", parts=7).orderBy("n").collect()
    want = sorted(((r.g, r.h) for r in df.collect()), key=lambda x: (-x[0], x[1]))
    assert [(r.g, r.h) for r in got] == want and [r.n for r in got] == list(range(500))
    assert ordered.numbered(df.filter("false"), ["h"], "n").collect() == []


def test_as_of_with_tie_and_vacuum(spark):
    facts = spark.sql("""select * from values (1L, 'a', timestamp'2024-01-01 10:00'),
        (2L, 'a', timestamp'2024-01-03 00:00'), (3L, 'b', timestamp'2024-01-02 00:00')
        as t(id, k, ts)""")
    versions = spark.sql("""select * from values ('a', timestamp'2024-01-03 00:00', 'v2'),
        ('a', timestamp'2024-01-03 00:00', 'v0'),
        ('a', timestamp'2024-01-01 11:00', 'v1') as t(k, ts, version)""")
    out = version.as_of(facts, versions, "k", "ts", "version", "id").orderBy("id").collect()
    assert [(r.version, r.vacuum) for r in out] == [(None, True), ("v2", False), (None, True)]


def test_pages_of_a_hub(spark):
    df = spark.range(5000).select((F.when(F.col("id") < 4000, 0).otherwise(F.col("id"))).alias("g"), "id")
    out = paging.paged(df, ["g"], "id", F.col("id"), 500)
    hub = out.filter("g = 0")
    assert hub.count() == 8
    assert hub.agg(F.max("n")).first()[0] < 700
    assert out.agg(F.sum("n")).first()[0] == 5000
    assert out.filter("g > 0").agg(F.max("page")).first()[0] == 0
