"""Secret scans: fixed patterns, and a battery of randomness tests with false-discovery control.

Besides three fixed patterns, every run of 20 or more characters of the base64 alphabets is a
candidate. Its encoding is inferred from its characters. Three tests ask whether it looks random
over that encoding: chi-squared uniformity of the alphabet, the number of runs above and below
the middle of the alphabet, and the serial correlation of neighbours. A candidate that fails the
runs or the correlation test is ordinary. For the rest the chi-squared statistic is held against
ordinary text, whose statistic grows with the length, so that a long random string is much
stronger evidence than a short one; the Benjamini-Hochberg procedure over all candidates of the
corpus then bounds the share of false discoveries.

Everything is DataFrame functions.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from docgraph.plans import storage
from docgraph.plans.once import computed

#: Fixed values of the contract: kind, pattern, group to measure, least length.
BASE = [
    ("assign", r"((?i:password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?"
               r"([A-Za-z0-9+/_.=-]+)", 2, 8),
    ("access", r"AKIA[A-Z0-9]+", 0, 16),
    ("hex", r"[0-9a-f]+", 0, 32),
]
CANDIDATE = r"[A-Za-z0-9+/_-]{20,}={0,2}"
#: Inferred encodings: name, what all characters match, alphabet in its order, and the chance that
#: two characters of ordinary words over this alphabet are equal (letters of European languages).
LETTERS = "abcdefghijklmnopqrstuvwxyz"
DIGITS = "0123456789"
ENCODINGS = [
    ("hex", r"^([0-9a-f]+|[0-9A-F]+)$", DIGITS + "abcdef", 0.26),
    ("base32", r"^[A-Z2-7]+$", LETTERS + "234567", 0.065),
    ("base36", r"^([0-9a-z]+|[0-9A-Z]+)$", DIGITS + LETTERS, 0.065),
    ("base64", r"^[A-Za-z0-9+/_-]+$", LETTERS.upper() + LETTERS + DIGITS + "+/", 0.065),
]
#: Two-sided limit of the runs and the correlation test, and the false-discovery rate.
LIMIT, RATE = 3.29, 0.001
#: Bins of -log10(p), and the largest value that is told apart.
BINS, CLIP = 20, 60


def _matches(text: Column, pattern: str) -> dict[str, Column]:
    """Leftmost non-overlapping matches, and the pieces of text between them."""
    return {"found": F.regexp_extract_all(text, F.lit(pattern), F.lit(0)),
            "between": F.split(text, pattern, -1)}


def _spans(df: DataFrame, name: str, pattern: str, kept) -> DataFrame:
    """Add the matches of a pattern as an array of (start, end, value), in code points.

    Matches and the pieces between them alternate, so that running sums of their lengths are the
    positions; they are carried in one fold over the matches.
    """
    df = computed(df, _matches(F.col("text"), pattern))
    empty = F.expr("struct(0L as at, cast(array() as array<struct<start:bigint,end:bigint,"
                   "value:string>>) as spans)")
    pairs = F.arrays_zip(F.col("found").alias("f"), F.slice("between", 1, F.size("found")).alias("b"))

    def step(acc, x):
        start = acc["at"] + F.length(x["b"])
        end = start + F.length(x["f"])
        own = F.struct(start.alias("start"), end.alias("end"), x["f"].alias("value"))
        return F.struct(end.alias("at"),
                        F.when(kept(x["f"]), F.concat(acc["spans"], F.array(own)))
                        .otherwise(acc["spans"]).alias("spans"))

    spans = F.when(F.size("found") > 0, F.aggregate(pairs, empty, step)["spans"]).otherwise(
        empty["spans"])
    return computed(df, {name: spans}).drop("found", "between")


def _long(pattern: str, group: int, least: int):
    def test(found: Column) -> Column:
        return F.length(F.regexp_extract(found, pattern, group) if group else found) >= least

    return test


def scanned(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, the base spans (assign, access, hex) and the candidates per document."""
    df = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"),
                     F.coalesce(F.col(f"`{text_col}`"), F.lit("")).alias("text"))
    for kind, pattern, group, least in BASE:
        df = _spans(df, kind, pattern, _long(pattern, group, least))
    df = _spans(df, "candidates", CANDIDATE, lambda f: F.length(f) > 0)
    return df.drop("text")


def _normal_tail(z: Column) -> Column:
    """-log10 of the upper tail of the normal distribution, close for z above 0."""
    z = F.greatest(z, F.lit(0.0))
    # Upper bound of the tail: exp(-z^2/2) * 2 / (sqrt(2 pi) * (z + sqrt(z^2 + 8/pi))).
    ln = (-z * z / 2 + math.log(2 / math.sqrt(2 * math.pi))
          - F.log(z + F.sqrt(z * z + 8 / math.pi)))
    return -ln / math.log(10)


def battery(df: DataFrame, value: str) -> DataFrame:
    """Add encoding, n, chi (normal score against uniformity), runs, serial (z scores) and
    evidence (-log10 p against ordinary text) to distinct candidate strings."""
    body = F.regexp_replace(F.col(value), "=+$", "")
    inferred = F.coalesce(*[F.when(F.col("body").rlike(pattern), F.struct(
        F.lit(name).alias("encoding"), F.lit(letters).alias("letters"),
        F.lit(equal).alias("equal"))) for name, pattern, letters, equal in ENCODINGS])
    df = computed(df, {"body": body})
    df = computed(df, {"inferred": inferred}).select("*", "inferred.*").drop("inferred")
    folded = F.when(F.col("encoding") == "base64", F.translate("body", "-_", "+/")).otherwise(
        F.lower("body"))
    df = computed(df, {"codes": F.transform(F.split(folded, ""), lambda c: F.instr(
        F.col("letters"), c).cast("double")), "size": F.length("letters").cast("double"),
        "n": F.length("body").cast("double"), "folded": folded})
    # Sum of squared counts: every character finds how often it occurs, n times in all.
    squares = F.aggregate(
        F.transform(F.array_distinct(F.split("folded", "")), lambda c: F.length("folded")
                    - F.length(F.replace(F.col("folded"), c, F.lit("")))),
        F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double"))
    middle = (F.col("size") + 1) / 2
    mean = F.aggregate("codes", F.lit(0.0), lambda a, x: a + x) / F.col("n")
    df = computed(df, {"x2": F.col("size") * squares / F.col("n") - F.col("n"), "mean": mean,
                       "high": F.size(F.filter("codes", lambda x: x > middle)).cast("double"),
                       "next": F.slice("codes", 2, F.greatest(F.size("codes") - 1, F.lit(1)))})
    pairs = F.zip_with("codes", "next", lambda a, b: F.struct(a.alias("a"), b.alias("b")))
    changes = F.size(F.filter(pairs, lambda p: p["b"].isNotNull() & (
        (p["a"] > middle) != (p["b"] > middle)))).cast("double")
    variance = F.aggregate("codes", F.lit(0.0), lambda a, x: a + (x - F.col("mean")) ** 2)
    together = F.aggregate(pairs, F.lit(0.0), lambda a, p: a + F.coalesce(
        (p["a"] - F.col("mean")) * (p["b"] - F.col("mean")), F.lit(0.0)))
    df = computed(df, {"runs_seen": changes + 1, "variance": variance, "together": together})
    n, k, low = F.col("n"), F.col("size"), F.col("n") - F.col("high")
    both = 2 * F.col("high") * low
    expected = both / n + 1
    spread = both * (both - n) / (n * n * (n - 1))
    runs = F.when(spread > 0, (F.col("runs_seen") - expected) / F.sqrt(spread)).otherwise(F.lit(99.0))
    serial = F.when(F.col("variance") > 0, F.col("together") / F.col("variance") * F.sqrt(n)
                    ).otherwise(F.lit(99.0))
    degrees = k - 1
    # Cube-root normal score of the statistic under uniformity.
    chi = (F.cbrt(F.greatest(F.col("x2"), F.lit(0.0)) / degrees) - (1 - 2 / (9 * degrees))) / F.sqrt(
        2 / (9 * degrees))
    # Ordinary text: noncentral, with n times the distance of its letters from uniformity.
    away = n * F.greatest(k * F.col("equal") - 1, F.lit(0.0))
    below = (degrees + away - F.col("x2")) / F.sqrt(2 * (degrees + 2 * away))
    looks = (chi < LIMIT) & (F.abs(runs) < LIMIT) & (F.abs(serial) < LIMIT)
    evidence = F.when(looks & (away > 0), _normal_tail(below)).otherwise(F.lit(0.0))
    return (df.withColumns({"chi": chi, "runs": runs, "serial": serial, "evidence": evidence})
            .drop("body", "letters", "equal", "codes", "size", "folded", "x2", "mean", "high", "next",
                  "runs_seen", "variance", "together"))


def discovered(tested: DataFrame, times: str) -> DataFrame:
    """The lowest bin of evidence that the procedure accepts, as one row ``bin`` (null: none).

    A candidate's p-value is the upper end of its bin, so binning never accepts more. The
    histogram has at most BINS * CLIP + 1 rows.
    """
    level = F.floor(F.least(F.col("evidence"), F.lit(float(CLIP))) * BINS).cast("int")
    bins = (tested.withColumn("bin", level).groupBy("bin").agg(F.sum(times).alias("n")))
    down = Window.orderBy(F.desc("bin"))
    ranked = bins.withColumn("rank", F.sum("n").over(down)).withColumn(
        "all", F.sum("n").over(Window.partitionBy()))
    fine = F.pow(F.lit(10.0), -F.col("bin") / BINS) * F.col("all") <= RATE * F.col("rank")
    return ranked.filter(fine).agg(F.min("bin").alias("bin"))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: doc_id, the base spans by kind, and ``random`` spans with their encoding.

    Null texts count as empty; documents without a span have empty arrays; repeated rows are
    scanned alike (each occurrence counts in the false-discovery control); an empty table gives
    an empty result. Spans are (start, end, value) in code points, the end exclusive.
    """
    found = storage.stored(scanned(docs, id_col, text_col), "spans")
    base = F.transform(F.concat(*[F.col(k) for k, *_ in BASE]),
                       lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end")))
    # A candidate that meets a base span is that span's business.
    free = F.filter("candidates", lambda c: ~F.exists("taken", lambda b: (
        b["start"] < c["end"]) & (c["start"] < b["end"])))
    rest = computed(found.withColumn("taken", base), {"free": free})
    values = (rest.select(F.explode("free.value").alias("value"))
              .groupBy("value").agg(F.count(F.lit(1)).alias("times")))
    tested = storage.stored(battery(values, "value"), "candidates")
    level = F.floor(F.least(F.col("evidence"), F.lit(float(CLIP))) * BINS)
    limit = discovered(tested, "times")
    random = (tested.crossJoin(F.broadcast(limit)).filter(level >= F.col("bin"))
              .select("value", "encoding", "evidence"))
    # One row per occurrence of a free candidate; the few accepted values join them.
    place = rest.filter("size(free) > 0").select(
        "doc_id", F.xxhash64("doc_id", *[k for k, *_ in BASE], "candidates").alias("row"),
        F.explode("free").alias("s")).distinct()
    hits = (place.join(random, F.col("s.value") == F.col("value"))
            .groupBy("doc_id", "row").agg(F.array_sort(F.collect_list(F.struct(
                F.col("s.start").alias("start"), F.col("s.end").alias("end"),
                F.col("value"), F.col("encoding"), F.col("evidence")))).alias("random"))
            .select(F.col("doc_id").alias("_id"), F.col("row").alias("_row"), "random"))
    own = found.withColumn("row", F.xxhash64("doc_id", *[k for k, *_ in BASE], "candidates"))
    joined = own.join(hits, own["doc_id"].eqNullSafe(F.col("_id")) & (F.col("row") == F.col("_row")),
                      "left")
    none = F.expr("cast(array() as array<struct<start:bigint,end:bigint,value:string,"
                  "encoding:string,evidence:double>>)")
    return joined.select("doc_id", *[k for k, *_ in BASE], F.coalesce("random", none).alias("random"))


def _placed(kind: str, order: int) -> Column:
    return F.transform(F.col(kind), lambda s: F.struct(
        s["start"].alias("start"), F.lit(order).alias("order"), s["end"].alias("end"),
        F.lit(kind).alias("kind")))


def _joined(kinds: list[str]) -> Column:
    parts = [_placed(k, i) for i, k in enumerate(kinds)]
    return F.array_join(F.transform(F.array_sort(F.concat(*parts)), lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def report(spans: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_random."""
    kinds = [k for k, *_ in BASE]
    return spans.select(
        "doc_id", *[F.size(k).cast("long").alias(f"n_{k}") for k in kinds],
        F.sha2(_joined(kinds), 256).alias("base_sha256"),
        _joined([*kinds, "random"]).alias("spans"),
        F.size("random").cast("long").alias("n_random"))
