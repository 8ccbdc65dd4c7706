"""Inputs the given tables do not hold as such, derived alike in Spark and in SQL.

Scores, places and themes come from arithmetic on ``doc_id`` and ``n_chars`` over all documents;
registries, queues, snapshots and versions come from the data themselves.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docgraph.functions import fixed
from docgraph.operators import link, score
from docgraph.sources import ingest

RELATIONS = list(fixed.REVERSE_NAMES)
DIMS = ["D1", "D2", "D3", "D4", "D5", "D6"]

SCORES = """
scores AS (
  SELECT doc_id, n_chars, doc_id % 6 AS D1, (doc_id // 6) % 6 AS D2, (doc_id // 36) % 6 AS D3,
         n_chars % 6 AS D4, (n_chars // 6) % 6 AS D5, (n_chars // 36) % 6 AS D6
  FROM documents),
scored AS (
  SELECT *, (4 * D1 + 4 * D2 + 2 * D3 + 5) // 10 AS importance,
         substr('ABCD', CAST(greatest(1, least(4,
           CASE WHEN D4 >= 4 THEN CASE WHEN D5 >= 4 THEN 1 ELSE 2 END
                ELSE CASE WHEN D5 >= 4 THEN 3 ELSE 4 END END
           + CASE WHEN D6 >= 4 THEN -1 WHEN D6 <= 2 THEN 1 ELSE 0 END)) AS INTEGER), 1) AS action_class
  FROM scores)"""

DOCS = SCORES + """,
docs AS (
  SELECT d.doc_id, d.lang, d.source, d.n_chars, d.doc_id % 25 AS nation, d.doc_id % 4 AS level,
         DATE '2020-01-01' + CAST(d.doc_id * 37 % 2000 AS INTEGER) AS date,
         d.doc_id % 13 AS theme, s.importance, s.action_class
  FROM documents d JOIN scored s ON d.doc_id = s.doc_id),
themed AS (
  SELECT doc_id, lang, source, nation, level, date, importance, action_class,
         unnest(CASE WHEN n_chars % 13 = doc_id % 13 THEN [doc_id % 13]
                     ELSE [doc_id % 13, n_chars % 13] END) AS theme
  FROM docs)"""

EDGES = """
edges AS (
  SELECT doc_id AS src,
         CASE WHEN doc_id % 97 = 0 THEN doc_id + 1000000000 ELSE doc_id // 3 END AS dst,
         ['supersedes','iterates','extends','clarifies','references','aligns_with',
          'conflicts_with','cites_basis','derives_from'][CAST(doc_id % 8 + 1 AS INTEGER)] AS rel
  FROM documents WHERE doc_id > 0)"""

ALIASES = r"""
alias_dim AS (
  SELECT DISTINCT item_id, alias FROM (
    SELECT item_id, trim(unnest(string_split_regex(text, '[.]\s+'))) AS alias FROM benchmark)
  WHERE alias NOT IN ('', '~'))"""

MENTIONS = ALIASES + """,
hits AS (
  SELECT d.doc_id, a.item_id, a.alias, d.text, instr(d.text, a.alias) AS pos,
         (length(d.text) - length(replace(d.text, a.alias, ''))) // length(a.alias) AS evidence_count
  FROM documents d JOIN alias_dim a ON contains(d.text, a.alias)),
mentions AS (
  SELECT doc_id, item_id, alias, pos, evidence_count,
         substr(text, greatest(1, pos - 30), pos + length(alias) + 30 - greatest(1, pos - 30)) AS snippet,
         CASE WHEN pos <= 800 THEN 'opening' WHEN pos * 10 > length(text) * 9 THEN 'supplementary'
              ELSE 'body' END AS location
  FROM hits)"""

#: Every occurrence; those of one alias do not overlap.
HITS = MENTIONS + """,
cut AS (SELECT doc_id, item_id, alias, text, string_split(text, alias) AS parts FROM hits),
placed AS (
  SELECT doc_id, item_id, alias, text, i AS nth,
         CAST(list_sum(list_transform(parts[1:i], lambda x: length(x))) AS BIGINT) + (i - 1) * length(alias) + 1 AS pos
  FROM (SELECT *, unnest(range(1, len(parts))) AS i FROM cut)),
occurrences AS (
  SELECT doc_id, item_id, alias, nth, pos,
         substr(text, greatest(1, pos - 30), pos + length(alias) + 30 - greatest(1, pos - 30)) AS snippet,
         CASE WHEN pos <= 800 THEN 'opening' WHEN pos * 10 > length(text) * 9 THEN 'supplementary'
              ELSE 'body' END AS location
  FROM placed)"""

REFS = HITS + """,
refs AS (
  SELECT doc_id, item_id, CAST(sum(evidence_count) AS BIGINT) AS evidence_count, min(pos) AS pos,
         first(snippet ORDER BY pos, snippet) AS evidence,
         first(location ORDER BY pos, snippet) AS location
  FROM mentions GROUP BY doc_id, item_id)"""

STANCES = """
stances AS (
  SELECT strftime(ts, '%Y-%m-%d') AS doc,
         CAST(json_extract(props, '$.k') AS BIGINT) % 20 AS aspect,
         event_type AS polarity, user_id AS source, value, ts, event_id
  FROM events)"""


def scores(t) -> DataFrame:
    div = lambda c, n: F.expr(f"{c} div {n}")
    return t.documents.select(
        "doc_id", "n_chars", (F.col("doc_id") % 6).alias("D1"), (div("doc_id", 6) % 6).alias("D2"),
        (div("doc_id", 36) % 6).alias("D3"), (F.col("n_chars") % 6).alias("D4"),
        (div("n_chars", 6) % 6).alias("D5"), (div("n_chars", 36) % 6).alias("D6"))


def scored(t) -> DataFrame:
    return score.scored(scores(t)).withColumn("importance", F.col("importance").cast("long"))


def docs(t) -> DataFrame:
    """Documents with place, date, main theme and scores, all from one scan."""
    d = t.documents
    div = lambda c, n: F.expr(f"{c} div {n}")
    wide = d.select(
        "doc_id", "lang", "source", "n_chars", (F.col("doc_id") % 25).alias("nation"),
        (F.col("doc_id") % 4).alias("level"),
        F.date_add(F.lit("2020-01-01").cast("date"), (F.col("doc_id") * 37 % 2000).cast("int")).alias("date"),
        (F.col("doc_id") % 13).alias("theme"),
        (F.col("doc_id") % 6).alias("D1"), (div("doc_id", 6) % 6).alias("D2"),
        (div("doc_id", 36) % 6).alias("D3"), (F.col("n_chars") % 6).alias("D4"),
        (div("n_chars", 6) % 6).alias("D5"), (div("n_chars", 36) % 6).alias("D6"))
    return score.scored(wide).withColumn("importance", F.col("importance").cast("long")).drop(
        *DIMS, "archive")


def theme_sets(t) -> DataFrame:
    return t.documents.select("doc_id", F.array_distinct(
        F.array(F.col("doc_id") % 13, F.col("n_chars") % 13)).alias("themes"))


def themed(t) -> DataFrame:
    both = F.array_distinct(F.array(F.col("theme"), F.col("n_chars") % 13))
    return docs(t).withColumn("theme", F.explode(both)).drop("n_chars")


def edges(t) -> DataFrame:
    names = F.array(*[F.lit(r) for r in RELATIONS])
    target = F.when(F.col("doc_id") % 97 == 0, F.col("doc_id") + 1000000000).otherwise(
        F.expr("doc_id div 3"))
    return t.documents.filter("doc_id > 0").select(
        F.col("doc_id").alias("src"), target.alias("dst"),
        F.element_at(names, (F.col("doc_id") % 8 + 1).cast("int")).alias("rel"))


def registry(t) -> DataFrame:
    """Benchmark passages as registry entries; their sentences are the aliases."""
    return t.benchmark.select("item_id", F.split("text", r"[.]\s+").alias("aliases"))


def aliases(t) -> DataFrame:
    return ingest.registry(registry(t), "item_id").filter("alias is not null").select("item_id", "alias")


def mentions(t) -> DataFrame:
    return link.mentions(t.texts.select("doc_id", "text"), "doc_id", "text", aliases(t), "item_id")


def present(t) -> DataFrame:
    return link.present(t.texts.select("doc_id", "text"), "doc_id", "text", aliases(t), "item_id")


def stances(t) -> DataFrame:
    return t.events.select(
        F.date_format("ts", "yyyy-MM-dd").alias("doc"),
        (F.get_json_object("props", "$.k").cast("long") % 20).alias("aspect"),
        F.col("event_type").alias("polarity"), F.col("user_id").alias("source"), "value", "ts",
        "event_id")


def stamp(c):
    """Timestamp as text, the same in both engines."""
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss.SSSSSS")


def day(c):
    return F.date_format(c, "yyyy-MM-dd")
