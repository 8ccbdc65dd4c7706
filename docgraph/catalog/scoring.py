"""Scores and decision tables."""

from pyspark.sql import functions as F

from docgraph.catalog import derive as D
from docgraph.catalog.base import query
from docgraph.functions import scores as S
from docgraph.functions import text
from docgraph.operators import score

WITH_SCORED = "WITH " + D.SCORES


@query("score_importance", WITH_SCORED + "SELECT doc_id, importance FROM scored")
def score_importance(t):
    return D.scored(t).select("doc_id", "importance")


@query("score_action", WITH_SCORED + "SELECT doc_id, action_class FROM scored")
def score_action(t):
    return D.scored(t).select("doc_id", "action_class")


@query("score_archive", WITH_SCORED + """
SELECT importance, CASE WHEN importance < 3 THEN 'low_score' END AS archive, count(*) AS n
FROM scored GROUP BY ALL""")
def score_archive(t):
    return D.scored(t).groupBy("importance", "archive").agg(F.count(F.lit(1)).alias("n"))


@query("score_display", WITH_SCORED + """
SELECT doc_id, CASE WHEN importance >= 5 AND D1 >= 3 THEN 'A' WHEN importance = 4 AND D1 >= 3 THEN 'B'
                    WHEN importance = 3 AND D1 >= 3 THEN 'C' ELSE 'D' END AS display_class,
       action_class FROM scored""")
def score_display(t):
    rows = D.scored(t)
    return rows.select("doc_id", S.display_class(F.col("importance"), F.col("D1") >= 3)
                       .alias("display_class"), "action_class")


@query("score_triage", WITH_SCORED + """
SELECT doc_id, CASE WHEN D1 < 3 THEN 'note' WHEN D2 = 5 THEN 'act now' WHEN D4 >= 4 THEN 'study first'
                    ELSE 'assess' END AS triage FROM scored""")
def score_triage(t):
    return D.scored(t).select("doc_id", S.triage(
        F.col("D1") >= 3, F.col("D2") == 5, F.col("D4") >= 4).alias("triage"))


@query("score_issuer_level", WITH_SCORED + """,
dim AS (SELECT d.source AS issuer, CAST(count(*) % 6 AS BIGINT) AS expected FROM documents d GROUP BY 1)
SELECT d.source, dim.expected, s.D3, count(*) AS n
FROM documents d JOIN scored s ON d.doc_id = s.doc_id JOIN dim ON dim.issuer = d.source
WHERE s.D3 <> dim.expected GROUP BY ALL""")
def score_issuer_level(t):
    dim = t.documents.groupBy(F.col("source").alias("issuer")).agg(
        (F.count(F.lit(1)) % 6).alias("level"))
    rows = D.scored(t).join(t.documents.select("doc_id", "source"), "doc_id")
    return score.issuer_level(rows, "source", "D3", dim).groupBy("source", "expected", "D3").agg(
        F.count(F.lit(1)).alias("n"))


@query("score_gate_audit", WITH_SCORED + """
SELECT D1 >= 3 AS declared, importance >= 3 AS stored, count(*) AS n FROM scored GROUP BY ALL""")
def score_gate_audit(t):
    return score.gate_audit(D.scored(t), F.col("D1") >= 3, F.col("importance") >= 3)


@query("score_matrix2x2", WITH_SCORED + """,
cells AS (SELECT * FROM (VALUES ('high'), ('low')) a(x), (VALUES ('high'), ('low')) b(y)),
counts AS (SELECT CASE WHEN D1 >= 4 THEN 'high' ELSE 'low' END AS x,
                  CASE WHEN D6 >= 4 THEN 'high' ELSE 'low' END AS y, count(*) AS n
           FROM scored GROUP BY ALL)
SELECT cells.x, cells.y, coalesce(n, 0) AS n FROM cells LEFT JOIN counts USING (x, y)""")
def score_matrix2x2(t):
    return score.matrix2x2(D.scored(t), "D1", "D6")


# Rule rows: term, business line, weight, evidence, region. Frequent words of the four languages.
RULES = [
    ("tion", "power", "high", "stated", None), ("with", "power", "medium", "stated", "en"),
    ("that", "power", "suppress", None, None), ("elle", "charging", "high", "stated", None),
    ("avec", "charging", "medium", "stated", "fr"), ("dans", "charging", "suppress", "stated", None),
    ("nicht", "fuel", "high", "stated", None), ("sich", "fuel", "medium", "implied", "de"),
    ("eine", "fuel", "suppress", None, None), ("para", "cross", "high", "stated", None),
    ("como", "cross", "medium", "stated", "es"), ("este", "cross", "suppress", "implied", None),
]
RULES_SQL = "rules(term, business, weight, evidence, region) AS (VALUES " + ", ".join(
    "(" + ", ".join("CAST(NULL AS VARCHAR)" if v is None else f"'{v}'" for v in r) + ")"
    for r in RULES) + ")"


@query("score_signals", "WITH " + RULES_SQL + r""",
words AS (SELECT DISTINCT doc_id, lang, unnest(regexp_split_to_array(lower(text), '[^\p{L}\p{N}]+')) AS term
          FROM documents),
flags AS (SELECT doc_id, business, count(*) AS hits, max(CAST(weight = 'high' AS INT)) AS h,
                 max(CAST(weight = 'suppress' AS INT)) AS s,
                 max(CAST(weight = 'medium' AND region IS NOT NULL AND region = lang AS INT)) AS loc,
                 max(CAST(evidence IS NULL AS INT)) AS blank
          FROM words JOIN rules USING (term) GROUP BY doc_id, business)
SELECT doc_id, business, hits, CASE WHEN h = 1 OR loc = 1 THEN 'high' WHEN blank = 1 THEN 'review'
                                    WHEN s = 1 THEN 'low' ELSE 'medium' END AS relevance FROM flags""")
def score_signals(t):
    rules = t.spark.createDataFrame(
        RULES, "term string, business string, weight string, evidence string, region string")
    return score.signals(t.texts.select("doc_id", "lang", "text"), "doc_id", text.words("text"),
                         F.col("lang"), rules)


@query("score_evidence", "WITH " + D.DOCS + """
SELECT doc_id, level, importance FROM docs
WHERE level > 0 AND (importance >= 4 OR doc_id IN (SELECT doc_id FROM labels WHERE quality = 1))""")
def score_evidence(t):
    linked = t.labels.filter("quality = 1").select("doc_id", F.lit("linked").alias("linkage"))
    rows = D.docs(t).join(linked, "doc_id", "left")
    return score.evidence(rows, "level", "importance", "linkage").select("doc_id", "level", "importance")


@query("score_cohorts", WITH_SCORED + """,
rows AS (SELECT d.source, s.importance, l.quality IS NOT NULL AS labelled
         FROM documents d JOIN scored s ON d.doc_id = s.doc_id LEFT JOIN labels l ON l.doc_id = d.doc_id)
SELECT source, count(*) AS n, round(avg(importance), 6) AS mean, round(stddev_pop(importance), 6) AS stddev,
       round(count(*) FILTER (labelled) / count(*), 6) AS themed_share,
       abs(avg(importance) - (SELECT avg(importance) FROM rows)) > 0.2 AS incomparable
FROM rows GROUP BY source""")
def score_cohorts(t):
    rows = (D.scored(t).join(t.documents.select("doc_id", "source"), "doc_id")
            .join(t.labels, "doc_id", "left"))
    return score.cohorts(rows, "source", "importance", F.col("quality").isNotNull(), 0.2)
