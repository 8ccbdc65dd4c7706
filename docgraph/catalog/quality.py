"""Field rules, gates, normalisation and lint reports."""


from pyspark.sql import functions as F
from pyspark.sql import types as T

from docgraph.catalog import derive as D
from docgraph.catalog.base import query

from docgraph.operators import gate, lint, norm

ALLOWED = ["event_id", "ts", "user_id", "event_type", "k"]


@query("lint_unknown_fields", """
SELECT field, status, count(*) AS n FROM (
  SELECT field, CASE WHEN field = 'props' THEN 'forbidden' WHEN field = 'value' THEN 'legacy'
                     WHEN field IN ('event_id','ts','user_id','event_type','k') THEN 'allowed'
                     ELSE 'unknown' END AS status
  FROM (SELECT unnest(list_concat(json_keys(props), [event_type, 'value', 'props', 'ts'])) AS field FROM events))
GROUP BY ALL""")
def lint_unknown_fields(t):
    """Keys of the payload and of the record; the event type stands in for a stray field."""
    keys = F.concat(F.json_object_keys("props"),
                    F.array(F.col("event_type"), F.lit("value"), F.lit("props"), F.lit("ts")))
    rows = lint.field_whitelist(t.events.select(F.explode(keys).alias("field")), ALLOWED,
                                ["props"], ["value"])
    return rows.groupBy("field", "status").agg(F.count(F.lit(1)).alias("n"))


@query("lint_required_fields", """
SELECT doc_id, concat_ws(',', CASE WHEN quality IS NULL THEN 'quality' END,
                              CASE WHEN toxic IS NULL THEN 'toxic' END) AS missing
FROM documents LEFT JOIN labels USING (doc_id) WHERE quality IS NULL OR toxic IS NULL""")
def lint_required_fields(t):
    rows = t.documents.select("doc_id", "lang", "source").join(t.labels, "doc_id", "left")
    found = lint.required(rows, ["lang", "source", "quality", "toxic"])
    return found.select("doc_id", F.array_join("missing", ",").alias("missing"))


TAGS = ["html", "head", "meta", "title", "body", "article", "h1", "p"]


@query("lint_sections", """
SELECT section, count(*) AS pages FROM (
  SELECT DISTINCT page_id, unnest(regexp_extract_all(html, '<([a-z0-9]+)', 1)) AS section FROM pages)
WHERE section NOT IN ('html','head','meta','title','body','article','h1','p') GROUP BY section""")
def lint_sections(t):
    sections = F.regexp_extract_all("html", F.lit("<([a-z0-9]+)"), F.lit(1))
    rows = lint.body_sections(t.pages.select("page_id", "html"), sections, TAGS)
    return rows.groupBy("section").agg(F.count(F.lit(1)).alias("pages"))


@query("norm_enum", """
SELECT CASE o_orderstatus WHEN 'F' THEN 'finished' WHEN 'O' THEN 'open' ELSE 'other' END AS status,
       CASE o_orderpriority WHEN '1-URGENT' THEN 'high' WHEN '2-HIGH' THEN 'high' WHEN '5-LOW' THEN 'low'
            ELSE 'medium' END AS priority, count(*) AS n FROM orders GROUP BY ALL""")
def norm_enum(t):
    rows = norm.enum(t.orders, "o_orderstatus", {"F": "finished", "O": "open"}, "status", "other")
    rows = norm.enum(rows, "o_orderpriority", {"1-URGENT": "high", "2-HIGH": "high", "5-LOW": "low"},
                     "priority", "medium")
    return rows.groupBy("status", "priority").agg(F.count(F.lit(1)).alias("n"))


@query("norm_confidence", """
SELECT event_type, round(sum(CASE WHEN event_type = 'error' THEN 0.5 WHEN event_type = 'view' THEN 0.9
       WHEN event_type = 'signup' THEN NULL ELSE value END), 2) AS total,
       count(CASE WHEN event_type <> 'signup' THEN 1 END) AS known
FROM events GROUP BY event_type""")
def norm_confidence(t):
    """A text field that holds a number, a word, a null marker or nothing usable."""
    raw = (F.when(F.col("event_type") == "error", "low").when(F.col("event_type") == "view", " High ")
           .when((F.col("event_type") == "signup") & (F.col("value") > 50), "~")
           .when(F.col("event_type") == "signup", "unclear")
           .otherwise(F.col("value").cast("string")))
    rows = norm.confidence(t.events.withColumn("raw", raw), "raw")
    return rows.groupBy("event_type").agg(F.round(F.sum("confidence"), 2).alias("total"),
                                          F.count("confidence").alias("known"))


@query("norm_coalesce", """
SELECT CASE WHEN event_type = 'click' THEN 'web' WHEN event_type = 'view' THEN 'app' END AS fetched_via,
       count(*) AS n FROM events GROUP BY 1""")
def norm_coalesce(t):
    rows = t.events.select(
        F.when(F.col("event_type") == "click", "web").when(F.col("event_type") == "error", "")
        .alias("fetched_via"),
        F.when(F.col("event_type") == "view", "app").when(F.col("event_type") == "error", "~")
        .when(F.col("event_type") == "click", "old").alias("fetched_method"))
    rows = norm.coalesce_alias(rows, {"fetched_method": "fetched_via"})
    return rows.groupBy("fetched_via").agg(F.count(F.lit(1)).alias("n"))


@query("lint_low_quality", """
SELECT doc_id, CAST(length(text) AS BIGINT) AS body_len FROM documents WHERE length(text) < 3000""")
def lint_low_quality(t):
    rows = lint.low_quality(t.documents.select("doc_id", "text"), "text")
    return rows.select("doc_id", F.col("body_len").cast("long").alias("body_len"))


@query("gate_main_graph", """
SELECT doc_id, lang FROM documents d WHERE NOT EXISTS (
  SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id AND l.toxic = 1)""")
def gate_main_graph(t):
    return gate.exclude(t.documents.select("doc_id", "lang"), t.labels.filter("toxic = 1"), "doc_id")


QUEUE = """
queue_events AS (SELECT event_id FROM events WHERE event_type = 'error' AND value > 100),
queue_users AS (SELECT DISTINCT user_id FROM events WHERE event_type = 'purchase' AND value > 250)"""


def queues(t):
    """Keys under review: events by their own id, and users with a very large purchase."""
    e = t.events.select("event_id", "user_id", "event_type", "value")
    return {"event_id": e.filter("event_type = 'error' and value > 100"),
            "user_id": e.filter("event_type = 'purchase' and value > 250").select("user_id").distinct()}


@query("gate_review_queue", "WITH " + QUEUE + """
SELECT event_id, user_id, event_type FROM events e
WHERE NOT EXISTS (SELECT 1 FROM queue_events q WHERE q.event_id = e.event_id)
  AND NOT EXISTS (SELECT 1 FROM queue_users q WHERE q.user_id = e.user_id)""")
def gate_review_queue(t):
    return gate.review(t.events.select("event_id", "user_id", "event_type"), queues(t))


SNAPSHOTS = """
new_docs AS (
  SELECT d.doc_id, CASE WHEN l.toxic = 1 THEN d.text || '!' ELSE d.text END AS text,
         CASE WHEN l.quality = 0 THEN 'xx' ELSE d.lang END AS lang,
         CASE WHEN d.lang = 'es' THEN d.source || 'x' ELSE d.source END AS source
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id WHERE d.n_chars >= 200)"""


def snapshots(t):
    """Old: all documents. New: toxic texts changed, languages of poor ones changed, Spanish
    sources changed, short documents gone."""
    old = t.documents.select("doc_id", "text", "lang", "source", "n_chars")
    new = old.join(t.labels, "doc_id", "left").filter("n_chars >= 200").select(
        "doc_id", F.when(F.col("toxic") == 1, F.concat("text", F.lit("!"))).otherwise(F.col("text")).alias("text"),
        F.when(F.col("quality") == 0, "xx").otherwise(F.col("lang")).alias("lang"),
        F.when(F.col("lang") == "es", F.concat("source", F.lit("x"))).otherwise(F.col("source")).alias("source"))
    return old.drop("n_chars"), new


@query("lint_immutable", "WITH " + SNAPSHOTS + """
SELECT o.doc_id, '*' AS field, 'removed' AS change FROM documents o
WHERE NOT EXISTS (SELECT 1 FROM new_docs n WHERE n.doc_id = o.doc_id)
UNION ALL SELECT o.doc_id, 'text', 'changed' FROM documents o JOIN new_docs n ON n.doc_id = o.doc_id WHERE n.text <> o.text
UNION ALL SELECT o.doc_id, 'source', 'changed' FROM documents o JOIN new_docs n ON n.doc_id = o.doc_id WHERE n.source <> o.source""")
def lint_immutable(t):
    old, new = snapshots(t)
    return lint.immutable(old, new, "doc_id", ["text", "lang", "source"], ["lang"])


@query("lint_id_year", """
WITH ids AS (SELECT o_orderkey, 'P_' || CASE o_orderpriority WHEN '1-URGENT' THEN '1900' WHEN '2-HIGH' THEN '2099'
    WHEN '5-LOW' THEN '1997' ELSE strftime(o_orderdate, '%Y') END || '_X_' || o_orderkey AS id,
    year(o_orderdate) AS y FROM orders)
SELECT id, CASE WHEN id LIKE 'P_1900%' THEN 'placeholder' WHEN id LIKE 'P_2099%' THEN 'future' ELSE 'mismatch' END AS problem
FROM ids WHERE id LIKE 'P_1900%' OR id LIKE 'P_2099%' OR CAST(substr(id, 3, 4) AS BIGINT) <> y""")
def lint_id_year(t):
    year = (F.when(F.col("o_orderpriority") == "1-URGENT", "1900")
            .when(F.col("o_orderpriority") == "2-HIGH", "2099")
            .when(F.col("o_orderpriority") == "5-LOW", "1997")
            .otherwise(F.date_format("o_orderdate", "yyyy")))
    rows = t.orders.select(F.concat(F.lit("P_"), year, F.lit("_X_"), F.col("o_orderkey")).alias("id"),
                           F.to_date("o_orderdate").alias("date"))
    return lint.id_year(rows, "id", "date", 2026).select("id", "problem")


@query("lint_orphan_refs", "WITH " + D.EDGES + """
SELECT e.src, e.dst, e.rel, 'dst' AS missing_end FROM edges e
WHERE NOT EXISTS (SELECT 1 FROM documents d WHERE d.doc_id = e.dst)""")
def lint_orphan_refs(t):
    return lint.orphans(D.edges(t), t.documents.select("doc_id"), "doc_id")


PAIRS = """
required AS (SELECT DISTINCT src, dst FROM edges WHERE rel IN ('iterates', 'supersedes')),
present AS (SELECT DISTINCT e.src, e.dst FROM edges e JOIN labels l ON l.doc_id = e.src
            WHERE e.rel IN ('iterates', 'extends'))"""


@query("lint_missing_pairs", "WITH " + D.EDGES + "," + PAIRS + """
SELECT src, dst, 'missing' AS status FROM (SELECT * FROM required EXCEPT SELECT * FROM present)
UNION ALL SELECT src, dst, 'extra' FROM (SELECT * FROM present EXCEPT SELECT * FROM required)""")
def lint_missing_pairs(t):
    edges = D.edges(t)
    needed = edges.filter(F.col("rel").isin("iterates", "supersedes")).select("src", "dst").distinct()
    held = edges.filter(F.col("rel").isin("iterates", "extends")).join(
        t.labels.select(F.col("doc_id").alias("src")), "src", "left_semi").select("src", "dst").distinct()
    return lint.diff_pairs(needed, held, ["src", "dst"])


@query("set_diff", """
WITH a AS (SELECT lang, source, count(*) AS c FROM documents GROUP BY ALL),
b AS (SELECT d.lang, d.source, count(*) AS c FROM documents d JOIN labels l ON d.doc_id = l.doc_id GROUP BY ALL)
SELECT a.lang, a.source, 'missing' AS status, a.c - coalesce(b.c, 0) AS n
FROM a LEFT JOIN b ON a.lang = b.lang AND a.source = b.source WHERE a.c <> coalesce(b.c, 0)""")
def set_diff(t):
    cols = ["lang", "source"]
    held = t.documents.join(t.labels, "doc_id", "left_semi").select(*cols)
    return lint.set_diff(t.documents.select(*cols), held)


def findings(t):
    docs = t.documents.select("doc_id", "text", "lang", "source")
    return lint.report({
        "frontmatter_missing": ("error", lint.required(docs.join(t.labels, "doc_id", "left").filter(
            "toxic = 1").withColumn("date", F.when(F.col("quality") == 1, "x")), ["date"]).select(
            "doc_id", "missing")),
        "low_quality_capture": ("warning", lint.low_quality(docs, "text").select("doc_id", "body_len")),
        "orphan_refs": ("warning", lint.orphans(D.edges(t), docs, "doc_id")),
        "not_labelled": ("info", docs.join(t.labels, "doc_id", "left_anti").select("doc_id")),
    })


FINDINGS = D.EDGES + """,
findings AS (
  SELECT 'frontmatter_missing' AS rule, 'error' AS severity FROM labels WHERE toxic = 1 AND quality = 0
  UNION ALL SELECT 'low_quality_capture', 'warning' FROM documents WHERE length(text) < 3000
  UNION ALL SELECT 'orphan_refs', 'warning' FROM edges WHERE dst NOT IN (SELECT doc_id FROM documents)
  UNION ALL SELECT 'not_labelled', 'info' FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels))"""


@query("lint_report", "WITH " + FINDINGS + """
SELECT rule, severity, count(*) AS n FROM findings GROUP BY ALL""")
def lint_report(t):
    return lint.totals(findings(t))


@query("lint_daily", "WITH " + FINDINGS + """
SELECT count(*) FILTER (severity = 'error') AS errors, count(*) FILTER (severity = 'warning') AS warnings,
       count(*) FILTER (severity = 'info') AS infos, count(*) FILTER (severity = 'error') = 0 AS lint_pass
FROM findings""")
def lint_daily(t):
    return lint.daily(findings(t))


RULE_TEXT = """
flags AS (SELECT doc_id, regexp_matches(text, '[0-9]{8,}') AS a, contains(text, '@') AS b,
                 contains(text, 'icense') AS c, n_chars < 300 AS d, n_chars > 3000 AS e FROM documents),
verdicts AS (SELECT doc_id, CASE WHEN a THEN 'C' WHEN b THEN 'B' WHEN c THEN 'D' WHEN d THEN 'C' WHEN e THEN 'A' ELSE '?' END AS type,
  CASE WHEN a THEN 0.9 WHEN b THEN 0.55 WHEN c THEN 0.85 WHEN d THEN 0.72 WHEN e THEN 0.8 ELSE 0.4 END AS confidence,
  CASE WHEN a THEN 'number run' WHEN b THEN 'address' WHEN c THEN 'license line' WHEN d THEN 'short'
       WHEN e THEN 'long' ELSE 'no rule' END AS reason FROM flags)"""


def verdicts(t):
    from docgraph.operators import audit

    return audit.classify(t.texts, [
        (F.col("text").rlike("[0-9]{8,}"), "C", 0.9, "number run"),
        (F.contains("text", F.lit("@")), "B", 0.55, "address"),
        (F.contains("text", F.lit("icense")), "D", 0.85, "license line"),
        (F.col("n_chars") < 300, "C", 0.72, "short"),
        (F.col("n_chars") > 3000, "A", 0.8, "long"),
    ]).select("doc_id", "source", "type", "confidence", "reason")


@query("audit_classify", "WITH " + RULE_TEXT + """
SELECT doc_id, type, CAST(confidence AS DOUBLE) AS confidence, reason FROM verdicts""")
def audit_classify(t):
    return verdicts(t).drop("source")


@query("audit_borderline", "WITH " + RULE_TEXT + """
SELECT doc_id, type, CAST(confidence AS DOUBLE) AS confidence, reason FROM verdicts WHERE confidence < 0.7""")
def audit_borderline(t):
    from docgraph.operators import audit

    return audit.borderline(verdicts(t)).drop("source").orderBy("confidence", "doc_id")




@query("nested_json", """
SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k,
       '{"k":' || CAST(json_extract(props, '$.k') AS BIGINT) || ',"type":"' || event_type || '"}' AS payload
FROM events""")
def nested_json(t):
    from docgraph.operators import nested

    schema = T.StructType([T.StructField("k", T.LongType())])
    rows = nested.parse(t.events, "props", schema)
    return rows.select("event_id", F.col("parsed.k").alias("k"), nested.dump(
        F.struct(F.col("parsed.k").alias("k"), F.col("event_type").alias("type"))).alias("payload"))
