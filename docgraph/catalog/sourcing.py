"""Sources and sinks."""

from pyspark.sql import functions as F
from pyspark.sql import types as T

from docgraph.catalog import derive as D
from docgraph.catalog.base import query
from docgraph.functions import text
from docgraph.plans import storage
from docgraph.sources import ingest, sink


@query("ingest_pages", r"""
SELECT page_id, trim(regexp_extract(html, '<title>([^<]*)</title>', 1)) AS title,
       regexp_extract(html, '<html lang="([a-z]+)"', 1) AS lang,
       CAST((length(html) - length(replace(html, '<a href="', ''))) // 9 AS BIGINT) AS n_links
FROM pages""")
def ingest_pages(t):
    return ingest.markup(t.pages.select("page_id", "html"), "html").drop("html")


@query("ingest_events_props", """
SELECT event_type, CAST(json_extract(props, '$.k') AS BIGINT) AS k, count(*) AS n
FROM events GROUP BY ALL""")
def ingest_events_props(t):
    schema = T.StructType([T.StructField("k", T.LongType())])
    good, _ = ingest.json_column(t.events.select("event_type", "props"), "props", schema)
    return good.groupBy("event_type", "k").agg(F.count(F.lit(1)).alias("n"))


@query("ingest_jsonl_files", """
SELECT event_type, count(*) AS n, count(DISTINCT user_id) AS users, CAST(sum(event_id) AS BIGINT) AS ids
FROM events GROUP BY event_type""")
def ingest_jsonl_files(t):
    path = storage.work_path(t.spark, "jsonl")
    t.events.select("event_id", "user_id", "event_type").write.json(path)
    schema = T.StructType([T.StructField("event_id", T.LongType()),
                           T.StructField("user_id", T.LongType()),
                           T.StructField("event_type", T.StringType())])
    good, _ = ingest.jsonl(t.spark, path, schema)
    return good.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("user_id").alias("users"),
        F.sum("event_id").alias("ids"))


@query("ingest_documents", r"""
SELECT doc_id, lang, source, n_chars,
       CAST(length(regexp_replace(text, '\r\n?', chr(10), 'g')) AS BIGINT) AS body_len
FROM documents WHERE lang <> 'es'
UNION ALL SELECT NULL, NULL, 'no header', count(*), 0 FROM documents WHERE lang = 'es'""")
def ingest_documents(t):
    """All documents written as header and body, those in Spanish without header, and parsed back."""
    whole = F.concat(F.lit("---\nid: "), F.col("doc_id"), F.lit("\nlang: '"), F.col("lang"),
                     F.lit("'\nprovenance:\n  source: "), F.col("source"), F.lit("\n  chars: "),
                     F.col("n_chars"), F.lit("\n---\n"), F.col("text"))
    raw = t.texts.select(F.when(F.col("lang") == "es", F.col("text")).otherwise(whole).alias("value"))
    schema = T.StructType([
        T.StructField("id", T.LongType()), T.StructField("lang", T.StringType()),
        T.StructField("provenance", T.StructType([
            T.StructField("source", T.StringType()), T.StructField("chars", T.LongType())]))])
    good, bad = ingest.parse_documents(raw, schema, "value", ("id",))
    rows = good.select(F.col("id").alias("doc_id"), "lang", F.col("provenance.source").alias("source"),
                       F.col("provenance.chars").alias("n_chars"),
                       F.length("body").cast("long").alias("body_len"))
    lost = bad.groupBy("reason").agg(F.count(F.lit(1)).alias("n_chars")).select(
        F.lit(None).cast("long").alias("doc_id"), F.lit(None).cast("string").alias("lang"),
        F.col("reason").alias("source"), "n_chars", F.lit(0).cast("long").alias("body_len"))
    return rows.unionByName(lost)


@query("ingest_records", r"""
WITH cut AS (SELECT *, array_to_string(list_transform(string_split(replace(text, chr(13) || chr(10), chr(10)), chr(10)),
               lambda l: CASE WHEN trim(l, ' ') = '' THEN '' ELSE l END), chr(10)) AS body FROM documents)
SELECT doc_id, lang, source, CAST(doc_id % 6 AS INTEGER) AS d1, CAST(n_chars % 6 AS INTEGER) AS d2, 2 * n_chars + 1 AS parts,
       'one two' || chr(10) || source || ' it''s: #' || doc_id AS impact,
       md5(rtrim('text' || chr(10) || body, chr(10))) AS text_md5
FROM cut WHERE lang <> 'es'
UNION ALL SELECT NULL, NULL, 'brackets not understood', NULL, NULL, count(*), NULL, NULL FROM documents WHERE lang = 'es'""")
def ingest_records(t):
    """All documents written as records and read back; Spanish ones with a list that does not close."""
    id_, chars = F.col("doc_id"), F.col("n_chars")
    lines = F.transform(F.split("text", "\n"), lambda line: F.concat(F.lit("    "), line))
    record = F.concat(
        F.lit("# a record\npid: P_"), id_, F.lit("   # remark"), F.lit("\nthemes:\n- "), F.col("lang"),
        F.lit("\n-   '"), F.col("source"), F.lit("'\nscores:\n  D1: "), id_ % 6, F.lit("\n  D2: "), chars % 6,
        F.lit("\nparts:\n  - n: 1\n    of: {chars: "), chars, F.lit("}\n  -\n    n: 2\n    of:\n        chars: "),
        chars + 1, F.lit("\nimpact:\n  main: 'one\n    two\n\n    "), F.col("source"), F.lit(" it''s: #"), id_,
        F.lit("'\n  text: |-\n    text\n"), F.array_join(lines, "\n"), F.lit("\n\nlast: ~\n"))
    broken = F.concat(F.lit("pid: P_"), id_, F.lit("\nthemes: [a, [b]]"))
    schema = T.StructType([
        T.StructField("pid", T.StringType()), T.StructField("themes", T.ArrayType(T.StringType())),
        T.StructField("scores", T.MapType(T.StringType(), T.IntegerType())),
        T.StructField("parts", T.ArrayType(T.StructType([
            T.StructField("n", T.IntegerType()), T.StructField("of", T.MapType(T.StringType(), T.LongType()))]))),
        T.StructField("impact", T.MapType(T.StringType(), T.StringType()))])
    raw = t.texts.select(F.when(F.col("lang") == "es", broken).otherwise(record).alias("value"))
    good, bad = ingest.records(raw, schema, required=("pid",))
    rows = good.select(
        F.substring("pid", 3, 20).cast("long").alias("doc_id"), F.col("themes")[0].alias("lang"),
        F.col("themes")[1].alias("source"), F.col("scores")["D1"].alias("d1"), F.col("scores")["D2"].alias("d2"),
        F.aggregate("parts", F.lit(0).cast("long"), lambda n, p: n + p["of"]["chars"]).alias("parts"),
        F.col("impact")["main"].alias("impact"), F.md5(F.col("impact")["text"]).alias("text_md5"))
    lost = bad.groupBy(F.split_part("reason", F.lit(":"), F.lit(1)).alias("source")).agg(
        F.count(F.lit(1)).alias("parts"))
    return rows.unionByName(lost, allowMissingColumns=True)


@query("registry_alias_dim", "WITH " + D.ALIASES + """
SELECT item_id, alias, count(*) OVER (PARTITION BY alias) AS owners FROM alias_dim""")
def registry_alias_dim(t):
    return ingest.registry(D.registry(t), "item_id").filter("alias is not null")


@query("append_new_docs", """
SELECT strftime(DATE '2020-01-01' + CAST(doc_id * 37 % 2000 AS INTEGER), '%Y') AS year,
       count(*) AS n, count(DISTINCT doc_id) AS ids, CAST(sum(n_chars) AS BIGINT) AS chars
FROM documents GROUP BY 1""")
def append_new_docs(t):
    """Store the labelled documents, then append all: those stored already are left alone."""
    path = storage.work_path(t.spark, "raw")
    rows = t.documents.join(D.docs(t).select("doc_id", F.year("date").cast("string").alias("year")),
                            "doc_id")
    sink.append_new(rows.join(t.labels, "doc_id", "left_semi"), path, "doc_id", "year")
    sink.append_new(rows, path, "doc_id", "year")
    return sink.existing(t.spark, path, rows.schema).groupBy("year").agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("doc_id").alias("ids"),
        F.sum("n_chars").alias("chars"))


@query("append_manifest", """
SELECT 'first' AS batch, 'rows' AS part, count(*) AS n, CAST(sum(n_chars) AS BIGINT) AS chars FROM documents WHERE doc_id IN (SELECT doc_id FROM labels)
UNION ALL SELECT 'second', 'rows', count(*), CAST(sum(n_chars) AS BIGINT) FROM documents
  WHERE doc_id NOT IN (SELECT doc_id FROM labels) AND lang NOT IN ('es', 'fr')
UNION ALL SELECT 'second', 'several contents', 2 * count(*), CAST(sum(2 * n_chars + 1) AS BIGINT) FROM documents
  WHERE doc_id NOT IN (SELECT doc_id FROM labels) AND lang = 'es'
UNION ALL SELECT 'second', 'other content is stored', count(*), CAST(sum(n_chars + 1) AS BIGINT) FROM documents
  WHERE doc_id IN (SELECT doc_id FROM labels) AND lang = 'es'
UNION ALL SELECT 'second', 'no key', count(*), CAST(sum(n_chars) AS BIGINT) FROM documents WHERE lang = 'fr'""")
def append_manifest(t):
    """Labelled documents first; then all, French ones without a key, Spanish ones in two versions."""
    path = storage.work_path(t.spark, "manifest")
    rows = t.documents
    sink.append_batch(rows.join(t.labels, "doc_id", "left_semi"), path, "doc_id", "first")
    twice = rows.unionByName(rows.filter("lang = 'es'").withColumn("n_chars", F.col("n_chars") + 1))
    again = twice.withColumn("doc_id", F.when(F.col("lang") != "fr", F.col("doc_id")))
    for _ in range(2):  # the second time it is in already
        sink.append_batch(again, path, "doc_id", "second")
    kept = sink.stored_rows(t.spark, path, rows.schema).withColumn("part", F.lit("rows"))
    aside = sink.rejected_rows(t.spark, path, rows.schema).withColumnRenamed("reason", "part")
    return kept.unionByName(aside).groupBy("batch", "part").agg(
        F.count(F.lit(1)).alias("n"), F.sum("n_chars").alias("chars"))


@query("rewrite_roundtrip", """
SELECT lang, count(*) AS n, CAST(sum(CASE WHEN lang = 'en' THEN n_chars ELSE -n_chars END) AS BIGINT) AS chars
FROM documents GROUP BY lang""")
def rewrite_roundtrip(t):
    """Write the table with negated lengths, then rewrite one partition only."""
    path = storage.work_path(t.spark, "derived")
    rows = t.documents.select("doc_id", "lang", "n_chars")
    sink.rewrite(rows.withColumn("n_chars", -F.col("n_chars")), path, ["lang"])
    sink.rewrite(rows.filter("lang = 'en'"), path, ["lang"])
    return t.spark.read.parquet(path).groupBy("lang").agg(
        F.count(F.lit(1)).alias("n"), F.sum("n_chars").alias("chars"))


@query("archive_split", """
SELECT CASE WHEN reason = 'none' THEN 'kept' ELSE 'dropped' END AS disposition, reason, count(*) AS n
FROM (SELECT CASE WHEN l.toxic = 1 THEN 'excluded' WHEN d.n_chars < 300 THEN 'too short'
                  WHEN d.source = 'src0' THEN 'noise source' ELSE 'none' END AS reason
      FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id) GROUP BY reason""")
def archive_split(t):
    path = storage.work_path(t.spark, "split")
    rows = t.documents.join(t.labels, "doc_id", "left")
    sink.split_archive(rows, {"excluded": F.col("toxic") == 1, "too short": F.col("n_chars") < 300,
                              "noise source": F.col("source") == "src0"}, path)
    return t.spark.read.parquet(path).groupBy("disposition", "reason").agg(F.count(F.lit(1)).alias("n"))


@query("link_channel", r"""
WITH pg AS (SELECT page_id, lower(regexp_extract(url, '^[a-z]+://([^/?#:]+)', 1)) AS host, url FROM pages),
channels AS (SELECT DISTINCT host, regexp_extract(host, '([a-z]+)[.][a-z]+$', 1) AS issuer,
                    CAST(length(host) % 3 AS BIGINT) AS level
             FROM pg WHERE url LIKE 'https:%')
SELECT pg.host, c.issuer, c.level, count(*) AS n FROM pg LEFT JOIN channels c ON pg.host = c.host
GROUP BY ALL""")
def link_channel(t):
    """Registry: the hosts that serve a secure page; the others stay without issuer."""
    from docgraph.operators import link

    channels = t.pages.filter(F.col("url").startswith("https:")).select(
        text.host("url").alias("host")).distinct().select(
        "host", F.regexp_extract("host", r"([a-z]+)[.][a-z]+$", 1).alias("issuer"),
        (F.length("host") % 3).cast("long").alias("level"))
    linked = link.channel(t.pages.select("page_id", "url"), "url", channels)
    return linked.groupBy("host", "issuer", "level").agg(F.count(F.lit(1)).alias("n"))
