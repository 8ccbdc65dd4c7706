"""Text, date, URL and hash functions over whole texts."""

from pyspark.sql import functions as F

from docgraph.catalog import derive as D
from docgraph.catalog.base import query
from docgraph.functions import text
from docgraph.operators import lint

MARK = "[0-9a-f]{16,40}"


@query("text_extract_refs", rf"""
SELECT DISTINCT doc_id, unnest(regexp_extract_all(text, '{MARK}')) AS mark FROM documents""")
def text_extract_refs(t):
    """Number-like marks cited in the texts; the document-number form is tested on its own."""
    return t.documents.select("doc_id", F.explode(text.marks("text", MARK)).alias("mark"))


@query("text_extract_date", r"""
SELECT page_id, strftime(make_date(2024, m, d), '%Y-%m-%d') AS date, 'url_path_pattern' AS method
FROM (SELECT page_id, CAST(1 + length(html) % 12 AS BIGINT) AS m, CAST(1 + page_id % 28 AS BIGINT) AS d, url FROM pages)
WHERE url LIKE 'https:%'
UNION ALL
SELECT page_id, strftime(make_date(2023, CAST(1 + page_id % 12 AS BIGINT), CAST(1 + length(html) % 28 AS BIGINT)), '%Y-%m-%d'),
       'body_chinese_date' FROM pages WHERE url NOT LIKE 'https:%'""")
def text_extract_date(t):
    """Secure pages get a dated address, the others a date in the body; both are read back."""
    rows = t.pages.select(
        "page_id", F.when(F.col("url").startswith("https:"), F.format_string(
            "%s/2024-%02d-%02d/", F.regexp_extract("url", "^[a-z]+://[^/]+", 0),
            1 + F.length("html") % 12, 1 + F.col("page_id") % 28)).otherwise(
            F.regexp_extract("url", "^[a-z]+://[^/]+", 0)).alias("url"),
        F.when(~F.col("url").startswith("https:"), F.concat("html", F.format_string(
            "2023年%d月%d日", 1 + F.col("page_id") % 12, 1 + F.length("html") % 28)))
        .otherwise(F.col("html")).alias("body"))
    found = rows.withColumn("_f", text.extract_date(F.col("url"), F.col("body"), F.lit("")))
    return found.select("page_id", D.day("_f.date").alias("date"), F.col("_f.method").alias("method"))


@query("text_url_host", r"""
SELECT lower(regexp_extract(url, '^[a-z]+://([^/?#:]+)', 1)) AS host, count(*) AS n FROM pages GROUP BY 1""")
def text_url_host(t):
    return t.pages.groupBy(text.host("url").alias("host")).agg(F.count(F.lit(1)).alias("n"))


@query("text_norm_title", r"""
SELECT page_id, lower(regexp_replace(regexp_replace(regexp_extract(html, '<title>([^<]*)</title>', 1),
  '[(（〔\[【][^)）〕\]】]*[)）〕\]】]', '', 'g'), '[^\p{L}\p{N}]+', '', 'g')) AS title FROM pages""")
def text_norm_title(t):
    title = F.regexp_extract("html", "<title>([^<]*)</title>", 1)
    return t.pages.select("page_id", text.norm_title(title).alias("title"))


@query("text_evidence_snippet", "WITH " + D.MENTIONS + """
SELECT doc_id, item_id, pos, evidence_count, snippet FROM mentions""")
def text_evidence_snippet(t):
    return D.mentions(t).select("doc_id", "item_id", "pos", "evidence_count", "snippet")


@query("text_ref_location", "WITH " + D.MENTIONS + """
SELECT location, count(*) AS n, CAST(min(pos) AS BIGINT) AS first_pos, CAST(max(pos) AS BIGINT) AS last_pos
FROM mentions GROUP BY location""")
def text_ref_location(t):
    return D.mentions(t).groupBy("location").agg(
        F.count(F.lit(1)).alias("n"), F.min("pos").cast("long").alias("first_pos"),
        F.max("pos").cast("long").alias("last_pos"))


@query("text_links", """
SELECT page_id, target, count(*) AS n
FROM (SELECT page_id, unnest(regexp_extract_all(html, '<a href="([^"]*)"', 1)) AS target FROM pages)
GROUP BY ALL""")
def text_links(t):
    rows = t.pages.select("page_id", F.explode(text.links("html")).alias("target"))
    return rows.groupBy("page_id", "target").agg(F.count(F.lit(1)).alias("n"))


@query("text_hash_id", """
SELECT doc_id, 'C_' || substr(sha256(source || '|' || text), 1, 12) AS hash_id FROM documents""")
def text_hash_id(t):
    return t.documents.select("doc_id", text.hash_id("C_", F.col("source"), F.col("text")).alias("hash_id"))


TERMS = ["license", "License", "MIT", "Apache", "token", "password", "copyright", "Released under"]


@query("lint_terms", """
SELECT doc_id, term, count(*) AS n FROM (
  SELECT doc_id, unnest(regexp_extract_all(text, '(Released under|copyright|password|license|License|Apache|token|MIT)', 1)) AS term
  FROM documents) GROUP BY ALL""")
def lint_terms(t):
    return lint.terms(t.texts, "doc_id", "text", TERMS)


@query("text_sanitize", r"""
SELECT doc_id, CAST(length(clean) AS BIGINT) AS clean_len, md5(clean) AS digest
FROM (SELECT doc_id, regexp_replace(replace(text, 'MIT License', 'open licence'),
             '(#{3}|%{3}|[$]{3}|&{3}|[*]{3})', '', 'g') AS clean FROM documents)""")
def text_sanitize(t):
    clean = text.sanitize("text", {"MIT License": "open licence"}, r"(#{3}|%{3}|[$]{3}|&{3}|[*]{3})")
    return t.texts.select("doc_id", clean.alias("c")).select(
        "doc_id", F.length("c").cast("long").alias("clean_len"), F.md5("c").alias("digest"))
