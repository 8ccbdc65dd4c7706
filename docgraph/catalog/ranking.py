"""Top-k, recency, monthly reports, timelines, claims."""

from datetime import date

from pyspark.sql import functions as F

from docgraph.catalog import derive as D
from docgraph.catalog.base import query
from docgraph.plans import storage
from docgraph.operators import check, cover, rank, report, theme

WITH_DOCS = "WITH " + D.DOCS
AS_OF = date(2025, 6, 1)


@query("rank_topk", WITH_DOCS + """
SELECT theme, doc_id, importance, rank FROM (
  SELECT *, row_number() OVER (PARTITION BY theme ORDER BY importance DESC, doc_id) AS rank FROM themed) WHERE rank <= 10""")
def rank_topk(t):
    rows = D.themed(t).select("theme", "doc_id", "importance")
    return rank.topk(rows, ["theme"], [F.desc("importance"), F.col("doc_id")], 10)


@query("check_ordinal", WITH_DOCS + """,
r AS (SELECT *, row_number() OVER w AS ordinal, lag(doc_id) OVER w AS predecessor,
             first_value(doc_id) OVER w AS first FROM themed WINDOW w AS (PARTITION BY theme, level ORDER BY date, doc_id))
SELECT theme, level, doc_id, ordinal, predecessor, first, ordinal = 1 AS holds FROM r
WHERE doc_id IN (SELECT doc_id FROM documents WHERE contains(lower(text), 'first') OR contains(text, 'and') OR contains(text, 'une'))""")
def check_ordinal(t):
    """Claim words of the test languages in the whole text."""
    claims = t.documents.select("doc_id", (
        F.contains(F.lower("text"), F.lit("first")) | F.contains("text", F.lit("and"))
        | F.contains("text", F.lit("une"))).alias("claim"))
    rows = D.themed(t).select("theme", "level", "doc_id", "date").join(claims, "doc_id")
    out = check.ordinal_claims(rows, "doc_id", ["theme", "level"], "date", F.col("claim"))
    return out.select("theme", "level", "doc_id", "ordinal", "predecessor", "first", "holds")


@query("rank_recent", WITH_DOCS + """
SELECT doc_id, strftime(date, '%Y-%m-%d') AS date, importance FROM docs
WHERE date > DATE '2025-05-02' AND date <= DATE '2025-06-01' ORDER BY importance DESC, docs.date DESC, doc_id LIMIT 10""")
def rank_recent(t):
    rows = D.docs(t).select("doc_id", "date", "importance")
    out = rank.recent(rows, "date", AS_OF, 30, [F.desc("importance"), F.desc("date"), F.col("doc_id")], 10)
    return out.withColumn("date", D.day("date"))


@query("report_monthly", WITH_DOCS + """,
c AS (SELECT date_trunc('month', date) AS month, CASE WHEN importance >= 4 THEN 'strong' WHEN importance = 3 THEN 'medium' ELSE 'weak' END AS band,
             count(*) AS n FROM docs GROUP BY ALL),
m AS (SELECT band, unnest(generate_series(min(month)::TIMESTAMP, (SELECT max(month) FROM c)::TIMESTAMP, INTERVAL 1 MONTH))::DATE AS month
      FROM c GROUP BY band)
SELECT strftime(m.month, '%Y-%m-%d') AS month, m.band, coalesce(c.n, 0) AS n, coalesce(p.n, 0) AS previous,
       coalesce(c.n, 0) - coalesce(p.n, 0) AS change
FROM m LEFT JOIN c ON c.band = m.band AND c.month = m.month
LEFT JOIN c p ON p.band = m.band AND p.month + INTERVAL 1 MONTH = m.month""")
def report_monthly(t):
    return report.monthly(D.docs(t), "date", "importance").withColumn("month", D.day("month"))


@query("report_cards", WITH_DOCS + """
SELECT strftime(date_trunc('month', date), '%Y-%m-%d') AS month, doc_id, importance, rank FROM (
  SELECT *, row_number() OVER (PARTITION BY date_trunc('month', date) ORDER BY importance DESC, date, doc_id) AS rank
  FROM docs WHERE importance >= 4 AND doc_id IN (SELECT doc_id FROM labels WHERE quality = 1)) WHERE rank <= 4""")
def report_cards(t):
    hits = t.labels.filter("quality = 1").select("doc_id", F.lit(True).alias("hit"))
    rows = D.docs(t).join(hits, "doc_id")
    out = report.cards(rows, "date", "importance", "hit", "doc_id")
    return out.select(D.day("month").alias("month"), "doc_id", "importance", "rank")


@query("report_listing", WITH_DOCS + """
SELECT strftime(date_trunc('month', date), '%Y-%m-%d') AS month,
       CASE WHEN importance >= 4 THEN 'strong' WHEN importance = 3 THEN 'medium' ELSE 'weak' END AS band, doc_id FROM docs""")
def report_listing(t):
    out = report.listing(D.docs(t), "date", "importance")
    return out.select(D.day("month").alias("month"), "band", "doc_id")


@query("cover_diffusion", WITH_DOCS + """,
f AS (SELECT theme, nation, min(date) AS adopted FROM themed GROUP BY ALL),
s AS (SELECT theme, adopted, count(*) AS new_regions FROM f GROUP BY ALL)
SELECT theme, strftime(adopted, '%Y-%m-%d') AS adopted, new_regions,
       CAST(sum(new_regions) OVER (PARTITION BY theme ORDER BY adopted) AS BIGINT) AS regions FROM s""")
def cover_diffusion(t):
    return cover.diffusion(D.themed(t), "theme", "nation", "date").withColumn("adopted", D.day("adopted"))


@query("theme_timeline", WITH_DOCS + """
SELECT theme, level, strftime(date, '%Y-%m-%d') AS date, doc_id, importance FROM themed WHERE importance >= 4
ORDER BY theme, level, themed.date, doc_id""")
def theme_timeline(t):
    out = theme.timeline(D.themed(t), "theme", "level", "date", "doc_id", "importance")
    return out.select("theme", "level", D.day("date").alias("date"), "doc_id", "importance")


@query("rank_frequent", """
SELECT p_name, count(*) AS n FROM part GROUP BY p_name ORDER BY n DESC, p_name LIMIT 15""")
def rank_frequent(t):
    return rank.frequent(t.part, "p_name", 15)


@query("rank_frequent_merged", """
SELECT event_type, k, n FROM (
  SELECT event_type, CAST(json_extract(props, '$.k') AS BIGINT) AS k, count(*) AS n FROM events GROUP BY ALL)
QUALIFY rank() OVER (PARTITION BY event_type ORDER BY n DESC) <= 3""")
def rank_frequent_merged(t):
    """Sketches per type and day, stored and combined: the most frequent numbers of each type.

    There are fewer numbers than the sketch tracks, so counts are exact; the values that share the
    third place are all listed.
    """
    rows = t.events.select("event_type", F.to_date("ts").alias("day"),
                           F.get_json_object("props", "$.k").cast("long").alias("k"))
    days = storage.stored(rank.tracked(rows, ["event_type", "day"], "k"), "sketches")
    top = rank.combined(days, ["event_type"], "k", 1_000)
    third = F.element_at(F.sort_array(F.collect_list("n"), False), F.lit(3))
    least = top.groupBy("event_type").agg(third.alias("_third"))
    return top.join(least, "event_type").filter("n >= _third").drop("_third")


@query("rank_frequent_approx")
def rank_frequent_approx(t):
    return rank.frequent_approx(t.lineitem, "l_partkey", 15)


@query("rank_bounded", """
SELECT lang, doc_id, rank, total, greatest(total - 20, 0) AS more FROM (
  SELECT lang, doc_id, row_number() OVER (PARTITION BY lang ORDER BY n_chars, doc_id) AS rank,
         count(*) OVER (PARTITION BY lang) AS total FROM documents) WHERE rank <= 20""")
def rank_bounded(t):
    rows = t.documents.select("lang", "doc_id", "n_chars")
    return rank.bounded(rows, ["lang"], [F.col("n_chars"), F.col("doc_id")], 20).drop("n_chars")
