"""Distributions, opinions, coverage, themes."""

from pyspark.sql import functions as F

from docgraph.catalog import derive as D
from docgraph.catalog.base import query
from docgraph.plans import storage
from docgraph.catalog.quality import RULE_TEXT, verdicts
from docgraph.operators import agg, backlog, cover, link, nested, opinion, report, signals, theme

WITH_DOCS = "WITH " + D.DOCS
WITH_STANCES = "WITH " + D.STANCES
TYPES = ["click", "error", "purchase", "signup", "view"]


@query("agg_distribution", """
SELECT source, count(*) AS n, round(100.0 * count(*) / (SELECT count(*) FROM documents), 1) AS pct FROM documents GROUP BY source""")
def agg_distribution(t):
    return agg.distribution(t.documents, "source")


@query("agg_buckets", "WITH " + RULE_TEXT + """,
names(bucket) AS (VALUES ('high'), ('mid'), ('low')),
counts AS (SELECT CASE WHEN confidence >= 0.85 THEN 'high' WHEN confidence >= 0.70 THEN 'mid' ELSE 'low' END AS bucket,
                  count(*) AS n FROM verdicts GROUP BY 1)
SELECT bucket, coalesce(n, 0) AS n FROM names LEFT JOIN counts USING (bucket)""")
def agg_buckets(t):
    return agg.buckets(verdicts(t), "confidence", [("high", 0.85), ("mid", 0.70)], "low")


@query("agg_crosstab", "WITH " + RULE_TEXT + """
SELECT d.source, count(*) FILTER (type = 'A') AS a, count(*) FILTER (type = 'B') AS b, count(*) FILTER (type = 'C') AS c,
       count(*) FILTER (type = 'D') AS d, count(*) AS total
FROM verdicts v JOIN documents d ON d.doc_id = v.doc_id GROUP BY d.source""")
def agg_crosstab(t):
    out = agg.crosstab(verdicts(t), "source", "type", ["A", "B", "C", "D"])
    return out.withColumnsRenamed({x: x.lower() for x in "ABCD"})


@query("agg_scenarios", "WITH " + RULE_TEXT + """
SELECT 'drop C' AS scenario, count(*) AS total, count(*) FILTER (type <> 'C') AS remaining,
       round(100.0 * count(*) FILTER (type <> 'C') / count(*), 1) AS pct FROM verdicts
UNION ALL SELECT 'keep A and D', count(*), count(*) FILTER (type NOT IN ('B', 'C', '?')),
       round(100.0 * count(*) FILTER (type NOT IN ('B', 'C', '?')) / count(*), 1) FROM verdicts""")
def agg_scenarios(t):
    return agg.scenarios(verdicts(t), "type", {"drop C": ["C"], "keep A and D": ["B", "C", "?"]})


@query("agg_region_rollup", """
SELECT r_name, n_name, count(*) AS n, CAST(grouping(r_name) * 2 + grouping(n_name) AS BIGINT) AS depth
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
GROUP BY ROLLUP (r_name, n_name)""")
def agg_region_rollup(t):
    places = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    rows = t.customer.select("c_nationkey").join(
        places.select("n_nationkey", "n_name", "r_name"),
        F.col("c_nationkey") == F.col("n_nationkey"))
    return agg.region_rollup(rows, "r_name", "n_name").withColumn("depth", F.col("depth").cast("long"))


@query("agg_region_map", """
SELECT r_name, string_agg(n_name || '=' || n, ',' ORDER BY n_name) AS names FROM (
  SELECT r_name, n_name, count(*) AS n FROM customer JOIN nation ON c_nationkey = n_nationkey
  JOIN region ON n_regionkey = r_regionkey GROUP BY ALL) GROUP BY r_name""")
def agg_region_map(t):
    places = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    rows = t.customer.join(places, F.col("c_nationkey") == F.col("n_nationkey"))
    out = agg.nested_counts(rows, "r_name", "n_name")
    return out.select("r_name", F.array_join(F.transform(
        F.array_sort(F.map_entries("names")), lambda e: F.concat_ws("=", e["key"], e["value"])), ",").alias("names"))


TYPE_DIM = "dim(rel) AS (VALUES " + ", ".join(f"('{r}')" for r in D.RELATIONS) + ")"


@query("agg_edge_types", "WITH " + D.EDGES + "," + TYPE_DIM + """
SELECT dim.rel, count(edges.src) AS n FROM dim LEFT JOIN edges ON edges.rel = dim.rel GROUP BY dim.rel""")
def agg_edge_types(t):
    return agg.edge_types(D.edges(t), "rel", D.RELATIONS)


@query("agg_density", "WITH " + D.EDGES + """
SELECT e.n AS edges, d.n AS nodes, round(e.n * 1000.0 / (d.n * (d.n - 1)), 6) AS per_mille
FROM (SELECT count(*) AS n FROM edges) e, (SELECT count(*) AS n FROM documents) d""")
def agg_density(t):
    return agg.density(D.edges(t), t.documents)


@query("agg_entity_usage", "WITH " + D.MENTIONS + """
SELECT b.item_id, count(DISTINCT m.doc_id) AS documents FROM benchmark b LEFT JOIN mentions m ON m.item_id = b.item_id GROUP BY 1""")
def agg_entity_usage(t):
    tags = link.tags(D.mentions(t), "doc_id", "item_id")
    return agg.entity_usage(tags, t.benchmark, "item_id", "doc_id")


@query("agg_coverage", WITH_DOCS + """
SELECT 'high_score' AS metric, count(*) AS total, count(*) FILTER (importance >= 4) AS covered,
       round(count(*) FILTER (importance >= 4) / count(*), 6) AS ratio FROM docs
UNION ALL SELECT 'labelled', count(*), count(l.doc_id), round(count(l.doc_id) / count(*), 6) FROM docs LEFT JOIN labels l ON l.doc_id = docs.doc_id""")
def agg_coverage(t):
    rows = D.docs(t).join(t.labels, "doc_id", "left")
    return agg.coverage(rows, {"high_score": F.col("importance") >= 4,
                               "labelled": F.col("quality").isNotNull()})


@query("opinion_consensus", WITH_STANCES + """
SELECT doc, aspect, polarity, count(DISTINCT source) AS sources, count(*) AS stances
FROM stances GROUP BY ALL HAVING count(DISTINCT source) >= 3""")
def opinion_consensus(t):
    return opinion.consensus(D.stances(t), "doc", "aspect", "polarity", "source")


@query("opinion_conflict", WITH_STANCES + """
SELECT doc, aspect, count(DISTINCT source) FILTER (polarity = 'purchase') AS pro,
       count(DISTINCT source) FILTER (polarity = 'error') AS con, count(DISTINCT source) AS sources
FROM stances WHERE polarity IN ('purchase', 'error') GROUP BY ALL
HAVING pro > 0 AND con > 0 AND count(DISTINCT source) >= 2""")
def opinion_conflict(t):
    return opinion.conflict(D.stances(t), ["doc", "aspect"], "polarity", "source", "purchase", "error")


@query("opinion_matrix", WITH_STANCES + """
SELECT doc, count(*) AS total, count(*) FILTER (polarity = 'click') AS click, count(*) FILTER (polarity = 'error') AS error,
       count(*) FILTER (polarity = 'purchase') AS purchase, count(*) FILTER (polarity = 'signup') AS signup,
       count(*) FILTER (polarity = 'view') AS "view", count(DISTINCT source) AS sources FROM stances GROUP BY doc""")
def opinion_matrix(t):
    return opinion.matrix(D.stances(t), "doc", "polarity", "source", TYPES)


@query("opinion_watch", WITH_STANCES + """
SELECT event_id, CASE WHEN polarity = 'view' THEN 'neutral' ELSE 'follow_up' END AS listing FROM stances
WHERE polarity = 'view' OR value > 200""")
def opinion_watch(t):
    return opinion.watch(D.stances(t), "polarity", "view", F.col("value") > 200).select("event_id", "listing")


@query("opinion_aspect_norm", """
WITH n AS (SELECT conv_id, CASE WHEN len(ws) = 0 THEN trim(text) ELSE array_to_string(ws, ' ') END AS k FROM (
  SELECT conv_id, text, list_sort(list_distinct(list_filter(regexp_split_to_array(lower(text), '[^\\p{L}\\p{N}]+'), lambda x: x <> ''))) AS ws
  FROM conversations))
SELECT md5(k) AS aspect_norm, count(*) AS n FROM n GROUP BY ALL""".replace("\\\\", "\\"))
def opinion_aspect_norm(t):
    rows = opinion.normalize_aspect(t.conversations.select(F.col("text").alias("aspect")))
    return rows.groupBy(F.md5("aspect_norm").alias("aspect_norm")).agg(F.count(F.lit(1)).alias("n"))


@query("cover_matrix", WITH_DOCS + """,
c AS (SELECT theme, nation, source, count(*) AS n FROM docs GROUP BY ALL)
SELECT nation, count(*) AS documents, count(*) FILTER (importance >= 4) AS high,
       (SELECT first(source ORDER BY n DESC, source) FROM (SELECT nation AS k, source, sum(n) AS n FROM c GROUP BY ALL) WHERE k = docs.nation) AS main_issuer,
       strftime(min(date), '%Y-%m-%d') AS first_date, strftime(max(date), '%Y-%m-%d') AS last_date FROM docs GROUP BY nation""")
def cover_matrix(t):
    out = cover.matrix(D.docs(t), "nation", "importance", "source", "date")
    return out.withColumns({c: D.day(c) for c in ("first_date", "last_date")})


@query("cover_summary", WITH_DOCS + """
SELECT lang || level || importance || action_class AS level, count(*) AS documents, count(DISTINCT nation) AS covered,
       (SELECT count(*) FROM nation) AS regions, round(100.0 * count(DISTINCT nation) / (SELECT count(*) FROM nation), 1) AS pct
FROM docs GROUP BY ALL""")
def cover_summary(t):
    """All documents; a level is one of a place, in a language, of an importance and a class."""
    regions = t.nation.select(F.col("n_nationkey").alias("nation"))
    rows = D.docs(t).withColumn("level", F.concat("lang", "level", "importance", "action_class"))
    return cover.summary(rows, "level", "nation", regions)


@query("cover_gaps", """
WITH present AS (SELECT DISTINCT p_partkey || ' ' || p_name AS title, s_nationkey FROM lineitem JOIN part ON l_partkey = p_partkey
                 JOIN supplier ON l_suppkey = s_suppkey),
grid AS (SELECT b.title, n.n_name, n.n_nationkey, r.r_name FROM (SELECT DISTINCT p_partkey || ' ' || p_name AS title FROM part) b, nation n
         JOIN region r ON n.n_regionkey = r.r_regionkey),
miss AS (SELECT g.* FROM grid g WHERE NOT EXISTS (SELECT 1 FROM present p WHERE p.title = g.title AND p.s_nationkey = g.n_nationkey))
SELECT title, r_name, count(*) AS n_missing, (SELECT count(*) FROM nation JOIN region ON n_regionkey = r_regionkey WHERE region.r_name = miss.r_name) AS n_regions,
       string_agg(n_name, ',' ORDER BY n_name) AS missing FROM miss GROUP BY ALL""")
def cover_gaps(t):
    """Nations that never shipped a product, by region of the world."""
    names = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        "n_nationkey", "n_name", "r_name")
    lots = t.lineitem.select("l_partkey", "l_suppkey")
    products = t.part.select("p_partkey", F.concat_ws(" ", "p_partkey", "p_name").alias("title"))
    pairs = lots.join(products, F.col("l_partkey") == F.col("p_partkey")).join(
        t.supplier.select("s_suppkey", "s_nationkey"), F.col("l_suppkey") == F.col("s_suppkey"))
    seen = pairs.select("title", "s_nationkey").distinct().join(
        names, F.col("s_nationkey") == F.col("n_nationkey"))
    out = cover.gaps(seen, "title", products, "n_name", names, "r_name")
    return out.withColumn("missing", F.array_join("missing", ",")).withColumns(
        {c: F.col(c).cast("long") for c in ("n_missing", "n_regions")})


@query("theme_stats", WITH_DOCS + """,
y AS (SELECT theme, year(date) AS yr, count(*) AS n FROM themed GROUP BY ALL)
SELECT theme, count(*) AS documents, count(*) FILTER (importance >= 4) AS high,
       round(100.0 * count(*) FILTER (importance >= 4) / count(*), 1) AS high_pct, round(avg(importance), 2) AS mean_importance,
       (SELECT CAST(first(yr ORDER BY n DESC, yr) AS BIGINT) FROM y WHERE y.theme = themed.theme) AS busiest_year,
       (SELECT string_agg(yr || '=' || n, ',' ORDER BY yr) FROM y WHERE y.theme = themed.theme) AS years
FROM themed GROUP BY theme""")
def theme_stats(t):
    out = theme.stats(D.themed(t), "theme", "date", "importance")
    return out.withColumn("busiest_year", F.col("busiest_year").cast("long")).withColumn(
        "years", F.array_join(F.transform(F.array_sort(F.map_entries("years")),
                                          lambda e: F.concat_ws("=", e["key"], e["value"])), ","))


@query("theme_bundle", WITH_DOCS + "," + D.EDGES + """,
ge AS (SELECT DISTINCT m.theme, e.src, e.dst, e.rel FROM edges e JOIN themed m ON m.doc_id = e.src OR m.doc_id = e.dst),
rk AS (SELECT *, row_number() OVER (PARTITION BY theme ORDER BY importance DESC, doc_id) AS r FROM themed)
SELECT theme, count(*) AS documents, count(DISTINCT level) AS levels, count(DISTINCT (level, nation)) AS regions,
       (SELECT count(*) FROM ge WHERE ge.theme = themed.theme) AS relations,
       (SELECT string_agg(doc_id || ':' || importance, ',' ORDER BY r) FROM rk WHERE rk.theme = themed.theme AND r <= 5) AS top,
       (SELECT max(n) FROM (SELECT theme AS k, source, count(*) AS n FROM themed GROUP BY ALL) WHERE k = themed.theme) AS top_issuer_n
FROM themed GROUP BY theme""")
def theme_bundle(t):
    from docgraph.operators import graph

    rows = D.themed(t)
    relations = graph.subgraph(D.edges(t), rows.select("theme", "doc_id"), "theme", "doc_id")
    out = theme.bundle(rows, relations, "theme", "doc_id", "level", "nation", "source", "importance")
    return out.select(
        "theme", "documents", F.size("region_distribution").cast("long").alias("levels"),
        F.aggregate(F.map_values("region_distribution"), F.lit(0).cast("long"),
                    lambda a, m: a + F.size(m)).alias("regions"),
        "relations", F.array_join(F.transform("top", lambda s: F.concat_ws(":", s["doc_id"], s["importance"])), ",").alias("top"),
        F.array_max(F.map_values("top_issuers")).alias("top_issuer_n"))


@query("theme_bundle_pages", WITH_DOCS + """
SELECT theme, (nth - 1) // 50 AS page, count(*) AS documents, CAST(sum(doc_id) AS BIGINT) AS ids, max(doc_id) AS last
FROM (SELECT theme, doc_id, row_number() OVER (PARTITION BY theme ORDER BY doc_id) AS nth FROM themed) GROUP BY ALL""")
def theme_bundle_pages(t):
    """Documents of each theme in nested pages of 50, in order."""
    rows = D.themed(t)
    policies, _ = theme.bundle_pages(rows, D.edges(t).withColumn("theme", F.col("src") % 13), "theme",
                                     "doc_id", ["date", "importance"], 50)
    flat = policies.select("theme", "page", F.explode("entries").alias("e"))
    return flat.groupBy("theme", "page").agg(F.count(F.lit(1)).alias("documents"), F.sum("e.doc_id").alias("ids"),
                                             F.max("e.doc_id").alias("last"))


@query("theme_relation_pages", "WITH " + D.EDGES + """
SELECT src % 13 AS theme, (nth - 1) // 50 AS page, count(*) AS relations, CAST(sum(src) AS BIGINT) AS sources, CAST(sum(dst) AS BIGINT) AS targets
FROM (SELECT *, row_number() OVER (PARTITION BY src % 13 ORDER BY src, dst, rel) AS nth FROM edges) GROUP BY ALL""")
def theme_relation_pages(t):
    """The relations of each theme's documents in nested pages of 50, in order."""
    _, relations = theme.bundle_pages(D.themed(t), D.edges(t).withColumn("theme", F.col("src") % 13), "theme",
                                      "doc_id", ["date"], 50)
    flat = relations.select("theme", "page", F.explode("entries").alias("e"))
    return flat.groupBy("theme", "page").agg(F.count(F.lit(1)).alias("relations"), F.sum("e.src").alias("sources"),
                                             F.sum("e.dst").alias("targets"))


@query("backlog_build", """
WITH e AS (SELECT 'k' || CAST(json_extract(props, '$.k') AS BIGINT) AS title, 't' || event_id % 3 AS kind, ts, user_id, event_id
           FROM events WHERE event_type = 'error'),
kinds AS (SELECT title, first(kind ORDER BY n DESC, kind) AS linkage_type FROM (
  SELECT title, kind, count(*) AS n FROM e GROUP BY ALL) GROUP BY title)
SELECT title, strftime(min(ts), '%Y-%m-%d %H:%M:%S.%f') AS first_seen, strftime(max(ts), '%Y-%m-%d %H:%M:%S.%f') AS last_seen,
       count(DISTINCT user_id) AS ref_count, count(*) AS sightings, any_value(linkage_type) AS linkage_type,
       first('value ' || event_id ORDER BY ts, event_id) AS evidence_sample
FROM e JOIN kinds USING (title) GROUP BY title""")
def backlog_build(t):
    rows = t.events.filter("event_type = 'error'").select(
        F.concat(F.lit("k"), F.get_json_object("props", "$.k")).alias("title"), "user_id", "ts", "event_id",
        F.concat(F.lit("t"), F.col("event_id") % 3).alias("kind"), F.concat(F.lit("value "), "event_id").alias("evidence"))
    out = backlog.build(rows, "title", "user_id", "ts", "kind", "evidence", ["event_id"])
    return out.withColumns({c: D.stamp(c) for c in ("first_seen", "last_seen")})


@query("agg_sources", """
SELECT event_type, count(DISTINCT user_id) AS sources FROM events GROUP BY event_type""")
def agg_sources(t):
    return agg.sources(t.events, "event_type", "user_id")


@query("agg_sources_approx")
def agg_sources_approx(t):
    return agg.sources(t.events, "event_type", "user_id", approx=True)


@query("agg_sources_merged", """
SELECT 'all' AS span, event_type, true AS within FROM events GROUP BY ALL
UNION ALL SELECT strftime(ts, '%Y-%m'), event_type, true FROM events GROUP BY ALL""")
def agg_sources_merged(t):
    """Sketches per type and day, stored and united over months and in all, against exact counts:
    whether each estimate lies within three standard errors (1.6 % each) and one of rounding."""
    rows = t.events.withColumn("day", F.to_date("ts"))
    days = storage.stored(agg.sketched(rows, ["event_type", "day"], "user_id"), "sketches")

    def spans(df):
        span = F.explode(F.array(F.lit("all"), F.date_format("day", "yyyy-MM")))
        return df.withColumn("span", span)

    exact = spans(rows).groupBy("span", "event_type").agg(F.count_distinct("user_id").alias("n"))
    both = agg.united(spans(days), ["span", "event_type"]).join(exact, ["span", "event_type"])
    return both.select("span", "event_type", (F.abs(F.col("sources") - F.col("n")) <= 0.048 * F.col("n") + 1).alias("within"))


@query("report_global_index", WITH_DOCS + "," + D.EDGES + "," + D.STANCES + """
SELECT 'documents' AS metric, CAST(count(*) AS DOUBLE) AS value FROM docs
UNION ALL SELECT 'top_importance', count(*) FILTER (importance = 5) FROM docs
UNION ALL SELECT 'issuers', count(DISTINCT source) FROM docs
UNION ALL SELECT 'excluded', count(*) FILTER (toxic = 1) FROM labels
UNION ALL SELECT 'labelled', count(*) FROM labels
UNION ALL SELECT 'commentaries', count(*) FROM conversations
UNION ALL SELECT 'entities', count(*) FROM benchmark
UNION ALL SELECT 'pages', count(*) FROM pages
UNION ALL SELECT 'hosts', count(DISTINCT lower(regexp_extract(url, '^[a-z]+://([^/?#:]+)', 1))) FROM pages
UNION ALL SELECT 'edges', count(*) FROM edges
UNION ALL SELECT 'conflict_edges', count(*) FILTER (rel = 'conflicts_with') FROM edges
UNION ALL SELECT 'stances', count(*) FROM stances
UNION ALL SELECT 'stance_days', count(DISTINCT doc) FROM stances""")
def report_global_index(t):
    from docgraph.functions import text

    n = F.count(F.lit(1))
    return report.global_index({
        "documents": (D.docs(t), {"documents": n, "top_importance": F.count_if(F.col("importance") == 5),
                                  "issuers": F.count_distinct("source")}),
        "labels": (t.labels, {"excluded": F.count_if(F.col("toxic") == 1), "labelled": n}),
        "conversations": (t.conversations, {"commentaries": n}),
        "registry": (t.benchmark, {"entities": n}),
        "pages": (t.pages, {"pages": n, "hosts": F.count_distinct(text.host("url"))}),
        "edges": (D.edges(t), {"edges": n, "conflict_edges": F.count_if(F.col("rel") == "conflicts_with")}),
        "stances": (D.stances(t), {"stances": n, "stance_days": F.count_distinct("doc")}),
    })


@query("set_union_signals", """
SELECT source_kind, count(*) AS n, count(role) AS with_role, count(region) AS with_region, round(sum(value), 2) AS total FROM (
  SELECT 'commentary' AS source_kind, role, NULL AS region, NULL AS value FROM conversations
  UNION ALL SELECT 'market_intel', NULL, event_type, value FROM events) GROUP BY source_kind""")
def set_union_signals(t):
    rows = signals.union({
        "commentary": t.conversations.select(F.col("conv_id").alias("id"), "role"),
        "market_intel": t.events.select(F.col("event_id").alias("id"), F.col("event_type").alias("region"), "value")})
    return rows.groupBy("source_kind").agg(
        F.count(F.lit(1)).alias("n"), F.count("role").alias("with_role"),
        F.count("region").alias("with_region"), F.round(F.sum("value"), 2).alias("total"))


@query("set_intersect", """
SELECT lang, source FROM documents d JOIN labels l ON d.doc_id = l.doc_id WHERE toxic = 1
INTERSECT SELECT lang, source FROM documents d JOIN labels l ON d.doc_id = l.doc_id WHERE quality = 0""")
def set_intersect(t):
    rows = t.documents.select("doc_id", "lang", "source").join(t.labels, "doc_id")
    return rows.filter("toxic = 1").select("lang", "source").intersect(
        rows.filter("quality = 0").select("lang", "source"))


@query("theme_overlap", WITH_DOCS + """
SELECT least(n_chars % 13, doc_id % 13) AS a, greatest(n_chars % 13, doc_id % 13) AS b, count(*) AS documents
FROM documents WHERE n_chars % 13 <> doc_id % 13 GROUP BY ALL""")
def theme_overlap(t):
    return theme.overlap(D.theme_sets(t), "themes")


@query("nested_explode", WITH_DOCS + """
SELECT theme, CAST(nation AS BIGINT) AS region_nation, CAST(level AS BIGINT) AS region_level, count(*) AS n FROM themed GROUP BY ALL""")
def nested_explode(t):
    rows = D.docs(t).select(F.struct("nation", "level").alias("region"), F.array_distinct(
        F.array("theme", F.col("n_chars") % 13)).alias("theme"))
    flat = nested.flatten(rows, "region", "theme")
    return flat.groupBy("theme", "region_nation", "region_level").agg(F.count(F.lit(1)).alias("n"))


@query("nested_unpivot", "WITH " + D.SCORES + """
SELECT doc_id, dimension, score FROM (UNPIVOT (SELECT doc_id, D1, D2, D3, D4, D5, D6 FROM scores) ON D1, D2, D3, D4, D5, D6 INTO NAME dimension VALUE score)""")
def nested_unpivot(t):
    wide = D.scores(t).select("doc_id", *D.DIMS)
    again = nested.scores_wide(nested.scores_long(wide, "doc_id", D.DIMS), "doc_id", D.DIMS)
    return nested.scores_long(again, "doc_id", D.DIMS)


@query("nested_map_keys", """
SELECT line, count(*) AS n, count(*) FILTER (line NOT IN ('en', 'fr')) AS not_allowed FROM (
  SELECT lang AS line FROM documents UNION ALL SELECT source FROM documents) GROUP BY line""")
def nested_map_keys(t):
    rows = t.documents.select("doc_id", F.create_map("lang", F.col("source"), "source", F.col("lang")).alias("impact"))
    lines, extra = nested.impact(rows, "doc_id", "impact", ["en", "fr"])
    bad = extra.groupBy("line").agg(F.count(F.lit(1)).alias("not_allowed"))
    return lines.groupBy("line").agg(F.count(F.lit(1)).alias("n")).join(bad, "line", "left").fillna(0, ["not_allowed"])


@query("nested_array_intersect", "WITH " + D.EDGES + """,
s AS (SELECT doc_id, list_distinct([doc_id % 13, n_chars % 13]) AS themes FROM documents)
SELECT e.src, e.dst, len(list_intersect(a.themes, b.themes)) AS n,
       array_to_string(list_sort(list_intersect(a.themes, b.themes)), ',') AS shared
FROM edges e JOIN s a ON a.doc_id = e.src JOIN s b ON b.doc_id = e.dst""")
def nested_array_intersect(t):
    out = nested.shared(D.edges(t).select("src", "dst"), D.theme_sets(t), "doc_id", "themes")
    return out.select("src", "dst", F.size("shared").cast("long").alias("n"),
                      F.array_join(F.col("shared").cast("array<string>"), ",").alias("shared"))
