"""The document graph."""

from pyspark.sql import functions as F

from docgraph.catalog import derive as D
from docgraph.catalog.base import query
from docgraph.operators import graph

WITH_EDGES = "WITH " + D.EDGES
REVERSE = "CASE rel " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in D.fixed.REVERSE_NAMES.items()) + " END"


@query("graph_reverse", WITH_EDGES + f"""
SELECT node, direction, section, count(*) AS n, string_agg(CAST(other AS VARCHAR), ',' ORDER BY other) AS others FROM (
  SELECT src AS node, 'out' AS direction, rel AS section, dst AS other FROM edges
  UNION ALL SELECT dst, 'in', {REVERSE}, src FROM edges) GROUP BY ALL""")
def graph_reverse(t):
    out = graph.pages(graph.reverse(D.edges(t)), 1000)
    return out.select("node", "direction", "section", "n",
                      F.array_join(F.col("entries").cast("array<string>"), ",").alias("others"))


@query("graph_reverse_pages", WITH_EDGES + """,
v AS (SELECT rel AS node, src AS other, (row_number() OVER (PARTITION BY rel ORDER BY src) - 1) // 50 AS page FROM edges)
SELECT node, page, count(*) AS n, CAST(min(other) AS BIGINT) AS first, CAST(max(other) AS BIGINT) AS last
FROM v GROUP BY ALL""")
def graph_reverse_pages(t):
    """Hub nodes (the relation names) listed in order, in pages of 50 entries."""
    views = D.edges(t).select(F.col("rel").alias("node"), F.lit("all").alias("direction"),
                              F.lit("members").alias("section"), F.col("src").alias("other"))
    out = graph.pages(views, 50)
    return out.select("node", "page", "n", F.array_min("entries").alias("first"),
                      F.array_max("entries").alias("last"))


@query("graph_degree", WITH_EDGES + """
SELECT node, CAST(sum(o) AS BIGINT) AS out_degree, CAST(sum(i) AS BIGINT) AS in_degree,
       CAST(sum(o) FILTER (rel = 'references') AS BIGINT) AS out_references,
       CAST(sum(i) FILTER (rel = 'references') AS BIGINT) AS in_references FROM (
  SELECT src AS node, rel, 1 AS o, 0 AS i FROM edges UNION ALL SELECT dst, rel, 0, 1 FROM edges) GROUP BY node""")
def graph_degree(t):
    out = graph.degree(D.edges(t), ["references"])
    # No edge of the relation is null in the SQL form and zero here.
    seen = (F.col("out_references") + F.col("in_references")) > 0
    return out.withColumns({c: F.when(seen, F.col(c)) for c in ("out_references", "in_references")})


@query("graph_mirror_check", WITH_EDGES + f"""
SELECT src, dst, rel, CAST(-1 AS BIGINT) AS surplus FROM edges WHERE rel = 'extends' AND dst > src""")
def graph_mirror_check(t):
    """The index without the inbound entries of forward 'extends' edges: just these are reported."""
    views = graph.reverse(D.edges(t))
    lost = (F.col("direction") == "in") & (F.col("section") == "extended_by") & (F.col("node") > F.col("other"))
    return graph.mirror(views.filter(~lost))


@query("graph_chain", "WITH RECURSIVE " + D.EDGES.lstrip() + """,
e AS (SELECT DISTINCT src, dst FROM edges WHERE src <> dst),
walk(src, dst, depth) AS (SELECT src, dst, 1 FROM e
  UNION SELECT w.src, e.dst, w.depth + 1 FROM walk w JOIN e ON e.src = w.dst WHERE w.src <> e.dst AND w.depth < 64)
SELECT src, dst, CAST(min(depth) AS BIGINT) AS depth FROM walk GROUP BY src, dst""")
def graph_chain(t):
    """What every document leads to, along relations of all kinds."""
    edges = D.edges(t)
    return graph.chain(edges, edges.select("src"), None)


@query("graph_reach", "WITH RECURSIVE " + D.EDGES.lstrip() + """,
e AS (SELECT DISTINCT src, dst FROM edges WHERE src <> dst),
walk(src, dst, depth) AS (SELECT src, dst, 1 FROM e WHERE src IN (SELECT doc_id FROM labels WHERE quality = 1)
  UNION SELECT w.src, e.dst, w.depth + 1 FROM walk w JOIN e ON e.src = w.dst WHERE w.src <> e.dst AND w.depth < 64)
SELECT src, dst, CAST(min(depth) AS BIGINT) AS depth FROM walk GROUP BY src, dst""")
def graph_reach(t):
    """What documents of good quality lead to, along relations of all kinds."""
    starts = t.labels.filter("quality = 1").select(F.col("doc_id").alias("src"))
    return graph.chain(D.edges(t), starts, None)


@query("graph_lineage", "WITH RECURSIVE " + D.EDGES.lstrip() + """,
up AS (SELECT src, min(dst) AS dst FROM edges WHERE src <> dst GROUP BY src),
walk(node, root, depth) AS (SELECT src, dst, 1 FROM up
  UNION ALL SELECT w.node, u.dst, w.depth + 1 FROM walk w JOIN up u ON u.src = w.root)
SELECT node, arg_max(root, depth) AS root, CAST(max(depth) AS BIGINT) AS depth, false AS cyclic FROM walk GROUP BY node""")
def graph_lineage(t):
    return graph.lineage(D.edges(t), None)


@query("graph_isolated", WITH_EDGES + """
SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT src FROM edges WHERE rel IN ('iterates', 'extends'))
AND doc_id NOT IN (SELECT dst FROM edges WHERE rel IN ('iterates', 'extends'))""")
def graph_isolated(t):
    some = D.edges(t).filter(F.col("rel").isin("iterates", "extends"))
    return graph.isolated(t.documents.select("doc_id"), "doc_id", some)


@query("graph_most_cited", WITH_EDGES + """
SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY rel ORDER BY citations DESC, node) AS rank FROM (
  SELECT rel, dst AS node, count(*) AS citations FROM edges GROUP BY ALL)) WHERE rank <= 5""")
def graph_most_cited(t):
    return graph.most_cited(D.edges(t), 5)


@query("graph_subgraph", "WITH " + D.DOCS + "," + D.EDGES + """
SELECT theme, rel, count(*) AS edges FROM (
  SELECT DISTINCT m.theme, e.src, e.dst, e.rel FROM edges e JOIN themed m ON m.doc_id = e.src
  UNION SELECT m.theme, e.src, e.dst, e.rel FROM edges e JOIN themed m ON m.doc_id = e.dst) GROUP BY ALL""")
def graph_subgraph(t):
    members = D.themed(t).select("theme", "doc_id")
    out = graph.subgraph(D.edges(t), members, "theme", "doc_id")
    return out.groupBy("theme", "rel").agg(F.count(F.lit(1)).alias("edges"))
