"""Linking documents with registries and with each other."""

from pyspark.sql import functions as F

from docgraph.catalog import derive as D
from docgraph.catalog.base import query
from docgraph.functions import text
from docgraph.operators import link, rel
from docgraph.plans import storage
from docgraph.sources import ingest, sink


@query("link_issuer_misses", """
WITH parts AS (SELECT conv_id * 1000 + turn AS id, trim(unnest(string_split(text, ','))) AS name FROM conversations),
misses AS (SELECT * FROM parts WHERE name <> '' AND name <> '~' AND name NOT IN (
  SELECT trim(unnest(string_split(text, ','))) FROM benchmark)),
ranked AS (SELECT *, row_number() OVER (PARTITION BY name ORDER BY id) AS r FROM (SELECT DISTINCT id, name FROM misses))
SELECT name, (SELECT count(*) FROM misses m WHERE m.name = ranked.name) AS n,
       string_agg(CAST(id AS VARCHAR), ',' ORDER BY id) AS documents FROM ranked WHERE r <= 20 GROUP BY name""")
def link_issuer_misses(t):
    """Comma-separated parts of turns that are no part of a benchmark text."""
    known = t.benchmark.select(F.explode(F.split("text", ",")).alias("alias")).select(
        text.blank_to_null("alias").alias("alias")).distinct()
    rows = t.conversations.select((F.col("conv_id") * 1000 + F.col("turn")).alias("id"), "text")
    out = link.issuer_misses(rows, "id", F.split("text", ","), known)
    return out.withColumn("documents", F.array_join(F.col("documents").cast("array<string>"), ","))


@query("link_entities", "WITH " + D.MENTIONS + """
SELECT doc_id, item_id, CAST(sum(evidence_count) AS BIGINT) AS hits FROM mentions GROUP BY ALL""")
def link_entities(t):
    return link.tags(D.mentions(t), "doc_id", "item_id")


@query("link_themes", "WITH " + D.MENTIONS + """,
tags AS (SELECT doc_id, item_id, CAST(sum(evidence_count) AS BIGINT) AS hits FROM mentions GROUP BY ALL)
SELECT doc_id, first(item_id ORDER BY hits DESC, item_id) AS "primary", count(*) AS n_themes,
       CAST(sum(hits) AS BIGINT) AS hits FROM tags GROUP BY doc_id""")
def link_themes(t):
    return link.primary(link.tags(D.mentions(t), "doc_id", "item_id"), "doc_id", "item_id")


def refs(t, repeal=rel.REPEAL):
    items = t.benchmark.select("item_id", F.col("item_id").alias("dst"))
    return rel.references(D.mentions(t), "doc_id", "item_id", items, "dst", repeal)


@query("rel_references", "WITH " + D.REFS + """
SELECT doc_id, item_id, evidence_count, pos, evidence, location, 'references' AS rel FROM refs""")
def rel_references(t):
    return refs(t).select("doc_id", "item_id", "evidence_count", "pos", "evidence", "location", "rel")


@query("rel_occurrences", "WITH " + D.HITS + """
SELECT doc_id, item_id, alias, nth, pos, snippet, location FROM occurrences""")
def rel_occurrences(t):
    return link.occurrences(D.mentions(t), "doc_id", "item_id")


@query("rel_supersedes", "WITH " + D.REFS + r"""
SELECT DISTINCT doc_id, item_id, 'supersedes' AS rel FROM occurrences WHERE regexp_matches(snippet, '[0-9#%$&]|\n')""")
def rel_supersedes(t):
    """A digit, a symbol or a line break next to the hit stands for the repeal verb."""
    return rel.supersedes(refs(t, r"[0-9#%$&]|\n")).select("doc_id", "item_id", "rel")


@query("rel_cites_basis", "WITH " + D.REFS + """
SELECT r.doc_id, r.item_id, CASE l.quality WHEN 1 THEN 'basis' WHEN 0 THEN 'context_mention' END AS semantic
FROM refs r LEFT JOIN labels l ON l.doc_id = r.doc_id WHERE r.location = 'opening'""")
def rel_cites_basis(t):
    """The label of a document stands for the verdict on each of its edges."""
    edges = refs(t)
    label = t.labels.select("doc_id", F.when(F.col("quality") == 1, "basis").otherwise(
        "context_mention").alias("semantic"))
    verdicts = edges.select("doc_id", "item_id").join(label, "doc_id")
    return rel.cites_basis(edges, verdicts, "doc_id", "item_id").select("doc_id", "item_id", "semantic")


@query("rel_clarifies", r"""
WITH titles AS (SELECT p_partkey, p_brand, regexp_extract(p_name, '(\S+)$', 1) AS stem,
                       regexp_matches(p_name, '^(small|hot|blue) ') AS detail FROM part),
bases AS (SELECT p_brand, stem, min(p_partkey) AS dst, count(*) AS candidates FROM titles WHERE NOT detail GROUP BY ALL)
SELECT t.p_partkey AS src, b.dst, t.p_brand, t.stem, b.candidates
FROM titles t JOIN bases b ON t.p_brand = b.p_brand AND t.stem = b.stem WHERE t.detail""")
def rel_clarifies(t):
    return rel.clarifies(t.part, "p_partkey", "p_brand", F.regexp_extract("p_name", r"(\S+)$", 1),
                         F.col("p_name").rlike("^(small|hot|blue) "))


FIRST_LINE = """
titled AS (
  SELECT doc_id, lang, split_part(text, chr(10), 1) AS title, date FROM (
    SELECT d.doc_id, d.lang, d.text, DATE '2020-01-01' + CAST(d.doc_id * 37 % 2000 AS INTEGER) AS date FROM documents d)),
stemmed AS (SELECT *, lower(regexp_replace(title, '[^\\p{L}\\p{N}]+', '', 'g')) AS stem FROM titled)""".replace("\\\\", "\\")


def stem_of(title):
    """Digest of the bare title: a short key, however long the line is."""
    return F.md5(F.lower(F.regexp_replace(title, r"[^\p{L}\p{N}]+", "")))


def titled(t):
    """The first line of a document serves as its title."""
    date = F.date_add(F.lit("2020-01-01").cast("date"), (F.col("doc_id") * 37 % 2000).cast("int"))
    title = F.split_part("text", F.lit("\n"), F.lit(1))
    return t.texts.select("doc_id", "lang", title.alias("title"), date.alias("date"), stem_of(title).alias("stem"))


@query("rel_iterates", "WITH " + FIRST_LINE + """,
chained AS (SELECT *, lag(doc_id) OVER w AS dst, lag(title) OVER w AS before, lag(date) OVER w AS dst_date
            FROM stemmed WINDOW w AS (PARTITION BY lang, stem ORDER BY date, doc_id))
SELECT doc_id AS src, dst, strftime(date, '%Y-%m-%d') AS src_date, strftime(dst_date, '%Y-%m-%d') AS dst_date,
       levenshtein(title, before) AS distance
FROM chained WHERE dst IS NOT NULL AND levenshtein(title, before) <= 5""")
def rel_iterates(t):
    out = rel.iterates(titled(t), "doc_id", ["lang", "stem"], "title", "date", 5)
    return out.select("src", "dst", D.day("src_date").alias("src_date"),
                      D.day("dst_date").alias("dst_date"), F.col("distance").cast("long").alias("distance"))


@query("rel_extends", "WITH " + D.DOCS + """,
c AS (SELECT w.theme, w.doc_id AS src, w.date AS src_date, n.doc_id AS dst, n.date AS dst_date
      FROM themed w JOIN themed n ON w.theme = n.theme AND n.level > w.level AND n.date < w.date)
SELECT theme, src, strftime(src_date, '%Y-%m-%d') AS src_date, arg_max(dst, (dst_date, dst)) AS dst,
       strftime(max(dst_date), '%Y-%m-%d') AS dst_date, count(*) AS earlier
FROM c GROUP BY theme, src, src_date""")
def rel_extends(t):
    out = rel.extends(D.themed(t), "doc_id", "theme", "level", "date")
    return out.select("theme", "src", "dst", D.day("src_date").alias("src_date"),
                      D.day("dst_date").alias("dst_date"), "earlier")


@query("rel_aligns_shared", "WITH " + D.DOCS + """
SELECT a.doc_id AS src, a.theme, a.source, min(b.doc_id) AS dst, count(*) AS aligned
FROM themed a JOIN themed b ON a.theme = b.theme AND a.source <> b.source GROUP BY ALL""")
def rel_aligns_shared(t):
    return rel.aligns(D.themed(t), "doc_id", "theme", "source").select(
        "src", "theme", "source", "dst", "aligned")


@query("rel_aligns_cosine", """
WITH x AS (SELECT vec_id, label, unnest(embedding)::DOUBLE AS v, unnest(range(64)) AS d FROM embeddings),
m AS (SELECT label, d, avg(v) AS c FROM x GROUP BY ALL),
s AS (SELECT vec_id, label, sum(v * c) / (sqrt(sum(v * v)) * sqrt(sum(c * c))) AS cosine
      FROM x JOIN m USING (label, d) GROUP BY ALL)
SELECT vec_id, label, round(cosine, 6) AS cosine FROM s WHERE cosine >= 0.15""")
def rel_aligns_cosine(t):
    out = rel.aligns_centroid(t.embeddings, "vec_id", "label", "embedding", 0.15)
    return out.withColumn("cosine", F.round("cosine", 6))


@query("rel_conflict_pairs", "WITH " + D.DOCS + """,
top AS (SELECT theme, doc_id, date, action_class FROM themed WHERE importance >= 4)
SELECT a.theme, a.doc_id AS src, arg_max(b.doc_id, (b.date, b.doc_id)) AS dst, a.action_class AS src_stance,
       arg_max(b.action_class, (b.date, b.doc_id)) AS dst_stance, count(*) AS earlier
FROM top a JOIN top b ON a.theme = b.theme AND a.action_class <> b.action_class AND (b.date, b.doc_id) < (a.date, a.doc_id)
GROUP BY a.theme, a.doc_id, a.action_class""")
def rel_conflict_pairs(t):
    return rel.conflict_pairs(D.themed(t), "doc_id", "theme", "date", "importance", "action_class")


@query("rel_derives_band", """
WITH o AS (SELECT o_orderkey, o_custkey, CAST(o_orderdate AS DATE) AS day FROM orders),
band AS (SELECT a.o_orderkey, count(*) AS origins, arg_min(b.o_orderkey, (b.day, b.o_orderkey)) AS first_origin,
                arg_max(b.o_orderkey, (b.day, b.o_orderkey)) AS last_origin
         FROM o a JOIN o b ON a.o_custkey = b.o_custkey AND a.day - b.day BETWEEN 180 AND 365 GROUP BY 1)
SELECT o.o_orderkey AS src, o_custkey, coalesce(origins, 0) AS origins, first_origin, last_origin,
       count(*) OVER (PARTITION BY o_custkey, date_trunc('month', day)) - 1 AS parallel
FROM o LEFT JOIN band ON band.o_orderkey = o.o_orderkey""")
def rel_derives_band(t):
    rows = t.orders.select("o_orderkey", "o_custkey", "o_orderdate")
    return rel.derives(rows, rows, "o_orderkey", "o_custkey", "o_orderdate")


@query("rel_derives_levels", "WITH " + D.DOCS + """,
nat AS (SELECT theme, doc_id, date FROM themed WHERE level = 0),
loc AS (SELECT theme, 'L' || doc_id AS src, date FROM themed WHERE level > 0),
band AS (SELECT l.src, l.theme, count(*) AS origins, min('N' || n.doc_id) FILTER (n.date = early) AS first_origin
         FROM (SELECT l.*, min(n.date) AS early FROM loc l JOIN nat n ON n.theme = l.theme AND l.date - n.date BETWEEN 180 AND 365 GROUP BY ALL) l
         JOIN nat n ON n.theme = l.theme AND l.date - n.date BETWEEN 180 AND 365 GROUP BY ALL),
months AS (SELECT theme, date_trunc('month', date) AS m, count(*) AS n FROM nat GROUP BY ALL)
SELECT l.src, l.theme, coalesce(b.origins, 0) AS origins, b.first_origin, coalesce(m.n, 0) AS parallel
FROM loc l LEFT JOIN band b ON b.src = l.src AND b.theme = l.theme
LEFT JOIN months m ON m.theme = l.theme AND m.m = date_trunc('month', l.date)""")
def rel_derives_levels(t):
    """Local documents against national ones of the theme, with ids that are texts."""
    rows = D.themed(t).withColumn("doc_id", F.concat(F.when(F.col("level") == 0, "N").otherwise("L"), "doc_id"))
    out = rel.derives(rows.filter("level > 0"), rows.filter("level = 0"), "doc_id", "theme", "date")
    return out.drop("last_origin")


@query("rel_iterates_text_ids", "WITH " + FIRST_LINE + """,
named AS (SELECT 'P_' || strftime(date, '%Y') || '_' || upper(lang) || '_' || doc_id AS id, * FROM stemmed),
chained AS (SELECT *, lag(id) OVER w AS dst, lag(title) OVER w AS before
            FROM named WINDOW w AS (PARTITION BY lang, stem ORDER BY date, id))
SELECT id AS src, dst, levenshtein(title, before) AS distance
FROM chained WHERE dst IS NOT NULL AND levenshtein(title, before) <= 5""")
def rel_iterates_text_ids(t):
    """The same under ids of the form P_year_issuer_number."""
    rows = titled(t).withColumn("doc_id", F.concat_ws("_", F.lit("P"), F.year("date"), F.upper("lang"), "doc_id"))
    out = rel.iterates(rows, "doc_id", ["lang", "stem"], "title", "date", 5)
    return out.select("src", "dst", F.col("distance").cast("long").alias("distance"))


@query("rel_number_citations", """
WITH own AS (SELECT doc_id, '机关〔' || (2000 + doc_id % 27) || '〕' || (doc_id + 1) || '号' AS mark, length(text) AS n FROM documents)
SELECT a.doc_id, b.doc_id AS dst, b.mark, CAST(2 AS BIGINT) AS evidence_count, a.n + 2 AS pos, a.doc_id % 2 = 0 AS repeals
FROM own a JOIN own b ON b.doc_id = a.doc_id // 3
UNION ALL SELECT doc_id, NULL, '机关〔1999〕' || (doc_id + 1) || '号', 1, 2 * n + 111 + 2 * length(CAST(doc_id // 3 + 1 AS VARCHAR)), false FROM own""")
def rel_number_citations(t):
    """Every text cites the number of another one twice, in two spellings and the second time with a
    repeal in every other text, and one that nobody has; numbers are resolved to documents."""
    id_, cited = F.col("doc_id"), F.floor(F.col("doc_id") / 3)
    plain = F.regexp_replace("text", r"[\s\S]", "x")  # as long as the text, without numbers of its own
    body = F.concat(
        plain, F.format_string(" 依据机关 [%d] %d 号印发", 2000 + cited % 27, cited + 1), plain, F.lit("。" + "y" * 40),
        F.when(id_ % 2 == 0, "废止").otherwise("参照"), F.format_string("机关〔%d〕%d号。", 2000 + cited % 27, cited + 1),
        F.format_string("z" * 40 + "见机关〔1999〕%d号", id_ + 1))
    rows = link.numbers(t.texts.select("doc_id", body.alias("text")), "doc_id", "text", ["机关"])
    own = t.documents.select(F.format_string("机关〔%d〕%d号", 2000 + id_ % 27, id_ + 1).alias("mark"), F.col("doc_id").alias("dst"))
    out = rel.references(rows, "doc_id", "mark", own, "dst")
    return out.select("doc_id", "dst", "mark", "evidence_count", "pos", "repeals")


@query("rel_edge_table", "WITH " + D.HITS + "," + FIRST_LINE + """,
cites AS (SELECT doc_id, item_id, first(snippet ORDER BY pos, snippet) AS evidence FROM mentions GROUP BY ALL),
chained AS (SELECT title, lag(doc_id) OVER w AS dst, lag(title) OVER w AS before
            FROM stemmed WINDOW w AS (PARTITION BY lang, stem ORDER BY date, doc_id)),
gone AS (SELECT DISTINCT doc_id, item_id FROM occurrences WHERE regexp_matches(snippet, '[0-9#%$&]|\n'))
SELECT 'references' AS rel, count(*) AS n, count(evidence) AS with_evidence, 0.9 AS confidence, 'dictionary' AS source FROM cites
UNION ALL SELECT 'supersedes', count(*), count(*), 0.7, 'dictionary' FROM gone
UNION ALL SELECT 'iterates', count(*), 0, 0.8, 'title' FROM chained WHERE dst IS NOT NULL AND levenshtein(title, before) <= 5""")
def rel_edge_table(t):
    """Three relations as one table, written by relation and read back."""
    cites = refs(t, r"[0-9#%$&]|\n")
    cites = storage.stored(cites, "cites")
    chains = rel.iterates(titled(t), "doc_id", ["lang", "stem"], "title", "date")
    found = {"references": cites.withColumnRenamed("doc_id", "src"),
             "supersedes": rel.supersedes(cites).withColumnRenamed("doc_id", "src"), "iterates": chains}
    table = rel.edge_table(found, confidence={"references": 0.9, "supersedes": 0.7, "iterates": 0.8},
                           source={"references": "dictionary", "supersedes": "dictionary", "iterates": "title"})
    path = storage.work_path(t.spark, "edges")
    sink.rewrite(table, path, ["rel"])
    return t.spark.read.schema(table.schema).parquet(path).groupBy("rel", "confidence", "source").agg(
        F.count(F.lit(1)).alias("n"), F.count("evidence").alias("with_evidence"))


@query("rel_linkage_class", """
SELECT CASE polarity WHEN 'purchase' THEN 'direct' WHEN 'signup' THEN 'refined' WHEN 'click' THEN 'same direction' END AS evidence_class,
       count(*) AS n FROM (SELECT event_type AS polarity FROM events) GROUP BY 1""")
def rel_linkage_class(t):
    rows = rel.linkage_class(t.events.select("event_type"), "event_type",
                             {"purchase": "direct", "signup": "refined", "click": "same direction"})
    return rows.groupBy("evidence_class").agg(F.count(F.lit(1)).alias("n"))


TITLES = """
titles AS (SELECT DISTINCT p_name || ' ' || p_type || ' ' || p_brand AS title FROM part),
others AS (SELECT DISTINCT p_name || ' ' || p_type || ' ' || p_brand AS match FROM part)"""


def part_titles(t):
    title = F.concat_ws(" ", "p_name", "p_type", "p_brand")
    return t.part.select(title.alias("title"))


@query("link_fuzzy", "WITH " + TITLES + """,
near AS (SELECT title, match, levenshtein(title, match) AS distance FROM titles, others
         WHERE title <> match AND abs(length(title) - length(match)) <= 2 AND levenshtein(title, match) <= 2)
SELECT title, arg_min(match, (distance, match)) AS match, min(distance) AS distance FROM near GROUP BY title""")
def link_fuzzy(t):
    titles = part_titles(t)
    return link.fuzzy_title(titles, titles, 2).withColumn("distance", F.col("distance").cast("long"))


@query("link_cascade", "WITH " + D.MENTIONS + "," + FIRST_LINE + """,
numbers AS (SELECT doc_id, min(item_id) AS target, 'B1_official_number' AS method FROM mentions GROUP BY doc_id),
bases AS (SELECT stem, min(doc_id) AS target, count(*) AS n FROM stemmed GROUP BY stem),
exact AS (SELECT s.doc_id, b.target, 'B2_title' AS method FROM stemmed s JOIN bases b ON b.stem = s.stem
          WHERE s.doc_id <> b.target AND s.doc_id NOT IN (SELECT doc_id FROM numbers)),
verdict AS (SELECT l.doc_id, CAST(l.quality AS BIGINT) AS target, 'B3_verdict' AS method FROM labels l
            WHERE l.doc_id NOT IN (SELECT doc_id FROM numbers) AND l.doc_id NOT IN (SELECT doc_id FROM exact)),
hit AS (SELECT * FROM numbers UNION ALL SELECT * FROM exact UNION ALL SELECT * FROM verdict)
SELECT d.doc_id, h.target, coalesce(h.method, 'none') AS method FROM documents d LEFT JOIN hit h ON h.doc_id = d.doc_id""")
def link_cascade(t):
    """Passage of the registry, then first document of the same title, then the verdict table."""
    stems = titled(t).select("doc_id", "stem")
    bases = stems.groupBy("stem").agg(F.min("doc_id").alias("target"))

    def by_number(rows):
        hits = link.present(rows.select("doc_id", "text"), "doc_id", "text", D.aliases(t), "item_id")
        return hits.select("doc_id", F.col("item_id").alias("target"))

    def by_title(rows):
        mine = rows.select("doc_id", stem_of(F.split_part("text", F.lit("\n"), F.lit(1))).alias("stem"))
        return mine.join(bases, "stem").filter("doc_id <> target").select("doc_id", "target")

    def by_verdict(rows):
        return rows.select("doc_id").join(t.labels, "doc_id").select(
            "doc_id", F.col("quality").cast("long").alias("target"))

    return link.cascade(t.texts.select("doc_id", "text"), "doc_id", {
        "B1_official_number": by_number, "B2_title": by_title, "B3_verdict": by_verdict,
    }).select("doc_id", "target", "method")


@query("link_cascade_fuzzy", """
WITH named AS (SELECT p_partkey, p_size, p_name || ' ' || p_type AS title FROM part),
reg AS (SELECT title, min(p_partkey) AS target FROM named WHERE p_partkey % 2 = 0 GROUP BY title),
ask AS (SELECT * FROM named WHERE p_partkey % 2 = 1),
exact AS (SELECT a.p_partkey, r.target FROM ask a JOIN reg r ON r.title = a.title),
titles AS (SELECT DISTINCT title FROM ask WHERE p_partkey NOT IN (SELECT p_partkey FROM exact)),
near AS (SELECT t.title, r.title AS match, r.target, levenshtein(t.title, r.title) AS d FROM titles t JOIN reg r
         ON abs(length(t.title) - length(r.title)) <= 3 AND levenshtein(t.title, r.title) <= 3),
best AS (SELECT title, arg_min(target, (d, match)) AS target FROM near GROUP BY title),
fuzzy AS (SELECT a.p_partkey, b.target FROM ask a JOIN best b ON b.title = a.title WHERE a.p_partkey NOT IN (SELECT p_partkey FROM exact))
SELECT a.p_partkey, coalesce(e.target, f.target, CASE WHEN a.p_size > 25 THEN a.p_partkey - 1 END) AS target,
       CASE WHEN e.target IS NOT NULL THEN 'B1_title' WHEN f.target IS NOT NULL THEN 'B2_fuzzy' WHEN a.p_size > 25 THEN 'B3_verdict' ELSE 'none' END AS method
FROM ask a LEFT JOIN exact e ON e.p_partkey = a.p_partkey LEFT JOIN fuzzy f ON f.p_partkey = a.p_partkey""")
def link_cascade_fuzzy(t):
    """Odd parts against even ones: the same title, then one at most three edits away, then a verdict."""
    rows = t.part.select("p_partkey", "p_size", F.concat_ws(" ", "p_name", "p_type").alias("title"))
    known = rows.filter("p_partkey % 2 = 0")
    return link.cascade(rows.filter("p_partkey % 2 = 1"), "p_partkey", {
        "B1_title": lambda rest: link.by_title(rest, "p_partkey", "title", known, "p_partkey"),
        "B2_fuzzy": lambda rest: link.by_title(rest, "p_partkey", "title", known, "p_partkey", 3),
        "B3_verdict": lambda rest: rest.filter("p_size > 25").select("p_partkey", (F.col("p_partkey") - 1).alias("target")),
    }).select("p_partkey", "target", "method")


@query("cov_zero_entity", "WITH " + D.MENTIONS + """
SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM mentions)""")
def cov_zero_entity(t):
    return link.covered(t.documents.select("doc_id"), D.present(t), "doc_id")[1]


@query("cov_without_label", """
SELECT lang, count(*) AS documents, count(*) FILTER (doc_id IN (SELECT doc_id FROM labels)) AS labelled FROM documents GROUP BY lang""")
def cov_without_label(t):
    docs = t.documents.select("doc_id", "lang")
    have, lack = link.covered(docs, t.labels, "doc_id")
    both = have.withColumn("l", F.lit(1)).unionByName(lack.withColumn("l", F.lit(0)))
    return both.groupBy("lang").agg(F.count(F.lit(1)).alias("documents"), F.sum("l").alias("labelled"))


@query("registry_collisions", "WITH " + D.ALIASES + """,
words AS (SELECT DISTINCT item_id, unnest(regexp_split_to_array(lower(text), '[^\\p{L}\\p{N}]+')) AS alias FROM benchmark)
SELECT alias, count(*) AS owners FROM words WHERE alias <> '' GROUP BY alias HAVING count(*) > 1""".replace("\\\\", "\\"))
def registry_collisions(t):
    """Single words as aliases: those several entries claim."""
    reg = t.benchmark.select("item_id", text.words("text").alias("aliases"))
    dim = ingest.registry(reg, "item_id")
    return dim.filter("owners > 1").select("alias", "owners").distinct()
