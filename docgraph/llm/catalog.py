"""The operators of this package applied to the given tables, with SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docgraph.llm import (codes, decontaminate, jaccard, linededup, lmscore, packing, pieces, quality,
                          repeats, resample, secrets, sharding, toxicity)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    """Register ``fn(spark, sf_dir) -> DataFrame``."""

    def register(fn):
        QUERIES[name] = fn
        if sql:
            ORACLES[name] = sql
        return fn

    return register


def table(spark: SparkSession, path: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{path}/{name}.parquet")


@query("op3_sharding")
def op3(spark: SparkSession, path: str) -> DataFrame:
    return sharding.shards(table(spark, path, "documents"))


@query("op9_line_dedup", """
with lines as (
  select doc_id, line, row_number() over (partition by doc_id order by i) - 1 as k, i
  from (select doc_id, unnest(string_split(text, chr(10))) as raw,
               unnest(range(len(string_split(text, chr(10))))) as i,
               trim(raw, chr(32) || chr(9) || chr(13) || chr(11) || chr(12)) as line from documents)
  where line <> ''),
windows as (
  select doc_id, k, line || chr(10) || lead(line, 1) over w || chr(10) || lead(line, 2) over w as win
  from lines window w as (partition by doc_id order by k)),
later as (
  select doc_id, k from (
    select doc_id, k, row_number() over (partition by win order by doc_id, k) as nth
    from windows where win is not null) where nth > 1),
gone as (select distinct l.doc_id, l.k + d.d as k from later l cross join (values (0), (1), (2)) d(d)),
flagged as (select l.doc_id, l.k, l.i, g.k is not null as removed
            from lines l left join gone g on l.doc_id = g.doc_id and l.k = g.k),
per_doc as (select doc_id, count(*) as n_lines, count(*) filter (removed) as n_removed,
                   list(i) filter (removed) as lines_gone from flagged group by doc_id)
select d.doc_id, coalesce(p.n_lines, 0)::bigint as n_lines, coalesce(p.n_removed, 0)::bigint as n_removed,
       md5(case when coalesce(p.n_removed, 0) = 0 then coalesce(d.text, '') else
           array_to_string(list_filter(list_transform(range(len(string_split(d.text, chr(10)))),
             lambda i: case when list_contains(p.lines_gone, i) then null
               else string_split(d.text, chr(10))[i + 1] end), lambda x: x is not null), chr(10)) end)
         as clean_md5
from documents d left join per_doc p on d.doc_id = p.doc_id
""")
def op9(spark: SparkSession, path: str) -> DataFrame:
    done = linededup.deduplicated(table(spark, path, "documents"))
    return done.select(F.col("doc.doc_id").alias("doc_id"), "n_lines", "n_removed",
                       F.md5(F.coalesce("clean_text", F.lit(""))).alias("clean_md5"))


@query("op8_quality_rules")
def op8(spark: SparkSession, path: str) -> DataFrame:
    return quality.verdicts(table(spark, path, "documents"))


@query("op10_benchmark_decontamination")
def op10(spark: SparkSession, path: str) -> DataFrame:
    return decontaminate.hits(table(spark, path, "documents"), table(spark, path, "benchmark"))


@query("op4_sentencepiece")
def op4(spark: SparkSession, path: str) -> DataFrame:
    return pieces.round_trip(table(spark, path, "documents"))


@query("op5_toxicity")
def op5(spark: SparkSession, path: str) -> DataFrame:
    return toxicity.scored(table(spark, path, "documents"), table(spark, path, "labels"))


@query("op2_secret_scans")
def op2(spark: SparkSession, path: str) -> DataFrame:
    return secrets.report(secrets.scan(table(spark, path, "documents")))


@query("op7_lm_scoring", """
with docs as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') as ws from documents),
words as (select doc_id, unnest(ws) as w, unnest(range(len(ws))) as i from docs),
counts as (select w, count(*) as n from words group by w),
total as (select sum(n) as n from counts),
uni as (select w, n from counts),
pairs as (select doc_id, i, w, lag(w) over (partition by doc_id order by i) as p from words),
bi as (select p, w, count(*) as n from pairs where p is not null group by p, w),
scored as (
  select s.doc_id, s.p is not null and b.n < 2 as back,
         case when s.p is null then ln(u.n / t.n) when b.n >= 2 then ln(b.n / q.n)
              else ln(0.4) + ln(u.n / t.n) end as x
  from pairs s cross join total t join uni u on s.w = u.w
  left join bi b on s.p = b.p and s.w = b.w left join uni q on s.p = q.w),
summed as (select doc_id, count(*) as n, count(*) filter (back) as backs, sum(x) as x
           from scored group by doc_id)
select d.doc_id, coalesce(s.n, 0)::bigint as n_words, coalesce(s.backs, 0)::bigint as n_backoff,
       round(coalesce(s.x, 0.0), 4)::double as log_score, round(s.x / s.n, 6)::double as score
from docs d left join summed s on d.doc_id = s.doc_id
""")
def op7(spark: SparkSession, path: str) -> DataFrame:
    return lmscore.scores(table(spark, path, "documents"))


@query("op1_ngram_jaccard_join", r"""
with docs as (
  select doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') as ws from documents),
sets as (select doc_id, list_distinct(case when len(ws) = 0 then []
           when len(ws) < 3 then [array_to_string(ws, ' ')]
           else list_transform(range(1, len(ws) - 1), lambda i: array_to_string(ws[i:i + 2], ' '))
           end) as s from docs),
grams as (select doc_id, len(s) as n, unnest(s) as g from sets),
common as (select a.doc_id as x, b.doc_id as y, a.n as nx, b.n as ny, count(*) as k
           from grams a join grams b on a.g = b.g and a.doc_id < b.doc_id group by all),
links as (select x, y from common where 100 * k >= 90 * (nx + ny - k)),
both_ways as (select x, y from links union all select y, x from links),
reach as (with recursive r(x, y) as (
  select doc_id, doc_id from documents union
  select r.x, b.y from r join both_ways b on r.y = b.x) select x, min(y) as c from r group by x)
select s.doc_id, len(s.s)::bigint as n_shingles, r.c as component_id
from sets s join reach r on s.doc_id = r.x
""".replace("\\\\", "\\"))
def op1(spark: SparkSession, path: str) -> DataFrame:
    rows = jaccard.join(table(spark, path, "documents"), n=3, num=9, den=10)
    return rows.select("doc_id", "n_shingles", "component_id")


@query("op6_suffix_array_dedup")
def op6(spark: SparkSession, path: str) -> DataFrame:
    return repeats.removed(table(spark, path, "documents")).drop("kept")


@query("op11_importance_resampling")
def op11(spark: SparkSession, path: str) -> DataFrame:
    rows = resample.resampled(table(spark, path, "documents"), table(spark, path, "benchmark"))
    return rows.select("doc_id", "n_features", "weight", "score", "rank")


@query("op12_best_fit_packing")
def op12(spark: SparkSession, path: str) -> DataFrame:
    return packing.packed(table(spark, path, "documents"), with_ids=False)


def _assigned(book: str, name: str) -> str:
    """The nearest entry of ``book`` for every part, and the floored means of what chose it."""
    return f"""
near{name} as (
  select p.vec_id, p.p, p.q, min(((p.q[1] - b.q[1]) ** 2 + (p.q[2] - b.q[2]) ** 2 + (p.q[3] - b.q[3]) ** 2
                                  + (p.q[4] - b.q[4]) ** 2)::bigint * 64 + b.e) as de
  from parts p join {book} b on p.p = b.p group by all),
sums{name} as (
  select p, de % 64 as e, count(*)::bigint as n, [sum(q[1])::bigint, sum(q[2])::bigint,
         sum(q[3])::bigint, sum(q[4])::bigint] as s from near{name} group by all),
means{name} as (
  select b.p, b.e, case when s.n is null then b.q
         else list_transform(s.s, lambda x: (x - ((x % s.n) + s.n) % s.n) // s.n) end as q
  from {book} b left join sums{name} s on b.p = s.p and b.e = s.e)"""


@query("op13_vector_codes", f"""
with kept as (
  select vec_id, label, list_transform(embedding, lambda x: floor(256 * x)::bigint) as v from embeddings
  where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
parts as (select vec_id, p.p, v[4 * p.p + 1:4 * p.p + 4] as q from kept cross join range(16) p(p)),
seeds as (select vec_id, row_number() over (order by vec_id) - 1 as e from kept order by vec_id limit 64),
book as (select p, e, q from parts join seeds using (vec_id)),{_assigned('book', '1')},{_assigned('means1', '2')},
near as (
  select p.vec_id, p.p, min(((p.q[1] - b.q[1]) ** 2 + (p.q[2] - b.q[2]) ** 2 + (p.q[3] - b.q[3]) ** 2
                             + (p.q[4] - b.q[4]) ** 2)::bigint * 64 + b.e) as de
  from parts p join means2 b on p.p = b.p group by all),
coded as (
  select vec_id, string_agg(printf('%02x', de % 64), '' order by p) as code, sum(de // 64)::bigint as error
  from near group by vec_id),
digest as (
  select sha256(string_agg(q[i]::varchar, ',' order by p, e, i)) as codebooks_sha256
  from means2 cross join range(1, 5) r(i))
select c.vec_id, c.code, c.error, sum(c.error) over (partition by k.label)::bigint as label_error,
       codebooks_sha256
from coded c join kept k on c.vec_id = k.vec_id cross join digest
""")
def op13(spark: SparkSession, path: str) -> DataFrame:
    return codes.with_label_error(codes.coded(table(spark, path, "embeddings")))
