"""Streaming jobs, driven over the events table as it would arrive.

Events land in three deliveries by date; those of type 'error' come late, in a fourth. Each
delivery is processed by one run of the query, which resumes from its checkpoint.
"""

from pyspark.sql import functions as F

from docgraph.catalog import derive as D
from docgraph.catalog.base import query
from docgraph.catalog.quality import QUEUE, queues
from docgraph.plans import storage
from docgraph.streaming import stream, upsert

COLUMNS = ["event_id", "ts", "user_id", "event_type", "value", "props"]


def deliveries(t):
    rows = t.events.select(*COLUMNS).withColumn("ts", F.col("ts").cast("timestamp"))
    third = F.least(F.floor((F.dayofmonth("ts") - 1) / 10), F.lit(2))
    on_time = F.col("event_type") != "error"
    return [rows.filter(on_time & (third == i)) for i in range(3)] + [rows.filter(~on_time)]


def drive(t, name, build, mode="append"):
    """Run ``build(stream)`` over all deliveries; returns the path of its change log."""
    root = storage.work_path(t.spark, name)
    for i, rows in enumerate(deliveries(t)):
        rows.write.parquet(f"{root}/in/{i}")
        source = stream.arriving(t.spark, f"{root}/in", rows.schema)
        stream.run(build(source), f"{root}/out", f"{root}/checkpoint", mode)
    return f"{root}/out"


@query("stream_intake", "SELECT DISTINCT user_id, event_type FROM events")
def stream_intake(t):
    out = drive(t, "intake", lambda s: stream.intake(s, ["user_id", "event_type"], "ts", "40 days"))
    return stream.emitted(t.spark, out).select("user_id", "event_type")


@query("stream_daily_counts", """
SELECT strftime(ts, '%Y-%m-%d') AS day, count(*) AS n FROM events
WHERE event_type <> 'error'
  AND date_trunc('day', ts) + INTERVAL 1 DAY <= (SELECT max(ts) FROM events WHERE event_type <> 'error') - INTERVAL 2 DAY
GROUP BY 1""")
def stream_daily_counts(t):
    """Days the watermark has passed; the late errors of these days come too late to count."""
    out = drive(t, "daily", lambda s: stream.daily(s, "ts", "2 days"))
    return stream.emitted(t.spark, out).select(D.day("day.start").alias("day"), "n")


@query("stream_gate", "WITH " + QUEUE + """
SELECT event_type, count(*) AS n, CAST(sum(event_id) AS BIGINT) AS ids FROM events e
WHERE NOT EXISTS (SELECT 1 FROM queue_events q WHERE q.event_id = e.event_id)
  AND NOT EXISTS (SELECT 1 FROM queue_users q WHERE q.user_id = e.user_id) GROUP BY event_type""")
def stream_gate(t):
    queue = queues(t)

    def build(s):
        return stream.gate(stream.gate(s, queue["event_id"], "event_id"), queue["user_id"], "user_id")

    out = drive(t, "gate", build)
    return stream.emitted(t.spark, out).groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n"), F.sum("event_id").alias("ids"))


@query("stream_backlog", """
SELECT 'k' || CAST(json_extract(props, '$.k') AS BIGINT) AS title, strftime(min(ts), '%Y-%m-%d %H:%M:%S.%f') AS first_seen,
       strftime(max(ts), '%Y-%m-%d %H:%M:%S.%f') AS last_seen, count(DISTINCT user_id) AS ref_count, count(*) AS sightings
FROM events GROUP BY 1""")
def stream_backlog(t):
    def build(s):
        titled = s.select(F.concat(F.lit("k"), F.get_json_object("props", "$.k")).alias("title"), "user_id", "ts")
        return stream.backlog(titled, "title", "user_id", "ts")

    out = drive(t, "backlog", build, "update")
    totals = stream.backlog_totals(stream.current(t.spark, out, ["title", "user_id"]), "title")
    return totals.withColumns({c: D.stamp(c) for c in ("first_seen", "last_seen")})


@query("stream_latest", """
SELECT user_id, event_id, event_type, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY events.ts DESC, event_id DESC) = 1""")
def stream_latest(t):
    out = drive(t, "latest", lambda s: stream.latest(s, "user_id", ["ts", "event_id"]), "update")
    rows = stream.current(t.spark, out, ["user_id"])
    return rows.select("user_id", "event_id", "event_type", D.stamp("ts").alias("ts"))


def kept_up(t, name, build, keys, merge, buckets=8):
    """Run all deliveries into a keyed table; returns its rows."""
    root = storage.work_path(t.spark, name)
    for i, rows in enumerate(deliveries(t)):
        rows.write.parquet(f"{root}/in/{i}")
        source = build(stream.arriving(t.spark, f"{root}/in", rows.schema))
        upsert.run(source, f"{root}/table", f"{root}/checkpoint", keys, merge, buckets)
    return upsert.table(t.spark, f"{root}/table", source.schema)


@query("stream_upsert_latest", """
SELECT user_id, event_id, event_type, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY events.ts DESC, event_id DESC) = 1""")
def stream_upsert_latest(t):
    rows = kept_up(t, "upsert", lambda s: s.select("user_id", "event_id", "event_type", "ts"), ["user_id"],
                   upsert.newest(["user_id"], ["ts", "event_id"]))
    return rows.withColumn("ts", D.stamp("ts"))


@query("stream_upsert_backlog", """
SELECT 'k' || CAST(json_extract(props, '$.k') AS BIGINT) AS title, user_id, strftime(min(ts), '%Y-%m-%d %H:%M:%S.%f') AS first_seen,
       strftime(max(ts), '%Y-%m-%d %H:%M:%S.%f') AS last_seen, count(*) AS sightings
FROM events GROUP BY ALL""")
def stream_upsert_backlog(t):
    def build(s):
        return s.select(F.concat(F.lit("k"), F.get_json_object("props", "$.k")).alias("title"), "user_id",
                        F.col("ts").alias("first_seen"), F.col("ts").alias("last_seen"), F.lit(1).cast("long").alias("sightings"))

    keys = ["title", "user_id"]
    rows = kept_up(t, "backlog", build, keys, upsert.summed(
        keys, {"first_seen": F.min, "last_seen": F.max, "sightings": F.sum}))
    return rows.withColumns({c: D.stamp(c) for c in ("first_seen", "last_seen")})
