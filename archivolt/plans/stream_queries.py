"""Streaming flows drained over whole tables; their SQL is that of the batch."""

from __future__ import annotations

from pyspark.sql import functions as F

from archivolt.functions.digests import canonical_digest
from archivolt.operators import merge as M, relational as R
from archivolt.streaming import flows as S


def stream_dedup_urls(spark, d):
    return S.drained(S.first_seen_once(S.table_stream(spark, d, "pages").select("url"), ["url"]))


def stream_window_events(spark, d):
    x = S.drained(S.windowed_counts(S.table_stream(spark, d, "events").withColumn("ts", F.col("ts").cast("timestamp")), "ts", ["event_type"], "1 day"), "complete")
    return x.select(F.date_format("w.start", "yyyy-MM-dd").alias("day"), "event_type", "n")


def stream_session_events(spark, d):
    x = S.drained(S.sessions(S.table_stream(spark, d, "events").withColumn("ts", F.col("ts").cast("timestamp")), "ts", "user_id", "30 minutes"), "complete")
    return x.groupBy("user_id").agg(F.count(F.lit(1)).alias("sessions"), F.max("n").alias("longest"))


def stream_newest_pages(spark, d):
    x = S.table_stream(spark, d, "pages").withColumn("digest", canonical_digest(F.col("content_hash")))
    last = S.drained(S.newest_by_key(x, "url", "last_seen_at", "digest"), "update")
    return R.latest(last, ["url"], ["visits", "newest", "digest"])


def stream_upsert_pages(spark, d):
    cols = ["url", "last_seen_at", "status_code", "depth"]

    def put(old, batch):
        new = M.last_per_key(batch.select(*cols), ["url"], ["last_seen_at"])
        return new if old is None else M.last_per_key(old.unionByName(new), ["url"], ["last_seen_at"])

    return S.merged(S.table_stream(spark, d, "pages", files_per_trigger=4), put, key="url")


QUERIES = {f.__name__: f for f in (stream_dedup_urls, stream_window_events, stream_session_events, stream_newest_pages, stream_upsert_pages)}

ORACLE = {
    "stream_dedup_urls": "SELECT DISTINCT url FROM pages",
    "stream_window_events": "SELECT strftime(ts, '%Y-%m-%d') AS day, event_type, count(*) AS n FROM events GROUP BY ALL",
    "stream_session_events": "WITH g AS (SELECT user_id, ts, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts) < INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS s FROM events), k AS (SELECT user_id, sum(s) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS k FROM g), c AS (SELECT user_id, k, count(*) AS n FROM k GROUP BY ALL) SELECT user_id, count(*) AS sessions, max(n) AS longest FROM c GROUP BY user_id",
    "stream_newest_pages": "WITH x AS (SELECT *, nullif(regexp_replace(lower(trim(content_hash)), '^[a-z0-9-]+:', ''), '') AS dg FROM pages) SELECT url, count(*) AS visits, max(last_seen_at) FILTER (dg IS NOT NULL) AS newest, arg_max(dg, last_seen_at) FILTER (dg IS NOT NULL) AS digest FROM x GROUP BY url",
    "stream_upsert_pages": "SELECT url, m.last_seen_at AS last_seen_at, m.status_code AS status_code, m.depth AS depth FROM (SELECT url, max(struct_pack(last_seen_at := last_seen_at, status_code := status_code, depth := depth)) AS m FROM pages GROUP BY url)",
}
