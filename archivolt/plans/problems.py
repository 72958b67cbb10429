"""Queries of the general problems: snapshot changes and incremental processing."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from archivolt.operators.snapshot_diff import sitemap_changes
from archivolt.operators.watermark import committed_due, run_windows
from archivolt.session import shared_dir


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def p1_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    changes = sitemap_changes(_t(spark, sf_dir, "sitemaps"), _t(spark, sf_dir, "sitemap_deliveries"))
    return changes.select(F.col("snapshot_no").cast("int").alias("snapshot_no"), "url", "change_kind").distinct()


def p6_found(spark: SparkSession, sf_dir: str) -> DataFrame:
    return committed_due(_t(spark, sf_dir, "pages"), _t(spark, sf_dir, "runs"), _t(spark, sf_dir, "exports"), f"{shared_dir(spark)}/replay-{uuid.uuid4().hex}")


def p6_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = run_windows(_t(spark, sf_dir, "runs"))
    return w.select("domain", "run_id", F.col("ordinal").cast("bigint").alias("ordinal"), F.date_format("low", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("low"), F.date_format("high", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("high"))


QUERIES = {"p1_found": p1_found, "p6_found": p6_found, "p6_windows": p6_windows}

ORACLE = {
    "p1_found": r"""
WITH numbered AS (SELECT domain, snapshot_no, row_number() OVER (PARTITION BY domain ORDER BY snapshot_no) AS seq
                  FROM (SELECT DISTINCT domain, snapshot_no FROM sitemap_deliveries)),
listed AS (SELECT n.domain, n.seq, s.url, s.removed, s.last_seen_at, s.loaded_at,
  CASE WHEN trim(s.lastmod) = '' THEN NULL
       WHEN regexp_matches(s.lastmod, '^\d{4}-\d\d-\d\d$') THEN epoch_us(CAST(s.lastmod || 'T00:00:00Z' AS TIMESTAMPTZ))
       WHEN regexp_matches(s.lastmod, '^\d{4}-') THEN epoch_us(TRY_CAST(s.lastmod AS TIMESTAMPTZ))
       ELSE epoch_us(try_strptime(regexp_replace(s.lastmod, '^[A-Za-z]+, ', ''), '%d %b %Y %H:%M:%S GMT')) END AS moment
  FROM sitemaps s JOIN numbered n USING (domain, snapshot_no)),
latest AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY domain, seq, url ORDER BY last_seen_at DESC, loaded_at DESC, moment DESC, removed) AS n FROM listed)
           WHERE n = 1 AND removed = 0),
prev AS (SELECT l.domain, l.seq + 1 AS seq, l.url, l.moment FROM latest l WHERE EXISTS (SELECT 1 FROM numbered n WHERE n.domain = l.domain AND n.seq = l.seq + 1)),
diff AS (SELECT coalesce(c.domain, p.domain) AS domain, coalesce(c.seq, p.seq) AS seq, coalesce(c.url, p.url) AS url,
  CASE WHEN p.url IS NULL THEN 'added' WHEN c.url IS NULL THEN 'removed'
       WHEN c.moment IS NOT NULL AND c.moment IS DISTINCT FROM p.moment THEN 'changed' END AS change_kind
  FROM (SELECT * FROM latest WHERE seq > 1) c FULL JOIN prev p ON c.domain = p.domain AND c.seq = p.seq AND c.url = p.url)
SELECT DISTINCT CAST(n.snapshot_no AS INTEGER) AS snapshot_no, d.url, d.change_kind FROM diff d JOIN numbered n ON n.domain = d.domain AND n.seq = d.seq WHERE d.change_kind IS NOT NULL
""",
    "p6_found": r"""
WITH ok AS (SELECT DISTINCT domain, run_id, started_at FROM runs WHERE status = 'success'),
seen AS (SELECT domain, url, last_seen_at, loaded_at, regexp_replace(lower(trim(content_hash)), '^[a-z0-9-]+:', '') AS digest FROM pages WHERE content_hash IS NOT NULL AND url IS NOT NULL),
now AS (SELECT r.domain, r.run_id, r.started_at, s.url, max(struct_pack(a := s.last_seen_at, b := s.loaded_at, c := s.digest)).c AS digest
        FROM ok r JOIN seen s ON s.domain = r.domain AND s.loaded_at <= r.started_at GROUP BY ALL),
base AS (SELECT url, max(struct_pack(a := exported_at, b := regexp_replace(lower(trim(source_hash)), '^[a-z0-9-]+:', ''))).b AS base FROM exports WHERE status = 'ok' GROUP BY url),
steps AS (SELECT *, lag(digest) OVER (PARTITION BY domain, url ORDER BY started_at, run_id) AS before FROM now)
SELECT DISTINCT run_id, s.url FROM steps s LEFT JOIN base b ON b.url = s.url
WHERE coalesce(before, base) IS NULL OR coalesce(before, base) <> digest
""",
    "p6_windows": r"""
SELECT domain, run_id, row_number() OVER w AS ordinal, strftime(lag(started_at) OVER w, '%Y-%m-%d %H:%M:%S.%f') AS low, strftime(started_at, '%Y-%m-%d %H:%M:%S.%f') AS high
FROM (SELECT DISTINCT domain, run_id, started_at FROM runs WHERE status = 'success') WINDOW w AS (PARTITION BY domain ORDER BY started_at, run_id)
""",
}
