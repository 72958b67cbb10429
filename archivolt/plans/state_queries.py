"""Due sites, revived urls, file checks and wiki answers over the archive's tables, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from archivolt.functions import wiki as K
from archivolt.operators.snapshot_diff import sitemap_changes
from archivolt.plans.problems import ORACLE as PROBLEM_SQL


def _t(spark, d, name):
    return spark.read.parquet(f"{d}/{name}.parquet")


def revived_urls(spark, d):
    changes = sitemap_changes(_t(spark, d, "sitemaps"), _t(spark, d, "sitemap_deliveries"))
    by = changes.groupBy("url").agg(F.min(F.when(F.col("change_kind") == "removed", F.col("snapshot_no"))).alias("removed_in"), F.max(F.when(F.col("change_kind") == "added", F.col("snapshot_no"))).alias("back_in"))
    return by.where("back_in > removed_in").select("url", "removed_in", "back_in")


def due_sites(spark, d):
    now = F.to_timestamp_ntz(F.lit("2025-03-20 00:00:00"))
    last = _t(spark, d, "runs").groupBy("domain").agg(F.max(F.when(F.col("status") == "success", F.col("started_at"))).alias("last"))
    return last.where(F.col("last").isNull() | (F.col("last") <= now - F.make_dt_interval(F.lit(3)))).select("domain")


def file_checks(spark, d):
    files = _t(spark, d, "md_texts").distinct().groupBy("md_path").agg(F.count(F.lit(1)).alias("pages"), F.sum(F.length("md_text")).alias("chars"))
    named = _t(spark, d, "exports").where("status = 'ok'").select("md_path").distinct()
    x = named.join(files, "md_path", "left")
    verdict = F.when(F.col("pages").isNull(), "no text").when((F.col("chars") < 3000) & (F.col("pages") > 2), "too short").otherwise("fine")
    return x.groupBy(verdict.alias("verdict")).agg(F.count(F.lit(1)).alias("files"))


def wiki_answers(spark, d):
    body = """CASE doc_id % 5 WHEN 0 THEN concat('{"parse":{"title":"T', cast(doc_id AS varchar(20)), '","text":"<p>x</p>"}}') WHEN 1 THEN '{"error":{"code":"missingtitle"}}' WHEN 2 THEN '{"error":{"code":"readonly"}}' WHEN 3 THEN '{broken' END"""
    x = _t(spark, d, "documents").select("doc_id", K.wiki_page(F.expr(body)).alias("p"))
    return x.select("doc_id", "p.status", "p.title", "p.html")


def own_links(spark, d):
    x = _t(spark, d, "documents").where("domain IS NOT NULL")
    text = F.concat(F.lit('<a href="https://'), "domain", F.lit('/a/b"> http://other.example/ <a href="http://'), "domain", F.lit('">'))
    return x.select("doc_id", K.own_links_relative(text, F.col("domain")).alias("html"))


QUERIES = {f.__name__: f for f in (revived_urls, due_sites, file_checks, wiki_answers, own_links)}

ORACLE = {
    "revived_urls": f"WITH c AS ({PROBLEM_SQL['p1_found']}), b AS (SELECT url, min(snapshot_no) FILTER (change_kind = 'removed') AS removed_in, max(snapshot_no) FILTER (change_kind = 'added') AS back_in FROM c GROUP BY url) SELECT * FROM b WHERE back_in > removed_in",
    "due_sites": "SELECT domain FROM (SELECT domain, max(started_at) FILTER (status = 'success') AS l FROM runs GROUP BY domain) WHERE l IS NULL OR l <= TIMESTAMP '2025-03-20 00:00:00' - INTERVAL 3 DAY",
    "file_checks": "WITH f AS (SELECT md_path, count(*) AS pages, sum(length(md_text)) AS chars FROM (SELECT DISTINCT * FROM md_texts) GROUP BY 1), x AS (SELECT n.md_path, pages, chars FROM (SELECT DISTINCT md_path FROM exports WHERE status = 'ok') n LEFT JOIN f USING (md_path)) SELECT CASE WHEN pages IS NULL THEN 'no text' WHEN chars < 3000 AND pages > 2 THEN 'too short' ELSE 'fine' END AS verdict, count(*) AS files FROM x GROUP BY 1",
    "wiki_answers": "SELECT doc_id, CASE doc_id % 5 WHEN 0 THEN 200 WHEN 1 THEN 404 WHEN 2 THEN 500 ELSE 0 END AS status, CASE WHEN doc_id % 5 = 0 THEN 'T' || doc_id END AS title, CASE WHEN doc_id % 5 = 0 THEN '<p>x</p>' END AS html FROM documents",
    "own_links": "SELECT doc_id, '<a href=\"/a/b\"> http://other.example/ <a href=\"/\">' AS html FROM documents WHERE domain IS NOT NULL",
}
