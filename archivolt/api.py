"""What a dashboard asks for, as functions of a session and a folder of tables that give DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from archivolt.operators import listing, receipts
from archivolt.plans import list_queries as Q, report_queries as P


def sites(spark: SparkSession, folder: str) -> DataFrame:
    """One row a site: pages, roles, documents, exports and runs."""
    out = P.site_totals(spark, folder)
    for part in (P.pdf_status_rollup(spark, folder), P.export_counts(spark, folder).withColumnsRenamed({"ok": "exports_ok", "failed": "exports_failed", "pages": "exported_pages"}), P.run_durations(spark, folder), Q.queue_eta(spark, folder).drop("waiting", "mean_seconds")):
        out = out.join(part, "domain", "left")
    return out


def health(spark: SparkSession, folder: str) -> DataFrame:
    return P.run_durations(spark, folder).select("domain", "healthy", "last_failure")


def docs(spark: SparkSession, folder: str, domain: str | None = None, sort: str | None = "score_asc", page: int = 1, **filters) -> DataFrame:
    """A page of a site's documents as shown; filters: search, status, score_max, tab."""
    x = Q._documents(spark, folder)
    return listing.row_shown(listing.listed(x if domain is None else x.where(F.col("domain") == domain), sort, page, **filters))


def doc_pages(spark: SparkSession, folder: str, domain: str | None = None, **filters) -> DataFrame:
    x = Q._documents(spark, folder)
    return listing.sizes(x if domain is None else x.where(F.col("domain") == domain), **filters)


def tabs(spark: SparkSession, folder: str) -> DataFrame:
    return P.tab_counts(spark, folder)


def runs(spark: SparkSession, folder: str) -> DataFrame:
    return P.recent_runs_top20(spark, folder)


def activity(spark: SparkSession, folder: str, now: str) -> DataFrame:
    """Jobs under way with pages a minute so far and the minutes left, from the pages their document has."""
    q = P._t(spark, folder, "pdf_upgrade_queue").where("status IN ('submitted', 'processing')").select("queue_id", "domain", "url", "started_at", "pages_processed")
    n = P._latest_quality(spark, folder).select("url", "pages")
    minutes = (F.unix_seconds(F.to_timestamp(F.lit(now))) - F.unix_seconds(F.try_to_timestamp("started_at"))) / 60
    rate = F.try_divide(F.coalesce("pages_processed", F.lit(0)).cast("double"), minutes)
    left = F.try_divide(F.greatest(F.lit(0), F.col("pages") - F.coalesce("pages_processed", F.lit(0))).cast("double"), F.nullif(rate, F.lit(0.0)))
    return q.join(n, "url", "left").select("queue_id", "domain", "url", "pages_processed", "pages", rate.alias("pages_a_minute"), left.alias("minutes_left"))


def receipt(spark: SparkSession, folder: str, queue_id: int) -> DataFrame:
    x = receipts.receipts(P._t(spark, folder, "pdf_upgrade_queue").where(F.col("queue_id") == queue_id))
    return receipts.receipt_steps(x, "queue_id", "receipt")


def summary_candidates(spark: SparkSession, folder: str, most: int = 1000) -> DataFrame:
    """Documents without a summary, the worst scored first."""
    return Q._documents(spark, folder).where("ai_summary IS NULL AND composite_score IS NOT NULL").orderBy("composite_score", "url").limit(most)


def download_name(spark: SparkSession, folder: str, url: str) -> DataFrame:
    """(md_path, file_name) of a document's newest good export."""
    from archivolt.functions.urls import safe_file_name

    e = P._t(spark, folder, "exports").where((F.col("url") == url) & (F.col("status") == "ok"))
    return e.groupBy("url").agg(F.max(F.struct("exported_at", "md_path"))["md_path"].alias("md_path")).select("md_path", safe_file_name(F.regexp_extract("md_path", "([^/]*)$", 1)).alias("file_name"))
