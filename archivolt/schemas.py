"""Tables of the archive as schemas, and bringing any older table to them."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StructType

_DDL = {
    "site_meta": "domain string, key string, value string",
    "runs": "run_id bigint, domain string, started_at timestamp_ntz, finished_at timestamp_ntz, status string, message string",
    "pages": "domain string, url string, path_slug string, local_path string, from_sitemap int, etag string, last_modified string, content_hash string, mime_type string, status_code int, depth int, first_seen_at string, last_seen_at string, last_changed_at string, gone int, gone_since string, page_role string, word_count_clean int, loaded_at timestamp_ntz",
    "hosts": "host_url string, hosted_url string, hosted_title string, detected_at string",
    "sitemaps": "snapshot_no int, domain string, url string, lastmod string, source_sitemap string, first_seen_at string, last_seen_at string, removed int, removed_at string, loaded_at timestamp_ntz",
    "exports": "domain string, url string, md_path string, source_hash string, md_hash string, exported_at string, conversion_method string, word_count int, ocr_used int, ocr_engines string, pages int, agreement_avg double, status string, error string",
    "assets": "hash string, path string, original_url string, mime_type string, skipped_reason string, bytes bigint, ref_count bigint, gone_since string",
    "asset_refs": "asset_hash string, referencing_url string",
    "pdf_quality": "domain string, url string, content_hash string, scored_at string, avg_chars_per_page double, readable_pages_pct double, has_text_layer int, word_quality_estimate double, composite_score double, pages int, pdf_title string, excerpt string, processing_difficulty double, skip int, ai_summary string, ai_author string, ai_summarized_at string, summary_tier string, ai_language string, ai_title string",
    "pdf_upgrade_queue": "queue_id bigint, batch_no int, domain string, url string, content_hash string, priority double, status string, queued_at string, started_at string, finished_at string, before_score double, after_score double, score_improvement double, pages_processed int, method string, error string, pass int, sample_text string",
    "llm_calls": "stage string, url string, page_no int, provider string, model string, tokens_in bigint, tokens_out bigint, ok int, called_at string",
}


def schema(name: str) -> StructType:
    return StructType.fromDDL(_DDL[name])


def conform(rows: DataFrame, name: str) -> DataFrame:
    """`rows` with exactly the columns of a table: missing ones NULL, others cast (unreadable values NULL), further ones dropped."""
    have = set(rows.columns)
    return rows.select(*[(F.col(f.name).try_cast(f.dataType) if f.name in have else F.lit(None).cast(f.dataType)).alias(f.name) for f in schema(name)])
