"""Reports, joins, windows and state transitions over the archive's tables, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from archivolt.functions.digests import canonical_digest
from archivolt.operators import merge as M, relational as R


def _t(spark, d, name):
    return spark.read.parquet(f"{d}/{name}.parquet")


def _latest_pages(spark, d, columns):
    """The last visit of each url with the columns named, so that the scan reads no others."""
    return R.latest(_t(spark, d, "pages").select("url", "last_seen_at", *columns.split()), ["url"], ["last_seen_at"])


def _latest_quality(spark, d):
    return R.latest(_t(spark, d, "pdf_quality").select("url", "scored_at", "composite_score", "pages", "has_text_layer", "pdf_title", "ai_title", "skip", "excerpt", "readable_pages_pct", "ai_summary"), ["url"], ["scored_at"])


def _latest_queue(spark, d):
    q = _t(spark, d, "pdf_upgrade_queue").select("url", "batch_no", "queue_id", "status", "before_score", "after_score", "priority", "finished_at")
    return R.latest(q, ["url"], ["batch_no", "queue_id"])


def _r(x, n=6):
    return F.floor(x * 10**n + 0.5) / 10**n


def site_totals(spark, d):
    p = _latest_pages(spark, d, "domain mime_type gone").where("gone = 0")
    like = lambda s: F.count_if(F.col("mime_type").startswith(s))
    return p.groupBy("domain").agg(F.count(F.lit(1)).alias("pages"), like("application/pdf").alias("pdf"), like("text/html").alias("html"), F.count_if(~F.col("mime_type").startswith("text/html")).alias("other"))


def role_counts(spark, d):
    return _latest_pages(spark, d, "domain gone page_role").where("gone = 0").groupBy("domain", "page_role").agg(F.count(F.lit(1)).alias("pages"))


def pdf_status_rollup(spark, d):
    q, u = _latest_quality(spark, d), _latest_queue(spark, d).select("url", "status", F.lit(True).alias("queued"))
    p = _latest_pages(spark, d, "domain gone").where("gone = 0").select("url", "domain")
    x = p.join(q, "url").join(u, "url", "left")
    image = (F.col("has_text_layer") == 0) | F.col("has_text_layer").isNull() | (F.col("readable_pages_pct") < 0.4)
    return x.groupBy("domain").agg(
        F.count(F.lit(1)).alias("scored"), F.count_if(F.col("queued").isNull() & (F.col("skip") == 0) & (F.col("composite_score") >= 0.7)).alias("already_ok"),
        *[F.count_if(F.col("status") == s).alias(s) for s in ("pending", "submitted", "processing", "done", "failed")],
        F.count_if(F.col("status").isin("pending", "submitted")).alias("waiting"), F.count_if(F.col("skip") == 1).alias("skipped"), F.count("ai_summary").alias("summarized"),
        F.count_if(image).alias("image_pdfs"), F.count_if(image & F.col("ai_summary").isNotNull()).alias("image_pdfs_summarized"), _r(F.avg("composite_score")).alias("mean_score"),
    )


def unscored_docs_anti(spark, d):
    p = _latest_pages(spark, d, "domain mime_type gone").where("gone = 0 AND mime_type LIKE 'application/pdf%'")
    return p.join(_t(spark, d, "pdf_quality").select("url"), "url", "left_anti").select("domain", "url")


def known_pages_semi(spark, d):
    return _t(spark, d, "sitemaps").select("domain", "url").distinct().join(_t(spark, d, "pages").select("url"), "url", "left_semi").groupBy("domain").agg(F.count(F.lit(1)).alias("known"))


def docs_left_quality_queue(spark, d):
    p = _latest_pages(spark, d, "domain mime_type").where("mime_type LIKE 'application/pdf%'").select("url", "domain")
    q = _latest_quality(spark, d).select("url", "composite_score", "pdf_title", "ai_title")
    u = _latest_queue(spark, d).select("url", "status", "before_score", "after_score")
    x = p.join(q, "url", "left").join(u, "url", "left")
    return x.select("url", "domain", F.coalesce("ai_title", "pdf_title", "url").alias("title"), F.coalesce("status", F.when(F.col("composite_score").isNull(), "unscored").otherwise("scored")).alias("state"), _r(F.col("after_score") - F.col("before_score")).alias("improvement"))


def host_lookup_semi_reduced(spark, d):
    keys = _t(spark, d, "pdf_quality").select("url")
    return R.semi_reduced(_t(spark, d, "sitemaps").select("url", "source_sitemap", "first_seen_at"), keys, "url", [F.min("source_sitemap").alias("source"), F.min("first_seen_at").alias("first_seen"), F.count(F.lit(1)).alias("listings")])


def export_skip_unchanged(spark, d):
    rows = _latest_pages(spark, d, "content_hash").where("content_hash IS NOT NULL").select("url", canonical_digest(F.col("content_hash")).alias("digest"))
    done = _t(spark, d, "exports").where("status = 'ok'").select("url", canonical_digest(F.col("source_hash")).alias("source"))
    return R.skip_unchanged(rows, done, "url", "digest", "source")


def tab_counts(spark, d):
    x = _latest_quality(spark, d).join(_latest_queue(spark, d).select("url", "status"), "url", "left")
    return x.agg(F.count(F.lit(1)).alias("everything"), F.count_if(F.col("status").isin("done", "processing")).alias("upgraded"), F.count_if(F.col("status").isin("pending", "submitted")).alias("waiting"), F.count_if(F.col("status") == "failed").alias("failed"), F.count_if(F.col("skip") == 1).alias("skipped"))


def export_counts(spark, d):
    e = _t(spark, d, "exports").distinct()
    return e.groupBy("domain").agg(F.count_if(F.col("status") == "ok").alias("ok"), F.count_if(~F.col("status").eqNullSafe(F.lit("ok"))).alias("failed"), F.sum("pages").alias("pages"), _r(F.avg("agreement_avg")).alias("agreement"), F.sum("ocr_used").alias("ocr"))


def run_durations(spark, d):
    r = _t(spark, d, "runs").distinct()
    secs = (F.unix_micros(F.col("finished_at").cast("timestamp")) - F.unix_micros(F.col("started_at").cast("timestamp"))) / 1e6
    return r.groupBy("domain").agg(F.count(F.lit(1)).alias("runs"), F.coalesce(_r(F.avg(secs), 3), F.lit(300.0)).alias("mean_seconds"), F.max_by("message", F.when(F.col("status") == "failed", F.col("run_id"))).alias("last_failure"), F.bool_and(F.coalesce(F.col("status") != "failed", F.lit(True))).alias("healthy"))


def latest_run_per_site(spark, d):
    return R.latest(_t(spark, d, "runs").select("domain", "run_id", "status"), ["domain"], ["run_id"])


def recent_runs_top20(spark, d):
    r = _t(spark, d, "runs").select("domain", "run_id", "started_at", "status").distinct()
    five = R.top_per_group(r, "domain", [F.col("run_id").desc()], 5)
    newest = five.orderBy(F.col("started_at").desc(), F.col("run_id").desc()).limit(20)
    return newest.select("domain", "run_id", "status", F.col("rn").cast("bigint").alias("rn"))


def docs_page_score_asc(spark, d):
    x = _latest_quality(spark, d).where("composite_score IS NOT NULL").select("url", "composite_score")
    p = R.page_of(x, [F.col("composite_score").asc(), F.col("url").asc()], 2)
    return p.select(F.col("rn").cast("bigint").alias("rn"), "url", "composite_score")


def docs_search(spark, d):
    x = _latest_quality(spark, d)
    hit = F.lit(False)
    for c in ("url", "ai_title", "pdf_title", "excerpt"):
        hit = hit | F.coalesce(F.col(c).ilike("%garden%"), F.lit(False))
    return x.where(hit & ((F.col("composite_score") <= 0.9) | F.col("composite_score").isNull())).select("url")


def score_deltas(spark, d):
    x = _t(spark, d, "pdf_quality").select("url", "scored_at", "composite_score").distinct()
    y = R.delta_to_last_known(x, "url", ["scored_at", "composite_score"], "composite_score")
    return y.select("url", "scored_at", "composite_score", _r(F.col("delta")).alias("delta"))


def score_trail(spark, d):
    x = _t(spark, d, "pdf_quality").select("url", "scored_at", "composite_score").distinct().where("composite_score IS NOT NULL")
    s = F.array_sort(F.collect_list(F.struct("scored_at", "composite_score")))
    return x.groupBy("url").agg(s.alias("s")).select("url", F.array_join(F.transform("s", lambda r: F.format_string("%.4f", r["composite_score"])), ">").alias("trail"))


def confidence_buckets(spark, d):
    x = _t(spark, d, "exports").where("agreement_avg IS NOT NULL").distinct()
    return x.groupBy("conversion_method").agg(F.count_if(F.col("agreement_avg") >= 0.9).alias("clean"), F.count_if((F.col("agreement_avg") >= 0.6) & (F.col("agreement_avg") < 0.9)).alias("fuzzy"), F.count_if(F.col("agreement_avg") < 0.6).alias("dirty"))


def gain_per_page(spark, d):
    x = _t(spark, d, "pdf_upgrade_queue").where("status = 'done'")
    gain = F.try_divide(F.col("pages_processed").cast("double"), F.nullif(F.col("score_improvement"), F.lit(0.0)))
    return x.groupBy("method").agg(F.count(F.lit(1)).alias("documents"), _r(F.avg(gain), 4).alias("pages_per_gain"), _r(F.avg("score_improvement")).alias("mean_gain"))


def best_method(spark, d):
    x = _t(spark, d, "pdf_upgrade_queue").where("status = 'done' AND method IS NOT NULL").groupBy("domain", "method").agg(_r(F.avg("score_improvement")).alias("gain"))
    x = x.where("gain IS NOT NULL")
    return x.groupBy("domain").agg(F.max(F.struct("gain", "method")).alias("m")).select("domain", "m.method", "m.gain")


def daily_visits(spark, d):
    x = _t(spark, d, "pages").select(F.date_format(F.date_trunc("day", F.to_timestamp("last_seen_at")), "yyyy-MM-dd").alias("day"), "status_code")
    return x.groupBy("day").agg(F.count(F.lit(1)).alias("visits"), F.count_if(F.col("status_code") >= 400).alias("errors"))


def gone_by_window(spark, d):
    x = _latest_pages(spark, d, "domain gone_since first_seen_at")
    day = F.to_date(F.to_timestamp("gone_since"))
    return x.groupBy("domain").agg(F.count_if(day >= F.lit("2025-02-15").cast("date")).alias("gone"), F.count_if(F.to_date(F.to_timestamp("first_seen_at")) >= F.lit("2025-02-15").cast("date")).alias("fresh"), F.min("gone_since").alias("first_gone"))


def page_upsert(spark, d):
    p = _t(spark, d, "pages").select("url", "domain", "content_hash", "first_seen_at", "last_seen_at", "last_changed_at", "gone", "gone_since", "page_role", "word_count_clean").distinct()
    cut = "2025-03-01T00:00:00.000Z"
    old = M.last_per_key(p.where(F.col("last_seen_at") < cut), ["url"], ["last_seen_at"])
    new = M.last_per_key(p.where(F.col("last_seen_at") >= cut), ["url"], ["last_seen_at"])
    return M.upsert_pages(old, new).select("url", "content_hash", "first_seen_at", "last_seen_at", "last_changed_at", "gone", "gone_since", "page_role", "word_count_clean")


def replace_upsert(spark, d):
    q = _t(spark, d, "pdf_quality").select("url", "scored_at", "composite_score", "ai_title").distinct()
    old = M.last_per_key(q, ["url"], ["scored_at"])
    batch = old.where("composite_score < 0.5").select("url", F.lit("2025-05-01T00:00:00.000Z").alias("scored_at"), (F.col("composite_score") * 2).alias("composite_score"))
    return M.upsert(old, batch, ["url"], mode="replace")


def gone_marking(spark, d):
    p = _latest_pages(spark, d, "gone gone_since").select("url", "last_seen_at", "gone", "gone_since")
    keep = _t(spark, d, "pdf_upgrade_queue").where("status IN ('pending', 'processing', 'done')").select("url")
    return M.mark_stale(p, "2025-03-01T00:00:00.000Z", keep, "2025-04-01T00:00:00.000Z")


def absent_marking(spark, d):
    p = _latest_pages(spark, d, "gone gone_since").select("url", "gone", "gone_since")
    return M.mark_absent(p, _t(spark, d, "sitemaps").select("url"), "url", "gone", "gone_since", "2025-04-01T00:00:00.000Z")


def retention_expired(spark, d):
    return M.expired(_latest_pages(spark, d, "gone gone_since").where("gone = 1"), "gone_since", "2025-05-01T00:00:00.000Z", 45).select("url", "gone_since")


def content_change_detection(spark, d):
    v = _t(spark, d, "pages").select("url", "last_seen_at", "content_hash").distinct()
    x = M.content_changes(v, "url", "last_seen_at", canonical_digest(F.col("content_hash")))
    return x.groupBy("content_state").agg(F.count(F.lit(1)).alias("visits"))


def reference_counts(spark, d):
    e = _t(spark, d, "sitemaps").select(F.col("source_sitemap").alias("node"), F.col("url").alias("referrer"))
    return M.reference_counts(e, "node", "referrer")


def dedup_first_wins(spark, d):
    x = _t(spark, d, "documents").where("text IS NOT NULL").select(F.sha2(F.col("text").cast("binary"), 256).alias("digest"), "doc_id")
    return x.groupBy(F.concat(F.lit("sha256:"), "digest").alias("digest")).agg(F.min("doc_id").alias("first_doc"), F.count(F.lit(1)).alias("copies"))


def robots_allowed(spark, d):
    prefixes = spark.createDataFrame([("/node",), ("/talks/19",), ("/reports/20",)], "prefix string")
    from archivolt.functions import urls as U

    x = _t(spark, d, "pages").select("url", U.path(F.col("url")).alias("path")).distinct()
    blocked = R.starts_with_any(x, "path", prefixes, "prefix")
    return x.join(blocked.select("url"), "url", "left_anti").select("url")


def visits_asof_run(spark, d):
    v = _t(spark, d, "pages").select("domain", "url", "loaded_at").distinct()
    r = _t(spark, d, "runs").where("status = 'success'").select("domain", "started_at", F.col("run_id").alias("last_run")).distinct()
    x = R.asof_join(v, r, "domain", "loaded_at", "started_at", ["last_run"])
    return x.groupBy("domain", "last_run").agg(F.count(F.lit(1)).alias("visits"))


def set_operations(spark, d):
    a, b = _t(spark, d, "sitemaps").select("url"), _t(spark, d, "pages").select("url")
    tag = lambda x, t: x.groupBy().agg(F.count(F.lit(1)).alias("urls")).withColumn("what", F.lit(t))
    return tag(a.intersect(b), "both").unionByName(tag(a.subtract(b), "listed only")).unionByName(tag(b.subtract(a), "visited only"))


def rollup_counts(spark, d):
    return _latest_pages(spark, d, "domain page_role").rollup("domain", "page_role").agg(F.count(F.lit(1)).alias("pages"), F.grouping_id().cast("bigint").alias("level"))


QUERIES = {f.__name__: f for f in (site_totals, role_counts, pdf_status_rollup, unscored_docs_anti, known_pages_semi, docs_left_quality_queue, host_lookup_semi_reduced, export_skip_unchanged, tab_counts, export_counts, run_durations, latest_run_per_site, recent_runs_top20, docs_page_score_asc, docs_search, score_deltas, score_trail, confidence_buckets, gain_per_page, best_method, daily_visits, gone_by_window, page_upsert, replace_upsert, gone_marking, absent_marking, retention_expired, content_change_detection, reference_counts, dedup_first_wins, robots_allowed, visits_asof_run, set_operations, rollup_counts)}

_LP = "lp AS (SELECT m.* FROM (SELECT max(struct_pack(last_seen_at := last_seen_at, domain := domain, path_slug := path_slug, mime_type := mime_type, status_code := status_code, depth := depth, content_hash := content_hash, gone := gone, gone_since := gone_since, page_role := page_role, word_count_clean := word_count_clean, first_seen_at := first_seen_at, last_changed_at := last_changed_at, url := url)) AS m FROM pages GROUP BY url))"
_LQ = "lq AS (SELECT m.* FROM (SELECT max(struct_pack(scored_at := scored_at, composite_score := composite_score, pages := pages, has_text_layer := has_text_layer, pdf_title := pdf_title, ai_title := ai_title, skip := skip, excerpt := excerpt, readable_pages_pct := readable_pages_pct, ai_summary := ai_summary, url := url)) AS m FROM pdf_quality GROUP BY url))"
_LU = "lu AS (SELECT m.* FROM (SELECT max(struct_pack(batch_no := batch_no, queue_id := queue_id, status := status, before_score := before_score, after_score := after_score, url := url)) AS m FROM pdf_upgrade_queue GROUP BY url))"
_DIGEST = "nullif(regexp_replace(lower(trim({})), '^[a-z0-9-]+:', ''), '')"


def _h(x: str, n: int = 6) -> str:
    return f"floor(({x}) * 1e{n} + 0.5) / 1e{n}"


ORACLE = {
    "site_totals": f"WITH {_LP} SELECT domain, count(*) AS pages, count(*) FILTER (starts_with(mime_type, 'application/pdf')) AS pdf, count(*) FILTER (starts_with(mime_type, 'text/html')) AS html, count(*) FILTER (NOT starts_with(mime_type, 'text/html')) AS other FROM lp WHERE gone = 0 GROUP BY domain",
    "role_counts": f"WITH {_LP} SELECT domain, page_role, count(*) AS pages FROM lp WHERE gone = 0 GROUP BY ALL",
    "pdf_status_rollup": f"WITH {_LP}, {_LQ}, {_LU} SELECT lp.domain, count(*) AS scored, count(*) FILTER (lu.url IS NULL AND skip = 0 AND composite_score >= 0.7) AS already_ok, " + ", ".join(f"count(*) FILTER (status = '{s}') AS {s}" for s in ("pending", "submitted", "processing", "done", "failed")) + f", count(*) FILTER (status IN ('pending', 'submitted')) AS waiting, count(*) FILTER (skip = 1) AS skipped, count(ai_summary) AS summarized, count(*) FILTER (has_text_layer = 0 OR has_text_layer IS NULL OR readable_pages_pct < 0.4) AS image_pdfs, count(*) FILTER ((has_text_layer = 0 OR has_text_layer IS NULL OR readable_pages_pct < 0.4) AND ai_summary IS NOT NULL) AS image_pdfs_summarized, {_h('avg(composite_score)')} AS mean_score FROM lp JOIN lq ON lq.url = lp.url LEFT JOIN lu ON lu.url = lp.url WHERE gone = 0 GROUP BY lp.domain",
    "unscored_docs_anti": f"WITH {_LP} SELECT domain, url FROM lp WHERE gone = 0 AND mime_type LIKE 'application/pdf%' AND NOT EXISTS (SELECT 1 FROM pdf_quality q WHERE q.url = lp.url)",
    "known_pages_semi": "SELECT domain, count(*) AS known FROM (SELECT DISTINCT domain, url FROM sitemaps) s WHERE EXISTS (SELECT 1 FROM pages p WHERE p.url = s.url) GROUP BY domain",
    "docs_left_quality_queue": f"WITH {_LP}, {_LQ}, {_LU} SELECT lp.url, lp.domain, coalesce(ai_title, pdf_title, lp.url) AS title, coalesce(status, CASE WHEN composite_score IS NULL THEN 'unscored' ELSE 'scored' END) AS state, {_h('after_score - before_score')} AS improvement FROM lp LEFT JOIN lq ON lq.url = lp.url LEFT JOIN lu ON lu.url = lp.url WHERE mime_type LIKE 'application/pdf%'",
    "host_lookup_semi_reduced": "SELECT url, min(source_sitemap) AS source, min(first_seen_at) AS first_seen, count(*) AS listings FROM sitemaps s WHERE EXISTS (SELECT 1 FROM pdf_quality q WHERE q.url = s.url) GROUP BY url",
    "export_skip_unchanged": f"WITH {_LP}, r AS (SELECT url, {_DIGEST.format('content_hash')} AS digest FROM lp WHERE content_hash IS NOT NULL) SELECT url, digest FROM r WHERE NOT EXISTS (SELECT 1 FROM exports e WHERE e.status = 'ok' AND e.url = r.url AND {_DIGEST.format('e.source_hash')} = r.digest)",
    "tab_counts": f"WITH {_LQ}, {_LU} SELECT count(*) AS everything, count(*) FILTER (status IN ('done', 'processing')) AS upgraded, count(*) FILTER (status IN ('pending', 'submitted')) AS waiting, count(*) FILTER (status = 'failed') AS failed, count(*) FILTER (skip = 1) AS skipped FROM lq LEFT JOIN lu USING (url)",
    "export_counts": f"SELECT domain, count(*) FILTER (status = 'ok') AS ok, count(*) FILTER (status IS DISTINCT FROM 'ok') AS failed, CAST(sum(pages) AS BIGINT) AS pages, {_h('avg(agreement_avg)')} AS agreement, CAST(sum(ocr_used) AS BIGINT) AS ocr FROM (SELECT DISTINCT * FROM exports) GROUP BY domain",
    "run_durations": f"SELECT domain, count(*) AS runs, coalesce({_h('avg(epoch_us(finished_at) - epoch_us(started_at)) / 1e6', 3)}, 300.0) AS mean_seconds, arg_max(message, run_id) FILTER (status = 'failed') AS last_failure, bool_and(coalesce(status <> 'failed', true)) AS healthy FROM (SELECT DISTINCT * FROM runs) GROUP BY domain",
    "latest_run_per_site": "SELECT domain, m.run_id AS run_id, m.status AS status FROM (SELECT domain, max(struct_pack(run_id := run_id, status := status)) AS m FROM runs GROUP BY domain)",
    "recent_runs_top20": "WITH f AS (SELECT *, row_number() OVER (PARTITION BY domain ORDER BY run_id DESC) AS rn FROM (SELECT DISTINCT domain, run_id, started_at, status FROM runs)) SELECT domain, run_id, status, rn FROM (SELECT * FROM f WHERE rn <= 5 ORDER BY started_at DESC, run_id DESC LIMIT 20)",
    "docs_page_score_asc": f"WITH {_LQ} SELECT * FROM (SELECT row_number() OVER (ORDER BY composite_score, url) AS rn, url, composite_score FROM lq WHERE composite_score IS NOT NULL) WHERE rn BETWEEN 51 AND 100",
    "docs_search": f"WITH {_LQ} SELECT url FROM lq WHERE (url ILIKE '%garden%' OR ai_title ILIKE '%garden%' OR pdf_title ILIKE '%garden%' OR excerpt ILIKE '%garden%') AND (composite_score <= 0.9 OR composite_score IS NULL)",
    "score_deltas": f"WITH x AS (SELECT DISTINCT url, scored_at, composite_score FROM pdf_quality) SELECT url, scored_at, composite_score, {_h('composite_score - last_value(composite_score IGNORE NULLS) OVER (PARTITION BY url ORDER BY scored_at, composite_score NULLS FIRST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)')} AS delta FROM x",
    "score_trail": "WITH x AS (SELECT DISTINCT url, scored_at, composite_score FROM pdf_quality WHERE composite_score IS NOT NULL) SELECT url, string_agg(printf('%.4f', composite_score), '>' ORDER BY scored_at, composite_score) AS trail FROM x GROUP BY url",
    "confidence_buckets": "SELECT conversion_method, count(*) FILTER (agreement_avg >= 0.9) AS clean, count(*) FILTER (agreement_avg >= 0.6 AND agreement_avg < 0.9) AS fuzzy, count(*) FILTER (agreement_avg < 0.6) AS dirty FROM (SELECT DISTINCT * FROM exports WHERE agreement_avg IS NOT NULL) GROUP BY 1",
    "gain_per_page": f"SELECT method, count(*) AS documents, {_h('avg(pages_processed / nullif(score_improvement, 0.0))', 4)} AS pages_per_gain, {_h('avg(score_improvement)')} AS mean_gain FROM pdf_upgrade_queue WHERE status = 'done' GROUP BY method",
    "best_method": f"WITH g AS (SELECT domain, method, {_h('avg(score_improvement)')} AS gain FROM pdf_upgrade_queue WHERE status = 'done' AND method IS NOT NULL GROUP BY ALL) SELECT domain, m.method AS method, m.gain AS gain FROM (SELECT domain, max(struct_pack(gain := gain, method := method)) AS m FROM g WHERE gain IS NOT NULL GROUP BY domain)",
    "daily_visits": "SELECT substring(last_seen_at, 1, 10) AS day, count(*) AS visits, count(*) FILTER (status_code >= 400) AS errors FROM pages GROUP BY 1",
    "gone_by_window": f"WITH {_LP} SELECT domain, count(*) FILTER (substring(gone_since, 1, 10) >= '2025-02-15') AS gone, count(*) FILTER (substring(first_seen_at, 1, 10) >= '2025-02-15') AS fresh, min(gone_since) AS first_gone FROM lp GROUP BY domain",
    "page_upsert": """WITH p AS (SELECT DISTINCT url, domain, content_hash, first_seen_at, last_seen_at, last_changed_at, gone, gone_since, page_role, word_count_clean FROM pages),
m AS (SELECT url, last_seen_at >= '2025-03-01T00:00:00.000Z' AS fresh, max(struct_pack(last_seen_at := last_seen_at, domain := domain, content_hash := content_hash, first_seen_at := first_seen_at, last_changed_at := last_changed_at, gone := gone, gone_since := gone_since, page_role := page_role, word_count_clean := word_count_clean)) AS r FROM p GROUP BY ALL),
o AS (SELECT url, r.* FROM m WHERE NOT fresh), n AS (SELECT url, r.* FROM m WHERE fresh)
SELECT coalesce(o.url, n.url) AS url, CASE WHEN o.url IS NOT NULL AND n.url IS NOT NULL THEN coalesce(n.content_hash, o.content_hash) WHEN n.url IS NOT NULL THEN n.content_hash ELSE o.content_hash END AS content_hash,
 coalesce(o.first_seen_at, n.first_seen_at) AS first_seen_at, coalesce(n.last_seen_at, o.last_seen_at) AS last_seen_at,
 CASE WHEN o.url IS NULL THEN n.last_changed_at WHEN n.url IS NULL THEN o.last_changed_at WHEN n.content_hash IS NOT NULL AND n.content_hash IS DISTINCT FROM o.content_hash THEN n.last_seen_at ELSE o.last_changed_at END AS last_changed_at,
 CASE WHEN o.url IS NULL THEN n.gone WHEN n.url IS NULL THEN o.gone ELSE 0 END AS gone, CASE WHEN o.url IS NULL THEN n.gone_since WHEN n.url IS NULL THEN o.gone_since END AS gone_since,
 coalesce(n.page_role, o.page_role) AS page_role, coalesce(n.word_count_clean, o.word_count_clean) AS word_count_clean
FROM o FULL JOIN n ON o.url = n.url""",
    "replace_upsert": """WITH o AS (SELECT url, r.* FROM (SELECT url, max(struct_pack(scored_at := scored_at, composite_score := composite_score, ai_title := ai_title)) AS r FROM pdf_quality GROUP BY url))
SELECT url, CASE WHEN composite_score < 0.5 THEN '2025-05-01T00:00:00.000Z' ELSE scored_at END AS scored_at, CASE WHEN composite_score < 0.5 THEN composite_score * 2 ELSE composite_score END AS composite_score, CASE WHEN composite_score < 0.5 THEN NULL ELSE ai_title END AS ai_title FROM o""",
    "gone_marking": f"""WITH {_LP}, s AS (SELECT *, last_seen_at < '2025-03-01T00:00:00.000Z' AND coalesce(gone, 0) = 0 AND NOT EXISTS (SELECT 1 FROM pdf_upgrade_queue q WHERE q.url = lp.url AND q.status IN ('pending', 'processing', 'done')) AS stale FROM lp)
SELECT url, last_seen_at, CASE WHEN stale THEN 1 ELSE gone END AS gone, CASE WHEN stale THEN '2025-04-01T00:00:00.000Z' ELSE gone_since END AS gone_since FROM s""",
    "absent_marking": f"""WITH {_LP}, s AS (SELECT *, coalesce(gone, 0) = 0 AND NOT EXISTS (SELECT 1 FROM sitemaps q WHERE q.url = lp.url) AS absent FROM lp)
SELECT url, CASE WHEN absent THEN 1 ELSE gone END AS gone, CASE WHEN absent THEN '2025-04-01T00:00:00.000Z' ELSE gone_since END AS gone_since FROM s""",
    "retention_expired": f"WITH {_LP} SELECT url, gone_since FROM lp WHERE gone = 1 AND CAST(gone_since AS TIMESTAMPTZ) < CAST('2025-05-01T00:00:00.000Z' AS TIMESTAMPTZ) - INTERVAL 45 DAY",
    "content_change_detection": f"""WITH v AS (SELECT DISTINCT url, last_seen_at, content_hash, {_DIGEST.format('content_hash')} AS dg FROM pages),
b AS (SELECT *, last_value(dg IGNORE NULLS) OVER (PARTITION BY url ORDER BY last_seen_at, dg NULLS FIRST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS before FROM v)
SELECT CASE WHEN dg IS NULL THEN NULL WHEN before IS NULL THEN 'new' WHEN before = dg THEN 'unchanged' ELSE 'changed' END AS content_state, count(*) AS visits FROM b GROUP BY 1""",
    "reference_counts": "SELECT source_sitemap AS node, count(DISTINCT url) AS ref_count FROM sitemaps WHERE source_sitemap IS NOT NULL AND url IS NOT NULL GROUP BY 1",
    "dedup_first_wins": "SELECT 'sha256:' || sha256(text) AS digest, min(doc_id) AS first_doc, count(*) AS copies FROM documents WHERE text IS NOT NULL GROUP BY 1",
    "robots_allowed": r"WITH x AS (SELECT DISTINCT url, CASE WHEN regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1) = '' THEN '/' ELSE regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1) END AS path FROM pages) SELECT url FROM x WHERE NOT (starts_with(path, '/node') OR starts_with(path, '/talks/19') OR starts_with(path, '/reports/20'))",
    "visits_asof_run": "WITH v AS (SELECT DISTINCT domain, url, loaded_at FROM pages), r AS (SELECT DISTINCT domain, started_at, run_id FROM runs WHERE status = 'success') SELECT v.domain, r.run_id AS last_run, count(*) AS visits FROM v ASOF LEFT JOIN r ON v.domain = r.domain AND v.loaded_at >= r.started_at GROUP BY ALL",
    "set_operations": "SELECT 'both' AS what, count(*) AS urls FROM (SELECT url FROM sitemaps INTERSECT SELECT url FROM pages) UNION ALL SELECT 'listed only', count(*) FROM (SELECT url FROM sitemaps EXCEPT SELECT url FROM pages) UNION ALL SELECT 'visited only', count(*) FROM (SELECT url FROM pages EXCEPT SELECT url FROM sitemaps)",
    "rollup_counts": f"WITH {_LP} SELECT domain, page_role, count(*) AS pages, grouping_id(domain, page_role) AS level FROM lp GROUP BY ROLLUP (domain, page_role)",
}
