"""Lists of documents, retention, receipts and run states over the archive's tables, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from archivolt.functions.digests import canonical_digest
from archivolt.operators import listing as L, merge as M, receipts as C, relational as R
from archivolt.plans.report_queries import _DIGEST, _LP, _h, _latest_pages, _r, _t
from archivolt.plans.text_queries import ORACLE as TEXT_SQL


def _documents(spark, d):
    q = R.latest(_t(spark, d, "pdf_quality").select("url", "scored_at", "composite_score", "pages", "has_text_layer", "readable_pages_pct", "pdf_title", "ai_title", "skip", "excerpt", "ai_summary", "summary_tier", "ai_language"), ["url"], ["scored_at"])
    u = R.latest(_t(spark, d, "pdf_upgrade_queue").select("url", "batch_no", "queue_id", "status", "before_score", "after_score", "score_improvement", "priority", "finished_at"), ["url"], ["batch_no", "queue_id"])
    return L.joined(_latest_pages(spark, d, "domain path_slug gone mime_type"), q, u)


def _page(spark, d, sort, page, **filters):
    return L.listed(_documents(spark, d), sort, page, **filters).select(F.col("rn").cast("bigint").alias("rn"), "url", "status")


def list_score_desc(spark, d):
    return _page(spark, d, "score_desc", 2)


def list_score_asc(spark, d):
    return _page(spark, d, "score_asc", 1, score_max=0.8)


def list_pages_desc(spark, d):
    return _page(spark, d, "pages_desc", 3)


def list_title_asc(spark, d):
    return _page(spark, d, "title_asc", 1, search="report")


def list_improved_desc(spark, d):
    return _page(spark, d, "improved_desc", 1)


def list_upgraded(spark, d):
    return _page(spark, d, None, 1, tab="upgraded")


def list_by_priority(spark, d):
    return _page(spark, d, None, 0)


def list_unscored(spark, d):
    return _page(spark, d, "title_asc", 1, status="unscored")


def list_skipped(spark, d):
    return _page(spark, d, "title_asc", 1, status="skipped")


def list_failed(spark, d):
    return _page(spark, d, "title_asc", 1, status="failed")


def list_sizes(spark, d):
    x = _documents(spark, d)
    out = None
    for name, told in (("all", {}), ("upgraded", {"tab": "upgraded"}), ("unscored", {"status": "unscored"}), ("done", {"status": "done"}), ("low", {"score_max": 0.5})):
        part = L.sizes(x, **told).withColumn("list", F.lit(name))
        out = part if out is None else out.unionByName(part)
    return out


def list_rows(spark, d):
    x = L.row_shown(_documents(spark, d))
    return x.select("url", "title", "summary", "summary_tier", "pdf_type", "pages_needed", _r(F.col("before")).alias("before"), _r(F.col("after")).alias("after"), _r(F.col("improvement")).alias("improvement"))


def list_languages(spark, d):
    return L.row_shown(_documents(spark, d)).select("url", "language")


def list_hosts(spark, d):
    hosts = _t(spark, d, "sitemaps").where("url IS NOT NULL").select(F.col("source_sitemap").alias("host_url"), F.col("url").alias("hosted_url"))
    return L.with_hosts(L.listed(_documents(spark, d), "score_asc", 2).select("url"), hosts)


def retention_two_runs(spark, d):
    p = _latest_pages(spark, d, "domain local_path gone gone_since").select("url", "domain", "local_path", "gone", "gone_since", F.lit(0).alias("archive_only"))
    return M.retained(M.retained(p, "2025-03-15T00:00:00.000Z", 20, 60), "2025-04-15T00:00:00.000Z", 20, 60).select("url", "local_path", "archive_only")


def degradation_freeze(spark, d):
    return M.degradation(_latest_pages(spark, d, "domain gone gone_since first_seen_at"), "2025-03-15T00:00:00.000Z", 30, 0.02, 1)


def sitemap_upsert(spark, d):
    s = _t(spark, d, "sitemaps").select("url", "snapshot_no", "last_seen_at", "lastmod", "source_sitemap", "first_seen_at", "removed", "removed_at").where("url IS NOT NULL").distinct()
    old = M.last_per_key(s.where("snapshot_no <= 4").drop("snapshot_no"), ["url"], ["last_seen_at"])
    new = M.last_per_key(s.where("snapshot_no > 4").drop("snapshot_no"), ["url"], ["last_seen_at"])
    return M.upsert_sitemaps(old, new)


def asset_upsert(spark, d):
    p = _t(spark, d, "pages").where("content_hash IS NOT NULL").select(canonical_digest(F.col("content_hash")).alias("hash"), F.col("mime_type"), "last_seen_at", F.lit(None).cast("string").alias("gone_since")).where("hash IS NOT NULL").distinct()
    old = M.last_per_key(p.where(F.col("last_seen_at") < "2025-03-01"), ["hash"], ["last_seen_at"]).withColumn("gone_since", F.lit("2025-02-28"))
    new = M.last_per_key(p.where(F.col("last_seen_at") >= "2025-03-01"), ["hash"], ["last_seen_at"])
    return M.upsert_assets(old, new)


def setting_upsert(spark, d):
    r = _t(spark, d, "runs").where("domain IS NOT NULL").select("domain", F.lit("last_run").alias("key"), F.col("run_id").cast("string").alias("value"), F.col("run_id").alias("n"), "status").distinct()
    return M.put_values(M.last_per_key(r.where("n % 2 = 0").drop("status"), ["domain", "key"], ["n"]).drop("n"), r.where("status = 'success'").drop("status"), "n")


def run_states(spark, d):
    r = _t(spark, d, "runs").where("run_id IS NOT NULL").select("run_id", "domain", "status").distinct().withColumn("status", F.when(F.col("run_id") % 5 == 0, "running").otherwise(F.col("status")))
    r = r.select("run_id", "domain", F.lit(None).cast("timestamp_ntz").alias("started_at"), F.lit(None).cast("timestamp_ntz").alias("finished_at"), "status", F.lit(None).cast("string").alias("message"))
    first = r.orderBy("domain").select("domain").first()
    opened = M.run_opened(r, first[0] if first else "none", 10**9, "2025-05-01 00:00:00")
    return M.run_closed(opened, 10**9, "2025-05-01 01:00:00", status="success", message="fine").select("run_id", "domain", "status", "message", F.date_format("finished_at", "HH:mm").alias("finished"))


def content_hash_reuse(spark, d):
    x = _t(spark, d, "pdf_quality").where("content_hash IS NOT NULL AND domain IS NOT NULL").select("domain", "url", canonical_digest(F.col("content_hash")).alias("digest"), "ai_summary")
    return R.first_elsewhere(x, "digest", "domain", "url", F.col("ai_summary").isNotNull()).select("digest", "url", "source_domain", "source_url")


def low_score_candidates(spark, d):
    x = _documents(spark, d).where("(status IS NULL OR status NOT IN ('done', 'submitted')) AND composite_score IS NOT NULL")
    return x.orderBy("composite_score", "url").limit(1000).select("url", "composite_score")


def smallest_first(spark, d):
    f = _t(spark, d, "md_texts").where("md_path IS NOT NULL").distinct().groupBy("md_path").agg(F.sum(F.length("md_text")).alias("chars"))
    return f.orderBy(F.col("chars").asc_nulls_first(), "md_path").limit(20)


def visit_order(spark, d):
    seen = _t(spark, d, "pages").select("url").distinct().withColumn("known", F.lit(True))
    x = _t(spark, d, "sitemaps").where("url IS NOT NULL").groupBy("url").agg(F.min("first_seen_at").alias("arrived")).join(seen, "url", "left")
    first = x.withColumn("class", F.when(F.col("known"), 1).otherwise(0)).orderBy("class", "arrived", "url").limit(200)
    return first.select("url", "class", "arrived")


def upgraded_counts(spark, d):
    p = _latest_pages(spark, d, "domain gone mime_type").where("gone = 0 AND mime_type = 'application/pdf'").select("url", "domain")
    u = _t(spark, d, "pdf_upgrade_queue").where("status = 'done'").select("url").distinct()
    return u.join(p, "url").groupBy("domain").agg(F.count(F.lit(1)).alias("upgraded"))


def recent_failures(spark, d):
    r = _t(spark, d, "runs").where("status = 'failed'").select("run_id", "domain", "started_at").distinct()
    return r.where(F.col("started_at") > F.to_timestamp_ntz(F.lit("2025-03-01 00:00:00")) - F.make_dt_interval(F.lit(10))).groupBy("domain").agg(F.count(F.lit(1)).alias("failures"))


def queue_eta(spark, d):
    u = _t(spark, d, "pdf_upgrade_queue").select("domain", "status", "started_at", "finished_at")
    secs = (F.unix_micros(F.try_to_timestamp("finished_at")) - F.unix_micros(F.try_to_timestamp("started_at"))) / 1e6
    x = u.groupBy("domain").agg(F.avg(F.when(F.col("status") == "done", secs)).alias("m"), F.count_if(F.col("status").isin("pending", "submitted")).alias("waiting"))
    mean = F.coalesce(F.nullif(F.col("m"), F.lit(0.0)), F.lit(300.0))
    return x.select("domain", "waiting", _r(mean, 3).alias("mean_seconds"), _r(F.col("waiting") * mean, 3).alias("eta_seconds"))


def errors_by_stage(spark, d):
    u = _t(spark, d, "pdf_upgrade_queue").where("status = 'failed'")
    return u.groupBy(F.coalesce(F.regexp_extract("error", "^[^: ]+", 0), F.lit("")).alias("code"), F.col("pass").alias("stage")).agg(F.count(F.lit(1)).alias("errors"))


def receipt_view(spark, d):
    return C.receipt_steps(C.receipts(_t(spark, d, "pdf_upgrade_queue")), "queue_id", "receipt")


def receipt_decisions(spark, d):
    return C.receipt_decisions(C.receipts(_t(spark, d, "pdf_upgrade_queue")), "queue_id", "receipt")


def preliminary_exports(spark, d):
    e = _t(spark, d, "exports").where("url IS NOT NULL").select("url", "exported_at", "source_hash", "md_hash", "status").distinct()
    first = M.last_per_key(e.where("source_hash IS NULL"), ["url"], ["exported_at"])
    final = M.last_per_key(e.where("source_hash IS NOT NULL"), ["url"], ["exported_at"])
    return M.upsert(first, final, ["url"], mode="replace").withColumn("preliminary", F.col("source_hash").isNull().cast("int"))


QUERIES = {f.__name__: f for f in (list_score_desc, list_score_asc, list_pages_desc, list_title_asc, list_improved_desc, list_upgraded, list_by_priority, list_unscored, list_skipped, list_failed, list_sizes, list_rows, list_languages, list_hosts, retention_two_runs, degradation_freeze, sitemap_upsert, asset_upsert, setting_upsert, run_states, content_hash_reuse, low_score_candidates, smallest_first, visit_order, upgraded_counts, recent_failures, queue_eta, errors_by_stage, receipt_view, receipt_decisions, preliminary_exports)}

_DOCS = f"""{_LP}, lq AS (SELECT m.* FROM (SELECT max(struct_pack(scored_at := scored_at, composite_score := composite_score, pages := pages, has_text_layer := has_text_layer, readable_pages_pct := readable_pages_pct, pdf_title := pdf_title, ai_title := ai_title, skip := skip, excerpt := excerpt, ai_summary := ai_summary, summary_tier := summary_tier, ai_language := ai_language, url := url)) AS m FROM pdf_quality GROUP BY url)),
lu AS (SELECT m.* FROM (SELECT max(struct_pack(batch_no := batch_no, queue_id := queue_id, status := status, before_score := before_score, after_score := after_score, score_improvement := score_improvement, priority := priority, finished_at := finished_at, url := url)) AS m FROM pdf_upgrade_queue GROUP BY url)),
docs AS (SELECT lp.url, lp.domain, CASE WHEN isnan(composite_score) THEN NULL ELSE composite_score END AS composite_score, pages, has_text_layer, CASE WHEN isnan(readable_pages_pct) THEN NULL ELSE readable_pages_pct END AS readable, pdf_title, ai_title, skip, excerpt, ai_summary, summary_tier, ai_language, status, before_score, after_score, score_improvement, priority, finished_at
 FROM lp LEFT JOIN lq ON lq.url = lp.url LEFT JOIN lu ON lu.url = lp.url WHERE lp.gone = 0 AND lp.mime_type = 'application/pdf')"""
_UP = "(status = 'done' OR (status IN ('pending', 'submitted') AND after_score IS NOT NULL))"


def _list(order: str, page: int = 1, where: str = "true") -> str:
    return f"WITH {_DOCS}, n AS (SELECT row_number() OVER (ORDER BY {order}, url) AS rn, url, status FROM docs WHERE {where}) SELECT rn, url, status FROM n WHERE rn BETWEEN {50 * page - 49} AND {50 * page}"


_TITLES = TEXT_SQL["titles_from_urls"].split("WITH r AS", 1)[1].split("SELECT doc_id, nullif", 1)[0]
_TITLE_OF = "nullif(" + TEXT_SQL["titles_from_urls"].split("SELECT doc_id, nullif(", 1)[1].split(" AS title, CAST", 1)[0]
_RETAIN = "before({0})"
_SMAP = "SELECT url, max(struct_pack(last_seen_at := last_seen_at, lastmod := lastmod, source_sitemap := source_sitemap, first_seen_at := first_seen_at, removed := removed, removed_at := removed_at)) AS r FROM sitemaps WHERE url IS NOT NULL AND snapshot_no {} 4 GROUP BY url"
_DETECTED = TEXT_SQL["detect_language"].split("WITH ", 1)[1].split(" SELECT doc_id, language", 1)[0]
_SHOWN = f"""{_DOCS}, a AS (SELECT *, coalesce(ai_title, pdf_title) AS raw, CASE WHEN regexp_extract(url, '[?&]dl=([^&#]+)', 1) <> '' THEN regexp_extract(url, '[?&]dl=([^&#]+)', 1) ELSE regexp_extract(regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1), '([^/]*)$', 1) END AS part FROM docs),
b AS (SELECT *, nullif(trim(array_to_string(list_transform(string_split(regexp_replace(regexp_replace(regexp_replace(part, '(?i)\\.pdf$', ''), '^\\d{{8,}}-', ''), '[-_]', ' ', 'g'), ' '), lambda w: upper(substring(w, 1, 1)) || substring(w, 2)), ' ')), '') AS made,
 CASE WHEN length(excerpt) > 160 THEN regexp_replace(substring(excerpt, 1, 160), '\\s+\\S*$', '') || '…' ELSE excerpt END AS cut, least(after_score, 1.0) AS after FROM a),
c AS (SELECT *, CASE WHEN raw IS NULL OR length(raw) <= 5 OR lower(trim(raw)) = 'pdf' THEN coalesce(made, raw) ELSE raw END AS title,
 nullif(concat_ws(' ', nullif(concat_ws(' — ', nullif(trim(pdf_title), ''), nullif(trim(cut), '')), ''), '[' || domain || ']'), '') AS free,
 coalesce(before_score, composite_score, greatest(0.0, after - score_improvement)) AS before FROM b)"""

_EVERY = "SELECT *, {0} AS list FROM (SELECT count(*) AS total, CAST(ceil(count(*) / 50) AS BIGINT) AS pages, 50 AS per_page FROM docs WHERE {1})"

ORACLE = {
    "list_score_desc": _list("coalesce(composite_score, 0) DESC", 2),
    "list_score_asc": _list("coalesce(composite_score, 1)", 1, "composite_score IS NULL OR composite_score <= 0.8"),
    "list_pages_desc": _list("coalesce(pages, 0) DESC", 3),
    "list_title_asc": _list("coalesce(ai_title, pdf_title, url)", 1, "url ILIKE '%report%' OR ai_title ILIKE '%report%' OR pdf_title ILIKE '%report%' OR excerpt ILIKE '%report%'"),
    "list_improved_desc": _list("coalesce(score_improvement, 0) DESC"),
    "list_upgraded": _list("CASE status WHEN 'submitted' THEN 0 WHEN 'pending' THEN 1 WHEN 'done' THEN 2 ELSE 3 END, finished_at DESC NULLS LAST", 1, _UP),
    "list_by_priority": _list("coalesce(priority, coalesce(composite_score, 0.5) * 100) DESC"),
    "list_unscored": _list("coalesce(ai_title, pdf_title, url)", 1, "composite_score IS NULL"),
    "list_skipped": _list("coalesce(ai_title, pdf_title, url)", 1, "skip = 1"),
    "list_failed": _list("coalesce(ai_title, pdf_title, url)", 1, "status = 'failed'"),
    "list_sizes": f"WITH {_DOCS} " + " UNION ALL ".join(_EVERY.format(f"'{n}'", w) for n, w in (("all", "true"), ("upgraded", _UP), ("unscored", "composite_score IS NULL"), ("done", "status = 'done'"), ("low", "composite_score IS NULL OR composite_score <= 0.5"))),
    "list_rows": f"WITH {_SHOWN} SELECT url, title, coalesce(ai_summary, free) AS summary, coalesce(summary_tier, CASE WHEN ai_summary IS NULL AND free IS NOT NULL THEN 'free' END) AS summary_tier, CASE WHEN NOT coalesce(has_text_layer = 1, false) OR readable < 0.3 THEN 'image' WHEN readable < 0.7 THEN 'mixed' ELSE 'text' END AS pdf_type, CAST(floor(coalesce(pages, 0) * (1 - coalesce(readable, 0.0)) + 0.5) AS BIGINT) AS pages_needed, {_h('before')} AS before, {_h('after')} AS after, {_h('after - before')} AS improvement FROM c",
    "list_languages": f"WITH {_SHOWN}, d AS (SELECT url, nullif(lower(trim(ai_language)), '') AS l, concat_ws(' ', excerpt, title) AS text FROM c), {_DETECTED.replace('FROM documents', 'FROM d')} SELECT url, coalesce(CASE l WHEN 'ar' THEN 'arabic' WHEN 'fa' THEN 'persian' WHEN 'he' THEN 'hebrew' WHEN 'fr' THEN 'french' WHEN 'es' THEN 'spanish' WHEN 'de' THEN 'german' WHEN 'it' THEN 'italian' WHEN 'pt' THEN 'portuguese' WHEN 'nl' THEN 'dutch' WHEN 'pl' THEN 'polish' WHEN 'tr' THEN 'turkish' WHEN 'ru' THEN 'russian' WHEN 'ja' THEN 'japanese' WHEN 'zh' THEN 'chinese' WHEN 'ko' THEN 'korean' WHEN 'en' THEN 'english' ELSE l END, language) AS language FROM detected",
    "list_hosts": f"WITH p AS ({_list('coalesce(composite_score, 1)', 2)}) SELECT url, (SELECT min(source_sitemap) FROM sitemaps s WHERE s.url = p.url) AS source_url FROM p",
    "retention_two_runs": f"WITH {_LP}, p AS (SELECT p.url, p.gone, CAST(p.gone_since AS TIMESTAMPTZ) AS g, r.local_path FROM lp p JOIN (SELECT url, max(struct_pack(last_seen_at := last_seen_at, domain := domain, local_path := local_path)).local_path AS local_path FROM pages GROUP BY url) r ON r.url = p.url), s AS (SELECT url, local_path, coalesce(gone = 1 AND g < TIMESTAMPTZ '2025-02-23 00:00:00+00', false) AS one, coalesce(gone = 1 AND g < TIMESTAMPTZ '2025-03-26 00:00:00+00', false) AS two, coalesce(gone = 1 AND g < TIMESTAMPTZ '2025-02-14 00:00:00+00', false) AS dropped FROM p) SELECT url, CASE WHEN NOT two THEN local_path END AS local_path, CAST(two AS INTEGER) AS archive_only FROM s WHERE NOT dropped",
    "degradation_freeze": f"WITH {_LP}, x AS (SELECT domain, count(*) FILTER (gone = 1 AND CAST(gone_since AS TIMESTAMPTZ) >= TIMESTAMPTZ '2025-02-13 00:00:00+00') AS lost, count(*) FILTER (gone = 0 AND CAST(first_seen_at AS TIMESTAMPTZ) >= TIMESTAMPTZ '2025-02-13 00:00:00+00') AS added, count(*) FILTER (gone = 0) AS present FROM lp GROUP BY domain) SELECT *, lost - added > greatest(present * CAST(0.02 AS DOUBLE), 1.0) AS frozen FROM x",
    "sitemap_upsert": f"WITH o AS ({_SMAP.format('<=')}), n AS ({_SMAP.format('>')}) SELECT coalesce(o.url, n.url) AS url, CASE WHEN n.url IS NULL THEN o.r.last_seen_at ELSE n.r.last_seen_at END AS last_seen_at, CASE WHEN n.url IS NULL THEN o.r.lastmod ELSE n.r.lastmod END AS lastmod, CASE WHEN n.url IS NULL THEN o.r.source_sitemap ELSE n.r.source_sitemap END AS source_sitemap, CASE WHEN o.url IS NULL THEN n.r.first_seen_at ELSE o.r.first_seen_at END AS first_seen_at, CASE WHEN o.url IS NOT NULL AND n.url IS NOT NULL THEN 0 WHEN n.url IS NULL THEN o.r.removed ELSE n.r.removed END AS removed, CASE WHEN o.url IS NOT NULL AND n.url IS NOT NULL THEN NULL WHEN n.url IS NULL THEN o.r.removed_at ELSE n.r.removed_at END AS removed_at FROM o FULL JOIN n ON o.url = n.url",
    "asset_upsert": f"WITH p AS (SELECT {_DIGEST.format('content_hash')} AS hash, mime_type, last_seen_at FROM pages), g AS (SELECT hash, last_seen_at >= '2025-03-01' AS fresh, max(struct_pack(last_seen_at := last_seen_at, mime_type := mime_type)) AS r FROM p WHERE hash IS NOT NULL GROUP BY ALL), o AS (SELECT * FROM g WHERE NOT fresh), n AS (SELECT * FROM g WHERE fresh) SELECT coalesce(o.hash, n.hash) AS hash, CASE WHEN o.hash IS NULL THEN n.r.mime_type ELSE o.r.mime_type END AS mime_type, CASE WHEN n.hash IS NULL THEN o.r.last_seen_at ELSE n.r.last_seen_at END AS last_seen_at, CASE WHEN n.hash IS NULL THEN '2025-02-28' END AS gone_since FROM o FULL JOIN n ON o.hash = n.hash",
    "setting_upsert": "WITH o AS (SELECT domain, max(run_id) AS v FROM runs WHERE domain IS NOT NULL AND run_id % 2 = 0 GROUP BY 1), n AS (SELECT domain, max(run_id) AS v FROM runs WHERE domain IS NOT NULL AND status = 'success' GROUP BY 1) SELECT coalesce(n.domain, o.domain) AS domain, 'last_run' AS key, CAST(coalesce(n.v, o.v) AS VARCHAR) AS value FROM o FULL JOIN n ON o.domain = n.domain",
    "run_states": "WITH f AS (SELECT min(domain) AS f FROM runs WHERE run_id IS NOT NULL), x AS (SELECT DISTINCT run_id, domain, CASE WHEN run_id % 5 = 0 THEN 'running' ELSE status END AS status FROM runs WHERE run_id IS NOT NULL) SELECT run_id, domain, CASE WHEN domain = f AND status = 'running' THEN 'interrupted' ELSE status END AS status, NULL AS message, CASE WHEN domain = f AND status = 'running' THEN '00:00' END AS finished FROM x, f UNION ALL SELECT 1000000000, f, 'success', 'fine', '01:00' FROM f",
    "content_hash_reuse": f"WITH x AS (SELECT domain, url, {_DIGEST.format('content_hash')} AS digest, ai_summary FROM pdf_quality WHERE domain IS NOT NULL), f AS (SELECT digest, domain, min(url) AS url FROM x WHERE ai_summary IS NOT NULL GROUP BY ALL), n AS (SELECT DISTINCT digest, domain, url FROM x WHERE ai_summary IS NULL AND digest IS NOT NULL), j AS (SELECT n.digest, n.url, min(struct_pack(d := f.domain, u := f.url)) AS s FROM n JOIN f ON f.digest = n.digest AND f.domain <> n.domain GROUP BY ALL) SELECT digest, url, s.d AS source_domain, s.u AS source_url FROM j",
    "low_score_candidates": f"WITH {_DOCS} SELECT url, composite_score FROM docs WHERE (status IS NULL OR status NOT IN ('done', 'submitted')) AND composite_score IS NOT NULL ORDER BY composite_score, url LIMIT 1000",
    "smallest_first": "SELECT md_path, CAST(sum(length(md_text)) AS BIGINT) AS chars FROM (SELECT DISTINCT * FROM md_texts WHERE md_path IS NOT NULL) GROUP BY 1 ORDER BY 2 NULLS FIRST, 1 LIMIT 20",
    "visit_order": "WITH x AS (SELECT url, min(first_seen_at) AS arrived FROM sitemaps WHERE url IS NOT NULL GROUP BY url) SELECT url, CASE WHEN EXISTS (SELECT 1 FROM pages p WHERE p.url = x.url) THEN 1 ELSE 0 END AS class, arrived FROM x ORDER BY 2, 3 NULLS FIRST, 1 LIMIT 200",
    "upgraded_counts": f"WITH {_LP} SELECT domain, count(*) AS upgraded FROM lp WHERE gone = 0 AND mime_type = 'application/pdf' AND url IN (SELECT url FROM pdf_upgrade_queue WHERE status = 'done') GROUP BY domain",
    "recent_failures": "SELECT domain, count(*) AS failures FROM (SELECT DISTINCT run_id, domain, started_at FROM runs WHERE status = 'failed') WHERE started_at > TIMESTAMP '2025-02-19 00:00:00' GROUP BY domain",
    "queue_eta": f"WITH x AS (SELECT domain, avg((epoch_us(try_cast(finished_at AS TIMESTAMPTZ)) - epoch_us(try_cast(started_at AS TIMESTAMPTZ))) / 1e6) FILTER (status = 'done') AS m, count(*) FILTER (status IN ('pending', 'submitted')) AS waiting FROM pdf_upgrade_queue GROUP BY domain) SELECT domain, waiting, {_h('coalesce(nullif(m, 0), 300.0)', 3)} AS mean_seconds, {_h('waiting * coalesce(nullif(m, 0), 300.0)', 3)} AS eta_seconds FROM x",
    "errors_by_stage": "SELECT coalesce(regexp_extract(error, '^[^: ]+'), '') AS code, pass AS stage, count(*) AS errors FROM pdf_upgrade_queue WHERE status = 'failed' GROUP BY ALL",
    "receipt_view": "WITH q AS (SELECT queue_id, before_score AS b, after_score AS a, pages_processed AS n FROM pdf_upgrade_queue WHERE status = 'done'), s AS (SELECT queue_id, unnest([{'step': 's3', 'score': (coalesce(b, 0) + coalesce(a, 0)) / 2, 'pages': coalesce(n, 0)}, {'step': 's4', 'score': NULL, 'pages': 1}, {'step': 's6', 'score': a, 'pages': coalesce(n, 0)}]) AS x, b, a FROM q) SELECT queue_id, x.step AS step, x.pages AS pages, floor((CASE x.step WHEN 's3' THEN x.score - b WHEN 's6' THEN x.score - (coalesce(b, 0) + coalesce(a, 0)) / 2 END) * 100 + 0.5) AS delta FROM s WHERE x.pages > 0",
    "receipt_decisions": "SELECT queue_id, 'surya,tesseract' AS engines, CAST(coalesce(pages_processed, 0) + 3 AS BIGINT) AS blocks, CAST(2 AS BIGINT) AS consensus, CAST(CASE WHEN queue_id % 2 = 0 THEN 4 ELSE 0 END AS BIGINT) AS synthesised FROM pdf_upgrade_queue WHERE status = 'done'",
    "preliminary_exports": "WITH e AS (SELECT DISTINCT url, exported_at, source_hash, md_hash, status FROM exports WHERE url IS NOT NULL), f AS (SELECT url, max(struct_pack(exported_at := exported_at, source_hash := source_hash, md_hash := md_hash, status := status)) FILTER (source_hash IS NOT NULL) AS a, max(struct_pack(exported_at := exported_at, source_hash := source_hash, md_hash := md_hash, status := status)) FILTER (source_hash IS NULL) AS b FROM e GROUP BY url) SELECT url, r.exported_at AS exported_at, r.source_hash AS source_hash, r.md_hash AS md_hash, r.status AS status, CAST(r.source_hash IS NULL AS INTEGER) AS preliminary FROM (SELECT url, coalesce(a, b) AS r FROM f)",
}
