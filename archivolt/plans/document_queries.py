"""Assets, summaries and JSON over the archive's tables, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from archivolt.functions import summaries as S
from archivolt.functions.constants import WS
from archivolt.operators import assets as A, relational as R
from archivolt.plans.web_queries import PAGE
from archivolt.schemas import conform


def _t(spark, d, name):
    return spark.read.parquet(f"{d}/{name}.parquet")


def asset_paths(spark, d):
    x = _t(spark, d, "documents").where("text IS NOT NULL")
    path = A.store_path(F.col("text").cast("binary"), F.lit(".txt"))
    return x.groupBy(path.alias("path")).agg(F.count(F.lit(1)).alias("ref_count"), F.min("doc_id").alias("first_doc"))


def asset_kinds(spark, d):
    from archivolt.functions import urls as U

    x = _t(spark, d, "pages").select("url", "mime_type").distinct()
    return x.groupBy(A.kind(F.col("mime_type"), U.extension(U.path(F.col("url")))).alias("kind")).agg(F.count(F.lit(1)).alias("pages"))


def local_images(spark, d):
    x = _t(spark, d, "documents").select("doc_id", F.concat(F.lit("a ![p](https://x.example/"), (F.col("doc_id") % 10).cast("string"), F.lit(".png) b ![q](https://x.example/missing.png)")).alias("md"))
    assets = spark.range(0, 10, 2).select(F.concat(F.lit("https://x.example/"), "id", F.lit(".png")).alias("original_url"), F.concat(F.lit("_assets/"), "id", F.lit(".png")).alias("path"))
    return A.with_local_images(x, "doc_id", "md", assets).select("doc_id", "md")


def free_summaries(spark, d):
    x = R.latest(_t(spark, d, "pdf_quality").select("url", "scored_at", "pdf_title", "excerpt", "domain"), ["url"], ["scored_at"])
    return x.select("url", S.free_summary(F.col("pdf_title"), F.col("excerpt"), F.col("domain")).alias("summary"))


def summary_prompts(spark, d):
    x = R.latest(_t(spark, d, "pdf_quality").select("url", "scored_at", "pdf_title", "ai_title", "excerpt"), ["url"], ["scored_at"])
    return x.select("url", S.prompt([("Title", F.coalesce("ai_title", "pdf_title")), ("Excerpt", F.col("excerpt"))]).alias("prompt"))


def link_contexts(spark, d):
    x = _t(spark, d, "documents").select("doc_id", F.expr(PAGE).alias("html"))
    file = lambda name: S.link_context(F.col("html"), F.concat(F.lit("https://x.example/files/"), name))
    return x.select("doc_id", file(F.concat(F.col("doc_id").cast("string"), F.lit(".pdf"))).alias("context"), file(F.lit("Untitled%3C%2fh1")).alias("decoded"))


def quality_average(spark, d):
    x = _t(spark, d, "pdf_quality").where("composite_score IS NOT NULL AND domain IS NOT NULL").select("domain", "scored_at", "url", "composite_score").distinct()
    return R.moving_average(x, "domain", ["scored_at", "url", "composite_score"], "composite_score").select("domain", (F.floor(F.col("average") * 1e6 + 0.5) / 1e6).alias("average"))


def event_props(spark, d):
    x = _t(spark, d, "events").select("event_type", F.from_json("props", "k bigint").alias("p"), "value")
    return x.groupBy("event_type").agg(F.sum("p.k").alias("k"), F.count_if(F.col("p.k").isNull()).alias("without"), F.max("p.k").alias("largest"))


def conformed_pages(spark, d):
    x = conform(_t(spark, d, "pages").drop("depth").withColumn("extra", F.lit(1)), "pages")
    return x.agg(F.count(F.lit(1)).alias("rows"), F.count("depth").alias("depths"), F.count("url").alias("urls"))


QUERIES = {f.__name__: f for f in (asset_paths, asset_kinds, local_images, free_summaries, summary_prompts, link_contexts, quality_average, event_props, conformed_pages)}

_LQ = "SELECT url, max(struct_pack(scored_at := scored_at, {})) AS r FROM pdf_quality GROUP BY url"



def _context(at: str) -> str:
    """SQL of the text around the place `at` of `html`; the paragraph's tags count within 1,000 characters."""
    head = f"substring(html, 1, {at} + 1)"
    opens = f"(CASE WHEN contains({head}, '<p') THEN length({head}) - strpos(reverse({head}), 'p<') END)"
    closes = f"nullif(strpos(substring(html, {at}), '</p>') + {at} - 1, {at} - 1)"
    start = f"(CASE WHEN {opens} > 1 AND {opens} > {at} - 1000 THEN {opens} ELSE greatest(1, {at} - 400) END)"
    end = f"(CASE WHEN {closes} > 1 AND {closes} < {at} + 1000 THEN {closes} + 4 ELSE least(length(html) + 1, {at} + 400) END)"
    text = f"substring(html, {start}, {end} - {start})"
    for tag in ("style", "script"):
        text = f"regexp_replace({text}, '(?i)<{tag}[^>]*>[\\s\\S]*?</{tag}>', ' ', 'g')"
    text = f"regexp_replace({text}, '<[^>]+>', ' ', 'g')"
    for name, sign in (("&amp;", "&"), ("&gt;", ">"), ("&lt;", "<"), ("&nbsp;", " ")):
        text = f"replace({text}, '{name}', '{sign}')"
    text = f"regexp_replace(regexp_replace(regexp_replace({text}, '&#\\d+;', ' ', 'g'), '{WS}+', ' ', 'g'), '^ | $', '', 'g')"
    return f"CASE WHEN {at} > 7 THEN trim(substring({text}, 1, 600)) END"


ORACLE = {
    "asset_paths": "SELECT '_assets/' || substring(sha256(text), 1, 2) || '/' || sha256(text) || '.txt' AS path, count(*) AS ref_count, min(doc_id) AS first_doc FROM documents WHERE text IS NOT NULL GROUP BY 1",
    "asset_kinds": r"""WITH x AS (SELECT DISTINCT url, mime_type, lower(regexp_replace(regexp_extract(regexp_extract(CASE WHEN regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1) = '' THEN '/' ELSE regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1) END, '([^/]*)$', 1), '^.+(\.[^.]*)$', 1), '^\.', '')) AS e FROM pages)
SELECT CASE WHEN mime_type IN ('image/png', 'image/jpeg', 'image/gif', 'image/webp', 'image/svg+xml', 'image/avif') OR e IN ('jpg', 'jpeg', 'png', 'gif', 'webp', 'svg', 'avif') THEN 'image' WHEN mime_type IN ('application/pdf', 'application/msword', 'application/vnd.openxmlformats-officedocument.wordprocessingml.document', 'application/vnd.oasis.opendocument.text', 'application/epub+zip', 'text/plain') OR e IN ('pdf', 'doc', 'docx', 'odt', 'epub', 'txt') THEN 'document' END AS kind, count(*) AS pages FROM x GROUP BY 1""",
    "local_images": "SELECT doc_id, 'a ![p](' || CASE WHEN doc_id % 2 = 0 THEN '_assets/' ELSE 'https://x.example/' END || (doc_id % 10) || '.png) b ![q](https://x.example/missing.png)' AS md FROM documents",
    "free_summaries": f"""WITH q AS ({_LQ.format('pdf_title := pdf_title, excerpt := excerpt, domain := domain')}), c AS (SELECT url, r.pdf_title AS t, r.domain AS d, CASE WHEN length(r.excerpt) > 160 THEN regexp_replace(substring(r.excerpt, 1, 160), '\\s+\\S*$', '') || '…' ELSE r.excerpt END AS e FROM q)
SELECT url, nullif(concat_ws(' ', nullif(concat_ws(' — ', nullif(trim(t), ''), nullif(trim(e), '')), ''), '[' || d || ']'), '') AS summary FROM c""",
    "summary_prompts": f"WITH q AS ({_LQ.format('pdf_title := pdf_title, ai_title := ai_title, excerpt := excerpt')}) SELECT url, nullif(concat_ws(chr(10), 'Title: ' || nullif(trim(coalesce(r.ai_title, r.pdf_title)), ''), 'Excerpt: ' || nullif(trim(r.excerpt), '')), '') AS prompt FROM q",
    "link_contexts": f"""WITH p AS (SELECT doc_id, {PAGE} AS html FROM documents), n AS (SELECT doc_id, html, strpos(html, '/files/' || doc_id || '.pdf') + 7 AS a, strpos(html, 'Untitled</h1') AS b FROM p),
c AS (SELECT doc_id, {_context('a')} AS context, {_context('b')} AS decoded FROM n)
SELECT doc_id, CASE WHEN length(context) > 30 THEN context END AS context, CASE WHEN length(decoded) > 30 THEN decoded END AS decoded FROM c""",
    "quality_average": "WITH x AS (SELECT DISTINCT domain, scored_at, url, composite_score FROM pdf_quality WHERE composite_score IS NOT NULL), v AS (SELECT domain, list(composite_score ORDER BY scored_at, url, composite_score) AS v FROM x GROUP BY domain) SELECT domain, floor(list_reduce(v, lambda a, x: a * (1 - CAST(0.3 AS DOUBLE)) + x * CAST(0.3 AS DOUBLE)) * 1e6 + 0.5) / 1e6 AS average FROM v",
    "event_props": "SELECT event_type, CAST(sum(CAST(props ->> '$.k' AS BIGINT)) AS BIGINT) AS k, count(*) FILTER ((props ->> '$.k') IS NULL) AS without, max(CAST(props ->> '$.k' AS BIGINT)) AS largest FROM events GROUP BY event_type",
    "conformed_pages": "SELECT count(*) AS rows, CAST(0 AS BIGINT) AS depths, count(url) AS urls FROM pages",
}
