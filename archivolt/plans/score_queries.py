"""Scores, roles, languages and answers over the archive's tables, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from archivolt.functions import html as H, scores as Q, text as T, urls as U
from archivolt.functions.constants import LANGUAGE_CODES, NOT_WS, QUALITY_WORDS, SCRIPTS, VOWELS, WORD_FORMING
from archivolt.operators import relational as R
from archivolt.plans.text_queries import _CONTROLS, _DETECT, _IN_SCRIPT, _NOISE, _PATH, _PRINTABLE, _REPEATED, _SEEN, _TOKENS, _half_up, _list, _n
from archivolt.plans.text_queries import ORACLE as TEXT_SQL
from archivolt.plans.web_queries import _HREF, _P, PAGE, _body
from archivolt.session import ship_package, spread


def _t(spark, d, name):
    ship_package(spark)
    return spark.read.parquet(f"{d}/{name}.parquet")


def _docs(spark, d):
    return spread(_t(spark, d, "documents"))


def word_quality(spark, d):
    x = _docs(spark, d).withColumn("language", T.detect_language(F.col("text")))
    return x.select("doc_id", "language", T.word_quality(F.col("text"), F.col("language")).alias("quality"))


def script_token_length(spark, d):
    x = _docs(spark, d).withColumn("language", T.detect_language(F.col("text")))
    return x.select("doc_id", "language", T.half_up(T.script_token_length(F.col("text"), F.col("language")), 6).alias("length"))


def bad_samples(spark, d):
    return _docs(spark, d).select("doc_id", T.bad_sample(F.col("text")).alias("sample"))


def composite_scores(spark, d):
    q = R.latest(_t(spark, d, "pdf_quality").select("url", "scored_at", "word_quality_estimate", "readable_pages_pct", "avg_chars_per_page", "has_text_layer"), ["url"], ["scored_at"])
    return q.select("url", Q.composite(F.col("word_quality_estimate"), F.col("readable_pages_pct"), F.col("avg_chars_per_page"), F.col("has_text_layer")).alias("score"))


def page_readability(spark, d):
    m = _t(spark, d, "md_texts").where("md_path IS NOT NULL").distinct()
    seen = F.regexp_count("md_text", F.lit(NOT_WS))
    x = m.groupBy("md_path").agg(F.count(F.lit(1)).alias("pages"), F.count_if(seen >= 50).alias("readable"), F.sum(F.length("md_text")).alias("chars"))
    mean = F.coalesce(F.col("chars"), F.lit(0)) / F.col("pages")
    return x.select("md_path", T.half_up(F.col("readable") / F.col("pages")).alias("readable_pct"), T.half_up(mean, 0).alias("mean_chars"), F.when(mean > 5, 1).otherwise(0).alias("has_text"))


def processing_difficulty(spark, d):
    q = _t(spark, d, "pdf_quality").select("url", "has_text_layer", "pages", "excerpt").distinct()
    return q.select("url", "has_text_layer", "pages", Q.difficulty(F.col("has_text_layer"), F.col("pages"), T.detect_language(F.col("excerpt"))).alias("difficulty")).distinct()


def url_path_language(spark, d):
    return _t(spark, d, "pages").select("url").distinct().select("url", U.url_path_language(F.col("url")).alias("language"))


def language_names(spark, d):
    x = _t(spark, d, "documents").select(Q.language_name(F.col("lang")).alias("language"))
    return x.groupBy("language").agg(F.count(F.lit(1)).alias("documents"))


def export_methods(spark, d):
    m = _t(spark, d, "md_texts").where("md_path IS NOT NULL").distinct().groupBy("md_path").agg(F.sum(F.length("md_text")).alias("chars"), F.count(F.lit(1)).alias("n"))
    q = R.latest(_t(spark, d, "pdf_quality").select("url", "scored_at", "word_quality_estimate"), ["url"], ["scored_at"])
    e = _t(spark, d, "exports").where("status = 'ok'").select("url", "md_path").distinct()
    x = e.join(m, "md_path", "left").join(q, "url", "left")
    return x.select("url", "md_path", Q.export_method(F.col("chars"), F.col("n"), F.col("word_quality_estimate")).alias("method"))


def transient_failures(spark, d):
    runs = _t(spark, d, "runs").where("status = 'failed'").select("run_id", F.col("message").alias("error")).distinct()
    x = runs.select(F.lit("run").alias("what"), "error").unionByName(_t(spark, d, "pdf_upgrade_queue").where("status = 'failed'").select(F.lit("document").alias("what"), "error"))
    return x.groupBy("what", Q.transient_error(F.col("error")).cast("int").alias("transient")).agg(F.count(F.lit(1)).alias("failures"))


def job_ends(spark, d):
    x = _t(spark, d, "pdf_upgrade_queue").select("queue_id", F.concat("status", F.when(F.col("queue_id") % 2 == 0, "").otherwise("ed")).alias("status"))
    return x.groupBy("status", Q.job_end(F.col("status")).alias("ended")).agg(F.count(F.lit(1)).alias("jobs"))


def answer_lines(spark, d):
    x = _t(spark, d, "pdf_quality").where("url IS NOT NULL").select("url", "ai_summary", "ai_author", "ai_language").distinct()
    text = F.concat(F.lit("Line 1: "), F.coalesce("ai_summary", F.lit("")), F.lit("\n\nLine 2: Author: "), F.coalesce("ai_author", F.lit("Unknown")), F.lit("\nlanguage: "), F.coalesce("ai_language", F.lit("")))
    y = x.select("url", Q.answer_lines(text).alias("a"))
    return y.select("url", "a.summary", "a.author", "a.language").distinct()


def recogniser_languages(spark, d):
    x = _t(spark, d, "documents").select(F.when(F.col("doc_id") % 3 == 0, "printed_cjk").when(F.col("doc_id") % 3 == 1, "printed_french").alias("region"), "lang", F.when(F.col("doc_id") % 11 == 0, "deu").alias("setting"))
    return x.groupBy("region", "lang", "setting").agg(F.count(F.lit(1)).alias("documents")).withColumn("language", Q.resolved_language(F.col("region"), F.col("lang"), F.col("setting")))


def unquoted_titles(spark, d):
    return _t(spark, d, "documents").where("title IS NOT NULL").select("doc_id", Q.without_quotes(F.concat(F.lit('«"'), "title", F.lit("」"))).alias("title"))


def backup_urls(spark, d):
    x = _t(spark, d, "pages").select("domain", "url").distinct()
    return x.select("url", Q.backup_url(F.lit("https://backup.example/{domain}/{path}"), F.col("domain"), U.path(F.col("url"))).alias("backup"))


def engine_choices(spark, d):
    x = _t(spark, d, "exports").where("agreement_avg IS NOT NULL").distinct().groupBy("domain").agg(F.avg(F.when(F.col("ocr_used") == 1, F.col("agreement_avg") * 100)).alias("a"), F.avg(F.when(F.col("ocr_used") == 0, F.col("agreement_avg") * 100)).alias("b"))
    return x.select("domain", Q.engine_choice(F.col("a"), F.col("b"), 2.0).alias("engine"))


def _web(spark, d):
    return _docs(spark, d).select("doc_id", "url", F.expr(PAGE).alias("html"))


#: Rules of the roles asked for below.
RULES = [(r"/talks/", "host_page"), (r"/node/1", "index")]


def page_roles(spark, d):
    x = _web(spark, d).select("doc_id", H.classified(F.col("html"), F.col("url"), RULES, 300).alias("c"))
    return x.select("doc_id", "c.role", "c.method", "c.words")


def doc_features(spark, d):
    title = F.coalesce(H.tag_text(F.col("html"), "title"), H.tag_text(F.col("html"), "h1"))
    x = _web(spark, d).select("doc_id", H.page_features(F.col("html"), title).alias("f"))
    return x.select("doc_id", "f.words", "f.links", "f.document_links", T.half_up(F.col("f.overlap"), 6).alias("overlap"), T.half_up(F.col("f.words_per_link")).alias("words_per_link"))


def host_edges(spark, d):
    x = _web(spark, d).where("url IS NOT NULL AND doc_id % 2 = 0")
    return H.host_edges(x, "url", "html")


def worth_rendering(spark, d):
    x = _web(spark, d)
    bare = F.regexp_replace("html", r"<p>[\s\S]*</p>", "")
    return x.select("doc_id", H.worth_rendering(bare, F.col("html")).cast("int").alias("worth"))


LD = """concat('<script type="application/ld+json">{broken</script><script type="application/ld+json">{"@type":"Person","name":"no"}</script><script type="application/ld+json">{"@type":["Thing","WebPage"],"headline":"H', cast(doc_id AS varchar(20)), '","author":[{"name":"A', cast(doc_id % 9 AS varchar(20)), '","jobTitle":"Clerk","worksFor":{"name":"Mill"}},{"url":"u"},"B"],"keywords":["k1","k', cast(doc_id % 5 AS varchar(20)), '"],"datePublished":"2024-02-0', cast(1 + doc_id % 9 AS varchar(20)), 'T10:00:00+02:00"}</script><meta name="keywords" content="k1, k9,,">')"""


def structured_metadata(spark, d):
    x = _docs(spark, d).select("doc_id", "url", F.concat(F.expr(LD), F.expr(PAGE)).alias("html"))
    y = x.select("doc_id", H.metadata(F.col("html"), F.coalesce("url", F.lit("u"))).alias("m"))
    a = F.get("m.authors", F.lit(0))
    return y.select("doc_id", "m.title", "m.title_source", F.size("m.authors").alias("authors"), a["name"].alias("author"), a["job_title"].alias("job"), a["organization"].alias("organization"), F.array_join("m.keywords", "|").alias("keywords"), "m.schema_type", "m.published", "m.modified")


QUERIES = {f.__name__: f for f in (word_quality, script_token_length, bad_samples, composite_scores, page_readability, processing_difficulty, url_path_language, language_names, export_methods, transient_failures, job_ends, answer_lines, recogniser_languages, unquoted_titles, backup_urls, engine_choices, page_roles, doc_features, host_edges, worth_rendering, structured_metadata)}

_LQ = "lq AS (SELECT url, r.* FROM (SELECT url, max(struct_pack(scored_at := scored_at, {})) AS r FROM pdf_quality GROUP BY url))"
_KNOWN = "coalesce(CASE WHEN isnan({0}) THEN NULL ELSE {0} END, 0)"
_WORD_LIST = "CASE language " + " ".join(f"WHEN '{k}' THEN list_contains({_list(v)}, w)" for k, v in QUALITY_WORDS.items()) + f" ELSE list_contains({_list(QUALITY_WORDS['english'])}, w) END"
_PER_TOKEN = "CASE language " + " ".join(f"WHEN '{k}' THEN list_filter(list_transform({_TOKENS}, lambda w: len(regexp_extract_all(w, '[{v}]'))), lambda n: n > 0)" for k, v in SCRIPTS.items()) + " END"
_LENGTH = f"(SELECT CASE WHEN len(n) >= 5 THEN list_sum(n) / len(n) END FROM (SELECT {_PER_TOKEN} AS n))"
_SPREAD = f"(SELECT CASE WHEN len(t) < 5 THEN 0.0 ELSE len(list_filter(t, lambda w: length(w) BETWEEN 3 AND 15)) / len(t) * 0.6 + len(list_distinct(t)) / least(len(t), 100) * 0.4 END FROM (SELECT list_filter({_TOKENS}, lambda w: length(w) BETWEEN 2 AND 25) AS t))"
_DOC_LINK = "split_part(lower(list_extract(string_split(z[1], '.'), -1)), '?', 1) IN ('pdf', 'doc', 'docx', 'odt', 'epub', 'txt') AND contains(z[1], '.')"
_ANCHORS = f"l AS (SELECT doc_id, url, title, html, list_zip(regexp_extract_all(html, '{_HREF}', 1), regexp_extract_all(html, '{_HREF}', 2)) AS l FROM p)"
_SET = r"list_distinct(list_filter(regexp_split_to_array(lower({}), '\W+'), lambda w: w <> ''))"
_TITLE = f"coalesce(nullif({_body('coalesce(title, chr(32))')}, ''), 'Untitled')"
_FEATURES = rf"""{_P}, {_ANCHORS}, w AS (SELECT doc_id, url, len(l) AS links, list_filter(l, lambda z: {_DOC_LINK}) AS docs, {_TITLE} AS t, len(list_filter(string_split({_body('html')}, ' '), lambda w: w <> '')) AS words FROM l),
e AS (SELECT doc_id, {_SET.format('t')} AS a, unnest(docs) AS z FROM w),
o AS (SELECT doc_id, max(len(list_intersect(a, b)) / greatest(len(list_distinct(list_concat(a, b))), 1)) AS overlap FROM (SELECT doc_id, a, {_SET.format(_body('z[2]'))} AS b FROM e) GROUP BY doc_id),
f AS (SELECT w.doc_id, url, words, links, len(docs) AS document_links, coalesce(overlap, 0.0) AS overlap, CASE WHEN links > 0 THEN words / links ELSE words END AS ratio FROM w LEFT JOIN o USING (doc_id))"""
_BARE = r"regexp_replace(html, '<p>[\s\S]*</p>', '')"
_SCRIPTED = f"least(1.0, sc * CAST(0.85 AS DOUBLE) + td * CAST(0.15 AS DOUBLE)) * CASE WHEN language IN ({', '.join(repr(x) for x in WORD_FORMING)}) AND al < 2.5 THEN 1 - least(CAST(0.8 AS DOUBLE), (2.5 - al) / 1.5) ELSE 1.0 END"
_LATIN = "CASE WHEN n < 10 THEN 0.0 ELSE greatest(0.0, real / n - noise * 3 - CASE WHEN bare / n > 0.03 THEN (bare / n - 0.03) * 4 ELSE 0.0 END) END"
_HARD = "CASE WHEN has_text_layer = 1 THEN 0.05 WHEN coalesce(pages, 0) = 0 THEN 1.0 ELSE greatest(CAST(0.3 AS DOUBLE), least(CAST(1.0 AS DOUBLE), pages / CAST(400 AS DOUBLE) * CASE WHEN language IN ('persian', 'arabic', 'hebrew', 'hindi', 'chinese', 'japanese', 'korean') THEN 2.0 ELSE 1.0 END)) END"

ORACLE = {
    "word_quality": f"""WITH {_DETECT}, w AS (SELECT *, list_transform(list_slice(list_filter(string_split(regexp_replace(coalesce(text, ''), '[^a-zA-ZÀ-ÿ]+', ' ', 'g'), ' '), lambda w: length(w) BETWEEN 2 AND 20), 1, 200), lambda w: lower(w)) AS s FROM detected),
m AS (SELECT doc_id, language, text, len(s) AS n, len(list_filter(s, lambda w: {_WORD_LIST} OR (len(regexp_extract_all(w, '[{VOWELS}]')) / length(w) BETWEEN 0.2 AND 0.75 AND NOT regexp_matches(w, '{_REPEATED}')))) AS real,
 len(list_filter(s, lambda w: length(w) <= 3 AND NOT regexp_matches(w, '[{VOWELS.replace('ç', '').replace('ñ', '')}y]'))) AS bare, {_PRINTABLE} AS pr, {_NOISE} AS noise,
 CASE WHEN {_SEEN} - {_CONTROLS} >= 20 THEN ({_IN_SCRIPT}) / ({_SEEN} - {_CONTROLS}) END AS sc, {_SPREAD} AS td, {_LENGTH} AS al FROM w)
SELECT doc_id, language, CASE WHEN NOT regexp_matches(coalesce(text, ''), '{NOT_WS}') THEN 0.0 ELSE {_half_up(f'CASE WHEN pr < 0.3 THEN pr WHEN sc IS NOT NULL THEN pr * ({_SCRIPTED}) ELSE pr * {_LATIN} END', 2)} END AS quality FROM m""",
    "script_token_length": f"WITH {_DETECT} SELECT doc_id, language, {_half_up(_LENGTH)} AS length FROM detected",
    "bad_samples": r"WITH c AS (SELECT doc_id, trim(regexp_replace(regexp_replace(coalesce(text, ''), '[^\x20-\x7E\n]', ' ', 'g'), '[ \n]+', ' ', 'g')) AS c FROM documents), r AS (SELECT doc_id, c, regexp_extract(c, '[A-Za-z]{3,}(?: +[A-Za-z]{2,}){4,}') AS run FROM c) SELECT doc_id, substring(CASE WHEN run <> '' THEN run ELSE c END, 1, 300) AS sample FROM r",
    "composite_scores": f"WITH {_LQ.format('word_quality_estimate := word_quality_estimate, readable_pages_pct := readable_pages_pct, avg_chars_per_page := avg_chars_per_page, has_text_layer := has_text_layer')} SELECT url, {_half_up('least(CAST(1.0 AS DOUBLE), ' + _KNOWN.format('word_quality_estimate') + ' * (CAST(0.6 AS DOUBLE) + CAST(0.3 AS DOUBLE) * ' + _KNOWN.format('readable_pages_pct') + ') + CAST(0.07 AS DOUBLE) * least(' + _KNOWN.format('avg_chars_per_page') + ' * CAST(1.0 AS DOUBLE) / 500, CAST(1.0 AS DOUBLE)) + CAST(0.03 AS DOUBLE) * coalesce(has_text_layer, 0))', 2)} AS score FROM lq",
    "page_readability": f"WITH m AS (SELECT DISTINCT md_path, page_no, md_text FROM md_texts WHERE md_path IS NOT NULL), x AS (SELECT md_path, count(*) AS pages, count(*) FILTER ({_n(NOT_WS, 'md_text')} >= 50) AS readable, coalesce(sum(length(md_text)), 0) / count(*) AS mean FROM m GROUP BY md_path) SELECT md_path, {_half_up('readable / pages', 2)} AS readable_pct, floor(mean + 0.5) AS mean_chars, CASE WHEN mean > 5 THEN 1 ELSE 0 END AS has_text FROM x",
    "processing_difficulty": f"WITH {_DETECT.replace('FROM documents', 'FROM (SELECT DISTINCT url, has_text_layer, pages, excerpt AS text FROM pdf_quality)')} SELECT DISTINCT url, has_text_layer, pages, {_half_up(_HARD, 2)} AS difficulty FROM detected",
    "url_path_language": f"""WITH u AS (SELECT DISTINCT url FROM pages), x AS (SELECT url, ({TEXT_SQL['url_language'].split('SELECT url, ', 1)[1].split(' AS language FROM', 1)[0]}) AS a, list_filter(regexp_split_to_array(lower(regexp_replace(url_decode({_PATH}), '[^a-zA-ZÀ-ÿ\\s]', ' ', 'g')), '\\s+'), lambda w: length(w) > 2) AS w FROM u),
{_DETECT.replace('FROM documents', "FROM (SELECT url, a, array_to_string(w, ' ') AS text, len(w) AS size FROM x)")} SELECT url, coalesce(a, CASE WHEN size >= 2 THEN language END) AS language FROM detected""",
    "language_names": "SELECT CASE lower(trim(lang)) " + " ".join(f"WHEN '{k}' THEN '{v.capitalize()}' WHEN '{v}' THEN '{v.capitalize()}'" for k, v in LANGUAGE_CODES.items()) + " END AS language, count(*) AS documents FROM documents GROUP BY 1",
    "export_methods": f"WITH {_LQ.format('word_quality_estimate := word_quality_estimate')}, m AS (SELECT md_path, sum(length(md_text)) AS chars, count(*) AS n FROM (SELECT DISTINCT * FROM md_texts WHERE md_path IS NOT NULL) GROUP BY md_path), e AS (SELECT DISTINCT url, md_path FROM exports WHERE status = 'ok') SELECT e.url, e.md_path, CASE WHEN coalesce(chars, 0) = 0 THEN 'stub' WHEN chars / greatest(coalesce(n, 1), 1) < 50 THEN 'pdf-text-sparse' WHEN {_KNOWN.format('word_quality_estimate')} < 0.8 THEN 'pdf-text-garbled' ELSE 'pdf-text' END AS method FROM e LEFT JOIN m USING (md_path) LEFT JOIN lq ON lq.url = e.url",
    "transient_failures": r"WITH x AS (SELECT 'run' AS what, error FROM (SELECT DISTINCT run_id, message AS error FROM runs WHERE status = 'failed') UNION ALL SELECT 'document', error FROM pdf_upgrade_queue WHERE status = 'failed') SELECT what, CAST(coalesce(regexp_matches(error, '(?i)no workers available|fetch failed|socket hang up|ECONNREFUSED|ETIMEDOUT|EAI_AGAIN|timed out|job expired|HTTP 408|HTTP 429|HTTP 5\d\d'), false) AS INTEGER) AS transient, count(*) AS failures FROM x GROUP BY ALL",
    "job_ends": "WITH x AS (SELECT status || CASE WHEN queue_id % 2 = 0 THEN '' ELSE 'ed' END AS status FROM pdf_upgrade_queue) SELECT status, CASE WHEN status IN ('done', 'completed', 'succeeded', 'complete') THEN 'done' WHEN status IN ('failed', 'error', 'cancelled', 'canceled') THEN 'failed' END AS ended, count(*) AS jobs FROM x GROUP BY ALL",
    "answer_lines": r"""WITH x AS (SELECT DISTINCT url, ai_summary AS s, ai_author AS a, ai_language AS l FROM pdf_quality WHERE url IS NOT NULL), c AS (SELECT url, list_filter(list_transform(string_split('Line 1: ' || coalesce(s, ''), chr(10)), lambda r: trim(r)), lambda r: r <> '')[1] AS first, a, l FROM x)
SELECT DISTINCT url, coalesce(nullif(trim(regexp_replace(first, '(?i)^(?:line\s*\d+[:.]?\s*|\d+[.:]\s*)', '')), ''), first) AS summary, trim(coalesce(a, 'Unknown')) AS author, trim(coalesce(l, '')) AS language FROM c""",
    "recogniser_languages": "WITH x AS (SELECT CASE doc_id % 3 WHEN 0 THEN 'printed_cjk' WHEN 1 THEN 'printed_french' END AS region, lang, CASE WHEN doc_id % 11 = 0 THEN 'deu' END AS setting FROM documents) SELECT region, lang, setting, count(*) AS documents, CASE WHEN setting IS NOT NULL THEN setting WHEN lang IN ('ar', 'ara') THEN 'ara' WHEN lang IN ('fa', 'fas', 'per') THEN 'fas' WHEN coalesce(region = 'printed_french', false) OR lang IN ('fr', 'fra', 'french') THEN 'fra' WHEN region = 'printed_cjk' THEN 'chi_sim+jpn' ELSE 'eng' END AS language FROM x GROUP BY region, lang, setting",
    "unquoted_titles": "SELECT doc_id, trim(regexp_replace('«\"' || title || '」', '^[\"«»「」『』\"'']+|[\"«»「」『』\"'']+$', '', 'g')) AS title FROM documents WHERE title IS NOT NULL",
    "backup_urls": f"SELECT url, 'https://backup.example/' || domain || '/' || regexp_replace({_PATH}, '^/', '') AS backup FROM (SELECT DISTINCT domain, url FROM pages)",
    "engine_choices": "WITH x AS (SELECT domain, avg(agreement_avg * 100) FILTER (ocr_used = 1) AS a, avg(agreement_avg * 100) FILTER (ocr_used = 0) AS b FROM (SELECT DISTINCT * FROM exports WHERE agreement_avg IS NOT NULL) GROUP BY domain) SELECT domain, CASE WHEN coalesce(b > a + 2.0, b IS NOT NULL) THEN 'second' WHEN a IS NOT NULL THEN 'first' END AS engine FROM x",
    "page_roles": f"WITH {_FEATURES}, r AS (SELECT *, CASE WHEN regexp_matches(url, '/talks/') THEN 'host_page' WHEN regexp_matches(url, '/node/1') THEN 'index' END AS ruled FROM f) SELECT doc_id, coalesce(ruled, CASE WHEN words < 300 AND document_links >= 1 THEN 'host_page' WHEN words < 50 AND links = 1 THEN 'redirect' WHEN ratio < 5 AND links > 10 THEN 'index' ELSE 'content' END) AS role, CASE WHEN ruled IS NULL THEN 'heuristic' ELSE 'rules' END AS method, CASE WHEN ruled IS NULL THEN words END AS words FROM r",
    "doc_features": f"WITH {_FEATURES} SELECT doc_id, words, links, document_links, {_half_up('overlap')} AS overlap, {_half_up('ratio', 2)} AS words_per_link FROM f",
    "host_edges": f"WITH {_P}, {_ANCHORS}, e AS (SELECT url AS host_url, doc_id, unnest(list_filter(l, lambda z: {_DOC_LINK})) AS z FROM l WHERE url IS NOT NULL AND doc_id % 2 = 0) SELECT DISTINCT host_url, regexp_extract(host_url, '^[a-z]+://[^/?#]*') || z[1] AS hosted_url, {_body('z[2]')} AS hosted_title FROM e",
    "worth_rendering": f"WITH {_P}, n AS (SELECT doc_id, len(list_filter(string_split({_body('html')}, ' '), lambda w: length(w) > 2)) AS a, len(list_filter(string_split({_body(_BARE)}, ' '), lambda w: length(w) > 2)) AS b FROM p) SELECT doc_id, CAST(a > 3 * b AND a > 100 AS INTEGER) AS worth FROM n",
    "structured_metadata": "SELECT doc_id, 'H' || doc_id AS title, 'json_ld' AS title_source, 2 AS authors, 'A' || (doc_id % 9) AS author, 'Clerk' AS job, 'Mill' AS organization, CASE doc_id % 5 WHEN 1 THEN 'k1|k9' ELSE 'k1|k9|k' || (doc_id % 5) END AS keywords, 'Thing' AS schema_type, '2024-02-0' || (1 + doc_id % 9) || 'T08:00:00.000Z' AS published, CAST(NULL AS VARCHAR) AS modified FROM documents",
}
