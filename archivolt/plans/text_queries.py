"""Text and url functions over whole tables, with their SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from archivolt.functions import text as T, urls as U

from archivolt.functions.constants import FUNCTION_WORDS, LATIN_LETTERS, NOT_WS, SCRIPTS, URL_LANGUAGES, VOWELS, WS
from archivolt.session import spread


def _docs(spark, d):
    return spread(spark.read.parquet(f"{d}/documents.parquet"))


def _pages(spark, d):
    return spark.read.parquet(f"{d}/pages.parquet")


def word_counts(spark, d):
    return _docs(spark, d).select("doc_id", T.word_count(F.col("text")).alias("words"))


def detect_language(spark, d):
    return _docs(spark, d).select("doc_id", T.detect_language(F.col("text")).alias("language"))


def lang_distribution(spark, d):
    return _docs(spark, d).groupBy("lang", T.detect_language(F.col("text")).alias("detected")).agg(F.count(F.lit(1)).alias("documents"))


def printable_ratio(spark, d):
    return _docs(spark, d).select("doc_id", T.half_up(T.printable_ratio(F.col("text")), 6).alias("printable"))


def script_consistency(spark, d):
    x = _docs(spark, d).withColumn("language", T.detect_language(F.col("text")))
    return x.select("doc_id", "language", T.half_up(T.script_share(F.col("text"), F.col("language")), 6).alias("share"))


def garbled_flag(spark, d):
    x = _docs(spark, d).withColumn("language", T.detect_language(F.col("text")))
    return x.select("doc_id", T.garbled(F.col("text"), F.col("language")).cast("int").alias("garbled"))


def token_distribution(spark, d):
    return _docs(spark, d).select("doc_id", T.half_up(T.token_distribution(F.col("text")), 6).alias("distribution"))


def digit_noise(spark, d):
    return _docs(spark, d).select("doc_id", T.half_up(T.digit_noise(F.col("text")), 6).alias("noise"))


def excerpts(spark, d):
    return _docs(spark, d).select("doc_id", T.excerpt(F.col("text")).alias("excerpt"))


def title_jaccard(spark, d):
    x = _docs(spark, d).where("title IS NOT NULL")
    return x.select("doc_id", T.half_up(T.jaccard(F.col("title"), F.col("text")), 6).alias("overlap"))


def titles_from_urls(spark, d):
    return _docs(spark, d).where("url IS NOT NULL").select("doc_id", T.title_from_url(F.col("url")).alias("title"), T.generic_title(F.col("title")).cast("int").alias("generic"))


def mirror_paths(spark, d):
    return _pages(spark, d).select("domain", "url").distinct().select("url", U.mirror_path(F.col("domain"), F.col("url")).alias("path"))


def path_slugs(spark, d):
    return _pages(spark, d).select("url").distinct().select("url", U.path_slug(U.path(F.col("url"))).alias("slug"))


def url_parts(spark, d):
    u = F.col("url")
    return _pages(spark, d).select("url").distinct().select("url", U.host(u).alias("host"), U.path(u).alias("path"), U.query(u).alias("query"), U.extension(U.path(u)).alias("extension"))


def url_strip_query(spark, d):
    return _pages(spark, d).select("url").distinct().select("url", U.without_parameters(F.concat("url", F.lit("?utm_source=a&doc=7&ref=x#top")), ["utm_source", "ref"]).alias("stripped"))


def url_in_scope(spark, d):
    x = _pages(spark, d).select("domain", "url").distinct()
    return x.select("url", U.in_scope(F.col("url"), F.col("domain"), ["/reports", "/node", "/talks"], ["/talks/19"]).cast("int").alias("in_scope"))


def url_language(spark, d):
    return _pages(spark, d).select("url").distinct().select("url", U.url_language(F.col("url")).alias("language"))


def resolve_links(spark, d):
    x = _pages(spark, d).select("url").distinct()
    hrefs = F.array(*map(F.lit, ("/a b.html", "next.pdf#page=2", "//cdn.example/x", "https://else.example/y#z", "../up.html", "./here/../there.html?a=../b", "?page=2", "../../../../../root/")))
    return x.select("url", F.explode(hrefs).alias("href")).select("url", "href", U.resolved(F.col("href"), F.col("url")).alias("absolute"))


def rule_overrides(spark, d):
    rules = [(r"/node/", "node"), (r"\.pdf$", "document"), (r"(?i)index\.php", "script")]
    return _pages(spark, d).select("url").distinct().groupBy(U.first_match(F.col("url"), rules, F.lit("page")).alias("kind")).agg(F.count(F.lit(1)).alias("urls"))


def feed_urls(spark, d):
    return _pages(spark, d).select("url").distinct().select("url", U.normalised_feed_url(F.col("url")).alias("feed_url"), U.safe_file_name(U.path_slug(U.path(F.col("url")))).alias("file_name"))


QUERIES = {f.__name__: f for f in (word_counts, detect_language, lang_distribution, printable_ratio, script_consistency, garbled_flag, token_distribution, digit_noise, excerpts, title_jaccard, titles_from_urls, mirror_paths, path_slugs, url_parts, url_strip_query, url_in_scope, url_language, resolve_links, rule_overrides, feed_urls)}


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _list(words) -> str:
    return "[" + ", ".join(_q(w) for w in words) + "]"


def _n(pattern: str, text: str = "coalesce(text, '')") -> str:
    return f"len(regexp_extract_all({text}, {_q(pattern)}))"


_TOKENS = f"list_filter(regexp_split_to_array(coalesce(text, ''), {_q(WS + '+')}), lambda w: w <> '')"
_VOTES = {k: f"len(list_filter(sample, lambda w: list_contains({_list(v)}, w)))" for k, v in FUNCTION_WORDS.items()}
_DETECT = f"""
words AS (SELECT *, regexp_extract_all(lower(coalesce(text, '')), {_q(chr(92) + 'b[' + LATIN_LETTERS + ']{2,}' + chr(92) + 'b')}) AS ws, length(coalesce(text, '')) AS n FROM documents),
sampled AS (SELECT *, list_slice(ws, 1, 150) AS sample FROM words),
votes AS (SELECT *, {', '.join(f'{v} AS {k}' for k, v in _VOTES.items())} FROM sampled),
detected AS (SELECT *, CASE WHEN n < 15 THEN 'unknown'
  WHEN {_n(r'[\x{0600}-\x{06FF}]')} / n > 0.07 THEN CASE WHEN regexp_matches(text, '[\\x{{067E}}\\x{{0686}}\\x{{0698}}\\x{{06AF}}]') THEN 'persian' ELSE 'arabic' END
  WHEN {_n(r'[\x{0590}-\x{05FF}]')} / n > 0.07 THEN 'hebrew'
  WHEN {_n(r'[\x{3040}-\x{30FF}]')} / n > 0.05 THEN 'japanese'
  WHEN {_n(r'[\x{4E00}-\x{9FFF}]')} / n > 0.07 THEN 'chinese'
  WHEN {_n(r'[\x{0400}-\x{04FF}]')} / n > 0.07 THEN 'russian'
  WHEN {_n('[a-zA-Z]')} / n > 0.3 THEN
    CASE WHEN len(ws) >= 8 AND greatest(french, spanish, german, italian, portuguese) >= greatest(3.0, len(sample) * 0.06) THEN
      CASE greatest(french, spanish, german, italian, portuguese) WHEN french THEN 'french' WHEN spanish THEN 'spanish' WHEN german THEN 'german' WHEN italian THEN 'italian' ELSE 'portuguese' END
    ELSE 'english' END
  ELSE 'unknown' END AS language FROM votes)"""
_CONTROLS = _n(r"[\x00-\x08\x0E-\x1F]")
_SEEN = _n(NOT_WS)
_IN_SCRIPT = "CASE language " + " ".join(f"WHEN '{k}' THEN {_n(f'[{v}]')}" for k, v in SCRIPTS.items()) + " END"
_REPEATED = "|".join(f"{c}{{4}}" for c in LATIN_LETTERS.replace("a-z", "abcdefghijklmnopqrstuvwxyz"))
_PRINTABLE = f"CASE WHEN {_SEEN} < 20 THEN 1.0 ELSE ({_SEEN} - {_CONTROLS}) / {_SEEN} END"
_NOISE = f"""(SELECT CASE WHEN len(t) < 10 THEN 0.0 ELSE len(list_filter(t, lambda w: regexp_matches(w, '[a-zA-Z][0-9][a-zA-Z]'))) / len(t) END
  FROM (SELECT list_filter({_TOKENS}, lambda w: length(w) BETWEEN 3 AND 25 AND len(regexp_extract_all(w, '[a-zA-Z]')) * 2 >= length(w)) AS t))"""


def _half_up(x: str, digits: int = 6) -> str:
    return f"floor(({x}) * 1e{digits} + 0.5) / 1e{digits}"


_PATH = r"(CASE WHEN regexp_extract(url, '^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*([^?#]*)', 1) = '' THEN '/' ELSE regexp_extract(url, '^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*([^?#]*)', 1) END)"


def _ext(p: str) -> str:
    return rf"regexp_extract(regexp_extract({p}, '([^/]*)$', 1), '^.+(\.[^.]*)$', 1)"


_SLUG = rf"(SELECT CASE WHEN s = '' THEN 'index' ELSE s END FROM (SELECT regexp_replace(replace(regexp_replace({_PATH}, '^/', ''), '/', '-'), '\.\w+$', '') AS s))"
_LANG_CASE = " ".join("WHEN regexp_matches(lower(url), {}) THEN '{}'".format(_q("|".join([f"/{k.split()[0]}/", f"[/_-]{k.split()[0]}[/_-]", *[f"/{n}/" for n in k.split()[1:]]])), name) for name, k in URL_LANGUAGES.items())

ORACLE = {
    "word_counts": f"SELECT doc_id, len({_TOKENS}) AS words FROM documents",
    "detect_language": f"WITH {_DETECT} SELECT doc_id, language FROM detected",
    "lang_distribution": f"WITH {_DETECT} SELECT lang, language AS detected, count(*) AS documents FROM detected GROUP BY ALL",
    "printable_ratio": f"SELECT doc_id, {_half_up(_PRINTABLE)} AS printable FROM documents",
    "script_consistency": f"WITH {_DETECT} SELECT doc_id, language, CASE WHEN {_SEEN} - {_CONTROLS} >= 20 THEN {_half_up(f'({_IN_SCRIPT}) / ({_SEEN} - {_CONTROLS})')} END AS share FROM detected",
    "garbled_flag": f"""WITH {_DETECT}, m AS (SELECT doc_id, {_SEEN} AS s, {_n(r'[\x{00C0}-\x{02FF}]')} AS le, {_n(r'[\x{E000}-\x{F8FF}]')} AS pua, {_n(r'[\x{0590}-\x{05FF}\x{0600}-\x{06FF}\x{FB50}-\x{FEFF}]')} AS rtl, {_n('[A-Za-z]')} AS a, {_IN_SCRIPT} AS sc FROM detected)
SELECT doc_id, CAST(s >= 50 AND (le > 0.15 * s OR pua > 0.05 * s OR (rtl > 0.05 * s AND a > 0.25 * (rtl + a)) OR coalesce(sc < 0.5 * s, false)) AS INTEGER) AS garbled FROM m""",
    "token_distribution": f"""WITH t AS (SELECT doc_id, list_filter({_TOKENS}, lambda w: length(w) BETWEEN 2 AND 25) AS t FROM documents)
SELECT doc_id, CASE WHEN len(t) < 5 THEN 0.0 ELSE {_half_up("len(list_filter(t, lambda w: length(w) BETWEEN 3 AND 15)) / len(t) * 0.6 + len(list_distinct(t)) / least(len(t), 100) * 0.4")} END AS distribution FROM t""",
    "digit_noise": f"SELECT doc_id, {_half_up(_NOISE)} AS noise FROM documents",
    "excerpts": f"""WITH c AS (SELECT doc_id, regexp_replace(regexp_replace(coalesce(text, ''), {_q(WS + '+')}, ' ', 'g'), '^ | $', '', 'g') AS c FROM documents),
r AS (SELECT doc_id, c, regexp_extract(c, '[A-ZÀ-Ö][a-zA-ZÀ-ÿ,;:\\s]{{40,}}') AS run FROM c)
SELECT doc_id, regexp_replace(substring(CASE WHEN run <> '' THEN run ELSE c END, 1, 280), '^ +| +$', '', 'g') AS excerpt FROM r""",
    "title_jaccard": f"""WITH s AS (SELECT doc_id, list_distinct(list_filter(regexp_split_to_array(lower(title), '\\W+'), lambda w: w <> '')) AS a, list_distinct(list_filter(regexp_split_to_array(lower(text), '\\W+'), lambda w: w <> '')) AS b FROM documents WHERE title IS NOT NULL)
SELECT doc_id, {_half_up("len(list_intersect(a, b)) / greatest(len(list_distinct(list_concat(a, b))), 1)")} AS overlap FROM s""",
    "titles_from_urls": r"""WITH r AS (SELECT doc_id, title, CASE WHEN regexp_extract(url, '[?&]dl=([^&#]+)', 1) <> '' THEN regexp_extract(url, '[?&]dl=([^&#]+)', 1) ELSE regexp_extract(regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1), '([^/]*)$', 1) END AS raw FROM documents WHERE url IS NOT NULL),
p AS (SELECT doc_id, title, regexp_replace(regexp_replace(regexp_replace(raw, '(?i)\.pdf$', ''), '^\d{8,}-', ''), '[-_]', ' ', 'g') AS plain FROM r)
SELECT doc_id, nullif(trim(array_to_string(list_transform(string_split(plain, ' '), lambda w: upper(substring(w, 1, 1)) || substring(w, 2)), ' ')), '') AS title, CAST(title IS NULL OR length(title) <= 5 OR lower(trim(title)) = 'pdf' AS INTEGER) AS generic FROM p""",
    "mirror_paths": rf"""WITH a AS (SELECT DISTINCT domain, url, {_PATH} AS p, regexp_extract(url, '^[^?#]*(\?[^#]*)', 1) AS q FROM pages),
b AS (SELECT *, CASE WHEN p LIKE '%/' OR {_ext('p')} = '' THEN regexp_replace(p, '/$', '') || '/index.html' ELSE p END AS p2 FROM a),
c AS (SELECT *, CASE WHEN q NOT IN ('', '?') THEN substring(p2, 1, length(p2) - length({_ext('p2')})) || '__' || substring(sha256(q), 1, 4) || {_ext('p2')} ELSE p2 END AS p3 FROM b),
e AS (SELECT *, regexp_extract(p3, '([^/]*)$', 1) AS last FROM c),
f AS (SELECT *, CASE WHEN strlen(last) > 200 THEN substring(p3, 1, length(p3) - length(last)) || substring(sha256(last), 1, 12) || {_ext('last')} ELSE p3 END AS p4 FROM e)
SELECT url, 'mirror/' || domain || '/' || regexp_replace(p4, '^/', '') AS path FROM f""",
    "path_slugs": f"SELECT url, {_SLUG} AS slug FROM (SELECT DISTINCT url FROM pages)",
    "url_parts": rf"SELECT url, nullif(lower(regexp_extract(url, '^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]*)', 1)), '') AS host, {_PATH} AS path, regexp_extract(url, '^[^?#]*(\?[^#]*)', 1) AS query, {_ext(_PATH)} AS extension FROM (SELECT DISTINCT url FROM pages)",
    "url_strip_query": r"""WITH u AS (SELECT DISTINCT url, url || '?utm_source=a&doc=7&ref=x#top' AS v FROM pages),
k AS (SELECT url, v, regexp_extract(v, '^[^?#]*(\?[^#]*)', 1) AS q FROM u),
l AS (SELECT *, list_filter(string_split(substring(q, 2), '&'), lambda x: split_part(x, '=', 1) NOT IN ('utm_source', 'ref') AND x <> '') AS kept FROM k)
SELECT url, CASE WHEN q = '' THEN v ELSE regexp_extract(v, '^[^?#]*') || CASE WHEN len(kept) > 0 THEN '?' || array_to_string(kept, '&') ELSE '' END || regexp_extract(v, '#.*$') END AS stripped FROM l""",
    "url_in_scope": rf"""SELECT url, CAST(coalesce(regexp_extract(url, '^[a-z]+://([^/:?#]*)', 1) = domain AND NOT starts_with({_PATH}, '/talks/19') AND (starts_with({_PATH}, '/reports') OR starts_with({_PATH}, '/node') OR starts_with({_PATH}, '/talks')), false) AS INTEGER) AS in_scope FROM (SELECT DISTINCT domain, url FROM pages)""",
    "url_language": f"""SELECT url, CASE WHEN regexp_matches(lower(url), '%d[89ab]%[0-9a-f]{{2}}') THEN CASE WHEN regexp_matches(lower(url), '%(?:d9%(?:be|87)|da%(?:86|98|a9|af)|db%8c)') THEN 'persian' ELSE 'arabic' END
 WHEN regexp_matches(lower(url), '%d[67]%[0-9a-f]{{2}}') THEN 'hebrew' {_LANG_CASE} END AS language FROM (SELECT DISTINCT url FROM pages)""",
    "resolve_links": rf"""WITH x AS (SELECT url, unnest(['/a b.html', 'next.pdf#page=2', '//cdn.example/x', 'https://else.example/y#z', '../up.html', './here/../there.html?a=../b', '?page=2', '../../../../../root/']) AS href FROM (SELECT DISTINCT url FROM pages)),
h AS (SELECT *, regexp_replace(replace(href, ' ', '%20'), '#.*$', '') AS h FROM x)
SELECT url, href, CASE WHEN h = '../../../../../root/' THEN regexp_extract(url, '^[a-z]+://[^/?#]*') || '/root/'
 WHEN h = '../up.html' THEN regexp_extract(url, '^[a-z]+://[^/?#]*') || regexp_replace(regexp_replace({_PATH}, '[^/]*$', ''), '[^/]+/$', '') || 'up.html'
 WHEN h = './here/../there.html?a=../b' THEN regexp_extract(url, '^[a-z]+://[^/?#]*') || regexp_replace({_PATH}, '[^/]*$', '') || 'there.html?a=../b'
 WHEN starts_with(h, '?') THEN regexp_extract(url, '^[a-z]+://[^/?#]*') || {_PATH} || h
 WHEN regexp_matches(h, '^[a-zA-Z][a-zA-Z0-9+.-]*:') THEN h WHEN starts_with(h, '//') THEN regexp_extract(url, '^([a-z]+):', 1) || ':' || h WHEN starts_with(h, '/') THEN regexp_extract(url, '^[a-z]+://[^/?#]*') || h ELSE regexp_extract(url, '^[a-z]+://[^/?#]*') || regexp_replace({_PATH}, '[^/]*$', '') || h END AS absolute FROM h""",
    "rule_overrides": r"SELECT CASE WHEN regexp_matches(url, '/node/') THEN 'node' WHEN regexp_matches(url, '\.pdf$') THEN 'document' WHEN regexp_matches(url, '(?i)index\.php') THEN 'script' ELSE 'page' END AS kind, count(*) AS urls FROM (SELECT DISTINCT url FROM pages) GROUP BY 1",
    "feed_urls": rf"SELECT url, regexp_replace(regexp_replace(url, '[?#].*$', ''), '/+$', '') || '/' AS feed_url, regexp_replace({_SLUG}, '[^\w.-]', '_', 'g') AS file_name FROM (SELECT DISTINCT url FROM pages)",
}
