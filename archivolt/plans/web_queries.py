"""Web-document operators over pages made of the archive's documents, the same markup in both dialects."""

from __future__ import annotations

from pyspark.sql import functions as F

from archivolt.functions import html as H
from archivolt.functions.constants import WS
from archivolt.operators import dom
from archivolt.session import spread

#: One page per document, written so that both dialects read it alike.
PAGE = """concat('<!DOCTYPE html><html lang="', coalesce(lang, 'en'), '-X"><head><title> ', coalesce(title, ''), ' </title><meta charset="utf-8"><meta name="author" content="', coalesce(source, ''), '">',
 CASE WHEN doc_id % 3 = 0 THEN concat('<meta property="og:title" content="OG ', cast(doc_id AS varchar(20)), '">') ELSE '' END, CASE WHEN doc_id % 7 = 0 THEN '<meta name="ROBOTS" content="noindex, noarchive">' ELSE '' END,
 CASE WHEN doc_id % 2 = 0 THEN concat('<link rel="canonical" href="', coalesce(url, 'none'), '">') ELSE '' END, '</head><body><nav><a href="/">home</a> <a href="#top">top</a> <a href="mailto:x">mail</a></nav><h1>', coalesce(title, 'Untitled'), '</h1><p>',
 replace(coalesce(text, ''), '<', '('), '</p><a class="x" href="/files/', cast(doc_id AS varchar(20)), '.pdf?v=1">Report &amp; notes</a><a href="next">next</a><script>var x = "</p>";</script></body></html>')"""


def _pages(spark, d):
    return spread(spark.read.parquet(f"{d}/documents.parquet")).select("doc_id", "url", "title", F.expr(PAGE).alias("html"))


def extract_links(spark, d):
    return _pages(spark, d).select("doc_id", F.posexplode(H.links(F.col("html"))).alias("n", "l")).select("doc_id", "n", "l.href", "l.label")


def strip_html(spark, d):
    return _pages(spark, d).select("doc_id", F.md5(H.body_text(F.col("html")).cast("binary")).alias("text_md5"))


def meta_tags_map(spark, d):
    m = H.meta_tags(F.col("html"))
    return _pages(spark, d).select("doc_id", F.try_element_at(m, F.lit("author")).alias("author"), F.try_element_at(m, F.lit("og:title")).alias("og_title"), F.try_element_at(m, F.lit("robots")).alias("robots"), F.size(m).alias("n"))


def page_metadata(spark, d):
    x = _pages(spark, d).select("doc_id", H.metadata(F.col("html"), F.coalesce("url", F.lit("https://x.example/none.html"))).alias("m"))
    return x.select("doc_id", "m.title", "m.title_source", "m.author", "m.language", "m.canonical_url")


def noarchive_pages(spark, d):
    return _pages(spark, d).where(H.may_not_be_archived(F.col("html"))).select("doc_id")


def html_shells(spark, d):
    return _pages(spark, d).select("doc_id", H.text_words(F.col("html")).alias("words"), H.is_shell(F.col("html")).cast("int").alias("shell"))


#: Fixed value: entries a sitemap file may hold.
FILE_ENTRIES = 50_000


def sitemap_parse(spark, d):
    s = spark.read.parquet(f"{d}/sitemaps.parquet").select("source_sitemap", "url", "lastmod").where("source_sitemap IS NOT NULL").distinct()
    # files of half the entries allowed, as urls do not fall evenly on them
    files = s.groupBy("source_sitemap").agg(F.ceil(F.count(F.lit(1)) / (FILE_ENTRIES // 2)).alias("files"))
    s = s.join(files, "source_sitemap").withColumn("file", F.pmod(F.xxhash64("url"), "files"))
    entry = F.concat(F.lit("<url>\n<loc>"), "url", F.lit("</loc>"), F.coalesce(F.concat(F.lit("<lastmod>"), "lastmod", F.lit("</lastmod>")), F.lit("")), F.lit("</url>"))
    xml = s.groupBy("source_sitemap", "file").agg(F.concat(F.lit('<?xml version="1.0"?><urlset xmlns="x">'), F.array_join(F.collect_list(entry), ""), F.lit("</urlset>")).alias("xml"))  # one file's entries
    return xml.select("source_sitemap", F.explode(H.sitemap_entries(F.col("xml"))).alias("e")).select("source_sitemap", "e.kind", "e.url", "e.lastmod").distinct()


def rss_items(spark, d):
    x = spark.read.parquet(f"{d}/documents.parquet").where("domain IS NOT NULL AND doc_id IS NOT NULL")
    item = F.concat(F.lit("<item><title><![CDATA["), F.coalesce("title", F.lit("")), F.lit("]]></title><link>"), F.coalesce("url", F.lit("")), F.lit("</link><dc:creator>"), F.coalesce("source", F.lit("")), F.lit("</dc:creator></item>"))
    feeds = x.groupBy("domain", F.floor(F.col("doc_id") / 1000).alias("page")).agg(F.concat(F.lit("<rss><channel>"), F.array_join(F.collect_list(item), "\n"), F.lit("</channel></rss>")).alias("xml"))  # a thousand at most
    return feeds.select("domain", F.explode(H.feed_items(F.col("xml"))).alias("i")).select("domain", "i.link", "i.title", "i.author")


def robots_rules(spark, d):
    roles = spark.read.parquet(f"{d}/pages.parquet").where("domain IS NOT NULL AND page_role IS NOT NULL").select("domain", "page_role").distinct()
    lines = F.transform(F.array_sort(F.collect_list("page_role")), lambda r: F.concat(F.lit("Disallow: /"), r, F.lit(": gone")))  # a handful of roles
    text = F.concat(F.lit("User-agent: other\nDisallow: /x\nCrawl-delay: 99\nUser-agent: *\r\nDisallow:\n"), F.array_join(lines, "\n"), F.lit("\nUser-agent: ArchiveBot/2\nDisallow: /tmp\ncrawl-delay: "), (F.count(F.lit(1)) / 2).cast("string"))
    return H.robots_rules(roles.groupBy("domain").agg(text.alias("text")), "domain", "text", "archivebot")


def hocr_parse(spark, d):
    return hocr_of_texts(spread(spark.read.parquet(f"{d}/documents.parquet")))


def hocr_of_texts(documents):
    """Words, mean confidence and right edge of hOCR made of all words of a text; confidences repeat from 60 to 99."""
    words = F.filter(F.split(F.replace("text", F.lit("<"), F.lit("(")), r"\s+"), lambda w: w != "")
    spans = F.transform(words, lambda w, i: F.concat(F.lit("<span class='ocrx_word' id='w' title='bbox "), (i * 10).cast("string"), F.lit(" 5 "), (i * 10 + 8).cast("string"), F.lit(" 20; x_wconf "), (60 + i % 40).cast("string"), F.lit("'>"), w, F.lit("</span>")))
    y = documents.where("text IS NOT NULL AND trim(text) != ''").select("doc_id", H.hocr_words(F.array_join(spans, "\n")).alias("w"))
    return y.where("size(w) > 0").select("doc_id", F.size("w").alias("words"), (F.floor(F.expr("aggregate(transform(w, x -> double(x.conf)), double(0), (a, b) -> a + b)") / F.size("w") * 100 + 0.5) / 100).alias("confidence"), F.array_max(F.transform("w", lambda v: v["x2"])).alias("right"))


def frontmatter(spark, d):
    x = spark.read.parquet(f"{d}/documents.parquet")
    head = H.frontmatter([("title", F.col("title")), ("source", F.col("source")), ("url", F.col("url")), ("chars", F.col("n_chars"))])
    y = x.select("doc_id", head.alias("head")).withColumn("m", H.frontmatter_map(F.col("head")))
    return y.select("doc_id", "head", F.try_element_at("m", F.lit("source")).alias("source"))


def backlinks_paragraph(spark, d):
    m = spark.read.parquet(f"{d}/md_texts.parquet").distinct()
    md = H.with_backlinks(F.col("md_text"), F.concat(F.lit("https://x.example/"), "md_path"), F.col("page_no"), "visible")
    return m.select("md_path", "page_no", F.md5(md.cast("binary")).alias("markdown_md5"))


def backlinks_page(spark, d):
    m = spark.read.parquet(f"{d}/md_texts.parquet").distinct()
    md = H.with_backlinks(F.col("md_text"), F.concat(F.lit("https://x.example/"), "md_path"), F.col("page_no"), per_page=True)
    return m.select("md_path", "page_no", F.md5(md.cast("binary")).alias("markdown_md5"))


def page_search(spark, d):
    m = spark.read.parquet(f"{d}/md_texts.parquet").distinct()
    return m.where(F.lower("md_text").contains("garden")).select("md_path", "page_no")


def html_markdown(spark, d):
    from archivolt.session import ship_package

    ship_package(spark)
    return dom.html_to_markdown(_pages(spark, d), "doc_id", "html", exclude=("nav",))


QUERIES = {f.__name__: f for f in (extract_links, strip_html, meta_tags_map, page_metadata, noarchive_pages, html_shells, sitemap_parse, rss_items, robots_rules, hocr_parse, frontmatter, backlinks_paragraph, backlinks_page, page_search, html_markdown)}

_P = f"p AS (SELECT doc_id, url, title, source, lang, {PAGE} AS html FROM documents)"


def _decode(x: str) -> str:
    for name, sign in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "''"), ("&nbsp;", " "), ("&aacute;", "á"), ("&eacute;", "é"), ("&iacute;", "í"), ("&amp;", "&")):
        x = f"replace({x}, '{name}', '{sign}')"
    return f"regexp_replace({x}, '(?i)&[a-z]+;', ' ', 'g')"


def _collapse(x: str) -> str:
    return f"regexp_replace(regexp_replace({x}, '{WS}+', ' ', 'g'), '^ | $', '', 'g')"


def _body(x: str) -> str:
    return _collapse(_decode(f"regexp_replace(regexp_replace({x}, '(?i)<(?:script|style)[\\s\\S]*?</(?:script|style)>', ' ', 'g'), '<[^>]+>', ' ', 'g')"))


_HREF = "(?i)<a\\b[^>]*?href=[\"'']([^\"'']*)[\"''][^>]*>([\\s\\S]*?)</a>"
_LINKS = f"l AS (SELECT doc_id, html, list_filter(list_zip(regexp_extract_all(html, '{_HREF}', 1), regexp_extract_all(html, '{_HREF}', 2)), lambda z: z[1] <> '' AND NOT regexp_matches(z[1], '^(#|mailto:|javascript:|data:)')) AS l FROM p)"
_TITLE = "nullif(trim(title), '')"

ORACLE = {
    "extract_links": f"WITH {_P}, {_LINKS}, e AS (SELECT doc_id, unnest(l) AS z, generate_subscripts(l, 1) - 1 AS n FROM l) SELECT doc_id, CAST(n AS INTEGER) AS n, z[1] AS href, {_body('z[2]')} AS label FROM e",
    "strip_html": f"WITH {_P} SELECT doc_id, md5({_body('html')}) AS text_md5 FROM p",
    "meta_tags_map": f"WITH {_P} SELECT doc_id, nullif(source, '') AS author, CASE WHEN doc_id % 3 = 0 THEN 'OG ' || doc_id END AS og_title, CASE WHEN doc_id % 7 = 0 THEN 'noindex, noarchive' END AS robots, (CASE WHEN coalesce(source, '') <> '' THEN 1 ELSE 0 END) + (CASE WHEN doc_id % 3 = 0 THEN 1 ELSE 0 END) + (CASE WHEN doc_id % 7 = 0 THEN 1 ELSE 0 END) AS n FROM p",
    "page_metadata": f"WITH {_P}, t AS (SELECT *, nullif({_collapse(_decode('coalesce(title, chr(32))'))}, '') AS ti FROM p) SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN 'OG ' || doc_id ELSE coalesce(ti, 'Untitled') END AS title, CASE WHEN doc_id % 3 = 0 THEN 'og' WHEN ti IS NOT NULL THEN 'meta' ELSE 'h1' END AS title_source, nullif(source, '') AS author, coalesce(lang, 'en') AS language, CASE WHEN doc_id % 2 = 0 THEN coalesce(url, 'none') ELSE coalesce(url, 'https://x.example/none.html') END AS canonical_url FROM t",
    "noarchive_pages": "SELECT doc_id FROM documents WHERE doc_id % 7 = 0",
    "html_shells": f"WITH {_P}, w AS (SELECT doc_id, len(list_filter(string_split({_body('html')}, ' '), lambda w: length(w) > 2)) AS n FROM p) SELECT doc_id, n AS words, CAST(n < 100 AS INTEGER) AS shell FROM w",
    "sitemap_parse": "SELECT DISTINCT source_sitemap, 'urlset' AS kind, url, nullif(trim(lastmod), '') AS lastmod FROM sitemaps WHERE source_sitemap IS NOT NULL",
    "rss_items": "SELECT domain, url AS link, trim(coalesce(title, '')) AS title, trim(coalesce(source, '')) AS author FROM documents WHERE domain IS NOT NULL AND url IS NOT NULL AND url <> ''",
    "robots_rules": "WITH r AS (SELECT DISTINCT domain, page_role FROM pages WHERE domain IS NOT NULL AND page_role IS NOT NULL), c AS (SELECT domain, CAST(count(*) / 2 * 1000 AS BIGINT) AS delay_ms FROM r GROUP BY domain) SELECT domain, '/' || page_role AS prefix, delay_ms FROM r JOIN c USING (domain) UNION ALL SELECT domain, '/tmp', delay_ms FROM c",
    "hocr_parse": r"WITH n AS (SELECT doc_id, len(list_filter(regexp_split_to_array(text, '[ \t\n\x0B\f\r]+'), lambda w: w <> '')) AS n FROM documents WHERE text IS NOT NULL AND trim(text) <> '') SELECT doc_id, n AS words, floor((60 + (floor(n / 40) * 780 + (n % 40) * (n % 40 - 1) / 2.0) / n) * 100 + 0.5) / 100 AS confidence, CAST((n - 1) * 10 + 8 AS INTEGER) AS right FROM n WHERE n > 0",
    "frontmatter": r"""WITH f AS (SELECT doc_id, source, list_filter([CASE WHEN contains(title, ': ') OR starts_with(title, '"') OR starts_with(title, '''') THEN 'title: "' || replace(replace(title, '\', '\\'), '"', '\"') || '"' ELSE 'title: ' || title END, 'source: ' || source, CASE WHEN contains(url, ': ') THEN 'url: "' || url || '"' ELSE 'url: ' || url END, 'chars: ' || n_chars], lambda x: x IS NOT NULL) AS r FROM documents)
SELECT doc_id, '---' || chr(10) || array_to_string(r, chr(10)) || chr(10) || '---' || chr(10) || chr(10) AS head, source FROM f""",
    "backlinks_paragraph": r"""WITH m AS (SELECT DISTINCT md_path, page_no, md_text FROM md_texts), s AS (SELECT *, ' [↗ p.' || page_no || '](https://x.example/' || md_path || '#page=' || page_no || ')' AS link FROM m)
SELECT md_path, page_no, md5(array_to_string(list_transform(regexp_split_to_array(md_text, '\n{2,}'), lambda p: CASE WHEN trim(p) <> '' THEN p || link ELSE p END), chr(10) || chr(10))) AS markdown_md5 FROM s""",
    "backlinks_page": r"""WITH m AS (SELECT DISTINCT md_path, page_no, md_text FROM md_texts)
SELECT md_path, page_no, md5('## Page ' || page_no || ' [↗](https://x.example/' || md_path || '#page=' || page_no || ')' || chr(10) || chr(10) || array_to_string(regexp_split_to_array(md_text, '\n{2,}'), chr(10) || chr(10))) AS markdown_md5 FROM m""",
    "page_search": "SELECT DISTINCT md_path, page_no FROM md_texts WHERE contains(lower(md_text), 'garden')",
}
