"""Web documents by regular expressions, as column expressions: links, metadata, text, feeds, sitemaps, robots, hOCR."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from archivolt.functions.constants import WS
from archivolt.functions.moments import iso_moment, moment_micros
from archivolt.functions.text import jaccard, let
from archivolt.functions.urls import first_match, resolved

LINK = r"(?i)<a\b[^>]*?href=[\"']([^\"']*)[\"'][^>]*>([\s\S]*?)</a>"
META = r"(?i)<meta\b[^>]*>"
SCRIPT = r"(?i)<(?:script|style)[\s\S]*?</(?:script|style)>"


def decoded_entities(text: Column) -> Column:
    """The common named and numeric entities; others of letters become a space."""
    for name, sign in (("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " "), ("&aacute;", "á"), ("&eacute;", "é"), ("&iacute;", "í"), ("&amp;", "&")):
        text = F.replace(text, F.lit(name), F.lit(sign))
    return F.regexp_replace(text, "(?i)&[a-z]+;", " ")


def collapsed(text: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(text, WS + "+", " "), "^ | $", "")


def body_text(html: Column) -> Column:
    """Visible text: no scripts, styles and tags, entities decoded, white space collapsed."""
    bare = F.regexp_replace(F.regexp_replace(F.coalesce(html, F.lit("")), SCRIPT, " "), "<[^>]+>", " ")
    return collapsed(decoded_entities(bare))


def links(html: Column) -> Column:
    """array<struct<href, label>> in order; empty, in-page, mail, script and data links left out."""
    hrefs, labels = F.regexp_extract_all(html, F.lit(LINK), F.lit(1)), F.regexp_extract_all(html, F.lit(LINK), F.lit(2))
    pairs = F.arrays_zip(hrefs.alias("href"), F.transform(labels, body_text).alias("label"))
    return F.filter(pairs, lambda p: (p["href"] != "") & ~p["href"].rlike("^(#|mailto:|javascript:|data:)"))


def meta_tags(html: Column) -> Column:
    """map of lower-case name or property to content; the last wins, tags without content are left out."""
    tags = F.regexp_extract_all(html, F.lit(META), F.lit(0))
    pairs = F.transform(tags, lambda t: F.struct(F.lower(F.regexp_extract(t, r"(?i)(?:property|name)=[\"']([^\"']+)[\"']", 1)).alias("k"), F.regexp_extract(t, r"(?i)content=[\"']([^\"']*)[\"']", 1).alias("v")))
    given = F.filter(pairs, lambda p: (p["k"] != "") & (p["v"] != ""))
    last = lambda kept: F.filter(kept, lambda p, i: ~F.exists(F.slice(kept, i + 2, F.greatest(F.lit(0), F.size(kept) - i - 1)), lambda q: q["k"] == p["k"]))
    return let(given, lambda kept: F.map_from_entries(last(kept)))


def tag_text(html: Column, tag: str) -> Column:
    """Text of the first such element, NULL if missing or blank."""
    t = collapsed(decoded_entities(F.regexp_replace(F.regexp_extract(html, rf"(?i)<{tag}\b[^>]*>([\s\S]*?)</{tag}>", 1), "<[^>]+>", "")))
    return F.nullif(t, F.lit(""))


def json_ld(html: Column, types: list[str]) -> Column:
    """The first JSON-LD block that is JSON and whose @type is, or lists, one of the types; NULL without any."""
    blocks = F.transform(F.regexp_extract_all(html, F.lit(r"(?i)<script[^>]*application/ld\+json[^>]*>([\s\S]*?)</script>"), F.lit(1)), lambda b: F.trim(b))
    told = lambda b: F.get_json_object(b, "$['@type']")
    listed = lambda b: F.coalesce(F.arrays_overlap(F.from_json(told(b), "array<string>"), F.array(*map(F.lit, types))), F.lit(False))
    fits = lambda b: F.try_parse_json(F.nullif(b, F.lit(""))).isNotNull() & F.coalesce(told(b).isin(types) | (told(b).startswith("[") & listed(b)), F.lit(False))
    return F.get(F.filter(blocks, fits), F.lit(0))


#: Types of what a page is described as.
ARTICLES = ["Article", "NewsArticle", "BlogPosting", "WebPage"]


def authors(json: Column) -> Column:
    """array<struct<name, url, bio, job_title, organization>> of a JSON-LD author: a string, an object or a list of either;
    nameless ones are dropped."""
    j = F.trim(json)
    many = F.from_json(F.when(j.startswith("["), j).when(j.startswith("{"), F.concat(F.lit("["), j, F.lit("]"))), "array<string>")
    many = F.coalesce(many, F.when(j != "", F.array(j)))
    of = lambda a, k: F.when(a.startswith("{"), F.get_json_object(a, f"$.{k}"))
    each = F.transform(many, lambda a: F.struct(F.when(a.startswith("{"), F.get_json_object(a, "$.name")).otherwise(a).alias("name"), of(a, "url").alias("url"), of(a, "description").alias("bio"), of(a, "jobTitle").alias("job_title"), of(a, "worksFor.name").alias("organization")))
    kept = F.filter(each, lambda a: F.coalesce(F.trim(a["name"]), F.lit("")) != "")
    return F.coalesce(kept, F.array().cast("array<struct<name:string,url:string,bio:string,job_title:string,organization:string>>"))


def metadata(html: Column, url: Column, last_modified: Column | None = None) -> Column:
    """struct(title, title_source, author, authors, language, keywords, canonical_url, schema_type, published, modified) by
    fallback chains; moments as ISO-8601 in UTC, `author` the first author's name."""
    file_name = F.regexp_replace(F.regexp_extract(url, "([^/]*)$", 1), r"\.\w+$", "")
    canonical = F.nullif(F.regexp_extract(html, r"(?i)<link\b[^>]*rel=[\"']canonical[\"'][^>]*href=[\"']([^\"']+)[\"']", 1), F.lit(""))
    byline = r"(?i)<(\w+)\b[^>]*(?:class=[\"'](?:[^\"']*\s)?(?:byline|author)(?:\s[^\"']*)?[\"']|rel=[\"']author[\"'])[^>]*>([\s\S]*?)</\1>"

    def chains(x: Column) -> Column:
        get = lambda k: F.nullif(F.try_element_at(x["meta"], F.lit(k)), F.lit(""))
        of = lambda k: F.nullif(F.get_json_object(x["ld"], f"$.{k}"), F.lit(""))
        chain = [("json_ld", F.coalesce(of("headline"), of("name"))), ("og", get("og:title")), ("meta", x["title"]), ("h1", x["h1"])]
        source = F.lit("filename")
        for name, c in reversed(chain):
            source = F.when(c.isNotNull(), name).otherwise(source)
        named = authors(of("author"))
        written = F.coalesce(get("author"), get("dc.creator"), F.nullif(body_text(F.regexp_extract(html, byline, 2)), F.lit("")))
        lone = F.array(F.struct(written.alias("name"), *[F.lit(None).cast("string").alias(k) for k in ("url", "bio", "job_title", "organization")]))
        people = F.when(F.size(named) > 0, named).when(written.isNotNull(), lone).otherwise(named)
        words = F.filter(F.transform(F.split(F.coalesce(get("keywords"), F.lit("")), ","), lambda w: F.trim(w)), lambda w: w != "")
        said = of("keywords")
        listed = F.when(said.startswith("["), F.from_json(said, "array<string>")).when(said.isNotNull(), F.array(said)).otherwise(F.array().cast("array<string>"))
        kind = F.coalesce(F.get(F.from_json(F.get_json_object(x["ld"], "$['@type']"), "array<string>"), F.lit(0)), F.get_json_object(x["ld"], "$['@type']"))
        first = lambda *moments: iso_moment(F.coalesce(*[moment_micros(m) for m in moments], *([moment_micros(last_modified)] if last_modified is not None else [])))
        return F.struct(
            F.coalesce(*[c for _, c in chain], file_name).alias("title"), source.alias("title_source"), F.get(people, F.lit(0))["name"].alias("author"), people.alias("authors"),
            F.nullif(F.regexp_extract(html, r"(?i)<html\b[^>]*\blang=[\"']([a-zA-Z]+)", 1), F.lit("")).alias("language"), F.array_distinct(F.concat(words, F.coalesce(listed, F.array().cast("array<string>")))).alias("keywords"),
            F.coalesce(canonical, get("og:url"), url).alias("canonical_url"), kind.alias("schema_type"), first(of("datePublished"), get("article:published_time")).alias("published"), first(of("dateModified"), get("article:modified_time")).alias("modified"),
        )

    return let(F.struct(json_ld(html, ARTICLES).alias("ld"), meta_tags(html).alias("meta"), tag_text(html, "title").alias("title"), tag_text(html, "h1").alias("h1")), chains)


def may_not_be_archived(html: Column) -> Column:
    return F.coalesce(F.try_element_at(meta_tags(html), F.lit("robots")).rlike("(?i)noarchive"), F.lit(False))


def text_words(html: Column) -> Column:
    """Words of more than two characters in the visible text."""
    return F.size(F.filter(F.split(body_text(html), " "), lambda w: F.length(w) > 2))


def is_shell(html: Column, least: int = 100) -> Column:
    """Whether a page holds so few words that it must be rendered to be read."""
    return text_words(html) < least


def worth_rendering(static_html: Column, rendered_html: Column) -> Column:
    """Whether rendering a page brought more than three times the words, and more than a hundred."""
    before, after = text_words(static_html), text_words(rendered_html)
    return (after > 3 * before) & (after > 100)


#: Extensions of documents.
DOCUMENTS = "pdf doc docx odt epub txt".split()


def anchors(html: Column) -> Column:
    """array<struct<href, label>> of all anchors with a link, in order."""
    hrefs, labels = F.regexp_extract_all(html, F.lit(LINK), F.lit(1)), F.regexp_extract_all(html, F.lit(LINK), F.lit(2))
    return F.arrays_zip(hrefs.alias("href"), F.transform(labels, body_text).alias("label"))


def links_document(href: Column) -> Column:
    """Whether a link ends in a document's extension, a query aside."""
    return F.substring_index(F.lower(F.substring_index(href, ".", -1)), "?", 1).isin(DOCUMENTS) & href.contains(".")


def page_features(html: Column, title: Column) -> Column:
    """struct(words, links, document_links, overlap, words_per_link): what a page's role is told from. `overlap` is the
    greatest likeness of the title to the label, or else the file name, of a linked document."""
    said = lambda p: F.coalesce(F.nullif(p["label"], F.lit("")), F.regexp_replace(F.substring_index(p["href"], "/", -1), r"\.\w+$", ""))
    words = F.size(F.filter(F.split(body_text(html), " "), lambda w: w != ""))

    def counts(found: Column) -> Column:
        docs = F.filter(found, lambda p: links_document(p["href"]))
        alike = F.array_max(F.transform(docs, lambda p: jaccard(F.coalesce(title, F.lit("")), said(p))))
        return F.struct(words.alias("words"), F.size(found).alias("links"), F.size(docs).alias("document_links"), F.coalesce(alike, F.lit(0.0)).alias("overlap"))

    per = lambda c: F.when(c["links"] > 0, c["words"] / c["links"]).otherwise(c["words"].cast("double"))
    return let(let(anchors(html), counts), lambda c: F.struct(c["words"].alias("words"), c["links"].alias("links"), c["document_links"].alias("document_links"), c["overlap"].alias("overlap"), per(c).alias("words_per_link")))


def page_role(features: Column, least_words: int = 100) -> Column:
    """host_page, redirect, index or content, from `page_features`."""
    f = features
    return F.when((f["words"] < least_words) & (f["document_links"] >= 1), "host_page").when((f["words"] < 50) & (f["links"] == 1), "redirect").when((f["words_per_link"] < 5) & (f["links"] > 10), "index").otherwise("content")


def classified(html: Column, url: Column, overrides: list[tuple[str, str]], least_words: int = 100) -> Column:
    """struct(role, method, words): by the first rule (pattern of the url, role) that fits, else by the page's features."""
    title = F.coalesce(tag_text(html, "title"), tag_text(html, "h1"), F.lit(""))
    ruled = first_match(url, overrides) if overrides else F.lit(None).cast("string")
    return let(page_features(html, title), lambda f: F.struct(F.coalesce(ruled, page_role(f, least_words)).alias("role"), F.when(ruled.isNotNull(), "rules").otherwise("heuristic").alias("method"), F.when(ruled.isNull(), f["words"]).alias("words")))


def host_edges(pages: DataFrame, url: str, html: str) -> DataFrame:
    """(host_url, hosted_url, hosted_title): documents that pages link to; of several labels in a page the last counts."""
    found = pages.select(F.col(url).alias("host_url"), F.posexplode(F.filter(anchors(F.col(html)), lambda p: links_document(p["href"]))).alias("n", "p"))
    edges = found.select("host_url", "n", resolved(F.col("p.href"), F.col("host_url")).alias("hosted_url"), F.coalesce(F.nullif(F.col("p.label"), F.lit("")), F.substring_index("p.href", "/", -1)).alias("hosted_title"))
    return edges.groupBy("host_url", "hosted_url").agg(F.max_by("hosted_title", "n").alias("hosted_title"))


def sitemap_entries(xml: Column) -> Column:
    """array<struct<kind, url, lastmod>>: entries of a url set or of an index; empty for anything else."""
    index = xml.rlike("(?i)<sitemapindex[ >]")
    blocks = F.regexp_extract_all(xml, F.lit(r"(?i)<(?:url|sitemap)>([\s\S]*?)</(?:url|sitemap)>"), F.lit(1))
    of = lambda b, tag: F.nullif(decoded_entities(F.trim(F.regexp_extract(b, rf"<{tag}>\s*([\s\S]*?)\s*</{tag}>", 1))), F.lit(""))
    return F.filter(F.transform(F.coalesce(blocks, F.array().cast("array<string>")), lambda b: F.struct(F.when(index, "index").otherwise("urlset").alias("kind"), of(b, "loc").alias("url"), of(b, "lastmod").alias("lastmod"))), lambda e: e["url"].isNotNull())


def feed_items(xml: Column) -> Column:
    """array<struct<link, title, published, author, description>> of a feed; items without link are left out."""
    blocks = F.regexp_extract_all(xml, F.lit(r"<item>([\s\S]*?)</item>"), F.lit(1))
    of = lambda b, tag: F.trim(F.regexp_extract(b, rf"<{tag}>(?:<!\[CDATA\[)?([\s\S]*?)(?:\]\]>)?</{tag}>", 1))
    items = F.transform(blocks, lambda b: F.struct(of(b, "link").alias("link"), of(b, "title").alias("title"), of(b, "pubDate").alias("published"), of(b, "dc:creator").alias("author"), of(b, "description").alias("description")))
    return F.filter(items, lambda i: i["link"] != "")


def robots_rules(robots: DataFrame, key: str, text: str, agent: str) -> DataFrame:
    """(key, prefix, delay_ms): disallowed prefixes for `*` and agents that contain `agent`, and the longest crawl delay.

    The last User-agent line before a rule decides; Allow is not looked at; a value ends at its next colon.
    """
    lines = robots.select(key, F.posexplode(F.split(F.coalesce(text, F.lit("")), "\n")).alias("n", "line")).withColumn("line", F.trim(F.regexp_replace("line", "\r", "")))
    named = F.when(F.col("line").startswith("User-agent:"), F.trim(F.get(F.split("line", ":"), F.lit(1))))
    active = F.last(named, ignorenulls=True).over(Window.partitionBy(key).orderBy("n").rowsBetween(Window.unboundedPreceding, 0))
    told = lines.withColumn("agent", active).where((F.col("agent") == "*") | F.lower("agent").contains(agent.lower()))
    rule = F.when(F.col("line").startswith("Disallow:"), F.nullif(F.trim(F.get(F.split("line", ":"), F.lit(1))), F.lit("")))
    delay = F.when(F.lower("line").startswith("crawl-delay:"), F.expr("try_cast(trim(substring_index(line, ':', -1)) AS double)") * 1000)
    flat = told.select(key, rule.alias("prefix"), delay.alias("d"))
    longest = flat.groupBy(key).agg(F.max("d").cast("long").alias("delay_ms"))
    return flat.where("prefix IS NOT NULL").select(key, "prefix").distinct().join(longest, key, "full")


def hocr_words(hocr: Column) -> Column:
    """array<struct<text, x1, y1, x2, y2, conf>> of recognised words; blank ones are left out."""
    span = r"<span[^>]*class=['\"]ocrx_word['\"][^>]*title=['\"]bbox (\d+) (\d+) (\d+) (\d+);[^'\"]*?x_wconf (\d+)[^'\"]*['\"][^>]*>([\s\S]*?)</span>"
    parts = [F.regexp_extract_all(hocr, F.lit(span), F.lit(i)) for i in range(1, 7)]
    zipped = F.arrays_zip(*[p.alias(n) for p, n in zip(parts, ("x1", "y1", "x2", "y2", "conf", "text"))])
    words = F.transform(zipped, lambda z: F.struct(F.trim(decoded_entities(F.regexp_replace(z["text"], "<[^>]+>", ""))).alias("text"), *[z[n].cast("int").alias(n) for n in ("x1", "y1", "x2", "y2", "conf")]))
    return F.filter(words, lambda w: w["text"] != "")


def frontmatter(fields: list[tuple[str, Column]], quote: bool = True) -> Column:
    """A YAML head: NULLs left out; strings that would not be plain YAML quoted as JSON if `quote`."""
    rows = []
    for name, c in fields:
        s = c.cast("string")
        risky = s.contains(": ") | s.startswith('"') | s.startswith("'")
        escaped = F.concat(F.lit('"'), F.replace(F.replace(s, F.lit("\\"), F.lit("\\\\")), F.lit('"'), F.lit('\\"')), F.lit('"'))
        rows.append(F.concat(F.lit(f"{name}: "), F.when(risky, escaped).otherwise(s) if quote else s))
    return F.concat(F.lit("---\n"), F.array_join(F.array_compact(F.array(*rows)), "\n"), F.lit("\n---\n\n"))


def frontmatter_map(markdown: Column) -> Column:
    """map of the `key: value` lines of a YAML head, values without surrounding quotes; empty without a head."""
    head = F.regexp_extract(markdown, r"^---\n([\s\S]*?)\n---", 1)
    pairs = F.filter(F.split(head, "\n"), lambda r: r.rlike(r"^\w+: "))
    return F.map_from_entries(F.transform(pairs, lambda r: F.struct(F.substring_index(r, ": ", 1), F.regexp_replace(F.regexp_replace(r, r"^\w+: ", ""), "^[\"']|[\"']$", ""))))


def with_backlinks(text: Column, url: Column, page: Column, style: str = "visible", per_page: bool = False) -> Column:
    """A page's Markdown with a link back to the page of its source, after each paragraph or as a heading."""
    anchor = F.concat(url, F.lit("#page="), page.cast("string"))
    paragraphs = F.split(text, r"\n{2,}")
    if per_page:
        return F.concat(F.lit("## Page "), page.cast("string"), F.lit(" [↗]("), anchor, F.lit(")\n\n"), F.array_join(paragraphs, "\n\n"))

    def linked(p: Column, i: Column) -> Column:
        seen = F.concat(F.lit(" [↗ p."), page.cast("string"), F.lit("]("), anchor, F.lit(")"))
        span = F.concat(F.lit('\n<span data-pdf-page="'), page.cast("string"), F.lit('" data-pdf-para="'), (i + 1).cast("string"), F.lit('" data-pdf-src="'), anchor, F.lit('"></span>'))
        tail = seen if style == "visible" else span if style == "comment" else F.concat(seen, span)
        return F.when(F.trim(p) != "", F.concat(p, tail)).otherwise(p)

    return F.array_join(F.transform(paragraphs, linked), "\n\n")
