"""Url and path functions as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from archivolt.functions.constants import URL_LANGUAGES
from archivolt.functions.text import detect_language, let


def host(url: Column) -> Column:
    return F.nullif(F.lower(F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]*)", 1)), F.lit(""))


def path(url: Column) -> Column:
    """The path, `/` where there is none."""
    p = F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*([^?#]*)", 1)
    return F.when(p == "", "/").otherwise(p)


def query(url: Column) -> Column:
    """`?` and the query, empty without one."""
    return F.regexp_extract(url, r"^[^?#]*(\?[^#]*)", 1)


def extension(p: Column) -> Column:
    """`.ext` of the last segment, empty where it has none or only begins with a dot."""
    return F.regexp_extract(F.regexp_extract(p, "([^/]*)$", 1), r"^.+(\.[^.]*)$", 1)


def mirror_path(domain: Column, url: Column) -> Column:
    """File of a url below the mirror: index.html for folders, a hash of the query, a hash for names over 200 bytes."""
    p = path(url)
    p = F.when(p.endswith("/") | (extension(p) == ""), F.concat(F.regexp_replace(p, "/$", ""), F.lit("/index.html"))).otherwise(p)
    q, ext = query(url), extension(p)
    with_query = F.concat(F.substring(p, F.lit(1), F.length(p) - F.length(ext)), F.lit("__"), F.substring(F.sha2(q.cast("binary"), 256), 1, 4), ext)
    p = F.when((q != "") & (q != "?"), with_query).otherwise(p)
    last = F.regexp_extract(p, "([^/]*)$", 1)
    short = F.concat(F.substring(p, F.lit(1), F.length(p) - F.length(last)), F.substring(F.sha2(last.cast("binary"), 256), 1, 12), extension(last))
    p = F.when(F.octet_length(last) > 200, short).otherwise(p)
    return F.concat(F.lit("mirror/"), domain, F.lit("/"), F.regexp_replace(p, "^/", ""))


def path_slug(p: Column) -> Column:
    s = F.regexp_replace(F.regexp_replace(F.regexp_replace(p, "^/", ""), "/", "-"), r"\.\w+$", "")
    return F.when(s == "", "index").otherwise(s)


def without_parameters(url: Column, names: list[str]) -> Column:
    """The url without the named query parameters."""
    kept = F.filter(F.split(F.substring(query(url), F.lit(2), F.length(url)), "&"), lambda kv: ~F.substring_index(kv, "=", 1).isin(names) & (kv != ""))
    base, fragment = F.regexp_extract(url, "^[^?#]*", 0), F.regexp_extract(url, "#.*$", 0)
    return F.when(query(url) == "", url).otherwise(F.concat(base, F.when(F.size(kept) > 0, F.concat(F.lit("?"), F.array_join(kept, "&"))).otherwise(""), fragment))


def normalised_feed_url(url: Column) -> Column:
    """No query, fragment or trailing slashes, then one slash."""
    return F.concat(F.regexp_replace(F.regexp_replace(url, r"[?#].*$", ""), "/+$", ""), F.lit("/"))


def without_dot_segments(p: Column) -> Column:
    """A rooted path with its `.` and `..` segments resolved; `..` above the root is the root."""
    parts = F.split(F.regexp_replace(p, "^/", ""), "/")

    def step(kept: Column, part: Column) -> Column:
        return F.when(part == ".", kept).when(part == "..", F.slice(kept, F.lit(1), F.greatest(F.size(kept) - 1, F.lit(0)))).otherwise(F.concat(kept, F.array(part)))

    # a path that ends in a dot segment names a folder
    open_ = F.when(F.element_at(parts, -1).isin(".", ".."), F.concat(parts, F.array(F.lit("")))).otherwise(parts)
    whole = F.concat(F.lit("/"), F.array_join(F.aggregate(open_, F.array().cast("array<string>"), step), "/"))
    return F.when(p.rlike(r"(?:^|/)\.\.?(?:/|$)"), whole).otherwise(p)


def resolved(href: Column, base: Column) -> Column:
    """An absolute url of a link: absolute, scheme-relative, rooted, a query alone, or relative; no fragment.

    Dot segments of http links are resolved; an empty link, or a fragment alone, is the base.
    """
    h = F.regexp_replace(F.replace(F.trim(href), F.lit(" "), F.lit("%20")), "#.*$", "")
    scheme = F.regexp_extract(base, r"^([a-z]+):", 1)
    root = F.regexp_extract(base, r"^[a-z]+://[^/?#]*", 0)
    folder = F.regexp_replace(path(base), "[^/]*$", "")
    whole = (
        F.when(h == "", F.regexp_replace(base, "#.*$", ""))
        .when(h.rlike(r"^[a-zA-Z][a-zA-Z0-9+.-]*:"), h)
        .when(h.startswith("//"), F.concat(scheme, F.lit(":"), h))
        .when(h.startswith("/"), F.concat(root, h))
        .when(h.startswith("?"), F.concat(root, path(base), h))
        .otherwise(F.concat(root, folder, h))
    )
    tidy = F.concat(F.regexp_extract(whole, r"^[a-z]+://[^/?#]*", 0), without_dot_segments(path(whole)), query(whole))
    return F.when(whole.rlike(r"^https?://[^?#]*/\.\.?(?:[/?]|$)"), tidy).otherwise(whole)


def in_scope(url: Column, seed_host: Column, include: list[str], exclude: list[str], allow_domains: list[str] | None = None) -> Column:
    """Whether a url is crawled: its host fits, no excluded prefix, an included one if any are named; no host: no."""
    fits = host(url) == seed_host
    if allow_domains:
        fits = fits | host(url).isin(allow_domains)
    p = path(url)
    for x in exclude:
        fits = fits & ~p.startswith(x)
    if include:
        some = F.lit(False)
        for x in include:
            some = some | p.startswith(x)
        fits = fits & some
    return F.coalesce(fits, F.lit(False))


def _leads(first: int, last: int) -> str:
    """The first bytes of UTF-8 of a range of code points, as a regular expression of percent escapes."""
    return "|".join(f"%{b:02x}" for b in sorted({chr(c).encode()[0] for c in range(first, last + 1)}))


def _escaped(letters: str) -> str:
    return "|".join("".join(f"%{b:02x}" for b in c.encode()) for c in letters)


#: Letters that Persian has and Arabic lacks, as urls are told apart by.
PERSIAN_LETTERS = "پچژگکهی"


def url_language(url: Column) -> Column:
    """Language of a url by percent-encoded script, then by codes and names in its path; NULL if none."""
    u = F.lower(url)
    out = F.lit(None).cast("string")
    for name, keys in reversed(URL_LANGUAGES.items()):
        code, *names = keys.split()
        out = F.when(u.rlike("|".join([f"/{code}/", f"[/_-]{code}[/_-]", *[f"/{n}/" for n in names]])), name).otherwise(out)
    out = F.when(u.rlike(f"(?:{_leads(0x0590, 0x05FF)})%[0-9a-f]{{2}}"), "hebrew").otherwise(out)
    return F.when(u.rlike(f"(?:{_leads(0x0600, 0x06FF)})%[0-9a-f]{{2}}"), F.when(u.rlike(_escaped(PERSIAN_LETTERS)), "persian").otherwise("arabic")).otherwise(out)


def url_path_language(url: Column) -> Column:
    """As `url_language`, else the language of the words in the decoded path; NULL where neither tells one."""
    decoded = F.try_url_decode(F.replace(path(url), F.lit("+"), F.lit("%2B")))
    words = F.filter(F.split(F.lower(F.regexp_replace(decoded, r"[^a-zA-ZÀ-ÿ\s]", " ")), r"\s+"), lambda w: F.length(w) > 2)
    told = let(words, lambda w: F.when(F.size(w) >= 2, detect_language(F.array_join(w, " "))))
    return F.coalesce(url_language(url), told)


def first_match(value: Column, rules: list[tuple[str, str]], default: Column | None = None) -> Column:
    """The result of the first rule (regular expression, result) that finds something."""
    out = F.lit(None).cast("string") if default is None else default
    for pattern, result in reversed(rules):
        out = F.when(value.rlike(pattern), result).otherwise(out)
    return out


def safe_file_name(name: Column) -> Column:
    return F.regexp_replace(name, r"[^\w.-]", "_")
