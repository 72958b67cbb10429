"""Strings and small structures made from a document's row."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from archivolt.functions.html import collapsed
from archivolt.functions.text import let


def _locate(text: Column, part: Column | str, start: Column) -> Column:
    """Place of a part at or after `start`, from 1; 0 without."""
    needle = F.lit(part) if isinstance(part, str) else part
    return F.call_function("locate", needle, text, start)


def free_summary(title: Column, excerpt: Column, domain: Column, most: int = 160) -> Column:
    """`title — excerpt… [domain]`, the excerpt cut at a word's end; parts that are missing are left out."""
    cut = F.when(F.length(excerpt) > most, F.concat(F.regexp_replace(F.substring(excerpt, 1, most), r"\s+\S*$", ""), F.lit("…"))).otherwise(excerpt)
    body = F.concat_ws(" — ", F.nullif(F.trim(title), F.lit("")), F.nullif(F.trim(cut), F.lit("")))
    return F.nullif(F.concat_ws(" ", F.nullif(body, F.lit("")), F.concat(F.lit("["), domain, F.lit("]"))), F.lit(""))


def prompt(fields: list[tuple[str, Column]]) -> Column:
    """`Name: value` lines of what is known; NULL when nothing is."""
    return F.nullif(F.concat_ws("\n", *[F.concat(F.lit(f"{n}: "), F.nullif(F.trim(c), F.lit(""))) for n, c in fields]), F.lit(""))


def plain_text(html: Column) -> Column:
    """Text of a piece of a page: scripts, styles and tags gone, the commonest entities decoded, white space collapsed."""
    t = F.regexp_replace(F.regexp_replace(html, r"(?i)<style[^>]*>[\s\S]*?</style>", " "), r"(?i)<script[^>]*>[\s\S]*?</script>", " ")
    t = F.regexp_replace(t, "<[^>]+>", " ")
    for name, sign in (("&amp;", "&"), ("&gt;", ">"), ("&lt;", "<"), ("&nbsp;", " ")):
        t = F.replace(t, F.lit(name), F.lit(sign))
    return collapsed(F.regexp_replace(t, r"&#\d+;", " "))


def link_context(html: Column, url: Column, near: int = 1000, around: int = 400, most: int = 600, least: int = 30) -> Column:
    """Text of the paragraph around the first mention of a url's file name in a page, or of what stands around it.

    The paragraph's tags must be less than `near` characters away. The name is tried as written, then decoded; NULL if it
    is not mentioned or says `least` characters or fewer.
    """
    name = F.substring_index(url, "/", -1)

    def of(needle: Column) -> Column:
        def cut(at: Column) -> Column:  # `at` counts from 1
            head = F.substring(html, F.lit(1), at + 1)
            opens = F.when(head.contains("<p"), F.length(head) - F.length(F.substring_index(head, "<p", -1)) - 1)
            closes = F.nullif(_locate(html, "</p>", at), F.lit(0))
            start = F.when((opens > 1) & (opens > at - near), opens).otherwise(F.greatest(F.lit(1), at - around))
            end = F.when((closes > 1) & (closes < at + near), closes + 4).otherwise(F.least(F.length(html) + 1, at + around))
            text = F.trim(F.substring(plain_text(F.substring(html, start, end - start)), 1, most))
            return F.when((at > 0) & (F.length(text) > least), text)

        return let(_locate(html, needle, F.lit(1)), cut)

    return F.when(name != "", F.coalesce(of(name), of(F.try_url_decode(F.replace(name, F.lit("+"), F.lit("%2B"))))))


def moving_average(values: Column, weight: float = 0.3) -> Column:
    """Exponential moving average over an ordered array, beginning with its first value; NULL for an empty one."""
    return F.aggregate(F.slice(values, F.lit(2), F.greatest(F.size(values) - 1, F.lit(0))), F.get(values, F.lit(0)), lambda a, x: a * (1 - weight) + x * weight)
