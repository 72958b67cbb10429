"""Answers of a wiki's API and mirrored links, as column expressions."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def wiki_page(json: Column) -> Column:
    """struct(status, title, html) of a `parse` answer: 200 with a page, 404 for a missing or invalid title, 500 for other
    errors, 0 for no answer or none that is JSON."""
    code = F.get_json_object(json, "$.error.code")
    html = F.get_json_object(json, "$.parse.text")
    status = F.when(json.isNull() | F.try_parse_json(json).isNull(), 0).when(code.isin("missingtitle", "invalidtitle"), 404).when(code.isNotNull() | html.isNull(), 500).otherwise(200)
    return F.struct(status.alias("status"), F.get_json_object(json, "$.parse.title").alias("title"), F.when(status == 200, html).alias("html"))


def own_links_relative(text: Column, domain: Column) -> Column:
    """Absolute links to the page's own host become rooted ones."""
    quoted = F.regexp_replace(domain, r"([.\-])", r"\\$1")
    return F.regexp_replace(text, F.concat(F.lit(r"https?://(?:www\.)?"), quoted, F.lit(r"(?=[/\"' ]|$)/?")), F.lit("/"))
