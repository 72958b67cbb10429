"""The list of a site's documents: filters, named orders, pages, and what a row of it shows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from archivolt.functions.constants import LANGUAGE_CODES
from archivolt.functions.summaries import free_summary
from archivolt.functions.text import detect_language, generic_title, title_from_url
from archivolt.operators.relational import page_of

PER_PAGE = 50


def joined(pages: DataFrame, quality: DataFrame, queue: DataFrame) -> DataFrame:
    """Present PDF pages with what is known of them; each input has one row a url. Scores that are no number count as none."""
    p = pages.where((F.col("gone") == 0) & (F.col("mime_type") == "application/pdf")).select("url", "domain", "path_slug")
    x = p.join(quality.drop("domain"), "url", "left").join(queue.drop("domain"), "url", "left")
    return x.withColumn("composite_score", F.nanvl("composite_score", F.lit(None).cast("double")))


def filtered(docs: DataFrame, search: str = "", status: str = "", score_max: float = 1.0, tab: str = "original") -> DataFrame:
    """The rows a list shows. `status`: unscored, skipped or a queue status; `score_max` below 1 keeps unscored ones too."""
    if tab == "upgraded":
        docs = docs.where((F.col("status") == "done") | (F.col("status").isin("pending", "submitted") & F.col("after_score").isNotNull()))
    if search:
        needle = "%" + search.replace("\\", "\\\\").replace("%", "\\%").replace("_", "\\_") + "%"
        hit = F.lit(False)
        for c in ("url", "ai_title", "pdf_title", "excerpt"):
            hit = hit | F.coalesce(F.col(c).ilike(needle), F.lit(False))
        docs = docs.where(hit)
    if status == "unscored":
        docs = docs.where("composite_score IS NULL")
    elif status == "skipped":
        docs = docs.where("skip = 1")
    elif status:
        docs = docs.where(F.col("status") == status)
    return docs.where(F.col("composite_score").isNull() | (F.col("composite_score") <= score_max)) if score_max < 1 else docs


def order_of(name: str | None, tab: str = "original") -> list[Column]:
    """A named order, ties by url. Without one: of upgraded documents those in flight first, then the newest; of all others by
    priority, or by score where there is none."""
    score = F.col("composite_score")
    named = {
        "score_asc": [F.coalesce(score, F.lit(1.0)).asc()],
        "score_desc": [F.coalesce(score, F.lit(0.0)).desc()],
        "pages_desc": [F.coalesce("pages", F.lit(0)).desc()],
        "title_asc": [F.coalesce("ai_title", "pdf_title", "url").asc()],
        "improved_desc": [F.coalesce("score_improvement", F.lit(0.0)).desc()],
    }
    rank = F.when(F.col("status") == "submitted", 0).when(F.col("status") == "pending", 1).when(F.col("status") == "done", 2).otherwise(3)
    first = named.get(name or "") or ([rank.asc(), F.col("finished_at").desc_nulls_last()] if tab == "upgraded" else [F.coalesce("priority", F.coalesce(score, F.lit(0.5)) * 100).desc()])
    return [*first, F.col("url").asc()]


def listed(docs: DataFrame, sort: str | None = "score_asc", page: int = 1, **filters) -> DataFrame:
    """One page of a list with its row numbers; pages below 1 are the first."""
    return page_of(filtered(docs, **filters), order_of(sort, filters.get("tab", "original")), max(1, page), PER_PAGE)


def sizes(docs: DataFrame, **filters) -> DataFrame:
    """(total, pages, per_page) of a list."""
    total = F.count(F.lit(1))
    return filtered(docs, **filters).agg(total.alias("total"), F.ceil(total / PER_PAGE).alias("pages"), F.lit(PER_PAGE).alias("per_page"))


def with_hosts(page: DataFrame, hosts: DataFrame) -> DataFrame:
    """`source_url`: the first page by url that links to each document, looked up for the documents of the page only."""
    wanted = hosts.join(page.select(F.col("url").alias("hosted_url")), "hosted_url", "left_semi")
    first = wanted.groupBy("hosted_url").agg(F.min("host_url").alias("source_url"))
    return page.join(first, F.col("url") == F.col("hosted_url"), "left").drop("hosted_url")


def row_shown(docs: DataFrame) -> DataFrame:
    """(url, title, summary, summary_tier, language, pdf_type, pages_needed, before, after, improvement) of each document.

    A title that says nothing gives way to one made of the url. Image: no text layer or under 0.3 readable; mixed: under 0.7.
    The score before is the queue's, else the document's, else what the improvement leaves; scores after are 1 at most.
    """
    raw = F.coalesce("ai_title", "pdf_title")
    title = F.when(generic_title(raw), F.coalesce(title_from_url(F.col("url")), raw)).otherwise(raw)
    codes = F.create_map(*[F.lit(x) for p in LANGUAGE_CODES.items() for x in p])
    label = F.nullif(F.lower(F.trim("ai_language")), F.lit(""))
    said = F.coalesce(F.try_element_at(codes, label), label)
    readable = F.nanvl("readable_pages_pct", F.lit(None).cast("double"))
    kind = F.when(~F.coalesce(F.col("has_text_layer") == 1, F.lit(False)) | (readable < 0.3), "image").when(readable < 0.7, "mixed").otherwise("text")
    free = free_summary(F.col("pdf_title"), F.col("excerpt"), F.col("domain"))
    after = F.least(F.col("after_score"), F.lit(1.0))
    before = F.coalesce("before_score", "composite_score", F.greatest(F.lit(0.0), after - F.col("score_improvement")))
    x = docs.select("*", title.alias("title"), after.alias("after"), before.alias("before"))
    return x.select(
        "url", "title", F.coalesce("ai_summary", free).alias("summary"), F.coalesce("summary_tier", F.when(F.col("ai_summary").isNull() & free.isNotNull(), "free")).alias("summary_tier"),
        F.coalesce(said, detect_language(F.concat_ws(" ", "excerpt", "title"))).alias("language"), kind.alias("pdf_type"), F.floor(F.coalesce("pages", F.lit(0)) * (1 - F.coalesce(readable, F.lit(0.0))) + 0.5).alias("pages_needed"),
        "before", "after", (F.col("after") - F.col("before")).alias("improvement"),
    )
