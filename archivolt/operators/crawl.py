"""Breadth-first discovery over a table of pages: each level is a join, the visited urls an anti join."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from archivolt.functions import html as H, urls as U
from archivolt.session import materialize


def reachable(seeds: DataFrame, pages: DataFrame, host: str, max_depth: int = 5, include: list[str] | None = None, exclude: list[str] | None = None) -> DataFrame:
    """(url, depth): urls found from the seeds, the least depth each; pages: (url, html).

    Each level is written to the shared folder, so lineage does not grow with depth. Links outside the scope, NULL and
    empty pages lead nowhere; a url without page is found but not followed.
    """
    seen = materialize(seeds.select("url").where("url IS NOT NULL").distinct().withColumn("depth", F.lit(0)), "crawl")
    front = seen
    for depth in range(1, max_depth + 1):
        found = front.join(pages.select("url", "html"), "url").select(F.col("url").alias("base"), F.explode(H.links(F.col("html"))).alias("l"))
        ahead = found.select(U.resolved(F.col("l.href"), F.col("base")).alias("url")).where(U.in_scope(F.col("url"), F.lit(host), include or [], exclude or [])).distinct()
        front = materialize(ahead.join(seen.select("url"), "url", "left_anti").withColumn("depth", F.lit(depth)), "crawl-level")
        if front.isEmpty():
            break
        seen = seen.unionByName(front)
    return seen


def expanded_sitemaps(roots: DataFrame, files: DataFrame, max_depth: int = 5) -> DataFrame:
    """(url, lastmod, source): entries of all url sets reached from the root sitemaps through indexes; files: (url, xml)."""
    front, leaves = roots.select("url").distinct(), None
    seen = front
    for _ in range(max_depth):
        entries = front.join(files, "url").select(F.col("url").alias("source"), F.explode(H.sitemap_entries(F.col("xml"))).alias("e")).select("source", "e.*")
        entries = materialize(entries, "sitemap-level")
        part = entries.where("kind = 'urlset'").select("url", "lastmod", "source")
        leaves = part if leaves is None else leaves.unionByName(part)
        front = entries.where("kind = 'index'").select("url").distinct().join(seen, "url", "left_anti")
        if front.isEmpty():
            break
        seen = seen.unionByName(front)
    # of several entries of a url the latest, then the first sitemap by name
    best = leaves.groupBy("url").agg(F.max(F.struct("lastmod", F.col("source").alias("s"))).alias("m"), F.min("source").alias("source"))
    return best.select("url", F.col("m.lastmod").alias("lastmod"), "source")


def all_unchanged(answers: DataFrame) -> DataFrame:
    """(unchanged): whether every leaf sitemap of (url, depth, status) answered that nothing changed; roots are always read."""
    return answers.agg(F.coalesce(F.bool_and((F.col("depth") > 0) & (F.col("status") == 304)), F.lit(False)).alias("unchanged"))
