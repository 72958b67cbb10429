"""Keyed state transitions as pure functions (old table, batch) -> new table: MERGE without a lakehouse.

One full outer join on the key each; nothing is updated in place, so a lost task is simply run again. `now` is always
a parameter. Keys must not be NULL (such rows are ignored in batches); of several batch rows of one key the last by
`order` counts, ties by the whole row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F


def last_per_key(batch: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row per key: the greatest by `order`, then by all columns."""
    rest = [c for c in batch.columns if c not in keys and c not in order]
    packed = batch.where(" AND ".join(f"`{k}` IS NOT NULL" for k in keys)).groupBy(*keys).agg(F.max(F.struct(*order, *rest)).alias("__row"))
    return packed.select(*keys, *[F.col("__row")[c].alias(c) for c in [*order, *rest]]).select(*batch.columns)


def upsert(old: DataFrame, batch: DataFrame, keys: list[str], mode: str = "update", rules: dict[str, Column] | None = None) -> DataFrame:
    """`old` with the rows of `batch` (one per key) put in.

    mode `update`: columns the batch lacks keep their old value; `replace`: they become NULL, as a replaced row loses
    what is not given again; `ignore`: keys that exist stay as they are. `rules` gives a matched column its value from
    `old.<c>` and `new.<c>`.
    """
    rules = rules or {}
    a, b = old.withColumn("__old", F.lit(True)).alias("old"), batch.withColumn("__new", F.lit(True)).alias("new")
    joined = a.join(b, [F.col(f"old.{k}") == F.col(f"new.{k}") for k in keys], "full")
    had, has = F.col("__old").isNotNull(), F.col("__new").isNotNull()
    out = []
    for c in old.columns:
        before = F.col(f"old.{c}")
        given = F.col(f"new.{c}") if c in batch.columns else F.lit(None).cast(old.schema[c].dataType)
        if c in keys:
            out.append(F.coalesce(before, given).alias(c))
        elif mode == "ignore":
            out.append(F.when(had, before).otherwise(given).alias(c))
        elif c in rules:
            out.append(F.when(had & has, rules[c]).when(has, given).otherwise(before).alias(c))
        elif mode == "update" and c not in batch.columns:
            out.append(before.alias(c))
        else:
            out.append(F.when(has, given).otherwise(before).alias(c))
    return joined.select(*out)


def upsert_pages(old: DataFrame, visits: DataFrame) -> DataFrame:
    """Pages after a batch of visits: the change time moves only with a new digest, a page seen again is not gone, a role
    and word count already known survive a visit that brings none."""
    new_digest = F.col("new.content_hash").isNotNull() & ~F.col("new.content_hash").eqNullSafe(F.col("old.content_hash"))
    rules = {
        "first_seen_at": F.col("old.first_seen_at"),
        "last_changed_at": F.when(new_digest, F.col("new.last_seen_at")).otherwise(F.col("old.last_changed_at")),
        "content_hash": F.coalesce("new.content_hash", "old.content_hash"),
        "gone": F.lit(0),
        "gone_since": F.lit(None).cast("string"),
        "page_role": F.coalesce("new.page_role", "old.page_role"),
        "word_count_clean": F.coalesce("new.word_count_clean", "old.word_count_clean"),
    }
    return upsert(old, visits, ["url"], rules={k: v for k, v in rules.items() if k in old.columns})


def mark_absent(old: DataFrame, seen: DataFrame, key: str, flag: str, since: str, now: str) -> DataFrame:
    """Rows whose key is not in `seen` get flag 1 and `since` = now, if not flagged yet; an empty `seen` flags all."""
    s = seen.select(F.col(key).alias("__key")).where("__key IS NOT NULL").distinct().withColumn("__seen", F.lit(True))
    joined = old.join(s, F.col(key) == F.col("__key"), "left")
    absent = F.col("__seen").isNull() & (F.coalesce(F.col(flag), F.lit(0)) == 0)
    return joined.select(*[F.when(absent, F.lit(1)).otherwise(F.col(c)).alias(c) if c == flag else F.when(absent, F.lit(now)).otherwise(F.col(c)).alias(c) if c == since else F.col(c) for c in old.columns])


def mark_stale(pages: DataFrame, cutoff: str, keep: DataFrame, now: str) -> DataFrame:
    """Pages unseen since `cutoff` and not in `keep` (url) become gone at `now`."""
    k = keep.select(F.col("url").alias("__key")).where("__key IS NOT NULL").distinct().withColumn("__keep", F.lit(True))
    joined = pages.join(k, F.col("url") == F.col("__key"), "left")
    stale = (F.col("last_seen_at") < cutoff) & F.col("__keep").isNull() & (F.coalesce("gone", F.lit(0)) == 0)
    return joined.select(*[F.when(stale, F.lit(1)).otherwise(F.col(c)).alias(c) if c == "gone" else F.when(stale, F.lit(now)).otherwise(F.col(c)).alias(c) if c == "gone_since" else F.col(c) for c in pages.columns])


def expired(rows: DataFrame, since: str, now: str, days: int) -> DataFrame:
    """Rows whose marker is set and older than `days` at `now`."""
    return rows.where(F.col(since).isNotNull() & (F.to_timestamp(since) < F.to_timestamp(F.lit(now)) - F.make_dt_interval(F.lit(days))))


def retained(pages: DataFrame, now: str, grace_days: int = 90, keep_days: int = 365) -> DataFrame:
    """Pages after a retention run: those gone for more than `grace_days` become tombstones (archive_only 1, no local file),
    tombstones gone for more than `keep_days` are dropped. A moment that cannot be read keeps its row."""
    stone = F.coalesce("archive_only", F.lit(0)) == 1
    since = F.try_to_timestamp("gone_since")
    before = lambda days: F.coalesce(since < F.to_timestamp(F.lit(now)) - F.make_dt_interval(F.lit(days)), F.lit(False))
    fresh = (F.col("gone") == 1) & ~stone & before(grace_days)
    x = pages.withColumns({"local_path": F.when(F.coalesce(fresh, F.lit(False)), F.lit(None)).otherwise(F.col("local_path")), "archive_only": F.when(F.coalesce(fresh, F.lit(False)), 1).otherwise(F.coalesce("archive_only", F.lit(0)))})
    return x.where(~((F.col("archive_only") == 1) & before(keep_days)))


def unreferenced(assets: DataFrame, now: str, grace_days: int = 90) -> DataFrame:
    """Assets to delete: referenced by nothing, gone for more than `grace_days`, and stored at all."""
    gone = F.try_to_timestamp("gone_since") < F.to_timestamp(F.lit(now)) - F.make_dt_interval(F.lit(grace_days))
    return assets.where((F.coalesce("ref_count", F.lit(0)) == 0) & gone & (F.coalesce("path", F.lit("")) != ""))


def degradation(pages: DataFrame, now: str, window_days: int = 30, loss_share: float = 0.1, least_pages: int = 50, preserve_always: bool = False) -> DataFrame:
    """(domain, lost, added, present, frozen): whether so many more pages went than came within the window that nothing may be
    deleted: more than `loss_share` of the present ones and more than `least_pages`. It clears by itself."""
    since = F.to_timestamp(F.lit(now)) - F.make_dt_interval(F.lit(window_days))
    inside = lambda c: F.coalesce(F.try_to_timestamp(c) >= since, F.lit(False))
    x = pages.groupBy("domain").agg(F.count_if((F.col("gone") == 1) & inside("gone_since")).alias("lost"), F.count_if((F.col("gone") == 0) & inside("first_seen_at")).alias("added"), F.count_if(F.col("gone") == 0).alias("present"))
    return x.withColumn("frozen", F.lit(preserve_always) | (F.col("lost") - F.col("added") > F.greatest(F.col("present") * loss_share, F.lit(float(least_pages)))))


def upsert_sitemaps(old: DataFrame, listed: DataFrame) -> DataFrame:
    """Sitemap entries (url, lastmod, source_sitemap, first_seen_at, last_seen_at, removed, removed_at) after a listing: an entry
    seen again keeps when it was first seen and is not removed."""
    rules = {"first_seen_at": F.col("old.first_seen_at"), "removed": F.lit(0), "removed_at": F.lit(None).cast("string")}
    return upsert(old, listed, ["url"], rules={k: v for k, v in rules.items() if k in old.columns})


def upsert_assets(old: DataFrame, seen: DataFrame) -> DataFrame:
    """Assets (hash, ..., last_seen_at, gone_since) after a visit: one known already is only touched, and not gone."""
    rules = {c: F.col(f"old.{c}") for c in old.columns if c not in ("hash", "last_seen_at", "gone_since")}
    return upsert(old, seen, ["hash"], rules=rules | {"gone_since": F.lit(None).cast("string")})


def put_values(old: DataFrame, told: DataFrame, order: str) -> DataFrame:
    """(domain, key, value) after a batch of settings; the last by `order` counts."""
    return upsert(old, last_per_key(told, ["domain", "key"], [order]).select("domain", "key", "value"), ["domain", "key"])


def run_opened(runs: DataFrame, domain: str, run_id: int, now: str) -> DataFrame:
    """Runs after one begins: those of the site that still run are interrupted."""
    open_ = (F.col("domain") == domain) & (F.col("status") == "running")
    old = runs.withColumns({"status": F.when(open_, "interrupted").otherwise(F.col("status")), "finished_at": F.when(open_, F.to_timestamp_ntz(F.lit(now))).otherwise(F.col("finished_at"))})
    new = runs.sparkSession.createDataFrame([(run_id, domain, now)], "run_id long, domain string, at string").select("run_id", "domain", F.to_timestamp_ntz("at").alias("started_at"), F.lit("running").alias("status"))
    return old.unionByName(new, allowMissingColumns=True).select(*runs.columns)


def run_closed(runs: DataFrame, run_id: int, now: str, **told) -> DataFrame:
    """Runs after one ends, with the columns it reports."""
    mine = F.col("run_id") == run_id
    set_ = {"finished_at": F.to_timestamp_ntz(F.lit(now)), **{k: F.lit(v) for k, v in told.items()}}
    return runs.select(*[F.when(mine, set_[c]).otherwise(F.col(c)).alias(c) if c in set_ else F.col(c) for c in runs.columns])


def content_changes(visits: DataFrame, key: str, order: str, digest: Column) -> DataFrame:
    """Every visit with `new`, `changed` or `unchanged` against the last visit of its key that had a digest; NULL without one."""
    w = Window.partitionBy(key).orderBy(order, "__d")
    x = visits.withColumn("__d", digest)
    before = F.last("__d", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, -1))
    kind = F.when(F.col("__d").isNull(), F.lit(None)).when(before.isNull(), "new").when(before == F.col("__d"), "unchanged").otherwise("changed")
    return x.withColumn("content_state", kind).drop("__d")


def reference_counts(edges: DataFrame, node: str, by: str) -> DataFrame:
    """Distinct referrers of each node: insert-or-ignore of edges, then a recount."""
    return edges.where(F.col(node).isNotNull() & F.col(by).isNotNull()).dropDuplicates([node, by]).groupBy(node).agg(F.count(F.lit(1)).alias("ref_count"))
