"""What changed between consecutive full listings.

Every listing is sorted by key and cut into content-defined chunks: a key whose hash is divisible by `chunk_rows`
opens a chunk, so that the same keys open chunks in every listing and an insertion only disturbs its own chunk.
Chunks of neighbouring listings with equal digests are dropped unseen; only the rows of the others are joined.

Scale: one shuffle of the listing by (group, listing, slot); slots are a hash of the key, as many as keep a slot's
share of the largest listing under `slot_rows`, so a group with a third of all rows is spread over many tasks.
Digests are about 1/chunk_rows of the rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from archivolt.functions.moments import moment_micros
from archivolt.session import materialize


def chunked_listing(rows: DataFrame, group: str, listing: str, key: str, newest: list[Column], state: Column, present: Column, chunk_rows: int = 16, slot_rows: int = 200_000) -> DataFrame:
    """Current, present rows of every listing with the chunk they fall in: (grp, seq, slot, chunk, key, state).

    Of several rows of one key in one listing the first by `newest` counts. Rows without group, listing or key are left out.
    """
    base = rows.where(F.col(group).isNotNull() & F.col(listing).isNotNull() & F.col(key).isNotNull())
    largest = base.groupBy(group, listing).count().agg(F.max("count")).first()[0] or 1
    slots = max(1, math.ceil(largest / slot_rows))
    picked = base.select(
        F.col(group).alias("grp"), F.col(listing).alias("seq"), F.pmod(F.xxhash64(F.col(key)), F.lit(slots)).cast("int").alias("slot"),
        F.col(key).alias("key"), state.alias("state"), present.alias("present"), *[c.alias(f"o{i}") for i, c in enumerate(newest)],
    )
    by_key = Window.partitionBy("grp", "seq", "slot", "key").orderBy(*[F.col(f"o{i}").desc_nulls_last() for i in range(len(newest))])
    picked = picked.repartition("grp", "seq", "slot").withColumn("n", F.row_number().over(by_key)).where("n = 1 AND present")
    opens = F.when(F.pmod(F.xxhash64(F.lit("chunk"), F.col("key")), F.lit(chunk_rows)) == 0, F.col("key"))
    sorted_keys = Window.partitionBy("grp", "seq", "slot").orderBy("key").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return picked.select("grp", "seq", "slot", F.coalesce(F.last(opens, ignorenulls=True).over(sorted_keys), F.lit("")).alias("chunk"), "key", "state")


def open_chunks(chunked: DataFrame) -> DataFrame:
    """Chunks that differ from the same chunk of the listing before (`as_new`) or after (`as_old`)."""
    told = [F.coalesce(F.col("state"), F.lit(-(2**62)))]
    digests = chunked.groupBy("grp", "seq", "slot", "chunk").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.shiftright(F.xxhash64("key", *told), 8)).alias("d1"),
        F.bit_xor(F.xxhash64(F.lit("second"), "key", *told)).alias("d2"),
    )
    along = Window.partitionBy("grp", "slot", "chunk").orderBy("seq")
    same = lambda step: F.coalesce(
        (step(F.col("seq"), 1).over(along) == F.col("seq") + F.lit(-1 if step is F.lag else 1)) & (step("n", 1).over(along) == F.col("n")) & (step("d1", 1).over(along) == F.col("d1")) & (step("d2", 1).over(along) == F.col("d2")), F.lit(False)
    )
    flagged = digests.select("grp", "seq", "slot", "chunk", (~same(F.lag)).alias("as_new"), (~same(F.lead)).alias("as_old"))
    return flagged.where("as_new OR as_old")


def diff_listings(chunked: DataFrame, seqs: DataFrame) -> DataFrame:
    """(grp, seq, key, change_kind) of every listing against the one numbered one less; seqs: the (grp, seq) delivered.

    `state` NULL means not given: a row counts as changed when its state is given now and differs from before.
    """
    rows = materialize(chunked, "listing-chunks")
    touched = rows.join(open_chunks(rows), ["grp", "seq", "slot", "chunk"])
    new = touched.where("as_new AND seq > 1").select("grp", "seq", "key", F.col("state").alias("now"), F.lit(1).alias("has_now"))
    old = touched.where("as_old").select("grp", (F.col("seq") + 1).alias("seq"), "key", F.col("state").alias("before"), F.lit(1).alias("had"))
    old = old.join(seqs.select("grp", "seq"), ["grp", "seq"], "left_semi")
    kind = (
        F.when(F.col("had").isNull(), "added")
        .when(F.col("has_now").isNull(), "removed")
        .when(F.col("now").isNotNull() & ~F.col("now").eqNullSafe(F.col("before")), "changed")
    )
    return new.join(old, ["grp", "seq", "key"], "full").select("grp", "seq", "key", kind.alias("change_kind")).where("change_kind IS NOT NULL")


def sitemap_changes(sitemaps: DataFrame, deliveries: DataFrame, chunk_rows: int = 16, slot_rows: int = 200_000) -> DataFrame:
    """Urls added, removed or changed in each delivered snapshot of a domain against its preceding delivered one.

    Result: domain, snapshot_no, url, change_kind. Nulls: rows without domain, snapshot_no or url are ignored; `removed`
    NULL counts as present only if 0 is given, so such a row is absent; unreadable `lastmod` counts as not given.
    Repeated rows: the latest `last_seen_at` counts; ties go to the later `loaded_at`, then the later `lastmod`, then the
    smaller `removed`. A delivered snapshot without rows removes everything. The first snapshot of a domain yields
    nothing; empty inputs give an empty result. Further columns are ignored.
    """
    order = Window.partitionBy("domain").orderBy("snapshot_no")
    numbered = deliveries.select("domain", "snapshot_no").where("domain IS NOT NULL AND snapshot_no IS NOT NULL").distinct().withColumn("seq", F.row_number().over(order))
    listed = sitemaps.select("domain", "snapshot_no", "url", "lastmod", "removed", "last_seen_at", "loaded_at").join(numbered, ["domain", "snapshot_no"])
    listed = listed.withColumn("moment", moment_micros(F.col("lastmod")))
    newest = [F.col("last_seen_at"), F.col("loaded_at"), F.col("moment"), -F.col("removed")]
    chunked = chunked_listing(listed, "domain", "seq", "url", newest, F.col("moment"), F.coalesce(F.col("removed") == 0, F.lit(False)), chunk_rows, slot_rows)
    changes = diff_listings(chunked, numbered.select(F.col("domain").alias("grp"), "seq"))
    return changes.join(numbered.withColumnRenamed("domain", "grp"), ["grp", "seq"]).select(F.col("grp").alias("domain"), "snapshot_no", F.col("key").alias("url"), "change_kind")
