"""Relational helpers that Catalyst does not derive on its own."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, functions as F

from archivolt.session import materialize


def semi_reduced(side: DataFrame, keys: DataFrame, on: str, aggregates: list[Column]) -> DataFrame:
    """An aggregate of `side` restricted to the keys that are asked for: the semi join comes before the aggregation."""
    return side.join(keys.select(on).distinct(), on, "left_semi").groupBy(on).agg(*aggregates)


def skip_unchanged(rows: DataFrame, done: DataFrame, key: str, digest: str, done_digest: str) -> DataFrame:
    """Rows whose digest is not the one that was processed: what an expensive step still has to do."""
    d = done.select(F.col(key).alias("__k"), F.col(done_digest).alias("__d")).where("__d IS NOT NULL").distinct()
    return rows.join(d, (F.col(key) == F.col("__k")) & (F.col(digest) == F.col("__d")), "left_anti")


def once_per_digest(rows: DataFrame, digest: str, inputs: list[str], step: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Runs `step` once per distinct digest (adding columns) and joins the result back to all rows."""
    distinct = rows.where(F.col(digest).isNotNull()).groupBy(digest).agg(*[F.min(c).alias(c) for c in inputs])
    made = step(distinct).drop(*inputs)
    return rows.join(made, digest, "left")


def latest(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """The newest row per key, by max over a struct: partial aggregation, no window over a hot key."""
    rest = [c for c in rows.columns if c not in keys and c not in order]
    return rows.groupBy(*keys).agg(F.max(F.struct(*order, *rest)).alias("__m")).select(*keys, *[F.col("__m")[c].alias(c) for c in [*order, *rest]])


def top_per_group(rows: DataFrame, group: str, order: list[Column], n: int) -> DataFrame:
    """The first n rows of each group; Spark limits before the shuffle as well."""
    return rows.withColumn("rn", F.row_number().over(Window.partitionBy(group).orderBy(*order))).where(F.col("rn") <= n)


#: Rows up to which a page's end is found by a top-n, which never sorts more in one place.
TOP_ROWS = 100_000


def numbered(rows: DataFrame, order: list[Column]) -> DataFrame:
    """All rows of a total order with their numbers `rn`: sorted by ranges into the shared folder, the ranges' sizes (one
    number a partition) added up, so that no task sees more than its range."""
    place = F.monotonically_increasing_id()
    x = materialize(rows.orderBy(*order).select("*", F.shiftright(place, 33).cast("int").alias("__p"), place.bitwiseAND(F.lit((1 << 33) - 1)).alias("__i")), "numbered")
    before, start = 0, []
    for r in x.groupBy("__p").agg(F.count(F.lit(1)).alias("n")).orderBy("__p").collect():  # one row a partition
        start.append((r["__p"], before))
        before += r["n"]
    starts = rows.sparkSession.createDataFrame(start, "__p int, __b long")
    return x.join(F.broadcast(starts), "__p").withColumn("rn", F.col("__i") + F.col("__b") + 1).drop("__p", "__i", "__b")


def moving_average(rows: DataFrame, group: str, order: list[str], value: str, weight: float = 0.3) -> DataFrame:
    """(group, average): exponential moving average of `value` over each group's order, beginning with its first value.

    A value's share depends on its distance from the group's end alone, so the places in one sorted table are all that is
    needed: no group is brought together.
    """
    x = numbered(rows.select(group, F.col(value).alias("__x"), F.struct(*order).alias("__o")), [F.col(group).asc(), F.col("__o").asc()])
    ends = x.groupBy(group).agg(F.min("rn").alias("__first"), F.max("rn").alias("__last"))
    share = F.pow(F.lit(1 - weight), F.col("__last") - F.col("rn")) * F.when(F.col("rn") == F.col("__first"), 1.0).otherwise(weight)
    return x.join(ends, group).groupBy(group).agg(F.sum(share * F.col("__x")).alias("average"))


def page_of(rows: DataFrame, order: list[Column], page: int, size: int = 50) -> DataFrame:
    """One page of a total order with its row numbers."""
    if page * size > TOP_ROWS:
        return numbered(rows, order).where((F.col("rn") > (page - 1) * size) & (F.col("rn") <= page * size))
    top = rows.orderBy(*order).limit(page * size)
    return top.withColumn("rn", F.row_number().over(Window.orderBy(*order))).where((F.col("rn") > (page - 1) * size) & (F.col("rn") <= page * size))


def starts_with_any(rows: DataFrame, value: str, prefixes: DataFrame, prefix: str) -> DataFrame:
    """Rows that begin with one of the prefixes, once each: a semi join on the beginning for every length a prefix has,
    instead of a join on all pairs. The lengths are looked up first: one number a length."""
    told = prefixes.where(F.col(prefix).isNotNull()).select(F.col(prefix).alias("__p")).distinct()
    lengths = [r["n"] for r in told.select(F.length("__p").alias("n")).distinct().orderBy("n").collect()]
    if not lengths:
        return rows.limit(0)
    starts = rows.withColumn("__v", F.explode(F.array_distinct(F.transform(F.array(*map(F.lit, lengths)), lambda n: F.substring(F.col(value), F.lit(1), n)))))
    return starts.join(told, F.col("__v") == F.col("__p"), "left_semi").drop("__v").distinct()


def first_elsewhere(rows: DataFrame, digest: str, place: str, key: str, has: Column) -> DataFrame:
    """Rows that lack something, with the first other place (by name, then key) that holds the same digest and has it:
    `source_<place>`, `source_<key>`. Two places a digest are enough to name one that is not the row's own."""
    held = rows.where(F.col(digest).isNotNull() & has).groupBy(digest, place).agg(F.min(key).alias(f"source_{key}")).withColumnRenamed(place, f"source_{place}")
    two = top_per_group(held, digest, [F.col(f"source_{place}").asc()], 2).drop("rn")
    lack = rows.where(F.col(digest).isNotNull() & ~has).select(digest, place, key).distinct()
    both = lack.join(two, digest).where(F.col(place) != F.col(f"source_{place}"))
    best = both.groupBy(digest, place, key).agg(F.min(F.struct(f"source_{place}", f"source_{key}")).alias("s"))
    return best.select(digest, place, key, f"s.source_{place}", f"s.source_{key}")


def delta_to_last_known(rows: DataFrame, group: str, order: list[str], value: str) -> DataFrame:
    """`value` less the last earlier non-NULL one of the group."""
    w = Window.partitionBy(group).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return rows.withColumn("delta", F.col(value) - F.last(value, ignorenulls=True).over(w))


def asof_join(left: DataFrame, right: DataFrame, key: str, left_time: str, right_time: str, take: list[str], slot: str = "DAY") -> DataFrame:
    """Each left row with the `take` columns of the latest right row of its key at or before it: a union and a running
    last, so that no left row meets more than one right row. Of right rows at one time the one greatest by `take` counts.

    A key's rows are worked on by slots of time (DAY, HOUR, ...), so that a hot key is many tasks; the last right row of
    each slot is carried into the later ones. That takes one row a key and slot.
    """
    own = lambda t: F.date_trunc(slot, F.col(t).cast("timestamp"))
    right = right.where(F.col(key).isNotNull() & F.col(right_time).isNotNull()).groupBy(key, right_time).agg(F.max(F.struct(*take)).alias("__m")).select(key, right_time, *[F.col("__m")[c].alias(c) for c in take])
    lasts = right.groupBy(key, own(right_time).alias("__slot")).agg(F.max(F.struct(F.col(right_time).alias("__t"), *take)).alias("__last"))
    slots = lasts.select(key, "__slot", "__last").unionByName(left.select(key, own(left_time).alias("__slot")).distinct().withColumn("__last", F.lit(None).cast(lasts.schema["__last"].dataType)))
    slots = slots.groupBy(key, "__slot").agg(F.max("__last").alias("__last"))
    earlier = Window.partitionBy(key).orderBy("__slot").rowsBetween(Window.unboundedPreceding, -1)
    carried = slots.withColumn("__carry", F.last("__last", ignorenulls=True).over(earlier)).where("__carry IS NOT NULL")
    start = carried.select(key, F.col("__slot").cast(right.schema[right_time].dataType).alias("__at"), *[F.col("__carry")[c].alias(c) for c in take], "__slot")
    return _running_last(left, right, start, key, left_time, right_time, take, own)


def _running_last(left: DataFrame, right: DataFrame, start: DataFrame, key: str, left_time: str, right_time: str, take: list[str], own: Callable[[str], Column]) -> DataFrame:
    """The union of a slot's carried row, its right rows and its left rows, with the last right row running."""
    shape = right.select(F.struct(*take).alias("x")).schema["x"].dataType
    a = left.select(key, own(left_time).alias("__slot"), F.col(left_time).alias("__t"), F.lit(2).alias("__s"), F.struct(*left.columns).alias("__l"), F.lit(None).cast(shape).alias("__r"))
    none = F.lit(None).cast(a.schema["__l"].dataType)
    b = right.select(key, own(right_time).alias("__slot"), F.col(right_time).alias("__t"), F.lit(1).alias("__s"), none.alias("__l"), F.struct(*take).alias("__r"))
    c = start.select(key, "__slot", F.col("__at").alias("__t"), F.lit(0).alias("__s"), none.alias("__l"), F.struct(*take).alias("__r"))
    w = Window.partitionBy(key, "__slot").orderBy("__t", "__s").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    run = a.unionByName(b).unionByName(c).withColumn("__r", F.last("__r", ignorenulls=True).over(w))
    return run.where("__s = 2").select("__l.*", *[F.col("__r")[c].alias(c) for c in take])
