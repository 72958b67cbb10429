"""Streaming versions of the batch operators.

Every flow runs on Structured Streaming with `availableNow` or a processing-time trigger; checkpoints and results go to
the shared folder. Flows that keep state bound it by a watermark where the operator allows it.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from archivolt.session import shared_dir


def table_stream(spark: SparkSession, sf_dir: str, name: str, files_per_trigger: int | None = None) -> DataFrame:
    """A stream over a table's files, be it one file or a folder of them."""
    path = f"{sf_dir}/{name}.parquet"
    schema = spark.read.parquet(path).schema
    jpath = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder = jpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getFileStatus(jpath).isDirectory()
    reader = spark.readStream.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(path) if folder else reader.option("pathGlobFilter", f"{name}.parquet").parquet(sf_dir)


def _folders(spark: SparkSession, root: str) -> list[int]:
    """Numbers of the `n=<number>` folders below a folder that were written whole, in order."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    fs = at(root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    names = [s.getPath().getName() for s in fs.listStatus(at(root))] if fs.exists(at(root)) else []
    return sorted(int(n[2:]) for n in names if n.startswith("n=") and fs.exists(at(f"{root}/{n}/_SUCCESS")))


def drained(stream: DataFrame, mode: str = "append", at: str | None = None) -> DataFrame:
    """Runs a stream over what there is now and gives its result: all rows so far, or the last complete table.

    With `at`, a folder of the caller's, the flow goes on where it stopped: progress and results are kept there.
    """
    spark = stream.sparkSession
    root = at or f"{shared_dir(spark)}/stream-{uuid.uuid4().hex}"

    def keep(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{root}/rows/n={number}")  # a repeated batch replaces its own output

    query = stream.writeStream.foreachBatch(keep).outputMode(mode).option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True).start()
    query.awaitTermination()
    done = _folders(spark, f"{root}/rows")
    wanted = done[-1:] if mode == "complete" else done
    return spark.read.schema(stream.schema).parquet(*[f"{root}/rows/n={n}" for n in wanted]) if wanted else spark.createDataFrame([], stream.schema)


def merged(stream: DataFrame, merge: Callable[[DataFrame | None, DataFrame], DataFrame], at: str | None = None, key: str | None = None, buckets: int = 16) -> DataFrame:
    """Folds micro-batches into a table by `merge(old, batch)`; each version is written beside the one it is made from.

    With `at`, a folder of the caller's, the flow goes on where it stopped. With `key`, the table lies in buckets of the key
    and a version holds only those that the batch touches, merged with their last version; `merge` must treat keys apart.
    """
    spark = stream.sparkSession
    root = at or f"{shared_dir(spark)}/merge-{uuid.uuid4().hex}"

    def versions(before: int) -> list[int]:
        return [n for n in _folders(spark, f"{root}/versions") if n < before]

    def newest(before: int, only: list[int] | None = None) -> list[str]:
        """Folders of the newest version of each bucket (or of the table) before a batch."""
        done = versions(before)
        if key is None:
            return [f"{root}/versions/n={done[-1]}"] if done else []
        jvm = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        fs = jvm(root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        last: dict[int, str] = {}
        for n in done:
            for s in fs.listStatus(jvm(f"{root}/versions/n={n}")):
                name = s.getPath().getName()
                if name.startswith("bucket="):
                    last[int(name[7:])] = f"{root}/versions/n={n}/{name}"
        return [p for b, p in sorted(last.items()) if only is None or b in only]

    def step(batch: DataFrame, number: int) -> None:
        where = f"{root}/versions/n={number}"
        if key is None:
            old = newest(number)
            merge(spark.read.parquet(*old) if old else None, batch).write.mode("overwrite").parquet(where)
            return
        bucket = F.coalesce(F.pmod(F.xxhash64(key), F.lit(buckets)), F.lit(0)).cast("int")
        touched = [r["b"] for r in batch.select(bucket.alias("b")).distinct().collect()]  # one row a bucket
        old = newest(number, touched)
        made = merge(spark.read.parquet(*old) if old else None, batch)
        made.withColumn("bucket", bucket).write.mode("overwrite").partitionBy("bucket").parquet(where)

    query = stream.writeStream.foreachBatch(step).option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True).start()
    query.awaitTermination()
    return spark.read.parquet(*newest(1 << 62))


def first_seen_once(stream: DataFrame, keys: list[str], time: str | None = None, delay: str = "30 days") -> DataFrame:
    """Each key once, however often it arrives; with an event time the state of old keys is dropped after `delay`."""
    if time is None:
        return stream.dropDuplicates(keys)
    return stream.withWatermark(time, delay).dropDuplicatesWithinWatermark(keys)


def windowed_counts(stream: DataFrame, time: str, by: list[str], length: str, slide: str | None = None, delay: str = "1 day") -> DataFrame:
    w = F.window(time, length, slide) if slide else F.window(time, length)
    return stream.withWatermark(time, delay).groupBy(w.alias("w"), *by).agg(F.count(F.lit(1)).alias("n"))


def sessions(stream: DataFrame, time: str, by: str, gap: str, delay: str = "1 day") -> DataFrame:
    return stream.withWatermark(time, delay).groupBy(F.session_window(time, gap).alias("w"), by).agg(F.count(F.lit(1)).alias("n"))


def newest_by_key(stream: DataFrame, key: str, order: str, value: str) -> DataFrame:
    """(key, visits, newest, value): running state per key in the JVM's state store, one update a key and batch.

    Rows without `value` count as visits only; ties in `order` go to the greater value.
    """
    known = F.when(F.col(value).isNotNull(), F.struct(F.col(order).alias("o"), F.col(value).alias("v")))
    x = stream.groupBy(key).agg(F.count(F.lit(1)).alias("visits"), F.max(known).alias("m"))
    return x.select(key, "visits", F.col("m.o").alias("newest"), F.col("m.v").alias(value))


def every(stream: DataFrame, step: Callable[[DataFrame, int], None], checkpoint: str, minutes: float = 15.0):
    """A processing-time tick that never overlaps itself."""
    return stream.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(processingTime=f"{int(minutes * 60)} seconds").start()
