"""Session construction and the shared working folder."""

from __future__ import annotations

import atexit
import os
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_RUN_FOLDER = uuid.uuid4().hex
_made: set[str] = set()


def local_session(cores: int | str = 8, shuffle_partitions: int = 8, app: str = "archivolt") -> SparkSession:
    """A local session for tests and benchmarks."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.host", "127.0.0.1")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach: the session's `spark.checkpoint.dir`.

    A session that runs in one process (local[...], as in tests) may name none; on a cluster it must.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = "file://" + tempfile.gettempdir() + "/archivolt-checkpoint"
    return base.rstrip("/") + f"/archivolt-{_RUN_FOLDER}"


def _drop_folder(spark: SparkSession, path: str) -> None:
    try:
        jvm = spark.sparkContext._jvm
        target = jvm.org.apache.hadoop.fs.Path(path)
        target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)
    except Exception:  # the session is already gone; the cluster's own clean-up takes over
        pass


def materialize(df: DataFrame, label: str, by: str | None = None) -> DataFrame:
    """Write `df` as Parquet into the shared folder, in folders by the column `by` if named, and read it back.

    Cuts lineage, survives lost executors (the files are shared), keeps column pruning and filters on the re-read.
    """
    spark = df.sparkSession
    root = shared_dir(spark)
    path = f"{root}/{label}-{uuid.uuid4().hex}"
    writer = df.hint("rebalance", by).write.partitionBy(by) if by else df.write
    writer.mode("errorifexists").parquet(path)
    if root not in _made:
        _made.add(root)
        atexit.register(_drop_folder, spark, root)
    return spark.read.schema(df.schema).parquet(path)


def spread(rows: DataFrame) -> DataFrame:
    """A scan with fewer partitions than the cluster has cores, dealt out to all of them for costly work per row.

    Only small inputs have so few; anything larger is left as it was read, without a shuffle.
    """
    cores = rows.sparkSession.sparkContext.defaultParallelism
    return rows.repartition(cores) if rows.rdd.getNumPartitions() < cores else rows


def row_bound(df: DataFrame, most: int) -> bool:
    """Whether `df` has at most `most` rows; reads no more than most + 1 of them."""
    return df.limit(most + 1).count() <= most


def ship_package(spark: SparkSession) -> None:
    """Send this package to the Python workers, once per Spark context, so that they can import it wherever they run."""
    context = spark.sparkContext
    if getattr(context, "_archivolt_shipped", False):
        return
    home = Path(__file__).resolve().parent
    fd, name = tempfile.mkstemp(prefix="archivolt-", suffix=".zip")
    os.close(fd)
    with zipfile.ZipFile(name, "w", zipfile.ZIP_DEFLATED) as z:
        for p in sorted(home.rglob("*.py")):
            z.write(p, str(p.relative_to(home.parent)))
    context.addPyFile(name)
    context._archivolt_shipped = True
