"""Scans of the archive's tables, one site or all of them, and the Markdown sink."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.utils import AnalysisException

from archivolt.schemas import conform, schema


def site_table(spark: SparkSession, root: str, name: str, domain: str | None = None) -> DataFrame | None:
    """A table, of one domain if named; None where there is no such table. A partition filter where it is partitioned."""
    try:
        rows = spark.read.parquet(f"{root}/{name}.parquet")
    except AnalysisException:
        return None
    return rows if domain is None else rows.where(F.col("domain") == domain)


def union_of_sites(spark: SparkSession, roots: dict[str, str], name: str) -> DataFrame:
    """One table out of several sites' folders, tagged with the domain; sites without the table add nothing."""
    out = spark.createDataFrame([], schema(name))
    for domain, root in roots.items():
        part = site_table(spark, root, name)
        if part is not None:
            out = out.unionByName(conform(part.withColumn("domain", F.lit(domain)), name))
    return out


def write_markdown(docs: DataFrame, path: str) -> None:
    """Documents (domain, md_path, text) as Parquet, a folder a domain: a file per document would drown any file system."""
    docs.select("domain", "md_path", "text").repartition("domain", F.pmod(F.xxhash64("md_path"), F.lit(16))).write.mode("overwrite").partitionBy("domain").parquet(path)
