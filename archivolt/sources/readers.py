"""Readers: mirrored files, JSON-lines logs, site settings, and a fetching data source."""

from __future__ import annotations

import importlib
import json
from collections.abc import Iterator
from urllib.parse import urlsplit

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from archivolt.sources.providers import TableFetcher, fetch_with_retries


def mirrored_files(spark: SparkSession, root: str, pattern: str = "*") -> DataFrame:
    """(path, length, content, digest) of the files below a folder."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(root)
    return files.select("path", "length", "content", F.concat(F.lit("sha256:"), F.sha2("content", 256)).alias("digest"))


def missing_files(expected: DataFrame, files: DataFrame, column: str, root: str) -> DataFrame:
    """Rows whose file is not there; `column` names it below the folder `root`."""
    below = F.substring_index("path", root.rstrip("/").split("://")[-1].removeprefix("file:") + "/", -1)
    return expected.join(files.select(below.alias("__p")), F.col("__p") == F.col(column), "left_anti")


def is_pdf(content: Column) -> Column:
    return F.substring(content, 1, 5) == F.lit(b"%PDF-")


def json_lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A log of JSON objects, one a line; broken lines give NULLs and the line itself in `broken`."""
    return spark.read.schema(schema + ", broken string").option("columnNameOfCorruptRecord", "broken").option("mode", "PERMISSIVE").json(path)


def deep_merged(base: dict, over: dict) -> dict:
    """`over` laid on `base`: maps key by key, anything else replaced, None too."""
    return {**base, **{k: deep_merged(base[k], v) if isinstance(v, dict) and isinstance(base.get(k), dict) else v for k, v in over.items()}}


def site_settings(path: str) -> list[dict]:
    """Settings of every site, defaults beneath each; `defaults:` and `sites:` of a YAML file."""
    import yaml

    with open(path, encoding="utf-8") as f:
        told = yaml.safe_load(f) or {}
    return [deep_merged(told.get("defaults") or {}, s) for s in told.get("sites") or []]


def table_fetcher(options: dict) -> TableFetcher:
    """The stand-in for the network: option `table`, JSON of url to [body, mime] or [body, mime, last modified]."""
    told = json.loads(options.get("table", "{}"))
    return TableFetcher({k: (v[0].encode(), v[1]) for k, v in told.items()}, modified={k: v[2] for k, v in told.items() if len(v) > 2})


def _named(path: str):
    module, name = path.split(":")
    return getattr(importlib.import_module(module), name)


class _Host(InputPartition):
    def __init__(self, urls: list[tuple[str, str | None, str | None]]):
        self.urls = urls


class _FetchReader(DataSourceReader):
    def __init__(self, options: dict):
        self.options = dict(options)
        self.requests = json.loads(options.get("requests", "[]"))

    def partitions(self) -> list[_Host]:
        hosts: dict[str, list] = {}
        for url, *validators in self.requests:
            etag, modified = [*validators, None, None][:2]
            hosts.setdefault(urlsplit(url).hostname or "", []).append((url, etag, modified))
        return [_Host(u) for _, u in sorted(hosts.items())] or [_Host([])]

    def read(self, partition: _Host) -> Iterator[tuple]:
        fetcher = _named(self.options.get("fetcher", f"{__name__}:table_fetcher"))(self.options)
        waits = tuple(float(w) for w in self.options.get("waits", "2,5").split(",") if w)
        for url, etag, modified in partition.urls:
            r = fetch_with_retries(fetcher, url, etag, modified, waits=waits)
            yield url, r.status, r.mime, r.etag, r.last_modified, r.body.decode("utf-8", "replace") if r.status == 200 else None


class FetchSource(DataSource):
    """`spark.read.format("archive_fetch")`: one partition per host, so that a host sees one connection.

    Options: `requests` (JSON list of [url, etag, last modified]), `fetcher` (module:function that makes a `Fetcher` of the
    options; by default the stand-in `table_fetcher`), `waits` (seconds before each further try of a transient error).
    """

    @classmethod
    def name(cls) -> str:
        return "archive_fetch"

    def schema(self) -> str:
        return "url string, status int, mime string, etag string, last_modified string, body string"

    def reader(self, schema) -> DataSourceReader:
        return _FetchReader(self.options)


def source_kind(site: dict) -> str:
    """How a site is read: http, mediawiki_api or wordpress_rss, as its settings say."""
    kind = (site.get("source") or {}).get("type") or ("mediawiki_api" if site.get("mediawiki_api") else "wordpress_rss" if site.get("wordpress_rss") else "http")
    if kind not in ("http", "mediawiki_api", "wordpress_rss"):
        raise ValueError(f"no source of the kind {kind}")
    return kind


def by_keys(rows: DataFrame, column: str, keys: list) -> DataFrame:
    """Rows with one of a few keys; the filter reaches the scan."""
    return rows.where(F.col(column).isin(keys)) if keys else rows.limit(0)
