"""Processing only what is new or changed since the last successful run.

Source rows carry a monotonic commit sequence (here the load time). A run fixes its upper bound when it starts and
processes the half-open window (watermark, bound]; a failed run moves nothing, so its window is covered by the next
successful one. Output, processed state and watermark are committed together by one manifest (`CommitLog`).
`WatermarkedState` does this for one feed, run by run; `CommittedReplay` for a whole log of runs over many feeds, in a few
bounded commits, each of which derives what all of its runs had to process from the state the last one left.
"""

from __future__ import annotations

import json
import re
import uuid
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from archivolt.functions.digests import canonical_digest


def run_windows(runs: DataFrame) -> DataFrame:
    """(domain, run_id, ordinal, low, high) of the successful runs: each covers the load times in (low, high].

    Runs without domain or start are ignored; runs that started at the same moment follow run_id, the later ones are empty.
    """
    done = runs.where((F.col("status") == "success") & F.col("domain").isNotNull() & F.col("started_at").isNotNull()).select("domain", "run_id", F.col("started_at").alias("high")).distinct()
    order = Window.partitionBy("domain").orderBy("high", "run_id")
    return done.select("domain", "run_id", F.row_number().over(order).alias("ordinal"), F.lag("high").over(order).alias("low"), "high")


def placed(rows: DataFrame, windows: DataFrame) -> DataFrame:
    """Rows (domain, loaded_at, ...) with the `run_id` and `ordinal` of the one window that covers them; others are dropped.

    Windows are looked up by domain and day, so that a row meets only those of its own day, and the first window of a
    domain, which is open below, by domain alone. Catalyst broadcasts the windows where they are small.
    """
    own = rows.withColumns({"__day": F.date_trunc("DAY", F.col("loaded_at").cast("timestamp")).cast("date")})
    opening = windows.where("low IS NULL").select("domain", F.col("high").alias("__high"), F.col("run_id").alias("__run"), F.col("ordinal").alias("__ordinal"))
    days = F.sequence(F.to_date("low"), F.to_date("high"))
    later = windows.where("low IS NOT NULL AND low < high").select(F.col("domain").alias("__d"), F.explode(days).alias("__on"), F.col("low").alias("__low"), F.col("high").alias("__upto"), F.col("run_id").alias("__r"), F.col("ordinal").alias("__o"))
    first = own.join(opening, "domain", "left")
    covered = first.join(later, (F.col("domain") == F.col("__d")) & (F.col("__day") == F.col("__on")) & (F.col("loaded_at") > F.col("__low")) & (F.col("loaded_at") <= F.col("__upto")), "left")
    early = F.coalesce(F.col("loaded_at") <= F.col("__high"), F.lit(False))
    out = covered.withColumns({"run_id": F.when(early, F.col("__run")).otherwise(F.col("__r")), "ordinal": F.when(early, F.col("__ordinal")).otherwise(F.col("__o"))})
    return out.where("run_id IS NOT NULL").select(*rows.columns, "run_id", "ordinal")


def newest_content(rows: DataFrame, *keys: str) -> DataFrame:
    """Per key the digest of the latest seen row that has one: `best` = struct(last_seen_at, loaded_at, digest)."""
    return rows.groupBy(*keys).agg(F.max(F.struct("last_seen_at", "loaded_at", "digest")).alias("best"))


def export_baseline(exports: DataFrame) -> DataFrame:
    """(url, base): digest of the source of each url's newest good export; NULL where the export names none.

    Ties in `exported_at` go to the row with the greater digest, NULL last.
    """
    good = exports.where((F.col("status") == "ok") & F.col("url").isNotNull()).select("url", "exported_at", canonical_digest(F.col("source_hash")).alias("digest"))
    return good.groupBy("url").agg(F.max(F.struct("exported_at", "digest")).alias("x")).select("url", F.col("x.digest").alias("base"))


def with_digests(pages: DataFrame) -> DataFrame:
    """(domain, url, last_seen_at, loaded_at, digest) of the page rows that have a content; others never matter."""
    return pages.select("domain", "url", "last_seen_at", "loaded_at", canonical_digest(F.col("content_hash")).alias("digest")).where("url IS NOT NULL AND digest IS NOT NULL AND loaded_at IS NOT NULL")


def taken(rows: DataFrame, windows: DataFrame, state: DataFrame | None) -> DataFrame:
    """(url, domain, run_id, before, now, best): what each window that has rows of a url found before and left, from `state`
    (url, domain, best), the newest content before the first of the windows."""
    per_run = newest_content(placed(rows, windows), "url", "domain", "run_id", "ordinal")
    if state is not None:
        touched = per_run.select("url", "domain").distinct()
        earlier = state.join(touched, ["url", "domain"], "left_semi").select("url", "domain", F.lit(None).cast(per_run.schema["run_id"].dataType).alias("run_id"), F.lit(0).alias("ordinal"), "best")
        per_run = per_run.unionByName(earlier)
    along = Window.partitionBy("url", "domain").orderBy("ordinal")
    running = per_run.withColumn("best", F.max("best").over(along.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    running = running.withColumn("now", F.col("best")["digest"]).withColumn("before", F.lag("now").over(along))
    return running.where("run_id IS NOT NULL").select("url", "domain", "run_id", "before", "now", "best")


def is_due(before: Column, base: Column, now: Column) -> Column:
    known = F.coalesce(before, base)
    return known.isNull() | (known != now)


def replay_due(pages: DataFrame, runs: DataFrame, exports: DataFrame) -> DataFrame:
    """(run_id, url): what each successful run had to process, derived for all of them at once and without a commit.

    A page row falls into the one window of its domain that covers its load time. Within a window the newest content of a
    url wins, and the running newest over the windows is what a run sees; the url is due where that differs from what the
    window before left, at first from the export baseline. Nulls: rows without url, domain, digest or load time are
    ignored. Repeated rows change nothing; ties in last_seen_at go to the later load, then the greater digest.
    Empty inputs give an empty result; further columns are ignored.
    """
    found = taken(with_digests(pages), run_windows(runs), None).join(export_baseline(exports), "url", "left")
    return found.where(is_due(F.col("before"), F.col("base"), F.col("now"))).select("run_id", "url").distinct()


class CommitLog:
    """Commits below a folder all executors share: `_commits/<number>.json`, each a JSON object.

    A manifest is written under another name and renamed, which fails if the number is taken: of two concurrent commits one
    wins, and no reader ever sees half of one. What is no whole JSON object (a manifest cut short by other means) is no
    commit, but its number is not used again. Only the newest manifest is read, so each must say all that the next needs.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        jvm = self._jvm = spark.sparkContext._jvm
        self._conf = spark.sparkContext._jsc.hadoopConfiguration()
        self.path = jvm.org.apache.hadoop.fs.Path
        self.fs = self.path(self.root).getFileSystem(self._conf)

    def _numbers(self) -> list[int]:
        folder = self.path(f"{self.root}/_commits")
        names = [s.getPath().getName() for s in self.fs.listStatus(folder)] if self.fs.exists(folder) else []
        return sorted(int(m.group(1)) for m in map(re.compile(r"^(\d+)\.json$").match, names) if m)

    def read(self, number: int) -> dict | None:
        stream = self.fs.open(self.path(f"{self.root}/_commits/{number:08d}.json"))
        try:
            told = json.loads(bytes(stream.readAllBytes()).decode("utf-8"))
        except ValueError:
            return None
        finally:
            stream.close()
        return told if isinstance(told, dict) else None

    def latest(self) -> tuple[int, dict] | None:
        """(number, entry) of the newest commit."""
        for n in reversed(self._numbers()):
            told = self.read(n)
            if told is not None:
                return n, told
        return None

    def all(self) -> list[tuple[int, dict]]:
        return [(n, e) for n in self._numbers() if (e := self.read(n)) is not None]

    def next_number(self) -> int:
        numbers = self._numbers()
        return numbers[-1] + 1 if numbers else 0

    def commit(self, number: int, entry: dict) -> None:
        there = f"{self.root}/_commits"
        self.fs.mkdirs(self.path(there))
        draft = self.path(f"{there}/.{number:08d}-{uuid.uuid4().hex}")
        stream = self.fs.create(draft, False)
        stream.write(bytearray(json.dumps(entry).encode()))
        stream.close()
        none = getattr(self._jvm.org.apache.hadoop.fs, "Options$Rename").NONE
        how = self.spark.sparkContext._gateway.new_array(getattr(self._jvm.org.apache.hadoop.fs, "Options$Rename"), 1)
        how[0] = none
        context = self._jvm.org.apache.hadoop.fs.FileContext.getFileContext(self.path(self.root).toUri(), self._conf)
        try:
            context.rename(draft, self.path(f"{there}/{number:08d}.json"), how)
        except Exception:
            self.fs.delete(draft, False)
            raise

    def vacuum(self, folder: str, named: Iterable[str]) -> list[str]:
        """Delete what failed attempts left below a folder: all that no commit names. Only while no run is under way."""
        keep = {n.split("/")[1] for n in named if n.startswith(f"{folder}/")}
        at = self.path(f"{self.root}/{folder}")
        names = [s.getPath().getName() for s in self.fs.listStatus(at)] if self.fs.exists(at) else []
        gone = sorted(n for n in names if n not in keep)
        for n in gone:
            self.fs.delete(self.path(f"{self.root}/{folder}/{n}"), True)
        return gone


class WatermarkedState:
    """Processed state of one feed. A manifest names the watermark, the commit's output and the folders of the state.

    The state is the newest content of every url, in a folder a commit, which are merged into one at every `merge_at`th
    commit: a run reads no more than that many folders, however many runs there were.
    """

    def __init__(self, spark: SparkSession, root: str, merge_at: int = 8):
        self.spark, self.merge_at = spark, merge_at
        self.log = CommitLog(spark, root)
        self.root = self.log.root

    def commits(self) -> list[dict]:
        return [e for _, e in self.log.all()]

    def watermark(self) -> str | None:
        last = self.log.latest()
        return last[1]["watermark"] if last else None

    def _state(self, folders: list[str]) -> DataFrame:
        rows = self.spark.read.parquet(*[f"{self.root}/{f}" for f in folders])
        return rows.groupBy("url").agg(F.max(F.struct("last_seen_at", "commit_no", "digest")).alias("k")).select("url", "k.digest", "k.last_seen_at", "k.commit_no")

    def processed(self) -> DataFrame | None:
        """(url, digest) last processed, over all commits."""
        last = self.log.latest()
        return self._state(last[1]["state"]).select("url", "digest") if last else None

    def output(self, commit_no: int) -> DataFrame:
        return self.spark.read.parquet(f"{self.root}/{self.log.read(commit_no)['data']}")

    def vacuum(self) -> list[str]:
        """Delete folders of failed attempts, and state that later commits have merged."""
        every = self.log.all()
        return self.log.vacuum("data", [e["data"] for _, e in every]) + self.log.vacuum("state", every[-1][1]["state"] if every else [])

    def run(self, rows: DataFrame, high: str, run_id: str, baseline: DataFrame | None = None, fail_at: str | None = None) -> int:
        """Process the rows (url, last_seen_at, loaded_at, digest) loaded in (watermark, high]; returns the commit number.

        A digest older than one already processed of the same url cannot be told from the window alone, so the newest
        last_seen_at is kept with the processed state. `fail_at` stops it before the step so named: output, state, commit.
        """

        def stop(step: str) -> None:
            if fail_at == step:
                raise RuntimeError(f"stopped before {step}")

        last = self.log.latest()
        number = self.log.next_number()
        bound = F.lit(high).cast("timestamp_ntz")
        window = rows.where(F.col("loaded_at") <= bound)
        if last:
            window = window.where(F.col("loaded_at") > F.lit(last[1]["watermark"]).cast("timestamp_ntz"))
        fresh = newest_content(window.where("digest IS NOT NULL AND url IS NOT NULL"), "url").select("url", F.col("best.digest").alias("digest"), F.col("best.last_seen_at").alias("last_seen_at"))
        if last:
            known = self._state(last[1]["state"]).select("url", F.col("digest").alias("before"), F.col("last_seen_at").alias("seen_before"))
        else:
            known = self.spark.createDataFrame([], "url string, before string, seen_before string")
        joined = fresh.join(known, "url", "left").where("seen_before IS NULL OR last_seen_at >= seen_before")
        base = baseline.select("url", "base") if baseline is not None else self.spark.createDataFrame([], "url string, base string")
        joined = joined.join(base, "url", "left")
        folder, state = f"data/{run_id}-{uuid.uuid4().hex}", f"state/{run_id}-{uuid.uuid4().hex}"
        stop("output")
        joined.select("url", "digest", "last_seen_at", is_due(F.col("before"), F.col("base"), F.col("digest")).alias("due"), F.lit(number).alias("commit_no")).write.parquet(f"{self.root}/{folder}")
        stop("state")
        own = self.spark.read.parquet(f"{self.root}/{folder}").drop("due")
        folders = [*(last[1]["state"] if last else []), state]
        if len(folders) > self.merge_at:
            own = self._state(folders[:-1]).select(*own.columns).unionByName(own)
            folders = [state]
        own.write.parquet(f"{self.root}/{state}")
        stop("commit")
        self.log.commit(number, {"watermark": high, "data": folder, "state": folders, "run_id": run_id})
        return number


class CommittedReplay:
    """A log of runs over many feeds, processed in bounded commits.

    A commit covers all runs up to its bound, a moment fixed before it reads anything. Its manifest names the bound, the
    output (run_id, url) and the state (url, domain, best), the newest content that any run so far has seen; `best` only
    ever grows, so the state of several commits is their maximum. A stopped commit leaves nothing that is read, and the next
    attempt covers the same runs.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.log = CommitLog(spark, root)
        self.root = self.log.root

    def state(self) -> DataFrame | None:
        every = self.log.latest()
        if every is None:
            return None
        return self.spark.read.parquet(*[f"{self.root}/{f}" for f in every[1]["state"]]).groupBy("url", "domain").agg(F.max("best").alias("best"))

    def advance(self, pages: DataFrame, runs: DataFrame, exports: DataFrame, bound: str, fail_at_commit: bool = False) -> int:
        """Process all runs that started after the last commit's bound and up to `bound`; returns the commit number.

        A row that no run has covered by then waits for a later one, however early it was loaded.
        """
        last, number = self.log.latest(), self.log.next_number()
        low = F.lit(last[1]["watermark"] if last else None).cast("timestamp_ntz")
        windows = run_windows(runs).where((F.col("high") <= F.lit(bound).cast("timestamp_ntz")) & (low.isNull() | (F.col("high") > low)))
        # windows of this commit: the first of a domain reaches down to its last window of the commit before
        reach = windows.agg(F.min("low").alias("low"), F.bool_or(F.col("low").isNull()).alias("opens")).first()
        rows = with_digests(pages).where(F.col("loaded_at") <= F.lit(bound).cast("timestamp_ntz"))
        if reach["opens"] is False:
            rows = rows.where(F.col("loaded_at") > F.lit(reach["low"]).cast("timestamp_ntz"))
        found = taken(rows, windows, self.state())
        folder = f"data/{number}-{uuid.uuid4().hex}"
        found.write.parquet(f"{self.root}/{folder}/seen")
        seen = self.spark.read.parquet(f"{self.root}/{folder}/seen")
        due = seen.join(export_baseline(exports), "url", "left").where(is_due(F.col("before"), F.col("base"), F.col("now")))
        due.select("run_id", "url").write.parquet(f"{self.root}/{folder}/due")
        if fail_at_commit:
            raise RuntimeError("stopped before commit")
        self.log.commit(number, {"watermark": bound, "data": folder, "due": [*(last[1]["due"] if last else []), f"{folder}/due"], "state": [*(last[1]["state"] if last else []), f"{folder}/seen"]})
        return number

    def due(self) -> DataFrame:
        """(run_id, url) of all commits."""
        last = self.log.latest()
        return self.spark.read.parquet(*[f"{self.root}/{f}" for f in last[1]["due"]]) if last else self.spark.createDataFrame([], "run_id long, url string")


def committed_due(pages: DataFrame, runs: DataFrame, exports: DataFrame, root: str, commits: int = 4) -> DataFrame:
    """As `replay_due`, by `commits` bounded commits, each over about as many runs."""
    replay = CommittedReplay(pages.sparkSession, root)
    started = runs.where("status = 'success' AND started_at IS NOT NULL").select("started_at")
    part = F.ntile(commits).over(Window.orderBy("started_at"))
    bounds = started.select(F.date_trunc("DAY", F.col("started_at").cast("timestamp")).cast("timestamp_ntz").alias("started_at")).groupBy("started_at").count()
    bounds = bounds.select("started_at", part.alias("part")).groupBy("part").agg(F.max("started_at").alias("bound")).select((F.col("bound") + F.expr("INTERVAL 1 DAY")).cast("string").alias("bound")).collect()  # one row a commit
    for bound in sorted({b["bound"] for b in bounds}):
        replay.advance(pages, runs, exports, bound)
    return replay.due().select("run_id", "url").distinct()
