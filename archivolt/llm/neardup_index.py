"""Duplicates of new batches among everything accepted before.

An inverted index holds, for every accepted text, keys of its rarest words (its prefix), in folders by batch and key bucket.
A batch looks up only the keys of its own texts; pairs of near lengths that have a key in common, and whose signatures do not
rule it out, are verified word by word, and the batch's postings are appended. Equal digests are found by key.

The prefix rule: tokens are words with the number of their occurrence. Texts of n and n' words of which l agree in order share
l tokens, and are accepted only if l is at least `accept_at` of the longer. So each lacks at most `most_lost` of its own n
tokens in any match, and the k rarest tokens shared are among the `most_lost` + k rarest of either. So the prefix is that long,
with k = `wanted`, a ninth of the tokens. It holds wherever the differing words stand; a shingle of more words has no such
bound, as one differing word breaks several. Any fixed order of tokens is right; the counts of what was staged first, in a
table of fixed size, keep postings short.

Keys: a token that is not hot is a key by itself. Of hot tokens two together are one, if they are in the same of g groups: of
g + 1 tokens shared two are in one group, so a pair of texts has a key in common if it shares a token that is not hot, or g + 1
that are. g is a power of two below the `wanted` of the shortest text that can agree; groups of more are parts of those of
less, so that texts of different lengths meet. Texts so short that one token must do have their hot tokens as keys as well.
Keys that are still frequent are split into parts: a text is stored under one and looked up under each.

Signatures: 512 bits, one a token. Every bit one text has and the other lacks is a token lacking, of which `most_lost` bounds
the number; so they are compared before anything leaves the bucket, by numpy on all the pairs of a key.

Scale: a batch is put down (`stage`) as classes, digests and postings in folders of its own, which count as history once it
is accepted. Its probe reads only the buckets it has keys in. Copies are folded into one text class a batch before anything
is paired. A class is looked for among the leaders first, classes that agree with none before them; then only what is earlier
than the leader found can be the answer, so that a group of near copies, however large, is not paired with itself. What leaves
a probe are pairs of like texts, not the pairs of texts that use the same words.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from archivolt.functions.digests import canonical_digest
from archivolt.llm.fold import folded, mix
from archivolt.session import materialize

#: Cells of the table of token counts; bytes of a signature; pairs compared at once.
CELLS, SIGN, AT_ONCE = 1 << 18, 64, 1 << 18
#: Occurrences at the first batch from which a token is hot; for which a key gets one part more; classes for which the index
#: gets one bucket more.
HOT, SPLIT_AT, BUCKET_OF = 200, 10_000, 16_000
ORD = "decimal(38,0)"
#: `first` as two longs, its digits above and below this.
_HALVES = "cast('1000000000000000000' as decimal(19,0))"
TABLES = {
    "classes": f"cls long, first {ORD}, words array<int>",
    "digests": f"digest string, first {ORD}",
    "postings": "hi long, lo long, n int, keys array<long>, asked array<long>, sign binary, bucket int",
    "near": f"first {ORD}, other {ORD}",
}


def least_agreeing(n, accept_at: float):
    """Fewest words that must agree for a text of n words, the longer one of a pair."""
    return F.ceil(n * accept_at - 1e-9).cast("int")


def must_agree(n, accept_at: float) -> np.ndarray:
    return np.ceil(np.asarray(n) * accept_at - 1e-9).astype(np.int64)


def most_lost(n, accept_at: float) -> np.ndarray:
    """Most words a text of n words can lack in one that agrees."""
    return n - must_agree(n, accept_at)


def wanted(n: int) -> int:
    """How many tokens of their prefixes two texts of n words share."""
    return max(1, n // 9)


def groups(n: int, accept_at: float) -> int:
    """Into how many groups the hot tokens of a text of n words go; 0 if one shared token must do."""
    most = wanted(int(must_agree(n, accept_at))) - 1
    return 1 << (most.bit_length() - 1) if most else 0


def tokens_of(words: np.ndarray) -> np.ndarray:
    """Hashes of words, each with the number of its occurrence, that fall evenly on cells and buckets."""
    order = np.argsort(words, kind="stable")
    at, same = np.arange(len(words)), np.zeros(len(words), bool)
    same[1:] = words[order][1:] == words[order][:-1]
    number = np.empty(len(words), np.int64)
    number[order] = at - np.maximum.accumulate(np.where(same, 0, at))
    return _hashed((words.astype(np.int64) + (number << 33)).view(np.uint64))


def _hashed(x: np.ndarray) -> np.ndarray:
    return mix(x * np.uint64(0x9E3779B97F4A7C15))


def halves(order: str, hi: str = "hi", lo: str = "lo") -> list[Column]:
    """An order as two longs that sort as it does."""
    return [F.expr(f"({order} - pmod({order}, {_HALVES})) div {_HALVES}").alias(hi), F.expr(f"cast(pmod({order}, {_HALVES}) as long)").alias(lo)]


def whole(hi: str, lo: str) -> Column:
    return F.expr(f"cast(cast({hi} as decimal(19,0)) * {_HALVES} + {lo} as {ORD})")


def keyed(rows: DataFrame) -> DataFrame:
    """(row_id, ord, digest, cls, folded, batch): rows with their folded text and its class."""
    x = rows.withColumn("folded", folded(F.col("text"))).withColumn("cls", F.when(F.length("folded") > 0, F.xxhash64("folded")))
    return x.select("row_id", F.col("ord").cast(ORD).alias("ord"), "digest", "cls", "folded", "batch")


def text_classes(rows: DataFrame) -> DataFrame:
    """One row per batch and distinct folded text: cls, words and `first`, its earliest row."""
    grouped = rows.where("cls IS NOT NULL").groupBy("batch", "cls").agg(F.min("ord").alias("first"), F.first("folded").alias("folded"))
    return grouped.select("batch", "cls", "first", F.transform(F.split("folded", " "), lambda w: F.hash(w)).alias("words"))


def _common_subsequence(a: list[int], b: list[int]) -> int:
    """Length of the longest common subsequence, one bit per word of `a`."""
    places: dict[int, int] = {}
    for i, x in enumerate(a):
        places[x] = places.get(x, 0) | (1 << i)
    full = (1 << len(a)) - 1
    row = full
    for x in b:
        hit = places.get(x, 0) & row
        row = ((row + hit) | (row - hit)) & full
    return len(a) - row.bit_count()


def word_agreement(a: str, b: str):
    """Share of the longer text's words that both have in order."""

    def agree(a: pd.Series, b: pd.Series) -> pd.Series:
        return pd.Series([_common_subsequence(x.tolist(), y.tolist()) / max(len(x), len(y), 1) for x, y in zip(a, b)], dtype="float64")

    return F.pandas_udf(agree, "double")(a, b)


def keys_of(tokens: np.ndarray, counts: tuple[np.ndarray, int], accept_at: float, hot: int, salt: int) -> tuple[np.ndarray, np.ndarray]:
    """The keys a text is stored and looked up under, and those it is only looked up under."""
    (table, texts), n = counts, len(tokens)
    level = table[(tokens & np.uint64(CELLS - 1)).astype(np.int64)]
    kept = np.lexsort((tokens, level))[: int(most_lost(n, accept_at)) + wanted(n)]
    tokens, often = tokens[kept], np.exp2((np.maximum(level[kept], 1) - 1) / 8)
    warm, g = often > hot, groups(n, accept_at)
    alone = np.flatnonzero(~warm) if g else np.arange(len(tokens))
    keys, expected = [tokens[alone]], [often[alone]]
    if wanted(n) > 1 and warm.sum() > 1:
        t, times = tokens[warm], often[warm]
        a, b = np.triu_indices(len(t), 1)
        if g > 1:
            group = (t >> np.uint64(50)) & np.uint64(g - 1)
            a, b = a[group[a] == group[b]], b[group[a] == group[b]]
        keys.append(_hashed(np.minimum(t[a], t[b]) * np.uint64(3) + np.maximum(t[a], t[b])))
        expected.append(np.minimum(times[a], times[b]) * np.minimum(1, np.maximum(times[a], times[b]) / max(texts, 1)))
    key, parts = np.concatenate(keys), 1 + (np.concatenate(expected) // SPLIT_AT).astype(np.int64)
    if parts.max(initial=1) == 1:
        return key, key[:0]
    each = np.repeat(np.arange(len(key)), parts)
    part = np.arange(len(each)) - np.repeat(np.cumsum(parts) - parts, parts)
    split = np.where(part > 0, _hashed(key[each] + part.astype(np.uint64)), key[each])
    stored = part == int(_hashed(np.array([salt]).view(np.uint64))[0] >> np.uint64(8)) % parts[each]
    return split[stored], split[~stored]


def meetings(rows: pa.Table, accept_at: float) -> tuple[np.ndarray, np.ndarray]:
    """Places (a, b) of the rows of one bucket that may agree: `side` 1 is looked up, 0 is there, 2 is both; b is earlier than
    what a is looked up to."""
    count = rows.num_rows
    hi, lo, uhi, ulo, side, n = (rows[c].to_numpy() for c in ("hi", "lo", "uhi", "ulo", "side", "n"))
    n = n.astype(np.int64)
    least = must_agree(n, accept_at)
    sign = np.frombuffer(b"".join(rows["sign"].to_pylist()), dtype=np.uint64).reshape(count, SIGN // 8)
    # places in the order of all rows, and how many rows come before each `upto`
    flag = np.repeat([1, 0], count)
    order = np.lexsort((flag, np.r_[lo, ulo], np.r_[hi, uhi]))
    before = np.empty(2 * count, np.int64)
    before[order] = np.cumsum(flag[order]) - flag[order]
    rank, bound = before[:count], before[count:]

    def listed(column: str, asked: bool) -> tuple[np.ndarray, np.ndarray]:
        lists = rows[column].combine_chunks()
        ends = lists.offsets.to_numpy()
        row, key = np.repeat(np.arange(count), np.diff(ends)), lists.values.to_numpy()[ends[0] : ends[-1]]
        use = side[row] != (0 if asked else 1)
        return row[use], key[use]

    there, stored = listed("keys", False)
    mine, asked = (np.concatenate(x) for x in zip(listed("keys", True), listed("asked", True)))
    known, number = np.unique(stored, return_inverse=True)
    if not len(known) or not len(asked):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    code = number * count + rank[there]
    by = np.argsort(code)
    code, there = code[by], there[by]
    at = np.minimum(np.searchsorted(known, asked), len(known) - 1)
    hit = known[at] == asked
    mine, at = mine[hit], at[hit]
    start = np.searchsorted(code, at * count)
    many = np.searchsorted(code, at * count + bound[mine]) - start
    mine, start, many = mine[many > 0], start[many > 0], many[many > 0]
    done, found = np.r_[0, np.cumsum(many)], np.empty(0, np.int64)
    new, size = [], 0
    for first in range(0, int(done[-1]), AT_ONCE):
        pair = np.arange(first, min(first + AT_ONCE, int(done[-1])))
        i = np.searchsorted(done, pair, side="right") - 1
        a, b = mine[i], there[start[i] + pair - done[i]]
        need = np.maximum(least[a], least[b])
        near = np.minimum(n[a], n[b]) >= need
        a, b, need = a[near], b[near], need[near]
        sa, sb = sign[a], sign[b]
        allowed = (np.bitwise_count(sa & ~sb).sum(1, dtype=np.int64) <= n[a] - need) & (np.bitwise_count(sb & ~sa).sum(1, dtype=np.int64) <= n[b] - need)
        new.append(np.unique(a[allowed] * count + b[allowed]))
        size += len(new[-1])
        if size > 16 * AT_ONCE:
            found, new, size = np.unique(np.concatenate([found, *new])), [], 0
    found = np.unique(np.concatenate([found, *new]))
    return found // count, found % count


class RareShingleIndex:
    """Index of accepted rows below a shared folder. Rows: row_id, ord (a number that orders them), digest, text.

    Batches are accepted in order: no row of a later one is earlier than a row of one before. Tables, each in a folder a
    batch: `classes` (its texts), `digests`, `postings` (of its texts, in folders by word bucket), `near` (of its texts the
    earliest one that agrees).
    """

    def __init__(self, spark: SparkSession, root: str, accept_at: float = 0.8, buckets: int | None = None, hot: int = HOT):
        self.spark, self.root, self.accept_at, self.buckets, self.hot = spark, root.rstrip("/"), accept_at, buckets, hot
        self.staged = self.accepted = 0
        self._rarity = None
        self._path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(self.root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def _below(self, folder: str) -> list[str]:
        at = self._path(folder)
        return [f.getPath().getName() for f in self._fs.listStatus(at)] if self._fs.exists(at) else []

    def read(self, table: str, batches: range, buckets: list[int] | None = None) -> DataFrame:
        """Rows of some batches; of postings those in some word buckets. Nothing else is listed or opened."""
        base = f"{self.root}/{table}"
        found = [f"{base}/{b}" for b in self._below(base) if b.startswith("batch=") and int(b[6:]) in batches]
        if buckets is not None:
            wanted = {f"bucket={b}" for b in buckets}
            found = [f"{f}/{b}" for f in found for b in self._below(f) if b in wanted]
        if not found:
            return self.spark.createDataFrame([], TABLES[table])
        return self.spark.read.schema(TABLES[table] + ", batch int").option("basePath", base).parquet(*sorted(found)).drop("batch")

    def _write(self, rows: DataFrame, table: str, *by: str) -> None:
        rows.hint("rebalance", *by).write.mode("append").partitionBy(*by).parquet(f"{self.root}/{table}")

    def _counts(self, classes: DataFrame):
        """Of each cell of tokens, how often they occurred in what was staged first: eighths of powers of two, at most CELLS
        numbers."""
        if self._rarity is None:

            def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
                for pdf in batches:
                    if len(pdf):
                        cell = np.concatenate([tokens_of(np.asarray(w)) & np.uint64(CELLS - 1) for w in pdf["words"]])
                        at, n = np.unique(cell.astype(np.int32), return_counts=True)
                        yield pd.DataFrame({"cell": at, "n": n})

            cells = classes.select("words").mapInPandas(count, "cell int, n long").groupBy("cell").agg(F.sum("n").alias("n"))
            told = cells.select("cell", F.floor(F.log2("n") * 8).cast("short").alias("level")).toPandas()
            table = np.zeros(CELLS, dtype=np.int16)
            table[told["cell"].to_numpy(dtype=np.int64)] = told["level"].to_numpy() + 1
            self._rarity = self.spark.sparkContext.broadcast((table, classes.count()))
        return self._rarity

    def _postings(self, classes: DataFrame) -> DataFrame:
        """(batch, hi, lo, n, keys, asked, sign, bucket): of each class and bucket the keys it is stored and looked up under,
        those it is only looked up under, and its signature."""
        shared, accept_at, hot, buckets = self._counts(classes), self.accept_at, self.hot, self.buckets
        schema = pa.schema([("batch", pa.int32()), ("hi", pa.int64()), ("lo", pa.int64()), ("n", pa.int32()), ("keys", pa.list_(pa.int64())), ("asked", pa.list_(pa.int64())), ("sign", pa.binary()), ("bucket", pa.int32())])

        def pick(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for x in batches:
                if not x.num_rows:
                    continue
                ends, flat = x["words"].offsets.to_numpy(), x["words"].values.to_numpy()
                made, extra, signs = [], [], np.zeros((x.num_rows, SIGN), np.uint8)
                for i in range(x.num_rows):
                    tokens = tokens_of(flat[ends[i] : ends[i + 1]])
                    bit = np.unique((tokens >> np.uint64(20)).astype(np.int64) & (8 * SIGN - 1))
                    np.bitwise_or.at(signs[i], bit >> 3, (1 << (bit & 7)).astype(np.uint8))
                    stored, only = keys_of(tokens, shared.value, accept_at, hot, int(x["lo"][i].as_py()))
                    made.append(stored)
                    extra.append(only)
                text = np.concatenate([np.repeat(np.arange(x.num_rows), [len(k) for k in kind]) for kind in (made, extra)])
                keys = np.concatenate(made + extra)
                stored = np.arange(len(keys)) < sum(len(k) for k in made)
                bucket = (keys % np.uint64(buckets)).astype(np.int64)
                place, row = np.unique(text * buckets + bucket, return_inverse=True)
                lists = []
                for kind in (stored, ~stored):
                    by = np.argsort(row[kind], kind="stable")
                    till = np.r_[0, np.cumsum(np.bincount(row[kind], minlength=len(place)))].astype(np.int32)
                    lists.append(pa.ListArray.from_arrays(pa.array(till), pa.array(keys[kind][by].view(np.int64))))
                mine = place // buckets
                sign = pa.Array.from_buffers(pa.binary(), len(place), [None, pa.py_buffer(np.arange(len(place) + 1, dtype=np.int32) * SIGN), pa.py_buffer(signs[mine].tobytes())])
                take = [x[c].take(pa.array(mine)) for c in ("batch", "hi", "lo", "n")]
                yield pa.RecordBatch.from_arrays([*take, *lists, sign, pa.array((place % buckets).astype(np.int32))], schema=schema)

        x = classes.select("batch", *halves("first"), F.size("words").alias("n"), "words")
        return x.mapInArrow(pick, "batch int, " + TABLES["postings"])

    def stage(self, rows: DataFrame) -> None:
        """Put down `keyed` rows, whose `batch` numbers follow on those staged before; they are not history yet."""
        self._write(text_classes(rows), "classes", "batch")
        given = rows.where("digest IS NOT NULL").groupBy("batch", "digest").agg(F.min("ord").alias("first"))
        self._write(given, "digests", "batch")
        now = range(self.staged, 1 << 31)
        classes = self.spark.read.schema(TABLES["classes"] + ", batch int").parquet(f"{self.root}/classes").where(F.col("batch") >= now.start) if self._below(f"{self.root}/classes") else self.read("classes", now).withColumn("batch", F.lit(0))
        if self.buckets is None:
            self.buckets = 12 + classes.count() // BUCKET_OF
        self._write(self._postings(classes), "postings", "batch", "bucket")

    def _pairs(self, mine: DataFrame, there: DataFrame | None, own: bool) -> DataFrame:
        """(first, other): pairs of a class of the batch and one earlier than its `upto`, of `there` or, if `own`, of the
        batch, which have a key in common and whose signatures allow that they agree."""
        accept_at = self.accept_at
        fields = ["bucket", "hi", "lo", "n", "keys", "asked", "sign"]
        x = mine.select(*fields, *halves("upto", "uhi", "ulo"), F.lit(2 if own else 1).alias("side"))
        if there is not None:
            none = [F.lit(0).cast("long").alias(c) for c in ("uhi", "ulo")]
            x = x.unionByName(there.select(*fields[:5], F.array().cast("array<long>").alias("asked"), "sign", *none, F.lit(0).alias("side")))

        def meet(rows: pa.Table) -> pa.Table:
            a, b = meetings(rows, accept_at)
            hi, lo = rows["hi"].to_numpy(), rows["lo"].to_numpy()
            return pa.table({"hi": hi[a], "lo": lo[a], "ohi": hi[b], "olo": lo[b]})

        met = x.groupBy("bucket").applyInArrow(meet, "hi long, lo long, ohi long, olo long").distinct()
        return met.select(whole("hi", "lo").alias("first"), whole("ohi", "olo").alias("other"))

    def _agreeing(self, pairs: DataFrame, number: int) -> DataFrame:
        """The pairs (first, other) of a batch whose words agree."""
        words = lambda batches, key, name: self.read("classes", batches).select(F.col("first").alias(key), F.col("words").alias(name))
        x = pairs.join(words(range(number + 1), "other", "b"), "other").join(words(range(number, number + 1), "first", "a"), "first")
        # words that one text has and the other lacks altogether are fewer than those left out
        agreeing = least_agreeing(F.greatest(F.size("a"), F.size("b")), self.accept_at)
        x = x.where((F.size(F.array_except("a", "b")) <= F.size("a") - agreeing) & (F.size(F.array_except("b", "a")) <= F.size("b") - agreeing))
        return x.where(word_agreement("a", "b") >= self.accept_at).select("first", "other")

    def probe(self) -> None:
        """Accept the next staged batch: find of each of its texts the earliest one in history or the batch that agrees."""
        i = self.accepted
        own = self.read("postings", range(i, i + 1)).withColumn("first", whole("hi", "lo"))
        buckets = [int(b[7:]) for b in self._below(f"{self.root}/postings/batch={i}") if b.startswith("bucket=")]
        past, followers = self.read("postings", range(i), buckets), self.read("near", range(i)).select(*halves("first"))
        settled = self.spark.createDataFrame([], f"first {ORD}, other {ORD}")
        if i:
            led = materialize(self._pairs(own.withColumn("upto", F.col("first")), past.join(followers, ["hi", "lo"], "left_anti"), False), "batch-leaders")
            settled = materialize(self._agreeing(led, i).groupBy("first").agg(F.min("other").alias("other")), "batch-settled")
        mine = own.join(settled, "first", "left").withColumn("upto", F.coalesce("other", "first")).drop("other")
        rest = materialize(self._pairs(mine, past.join(followers, ["hi", "lo"], "left_semi") if i else None, True), "batch-rest")
        found = settled.unionByName(self._agreeing(rest, i)).groupBy("first").agg(F.min("other").alias("other"))
        found.write.parquet(f"{self.root}/near/batch={i}")
        self.accepted += 1

    def accept(self, rows: DataFrame) -> DataFrame:
        """(row_id, first): the earliest accepted or own-batch row that is the same document, for rows that have one.

        The rows are then part of the index.
        """
        rows = materialize(keyed(rows.withColumn("batch", F.lit(self.staged))), "batch-rows")
        self.stage(rows)
        self.staged += 1
        self.probe()
        return self.found(rows)

    def found(self, rows: DataFrame) -> DataFrame:
        """As `accept` gives it, of the `keyed` rows of accepted batches."""
        every = range(self.accepted)
        digests = self.read("digests", every).groupBy("digest").agg(F.min("first").alias("d"))
        texts = self.read("classes", every).select("cls", "first").join(self.read("near", every), "first", "left")
        texts = texts.groupBy("cls").agg(F.min(F.least("first", "other")).alias("t"))
        x = rows.select("row_id", "ord", "digest", "cls").join(digests, "digest", "left").join(texts, "cls", "left").withColumn("first", F.least("d", "t"))
        return x.where("first < ord").select("row_id", "first")


#: Room for any queue_id below each batch_no in one number.
_ROOM, _HALF = 10**20, 2**63


def queue_rows(queue: DataFrame, pages: DataFrame) -> DataFrame:
    """Queue rows as (row_id, ord, digest, text, batch_no), ordered by batch_no, then queue_id; a missing digest is that of
    the url's latest page row that has one."""
    q = queue.where("queue_id IS NOT NULL").select("queue_id", F.coalesce("batch_no", F.lit(0)).alias("batch_no"), "url", canonical_digest(F.col("content_hash")).alias("own"), "sample_text").distinct()
    visits = pages.select("url", "last_seen_at", canonical_digest(F.col("content_hash")).alias("digest")).where("url IS NOT NULL AND digest IS NOT NULL")
    wanted = q.where("own IS NULL AND url IS NOT NULL").select("url").distinct()
    latest = visits.join(wanted, "url", "left_semi").groupBy("url").agg(F.max(F.struct("last_seen_at", "digest"))["digest"].alias("paged"))
    order = F.col("batch_no").cast(ORD) * F.lit(str(_ROOM)).cast("decimal(21,0)") + F.col("queue_id").cast("decimal(19,0)") + F.lit(str(_HALF)).cast("decimal(19,0)")
    return q.join(latest, "url", "left").select(F.col("queue_id").alias("row_id"), order.cast(ORD).alias("ord"), F.coalesce("own", "paged").alias("digest"), F.col("sample_text").alias("text"), "batch_no")


def queue_id_of(order: Column) -> Column:
    """The queue_id of a row from its order."""
    return (F.pmod(order, F.lit(str(_ROOM)).cast("decimal(21,0)")) - F.lit(str(_HALF)).cast("decimal(19,0)")).cast("long")


def queue_duplicates(queue: DataFrame, pages: DataFrame, root: str) -> DataFrame:
    """(first_id, dup_id): every queue row with the same document as an earlier one, with the earliest such row.

    What a row's answer is depends on the rows before it and not on where batches end. So those that are all there are
    accepted together, in growing parts, and history is gone through a few times in all, not once a batch. Nulls: rows without queue_id are
    ignored, a missing batch_no is history; rows with neither digest nor text match nothing. Exact repeats of a row count
    once. Texts of three words or fewer match only as wholes. Empty tables give an empty result; further columns are ignored.
    """
    spark = queue.sparkSession
    rows = materialize(keyed(queue_rows(queue, pages).withColumn("batch", F.lit(0))), "queue-rows")
    cuts = batch_cuts(rows)
    if not cuts:
        return spark.createDataFrame([], "first_id long, dup_id long")
    starts = F.array(*[F.lit(str(c)).cast(ORD) for c in cuts])
    rows = rows.withColumn("batch", F.size(F.filter(starts, lambda c: c <= F.col("ord"))) - 1)
    index = RareShingleIndex(spark, root)
    index.stage(rows)
    index.staged = len(cuts)
    for _ in cuts:
        index.probe()
    return index.found(rows).select(queue_id_of(F.col("first")).alias("first_id"), F.col("row_id").alias("dup_id"))


def batch_cuts(rows: DataFrame, block: int = 20_000) -> list[int]:
    """Orders at which parts begin, the first of `block` rows, each other one as large as all before it or up to three times
    that at the end, so that what its first rows lead is known when the others come."""
    n, least = rows.agg(F.count(F.lit(1)), F.min("ord")).first()
    shares, size = [], block
    while 2 * size <= n:
        shares.append(size / n)
        size *= 2
    inner = rows.agg(F.percentile_approx("ord", shares, 1_000_000)).first()[0] if shares else []
    return sorted({int(least), *map(int, inner)}) if n else []
