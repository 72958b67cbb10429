"""Evaluation items in training text.

Items and documents are brought to templates: numbers, names and units become typed placeholders. Windows of template words
are hash-joined; each pair of document and passage that shares one is compared word by word along the diagonals of its
windows, the values that fill the slots of the template being checked for consistency (the same value always replaced by the
same other one), which catches re-parameterised items too.

Template windows are long (2 x WIDTH words), as short ones match anything of the same grammar. So that words replaced all
over a passage are found as well, WIDTH words are also hashed as they stand. Each passage is cut into pieces of WIDTH to
2 x WIDTH words, as short as they can be to hold a window that no other passage has; that window, or the one fewest passages
have, is the piece's seed. By the pigeonhole principle m pieces leave one whole under up to m - 1 replaced words, wherever
those stand (m is n // WIDTH for n words where all windows are rare, n // (2 x WIDTH) at least); a run of 20 words covers a
piece; a passage too short to be cut is one piece.

Scale: one map pass over the documents, whatever the number of items. A bit table of fixed size tells which windows can be a
seed; only those, and the word hashes of documents that have one, are shuffled. Nothing of the items but tables of fixed
size is sent to the executors or the driver; copies of a passage are looked for once.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from archivolt.llm.fold import Words, mix, slices, word_hash
from archivolt.session import materialize, spread

#: Units of measure and count that follow a number, beside those learned from the items.
UNITS = "pages page copies copy volumes volume km kg m cm mm g l lb oz miles mile feet foot hours hour minutes seconds days day weeks months years percent dollars euros pounds letters seiten paginas pages ans jahre".split()
#: German articles; a capitalised word behind one of them is a noun, not a name.
ARTICLES = "der die das den dem des ein eine einen einem einer eines im am zum zur".split()

NUM, NAME, UNIT = np.uint64(0x11), np.uint64(0x22), np.uint64(0x33)
#: Words of a piece; passages under LEAST_CUT x WIDTH words are cut into pieces of a word less, and under 2 x (WIDTH - 1) not at all.
WIDTH, LEAST_CUT = 5, 4
#: Cells of the table of word roles, and of the table of seeds.
WORD_CELLS, SEED_CELLS = 1 << 22, 1 << 24
NAMED, KNOWN, COMMON, MEASURE = 1, 2, 4, 8


def seed_windows(n: int) -> list[tuple[int, bool]]:
    """(width, whether of the template) of the seeds of a passage of n words."""
    width = WIDTH if n >= LEAST_CUT * WIDTH else WIDTH - 1 if n >= 2 * (WIDTH - 1) else n
    return [(width, False), (min(n, 2 * width), True)]


class Template:
    """Roles of words, as learned from the items: `roles[cell]` of a word's hash."""

    def __init__(self, roles: np.ndarray):
        self.roles = roles

    def of(self, words: Words) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Word codes with placeholders, whether a word fills a slot, and whether it stands for itself.

        A name is a word that some item has with a capital inside a sentence, or a word no item has that stands so in the
        text, and in scripts without capitals any word that not two items have. What an item's word is depends on nothing
        around it, so that equal words make equal templates.
        """
        h, digit = words.hash, words.digit
        if len(h) == 0:
            return h, digit, digit
        role = self.roles[h & np.uint64(WORD_CELLS - 1)]
        name = ((role & NAMED) > 0) | (words.capital & ((role & KNOWN) == 0)) | (words.caseless & ((role & COMMON) == 0))
        unit = (role & MEASURE) > 0
        code = np.where(digit, NUM, np.where(unit, UNIT, np.where(name, NAME, h)))
        return code, digit | (name & ~unit), ~(digit | name | unit)


def windows(words: Words, code: np.ndarray, literal: np.ndarray, width: int, template: bool) -> tuple[np.ndarray, np.ndarray]:
    """Place and hash of each window; template windows with under three words that stand for themselves are left out, as
    placeholders alone would match anything, and have hash 0."""
    at, h = words.windows(code if template else words.hash, width)
    h ^= np.uint64(2 * width + template)
    if template:
        upto = np.concatenate(([0], np.cumsum(literal)))
        h[upto[at + width] - upto[at] < 3] = 0
    return at, h


def word_roles(items: DataFrame) -> np.ndarray:
    """The table of roles from all passages: one aggregation over words, then at most WORD_CELLS rows to the driver."""

    def tell(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        articles = word_hash(ARTICLES)
        for pdf in batches:
            texts = pdf["t"].tolist()
            for a, b in slices(texts):
                w = Words(texts[a:b])
                if len(w.hash) == 0:
                    continue
                before = np.concatenate(([np.uint64(0)], w.hash[:-1]))
                x = pd.DataFrame({"h": w.hash.view(np.int64), "doc": w.doc, "named": w.capital & ~np.isin(before, articles), "measured": np.concatenate(([False], w.digit[:-1])) & ~w.digit})
                x["n"] = 1
                per = x.groupby(["h", "doc"], sort=False).sum().reset_index()
                per["items"] = 1
                yield per.groupby("h", sort=False)[["items", "n", "named", "measured"]].sum().reset_index()

    parts = items.mapInPandas(tell, "h long, items long, n long, named long, measured long")
    sums = parts.groupBy("h").agg(*[F.sum(c).alias(c) for c in ("items", "n", "named", "measured")])
    flag = lambda cond, bit: F.when(cond, F.lit(bit)).otherwise(0)
    role = flag(F.col("named") > 0, NAMED) + F.lit(KNOWN) + flag(F.col("items") >= 2, COMMON) + flag((F.col("measured") >= 2) & (F.col("measured") * 2 >= F.col("n")), MEASURE)
    cells = sums.select(F.col("h").bitwiseAND(F.lit(WORD_CELLS - 1)).cast("int").alias("cell"), role.alias("role"))
    told = cells.groupBy("cell").agg(F.bit_or("role").cast("int").alias("role")).toPandas()
    roles = np.zeros(WORD_CELLS, dtype=np.uint8)
    roles[told["cell"].to_numpy(dtype=np.int64)] = told["role"].to_numpy(dtype=np.uint8)
    roles[(word_hash(UNITS) & np.uint64(WORD_CELLS - 1)).astype(np.int64)] |= MEASURE
    return roles


def _packed(words: np.ndarray) -> bytes:
    return words.astype(np.uint64).tobytes()


def windowed_items(items: DataFrame, roles) -> DataFrame:
    """(pid, words, slots, n, kind, width, hashes): word hashes of each passage, with all its windows of either kind."""

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = Template(roles.value)
        for pdf in batches:
            out = []
            for pid, text in zip(pdf["pid"], pdf["t"]):
                w = Words([text])
                n = len(w.hash)
                if n == 0:
                    continue
                code, slot, literal = known.of(w)
                kinds = [(width, windows(w, code, literal, width, template)[1].view(np.int64)) for width, template in seed_windows(n)]
                out.append((pid, _packed(w.hash), slot.tobytes(), n, *kinds[0], *kinds[1]))
            yield pd.DataFrame(out, columns=["pid", "words", "slots", "n", "width", "plain", "template_width", "template"])

    return items.mapInPandas(cut, "pid long, words binary, slots binary, n int, width int, plain array<long>, template_width int, template array<long>")


def chosen(width: int, hashes: np.ndarray, often: np.ndarray) -> list[int]:
    """Places of the seeds: in each piece the first window no other passage has, else the one fewest have."""
    out, a = [], 0
    while a < len(hashes):
        b = min(a + width + 1, len(hashes))
        free = np.flatnonzero(hashes[a:b] != 0)
        if len(free) == 0:
            a = b
            continue
        at = a + int(free[often[a:b][free].argmin()])
        out.append(at)
        a = at + width
    return out


def seeds_of(items: DataFrame) -> DataFrame:
    """(pid, seed, off): the seeds of the windowed passages with their places."""
    kinds = [items.select("pid", F.lit(k).alias("kind"), F.col(w).alias("width"), F.posexplode(h).alias("off", "seed")) for k, w, h in ((0, "width", "plain"), (1, "template_width", "template"))]
    each = kinds[0].unionByName(kinds[1])
    often = each.where("seed != 0").select("pid", "seed").distinct().groupBy("seed").agg(F.count(F.lit(1)).alias("often"))
    whole = each.join(often, "seed", "left").groupBy("pid", "kind", "width").agg(F.array_sort(F.collect_list(F.struct("off", "seed", F.coalesce("often", F.lit(0)).alias("often")))).alias("x"))  # one passage's windows
    flat = whole.select("pid", "width", F.transform("x", lambda x: x["seed"]).alias("seeds"), F.transform("x", lambda x: x["often"]).alias("often"))

    def choose(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = [(pid, int(seeds[at]), at) for pid, width, seeds, often in zip(pdf["pid"], pdf["width"], pdf["seeds"], pdf["often"]) for at in chosen(width, np.asarray(seeds), np.asarray(often))]
            yield pd.DataFrame(out, columns=["pid", "seed", "off"])

    return flat.mapInPandas(choose, "pid long, seed long, off int")


def _longest(hit: np.ndarray) -> int:
    edge = np.flatnonzero(np.diff(np.concatenate(([0], hit.view(np.int8), [0]))))
    return int((edge[1::2] - edge[0::2]).max()) if len(edge) else 0


def _in_runs(hit: np.ndarray, least: int) -> np.ndarray:
    """`hit` where it belongs to a run of at least `least`."""
    edge = np.flatnonzero(np.diff(np.concatenate(([0], hit.view(np.int8), [0]))))
    out = np.zeros(len(hit), dtype=bool)
    for a, b in zip(edge[0::2], edge[1::2]):
        if b - a >= least:
            out[a:b] = True
    return out


def compared(doc: np.ndarray, doc_slot: np.ndarray, item: np.ndarray, slot: np.ndarray, lead: int, others: list[int], run: int, share: float) -> tuple[str, int, float] | None:
    """(kind, longest run, share of the passage in place) if the part of a document holds the passage, else None.

    `lead` and `others` are diagonals; words put in or left out shift the diagonal, so what the others hold counts too.
    """
    n, longest, swapped, clash, mapped = len(item), 0, 0, 0, {}
    covered = np.zeros(n, dtype=bool)
    for g in [lead, *others]:
        x, y = max(0, -g), min(n, len(doc) - g)
        if y <= x:
            continue
        same = np.zeros(n, dtype=bool)
        same[x:y] = item[x:y] == doc[x + g : y + g]
        far = _longest(same)
        longest = max(longest, far)
        if far >= min(run, n):
            return "verbatim", far, float(_in_runs(same, min(3, n)).mean())
        filled = slot[x:y] & doc_slot[x + g : y + g]
        for p in np.flatnonzero(filled if g == lead else filled & ~covered[x:y]):
            was, now = int(item[x + p]), int(doc[x + g + p])
            swapped += was != now
            clash += mapped.setdefault(was, now) != now
        covered |= _in_runs(same, min(3, n))
    part = float(covered.mean())
    if part >= share:
        return "edited", longest, part
    if swapped and clash == 0 and swapped * 3 <= n and part + swapped / n >= 0.95:
        return "reparameterised", longest, part
    return None


def compared_parts(pdf: pd.DataFrame, run: int, share: float) -> list[tuple]:
    """(doc_id, pid, kind, longest run, share) of the rows that hold their passage.

    All rows are first compared along their own diagonal in one go; a row is looked at closely only if enough words agree
    for any verdict, which takes three fifths of the passage or a run.
    """
    item = [np.frombuffer(x, dtype=np.uint64) for x in pdf["item"]]
    text = [np.frombuffer(x, dtype=np.uint64) for x in pdf["words"]]
    n, size = pdf["n"].to_numpy(dtype=np.int64), np.array([len(t) for t in text], dtype=np.int64)
    lead = (pdf["g"] - pdf["lo"]).to_numpy(dtype=np.int64)
    first = np.cumsum(n) - n
    row = np.repeat(np.arange(len(n)), n)
    at = np.arange(n.sum()) - first[row] + lead[row]
    there = (at >= 0) & (at < size[row])
    same = np.zeros(len(at), dtype=np.int64)
    same[there] = np.concatenate(item)[there] == np.concatenate(text)[(np.cumsum(size) - size)[row[there]] + at[there]]
    agree = np.add.reduceat(same, first)
    alone = np.array([len(x) == 0 for x in pdf["others"]])
    out = []
    for i in np.flatnonzero(~alone | (agree >= np.minimum(run, 0.6 * n))):
        flags = lambda raw: np.frombuffer(raw, dtype=np.bool_)
        told = compared(text[i], flags(pdf["slots"].iat[i]), item[i], flags(pdf["item_slots"].iat[i]), int(lead[i]), [int(lead[i] + x) for x in pdf["others"].iat[i]], run, share)
        if told:
            out.append((pdf["doc_id"].iat[i], pdf["pid"].iat[i], *told))
    return out


def passages(benchmark: DataFrame) -> DataFrame:
    """(item_id, passage): the text without a stock instruction, i.e. a first line that opens two items or more."""
    line = F.substring_index("text", "\n", 1)
    b = benchmark.select("item_id", "text", F.when(F.col("text").contains("\n"), line).alias("line")).where("item_id IS NOT NULL AND text IS NOT NULL")
    stock = b.where("line IS NOT NULL").groupBy("line").agg(F.countDistinct("item_id").alias("items")).where("items > 1")
    joined = b.join(stock, "line", "left")
    return joined.select("item_id", F.when(F.col("items").isNotNull(), F.expr("substring(text, length(line) + 2)")).otherwise(F.col("text")).alias("passage"))


def seeded_documents(docs: DataFrame, roles, seeds, widths: list[tuple[int, bool]]) -> DataFrame:
    """(doc_id, words, slots, seed, at): of each document with a window that may be a seed."""

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known, bits = Template(roles.value), seeds.value
        for pdf in batches:
            texts, ids, out = pdf["t"].tolist(), pdf["doc_id"].to_numpy(), []
            for x, y in slices(texts):
                w = Words(texts[x:y])
                if len(w.hash) == 0:
                    continue
                code, slot, literal = known.of(w)
                found = []
                for width, template in widths:
                    at, h = windows(w, code, literal, width, template)
                    cell = h & np.uint64(SEED_CELLS - 1)
                    hit = np.flatnonzero((bits[(cell >> np.uint64(3)).astype(np.int64)] >> (cell & np.uint64(7)).astype(np.uint8)) & (h != 0))
                    found.append((at[hit], h[hit]))
                at, h = np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])
                if len(at) == 0:
                    continue
                bounds = np.searchsorted(w.doc, np.arange(y - x + 1))
                order = np.argsort(at, kind="stable")
                at, h = at[order], h[order]
                for d in np.unique(w.doc[at]):
                    lo, hi = bounds[d], bounds[d + 1]
                    a, b = np.searchsorted(at, lo), np.searchsorted(at, hi)
                    out.append((ids[x + d], _packed(w.hash[lo:hi]), slot[lo:hi].tobytes(), h[a:b].view(np.int64), (at[a:b] - lo).astype(np.int32)))
            yield pd.DataFrame(out, columns=["doc_id", "words", "slots", "seed", "at"])

    return docs.mapInPandas(scan, "doc_id long, words binary, slots binary, seed array<long>, at array<int>")


def leaks(documents: DataFrame, benchmark: DataFrame, run: int = 20, share: float = 0.8) -> DataFrame:
    """(doc_id, item_id, kind, longest_run, covered) of documents that hold a passage of an item.

    kind: `verbatim` (a run of `run` words, or the whole of a shorter passage), `edited` (at least `share` of the passage's
    words in place, in runs of three), `reparameterised` (all but the values of names, numbers and units, at most a third,
    which are replaced consistently). Nulls: rows without id or text are ignored, as are passages without words. Repeated
    rows give the same pairs, once per doc_id; empty tables give none; whole texts count; further columns are ignored.
    """
    spark = documents.sparkSession
    schema = "doc_id long, pid long, kind string, longest_run int, covered double"
    items = materialize(passages(benchmark).select("item_id", F.col("passage").alias("t")).where("trim(t) != ''").distinct().withColumn("pid", F.xxhash64("t")), "leak-passages")
    distinct = items.groupBy("pid").agg(F.min("t").alias("t"))
    roles = spark.sparkContext.broadcast(word_roles(distinct))
    seeded = materialize(windowed_items(distinct, roles), "leak-items")
    seeds = materialize(seeds_of(seeded), "leak-seeds")
    cells = seeds.select(F.col("seed").bitwiseAND(F.lit(SEED_CELLS - 1)).cast("int").alias("cell")).distinct().toPandas()["cell"].to_numpy(dtype=np.int64)  # SEED_CELLS rows at most
    bits = np.zeros(SEED_CELLS, dtype=bool)
    bits[cells] = True
    bits = spark.sparkContext.broadcast(np.packbits(bits, bitorder="little"))
    widths = sorted({x for r in seeded.select(F.least("n", F.lit(LEAST_CUT * WIDTH)).alias("n")).distinct().collect() for x in seed_windows(r["n"])})  # 20 rows at most
    docs = spread(documents.where("doc_id IS NOT NULL AND text IS NOT NULL").select("doc_id", F.col("text").alias("t")))
    if not widths:
        return spark.createDataFrame([], "doc_id long, item_id long, kind string, longest_run int, covered double")
    held = materialize(seeded_documents(docs, roles, bits, widths), "leak-documents")
    # repeated rows of one id may carry several texts: each is compared by itself
    held = held.withColumn("tid", F.xxhash64("words"))
    hits = held.select("doc_id", "tid", F.explode(F.arrays_zip("seed", "at")).alias("s")).select("doc_id", "tid", "s.seed", "s.at")
    lines = hits.join(seeds, "seed").groupBy("doc_id", "tid", "pid").agg(F.collect_set(F.col("at") - F.col("off")).alias("diagonals"))  # one document's places of one passage
    sized = lines.join(seeded.select("pid", "n", F.greatest(F.lit(2), F.floor(F.col("n") / 5)).cast("int").alias("m")), "pid")
    near = lambda g: F.transform(F.filter("diagonals", lambda x: (x != g) & (F.abs(x - g) <= F.col("m"))), lambda x: x - g)
    leads = sized.select("*", F.explode("diagonals").alias("g")).select("doc_id", "tid", "pid", "n", "m", "g", near(F.col("g")).alias("others"), F.greatest(F.lit(0), F.col("g") - F.col("m")).alias("lo"))
    there = leads.join(held.select("doc_id", "tid", "words", "slots"), ["doc_id", "tid"])
    upto = F.greatest(F.lit(0), F.col("g") + F.col("n") + F.col("m") - F.col("lo"))
    parts = there.select("doc_id", "pid", "n", "g", "others", "lo", F.substring("words", F.col("lo") * 8 + 1, upto * 8).alias("words"), F.substring("slots", F.col("lo") + 1, upto).alias("slots"))
    joined = parts.join(seeded.select("pid", F.col("words").alias("item"), F.col("slots").alias("item_slots")), "pid").drop("m")

    def verify(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            yield pd.DataFrame(compared_parts(pdf, run, share) if len(pdf) else [], columns=["doc_id", "pid", "kind", "longest_run", "covered"])

    verdicts = joined.mapInPandas(verify, schema).groupBy("doc_id", "pid").agg(F.max(F.struct("covered", "longest_run", "kind")).alias("v"))
    return verdicts.join(items.select("pid", "item_id").distinct(), "pid").select("doc_id", "item_id", "v.kind", "v.longest_run", "v.covered")


def leaked_items(found: DataFrame) -> DataFrame:
    """(item_id, documents, verbatim, edited, reparameterised): how many documents each leaked item is in."""
    return found.groupBy("item_id").agg(
        F.countDistinct("doc_id").alias("documents"),
        *[F.count_if(F.col("kind") == k).alias(k) for k in ("verbatim", "edited", "reparameterised")],
    )
