"""Language labels from n-gram filters that answer with language bitmasks.

A bit-sliced Bloom filter holds as many 64-bit words per cell as the languages need; a lookup ANDs the cells of an n-gram's
hashes and returns every language that contains it. Hits per language, corrected by that language's rate of false positives,
give word scores; a best path with a cost for switching cuts a text into segments of one language each. Which languages there
are is learned from the labels: one that names no language known here is another spelling of the language its texts are in,
or else a language of its own.

Scale: the filter's size depends on the number of languages alone, and it goes to every executor; texts are judged in Arrow
batches, all words of many texts at once, without a shuffle but the one that picks the newest row of a url. The filter is
fitted on a bounded sample of labelled rows.
"""

from __future__ import annotations

import functools
import unicodedata
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from archivolt.llm.fold import mix, slices
from archivolt.session import materialize, spread

#: ISO 639-1 codes and the names a label may use for them.
NAMES = {
    "en": "en eng english anglais inglés inglese englisch", "fr": "fr fra fre french français francais französisch francés", "de": "de deu ger german deutsch allemand alemán tedesco",
    "es": "es spa spanish español espanol castellano spanisch espagnol", "it": "it ita italian italiano italienisch italien", "pt": "pt por portuguese português portugues portugiesisch",
    "ru": "ru rus russian русский", "ar": "ar ara arabic العربية عربي", "fa": "fa fas per persian farsi فارسی", "he": "he heb iw hebrew עברית",
    "zh": "zh zho chi chinese mandarin 中文 汉语", "ja": "ja jpn japanese 日本語", "nl": "nl nld dut dutch nederlands", "pl": "pl pol polish polski", "tr": "tr tur turkish türkçe",
}
CELLS = 1 << 20
HASHES = 2
#: Labels that say nothing.
NO_LABEL = ["", "unknown", "und", "none", "null", "n/a", "?"]


def label_code(label: Column, spellings: dict[str, str] | None = None) -> Column:
    """ISO 639-1 code a label names, else what `spellings` makes of it, else the label in lower case; NULL where it says
    nothing (NULL, blank, unknown, und)."""
    pairs = [(n, code) for code, names in NAMES.items() for n in names.split()] + list((spellings or {}).items())
    table = F.create_map(*[F.lit(x) for p in dict(pairs).items() for x in p])
    plain = F.lower(F.trim(label))
    bare = F.regexp_replace(plain, r"^([a-z]{2,3})[-_].*$", "$1")
    return F.when(~plain.isin(NO_LABEL), F.coalesce(F.try_element_at(table, plain), F.try_element_at(table, bare), bare))


@functools.cache
def _letters() -> tuple[np.ndarray, np.ndarray]:
    """Folded letter of every code point below 0x30000 (0: none), and whether it is a word of its own."""
    fold = np.zeros(0x30000, dtype=np.uint32)
    alone = np.zeros(0x30000, dtype=bool)
    for cp in range(0x30000):
        c = chr(cp)
        if unicodedata.category(c)[0] == "L":
            fold[cp] = ord(c.lower()[0])
    for a, z in ((0x3040, 0x3100), (0x3400, 0xA000), (0x20000, 0x30000)):
        alone[a:z] = fold[a:z] > 0
    return fold, alone


def grams(text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the n-grams, the word of each, and (begin, end) of the words in the text.

    A word's n-grams are its letters' pairs, triples and fours, bars before and behind, and its letters beyond Latin.
    """
    fold, alone = _letters()
    code = np.frombuffer(text.encode("utf-32-le", "replace"), dtype=np.uint32)
    code = np.minimum(code, 0x2FFFF)
    letter = fold[code]
    single = alone[code]
    is_letter = letter > 0
    new = is_letter & (~np.concatenate(([False], is_letter[:-1])) | single | np.concatenate(([False], single[:-1])))
    begin = np.flatnonzero(new)
    if len(begin) == 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), begin, begin
    at = np.flatnonzero(is_letter)
    word = np.cumsum(new)[at] - 1
    last = np.concatenate((np.flatnonzero(np.diff(word)), [len(at) - 1]))
    end = at[last] + 1
    # one bar (1) before each word and one behind the last
    n = len(at) + len(begin) + 1
    seq = np.ones(n, dtype=np.uint64)
    owner = np.zeros(n, dtype=np.int64)
    place = np.arange(len(at)) + word + 1
    seq[place] = letter[at].astype(np.uint64) + np.uint64(2)
    owner[place] = word
    bars = np.flatnonzero(seq == 1)
    owner[bars] = np.minimum(np.arange(len(bars)), len(begin) - 1)
    out_h, out_w = [], []
    far = place[letter[at] > 0x24F]
    out_h.append(mix(seq[far] * np.uint64(0x9E3779B97F4A7C15)))
    out_w.append(owner[far])
    bar = seq == 1
    with np.errstate(over="ignore"):
        for k in (2, 3, 4):
            if n < k:
                break
            h = np.full(n - k + 1, k, dtype=np.uint64)
            inner = np.zeros(n - k + 1, dtype=bool)
            for i in range(k):
                h = h * np.uint64(0xC2B2AE3D27D4EB4F) + seq[i : n - k + 1 + i]
                if 0 < i < k - 1:
                    inner |= bar[i : n - k + 1 + i]
            ok = ~inner & ~(bar[: n - k + 1] & bar[k - 1 :])
            out_h.append(mix(h[ok]))
            # a bar that ends a word belongs to the next one; the n-gram's second sign is surely in its own word
            out_w.append(owner[1 : n - k + 2][ok] if k > 2 else np.where(bar[1:n][ok], owner[: n - 1][ok], owner[1:n][ok]))
    return np.concatenate(out_h), np.concatenate(out_w), begin, end


def cells(h: np.ndarray) -> list[np.ndarray]:
    return [((h >> np.uint64(21 * i)) % np.uint64(CELLS)).astype(np.int64) for i in range(HASHES)]


class Filter:
    """The filter: bit k of word k // 64 of a cell is set if language k has an n-gram there. `spellings`: labels of no name
    known here, with the language they name."""

    def __init__(self, languages: list[str], entries: list[tuple[int, np.ndarray]], spellings: dict[str, str] | None = None):
        self.languages, self.spellings = languages, spellings or {}
        kind = np.uint16 if len(languages) <= 16 else np.uint64
        self.bits = 16 if len(languages) <= 16 else 64
        self.tables = [np.zeros(CELLS, dtype=kind) for _ in range(max(1, -(-len(languages) // self.bits)))]
        for k, h in entries:
            for c in cells(h):
                self.tables[k // self.bits][c] |= kind(1 << (k % self.bits))
        self.false_rate = np.array([float(self._bit(self.tables, k).mean()) ** HASHES for k in range(len(languages))])

    def _bit(self, words: list[np.ndarray], k: int) -> np.ndarray:
        w = words[k // self.bits]
        return (w >> w.dtype.type(k % self.bits)) & w.dtype.type(1)

    def masks(self, h: np.ndarray) -> list[np.ndarray]:
        at = cells(h)
        return [functools.reduce(np.bitwise_and, [t[c] for c in at]) for t in self.tables]

    def word_scores(self, text: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(words x languages) corrected hits, n-grams per word, begin, end."""
        h, w, begin, end = grams(text)
        if len(begin) == 0:
            return np.zeros((0, len(self.languages))), np.zeros(0), begin, end
        m = self.masks(h)
        n = np.bincount(w, minlength=len(begin)).astype(float)
        hits = np.stack([np.bincount(w, weights=self._bit(m, k), minlength=len(begin)) for k in range(len(self.languages))], axis=1)
        return (hits - n[:, None] * self.false_rate) / (1 - self.false_rate), n, begin, end

    @staticmethod
    def _path(gain: np.ndarray, switch: float) -> np.ndarray:
        """The language of each word on the best path, a change costing `switch`."""
        best = np.zeros(gain.shape[1])
        back = np.zeros(gain.shape, dtype=np.int16)
        own = np.arange(gain.shape[1])
        for i in range(len(gain)):
            top = int(best.argmax())
            stay = best >= best[top] - switch
            back[i] = np.where(stay, own, top)
            best = np.where(stay, best, best[top] - switch) + gain[i]
        path = np.zeros(len(gain), dtype=np.int64)
        path[-1] = best.argmax()
        for i in range(len(gain) - 1, 0, -1):
            path[i - 1] = back[i][path[i]]
        return path

    def segments(self, texts: list[str], switch: float = 14.0, least_words: int = 5, least_letters: int = 20) -> list[list[tuple[str, int, int, float, float]]]:
        """Of each text (language, begin, end, confidence, weight) of each passage; shorter stretches belong to none."""
        joined = "\n".join(texts)
        score, n, begin, end = self.word_scores(joined)
        out: list[list] = [[] for _ in texts]
        if len(begin) == 0:
            return out
        offset = np.cumsum([0] + [len(t) + 1 for t in texts])
        owner = np.searchsorted(offset, begin, side="right") - 1
        first = np.flatnonzero(np.concatenate(([True], owner[1:] != owner[:-1])))
        last = np.concatenate((first[1:], [len(begin)]))
        size = end - begin
        _, alone = _letters()
        code = np.frombuffer(joined.encode("utf-32-le", "replace"), dtype=np.uint32)
        han = alone[np.minimum(code[begin], 0x2FFFF)]
        gain = score - score.max(axis=1, keepdims=True)
        # where no stretch in any other language wins half a change back, one language throughout is the best path
        lead = np.add.reduceat(gain, first, axis=0).argmax(axis=1)
        place = np.repeat(np.arange(len(first)), last - first)
        ahead = gain - gain[np.arange(len(gain)), lead[place]][:, None]
        run = np.cumsum(ahead, axis=0)
        run -= (run[first] - ahead[first])[place]
        apart = (1e7 * place)[:, None]
        low = np.minimum.accumulate(run - ahead - apart, axis=0) + apart
        mixed = np.maximum.reduceat((run - low).max(axis=1), first) >= switch / 2
        for t, (a, b) in enumerate(zip(first, last)):
            path = self._path(gain[a:b], switch) if mixed[t] else None
            cut = np.concatenate(([0], np.flatnonzero(np.diff(path)) + 1, [b - a])) if path is not None else (0, b - a)
            for x, y in zip(cut[:-1], cut[1:]):
                k = int(lead[t] if path is None else path[x])
                x, y = a + x, a + y
                if len(cut) > 2:  # names belong to no language: a passage among others reaches from its first to its last own word
                    rest = score[x:y].copy()
                    rest[:, k] = -np.inf
                    own = np.flatnonzero(score[x:y, k] - (rest.max(axis=1) if score.shape[1] > 1 else 0.0) > 0.5)
                    if len(own) == 0:
                        continue
                    x, y = x + own[0], x + own[-1] + 1
                chars, letters = int(han[x:y].sum()), int(size[x:y].sum())
                words = (y - x - chars) + chars / 1.7
                if words < least_words or letters < (least_letters if chars == 0 else 6):
                    continue
                total = score[x:y].sum(axis=0)
                others = np.delete(total, k)
                hit, far = total[k] / max(1.0, n[x:y].sum()), (total[k] - (others.max() if len(others) else 0.0)) / max(total[k], 1e-9)
                begun = int(offset[owner[a]])
                out[owner[a]].append((self.languages[k], int(begin[x]) - begun, int(end[y - 1]) - begun, float(np.clip(hit * (0.5 + 0.5 * min(1.0, 4 * far)), 0, 1)), float(letters + 1.5 * chars)))
        return out


def _fitted(sample: pd.DataFrame, languages: list[str], least_share: float, spellings: dict[str, str] | None = None) -> Filter:
    shares: list[tuple[np.ndarray, np.ndarray]] = []
    for lang in languages:
        texts = sample.loc[sample["lang"] == lang, "text"]
        each = [np.unique(grams(t)[0]) for t in texts]
        h, c = np.unique(np.concatenate(each), return_counts=True)
        often = c >= min(2, max(1, len(texts) // 10))
        shares.append((h[often], c[often] / len(texts)))
    every = np.concatenate([h for h, _ in shares])
    known, place_of = np.unique(every, return_inverse=True)
    most = np.zeros(len(known))
    np.maximum.at(most, place_of, np.concatenate([s for _, s in shares]))
    entries, at = [], 0
    for k, (h, s) in enumerate(shares):
        ok = s >= least_share * most[place_of[at : at + len(h)]]
        entries.append((k, h[ok]))
        at += len(h)
    return Filter(languages, entries, spellings)


def fit(labelled: DataFrame, rows_per_language: int = 600, least_share: float = 0.3, least_part: float = 0.002, same: float = 0.7) -> Filter:
    """The filter of (lang, text) rows: an n-gram belongs to a language if the share of that language's texts which have
    it is at least `least_share` of its largest share in any language. At most `rows_per_language` rows of each count,
    chosen by the hash of the text, whatever the size of the table. Wrong labels are outvoted.

    A label with no name known here counts from `least_part` of the labelled rows on, so that there are 1 / `least_part` at
    most: if a share `same` of its texts' n-grams are those of one language known by then, it names that, else one of its own.
    """

    hashed = labelled.where("lang IS NOT NULL AND text IS NOT NULL AND text != ''").select("lang", "text", F.xxhash64("text").alias("h")).distinct()
    sizes = hashed.groupBy("lang").agg(F.count(F.lit(1)).alias("n"))
    part = F.col("n") >= least_part * F.sum("n").over(Window.partitionBy(F.lit(1)))  # one row a label
    size = {r["lang"]: r["n"] for r in sizes.where("lang IS NOT NULL").withColumn("often", part).where(F.col("often") | F.col("lang").isin(list(NAMES))).collect()}
    if not size:
        return Filter(["en"], [])
    keep = F.create_map(*[F.lit(x) for k, v in size.items() for x in (k, min(1.0, rows_per_language / v))])
    # the hash as a number in [0, 1): a fraction of each language's rows
    place = F.pmod("h", F.lit(1 << 30)) / F.lit(float(1 << 30))
    sample = hashed.where(place < F.try_element_at(keep, F.col("lang"))).select("lang", "text").toPandas()
    present = sorted(sample["lang"].unique())
    languages, spellings = [k for k in present if k in NAMES] or present[:1], {}
    model = _fitted(sample, languages, least_share)
    for label in sorted(set(present) - set(languages), key=lambda k: (-size[k], k)):
        total, grams_seen = np.zeros(len(model.languages)), 0.0
        for text in sample.loc[sample["lang"] == label, "text"]:
            score, n, _, _ = model.word_scores(text)
            total, grams_seen = total + score.sum(axis=0), grams_seen + n.sum()
        if grams_seen and total.max() >= same * grams_seen:
            spellings[label] = model.languages[int(total.argmax())]
        else:
            languages = sorted([*languages, label])
            model = _fitted(sample, languages, least_share)
    model.spellings = spellings
    return model


def newest(pdf_quality: DataFrame) -> DataFrame:
    """One row per url: the latest scored; ties go to the greater label, excerpt and summary."""
    kept = pdf_quality.where("url IS NOT NULL").select("url", F.struct("scored_at", "ai_language", "excerpt", "ai_summary").alias("r"))
    return kept.groupBy("url").agg(F.max("r").alias("r")).select("url", "r.ai_language", "r.excerpt", "r.ai_summary")


def learned(pdf_quality: DataFrame, rows_per_language: int = 600) -> tuple[DataFrame, Filter]:
    """The newest row of each url, and the filter fitted on their labels and excerpts."""
    rows = materialize(newest(pdf_quality), "newest-quality")
    return rows, fit(rows.select(label_code(F.col("ai_language")).alias("lang"), F.col("excerpt").alias("text")), rows_per_language)


def judged(rows: DataFrame, model: Filter) -> DataFrame:
    """(url, field, seg_no, begin, end, lang, confidence, share): segments of excerpt and ai_summary, in order.

    Texts without a passage yield nothing; NULL and blank texts are ignored. `share` is the segment's part of the text.
    """
    rows = spread(rows)
    shared = rows.sparkSession.sparkContext.broadcast(model)

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        model = shared.value
        for pdf in batches:
            out = []
            for field in ("excerpt", "ai_summary"):
                given = pdf[["url", field]][pdf[field].map(bool) & pdf[field].notna()]
                urls, texts = given["url"].tolist(), given[field].tolist()
                for a, b in slices(texts, 100_000):
                    for url, parts in zip(urls[a:b], model.segments(texts[a:b])):
                        total = sum(p[4] for p in parts) or 1.0
                        out += [(url, field, i, p[1], p[2], p[0], p[3], p[4] / total) for i, p in enumerate(parts)]
            yield pd.DataFrame(out, columns=["url", "field", "seg_no", "begin", "end", "lang", "confidence", "share"])

    return rows.select("url", "excerpt", "ai_summary").mapInPandas(cut, "url string, field string, seg_no int, begin int, end int, lang string, confidence double, share double")


def main_languages(segments: DataFrame) -> DataFrame:
    """(url, lang, confidence): the language of the greater part of each excerpt; ties go to the earlier code."""
    by = segments.where("field = 'excerpt'").groupBy("url", "lang").agg(F.sum("share").alias("share"), F.sum(F.col("confidence") * F.col("share")).alias("c"))
    top = by.groupBy("url").agg(F.max(F.struct("share", (-F.ascii("lang")).alias("t"), (-F.ascii(F.substring("lang", 2, 1))).alias("u"), "lang", "c")).alias("m"))
    return top.select("url", F.col("m.lang").alias("lang"), (F.col("m.c")).alias("confidence"))


def label_findings(rows: DataFrame, model: Filter, segments: DataFrame) -> DataFrame:
    """(url, field, lang): of the newest rows, labels that are missing or name another language than the excerpt's main one, with that
    language; and for texts with passages in two languages or more each of them."""
    labels = rows.select("url", label_code(F.col("ai_language"), model.spellings).alias("said"))
    wrong = main_languages(segments).join(labels, "url").where("said IS NULL OR said != lang").select("url", F.lit("ai_language").alias("field"), "lang")
    per = segments.groupBy("url", "field").agg(F.collect_set("lang").alias("langs")).where(F.size("langs") > 1)
    return wrong.unionByName(per.select("url", "field", F.explode("langs").alias("lang")))
