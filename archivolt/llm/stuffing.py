"""Pages that are not writing but stuffed keywords, link lists or product tags.

Every text is cut into segments at sentence ends and blank lines. A segment counts as writing when enough of its words
are function words of one language, and it is neither repeated, nor dominated by few words, nor dense in separators,
links, tags or codes; words inside n-grams that the text says SAID times are not counted in either case. Function words
are those that many documents of a language share. Every threshold is the language's own, from all labelled documents:
what its words usually have (quantiles that a third of stuffing does not move), times or plus a margin.

Scale: two map passes over the texts (Arrow batches, numpy), a partial aggregation of word counts and histograms before the
only shuffle, and per-document feature rows of some hundred bytes from which the last calibration and the verdict follow.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from archivolt.llm.fold import END, LINK, SEP, TAG, WORD, Words, slices
from archivolt.session import materialize, spread

BINS = 20
#: A link target stands for about so many words (scheme, host, path, query), a hash sign joins two.
LINK_WORDS, TAG_WORDS = 5, 1


#: Documents without any of the words that are added to each label, so that few documents make few function words.
EMPTY_DOCS = 10


#: Measures of segments: name, length classes (words from, below), quantile taken, and the threshold as times x quantile + plus,
#: no less than the last number: long segments may be stuffing for the greater part.
MEASURES = {
    "separators": ((4, 1 << 30), 2 / 3, 2.0, 0.2, 0.0),
    "links": ((4, 1 << 30), 2 / 3, 1.0, 0.1, 0.0),
    "digits": ((4, 1 << 30), 2 / 3, 1.0, 0.3, 0.0),
    "distinct": ((12, 40), 1 / 3, 0.55, 0.0, 0.4),
    "distinct of many": ((40, 1 << 30), 1 / 3, 0.5, 0.0, 0.3),
}
#: Bins of a measure between 0 and 1, and words of all languages together that are added to each language's histogram.
MEASURE_BINS, POOLED_WORDS = 50, 1000
#: Words of the n-grams looked for, how often a text must say one, how often the language's commonest word is too much, and
#: the share that is never too much.
NGRAM, SAID, TOP_TIMES, TOP_LEAST = 5, 6, 2.0, 0.12


class Segments:
    """Segments of a batch of texts, with what is measured on each."""

    def __init__(self, texts: list[str]):
        w = self.words = Words(texts, signs=True)
        kind = w.kind
        word = self.word = kind == WORD
        ends = np.concatenate(([False], (kind[:-1] == END) | (w.doc[1:] != w.doc[:-1]))) if len(kind) else np.zeros(0, bool)
        if len(ends):
            ends[0] = True
        first = self.first = np.flatnonzero(ends)
        seg = self.of = np.cumsum(ends) - 1
        self.doc = w.doc[first]
        n = self.n = _counts(word, first)
        per = self.per = np.maximum(n, 1)
        self.link, self.tag = _counts(kind == LINK, first), _counts(kind == TAG, first)
        order = np.lexsort((w.hash[word], seg[word]))
        h, s = w.hash[word][order], seg[word][order]
        fresh = np.concatenate(([True], (h[1:] != h[:-1]) | (s[1:] != s[:-1]))) if len(h) else np.zeros(0, bool)
        distinct = np.bincount(s[fresh], minlength=len(first)) / per
        self.measures = {"separators": _counts(kind == SEP, first) / per, "links": (self.link + self.tag) / per, "digits": _counts(w.digit, first) / per, "distinct": distinct, "distinct of many": distinct}

    def repeated_words(self) -> np.ndarray:
        """Words of each segment inside n-grams that their text says SAID times or more."""
        w = self.words
        at = np.flatnonzero(self.word)
        h, d = w.hash[at], w.doc[at]
        size = len(h) - NGRAM + 1
        covered = np.zeros(len(h), bool)
        if size > 0:
            code = np.zeros(size, np.uint64)
            with np.errstate(over="ignore"):
                for k in range(NGRAM):
                    code = code * np.uint64(0x9E3779B97F4A7C15) + h[k : k + size]
            inside = np.flatnonzero(d[:size] == d[NGRAM - 1 :])
            order = inside[np.lexsort((code[inside], d[inside]))]
            if len(order):
                c, e = code[order], d[order]
                new = np.flatnonzero(np.concatenate(([True], (c[1:] != c[:-1]) | (e[1:] != e[:-1]))))
                often = np.diff(np.concatenate((new, [len(c)])))
                hit = order[np.repeat(often >= SAID, often)]
                for k in range(NGRAM):
                    covered[hit + k] = True
        return np.bincount(self.of[at], weights=covered, minlength=len(self.first)).astype(np.int32)


def learned(docs: DataFrame, least_share: float = 0.2, most: int = 200) -> tuple[dict[str, np.ndarray], np.ndarray, dict[str, dict[str, float]]]:
    """Function words of each label, the words usual in labels that have any, and thresholds by label ("" for all together).

    Function words are the hashes of the words that occur in at least `least_share` of a label's documents, at most `most` of
    them; usual words those in at least a hundredth of that share. EMPTY_DOCS documents without words are added to each
    label, and POOLED_WORDS words of all labels to its histograms; no label is left out for its size.
    """

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            texts, langs = pdf["t"].tolist(), pdf["lang"].to_numpy()
            for a, b in slices(texts):
                x = Segments(texts[a:b])
                w = x.words
                label, code = np.unique(langs[a:b].astype(str), return_inverse=True)
                # a word counts once a document as `n`, as often as it occurs as `said`
                order = np.lexsort((w.hash, w.doc))
                order = order[x.word[order]]
                h, d = w.hash[order], w.doc[order]
                new = np.flatnonzero(np.concatenate(([True], (h[1:] != h[:-1]) | (d[1:] != d[:-1])))) if len(h) else np.zeros(0, int)
                said = np.diff(np.concatenate((new, [len(h)])))
                h, l = h[new], code[d[new]]
                order = np.lexsort((h, l))
                h, l, said = h[order], l[order], said[order]
                new = np.flatnonzero(np.concatenate(([True], (h[1:] != h[:-1]) | (l[1:] != l[:-1])))) if len(h) else np.zeros(0, int)
                n = np.diff(np.concatenate((new, [len(h)])))
                yield pd.DataFrame({"lang": label[l[new]], "kind": "word", "h": h[new].astype(np.int64), "n": n, "said": np.add.reduceat(said, new) if len(new) else n})
                size = np.bincount(code, minlength=len(label))
                yield pd.DataFrame({"lang": label, "kind": "docs", "h": np.zeros(len(label), np.int64), "n": size, "said": size})
                for name, ((low, high), *_) in MEASURES.items():
                    fits = (x.n >= low) & (x.n < high)
                    bins = np.minimum((x.measures[name][fits] * MEASURE_BINS).astype(np.int64), MEASURE_BINS)
                    mass = np.bincount(code[x.doc[fits]] * (MEASURE_BINS + 1) + bins, weights=x.n[fits])
                    at = np.flatnonzero(mass)
                    yield pd.DataFrame({"lang": label[at // (MEASURE_BINS + 1)], "kind": name, "h": at % (MEASURE_BINS + 1), "n": mass[at].astype(np.int64), "said": 0})

    labelled = docs.where("lang IS NOT NULL AND trim(lang) != ''").select("lang", "t")
    counts = materialize(labelled.mapInPandas(count, "lang string, kind string, h long, n long, said long").groupBy("lang", "kind", "h").agg(F.sum("n").alias("n"), F.sum("said").alias("said")), "word-counts")
    words = counts.where("kind = 'word'")
    totals = counts.where("kind = 'docs'").select("lang", F.col("n").alias("docs"))
    common = words.join(F.broadcast(totals), "lang").where(F.col("n") >= least_share * (F.col("docs") + EMPTY_DOCS))  # totals: one row a label
    best: dict[str, list[tuple[int, int]]] = {}
    for r in common.select("lang", "h", "n").collect():  # at most (mean distinct words of a document) / least_share a language
        best.setdefault(r["lang"], []).append((-r["n"], r["h"]))
    usual = words.where(F.col("lang").isin(list(best))).join(F.broadcast(totals), "lang").where((F.col("n") >= 2) & (F.col("n") >= least_share / 100 * F.col("docs")))
    known = usual.select("h").distinct().toPandas()["h"].to_numpy(dtype=np.int64)  # at most a hundred times the above
    shares = {r["lang"]: (r["top"] or 0) / max(1, r["all"] or 0) for r in words.groupBy("lang").agg(F.max("said").alias("top"), F.sum("said").alias("all")).collect()}  # one row a label
    tables: dict[tuple[str, str], np.ndarray] = {}
    for r in counts.where(~F.col("kind").isin("word", "docs")).collect():  # MEASURE_BINS rows a label and measure
        for lang in (r["lang"], ""):
            tables.setdefault((lang, r["kind"]), np.zeros(MEASURE_BINS + 1))[r["h"]] += r["n"]
    limits = {}
    for lang in ["", *sorted(best)]:
        told = limits[lang] = {"top": max(TOP_LEAST, TOP_TIMES * (shares.get(lang) or (max(shares.values()) if shares else 0.0)))}
        for name, (_, point, times, plus, least) in MEASURES.items():
            pooled = tables.get(("", name), np.zeros(MEASURE_BINS + 1))
            mass = tables.get((lang, name), np.zeros(MEASURE_BINS + 1)) + pooled * (POOLED_WORDS / max(1.0, pooled.sum()))
            usual_value = np.searchsorted(np.cumsum(mass), point * mass.sum()) / MEASURE_BINS if mass.sum() else 0.0
            told[name] = max(least, times * usual_value + plus)
    return {k: np.sort(np.array([h for _, h in sorted(v)[:most]], dtype=np.int64).view(np.uint64)) for k, v in sorted(best.items())}, np.sort(known.view(np.uint64)), limits


def _counts(value: np.ndarray, first: np.ndarray) -> np.ndarray:
    return np.add.reduceat(value.astype(np.int32), first) if len(first) else np.zeros(0, np.int32)


def segment_features(texts: list[str], table: np.ndarray, masks: np.ndarray, languages: int, vocabulary: np.ndarray, limits: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per text: words, words in each (language, bin of function-word share) of sentence-shaped segments, and the share of
    words of `vocabulary`. `limits` has a threshold for each language, and one for all at the end."""
    x = Segments(texts)
    w, word, first, doc, n, per = x.words, x.word, x.first, x.doc, x.n, x.per
    held = np.zeros((len(texts), languages, BINS), np.int32)
    if len(w.hash) == 0:
        return np.zeros(len(texts), np.int32), held, np.zeros(len(texts))
    total = np.bincount(doc, weights=n + LINK_WORDS * x.link + TAG_WORDS * x.tag, minlength=len(texts)).astype(np.int32)
    at = np.minimum(np.searchsorted(table, w.hash), max(0, len(table) - 1))
    mask = np.where(table[at] == w.hash, masks[at], 0) if len(table) else np.zeros(len(w.hash), np.int64)
    fw = np.stack([_counts((mask >> k) & 1, first) for k in range(languages)], axis=1) if languages else np.zeros((len(first), 1), np.int32)
    lang = fw.argmax(axis=1)
    share = fw.max(axis=1) / per
    limit = {k: v[np.where(fw.max(axis=1) > 0, lang, len(v) - 1)] for k, v in limits.items()}
    # repeated segments of a text
    with np.errstate(over="ignore"):
        whole = np.zeros(len(first), np.uint64)
        np.add.at(whole, x.of[word], w.hash[word])
    order = np.lexsort((whole, doc))
    a, b = whole[order], doc[order]
    new = np.flatnonzero(np.concatenate(([True], (a[1:] != a[:-1]) | (b[1:] != b[:-1]))))
    size = np.diff(np.concatenate((new, [len(a)])))
    repeated = np.zeros(len(first), np.int32)
    repeated[order] = np.repeat(size, size)
    # content words that fill a text
    content = word & (mask == 0) & ~w.digit
    order = np.lexsort((w.hash[content], w.doc[content]))
    h, d = w.hash[content][order], w.doc[content][order]
    stuffed = np.zeros(len(first), bool)
    if len(h):
        new = np.flatnonzero(np.concatenate(([True], (h[1:] != h[:-1]) | (d[1:] != d[:-1]))))
        size = np.diff(np.concatenate((new, [len(h)])))
        places = np.flatnonzero(content)[order]
        filled = np.zeros(len(w.hash))
        filled[places] = np.where(total[d] >= 30, np.repeat(size / np.maximum(total[d[new]], 1), size), 0.0)
        stuffed = np.maximum.reduceat(filled, first) > limit["top"]
    m = x.measures
    writing = (
        (n >= 4)
        & ((n < 12) | (n >= 40) | (m["distinct"] >= limit["distinct"]))
        & ((n < 40) | (m["distinct"] >= limit["distinct of many"]))
        & (m["separators"] <= limit["separators"])
        & (m["links"] <= limit["links"])
        & (m["digits"] <= limit["digits"])
        & ~((repeated >= 3) & (n <= 12))
        & (repeated < 6)
        & ~(stuffed & (n <= 8))
    )
    own = n - x.repeated_words()
    b = np.minimum((share * BINS).astype(int), BINS - 1)
    np.add.at(held, (doc[writing], lang[writing], b[writing]), own[writing])
    at = np.minimum(np.searchsorted(vocabulary, w.hash), max(0, len(vocabulary) - 1))
    familiar = word & (vocabulary[at] == w.hash) if len(vocabulary) else np.zeros(len(w.hash), bool)
    size = np.bincount(w.doc[word], minlength=len(texts))
    return total, held, np.bincount(w.doc[familiar], minlength=len(texts)) / np.maximum(size, 1)


def stuffing_shares(documents: DataFrame, least_share: float = 0.2) -> DataFrame:
    """(doc_id, words, writing, stuffed_share): how many words of a text are in segments of writing.

    Rows without id or text are left out; a text without words has stuffed_share NULL. Repeated rows of one id come out
    once each; whole texts count. Texts of a language without learnt function words (neither is their label one with, nor
    are half of their words usual in such a label) are judged by the other measures alone.
    """
    docs = spread(documents.where("doc_id IS NOT NULL AND text IS NOT NULL").select("doc_id", "lang", F.col("text").alias("t")))
    words, vocabulary, told = learned(docs, least_share)
    names = list(words)
    table = np.unique(np.concatenate([*words.values(), np.zeros(0, np.uint64)]))
    masks = np.zeros(len(table), np.int64)
    for k, name in enumerate(names):
        masks[np.searchsorted(table, words[name])] |= 1 << k
    languages = max(1, len(names))
    limits = {k: np.array([*[told[n][k] for n in names], told[""][k]]) for k in told[""]}
    shared = documents.sparkSession.sparkContext.broadcast((table, masks, languages, names, vocabulary, limits))

    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        table, masks, languages, names, vocabulary, limits = shared.value
        for pdf in batches:
            texts, ids, told = pdf["t"].tolist(), pdf["doc_id"].to_numpy(), pdf["lang"].isin(names).to_numpy()
            for a, b in slices(texts):
                total, held, familiar = segment_features(texts[a:b], table, masks, languages, vocabulary, limits)
                lang = held.sum(axis=2).argmax(axis=1)
                yield pd.DataFrame({"doc_id": ids[a:b], "words": total, "language": lang, "known": told[a:b] | (familiar >= 0.5), "bins": list(held.sum(axis=1))})

    features = materialize(docs.select("doc_id", "lang", "t").mapInPandas(measure, "doc_id long, words int, language int, known boolean, bins array<int>"), "stuffing-features")
    per_bin = features.where("known").groupBy("language").agg(*[F.sum(F.col("bins")[k].cast("long")).alias(f"b{k}") for k in range(BINS)])
    half_median = np.zeros(languages)
    for r in per_bin.collect():  # one row a language
        mass = np.array([r[f"b{k}"] or 0 for k in range(BINS)], dtype=float)
        if names and mass.sum():
            half_median[r["language"]] = (np.searchsorted(np.cumsum(mass), mass.sum() / 2) + 0.5) / BINS / 2
    floor = F.element_at(F.array(*[F.lit(int(x * BINS)) for x in half_median]), F.col("language") + 1)
    kept = F.aggregate(F.transform("bins", lambda x, i: F.when(~F.col("known") | (i >= floor), x).otherwise(0)), F.lit(0), lambda a, x: a + x)
    out = features.withColumn("writing", kept)
    return out.select("doc_id", "words", "writing", F.when(F.col("words") > 0, 1 - F.col("writing") / F.col("words")).alias("stuffed_share"))


def stuffed_documents(documents: DataFrame, most_writing: float = 0.25, least_words: int = 15) -> DataFrame:
    """(doc_id, words, writing, stuffed_share) of texts of `least_words` words or more that are writing to less than `most_writing`."""
    return stuffing_shares(documents).where((F.col("words") >= least_words) & (F.col("stuffed_share") > 1 - most_writing))
