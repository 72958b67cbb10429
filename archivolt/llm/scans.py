"""Noise in text from scanned pages: found, and repaired into continuous paragraphs.

Rare words are linked to words at least `ratio` times as frequent that plausible misreadings of glyphs lead from. Skip-gram
vectors are learned in closed form: of every word that is a link's end the words within two places are counted, in a random
sketch of DIMS numbers with frequent neighbours damped; centred on what any word has around it, these counts are what
skip-gram training with negative samples factorises, and their leading eigenvectors over all pages give the vectors (a
randomised singular value decomposition). Each occurrence of a rare word is then judged by the words around it: of its
readings the one with the greatest posterior, by frequency and by likelihood of the context under the reading's vector, is
taken. A form made of letters alone stays as it is where the context speaks against every reading by more than `ratio`, and
by more than it does in all but a hundredth of the forms that cannot be words, since those are misread for certain. Running headers are lines that several pages of a file
begin or end with, compared after collapsing glyphs that scans confuse; page numbers stand alone or beside them.

Scale: two map passes over the texts. Vocabulary, links, vectors and lines are tables; only tables of fixed size and DIMS
times DIMS sums are collected. A bit table of fixed size tells which words of a page can be misread at all, so that only
those are shuffled to the links.
"""

from __future__ import annotations

import bisect
import math
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from archivolt.session import materialize, spread

#: Signs and what they are misread from; then letter groups and what they are misread from.
SIGNS = {"@": "a", "!": "i", "0": "o", "1": "li", "5": "s", "9": "g", "†": "t", "|": "li", "6": "b"}
GLYPHS = [("rn", "m"), ("cl", "d"), ("ri", "n"), ("ii", "u"), ("li", "h"), ("vv", "w"), ("m", "in"), ("c", "e"), ("f", "e")]
MARKS = "-‐­¬"
DIMS = 32
CELLS, COUNT_CELLS = 1 << 23, 1 << 20
#: Words on either side that make a context, and the share of all words above which a neighbour is damped.
AROUND, COMMON = 2, 1e-3

_CUT = re.compile(rf"[{MARKS}](?:(?<=[^\W_].)\s+(?=[^\W\d_])|(?<=[­¬])(?=\w))", re.S)
_SMALL_L = re.compile("[A-ZÀ-Ý]l(?:[A-ZÀ-Ý]|$)|^l[A-ZÀ-Ý]{2}")
_EDGE = re.compile(r"^[^\w@†|]+|[^\w@†|]+$")


def plain_word(token: str) -> str:
    """A token without the punctuation around it, in lower case; a small l among capitals becomes a sign."""
    if "l" in token and _SMALL_L.search(token):
        token = token.replace("l", "|")
    return _EDGE.sub("", token).lower()


def cell(word: str) -> int:
    return zlib.crc32(word.encode("utf-8", "replace")) & (CELLS - 1)


def _signs(words: list[str]) -> np.ndarray:
    """A fixed random +-1 vector of each word."""
    seeds = np.array([zlib.crc32(w.encode("utf-8", "replace")) for w in words], dtype=np.uint64)
    bits = (seeds * np.uint64(0x9E3779B97F4A7C15)) ^ (seeds << np.uint64(29))
    bits = (bits ^ (bits >> np.uint64(31))) * np.uint64(0xD6E8FEB86659FD93)
    return (((bits[:, None] >> np.arange(DIMS, dtype=np.uint64)) & np.uint64(1)).astype(np.float32) * 2 - 1) if len(words) else np.zeros((0, DIMS), np.float32)


def vocabulary(texts: DataFrame) -> DataFrame:
    """(word, n): count of every word of the column `text`, cut words joined."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            code, raw = pd.factorize(np.array(" ".join(_CUT.sub("", t) for t in pdf["text"]).split(), dtype=object))
            kind, words = pd.factorize(np.array([plain_word(x) for x in raw], dtype=object))
            n = np.bincount(kind[code], minlength=len(words)) if len(words) else np.zeros(0, np.int64)
            out = pd.DataFrame({"word": words, "n": n})
            yield out[out["word"] != ""]

    return texts.select("text").mapInPandas(count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


#: What letters and signs look like that scans confuse: each group of GLYPHS and each sign comes out like what it is misread from.
_STROKES = str.maketrans({"@": "a", "!": "i", "0": "o", "1": "i", "5": "s", "9": "g", "†": "t", "|": "i", "6": "b", "l": "i", "r": "i", "n": "ii", "u": "ii", "h": "ii", "m": "iii", "d": "ci", "w": "vv", "e": "c", "f": "c"})


def strokes(word: str) -> str:
    """A key that a word and all its misreadings share."""
    return word.translate(_STROKES)


def glyph_edits(wrong: str, right: str) -> int | None:
    """Fewest groups of letters to undo on the way from `wrong` to `right`, signs not counted; None if there is no way."""
    same = lambda x, y: x == y or y in SIGNS.get(x, "")
    best = {(0, 0): 0}
    for i in range(len(wrong) + 1):
        for j in range(len(right) + 1):
            now = best.get((i, j))
            if now is None:
                continue
            if i < len(wrong) and j < len(right) and same(wrong[i], right[j]):
                best[i + 1, j + 1] = min(now, best.get((i + 1, j + 1), now))
            for a, b in GLYPHS:
                part = wrong[i : i + len(a)]
                if len(part) == len(a) and right.startswith(b, j) and all(map(same, part, a)):
                    best[i + len(a), j + len(b)] = min(now + 1, best.get((i + len(a), j + len(b)), now + 1))
    return best.get((len(wrong), len(right)))


def links(vocab: DataFrame, ratio: int = 8, least: int = 5, most_edits: int = 2) -> DataFrame:
    """(wrong, right, n, right_n, odd, readings): rare words and the frequent ones they can be misreadings of, all of them.

    `odd`: the form holds a sign inside a word, so that it is none itself; `readings`: how many the form has.
    """

    def key(word: pd.Series) -> pd.Series:
        return word.map(strokes)

    def edits(wrong: pd.Series, right: pd.Series) -> pd.Series:
        return pd.Series([glyph_edits(a, b) for a, b in zip(wrong, right)], dtype="Int32")

    v = vocab.where(F.length("word") >= 2).withColumn("key", F.pandas_udf(key, "string")("word"))
    frequent = v.where((F.col("n") >= least) & F.col("word").rlike(r"^(?:\p{L}|[-’])+$")).select("key", F.col("word").alias("right"), F.col("n").alias("right_n"))
    rare = v.where((F.length("word") >= 3) & F.col("word").rlike(r"\p{L}")).select("key", F.col("word").alias("wrong"), "n")
    pairs = rare.join(frequent, "key").where((F.col("right_n") >= ratio * F.col("n")) & (F.col("wrong") != F.col("right")))
    kept = pairs.withColumn("edits", F.pandas_udf(edits, "int")("wrong", "right")).where(F.col("edits") <= most_edits)
    many = kept.groupBy("wrong").agg(F.count(F.lit(1)).alias("readings"))
    return kept.join(many, "wrong").select("wrong", "right", "n", "right_n", F.col("wrong").rlike(r"[@!†|]|\p{L}[0-9]|[0-9]\p{L}").alias("odd"), "readings")


class Vectors:
    """The closed form: leading eigenvectors of the centred context counts, and the noise of a single context."""

    def __init__(self, total: float, first: np.ndarray, between: np.ndarray, within: float):
        self.mean = first / max(total, 1.0)
        spread_ = between / max(total, 1.0) - np.outer(self.mean, self.mean)
        value, vector = np.linalg.eigh(spread_)
        self.noise = max((within - float(np.trace(spread_)) - float(self.mean @ self.mean)) / DIMS, 1e-6)
        kept = value > max(1e-9, 1e-3 * float(value.max(initial=0.0)))
        self.project = vector[:, kept] @ vector[:, kept].T
        self.few = self.noise * DIMS / max(float(value[kept].sum()), 1e-9)

    def of(self, n: np.ndarray, total: np.ndarray) -> np.ndarray:
        """Vectors of words: the mean context less the common one, drawn to 0 where a word is seldom seen."""
        x = total / np.maximum(n, 1)[:, None] - self.mean
        return (x @ self.project) * (n / (n + self.few))[:, None]


_ROMAN = r"(?=[ivxlc])c{0,3}(?:xc|xl|l?x{0,3})(?:ix|iv|v?i{0,3})"
#: A printed number alone must hold a digit or be a Roman numeral; between dashes or brackets misread signs may be all of it.
_PLAIN = rf"(?:[0-9lOoI|!@]{{0,3}}[0-9][0-9lOoI|!@]{{0,3}}|{_ROMAN}|{_ROMAN.upper()})"
_NUMBER = rf"(?:{_PLAIN}|[ivxlcdm]{{1,7}}|[lOoI|!]{{1,3}})"
_DRESSED = re.compile(rf"^\s*(?:[-–—·]\s*{_NUMBER}\s*[-–—·]|\[\s*{_NUMBER}\s*\]|\(\s*{_NUMBER}\s*\)|(?:[Pp](?:age|a9e|@ge|\.)|[Ss]eite|[Pp]ágina|[Pp]agina)\s*{_NUMBER}\.?)\s*$")
_BARE = re.compile(rf"^\s*{_PLAIN}\s*\.?\s*$")
_BESIDE = re.compile(rf"^\s*(?P<a>\S.*?)\s{{2,}}(?P<b>\S.*?)\s*$")
_INLINE = re.compile(r"(?:^|(?<=\s))(?:[-–—·] ?(?:[0-9lOI]{0,3}[0-9][0-9lOI]{0,2}|[ivxlc]{1,7}) ?[-–—·]|\[ ?(?:[0-9lOI]{0,3}[0-9][0-9lOI]{0,2}|[ivxlc]{1,7}) ?\]|\( ?(?:[0-9lOI]{0,2}[0-9][0-9lOI]?|[ivxlc]{1,7}) ?\)|(?:p\.|[Pp]age) ?(?:[0-9lOI]{0,3}[0-9][0-9lOI]{0,2}|[ivxlc]{1,7})(?: ?\|)?)(?=\s|$)")
_STOPS = tuple(".!?؟。…”\"»")
#: Signs and letters that scans confuse with one another, first one by one, then in groups, then what groups look like.
_ALIKE = str.maketrans({"@": "a", "!": "i", "0": "o", "1": "i", "5": "s", "9": "g", "†": "t", "|": "i", "6": "b", "l": "i", "f": "e"})
_GROUPS = [("rn", "n"), ("ci", "n"), ("vv", "w"), ("in", "n"), ("ri", "n"), ("ii", "u")]
_FINAL = str.maketrans({"c": "e", "m": "n", "d": "n", "h": "u"})


def collapsed(line: str) -> str:
    """Letters of a line with those equal that scans confuse."""
    t = line.lower().translate(_ALIKE)
    for group, one in _GROUPS:
        t = t.replace(group, one)
    return "".join(c for c in t.translate(_FINAL) if c.isalpha())


def in_capitals(line: str) -> bool:
    """Whether a line is set in capitals, a misread small l aside."""
    words = [w for w in re.findall(r"[^\W\d_]+", line) if len(w) > 1]
    return len(words) >= 2 and sum(w.replace("l", "I").isupper() for w in words) >= 0.7 * len(words)


def is_number(part: str) -> bool:
    return bool(_DRESSED.match(part) or _BARE.match(part))


def page_furniture(text: str) -> tuple[list[int], list[tuple[int, str]], bool, bool]:
    """(lines that are furniture for sure, (line, collapsed) that may be headers, header beside a number, page number)."""
    lines = text.split("\n")
    full = [i for i, x in enumerate(lines) if x.strip()]
    sure: list[int] = []
    maybe: list[tuple[int, str]] = []
    header = number = False
    lengths = sorted(len(lines[i].strip()) for i in full)
    for order in (full, full[::-1]):
        counted = False  # one page number an edge
        for depth, i in enumerate(order):
            line = lines[i].strip()
            longest = lengths[-2] if len(lengths) > 1 and len(line) == lengths[-1] else lengths[-1]
            if i in sure or line.startswith(("#", "- ", "| ")) and not _DRESSED.match(line):
                break
            beside = _BESIDE.match(line)
            if beside and not counted and (is_number(beside["a"]) != is_number(beside["b"])):
                sure.append(i)
                header = number = counted = True
                continue
            if not counted and _DRESSED.match(line):
                sure.append(i)
                number = counted = True
                continue
            if _BARE.match(line):
                before = lines[i - 1].strip() if i else ""
                year = re.match(r"^1[5-9]\d\d|^20[0-4]\d", line)
                # the end of a paragraph may be a number too: it goes on from a line, or a page, that has not ended
                alone = not line.endswith(".") and (line.isdigit() and len(line) <= 3 or len(line) >= 2 and not line[0].isdigit())
                if not counted and not year and (not before or alone or before.endswith(_STOPS)):
                    sure.append(i)
                    number = counted = True
                    continue
            elif len(line) <= longest and in_capitals(line):
                sure.append(i)
                header = True
                continue
            elif not (line.endswith(_STOPS[:6]) and depth) and any(c.isalpha() for c in line):
                maybe.append((i, collapsed(line)))
            break
    return sure, maybe, header, number


_MARK = re.compile(rf"[{MARKS}](?:\s+|(?<=[­¬])(?=\w))")
_AFTER = re.compile(r"[^\W\d_]+")


def cut_words(text: str, compounds: np.ndarray) -> list[tuple[int, int]]:
    """(begin, end) of the break marks, with the space behind, that cut a word; hyphens of compounds are left alone."""
    out = []
    for m in _MARK.finditer(text):
        mark = text[m.start()]
        if m.end() == m.start() + 1:
            out.append(m.span())
            continue
        start = m.start()
        while start and text[start - 1].isalpha():
            start -= 1
        right = _AFTER.match(text, m.end())
        if start == m.start() or right is None:
            continue
        left, right = text[start : m.start()], right.group()
        if mark in "­¬" or not right[0].isupper() and not (compounds[cell(f"{left}-{right}".lower())]):
            out.append(m.span())
    return out


def inline_header(text: str, titles: list[str]) -> tuple[int, int] | None:
    """(begin, end) of a title, or of a run of capitals, inside an excerpt."""
    runs = [m for m in re.finditer(r"(?:(?:[^\W\d_a-zà-ÿ][^\W\d_a-zà-ÿ’'”“\".:,]*|\d{4}|[–—:&’“”\"]+|[^\W\d_a-zà-ÿ]+[’'][^\W\d_a-zà-ÿ]+[.:,]?)[,:.”\"]?\s+){2,}[^\W\d_a-zà-ÿ]{2,}[^\s]*", text) if len([w for w in m.group().split() if w.upper() != w.lower() and len(w) > 1 and w == w.upper()]) >= 2]
    if runs:
        return runs[0].span()
    flat, where = [], []
    for i, c in enumerate(text):
        if c.isalpha():
            flat.append(c.lower())
            where.append(i)
    joined = "".join(flat)
    for t in titles:
        key = "".join(c.lower() for c in t if c.isalpha())
        chunks = [key] + [x for x in re.findall("[a-z]{14,}", re.sub(r"[^a-z]", "|", re.sub(r"[\s\W\d_]", "", t.lower())))]
        if len(t.split()) < 3 and len(key) < 12:
            continue
        for k in chunks:
            at = joined.find(k) if len(k) >= 8 else -1
            if at >= 0:
                return where[at], where[at + len(k) - 1] + 1
    return None


def sources(pdf_quality: DataFrame, md_texts: DataFrame) -> DataFrame:
    """(table_name, record_key, page_no, text, titles) of all excerpts and Markdown pages, exact repeats once.

    The latest scored row of a url gives its excerpt. Rows without key or text are left out.
    """
    newest = pdf_quality.where("url IS NOT NULL").groupBy("url").agg(F.max(F.struct("scored_at", "excerpt", "pdf_title", "ai_title")).alias("r"))
    excerpts = newest.select(F.lit("pdf_quality").alias("table_name"), F.col("url").alias("record_key"), F.lit(0).alias("page_no"), F.col("r.excerpt").alias("text"), F.array_compact(F.array("r.pdf_title", "r.ai_title")).alias("titles"))
    files = md_texts.select(F.lit("md_texts").alias("table_name"), F.col("md_path").alias("record_key"), F.coalesce("page_no", F.lit(1)).cast("int").alias("page_no"), F.col("md_text").alias("text"))
    files = files.groupBy("table_name", "record_key", "page_no").agg(F.max("text").alias("text"))  # of two texts of a page the greater
    files = files.withColumn("titles", F.array().cast("array<string>"))
    return excerpts.unionByName(files).where("record_key IS NOT NULL AND text IS NOT NULL AND trim(text) != ''")


class ScanNoise:
    """Everything learned of one corpus, and what follows from it."""

    def __init__(self, pdf_quality: DataFrame, md_texts: DataFrame, least_pages: int = 2, ratio: int = 8):
        self.texts = spread(materialize(sources(pdf_quality, md_texts), "scan-texts"))
        self.least_pages, self.ratio = least_pages, ratio
        spark = self.spark = pdf_quality.sparkSession
        vocab = materialize(vocabulary(self.texts), "scan-vocabulary")
        self.links = materialize(links(vocab, ratio), "misread-links")
        open_ = self.links.where("readings > 1 OR NOT odd")
        suspect = self._bits(self.links.select(F.col("wrong").alias("word")))
        judged = self._bits(open_.select(F.col("right").alias("word")).unionByName(open_.select(F.col("wrong").alias("word"))))
        hyphened = vocab.where(F.col("word").contains("-") & (F.col("n") >= 3)).select("word", "n", F.regexp_replace("word", "-", "").alias("joined"))
        joined = vocab.select(F.col("word").alias("joined"), F.col("n").alias("joined_n"))
        compounds = self._bits(hyphened.join(joined, "joined", "left").where("joined_n IS NULL OR n >= joined_n").select("word"))
        self.shared = spark.sparkContext.broadcast((suspect, judged, compounds, self._weights(vocab)))
        self.seen = materialize(self.observed(), "scan-observations")
        self.verdicts = materialize(self.judged(), "misread-words")

    @staticmethod
    def _cell(modulus: int) -> Column:
        return F.expr(f"int(crc32(encode(word, 'UTF-8')) & {modulus - 1})").alias("cell")

    @classmethod
    def _bits(cls, words: DataFrame) -> np.ndarray:
        """A table of CELLS truth values with the cells of the words set; at most CELLS numbers come to the driver."""
        cells = words.select(cls._cell(CELLS)).distinct().toPandas()
        table = np.zeros(CELLS, dtype=bool)
        table[cells["cell"].to_numpy(dtype=np.int64)] = True
        return table

    @classmethod
    def _weights(cls, vocab: DataFrame) -> np.ndarray:
        """Of each of COUNT_CELLS cells of words what a neighbour from it weighs: less than 1 for the common ones only, so
        that only their cells come to the driver, under 1 / COMMON of them."""
        total = vocab.agg(F.sum("n")).first()[0] or 1
        common = vocab.groupBy(cls._cell(COUNT_CELLS)).agg(F.sum("n").alias("n")).where(F.col("n") > COMMON * total).toPandas()
        table = np.ones(COUNT_CELLS, dtype=np.float16)
        table[common["cell"].to_numpy(dtype=np.int64)] = np.sqrt(COMMON * total / common["n"].to_numpy(dtype=float))
        return table

    def observed(self) -> DataFrame:
        """Rows of two sorts. Of a text: kinds seen in it alone, collapsed lines that may be headers, and the places, forms
        and contexts of words that may be misread. Of a judged word (`word` is given): how often it was seen in a batch, and
        the sum and the summed squares of its contexts."""
        shared = self.shared
        columns = [f"v{d}" for d in range(DIMS)]

        def look(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            suspect, judged, compounds, weights = shared.value
            for pdf in batches:
                out, sums = [], []
                for a in range(0, len(pdf), 2000):
                    part = pdf.iloc[a : a + 2000]
                    plain = [_CUT.sub("", t) for t in part["text"]]
                    tokens = [p.split() for p in plain]
                    code, raw = pd.factorize(np.array([x for t in tokens for x in (*t, "", "")], dtype=object))
                    kind, words = pd.factorize(np.array([plain_word(x) for x in raw], dtype=object))
                    at = kind[code]
                    crc = np.array([zlib.crc32(w.encode("utf-8", "replace")) for w in words], dtype=np.int64)
                    real = np.array([w != "" for w in words], dtype=bool)
                    odd, wanted = suspect[crc & (CELLS - 1)] & real, judged[crc & (CELLS - 1)] & real
                    sign = _signs(list(words)) * np.where(real, weights[crc & (COUNT_CELLS - 1)], 0).astype(np.float32)[:, None]
                    context: dict[int, np.ndarray] = {}
                    places = np.flatnonzero((wanted | odd)[at])
                    for b in range(0, len(places), 50_000):
                        p = places[b : b + 50_000]
                        total = np.zeros((len(p), DIMS), np.float32)
                        for step in range(1, AROUND + 1):
                            total += sign[at[np.maximum(p - step, 0)]] + sign[at[np.minimum(p + step, len(at) - 1)]]
                        free = odd[at[p]]
                        context.update(zip(p[free].tolist(), total[free]))
                        use = wanted[at[p]]
                        w, inner = np.unique(at[p[use]], return_inverse=True)
                        if len(w):
                            by = np.argsort(inner, kind="stable")
                            first = np.searchsorted(inner[by], np.arange(len(w)))
                            data = {"word": words[w], "n": np.bincount(inner), "squares": np.bincount(inner, weights=(total[use] ** 2).sum(axis=1))}
                            sums.append(pd.DataFrame(data | dict(zip(columns, np.add.reduceat(total[use][by], first).T))))
                    start = np.cumsum([0] + [len(t) + 2 for t in tokens])
                    marked = odd[at]
                    for k, (table, key, page, text, titles) in enumerate(zip(part["table_name"], part["record_key"], part["page_no"], part["text"], part["titles"])):
                        kinds, lines = [], []
                        body = text
                        if table == "md_texts":
                            sure, maybe, header, number = page_furniture(text)
                            lines = [x for _, x in maybe]
                            kinds += ["header"] * header + ["page_number"] * number
                            if sure:
                                body = "\n".join(x for i, x in enumerate(text.split("\n")) if i not in sure)
                            tail = body.rstrip()
                            if len(tail) > 1 and tail[-1] in MARKS and tail[-2].isalpha():
                                kinds.append("hyphen")
                        else:
                            edge = text.strip().split("\n")
                            if _INLINE.search(text) or (len(edge) > 1 and (is_number(edge[-1]) or is_number(edge[0]))):
                                kinds.append("page_number")
                            if inline_header(text, list(titles)):
                                kinds.append("header")
                        if "hyphen" not in kinds and cut_words(body, compounds):
                            kinds.append("hyphen")
                        mine = np.flatnonzero(marked[start[k] : start[k + 1]])
                        found = places_of(text, plain[k], mine) if len(mine) else []
                        forms = [words[at[start[k] + i]] for i in mine]
                        out.append((table, key, page, kinds, lines, forms, [x[0] for x in found], [x[1] for x in found], [context[int(start[k] + i)] for i in mine]))
                yield pd.DataFrame(out, columns=["table_name", "record_key", "page_no", "kinds", "lines", "forms", "begins", "ends", "contexts"])
                if sums:
                    yield pd.concat(sums).groupby("word", sort=False).sum().reset_index()

        def shaped(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for pdf in look(batches):
                for c in names:
                    if c not in pdf:
                        pdf[c] = pd.Series([None] * len(pdf), dtype=object)
                yield pdf[names]

        shape = "table_name string, record_key string, page_no int, kinds array<string>, lines array<string>, forms array<string>, begins array<int>, ends array<int>, contexts array<array<float>>, word string, n long, squares double, " + ", ".join(f"v{d} float" for d in range(DIMS))
        names = [x.split()[0] for x in shape.split(", ")]
        return self.texts.mapInPandas(shaped, shape)

    def vectors(self) -> DataFrame:
        """(right, vector): of every reading that a context decides on; DIMS x DIMS sums over all words come to the driver."""
        columns = [f"v{d}" for d in range(DIMS)]
        sums = materialize(self.seen.where("word IS NOT NULL").groupBy("word").agg(F.sum("n").alias("n"), F.sum("squares").alias("squares"), *[F.sum(c).alias(c) for c in columns]), "context-sums")

        def moments(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            total = np.zeros(2 + DIMS + DIMS * DIMS)
            for pdf in batches:
                x, n = pdf[columns].to_numpy(dtype=float), pdf["n"].to_numpy(dtype=float)
                total += np.concatenate(([n.sum(), pdf["squares"].sum()], x.sum(axis=0), ((x / np.maximum(n, 1)[:, None]).T @ x).ravel()))
            yield pd.DataFrame({"i": np.arange(len(total)), "x": total})

        m = sums.mapInPandas(moments, "i int, x double").groupBy("i").agg(F.sum("x").alias("x")).orderBy("i").toPandas()["x"].to_numpy(dtype=float)
        if len(m) == 0:
            m = np.zeros(2 + DIMS + DIMS * DIMS)
        self.model = Vectors(m[0], m[2 : 2 + DIMS], m[2 + DIMS :].reshape(DIMS, DIMS), m[1] / max(m[0], 1.0))
        shared = self.spark.sparkContext.broadcast(self.model)

        def make(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            for pdf in batches:
                v = shared.value.of(pdf["n"].to_numpy(dtype=float), pdf[columns].to_numpy(dtype=float))
                yield pd.DataFrame({"right": pdf["word"], "vector": list(v.astype(np.float32))})

        return sums.mapInPandas(make, "right string, vector array<float>")

    def judged(self) -> DataFrame:
        """(table_name, record_key, page_no, begin, end, wrong, right, gain): occurrences found misread, with the word meant.

        `gain` is the log-likelihood of the context under the reading's vector against any word's.
        """
        keys = ["table_name", "record_key", "page_no"]
        each = self.seen.where("word IS NULL AND size(forms) > 0").select(*keys, F.explode(F.arrays_zip("forms", "begins", "ends", "contexts")).alias("o"))
        each = each.select(*keys, F.col("o.forms").alias("wrong"), F.col("o.begins").alias("begin"), F.col("o.ends").alias("end"), F.col("o.contexts").alias("context"))
        vectors = self.vectors()
        mean, noise = F.array(*[F.lit(float(x)) for x in self.model.mean]), self.model.noise
        pairs = each.join(self.links.select("wrong", "right", "right_n", "odd"), "wrong").join(vectors, "right", "left")
        centred = F.zip_with("context", mean, lambda a, b: a - b)
        terms = F.zip_with(centred, "vector", lambda c, v: (c * v - v * v / 2) / noise)
        told = pairs.withColumn("gain", F.coalesce(F.aggregate(terms, F.lit(0.0), lambda s, z: s + z), F.lit(0.0)))
        best = told.groupBy(*keys, "begin", "wrong", "odd").agg(F.max(F.struct((F.log("right_n") + F.col("gain")).alias("posterior"), "right", "end", "gain")).alias("m"))
        best = materialize(best.select(*keys, "begin", "m.end", "wrong", "m.right", "odd", "m.gain"), "misread-candidates")
        least = best.where("odd").agg(F.percentile_approx("gain", 0.01, 10_000)).first()[0]
        self.least_gain = min(-math.log(self.ratio), least if least is not None else 0.0)
        return best.where(F.col("odd") | (F.col("gain") >= self.least_gain)).drop("odd")

    def _headers(self) -> DataFrame:
        keys = ["table_name", "record_key", "page_no"]
        lines = self.seen.where("word IS NULL").select(*keys, F.explode("lines").alias("line"))
        repeated = lines.groupBy("record_key", "line").agg(F.count_distinct("page_no").alias("pages")).where(F.col("pages") >= self.least_pages)
        return lines.join(repeated, ["record_key", "line"], "left_semi")

    def found(self) -> DataFrame:
        """(table_name, record_key, page_no, kind): one row per kind of noise in a text."""
        keys = ["table_name", "record_key", "page_no"]
        own = self.seen.where("word IS NULL").select(*keys, F.explode("kinds").alias("kind"))
        return own.unionByName(self.verdicts.select(*keys, F.lit("misread").alias("kind"))).unionByName(self._headers().select(*keys, F.lit("header").alias("kind"))).distinct()

    def repaired(self) -> DataFrame:
        """(table_name, record_key, text): each excerpt and each file in continuous paragraphs."""
        keys = ["table_name", "record_key", "page_no"]
        fixes = self.verdicts.groupBy(*keys).agg(F.collect_list(F.struct("begin", "end", "right")).alias("fixes"))  # one text's words
        headers = self._headers().groupBy(*keys).agg(F.collect_set("line").alias("headers"))
        rows = self.texts.join(fixes, keys, "left").join(headers, keys, "left")
        shared = self.shared

        def mend(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
            compounds = shared.value[2]
            for pdf in batches:
                texts = [
                    mended(table, text, list(titles), [(f["begin"], f["end"], f["right"]) for f in fix] if fix is not None else [], set(head) if head is not None else set(), compounds)
                    for table, text, titles, fix, head in zip(pdf["table_name"], pdf["text"], pdf["titles"], pdf["fixes"], pdf["headers"])
                ]
                yield pd.DataFrame({"table_name": pdf["table_name"], "record_key": pdf["record_key"], "page_no": pdf["page_no"], "text": texts})

        pages = rows.mapInPandas(mend, "table_name string, record_key string, page_no int, text string")
        whole = pages.groupBy("table_name", "record_key").agg(F.array_sort(F.collect_list(F.struct("page_no", "text"))).alias("p"))  # the pages of one file
        return whole.select("table_name", "record_key", across_pages(F.array_join(F.transform("p", lambda x: x["text"]), "\f")).alias("text"))


def places_of(text: str, plain: str, at: np.ndarray) -> list[tuple[int, int]]:
    """(begin, end) in `text` of the tokens number `at` of `plain`, the text with its cut words joined."""
    gone = [m.span() for m in _CUT.finditer(text)] if len(plain) < len(text) else []
    edge = [a - sum(y - x for x, y in gone[:i]) for i, (a, _) in enumerate(gone)]  # where a cut was, in `plain`
    wanted, out = set(at.tolist()), []
    for i, m in enumerate(re.finditer(r"\S+", plain)):
        if i in wanted:
            far = lambda p, after: p + sum(y - x for x, y in gone[: bisect.bisect_right(edge, p) if after else bisect.bisect_left(edge, p)])
            out.append((far(m.start(), True), far(m.end(), False)))
    return out


def across_pages(text: Column) -> Column:
    """Pages joined: words cut by the page end, then sentences that run on, else a new paragraph."""
    t = F.regexp_replace(text, rf"(?<=\p{{L}})[{MARKS}]\s*\f\s*(?=\p{{Ll}})", "")
    t = F.regexp_replace(t, r"(?<=[^.!?؟。…”\"»\s|])\s*\f\s*(?![#|\-\s])", " ")
    return F.trim(F.regexp_replace(t, r"\s*\f\s*", "\n\n"))


def put_right(token: str, right: str) -> str:
    """A token with its word replaced, the case and the punctuation around it kept."""
    word = _EDGE.sub("", _CUT.sub("", token))
    joined = _CUT.sub("", token)
    at = joined.find(word)
    new = right.upper() if word.isupper() and len(word) > 2 else right.capitalize() if word[:1].isupper() or (not word[:1].isalpha() and right[:1].isupper()) else right
    return joined[:at] + new + joined[at + len(word) :]


def mended(table: str, text: str, titles: list[str], fixes: list[tuple[int, int, str]], headers: set[str], compounds: np.ndarray) -> str:
    """One page or excerpt without furniture and cut words, misread words replaced, lines flowed into paragraphs."""
    edits = []
    if table == "md_texts":
        sure, maybe, _, _ = page_furniture(text)
        gone = set(sure) | {i for i, x in maybe if x in headers}
        at = 0
        for i, line in enumerate(text.split("\n")):
            if i in gone:
                edits.append((at, min(len(text), at + len(line) + 1), ""))
            at += len(line) + 1
    else:
        span = inline_header(text, titles)
        if span:
            edits.append((*span, " "))
    free = [f for f in fixes if not any(a < f[1] and f[0] < b for a, b, _ in edits)]
    for a, b, new in sorted([*edits, *((a, b, put_right(text[a:b], right)) for a, b, right in free)], reverse=True):
        text = text[:a] + new + text[b:]
    if table != "md_texts":
        text = _INLINE.sub(" ", text)
    for a, b in reversed(cut_words(text, compounds)):
        text = text[:a] + text[b:]
    blocks = []
    for block in re.split(r"\n\s*\n", text):
        rows = [r.strip() for r in block.split("\n") if r.strip()]
        flow: list[str] = []
        for r in rows:
            if flow and not r.startswith(("- ", "|", "#")) and not flow[-1].startswith(("|", "#")):
                flow[-1] += " " + r
            else:
                flow.append(r)
        if flow:
            blocks.append("\n".join(flow))
    return re.sub(r"[ \t]{2,}", " ", "\n\n".join(blocks)).strip()


