"""Folding and hashing the words of whole texts.

Windows over all words of a text have no built-in form that avoids interpreting a lambda per word, so batches of texts go
to Python once, and numpy does the rest: a table maps every code point to its class and folded letter, and all words of
a batch are hashed in one pass, without a Python step per word. `folded` is the same folding as built-in expressions, for
short texts that stay in the JVM.
"""

from __future__ import annotations

import functools
import re
import unicodedata

import numpy as np
from pyspark.sql import Column, functions as F

GAP, WORD, SINGLE, LINK, TAG, END, SEP, BREAK, DROP = range(9)
_LINK_SIGN, _TAG_SIGN = "", ""
_ENDS, _ALWAYS_ENDS, _SEPS, _CLOSING = ".!?؟…", "。！？", ",;|/·•،、", "\"”»’)]"


def _base(cp: int) -> int:
    """The lower-case letter without marks that a code point folds to."""
    c = chr(cp).lower()
    d = unicodedata.normalize("NFD", c[0])
    return ord(d[0]) if len(d) > 1 and all(unicodedata.combining(x) for x in d[1:]) else ord(c[0])


@functools.cache
def _tables() -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Class, folded code point and case (1 lower, 2 upper) of every code point."""
    kind = np.zeros(0x110000, dtype=np.uint8)
    fold = np.arange(0x110000, dtype=np.uint32)
    case = np.zeros(0x110000, dtype=np.uint8)
    for cp in (*range(0x32000), *range(0xE0000, 0xE0200)):  # no letters or marks beyond
        cat = unicodedata.category(chr(cp))
        if cat[0] == "L" or cat[0] == "N":
            kind[cp] = WORD
            if cat == "Ll":
                case[cp] = 1
            elif cat == "Lu":
                case[cp] = 2
        elif cat[0] == "M" or cat == "Cf":
            kind[cp] = DROP
    for cp in range(0x3000):
        if kind[cp] == WORD:
            fold[cp] = _base(cp)
    for a, z in ((0x3040, 0x3100), (0x3400, 0x4DC0), (0x4E00, 0xA000), (0x20000, 0x32000)):
        kind[a:z][kind[a:z] == WORD] = SINGLE
    for c in "*_`~":
        kind[ord(c)] = DROP
    kind[ord(_LINK_SIGN)], kind[ord(_TAG_SIGN)], kind[2] = LINK, TAG, BREAK
    return kind, fold, case


_ANCHOR = re.compile(r"<a\b[^<>]*>|\]\([^()\s]*\)|(?:https?://|www\.)[^\s<>\"]+")
_MARKUP = re.compile(r"<[/!a-zA-Z][^<>]*>|&(?:[a-zA-Z]{2,8}|#\d{1,6}|#x[0-9a-fA-F]{1,5});")
_HYPHEN = re.compile(r"(?<=[^\W\d_])[-‐‑]\s*(?=[^\W\d_])")
_HASHTAG = re.compile(r"#(?=[^\W\d_])")


def _plain(t: str, signs: bool) -> str:
    if signs:
        if "<a" in t or "](" in t or "http" in t or "www." in t:
            t = _ANCHOR.sub(f" {_LINK_SIGN} ", t)
        if "#" in t:
            t = _HASHTAG.sub(f" {_TAG_SIGN} ", t)
    if "<" in t or "&" in t:
        t = _MARKUP.sub(" ", t)
    if "\x02" in t:
        t = t.replace("\x02", " ")
    return t


_POW = np.ones(4096, dtype=np.uint64)
with np.errstate(over="ignore"):
    for _i in range(1, 4096):
        _POW[_i] = _POW[_i - 1] * np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xD6E8FEB86659FD93)


def mix(h: np.ndarray) -> np.ndarray:
    """Finalise 64-bit hashes."""
    with np.errstate(over="ignore"):
        h = (h ^ (h >> np.uint64(32))) * _MIX
        h = (h ^ (h >> np.uint64(32))) * _MIX
    return h ^ (h >> np.uint64(32))


class Words:
    """All words of a batch of texts: `hash` of the folded word, `doc` (place in the batch), `kind`, `digit`, `capital`, `caseless`.

    Folded means lower-case, without accents, punctuation, markup and hyphenation; Han characters and kana are words of
    their own. `capital`: begins with a capital inside a sentence; `caseless`: of a
    script without capitals. With `signs`, links, tags, sentence ends and
    separators are tokens of their own kind as well.
    """

    def __init__(self, texts: list[str], signs: bool = False):
        kinds, fold, case = _tables()
        joined = _HYPHEN.sub("", "\x02".join(_plain(t, signs) for t in texts))
        code = np.frombuffer(joined.encode("utf-32-le", "replace"), dtype=np.uint32)
        kind = kinds[code]
        if signs:
            kind = self._mark(code, kind)
        keep = kind != DROP
        code, kind = code[keep], kind[keep]
        word = kind == WORD
        starts = (word & ~np.concatenate(([False], word[:-1]))) | ((kind >= SINGLE) & (kind <= SEP))
        start = np.flatnonzero(starts)
        self.doc = np.searchsorted(np.flatnonzero(kind == BREAK), start, side="left").astype(np.int32)
        self.kind = np.where(kind[start] == SINGLE, WORD, kind[start]).astype(np.uint8) if len(start) else np.zeros(0, np.uint8)
        if len(start) == 0:
            self.hash = np.zeros(0, dtype=np.uint64)
            self.digit = self.capital = self.caseless = np.zeros(0, dtype=bool)
            return
        solid = word | ((kind >= SINGLE) & (kind <= SEP))
        first = np.zeros(len(code), dtype=np.int64)
        first[start] = start
        offset = np.minimum(np.arange(len(code), dtype=np.int64) - np.maximum.accumulate(first), 4095)
        weight = np.where(solid, (fold[code].astype(np.uint64) + np.uint64(1)) * _POW[offset], np.uint64(0))
        self.hash = mix(np.add.reduceat(weight, start))
        c = code[start]
        self.digit = (c >= 0x30) & (c <= 0x39)
        self.caseless = (case[c] == 0) & ~self.digit
        after = np.minimum(start + 1, len(code) - 1)
        before = np.maximum(start - 2, 0)
        calm = (case[code[before]] == 1) | (code[before] == 0x2C) | (code[before] == 0x3B) | ((code[before] >= 0x30) & (code[before] <= 0x39))
        self.capital = (case[c] == 2) & (case[code[after]] == 1) & (code[np.maximum(start - 1, 0)] == 0x20) & calm & (start >= 2)

    @staticmethod
    def _mark(code: np.ndarray, kind: np.ndarray) -> np.ndarray:
        kind = kind.copy()
        space = np.zeros(0x110000, dtype=bool)
        space[[9, 10, 13, 32, 0xA0, 2]] = True
        closing = space.copy()
        closing[[ord(c) for c in _CLOSING]] = True
        ahead = np.concatenate((code[1:], [2]))
        behind = np.concatenate(([2], code[:-1]))
        kind[np.isin(code, [ord(c) for c in _ENDS]) & closing[ahead]] = END
        kind[np.isin(code, [ord(c) for c in _ALWAYS_ENDS]) | ((code == 10) & (ahead == 10))] = END
        kind[np.isin(code, [ord(c) for c in _SEPS])] = SEP
        kind[np.isin(code, [0x2D, 0x2013, 0x2014]) & space[ahead] & space[behind]] = SEP
        return kind

    def windows(self, code: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
        """Place of the first word and hash of every window of `width` words inside one text."""
        n = len(code) - width + 1
        if n <= 0:
            return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint64)
        h = np.zeros(n, dtype=np.uint64)
        with np.errstate(over="ignore"):
            for k in range(width):
                h += code[k : k + n] * _POW[k + 1]
        at = np.flatnonzero(self.doc[:n] == self.doc[width - 1 :])
        return at, mix(h[at])


def word_hash(words: list[str]) -> np.ndarray:
    """Hashes of single words, the same as in `Words`."""
    return Words([" ".join(words)]).hash if words else np.zeros(0, dtype=np.uint64)


def slices(texts: list[str], most: int = 500_000):
    """(from, to) of runs of texts with about `most` characters each; a longer text is a run of its own."""
    at, size = 0, 0
    for i, t in enumerate(texts):
        if size and size + len(t) > most:
            yield at, i
            at, size = i, 0
        size += len(t) + 1
    if at < len(texts):
        yield at, len(texts)


def _accent_table() -> tuple[str, str]:
    """Letters below U+2000 that fold to another letter, and that letter; marks and emphasis signs are deleted."""
    src, dst, gone = [], [], list("*_`~")
    for cp in range(0x2000):
        c = chr(cp)
        if unicodedata.category(c) in ("Mn", "Mc", "Me", "Cf"):
            gone.append(c)
        elif unicodedata.category(c)[0] == "L" and c.lower() == c and _base(cp) != cp:
            src.append(c)
            dst.append(chr(_base(cp)))
    return "".join(src + gone), "".join(dst)


_FROM, _TO = _accent_table()


def folded(text: Column) -> Column:
    """Words of a text, folded as in `Words`, parted by single spaces. NULL stays NULL."""
    t = F.regexp_replace(text, r"<[/!a-zA-Z][^<>]*>|&(?:[a-zA-Z]{2,8}|#\d{1,6}|#x[0-9a-fA-F]{1,5});", " ")
    t = F.regexp_replace(t, r"(?<=\p{L})[-‐‑]\s*(?=\p{L})", "")
    t = F.translate(F.lower(t), _FROM, _TO)
    t = F.regexp_replace(t, r"([\p{IsHan}\p{IsHiragana}\p{IsKatakana}])", " $1 ")
    return F.trim(F.regexp_replace(t, r"[^\p{L}\p{N}]+", " "))
