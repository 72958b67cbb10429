"""Text metrics as column expressions: no Python runs per row.

Conventions: NULL text gives the value of an empty text unless said otherwise; white space is that of browsers.
"""

from __future__ import annotations

import itertools
import re

import pandas as pd
from pyspark.sql import Column, functions as F

from archivolt.functions.constants import ASCII_BOUNDARY, ASCII_LETTERS, FUNCTION_WORDS, LATIN_LETTERS, NOT_WS, QUALITY_WORDS, SCRIPTS, VOWELS, WORD_FORMING, WS


def _text(c: Column) -> Column:
    return F.coalesce(c, F.lit(""))


def let(value: Column, body) -> Column:
    """`body(value)` with the value evaluated once, however often the body uses it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def count_of(text: Column, pattern: str) -> Column:
    return F.regexp_count(_text(text), F.lit(pattern))


def half_up(x: Column, digits: int = 2) -> Column:
    """Rounding by floor(x * 10^digits + 0.5), the same in every engine."""
    p = float(10**digits)
    return F.floor(x * p + 0.5) / p


def tokens(text: Column) -> Column:
    """Words between white space, none empty."""
    return F.filter(F.split(_text(text), WS + "+"), lambda w: w != "")


def word_count(text: Column) -> Column:
    return F.size(tokens(text))


def word_set(text: Column) -> Column:
    """Distinct lower-case runs of ASCII word characters."""
    return F.array_distinct(F.filter(F.split(F.lower(_text(text)), r"\W+"), lambda w: w != ""))


def jaccard(a: Column, b: Column) -> Column:
    """Shared over all words; two empty sets give 0."""
    pair = F.struct(word_set(a).alias("a"), word_set(b).alias("b"))
    return let(pair, lambda p: F.size(F.array_intersect(p["a"], p["b"])) / F.greatest(F.size(F.array_union(p["a"], p["b"])), F.lit(1)))


def printable_ratio(text: Column) -> Column:
    """Share of the visible characters that are no controls; 1 below 20 characters."""
    n = count_of(text, NOT_WS)
    return F.when(n < 20, F.lit(1.0)).otherwise((n - count_of(text, r"[\x00-\x08\x0E-\x1F]")) / n)


def script_share(text: Column, language: Column) -> Column:
    """Share of the printable characters in the language's script; NULL without script or below 20 characters."""
    n = count_of(text, NOT_WS) - count_of(text, r"[\x00-\x08\x0E-\x1F]")
    found = F.lit(None).cast("int")
    for name, ranges in SCRIPTS.items():
        found = F.when(language == name, count_of(text, f"[{ranges}]")).otherwise(found)
    return F.when(n >= 20, found / n)


def garbled(text: Column, language: Column) -> Column:
    """Whether a text layer is garbage: too much extended Latin or private use, ASCII in right-to-left text, or a wrong script."""
    n = count_of(text, NOT_WS)
    rtl = count_of(text, r"[\x{0590}-\x{05FF}\x{0600}-\x{06FF}\x{FB50}-\x{FEFF}]")
    ascii_ = count_of(text, "[A-Za-z]")
    in_script = F.lit(None).cast("int")
    for name, ranges in SCRIPTS.items():
        in_script = F.when(language == name, count_of(text, f"[{ranges}]")).otherwise(in_script)
    bad = (count_of(text, r"[\x{00C0}-\x{02FF}]") > 0.15 * n) | (count_of(text, r"[\x{E000}-\x{F8FF}]") > 0.05 * n)
    bad = bad | ((rtl > 0.05 * n) & (ascii_ > 0.25 * (rtl + ascii_))) | F.coalesce(in_script < 0.5 * n, F.lit(False))
    return (n >= 50) & bad


def token_distribution(text: Column) -> Column:
    """0.6 x share of words of 3-15 characters + 0.4 x distinct / min(words, 100); 0 below five words of 2-25."""
    t = F.filter(tokens(text), lambda w: F.length(w).between(2, 25))
    fine = lambda x: F.size(F.filter(x, lambda w: F.length(w).between(3, 15)))
    share = lambda x: fine(x) / F.size(x) * 0.6 + F.size(F.array_distinct(x)) / F.least(F.size(x), F.lit(100)) * 0.4
    return let(t, lambda x: F.when(F.size(x) < 5, F.lit(0.0)).otherwise(share(x)))


def digit_noise(text: Column) -> Column:
    """Share of the mostly-letter words with a digit between letters; 0 below ten such words."""
    t = F.filter(tokens(text), lambda w: F.length(w).between(3, 25) & ((F.length(w) - F.length(F.translate(w, ASCII_LETTERS, ""))) * 2 >= F.length(w)))
    noisy = lambda x: F.size(F.filter(x, lambda w: w.rlike("[a-zA-Z][0-9][a-zA-Z]")))
    return let(t, lambda x: F.when(F.size(x) < 10, F.lit(0.0)).otherwise(noisy(x) / F.size(x)))


def script_token_length(text: Column, language: Column) -> Column:
    """Mean number of characters in the language's script over the tokens with any; NULL below five, or without script."""
    found = F.lit(None).cast("array<int>")
    for name, ranges in SCRIPTS.items():
        letters = F.lit(f"[{ranges}]")
        counts = F.filter(F.transform(tokens(text), lambda w: F.regexp_count(w, letters)), lambda n: n > 0)  # noqa: B023
        found = F.when(language == name, counts).otherwise(found)
    return let(found, lambda n: F.when(F.size(n) >= 5, F.aggregate(n, F.lit(0), lambda a, x: a + x) / F.size(n)))


_LATIN_RUN = re.compile("[a-zA-ZÀ-ÿ]+")
_FOUR_ALIKE = re.compile(r"(.)\1{3}")


def latin_words(text: Column, language: Column) -> Column:
    """struct(n, real, bare) of the first 200 Latin words of 2 to 20 letters: how many there are, how many are listed for the
    language or have a natural share of vowels, and how many short ones have none."""
    known = {k: frozenset(v) for k, v in QUALITY_WORDS.items()}
    vowels, open_ = frozenset(VOWELS), frozenset(VOWELS.replace("ç", "").replace("ñ", "") + "y")

    def count(texts: pd.Series, languages: pd.Series) -> pd.DataFrame:
        seen: dict[str, tuple[str, bool, bool]] = {}
        out = []
        for text, language in zip(texts, languages):
            listed = known.get(language, known["english"])
            n = real = bare = 0
            fitting = (m.group() for m in _LATIN_RUN.finditer(text or "") if 2 <= m.end() - m.start() <= 20)
            for word in itertools.islice(fitting, 200):
                told = seen.get(word)
                if told is None:
                    low = word.lower()
                    share = sum(c in vowels for c in low) / len(low)
                    told = (low, 0.2 <= share <= 0.75 and not _FOUR_ALIKE.search(low), len(low) <= 3 and not open_.intersection(low))
                    if len(seen) < 200_000:
                        seen[word] = told
                n += 1
                real += told[0] in listed or told[1]
                bare += told[2]
            out.append((n, real, bare))
        return pd.DataFrame(out, columns=["n", "real", "bare"])

    return F.pandas_udf(count, "n int, real int, bare int")(text, language)


def word_quality(text: Column, language: Column) -> Column:
    """How much of a text reads like words of its language, 0 to 1 in two digits.

    Mostly control characters: their share. Languages with a script of their own: share of the script and distribution of
    tokens, less for isolated letters. Others: `latin_words`, less for digits inside words and for short ones without vowels.
    """
    printable = printable_ratio(text)
    scripted = let(F.struct(script_share(text, language).alias("share"), token_distribution(text).alias("spread"), script_token_length(text, language).alias("length")), lambda m: F.least(F.lit(1.0), m["share"] * 0.85 + m["spread"] * 0.15) * F.when(language.isin(WORD_FORMING) & (m["length"] < 2.5), 1 - F.least(F.lit(0.8), (2.5 - m["length"]) / 1.5)).otherwise(1.0))

    def latin(w: Column) -> Column:
        bare = w["bare"] / w["n"]
        penalty = F.when(bare > 0.03, (bare - 0.03) * 4).otherwise(0.0)
        return F.when(w["n"] < 10, F.lit(0.0)).otherwise(F.greatest(F.lit(0.0), w["real"] / w["n"] - digit_noise(text) * 3 - penalty))

    plain = latin(latin_words(text, language))
    value = F.when(printable < 0.3, printable).when(script_share(text, language).isNotNull(), printable * scripted).otherwise(printable * plain)
    return F.when(F.length(F.regexp_replace(_text(text), WS + "+", "")) == 0, F.lit(0.0)).otherwise(half_up(value))


def bad_sample(text: Column, most: int = 300) -> Column:
    """The first run of five words among what is plain ASCII, else its beginning."""
    plain = F.trim(F.regexp_replace(F.regexp_replace(_text(text), r"[^\x20-\x7E\n]", " "), r"[ \n]+", " "))
    run = F.regexp_extract(plain, r"[A-Za-z]{3,}(?: +[A-Za-z]{2,}){4,}", 0)
    return F.substring(F.when(run != "", run).otherwise(plain), 1, most)


def excerpt(text: Column, most: int = 280) -> Column:
    """The first long run of a sentence, else the beginning; white space collapsed."""
    clean = F.regexp_replace(F.regexp_replace(_text(text), WS + "+", " "), "^ | $", "")
    run = F.regexp_extract(clean, r"[A-ZÀ-Ö][a-zA-ZÀ-ÿ,;:\s]{40,}", 0)
    return F.regexp_replace(F.substring(F.when(run != "", run).otherwise(clean), 1, most), "^ +| +$", "")


def detect_language(text: Column) -> Column:
    """Language by script, Latin ones by function words among the first 150 words; `unknown` below 15 characters."""
    t = _text(text)
    n = F.length(t)
    share = lambda ranges: count_of(t, f"[{ranges}]") / n
    letters = f"{ASCII_BOUNDARY}[{LATIN_LETTERS}]{{2,}}{ASCII_BOUNDARY}"

    def named(v: Column, size: Column) -> Column:
        best = F.greatest(*[v[k] for k in FUNCTION_WORDS])
        out = F.lit("portuguese")
        for k in ("italian", "german", "spanish", "french"):
            out = F.when(v[k] == best, k).otherwise(out)
        return F.when((size >= 8) & (best >= F.greatest(F.lit(3.0), F.least(size, F.lit(150)) * 0.06)), out).otherwise("english")

    vote = lambda sample, known: F.size(F.filter(sample, lambda w: w.isin(known)))
    votes = lambda sample: F.struct(*[vote(sample, v).alias(k) for k, v in FUNCTION_WORDS.items()])
    words = F.regexp_extract_all(F.lower(t), F.lit(letters), F.lit(0))
    latin = let(words, lambda ws: let(votes(F.slice(ws, 1, 150)), lambda v: named(v, F.size(ws))))
    return (
        F.when(n < 15, "unknown")
        .when(share(r"\x{0600}-\x{06FF}") > 0.07, F.when(t.rlike(r"[\x{067E}\x{0686}\x{0698}\x{06AF}]"), "persian").otherwise("arabic"))
        .when(share(r"\x{0590}-\x{05FF}") > 0.07, "hebrew")
        .when(share(r"\x{3040}-\x{30FF}") > 0.05, "japanese")
        .when(share(r"\x{4E00}-\x{9FFF}") > 0.07, "chinese")
        .when(share(r"\x{0400}-\x{04FF}") > 0.07, "russian")
        .when(share("a-zA-Z") > 0.3, latin)
        .otherwise("unknown")
    )


def title_from_url(url: Column) -> Column:
    """The last path segment (or the `dl` parameter) as a title: no .pdf, no leading time stamp, capitals at word starts."""
    path = F.regexp_extract(url, r"^[a-z]+://[^/?#]*([^?#]*)", 1)
    dl = F.regexp_extract(url, r"[?&]dl=([^&#]+)", 1)
    raw = F.when(dl != "", dl).otherwise(F.regexp_extract(path, "([^/]*)$", 1))
    plain = F.regexp_replace(F.regexp_replace(F.regexp_replace(raw, r"(?i)\.pdf$", ""), r"^\d{8,}-", ""), "[-_]", " ")
    raised = F.array_join(F.transform(F.split(plain, " "), lambda w: F.concat(F.upper(F.substring(w, F.lit(1), F.lit(1))), F.substring(w, F.lit(2), F.length(w)))), " ")
    return F.nullif(F.trim(raised), F.lit(""))


def generic_title(title: Column) -> Column:
    return title.isNull() | (F.length(title) <= 5) | (F.lower(F.trim(title)) == "pdf")
