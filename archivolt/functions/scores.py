"""Scores of a document's text layer, and names of languages."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from archivolt.functions.constants import HARD_SCRIPTS, LANGUAGE_CODES
from archivolt.functions.text import half_up


def known(x: Column) -> Column:
    """A number, 0 for none or for what is no number."""
    return F.coalesce(F.nanvl(x, F.lit(None).cast("double")), F.lit(0.0))


def composite(quality: Column, readable: Column, mean_chars: Column, has_text: Column, printable: Column | None = None) -> Column:
    """min(1, quality x (0.6 + 0.3 readable) + 0.07 chars + 0.03 text layer), chars being the printable ones over 500, at most
    1; two digits."""
    chars = F.least(known(mean_chars) * (F.lit(1.0) if printable is None else printable) / 500, F.lit(1.0))
    return half_up(F.least(F.lit(1.0), known(quality) * (0.6 + 0.3 * known(readable)) + 0.07 * chars + 0.03 * F.coalesce(has_text, F.lit(0))))


def difficulty(has_text: Column, pages: Column, language: Column) -> Column:
    """0.05 with a text layer, 1 without pages, else by pages, twice as much for scripts that are hard to recognise; 0.3 to 1."""
    hard = F.when(F.coalesce(language.isin(HARD_SCRIPTS), F.lit(False)), 2.0).otherwise(1.0)
    n = F.coalesce(pages, F.lit(0))
    return half_up(F.when(has_text == 1, 0.05).when(n == 0, 1.0).otherwise(F.greatest(F.lit(0.3), F.least(F.lit(1.0), n / 400.0 * hard))))


def language_name(label: Column) -> Column:
    """The English name of a language given by name or ISO 639-1 code; NULL for others."""
    names = {**{n: n.capitalize() for n in LANGUAGE_CODES.values()}, **{c: n.capitalize() for c, n in LANGUAGE_CODES.items()}}
    return F.try_element_at(F.create_map(*[F.lit(x) for p in names.items() for x in p]), F.lower(F.trim(label)))


#: How a text recogniser names the languages it is told apart by, by kind of region and by language code.
RECOGNISER = {"ara": ("printed_arabic", ["ar", "ara"]), "fas": ("printed_persian", ["fa", "fas", "per"]), "fra": ("printed_french", ["fr", "fra", "french"])}


def resolved_language(region: Column, document: Column, setting: Column) -> Column:
    """The recogniser's language for a region: the site's setting, else by the kind of region or the document's language."""
    out = F.when(region == "printed_cjk", "chi_sim+jpn").otherwise("eng")
    for name, (kind, codes) in reversed(RECOGNISER.items()):
        out = F.when(F.coalesce(region == kind, F.lit(False)) | F.coalesce(document.isin(codes), F.lit(False)), name).otherwise(out)
    return F.coalesce(F.nullif(setting, F.lit("")), out)


def without_quotes(text: Column) -> Column:
    """A text without the quotation marks around it."""
    return F.trim(F.regexp_replace(text, "^[\"«»「」『』\"']+|[\"«»「」『』\"']+$", ""))


def answer_lines(answer: Column) -> Column:
    """struct(summary, author, language) of a model's answer in lines: numbers and `Line n:` before a line are dropped, author
    and language are the values of the lines that name them, NULL where none does."""
    lines = F.filter(F.transform(F.split(F.coalesce(answer, F.lit("")), "\n"), lambda r: F.trim(r)), lambda r: r != "")

    def of(name: str, n: int) -> Column:
        before = rf"(?i)^(?:line\s*{n}[:.]?\s*)?{name}:\s*"
        return F.trim(F.regexp_replace(F.get(F.filter(lines, lambda r: r.rlike(before)), F.lit(0)), before, ""))

    first = F.get(lines, F.lit(0))
    bare = F.trim(F.regexp_replace(first, r"(?i)^(?:line\s*\d+[:.]?\s*|\d+[.:]\s*)", ""))
    return F.struct(F.coalesce(F.nullif(bare, F.lit("")), first).alias("summary"), of("author", 2).alias("author"), of("language", 3).alias("language"))


def export_method(chars: Column, pages: Column, quality: Column, least_chars: int = 50, least_quality: float = 0.8) -> Column:
    """How the text of a PDF was exported: pdf-text, -sparse for few characters a page, -garbled for low quality; stub without."""
    n = F.coalesce(chars, F.lit(0))
    return F.when(n == 0, "stub").when(n / F.greatest(F.coalesce(pages, F.lit(1)), F.lit(1)) < least_chars, "pdf-text-sparse").when(known(quality) < least_quality, "pdf-text-garbled").otherwise("pdf-text")


def engine_choice(first: Column, second: Column, ahead: float = 15.0) -> Column:
    """The second engine if its mean confidence is more than `ahead` above the first one's, or the first one has none."""
    return F.when(F.coalesce(second > first + ahead, second.isNotNull()), "second").when(first.isNotNull(), "first")


#: Parts of messages of errors that pass.
TRANSIENT = ["no workers available", "fetch failed", "socket hang up", "ECONNREFUSED", "ETIMEDOUT", "EAI_AGAIN", "timed out", "job expired", "HTTP 408", "HTTP 429", r"HTTP 5\d\d"]


def transient_error(message: Column) -> Column:
    """Whether an error is worth another try."""
    return F.coalesce(message.rlike("(?i)" + "|".join(TRANSIENT)), F.lit(False))


#: Words for how a job ended.
DONE, FAILED = ["done", "completed", "succeeded", "complete"], ["failed", "error", "cancelled", "canceled"]


def job_end(status: Column) -> Column:
    """done, failed, or NULL for a job that goes on."""
    s = status
    return F.when(s.isin(DONE), "done").when(s.isin(FAILED), "failed")


def backup_url(template: Column, domain: Column, path: Column) -> Column:
    """A url from a template with {domain} and {path}."""
    return F.replace(F.replace(template, F.lit("{domain}"), domain), F.lit("{path}"), F.regexp_replace(path, "^/", ""))
