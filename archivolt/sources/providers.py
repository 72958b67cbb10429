"""What the outside world must offer, and deterministic stand-ins: no network, PDF library or model is needed here."""

from __future__ import annotations

import hashlib
import re
import time
import zipfile
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field
from io import BytesIO
from typing import Protocol
from xml.etree import ElementTree


@dataclass
class Response:
    status: int
    body: bytes = b""
    mime: str | None = None
    etag: str | None = None
    last_modified: str | None = None


class Fetcher(Protocol):
    def fetch(self, url: str, etag: str | None = None, last_modified: str | None = None) -> Response: ...


class PageText(Protocol):
    def pages(self, content: bytes, most: int = 5) -> list[str]: ...


class Completion(Protocol):
    def complete(self, prompt: str) -> str: ...


class ObjectStore(Protocol):
    def put(self, key: str, content: bytes) -> str: ...


class TransientError(Exception):
    """Worth another try: time-out, reset or refused connection."""


@dataclass
class TableFetcher:
    """Answers from a table of urls; honours validators; fails first where told to."""

    table: dict[str, tuple[bytes, str]]
    failures: dict[str, int] = field(default_factory=dict)
    modified: dict[str, str] = field(default_factory=dict)

    def fetch(self, url: str, etag: str | None = None, last_modified: str | None = None) -> Response:
        if self.failures.get(url, 0) > 0:
            self.failures[url] -= 1
            raise TransientError(url)
        if url not in self.table:
            return Response(404)
        body, mime = self.table[url]
        tag = '"' + hashlib.sha256(body).hexdigest()[:16] + '"'
        when = self.modified.get(url)
        if etag == tag or (etag is None and when is not None and last_modified == when):
            return Response(304, etag=tag, last_modified=when)
        return Response(200, body, mime.split(";")[0].strip(), tag, when)


def fetch_with_retries(fetcher: Fetcher, url: str, etag: str | None = None, last_modified: str | None = None, waits: tuple[float, ...] = (2.0, 5.0), sleep=time.sleep) -> Response:
    """Retries transient errors only, after each of the waits; status 0 when none is left."""
    for wait in (*waits, None):
        try:
            return fetcher.fetch(url, etag, last_modified)
        except TransientError:
            if wait is not None:
                sleep(wait)
    return Response(0)


#: Where a site's sitemap is looked for beside what its robots.txt names.
SITEMAP_PATHS = ["/sitemap.xml", "/sitemap_index.xml", "/sitemap-index.xml", "/sitemap1.xml"]


def sitemap_urls(origin: str, robots: str | None) -> list[str]:
    """Sitemaps named by a robots.txt, then the usual places, each once."""
    named = [m.strip() for m in re.findall(r"^Sitemap:\s*(.+)$", robots or "", re.M | re.I)]
    return list(dict.fromkeys([*named, *[origin.rstrip("/") + p for p in SITEMAP_PATHS]]))


def pages_by_token(fetch: Callable[[str | None], tuple[list, str | None]]) -> Iterator:
    """All items of an answer given in pages: `fetch(token)` gives (items, next token); the first token is None."""
    token, seen = None, set()
    while True:
        items, token = fetch(token)
        yield from items
        if token is None or token in seen:
            return
        seen.add(token)


def feed_posts(page: Callable[[int], list[dict]], tries: int = 4, most: int = 2000, sleep=time.sleep) -> dict[str, dict]:
    """Posts of a paged feed by normalised url, the last of a url counts; a page that comes back empty is asked for again."""

    def asked(n: int) -> list[dict]:
        for attempt in range(tries):
            if attempt:
                sleep(0.5 * attempt)
            items = page(n)
            if items:
                return items
        return []

    last = max(1, last_page(lambda n: bool(page(n)), most))
    return {p["link"].removesuffix("/") + "/": p for n in range(1, last + 1) for p in asked(n)}


def environment(text: str, held: dict[str, str]) -> dict[str, str]:
    """`held` with the `KEY="value"` lines of a settings file beneath: what is held already wins."""
    told = re.findall(r"""^([A-Z][A-Z0-9_]*)=["']?([^"'\n]*)["']?$""", text, re.M)
    return {**{k: v for k, v in reversed(told)}, **{k: v for k, v in held.items() if v}}


class Cached:
    """Answers of a function, kept for some seconds by argument; `stale` answers are given while one fetches anew."""

    def __init__(self, make: Callable, seconds: float, clock=time.monotonic):
        self.make, self.seconds, self.clock, self.held = make, seconds, clock, {}

    def __call__(self, *key):
        at, value = self.held.get(key, (None, None))
        if at is None or self.clock() - at >= self.seconds:
            value = self.make(*key)
            self.held[key] = (self.clock(), value)
        return value


class Jobs(Protocol):
    def submit(self, name: str, content: bytes) -> str: ...
    def status(self, job: str) -> str: ...


def awaited(jobs: Jobs, job: str, ends: Callable[[str], str | None], wait: float = 3.0, most: float = 3600.0, sleep=time.sleep, clock=time.monotonic) -> str:
    """Polls a job until `ends` says done or failed; "timeout" after `most` seconds."""
    start = clock()
    while clock() - start < most:
        end = ends(jobs.status(job))
        if end:
            return end
        sleep(wait)
    return "timeout"


@dataclass
class ScriptedJobs:
    """Jobs that go through the statuses they are told, one a question."""

    script: list[str]
    asked: dict[str, int] = field(default_factory=dict)

    def submit(self, name: str, content: bytes) -> str:
        return hashlib.sha256(content).hexdigest()[:12]

    def status(self, job: str) -> str:
        n = self.asked.get(job, 0)
        self.asked[job] = n + 1
        return self.script[min(n, len(self.script) - 1)]


def last_page(exists, most: int = 2000) -> int:
    """The last page in [1, most) that exists, by bisection; 0 if none does."""
    low, high = 0, most
    while high - low > 1:
        mid = (low + high) // 2
        low, high = (mid, high) if exists(mid) else (low, mid)
    return low


class DocxText:
    """Paragraphs of a .docx file with the standard library; no pages there, so all text is one."""

    def pages(self, content: bytes, most: int = 5) -> list[str]:
        with zipfile.ZipFile(BytesIO(content)) as z:
            root = ElementTree.fromstring(z.read("word/document.xml"))
        w = "{http://schemas.openxmlformats.org/wordprocessingml/2006/main}"
        return ["\n\n".join("".join(t.text or "" for t in p.iter(f"{w}t")) for p in root.iter(f"{w}p"))]


class FormFeedText:
    """Stands in for a PDF parser: pages parted by form feeds, behind the magic header."""

    def pages(self, content: bytes, most: int = 5) -> list[str]:
        if not content.startswith(b"%PDF-"):
            raise ValueError("no PDF header")
        return content.split(b"\n", 1)[1].decode("utf-8", "replace").split("\f")[:most]


class EchoCompletion:
    """Answers with the prompt's first words and its digest, the same for the same prompt."""

    def complete(self, prompt: str) -> str:
        return " ".join(re.findall(r"\w+", prompt)[:8]) + " " + hashlib.sha256(prompt.encode()).hexdigest()[:8]


@dataclass
class MemoryStore:
    objects: dict[str, bytes] = field(default_factory=dict)

    def put(self, key: str, content: bytes) -> str:
        self.objects[key] = content
        return hashlib.sha256(content).hexdigest()
