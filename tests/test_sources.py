import io
import json
import zipfile

import pytest

from archivolt.sources import providers as P, readers as S


def test_retry_only_transient():
    waits = []
    f = P.TableFetcher({"u": (b"x", "text/html; charset=utf-8")}, {"u": 2})
    r = P.fetch_with_retries(f, "u", sleep=waits.append)
    assert (r.status, r.mime, waits) == (200, "text/html", [2.0, 5.0])
    assert P.fetch_with_retries(f, "u", etag=r.etag).status == 304 and P.fetch_with_retries(f, "v").status == 404
    assert P.fetch_with_retries(P.TableFetcher({}, {"u": 9}), "u", sleep=waits.append).status == 0


def test_last_page():
    assert [P.last_page(lambda n, k=k: n <= k) for k in (0, 1, 7, 1999)] == [0, 1, 7, 1999]


def test_documents():
    b = io.BytesIO()
    w = 'xmlns:w="http://schemas.openxmlformats.org/wordprocessingml/2006/main"'
    with zipfile.ZipFile(b, "w") as z:
        z.writestr("word/document.xml", f"<w:document {w}><w:body><w:p><w:r><w:t>a</w:t></w:r></w:p><w:p><w:r><w:t>b</w:t></w:r></w:p></w:body></w:document>")
    assert P.DocxText().pages(b.getvalue()) == ["a\n\nb"]
    assert P.FormFeedText().pages(b"%PDF-1\none\ftwo") == ["one", "two"]
    with pytest.raises(ValueError):
        P.FormFeedText().pages(b"<html>")


def test_fetch_source(spark, rows):
    spark.dataSource.register(S.FetchSource)
    table = {"https://a.example/": ["hello", "text/html"]}
    df = spark.read.format("archive_fetch").option("requests", json.dumps([["https://a.example/", None], ["https://b.example/", None]])).option("table", json.dumps(table)).load()
    assert rows(df, "url", "status", "body") == [("https://a.example/", 200, "hello"), ("https://b.example/", 404, None)]


def test_files_logs_and_settings(spark, tmp_path, rows):
    (tmp_path / "m" / "d").mkdir(parents=True)
    (tmp_path / "m" / "d" / "a.pdf").write_bytes(b"%PDF-1.4")
    (tmp_path / "m" / "d" / "b.pdf").write_bytes(b"no")
    files = S.mirrored_files(spark, str(tmp_path / "m"), "*.pdf")
    assert sorted(files.select(S.is_pdf(files.content).alias("p")).toPandas().p) == [False, True]
    want = spark.createDataFrame([("d/a.pdf",), ("d/c.pdf",)], "local_path string")
    assert rows(S.missing_files(want, files, "local_path", str(tmp_path / "m")), "local_path") == [("d/c.pdf",)]
    (tmp_path / "log.jsonl").write_text('{"a": 1}\nbroken\n')
    assert rows(S.json_lines(spark, str(tmp_path / "log.jsonl"), "a int"), "a", "broken") == [(1, None), (None, "broken")]
    (tmp_path / "s.yaml").write_text("defaults: {a: {b: 1, c: 2}, d: 3}\nsites: [{domain: x, a: {b: 9}}]")
    assert S.site_settings(str(tmp_path / "s.yaml")) == [{"a": {"b": 9, "c": 2}, "d": 3, "domain": "x"}]


def test_discovery_pages_and_settings():
    assert P.sitemap_urls("https://a.example", "User-agent: *\nsitemap: https://a.example/x.xml \nSitemap: https://a.example/sitemap.xml")[:2] == ["https://a.example/x.xml", "https://a.example/sitemap.xml"]
    assert len(P.sitemap_urls("https://a.example", None)) == 4
    answers = {None: ([1, 2], "b"), "b": ([3], "c"), "c": ([], None)}
    assert list(P.pages_by_token(answers.get)) == [1, 2, 3]
    calls = []

    def page(n):
        calls.append(n)
        return [] if n > 3 or (n == 2 and calls.count(2) == 2) else [{"link": f"https://a.example/{n}/", "n": n}]

    assert sorted(P.feed_posts(page, sleep=lambda s: None)) == [f"https://a.example/{n}/" for n in (1, 2, 3)]
    assert P.environment('A="x"\nB=y\nbad\nC=', {"A": "own", "D": ""}) == {"A": "own", "B": "y", "C": ""}
    assert S.source_kind({"wordpress_rss": {}}) == "http" and S.source_kind({"source": {"type": "mediawiki_api"}}) == "mediawiki_api"
    with pytest.raises(ValueError):
        S.source_kind({"source": {"type": "gopher"}})


def test_jobs_and_kept_answers():
    now = [0.0]
    jobs = P.ScriptedJobs(["queued", "processing", "completed"])
    job = jobs.submit("a.pdf", b"x")
    ends = {"completed": "done", "error": "failed"}.get
    assert P.awaited(jobs, job, ends, sleep=lambda s: now.__setitem__(0, now[0] + s), clock=lambda: now[0]) == "done" and now[0] == 6.0
    assert P.awaited(P.ScriptedJobs(["queued"]), "j", ends, most=9, sleep=lambda s: now.__setitem__(0, now[0] + s), clock=lambda: now[0]) == "timeout"
    made = []
    kept = P.Cached(lambda k: made.append(k) or len(made), 30, clock=lambda: now[0])
    assert (kept("a"), kept("a"), kept("b")) == (1, 1, 2)
    now[0] += 31
    assert kept("a") == 3


def test_conditional_by_date(spark, rows):
    spark.dataSource.register(S.FetchSource)
    table = {"https://a.example/": ["hello", "text/html", "Mon, 06 Jan 2025 10:00:00 GMT"]}
    asked = [["https://a.example/", None, "Mon, 06 Jan 2025 10:00:00 GMT"]]
    df = spark.read.format("archive_fetch").option("requests", json.dumps(asked)).option("table", json.dumps(table)).option("waits", "").load()
    assert rows(df, "url", "status", "last_modified") == [("https://a.example/", 304, "Mon, 06 Jan 2025 10:00:00 GMT")]
