import pytest
from pyspark.sql import functions as F

from archivolt.functions import html as H, text as T, urls as U
from archivolt.functions.moments import moment_micros


def one(spark, value, expr, kind="string"):
    return spark.createDataFrame([(value,)], f"v {kind}").select(expr(F.col("v"))).first()[0]


@pytest.mark.parametrize("text,micros", [("1970-01-02", 86_400_000_000), ("1970-01-01T02:00:00+02:00", 0), ("1970-01-01T00:00:01.5Z", 1_500_000), ("Thu, 01 Jan 1970 00:00:03 GMT", 3_000_000), ("", None), ("soon", None), (None, None), ("1970-01-01T01:00:00", 3_600_000_000), ("1970-13-01", None)])
def test_moments(spark, text, micros):
    assert one(spark, text, moment_micros) == micros


@pytest.mark.parametrize("text,language", [("short", "unknown"), (None, "unknown"), ("این یک متن فارسی است که پچ دارد", "persian"), ("في هذه المدينة كتاب كبير", "arabic"), ("The report of the council was read in the hall", "english"), ("le chat est dans la maison avec les autres chats qui ne sont pas la", "french"), ("Мы знаем, как это было", "russian"), ("这是学校第一次描述了这样的剧院的报纸", "chinese")])
def test_detect_language(spark, text, language):
    assert one(spark, text, T.detect_language) == language


def test_text_metrics_on_nothing(spark):
    for v in (None, "", " \n"):
        assert one(spark, v, T.word_count) == 0
        assert one(spark, v, T.printable_ratio) == 1.0
        assert one(spark, v, T.token_distribution) == 0.0
        assert one(spark, v, lambda c: T.word_quality(c, F.lit("english"))) == 0.0
        assert one(spark, v, T.excerpt) == ""
    assert one(spark, "a b " * 100_000, T.word_count) == 200_000


def test_urls(spark):
    assert one(spark, "https://a.example/x/y.html?q=1#f", lambda c: U.mirror_path(F.lit("a.example"), c)).startswith("mirror/a.example/x/y__")
    assert one(spark, "https://a.example/x/", lambda c: U.mirror_path(F.lit("a.example"), c)) == "mirror/a.example/x/index.html"
    assert one(spark, "/foo/bar.html", U.path_slug) == "foo-bar" and one(spark, "/", U.path_slug) == "index"
    assert one(spark, "../x y.pdf#p", lambda c: U.resolved(c, F.lit("https://a.example/d/e.html"))) == "https://a.example/x%20y.pdf"
    scope = lambda c: U.in_scope(c, F.lit("a.example"), ["/d"], ["/d/no"])
    assert [one(spark, u, scope) for u in ("https://a.example/d/1", "https://a.example/d/no/1", "https://b.example/d", "no url", None)] == [True, False, False, False, False]


def test_meta_last_wins_and_links(spark):
    html = '<meta name="A" content="1"><META property="a" content="2"><a href="#x">n</a><a href="y.pdf">T &amp; <b>U</b></a>'
    assert one(spark, html, H.meta_tags) == {"a": "2"}
    assert [tuple(x) for x in one(spark, html, H.links)] == [("y.pdf", "T & U")]


def test_json_ld_beats_og_and_broken_is_skipped(spark):
    page = '<html lang="de-AT"><head><title>t</title><meta property="og:title" content="og"><script type="application/ld+json">{}</script></head></html>'
    good = page.replace("{}", '{"@type": "Article", "headline": "ld", "author": {"name": "n"}}')
    m = one(spark, good, lambda c: H.metadata(c, F.lit("https://x/y.html")))
    assert (m.title, m.title_source, m.author, m.language, m.canonical_url) == ("ld", "json_ld", "n", "de", "https://x/y.html")
    assert one(spark, page.replace("{}", "{broken"), lambda c: H.metadata(c, F.lit("u"))).title_source == "og"


def test_backlinks(spark):
    assert one(spark, "a\n\nb", lambda c: H.with_backlinks(c, F.lit("u"), F.lit(3))) == "a [↗ p.3](u#page=3)\n\nb [↗ p.3](u#page=3)"
    assert 'data-pdf-para="2"' in one(spark, "a\n\nb", lambda c: H.with_backlinks(c, F.lit("u"), F.lit(3), "both"))


def test_frontmatter_round_trip(spark):
    head = lambda c: H.frontmatter([("title", c), ("none", F.lit(None).cast("string"))])
    assert one(spark, 'a: "b"', head) == '---\ntitle: "a: \\"b\\""\n---\n\n'
    assert one(spark, "plain", lambda c: H.frontmatter_map(head(c))) == {"title": "plain"}
