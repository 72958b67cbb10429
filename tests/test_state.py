from pyspark.sql import functions as F

from archivolt.operators import merge as M, relational as R
from archivolt.operators.crawl import expanded_sitemaps, reachable
from archivolt.operators.dom import main_content, markdown, parse


def test_upsert_modes(spark, rows):
    old = spark.createDataFrame([("a", 1, "x"), ("b", 2, "y")], "k string, v int, w string")
    new = spark.createDataFrame([("b", 3), ("c", 4)], "k string, v int")
    assert rows(M.upsert(old, new, ["k"]), "k", "v", "w") == [("a", 1, "x"), ("b", 3, "y"), ("c", 4, None)]
    assert rows(M.upsert(old, new, ["k"], "replace"), "k", "v", "w") == [("a", 1, "x"), ("b", 3, None), ("c", 4, None)]
    assert rows(M.upsert(old, new, ["k"], "ignore"), "k", "v", "w") == [("a", 1, "x"), ("b", 2, "y"), ("c", 4, None)]
    assert rows(M.upsert(old.limit(0), new, ["k"]), "k", "v") == [("b", 3), ("c", 4)]


def test_last_per_key_takes_ties_by_row_and_drops_null_keys(spark, rows):
    x = spark.createDataFrame([("a", 1, "p"), ("a", 1, "q"), (None, 9, "z")], "k string, t int, v string")
    assert rows(M.last_per_key(x, ["k"], ["t"]), "k", "t", "v") == [("a", 1, "q")]


def test_page_seen_again_is_revived(spark):
    schema = "url string, content_hash string, first_seen_at string, last_seen_at string, last_changed_at string, gone int, gone_since string, page_role string, word_count_clean int"
    old = spark.createDataFrame([("u", "h", "1", "1", "1", 1, "2", "content", 7)], schema)
    new = spark.createDataFrame([("u", None, "3", "3", "3", 0, None, None, None)], schema)
    r = M.upsert_pages(old, new).first()
    assert (r.gone, r.gone_since, r.last_changed_at, r.page_role, r.word_count_clean, r.content_hash, r.first_seen_at) == (0, None, "1", "content", 7, "h", "1")


def test_empty_seen_set_marks_all(spark, rows):
    old = spark.createDataFrame([("a", 0, None), ("b", 1, "1")], "url string, gone int, gone_since string")
    assert rows(M.mark_absent(old, old.limit(0), "url", "gone", "gone_since", "9"), "url", "gone", "gone_since") == [("a", 1, "9"), ("b", 1, "1")]


def test_content_states(spark, rows):
    v = spark.createDataFrame([("u", 1, "a"), ("u", 2, None), ("u", 3, "a"), ("u", 4, "b")], "url string, t int, h string")
    assert [x[1] for x in rows(M.content_changes(v, "url", "t", F.col("h")), "t", "content_state")] == ["new", None, "unchanged", "changed"]


def test_prefixes_and_asof(spark, rows):
    x = spark.createDataFrame([("/a/1",), ("/b",), (None,)], "p string")
    pre = spark.createDataFrame([("/a",), ("/b/",)], "q string")
    assert rows(R.starts_with_any(x, "p", pre, "q"), "p") == [("/a/1",)]
    left = spark.createDataFrame([("k", 5), ("k", 1), ("m", 1)], "k string, t int")
    right = spark.createDataFrame([("k", 2, "two"), ("k", 5, "five"), ("k", 9, "nine")], "k string, s int, v string")
    assert rows(R.asof_join(left, right, "k", "t", "s", ["v"]), "k", "t", "v") == [("k", 1, None), ("k", 5, "five"), ("m", 1, None)]


def test_once_per_digest_and_skip(spark, rows):
    x = spark.createDataFrame([(1, "h", "t"), (2, "h", "t"), (3, None, "z")], "i int, d string, t string")
    assert rows(R.once_per_digest(x, "d", ["t"], lambda y: y.withColumn("n", F.length("t"))), "i", "n") == [(1, 1), (2, 1), (3, None)]
    done = spark.createDataFrame([(1, "h"), (2, None)], "i int, s string")
    assert rows(R.skip_unchanged(x, done, "i", "d", "s"), "i") == [(2,), (3,)]


def test_crawl_depth_is_least_and_scope_holds(spark, rows):
    link = lambda *u: "".join(f'<a href="{x}">x</a>' for x in u)
    pages = spark.createDataFrame([("https://a.example/", link("/1", "/2", "https://b.example/")), ("https://a.example/1", link("/2", "/3")), ("https://a.example/3", link("/", "/4"))], "url string, html string")
    seeds = spark.createDataFrame([("https://a.example/",)], "url string")
    assert rows(reachable(seeds, pages, "a.example", 2), "url", "depth") == [("https://a.example/", 0), ("https://a.example/1", 1), ("https://a.example/2", 1), ("https://a.example/3", 2)]


def test_sitemap_index_is_expanded(spark, rows):
    files = spark.createDataFrame([("r", "<sitemapindex><sitemap><loc>s</loc></sitemap><sitemap><loc>r</loc></sitemap></sitemapindex>"), ("s", "<urlset><url><loc>u</loc></url><url></url></urlset>"), ("t", "junk")], "url string, xml string")
    assert rows(expanded_sitemaps(files.select("url").where("url = 'r'"), files), "url", "lastmod", "source") == [("u", None, "s")]


def test_markdown_of_broken_markup():
    html = "<div><nav><a href=/>home</a></nav><div id=c><h2>T</h2><p>one <b>two</b><p>three <a href='x'>y</a><ul><li>p<li>q</ul><pre>a\nb</pre><table><tr><td>1<td>2</table></div></div><script>z()</script>"
    node, how = main_content(parse(html), "#c")
    assert how == "rules"
    assert markdown(node) == "## T\n\none **two**\n\nthree [y](x)\n\n- p\n- q\n\n```\na\nb\n```\n\n| 1 | 2 |\n| --- | --- |"
    assert markdown(parse("")) == "" and markdown(parse("<p")) in ("", "<p")
