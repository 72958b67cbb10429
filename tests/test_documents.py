from pyspark.sql import functions as F

from archivolt.functions import html as H, summaries as S
from archivolt.operators import assets as A
from archivolt.plans import web_queries as W
from archivolt.schemas import conform, schema
from archivolt.sources import tables


def one(spark, value, expr):
    return spark.createDataFrame([(value,)], "v string").select(expr(F.col("v"))).first()[0]


def test_authors_of_every_form(spark):
    assert [tuple(a) for a in one(spark, '[{"name": "A", "url": "u"}, "B", {"url": "x"}]', H.authors)] == [("A", "u", None, None, None), ("B", None, None, None, None)]
    assert [tuple(a) for a in one(spark, '{"name": "A"}', H.authors)] == [("A", None, None, None, None)]
    assert one(spark, None, H.authors) == []


def test_summaries_of_little(spark):
    assert one(spark, None, lambda c: S.free_summary(c, c, c)) is None and one(spark, None, lambda c: S.prompt([("a", c)])) is None
    assert one(spark, "word " * 50, lambda c: S.free_summary(F.lit("T"), c, F.lit("d"))).endswith("word… [d]")
    assert one(spark, "x", lambda c: S.moving_average(F.array().cast("array<double>"))) is None


def test_local_images(spark, rows):
    docs = spark.createDataFrame([(1, "![a](u1) ![b](u10) [c](u1)"), (2, None), (3, "none")], "k int, t string")
    assets = spark.createDataFrame([("u1", "p1"), ("u10", "p10"), ("u1", "p1")], "original_url string, path string")
    assert rows(A.with_local_images(docs, "k", "t", assets), "k", "t") == [(1, "![a](p1) ![b](p10) [c](p1)"), (2, None), (3, "none")]


def test_conform_and_scans(spark, tmp_path):
    x = conform(spark.createDataFrame([("u", "7", "n")], "url string, depth string, other string"), "pages")
    assert x.columns == schema("pages").names and x.first().depth == 7 and x.first().domain is None
    assert tables.site_table(spark, str(tmp_path), "pages") is None
    spark.createDataFrame([("d", "u", 1)], "domain string, url string, extra int").write.parquet(f"{tmp_path}/hosts.parquet")
    assert tables.site_table(spark, str(tmp_path), "hosts", "d").count() == 1
    spark.createDataFrame([("u",)], "url string").write.parquet(f"{tmp_path}/pages.parquet")
    assert tables.union_of_sites(spark, {"a": str(tmp_path), "b": "/nowhere"}, "pages").first().domain == "a"
    tables.write_markdown(spark.createDataFrame([("d", "p", "t")], "domain string, md_path string, text string"), f"{tmp_path}/md")
    assert spark.read.parquet(f"{tmp_path}/md").first().text == "t"


def test_hocr_of_all_words(spark, rows):
    docs = spark.createDataFrame([(1, " ".join(f"w{i}" for i in range(100))), (2, "a < b"), (3, " "), (4, None)], "doc_id long, text string")
    assert rows(W.hocr_of_texts(docs), "doc_id", "words", "confidence", "right") == [(1, 100, sum(60 + i % 40 for i in range(100)) / 100, 998), (2, 3, 61.0, 28)]
    assert "hocr_parse" in W.QUERIES
