import math

import pytest
from pyspark.sql import functions as F

from archivolt.llm import mixing, ranking

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
SCHEMA = "url string, scored_at string, avg_chars_per_page double, readable_pages_pct double, word_quality_estimate double, has_text_layer int, rank string, closeness string"


def quality(spark, data):
    return spark.createDataFrame([(*r, "x", "y") for r in data], SCHEMA)


def test_no_score_decides_alone(spark):
    data = [(f"u{i}", "1", 10.0 * i, i / 400, i / 400, int(i > 200)) for i in range(401)]
    data += [("huge", "1", 1e12, 0.0, 0.0, 0), ("percent", "1", 2500.0, 100.0, 1.0, 1), ("bad", "1", float("nan"), -1.0, None, None), ("none", "1", None, None, None, None), ("u3", "0", 5000.0, 1.0, 1.0, 1), ("u3", "1", 300.0, 0.06, 0.06, 0), (None, "1", 1.0, 1.0, 1.0, 1)]
    got = ranking.pdf_ranking(quality(spark, data)).toPandas().set_index("url")
    assert sorted(got["rank"]) == list(range(1, 406)) and got["closeness"].between(0, 1).all()
    assert got.loc["u400", "rank"] <= 5 and got.loc["huge", "rank"] > 100 and got.loc["percent", "rank"] < 100 and got.loc["u3", "rank"] > 300
    assert (got.sort_values("rank")["closeness"].diff().dropna() <= 0).all()


def test_closeness_by_hand(spark):
    x = spark.createDataFrame([("a", 3.0, 0.0), ("b", 4.0, 1.0)], "k string, p double, q double")
    got = {r["k"]: r["closeness"] for r in ranking.ideal_point_closeness(x, "k", [ranking.Criterion("p", F.col("p")), ranking.Criterion("q", F.col("q"))], (0.0, 1.0)).collect()}
    assert got == {"a": 0.0, "b": 1.0}
    y = spark.createDataFrame([("a", 0.0, 1.0), ("b", 4.0, 0.0), ("c", 3.0, 0.5)], "k string, p double, q double")
    got = {r["k"]: r["closeness"] for r in ranking.ideal_point_closeness(y, "k", [ranking.Criterion("p", F.col("p"), 2.0), ranking.Criterion("q", F.col("q"))], (0.0, 1.0)).collect()}
    p, q = 2 / 3 / 5, 1 / 3 / math.sqrt(1.25)
    far, near = math.hypot(1 * p, 0.5 * q), math.hypot(3 * p, 0.5 * q)
    assert got["c"] == pytest.approx(near / (far + near), abs=1e-8)


def test_ties_one_value_and_empty(spark):
    same = quality(spark, [(f"u{i}", "1", 5.0, 0.5, 0.5, 1) for i in range(30)])
    got = ranking.pdf_ranking(same).toPandas()
    assert sorted(got["rank"]) == list(range(1, 31)) and set(got.closeness) == {0.5} and list(got.sort_values("rank").url) == sorted(got.url)
    assert ranking.pdf_ranking(quality(spark, [])).count() == 0


def test_rates():
    r = mixing.repetition_rates({"a": 900, "b": 100}, {"a": (0.5, 5), "b": (0.5, 2)})
    assert r["b"] == 2.0 and r["a"] == pytest.approx(800 / 900)
    r = mixing.repetition_rates({"a": 100, "b": 100}, {"a": (0.25, 3), "b": (0.75, 3)})
    assert (r["a"], r["b"]) == (0.5, 1.5)
    assert mixing.repetition_rates({}, {"a": (1.0, 2)}) == {"a": 0.0} and mixing.repetition_rates({"a": 5}, {}) == {}
    assert mixing.repetition_rates({"a": 10, "b": 10}, {"a": (0.5, 1), "b": (0.5, 1)}, total=1000) == {"a": 1.0, "b": 1.0}


def test_mixture(spark):
    rows = [(i, "word " * 50, "a" if i < 600 else "b", "z") for i in range(800)] + [(900, None, "a", "z"), (901, "x", None, "z"), (902, "x", "other", "z"), (903, "", "b", "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string, tokens string")
    targets = spark.createDataFrame([("a", 0.5, 3, "q"), ("b", 0.5, 3, "q"), ("c", 0.0, 3, "q"), (None, 0.1, 1, "q")], "source string, target_share double, max_repeats int, tokens string")
    m = mixing.Mixture(docs, targets, VOCABULARY)
    report = {r["source"]: r for r in m.report().collect()}
    assert abs(report["a"]["reached_share"] - 0.5) < 0.05 and not report["b"]["capped"] and report["c"]["tokens_emitted"] == 0
    got = mixing.mix(docs, targets, VOCABULARY).toPandas()
    assert got.groupby(["doc_id", "copy_no"]).size().max() == 1 and got.copy_no.max() <= 3 and set(got.source) == {"a", "b"}
    again = mixing.mix(docs, targets, VOCABULARY).toPandas()
    assert sorted(map(tuple, got[["doc_id", "copy_no"]].values)) == sorted(map(tuple, again[["doc_id", "copy_no"]].values))
    assert mixing.mix(docs.limit(0), targets, VOCABULARY).count() == 0 and mixing.mix(docs, targets.limit(0), VOCABULARY).count() == 0
