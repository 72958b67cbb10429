from pyspark.sql import functions as F

from archivolt.operators import merge as M
from archivolt.streaming import flows as S


def stream(spark, tmp_path, data, schema):
    for i, part in enumerate(data):
        spark.createDataFrame(part, schema).coalesce(1).write.mode("append").parquet(f"{tmp_path}/pages.parquet")
    return S.table_stream(spark, str(tmp_path), "pages", files_per_trigger=1)


def test_each_key_once_over_batches(spark, tmp_path, rows):
    x = stream(spark, tmp_path, [[("a",), ("b",)], [("a",), (None,)], [("b",), ("c",)]], "url string")
    assert rows(S.drained(S.first_seen_once(x, ["url"])), "url") == [("a",), ("b",), ("c",), (None,)]


def test_merge_is_the_same_under_any_batching(spark, tmp_path, rows):
    parts = [[("a", 2), ("b", 1)], [("a", 1), ("c", 5)], [("b", 3), (None, 9)]]
    x = stream(spark, tmp_path, parts, "url string, t int")

    def put(old, batch):
        new = M.last_per_key(batch, ["url"], ["t"])
        return new if old is None else M.last_per_key(old.unionByName(new), ["url"], ["t"])

    assert rows(S.merged(x, put), "url", "t") == [("a", 2), ("b", 3), ("c", 5)]


def test_newest_by_key_and_windows(spark, tmp_path, rows):
    x = stream(spark, tmp_path, [[("a", "1", "x"), ("a", "3", None)], [("a", "2", "y"), ("b", "1", None)]], "url string, o string, v string")
    last = S.drained(S.newest_by_key(x, "url", "o", "v"), "update").groupBy("url").agg(F.max(F.struct("visits", "newest", "v")).alias("m")).select("url", "m.*")
    assert rows(last, "url", "visits", "newest", "v") == [("a", 3, "2", "y"), ("b", 1, None, None)]


def test_a_flow_goes_on_where_it_stopped(spark, tmp_path, rows):
    def put(old, batch):
        new = M.last_per_key(batch, ["url"], ["t"])
        return new if old is None else M.last_per_key(old.unionByName(new), ["url"], ["t"])

    data = f"{tmp_path}/data"
    x = stream(spark, data, [[("a", 2), ("b", 1)], [("c", 5)]], "url string, t int")
    at = f"file://{tmp_path}/state"
    assert rows(S.merged(x, put, at=at, key="url", buckets=3), "url", "t") == [("a", 2), ("b", 1), ("c", 5)]
    seen = f"file://{tmp_path}/seen"
    assert rows(S.drained(S.first_seen_once(x.select("url"), ["url"]), at=seen), "url") == [("a",), ("b",), ("c",)]
    again = stream(spark, data, [[("a", 9), ("d", 1)]], "url string, t int")
    assert rows(S.merged(again, put, at=at, key="url", buckets=3), "url", "t") == [("a", 9), ("b", 1), ("c", 5), ("d", 1)]
    assert rows(S.drained(S.first_seen_once(again.select("url"), ["url"]), at=seen), "url") == [("a",), ("b",), ("c",), ("d",)]
