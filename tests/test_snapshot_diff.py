import random

from archivolt.operators.snapshot_diff import sitemap_changes

LISTING = "domain string, snapshot_no int, url string, lastmod string, removed int, last_seen_at string, loaded_at string, slot string, key string"
DELIVERED = "domain string, snapshot_no int, taken_at string"


def listing(spark, data):
    return spark.createDataFrame([(*r, "x", "y") for r in data], LISTING)


def test_kinds_gaps_and_repeats(spark, rows):
    a = [
        ("d", 1, "u1", "2025-01-01", 0, "a", "a"), ("d", 1, "u2", "2025-01-01", 0, "a", "a"), ("d", 1, "u3", None, 0, "a", "a"), ("d", 1, "u4", "2025-01-01T00:00:00Z", 0, "a", "a"),
        # snapshot 2 was never delivered; 3 follows 1
        ("d", 3, "u1", "Wed, 01 Jan 2025 00:00:00 GMT", 0, "b", "b"), ("d", 3, "u1", "2020-01-01", 0, "a", "b"), ("d", 3, "u3", "2025-02-01", 0, "b", "b"), ("d", 3, "u4", "", 0, "b", "b"),
        ("d", 3, "u4", "", 0, "b", "b"), ("d", 3, "u5", "bad", 0, "b", "b"), ("d", 3, "u2", "2025-01-01", 1, "b", "b"),
        (None, 3, "u9", None, 0, "b", "b"), ("d", 3, None, None, 0, "b", "b"), ("d", 2, "u7", None, 0, "b", "b"),
    ]
    got = sitemap_changes(listing(spark, a), spark.createDataFrame([("d", 1, "t"), ("d", 3, "t"), ("e", 1, "t")], DELIVERED))
    assert rows(got, "snapshot_no", "url", "change_kind") == [(3, "u2", "removed"), (3, "u3", "changed"), (3, "u5", "added")]


def test_delivered_but_empty_removes_all(spark, rows):
    got = sitemap_changes(listing(spark, [("d", 1, "u", None, 0, "a", "a")]), spark.createDataFrame([("d", 1, "t"), ("d", 2, "t")], DELIVERED))
    assert rows(got, "snapshot_no", "url", "change_kind") == [(2, "u", "removed")]


def test_empty_tables(spark):
    assert sitemap_changes(listing(spark, []), spark.createDataFrame([], DELIVERED)).count() == 0


def test_against_brute_force_with_small_chunks_and_slots(spark, rows):
    rng = random.Random(5)
    data, state = [], {}
    for n in range(1, 6):
        for u in range(120):
            if rng.random() < 0.1:
                state.pop(u, None)
            elif rng.random() < 0.2 or (n == 1 and rng.random() < 0.8):
                state[u] = f"2025-01-{rng.randint(1, 28):02d}"
        data.append(dict(state))
    listed = [("d", n + 1, f"u{u}", m, 0, "a", "a") for n, s in enumerate(data) for u, m in s.items()]
    want = []
    for n in range(1, 5):
        old, new = data[n - 1], data[n]
        want += [(n + 1, f"u{u}", "added") for u in new.keys() - old.keys()] + [(n + 1, f"u{u}", "removed") for u in old.keys() - new.keys()]
        want += [(n + 1, f"u{u}", "changed") for u in new.keys() & old.keys() if new[u] != old[u]]
    for chunk, slot in ((1, 7), (4, 10), (16, 1000)):
        got = sitemap_changes(listing(spark, listed), spark.createDataFrame([("d", n, "t") for n in range(1, 6)], DELIVERED), chunk, slot)
        assert rows(got, "snapshot_no", "url", "change_kind") == sorted(want, key=lambda t: [(False, str(x)) for x in t])
