import random
import uuid

from pyspark.sql import functions as F

from archivolt.llm import neardup_index as N

QUEUE = "queue_id long, batch_no int, url string, content_hash string, sample_text string, digest string"
PAGES = "url string, last_seen_at string, content_hash string"


def words(rng, n):
    return ["".join(rng.choice("abcdefghij") for _ in range(5)) for _ in range(n)]


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], last + 1 if x == y else max(row[j], row[j - 1])
    return row[-1]


def run(spark, tmp_path, data, pages=()):
    q = spark.createDataFrame([(*r, "z") for r in data], QUEUE)
    return N.queue_duplicates(q, spark.createDataFrame(list(pages), PAGES), f"file://{tmp_path}/{uuid.uuid4().hex}")


def test_common_subsequence_is_exact():
    rng = random.Random(1)
    for _ in range(50):
        a, b = [rng.randint(0, 5) for _ in range(rng.randint(0, 20))], [rng.randint(0, 5) for _ in range(rng.randint(0, 20))]
        assert N._common_subsequence(a, b) == lcs(a, b)


def test_digests_texts_and_pages(spark, tmp_path, rows):
    rng = random.Random(2)
    t = words(rng, 60)
    near = [w if i % 8 else "other" for i, w in enumerate(t)]
    opening = t[:25] + words(rng, 35)
    data = [
        (1, 0, "u1", "sha256:AA", None), (2, 0, "u2", None, " ".join(t)), (3, 1, "u3", "aa", None), (4, 1, "u4", None, None), (5, 1, "u5", None, " ".join(near).upper()),
        (6, 2, "u6", None, " ".join(opening)), (7, 2, "u7", None, None), (7, 2, "u7", None, None), (8, 2, "u8", None, ""), (9, 2, "u9", None, "ab cd"), (10, 3, "u10", None, "Ab, cd!"), (11, None, "u11", "bb", None), (12, 3, "u12", "BB", None),
        (None, 3, "u1", "aa", None),
    ]
    got = run(spark, tmp_path, data, [("u4", "1", "aa"), ("u4", "0", "zz"), ("u7", "1", None)])
    assert rows(got, "dup_id", "first_id") == sorted([(3, 1), (4, 1), (5, 2), (10, 9), (12, 11)], key=lambda r: str(r[0]))


def test_against_brute_force_and_batch_by_batch(spark, tmp_path, rows):
    rng = random.Random(3)
    base = [words(rng, rng.randint(30, 60)) for _ in range(12)]
    data = []
    for i in range(80):
        x = list(rng.choice(base))
        for _ in range(rng.choice([0, 0, 2, 4, 9, 20])):
            x[rng.randrange(len(x))] = words(rng, 1)[0]
        data.append((i, rng.randint(0, 4), f"u{i}", None, " ".join(x)))
    order = sorted(data, key=lambda r: (r[1], r[0]))
    want, sure = {}, set()
    for k, r in enumerate(order):
        for s in order[:k]:
            a, b = r[4].split(), s[4].split()
            agree = lcs(a, b) / max(len(a), len(b))
            if agree >= 5 / 6:
                want.setdefault(r[0], s[0])
            if 0.8 <= agree < 5 / 6:
                sure.add(r[0])
    got = dict(rows(run(spark, tmp_path, data), "dup_id", "first_id"))
    for k in {r[0] for r in data} - sure:
        assert got.get(k) == want.get(k)
    q = N.queue_rows(spark.createDataFrame([(*r, "z") for r in data], QUEUE), spark.createDataFrame([], PAGES))
    index = N.RareShingleIndex(spark, f"file://{tmp_path}/steps")
    parts = [index.accept(q.where(F.col("batch_no") == b)) for b in range(5)]
    step = {r["row_id"]: r["id"] for p in parts for r in p.select("row_id", N.queue_id_of(F.col("first")).alias("id")).collect()}
    assert step == got


def test_one_text_for_most_rows(spark, tmp_path):
    rng = random.Random(4)
    t = " ".join(words(rng, 50))
    data = [(i, i % 3, f"u{i}", None, t if i % 2 else " ".join(words(rng, 50))) for i in range(300)]
    got = run(spark, tmp_path, data)
    assert got.count() == 149 and got.select("first_id").distinct().count() == 1


def test_empty(spark, tmp_path):
    assert run(spark, tmp_path, []).count() == 0


def test_spread_differences_down_to_four_fifths(spark, tmp_path):
    rng = random.Random(5)
    history, batch, want = [], [], {}

    def pair(a, b):
        k = len(history)
        history.append((k, 0, f"u{k}", None, " ".join(a)))
        batch.append((1000 + k, 1, f"v{k}", None, " ".join(b)))
        if lcs(a, b) / max(len(a), len(b)) >= 0.8:
            want[1000 + k] = k

    for changed in (15, 16, 17, 18, 19, 20, 21, 24):  # misreads spread over 100 words
        for _ in range(3):
            a = words(rng, 100)
            at = {int((i + rng.random()) * 100 / changed) for i in range(changed)}
            pair(a, [words(rng, 1)[0] if i in at else w for i, w in enumerate(a)])
    for lacks in (10, 15, 20, 25):  # each copy lacks other words, spread
        for _ in range(3):
            a = words(rng, 100)
            drop = rng.sample(range(100), 2 * lacks)
            one, other = set(drop[::2]), set(drop[1::2])
            pair([w for i, w in enumerate(a) if i not in one], [w for i, w in enumerate(a) if i not in other])
    for n in range(4, 16):  # short texts, one word less or more
        for turn in (1, -1):
            a = words(rng, n)
            i = rng.randrange(n)
            pair(*[a, a[:i] + a[i + 1 :]][::turn])
    for more in (5, 10, 20, 25, 30):  # words put in
        a = words(rng, 100)
        b = list(a)
        for _ in range(more):
            b.insert(rng.randint(0, len(b)), words(rng, 1)[0])
        pair(a, b)
    got = {r["dup_id"]: r["first_id"] for r in run(spark, tmp_path, history + batch).collect()}
    assert len(want) > 40 and got == want


def test_pairs_of_hot_words_find_all_that_agree_and_leave_unlike_texts(spark, tmp_path, rows):
    rng = random.Random(6)
    stock = words(rng, 60)  # few words, so that unlike texts share most of theirs
    data, want = [], {}
    for k in range(120):
        n = rng.choice([6, 15, 17, 18, 20, 23, 40, 60, 90, 110, 130])
        a = [rng.choice(stock) for _ in range(n)]
        b = list(a)
        for _ in range(rng.randint(0, n // 6)):
            i = rng.randrange(len(b))
            rng.choice([lambda i=i: b.__setitem__(i, rng.choice(stock)), lambda i=i: b.pop(i), lambda i=i: b.insert(i, rng.choice(stock))])()
        data += [(k, 0, f"u{k}", None, " ".join(a)), (1000 + k, 1, f"v{k}", None, " ".join(b))]
    order = sorted(data, key=lambda r: (r[1], r[0]))
    for i, r in enumerate(order):
        for s in order[:i]:
            a, b = r[4].split(), s[4].split()
            if r[0] not in want and lcs(a, b) / max(len(a), len(b)) >= 0.8:
                want[r[0]] = s[0]
    q = N.queue_rows(spark.createDataFrame([(*r, "z") for r in data], QUEUE), spark.createDataFrame([], PAGES))
    for hot in (3, 10**9):
        index = N.RareShingleIndex(spark, f"file://{tmp_path}/{uuid.uuid4().hex}", hot=hot)
        met, pairs = [], index._pairs
        index._pairs = lambda *x, pairs=pairs, met=met: met.append(pairs(*x)) or met[-1]
        parts = [index.accept(q.where(F.col("batch_no") == b)) for b in range(2)]
        got = {r["row_id"]: r["id"] for p in parts for r in p.select("row_id", N.queue_id_of(F.col("first")).alias("id")).collect()}
        assert got == want and len(want) >= 100
        assert sum(m.count() for m in met) < 4 * len(want)  # of 28,000 pairs, most of which share a rare word


def test_history_is_gone_through_in_growing_parts_not_once_a_batch(spark, tmp_path):
    rng = random.Random(7)
    t = [" ".join(words(rng, 30)) for _ in range(20)]
    got = run(spark, tmp_path, [(i, i // 10, f"u{i}", None, t[i % 20]) for i in range(60)])
    assert got.count() == 40 and len(list(tmp_path.glob("*/near/batch=*"))) == 1


def test_frequent_keys_are_split_and_still_meet():
    rng = random.Random(8)
    a = N.tokens_of(N.np.array([rng.randrange(10**6) for _ in range(60)]))
    level = N.np.full(N.CELLS, 1 + 8 * 20, N.np.int16)  # 2^20 occurrences each
    (k1, o1), (k2, o2) = (N.keys_of(a, (level, 1 << 20), 0.8, N.HOT, salt) for salt in (1, 2))
    assert len(o1) and set(k1) <= {*k2, *o2} and set(k2) <= {*k1, *o1} and set(k1) != set(k2)
