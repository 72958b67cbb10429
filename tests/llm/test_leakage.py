import random

from archivolt.llm import leakage

WORDS = [f"{a}{b}" for a in ("gar", "lor", "mon", "tel", "ris", "vol", "sun", "per") for b in ("den", "ket", "mer", "tal", "nis", "dor", "val", "tem")]


def prose(rng, n):
    return [rng.choice(WORDS) for _ in range(n)]


def docs(spark, data):
    return spark.createDataFrame([(i, t, "x", "y") for i, t in data], "doc_id long, text string, item_id string, t string")


def items(spark, data):
    return spark.createDataFrame(data, "item_id long, text string")


def test_forms_of_a_leak(spark, rows):
    rng = random.Random(1)
    p = prose(rng, 60)
    other = prose(rng, 40)
    cut = " ".join(p[:24])
    edited = list(p)
    for i in (8, 25, 42):
        edited[i] = "zzz"
    data = [
        (1, "Intro. " + " ".join(p) + " end."), (2, " ".join(other) + " " + cut.upper() + ". more"), (3, " ".join(p[:19])), (4, " ".join(edited)),
        (5, "\n".join(w[:2] + "-\n" + w[2:] for w in p)), (6, "<b>" + "</b> *".join(p)), (7, " ".join(w.replace("e", "é") for w in p)),
        (8, " ".join(other)), (9, None), (10, ""), (11, "Do it so."), (1, "Intro. " + " ".join(p) + " end."),
    ]
    got = leakage.leaks(docs(spark, data), items(spark, [(100, "Do it so.\n" + " ".join(p)), (101, "Do it so.\n" + " ".join(prose(rng, 60))), (102, None)]))
    assert rows(got.select("doc_id", "item_id").distinct(), "doc_id", "item_id") == sorted([(i, 100) for i in (1, 2, 4, 5, 6, 7)], key=lambda t: str(t[0]))


def test_consistent_replacement_counts_and_inconsistent_does_not(spark, rows):
    text = "the clerk of Holmby sold {0} books to the mayor of Garby while the mayor of Garby asked the clerk of Holmby for {0} letters and many other things that nobody wanted to keep in that old house near the river"
    item = text.format(12)
    fine = text.format(77).replace("Holmby", "Quelwick").replace("Garby", "Rosford")
    got = leakage.leaks(docs(spark, [(1, fine)]), items(spark, [(5, item)]), run=30, share=0.95)
    assert rows(got, "doc_id", "item_id", "kind") == [(1, 5, "reparameterised")]
    mixed = text.format(77).replace("Holmby", "Quelwick", 1).replace("Garby", "Rosford")
    assert leakage.leaks(docs(spark, [(1, mixed)]), items(spark, [(5, item)]), run=30, share=0.97).count() == 0


def test_many_items_and_empty_tables(spark, rows):
    rng = random.Random(2)
    p = [prose(rng, 40) for _ in range(7)]
    d = docs(spark, [(i, " ".join(x)) for i, x in enumerate(p)])
    b = items(spark, [(10 + i, " ".join(x)) for i, x in enumerate(p)])
    want = [(i, 10 + i) for i in range(7)]
    assert rows(leakage.leaks(d, b).select("doc_id", "item_id"), "doc_id", "item_id") == want
    assert leakage.leaks(d.limit(0), b).count() == 0 and leakage.leaks(d, b.limit(0)).count() == 0
    assert leakage.leaked_items(leakage.leaks(d, b)).count() == 7


def test_very_long_text(spark):
    rng = random.Random(3)
    p = prose(rng, 50)
    long = " ".join(prose(rng, 200_000)) + " " + " ".join(p)
    assert leakage.leaks(docs(spark, [(1, long)]), items(spark, [(1, " ".join(p))])).count() == 1


def test_short_passages_and_spread_replacements(spark, rows):
    rng = random.Random(4)
    short = {n: prose(rng, n) for n in range(3, 20)}
    data, bench, want = [], [], set()
    for n, p in short.items():
        data.append((n, " ".join(prose(rng, 30) + p + prose(rng, 30))))
        bench.append((100 + n, " ".join(p)))
        want.add((n, 100 + n))
    for n in (20, 25, 33, 40, 60, 100):
        p = prose(rng, n)
        bench.append((1000 + n, " ".join(p)))
        for k in {1, 2, n // 10, n // 5 - 1}:  # replaced words, spread evenly
            x = list(p)
            for i in range(k):
                x[(i + 1) * n // (k + 1)] = f"zz{i}"
            covered = sum(len(r) for r in " ".join("|" if w.startswith("zz") else w for w in x).split("|") for r in [r.split()] if len(r) >= 3)
            if covered >= 0.8 * n:
                data.append((1000 * n + k, " ".join(prose(rng, 10) + x + prose(rng, 10))))
                want.add((1000 * n + k, 1000 + n))
        data.append((1000 * n + 999, " ".join(p[: n // 2 - 1][:19])))
    got = {tuple(r) for r in leakage.leaks(docs(spark, data), items(spark, bench)).select("doc_id", "item_id").collect()}
    assert want <= got and not any(d % 1000 == 999 for d, i in got if i >= 1000)


def test_words_put_in_and_copies_of_items(spark, rows):
    rng = random.Random(5)
    p = prose(rng, 40)
    more = p[:10] + ["zz"] + p[10:19] + ["yy"] + p[19:30] + ["xx"] + p[30:]
    got = leakage.leaks(docs(spark, [(1, " ".join(more)), (1, "other"), (2, " ".join(p * 3))]), items(spark, [(7, " ".join(p)), (8, " ".join(p))]))
    assert rows(got, "doc_id", "item_id") == [(1, 7), (1, 8), (2, 7), (2, 8)]


def test_names_of_scripts_without_capitals(spark, rows):
    common = ["كان", "في", "هذا", "من", "على", "الذي", "بعد", "قبل", "كل", "ثم"]
    rng = random.Random(6)
    first = [rng.choice(common) for _ in range(30)]
    item = list(first)
    item[5] = item[20] = "محمد"
    item[12] = "دمشق"
    swap = {"محمد": "خالد", "دمشق": "بغداد"}
    bench = [(1, " ".join(item)), (2, " ".join(first)), (3, " ".join(reversed(first)))]
    found = leakage.leaks(docs(spark, [(9, " ".join(swap.get(w, w) for w in item))]), items(spark, bench), run=25, share=0.97)
    assert (9, 1, "reparameterised") in rows(found, "doc_id", "item_id", "kind")
