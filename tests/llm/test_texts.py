import itertools
import random

import pytest
from pyspark.sql import functions as F

from archivolt.llm import fold, language, mojibake, scans, stuffing

EN = "The clerk of the council said that the letter was in the house and that it had been read by all of them. "
FR = "Le greffier du conseil dit que la lettre est dans la maison et que tout le monde ne sait pas ce qui est dit. "


def test_words_fold_alike():
    same = ["Café-\nhaus **ÉTÉ** 12", "cafehaus été 12", "CAFÉHAUS <b>ete</b>, 12"]
    hashes = [fold.Words([t]).hash.tolist() for t in same]
    assert hashes[0] == hashes[1] == hashes[2] and len(hashes[0]) == 3
    w = fold.Words(["a b", "", "c"])
    assert w.doc.tolist() == [0, 0, 2] and len(fold.Words(["手稿"]).hash) == 2
    at, _ = w.windows(w.hash, 2)
    assert at.tolist() == [0] and len(fold.Words([]).hash) == 0


def test_folded_column_agrees_with_words(spark):
    texts = ["Café-\nhaus **ÉTÉ** 12", "手稿 ok", "", "x" * 5000]
    got = [r[0] for r in spark.createDataFrame([(t,) for t in texts], "t string").select(fold.folded(F.col("t"))).collect()]
    assert [fold.Words([a]).hash.tolist() for a in texts] == [fold.Words([b]).hash.tolist() for b in got]


def documents(spark):
    rng = random.Random(1)
    nouns = [f"noun{i}" for i in range(300)]
    data = [(i, EN.replace("letter", rng.choice(nouns)).replace("house", rng.choice(nouns)) + EN.replace("clerk", rng.choice(nouns)), "en") for i in range(60)]
    data += [(100 + i, FR.replace("lettre", rng.choice(nouns)), "fr") for i in range(40)]
    data += [
        (200, "cheap lamp, " * 40, "en"), (201, " ".join(f"#tag{i}" for i in range(40)), None), (202, "\n".join(f"{i}. shop {i} – www.a{i}.example/x" for i in range(30)), "en"),
        (203, EN * 3 + "buy lamp, sale lamp, " * 6, "en"), (204, "lamp desk", "en"), (205, " \n", "en"), (206, None, "en"), (207, "Buy lamp now. Lamp shop price. " * 20, "xx"), (208, "cheap lamp, " * 40, "en"),
    ]
    return spark.createDataFrame([(*r, "a", "b") for r in data], "doc_id long, text string, lang string, t string, words string")


def test_stuffed_texts(spark, rows):
    d = documents(spark)
    assert rows(stuffing.stuffed_documents(d), "doc_id") == [(200,), (201,), (202,), (207,), (208,)]
    assert stuffing.stuffed_documents(d.limit(0)).count() == 0
    shares = {r["doc_id"]: r["stuffed_share"] for r in stuffing.stuffing_shares(d).collect()}
    assert shares[205] is None and 206 not in shares and 0 < shares[203] < 0.75


def test_language_of_labels_and_mixtures(spark, rows):
    es = "El consejo dice que la carta está en la casa y que todos los vecinos saben muy bien lo que se dijo. "
    more = "amber birch cedar dune elm fern gorse heath iris juniper kelp lilac".split()
    data = [(f"e{w}", "english", EN.replace("letter", w), None) for w in more] + [(f"f{w}", "français", FR.replace("lettre", w), None) for w in more] + [(f"s{w}", "es", es.replace("carta", w), None) for w in more]
    data += [("w1", "fr", EN, ""), ("w2", None, FR, EN + "«Lettre maison»."), ("w3", "und", es, EN + es), ("m", "en-GB", EN * 2 + FR, "x"), ("n", "english", None, None), (None, "en", EN, None), ("w1", "fr", EN, "")]
    q = spark.createDataFrame([(u, "1", lab, ex, s, "z") for u, lab, ex, s in data], "url string, scored_at string, ai_language string, excerpt string, ai_summary string, lang string")
    kept, model = language.learned(q)
    got = language.label_findings(kept, model, language.judged(kept, model)).distinct()
    assert rows(got, "url", "field", "lang") == [("m", "excerpt", "en"), ("m", "excerpt", "fr"), ("w1", "ai_language", "en"), ("w2", "ai_language", "fr"), ("w3", "ai_language", "es"), ("w3", "ai_summary", "en"), ("w3", "ai_summary", "es")]
    assert language.judged(*language.learned(q.limit(0))).count() == 0


def test_bloom_filter_has_no_false_negatives():
    h = fold.word_hash([f"w{i}" for i in range(2000)])
    f = language.Filter(["aa", "bb"], [(0, h), (1, h[:100])])
    assert (f.masks(h)[0] & 1).all() and (f.masks(h[:100])[0] == 3).all()
    assert (f.masks(fold.word_hash([f"v{i}" for i in range(2000)]))[0] & 1).mean() < 0.01
    many = language.Filter([f"l{k:02}" for k in range(150)], [(k, h[k * 10 : k * 10 + 10]) for k in range(150)])
    assert len(many.tables) == 3 and all(many._bit(many.masks(h[k * 10 : k * 10 + 10]), k).all() for k in range(150))


def test_unheard_labels_name_their_texts(spark):
    vowels, stems = "aeiou", [f"{a}{b}" for a in "bdfgklmnprstvz" for b in "aeiou"]
    rng = random.Random(9)
    own = lambda: " ".join(rng.choice(stems) + rng.choice(["qvu", "xhi", "wyo"]) for _ in range(40))
    data = [(f"e{i}", "en", EN.replace("letter", rng.choice(stems) * 2)) for i in range(30)] + [(f"x{i}", "Anglo", EN.replace("council", rng.choice(stems))) for i in range(10)] + [(f"k{i}", "Klingon", own()) for i in range(20)] + [("w", "en", own())]
    q = spark.createDataFrame([(u, "1", lab, t, None) for u, lab, t in data], "url string, scored_at string, ai_language string, excerpt string, ai_summary string")
    kept, model = language.learned(q)
    assert model.spellings == {"anglo": "en"} and model.languages == ["en", "klingon"]
    assert [tuple(r) for r in language.label_findings(kept, model, language.judged(kept, model)).collect()] == [("w", "ai_language", "klingon")]


@pytest.mark.parametrize("page", mojibake.READ_AS)
def test_undoing_is_exact(page):
    back = {b: c for c, b in mojibake.code_page(page).items()}
    for text in ("Café été – “x”", "Глава и лес", "السوق"):
        spoilt = "".join(c if ord(c) < 128 else "".join(back[b] for b in c.encode()) for c in text)
        reader = next(r for r in mojibake.READERS if r.name == page)
        assert reader.undo(spoilt, False) == text


def test_titles(spark):
    titles = [f"Café {n}: une histoire d’été" for n in "Rosmir Holmby Garvik Lorne Selby Tamford Quelby Vasmir".split()] + [f"Глава: записки {i}" for i in range(8)] + [f"The letter of {n}" for n in "abcdefgh"]
    bad = {"x1": "CafÃ© Rosmir: une histoire dâ€™Ã©tÃ©", "x2": "Ð“Ð»Ð°Ð²Ð°: Ð·Ð°Ð¿Ð¸ÑÐºÐ¸ 3", "x3": "Caf� Holmby", "x4": "Caf&#195;&#169; Selby: une histoire"}
    data = [(f"u{i}", t) for i, t in enumerate(titles * 1)] + list(bad.items()) + [("n", None), (None, "Café"), ("e", "")]
    q = spark.createDataFrame([(*r, "z") for r in data], "url string, pdf_title string, value string")
    p = spark.createDataFrame([("u1", "caf%C3%A9-rosmir", "z"), ("p1", "caf%C3%83%C2%A9-rosmir", "z")], "url string, path_slug string, value string")
    got = {r["url"]: r for r in mojibake.repaired(q, p).collect()}
    assert set(got) == {"x1", "x2", "x3", "x4", "p1"}
    assert got["x1"]["repaired"] == titles[0] and not got["x3"]["recovered"] and got["p1"]["repaired"] == "café-rosmir"
    assert mojibake.repaired(q.limit(0), p.limit(0)).count() == 0


def test_every_clean_title_counts_in_the_model_and_the_margin(spark):
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abdegilmnorstéüñç") for _ in range(6))
    titles = sorted({f"{word()} é {word()} {word()}" for _ in range(300)})
    q = spark.createDataFrame([(f"u{i}", t, "z") for i, t in enumerate(titles)], "url string, pdf_title string, value string")
    p = spark.createDataFrame([], "url string, path_slug string, value string")
    few, many = (mojibake.Repair(q, p, held_out=n) for n in (3, 1500))
    assert few.margin == many.margin and few.models[-1].mean == many.models[-1].mean
    for repair in (few, many):
        counted = [m.uni.sum() - m.uni[2] for m in repair.models]  # all but the bars
        assert counted[-1] == sum(map(len, titles)) and sum(counted[-1] - n for n in counted[:-1]) == counted[-1]
    told = {r["kind"]: r for r in few.validation().collect()}
    assert told["clean"]["tried"] == 3


def test_furniture_and_cut_words():
    page = "THE OLD MILL   12\nFirst line of a para-\ngraph goes on here.\n\n- 12 -"
    sure, _, header, number = scans.page_furniture(page)
    assert header and number and sure == [0, 4]
    assert scans.page_furniture("It ended in\n1816.")[3] is False
    import numpy as np

    compounds = np.zeros(scans.CELLS, bool)
    compounds[scans.cell("long-lost")] = True
    assert [b - a for a, b in scans.cut_words("a para-\ngraph, long-\nlost", compounds)] == [2]
    for wrong, right, edits in (("rnodern", "modern", 1), ("wmdow", "window", 1), ("g@rclen", "garden", 1), ("c1erk", "clerk", 0), ("rn@rnrn@|!5m", "mammalism", 3), ("garden", "market", None)):
        assert scans.glyph_edits(wrong, right) == edits
        assert edits is None or scans.strokes(wrong) == scans.strokes(right)
    assert scans.collapsed("RFPORT OF THF MlLL") == scans.collapsed("Report of the Mill")


def test_scan_noise_end_to_end(spark, rows):
    rng = random.Random(7)
    nouns = "garden letter bridge market summer kitchen morning teacher window river".split()
    line = lambda: f"the {rng.choice(nouns)} and the {rng.choice(nouns)} were kept in the {rng.choice(nouns)}"
    clean = [(f"c{i}", 1, ". ".join(line() for _ in range(12)) + ".") for i in range(20)]
    body = [f"{line()}. the g@rden and the brid-\nge were kept in the rnarket.", f"{line()}. {line()}."]
    noisy = [("n", i + 1, f"THE OLD MILL   {i + 4}\n{b}") for i, b in enumerate(body)]
    md = spark.createDataFrame([(*r, "z") for r in clean + noisy + noisy + [(None, 1, "x"), ("b", 1, ""), ("k", 1, None)]], "md_path string, page_no int, md_text string, text string")
    q = spark.createDataFrame([("u1", "1", "The Old Bridge Letter", None, "the garden the old bridge letter was kept. the wmdow and the mar- ket were kept — 12 — in the river.", "z"), ("u2", "1", None, None, None, "z")], "url string, scored_at string, pdf_title string, ai_title string, excerpt string, text string")
    noise = scans.ScanNoise(q, md)
    got = rows(noise.found(), "record_key", "page_no", "kind")
    assert got == [("n", 1, "header"), ("n", 1, "hyphen"), ("n", 1, "misread"), ("n", 1, "page_number"), ("n", 2, "header"), ("n", 2, "page_number"), ("u1", 0, "header"), ("u1", 0, "hyphen"), ("u1", 0, "misread"), ("u1", 0, "page_number")]
    text = {r["record_key"]: r["text"] for r in noise.repaired().collect()}
    assert "the garden and the bridge were kept in the market." in text["n"] and "MILL" not in text["n"]
    assert "@" not in text["n"] and text["u1"].startswith("the garden was kept. the window and the market were kept in the river")
    assert scans.ScanNoise(q.limit(0), md.limit(0)).found().count() == 0


def test_every_chain_is_searched():
    def misread(text, page):
        back = {b: c for c, b in mojibake.code_page(page).items()}
        return "".join(c if ord(c) < 128 else "".join(back[b] for b in c.encode()) for c in text)

    readers = {r.name: r for r in mojibake.READERS}
    tried = 0
    for text in ("Café été", "Glück für Öl", "Глава"):
        for chain in itertools.product(mojibake.READ_AS, repeat=3):
            spoilt = text
            for page in chain:
                spoilt = misread(spoilt, page)
            back = spoilt
            for page in chain[::-1]:
                back = readers[page].undo(back, False) or ""
            if back == text:
                tried += 1
                assert text in mojibake.candidates(spoilt, None), (text, chain)
    assert tried > 500


def test_swaps_and_double_byte_pages_after_a_misreading():
    back = {b: c for c, b in mojibake.code_page("cp1252").items()}
    misread = lambda t: "".join(c if ord(c) < 128 else "".join(back[b] for b in c.encode()) for c in t)
    assert "Привет" in mojibake.candidates(misread("Привет".encode("cp1251").decode("cp1252")), None)
    assert "中文" in mojibake.candidates(misread("".join(back[b] for b in "中文".encode("gbk"))), None)


def test_writing_in_a_language_without_function_words_is_no_stuffing(spark, rows):
    es = "El consejo dice que la carta está en la casa. Los vecinos saben muy bien lo que se dijo ayer por la tarde. Nadie sabe quién escribió tales palabras."
    he = "המועצה אמרה כי המכתב נמצא בבית הישן. כל השכנים יודעים היטב מה נאמר אתמול בערב. איש אינו יודע מי כתב את הדברים האלה."
    more = [(300, es, "es"), (301, he, None), (302, he.replace("המכתב", "הספר"), "he"), (303, "manta barata, " * 40, "es"), (304, "שטיח זול, " * 40, None), (305, "cheap lamp, " * 40, None)]
    d = documents(spark).unionByName(spark.createDataFrame([(*r, "a", "b") for r in more], "doc_id long, text string, lang string, t string, words string"))
    assert rows(stuffing.stuffed_documents(d), "doc_id") == [(200,), (201,), (202,), (207,), (208,), (303,), (304,), (305,)]


def test_one_form_that_means_two_words(spark):
    rng = random.Random(8)
    dogs, trees = "puppy kennel bark collar leash paw bone".split(), "branch leaf trunk root forest timber oak".split()
    say = lambda around, word: " ".join([rng.choice(around), rng.choice(around), word, rng.choice(around), rng.choice(around)]) + "."
    clean = [(f"c{i}", 1, " ".join(say(dogs, "tail") for _ in range(10)) + " " + " ".join(say(trees, "tall") for _ in range(12))) for i in range(12)]
    noisy = [("n", 1, say(dogs, "ta1l") + " " + say(trees, "ta1l") + " " + say(dogs, "ta1l"))]
    md = spark.createDataFrame(clean + noisy, "md_path string, page_no int, md_text string")
    q = spark.createDataFrame([], "url string, scored_at string, excerpt string, pdf_title string, ai_title string")
    noise = scans.ScanNoise(q, md)
    got = [r["right"] for r in noise.verdicts.where("record_key = 'n'").orderBy("begin").collect()]
    assert got == ["tail", "tall", "tail"]
    text = noise.repaired().where("record_key = 'n'").first()["text"]
    assert text.count("tail") == 2 and text.count("tall") == 1 and "1" not in text


def test_places_of_words_across_cuts():
    import numpy as np

    text = "a gar-\n den x­y zz"
    plain = scans._CUT.sub("", text)
    assert plain.split() == ["a", "garden", "xy", "zz"]
    assert [text[a:b] for a, b in scans.places_of(text, plain, np.array([1, 2, 3]))] == ["gar-\n den", "x­y", "zz"]


def test_one_phrase_with_a_word_varied_is_stuffing(spark):
    towns = "Selby Tamford Quelby Vasmir Holmby Garvik Lorne Rosmir Calder Fenby Norwick Thorpe Usk Wye Yarm Zeal".split()
    phrase = " ".join(f"You can buy the best cheap red running shoes in {t} from the house of our council." for t in towns)
    d = documents(spark).unionByName(spark.createDataFrame([(400, phrase, "en", "a", "b"), (401, EN * 4, "en", "a", "b")], "doc_id long, text string, lang string, t string, words string"))
    found = {r["doc_id"] for r in stuffing.stuffed_documents(d).collect()}
    assert 400 in found and 401 not in found


def test_thresholds_are_the_languages_own(spark):
    d = documents(spark).select("lang", F.col("text").alias("t"))
    _, _, limits = stuffing.learned(d.where("t IS NOT NULL"))
    assert set(limits) == {"", "en", "fr"} and limits["en"]["top"] >= 0.12
    assert all(0 < limits[k][m] for k in limits for m in ("separators", "links", "digits", "top"))
