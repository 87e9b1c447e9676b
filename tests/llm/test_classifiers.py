import random

import pandas as pd

from daybook.llm.language import UNKNOWN, learn_language, predict_language
from daybook.llm.quality import fit_quality, learn_quality, score_quality
from daybook.llm.sampling import labelled_sample, remainder

SOUNDS = {"aa": ("bdg", "aou"), "bb": ("ptk", "ieä"), "cc": ("szj", "yøå")}


def text_in(lang, seed, words=60):
    rng, (c, v) = random.Random(seed), SOUNDS[lang]
    return " ".join("".join(rng.choice(c) + rng.choice(v) for _ in range(rng.randint(1, 3))) for _ in range(words))


def rows_of_languages(n=450):
    return [(i, text_in(sorted(SOUNDS)[i % 3], i), sorted(SOUNDS)[i % 3], "s") for i in range(n)]


def test_language_of_held_out_rows(documents):
    docs = documents(rows_of_languages())
    model = learn_language(docs.where(remainder(4) != 2))
    held = predict_language(docs.where(remainder(4) == 2), model).join(docs.select("doc_id", "lang"), "doc_id")
    rows = held.collect()
    assert len(rows) > 50 and sum(r.lang == r.lang_pred for r in rows) >= 0.98 * len(rows)
    assert all(0 <= r.score <= 1 for r in rows)
    assert 0.5 < (model.weights == 0).mean()


def test_language_of_odd_rows(documents, odd_rows):
    model = learn_language(documents(rows_of_languages(90)))
    found = predict_language(documents(odd_rows), model).collect()
    assert len(found) == len(odd_rows)
    unknown = {r.doc_id for r in found if r.lang_pred == UNKNOWN}
    assert unknown == {2, 3, 4, 8, None}
    assert all(r.score == 0 for r in found if r.lang_pred == UNKNOWN)
    assert predict_language(documents([]), model).count() == 0
    nothing = learn_language(documents([(1, None, "aa", "s"), (2, "text", None, "s")]))
    assert {r.lang_pred for r in predict_language(documents(odd_rows), nothing).collect()} == {UNKNOWN}


def test_scores_do_not_depend_on_neighbours(documents):
    docs = documents(rows_of_languages(60))
    model = learn_language(docs)
    one = {r.doc_id: r.score for r in predict_language(docs.repartition(1), model).collect()}
    many = {r.doc_id: r.score for r in predict_language(docs.repartition(13), model).collect()}
    assert one == many


def quality_rows(prose, n=500):
    rows, labels = [], []
    for i in range(n):
        good = i % 4 != 0
        text = prose(i, 120) if good else " | ".join(prose(i, 60).upper().split(" ")) + " !!! $$$"
        rows.append((i, text, "aa", "s"))
        labels.append((i, int(good), 0))
    return rows, labels


def test_quality(spark, documents, prose):
    rows, labels = quality_rows(prose)
    docs, marks = documents(rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    model = learn_quality(docs, marks, remainder(3) != 1)
    held = score_quality(docs.where(remainder(3) == 1), model).join(marks, "doc_id").collect()
    assert len(held) > 100 and sum((r.score >= 0.5) == r.quality for r in held) >= 0.97 * len(held)


def test_quality_of_odd_rows(spark, documents, odd_rows, prose):
    rows, labels = quality_rows(prose, 120)
    marks = spark.createDataFrame([*labels, (1, None, None), (1, 1, 0), (None, 1, 1)], "doc_id long, quality int, toxic int")
    model = learn_quality(documents(rows), marks, remainder(3) != 1)
    found = score_quality(documents(odd_rows), model).collect()
    assert len(found) == len(odd_rows) and all(0 <= r.score <= 1 for r in found)
    assert score_quality(documents([]), model).count() == 0
    for few in (marks.where("false"), marks.where("quality = 1")):
        plain = learn_quality(documents(rows), few, remainder(3) != 1)
        assert len({r.score for r in score_quality(documents(odd_rows), plain).collect()}) == 1


def test_language_that_only_long_texts_carry(documents):
    rows = rows_of_languages(200)
    rows = [r for r in rows if r[2] != "cc"] + [(1000 + i, text_in("cc", i, 8_000), "cc", "s") for i in range(12)]
    assert min(len(r[1]) for r in rows[-12:]) > 20_000
    tests = documents([(i, text_in(lang, 5000 + i), None, "s") for i, lang in enumerate(sorted(SOUNDS) * 10)])
    for known in (rows, [(i, text_in(sorted(SOUNDS)[i % 3], i, 8_000), sorted(SOUNDS)[i % 3], "s") for i in range(30)]):
        found = predict_language(tests, learn_language(documents(known))).collect()
        right = sum(r.lang_pred == sorted(SOUNDS)[r.doc_id % 3] for r in found)
        assert right >= 29


def test_quality_that_only_long_texts_carry(spark, documents, prose):
    rows, labels = quality_rows(prose, 200)
    rows = [(i, t if i % 4 else " ".join([t] * (25_000 // len(t) + 1)), lang, s) for i, t, lang, s in rows]
    assert all(len(t) > 20_000 for i, t, _, _ in rows if i % 4 == 0)
    docs, marks = documents(rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    model = learn_quality(docs, marks, remainder(3) != 1)
    held = score_quality(docs.where(remainder(3) == 1), model).join(marks, "doc_id").collect()
    assert sum((r.score >= 0.5) == r.quality for r in held) >= 0.97 * len(held)


def test_sample_draws_all_along_a_long_text(documents):
    long = "".join(chr(97 + i // 10_000) for i in range(100_000))
    drawn = labelled_sample(documents([(1, long, "aa", "s"), (2, "short", "aa", "s")]), "lang")
    assert list(drawn["document"]) == [0, 0, 0, 0, 0, 1] and drawn["text"].str.len().max() == 2_000
    assert [long.index(t[0]) // 20_000 for t in drawn["text"][:5]] == [0, 1, 2, 3, 4]
    many = documents([(i, long, "aa", "s") for i in range(200)])
    assert 300_000 < labelled_sample(many, "lang", chars=1_000_000)["text"].str.len().sum() < 2_000_000


def test_quality_of_a_few_labelled_texts(prose):
    good = [prose(i, 120) for i in range(60)]
    bad = [" | ".join(prose(i, 60).upper().split(" ")) + " !!! $$$" for i in range(60)]
    for few in (1, 2, 5):
        for texts in ([(t, 1) for t in good[:40]] + [(t, 0) for t in bad[:few]], [("ab", 1), ("cd", 0)]):
            sample = pd.DataFrame(texts, columns=["text", "quality"]).assign(document=range(len(texts)))
            model = fit_quality(sample)
            assert model.dictionaries is not None
            if len(texts) > 2:
                high, low = (model.scores(t[40:], model.compressors()) for t in (good, bad))
                assert low.max() < high.min()
