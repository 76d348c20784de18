import itertools
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from lumenframe.llm import language


def test_best_path_equals_all_paths():
    rng = np.random.default_rng(2)
    for _ in range(200):
        n, k = int(rng.integers(1, 7)), int(rng.integers(1, 4))
        scores, penalty = rng.normal(0, 2, (n, k)), float(rng.uniform(0, 4))
        value = lambda p: sum(scores[i, x] for i, x in enumerate(p)) - penalty * sum(a != b for a, b in zip(p, p[1:]))
        labels, starts = language.best_path(scores, penalty)
        path = np.repeat(labels, np.diff(np.append(starts, n)))
        assert value(path) == pytest.approx(max(map(value, itertools.product(range(k), repeat=n))))


def test_a_switch_inside_a_run_of_one_best_label():
    scores = np.array([(0, -20, -20), (-1, -11, 0), (-11, -1, 0), (-20, 0, -20)], float)
    labels, starts = language.best_path(scores, 8.0)
    assert (labels.tolist(), starts.tolist()) == ([0, 1], [0, 2])
    rng = np.random.default_rng(3)
    for _ in range(300):
        n, k, penalty = 6, 4, float(rng.uniform(2, 9))
        # a third label is best in the middle, related ones close behind
        scores = rng.uniform(-12, 0, (n, k))
        scores[1:-1, 2] = 0
        value = lambda p: sum(scores[i, x] for i, x in enumerate(p)) - penalty * sum(a != b for a, b in zip(p, p[1:]))
        labels, starts = language.best_path(scores, penalty)
        path = np.repeat(labels, np.diff(np.append(starts, n)))
        assert value(path) == pytest.approx(max(map(value, itertools.product(range(k), repeat=n))))


def test_held_out_accuracy_and_spans(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    got = language.identify_held_out(docs).join(docs.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert np.mean([r.lang_pred == r.lang for r in got]) > 0.98
    model = language.learn(docs)
    rows = {r.lang: r.text for r in docs.where("length(text) BETWEEN 500 AND 900 AND text NOT LIKE '%|%'").collect()}
    a, b = rows["de"], rows["fr"]
    spans, top, share = model.label(a + "\n" + b)
    assert [s[2] for s in spans] == ["de", "fr"] and abs(spans[1][0] - len(a)) < 40
    assert top in ("de", "fr") and 0.3 < share < 0.9


def test_scripts_narrow_the_candidates(spark, make_docs):
    rng = random.Random(1)
    make = lambda letters: " ".join("".join(rng.choices(letters, k=5)) for _ in range(30))
    rows = [(i, make("абвгд"), "s", "ru") for i in range(5)] + [(i + 9, make("abcde"), "s", "en") for i in range(5)]
    model = language.learn(make_docs(rows + [(90, "x", "s", None), (91, None, "s", "en"), (92, "", "s", "el")]))
    assert model.names == ("en", "ru")
    spans, top, _ = model.label("zzz qqq жжж ффф ххх ззз")
    assert [s[2] for s in spans] == ["en", "ru"] and top == "ru"
    assert model.label("漢字")[1] in model.names and model.label("12 -- !")[1:] == ("und", 0.0)


def test_a_rare_language_keeps_its_rows(make_docs):
    rows = [(i, f"abc abd{i}", "s", "en") for i in range(3000)] + [(5000 + i, "жук жаба", "s", "ru") for i in range(3)]
    model = language.learn(make_docs(rows), most=20)
    whole = language.learn(make_docs(rows[3000:]))
    assert model.names == ("en", "ru") and np.array_equal(model.logs[:, 1], whole.logs[:, 0])
    assert model.label("жук жаба")[1] == "ru"


def test_nulls_long_texts_and_empty_tables(make_docs):
    docs = make_docs([(None, None, "s", "a"), (1, "", "s", None), (2, "ab " * 500_000, "s", "a"), (3, "y" * 900_000, "s", "b"), (3, "İ ab", "s", "a")])
    docs = docs.withColumn("spans", F.lit(0)).withColumn("score", F.lit("x"))
    got = language.identify(docs, language.learn(docs)).collect()
    assert [r.lang_pred for r in got] == ["und", "und", "a", "b", "a"]
    assert {r.lang_pred for r in language.identify(docs, language.learn(docs.limit(0))).collect()} == {"und"}
    assert language.identify(docs.limit(0), language.learn(docs)).collect() == []
    few = language.learn(docs, most=1)
    assert set(few.names) <= {"a", "b"}


@pytest.mark.parametrize("word", ["हिन्दी", "தமிழ்நாடு", "नि", "été"])
def test_long_texts_are_cut_between_words(word):
    for shift in range(len(word) + 1):
        text = "x" * shift + " " + (word + " ") * (language._PART // (len(word) + 1) + 50)
        parts = list(language._parts(text))
        assert len(parts) > 1 and "".join(parts) == text
        whole = language._words(text)
        each = [language._words(p) for p in parts]
        assert sum(len(e[1]) for e in each) == len(whole[1])
        assert np.array_equal(np.concatenate([e[0] for e in each]), whole[0])


def test_too_many_languages_are_refused(make_docs):
    docs = make_docs([(i, "some words", "s", f"l{i}") for i in range(30)])
    assert len(language.learn(docs).names) == 30
    with pytest.raises(ValueError, match="more than 20"):
        language.learn(docs, most_languages=20)
