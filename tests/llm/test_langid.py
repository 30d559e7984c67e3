from __future__ import annotations

import os
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from renalis.llm import langid
from tests.llm.rows import CLASHING, documents, edge_rows

SYLLABLES = {"aa": ["ka", "lo", "mi", "ta"], "bb": ["schw", "eit", "ung", "zer"]}


def text(lang: str, seed: int, words: int) -> str:
    rng = random.Random(f"{lang}{seed}")
    return " ".join(
        "".join(rng.choices(SYLLABLES[lang], k=rng.randint(1, 3))) for _ in range(words)
    )


@pytest.fixture(scope="module")
def labelled(spark):
    rows, langs = [], {}
    for i in range(120):
        lang = "aa" if i % 3 else "bb"
        rows.append((i, text(lang, i, 30)))
        langs[i] = lang
    return documents(spark, rows, langs)


@pytest.fixture(scope="module")
def model(labelled):
    return langid.train(labelled)


@pytest.mark.parametrize("lengths", [[1], [32], [5, 70, 1, 33], [64, 2, 31, 129]])
def test_marginals_are_those_of_forward_backward(lengths):
    rng = np.random.default_rng(len(lengths))
    psi = rng.random((sum(lengths), 3)).astype(np.float32) + 0.01
    transitions = rng.normal(size=(3, 3))
    got = langid.marginals(psi, np.array(lengths), transitions)
    a, start = np.exp(transitions), 0
    for n in lengths:
        p = psi[start : start + n].astype(float)
        forward, message = [], np.full(3, 1 / 3)
        for t in range(n):
            message = (message @ a) * p[t]
            message /= message.sum()
            forward.append(message)
        backward = [np.ones(3)]
        for t in range(n - 1, 0, -1):
            backward.insert(0, a @ (p[t] * backward[0]))
            backward[0] /= backward[0].sum()
        want = np.array(forward) * np.array(backward)
        want /= want.sum(1, keepdims=True)
        assert np.allclose(got[start : start + n], want, atol=1e-5)
        start += n


def test_held_out_accuracy(spark, labelled):
    rows = langid.identify(spark, labelled).join(labelled.select("doc_id", "lang"), "doc_id")
    rows = rows.collect()
    for r in rows:
        assert r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1)
        assert 0 <= r.score <= 1
    held = [r for r in rows if r.held_out]
    assert len(held) > 20 and all(r.lang_pred == r.lang for r in held)


def test_nothing_is_learned_from_held_out_rows(labelled, model):
    spoiled = labelled.withColumn(
        "lang", F.when(langid.held_out(), F.lit("zz")).otherwise(F.col("lang"))
    )
    again = langid.train(spoiled)
    assert again.labels == model.labels and np.array_equal(again.weights, model.weights)


def test_code_switched_text_is_labelled_by_word(spark, model):
    mixed = text("aa", 900, 40) + " " + text("bb", 901, 40) + " " + text("aa", 902, 40)
    row = langid.label_words(documents(spark, [(1, mixed)]), model).first()
    want = ["aa"] * 40 + ["bb"] * 40 + ["aa"] * 40
    assert sum(x == y for x, y in zip(row.labels, want)) >= 117
    assert model.transitions[0, 0] > model.transitions[0, 1]


def test_edge_rows(spark, labelled, model):
    docs = documents(spark, edge_rows(), {1: "aa"})
    rows = langid.predict(docs, model).collect()
    assert len(rows) == len(edge_rows())
    texts = {}
    for (i, t), r in zip(edge_rows(), rows):
        assert r.doc_id == i
        if not any(c.isalpha() for c in t or ""):
            assert (r.lang_pred, r.score, r.n_words) == ("und", 0.0, 0)
        else:
            assert r.lang_pred in model.labels
            assert texts.setdefault(t, (r.lang_pred, round(r.score, 5))) == (
                r.lang_pred, round(r.score, 5),
            )


def test_empty_table_and_nothing_to_learn(spark, labelled):
    assert langid.identify(spark, labelled.limit(0)).count() == 0
    nothing = documents(spark, [(1, "some words"), (2, "other words")])
    assert {r.lang_pred for r in langid.identify(spark, nothing).collect()} == {"und"}


def test_rejected_documents_go_and_columns_stay(spark, labelled):
    more = labelled.unionByName(documents(spark, [(500, "123 !!!"), (501, None)]))
    kept = langid.keep_identified(more, 0.3)
    assert kept.columns == more.columns and set(CLASHING) <= set(kept.columns)
    assert sorted(r.doc_id for r in kept.select("doc_id").collect()) == list(range(120))


FOREIGN = [
    "Все люди рождаются свободными и равными в своём достоинстве и правах.",
    "人人生而自由，在尊严和权利上一律平等。", "Όλοι οι άνθρωποι γεννιούνται ελεύθεροι", "Привет",
    "Kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan.",
    "Wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw.",
    "Bütün insanlar hür, haysiyet ve haklar bakımından eşit doğarlar.",
]


def test_texts_in_languages_not_learned_go(spark, labelled):
    mixed = text("aa", 700, 60) + " " + FOREIGN[0] + " " + text("bb", 701, 60)
    clean = [(600 + i, text(("aa", "bb")[i % 2], 600 + i, 1 + i)) for i in range(40)]
    clean.append((640, text("aa", 640, 9) + " 2abc3ff2ca8fb1e4c565a0eb63815530a948bdde"))
    foreign = [(800 + i, t * n) for i, (t, n) in enumerate((t, n) for t in FOREIGN for n in (1, 40))]
    more = labelled.unionByName(documents(spark, [*clean, (700, mixed), *foreign]))
    kept = langid.keep_identified(more, 0.3)
    got = sorted(r.doc_id for r in kept.select("doc_id").collect())
    assert got == [*range(120), *range(600, 641), 700]


def test_rejection_on_the_test_tables(spark):
    """Nothing of the learned languages goes, and all of the foreign texts do."""
    path = "/root/testdata/sf0.01/documents.parquet"
    if not os.path.exists(path):
        pytest.skip("no test tables")
    docs = spark.read.parquet(path).select("doc_id", "text", "lang")
    foreign = spark.createDataFrame(
        [(-1 - i, t, None) for i, t in enumerate(FOREIGN)], docs.schema
    )
    want = docs.filter(F.col("text").rlike("[a-zA-ZäöüÄÖÜßñÑéèêçÉÈÊÇíóáúÍÓÁÚ]"))
    kept = langid.keep_identified(docs.unionByName(foreign), 0.3)
    ids = [sorted(r.doc_id for r in x.select("doc_id").collect()) for x in (kept, want)]
    assert ids[0] == ids[1]
