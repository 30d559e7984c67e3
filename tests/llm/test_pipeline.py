from __future__ import annotations

import os

import public_tokenizers
import pytest
import sentencepiece as library

import corpus_pipeline
from renalis.llm import pii
from tests.llm.rows import CLASHING, documents, edge_rows, prose
from tests.llm.test_near_dedup import components_by_definition, edited

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no test tables")


def test_stages_by_brute_force(spark, work):
    item = spark.read.parquet(f"{SF}/benchmark.parquet").first().text
    texts = [(i, prose(i, 60)) for i in range(40)]
    texts += [(50, prose(3, 60)), (51, edited(prose(4, 300), 0.01, 1)), (52, prose(4, 300))]
    texts += [(60, prose(61, 40) + " " + item), (61, "12345 !!!"), (62, None)]
    texts += [(70, prose(70, 30) + " mail me@example.com or me (at) example (dot) org")]
    docs = documents(spark, texts, {i: "en" if i % 4 else "de" for i, _ in texts})
    expected = dict(texts)
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES:
        docs = work.cut(stage(spark, docs, SF), name)
        if name == "language":
            expected = {i: t for i, t in expected.items() if i not in (61, 62)}
        elif name == "near_duplicates":
            found = components_by_definition(sorted(expected.items()), size=5)
            expected = {i: t for i, t in expected.items() if found[i][1] == i}
            assert 50 not in expected and 52 not in expected
        elif name == "decontaminate":
            del expected[60]
        elif name == "mask_personal_data":
            expected = {i: pii.masked(t, pii.spans_of(t)[1]) for i, t in expected.items()}
            assert expected[70].endswith("mail <EMAIL> or <EMAIL>")
            assert all(r.n_chars == len(r.text) for r in docs.collect())
        else:
            model = library.SentencePieceProcessor(
                model_file=public_tokenizers.path("piece_bpe_32k.model")
            )
            rows = {r.doc_id: r for r in docs.drop(*set(CLASHING) - {"pieces"}).collect()}
            assert {i: r.pieces for i, r in rows.items()} == {
                i: model.encode(t) for i, t in expected.items()
            }
            break
        assert docs.columns == columns
        assert {r.doc_id: r.text for r in docs.collect()} == expected, name


def test_edge_rows_and_empty_tables(spark, work):
    for rows in ([], edge_rows()):
        docs = documents(spark, rows, {1: "en", 9: "de"})
        for name, stage in corpus_pipeline.STAGES:
            docs = work.cut(stage(spark, docs, SF), name)
        assert docs.count() <= len(rows)


def test_run(spark):
    got = corpus_pipeline.run(spark, SF)
    assert 100 < got.count() <= 200 and {"doc_id", "text", "pieces"} <= set(got.columns)
