from __future__ import annotations

import random
import subprocess
import sys
from pathlib import Path

import public_tokenizers
import pytest
import sentencepiece as library
from tokenizers import Tokenizer

from renalis.llm import sentencepiece as pieces
from renalis.llm import token_counts
from tests.llm.rows import CLASHING, documents, edge_rows, prose

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
MODEL = public_tokenizers.path("piece_bpe_32k.model")
ROOT = Path(__file__).parents[2]


def odd_texts(n: int, seed: int) -> list[str]:
    rng = random.Random(seed)
    pool = "aàéΣσςİıßẞ'sS0९٣½ .,!?\t\n\x0b\x85\xa0​漢字🙂é가<|>▁\x00\x1c"
    return ["".join(rng.choices(pool, k=rng.randint(1, 40))) for _ in range(n)]


HARD = [
    "", "  ", "ΑΣ ΣΑΣ Σ", "a<|endoftext|>b <|startoftext|><|endoftext|>", "<|ENDOFTEXT|>", "a" * 700,
    "it's we'LL I'M 'S'", "##$$%%^^ ----- .....", "🙂" * 40 + "!!!", "<s>hi</s><unk><0x41>",
    " " * 37 + "x" + " " * 40, "the the", "." * 70, "▁x ▁▁ y", prose(3, 4000), "x" * 30_000,
    "a\nb\tc\r\nd", "don't stop",
]


@pytest.fixture(scope="module")
def texts():
    return HARD + odd_texts(1500, 4)


def test_counts_are_those_of_the_library(texts):
    counts = token_counts._Counts(token_counts.prove(VOCABULARY))
    tokenizer = Tokenizer.from_file(VOCABULARY)
    for t in texts:
        want = len(tokenizer.encode(t, add_special_tokens=False).ids)
        assert counts.tokens(t) == want, repr(t[:60])


def test_whole_tokens_are_one_token():
    vocabulary = token_counts.prove(VOCABULARY)
    tokenizer = Tokenizer.from_file(VOCABULARY)
    some = random.Random(1).sample(sorted(vocabulary.whole), 2000)
    found = tokenizer.encode_batch(some, add_special_tokens=False)
    assert len(vocabulary.whole) > 30_000 and all(len(e.ids) == 1 for e in found)


def test_long_strings_are_merged_alike():
    vocabulary = token_counts.prove(VOCABULARY)
    rng = random.Random(2)
    for _ in range(60):
        symbols = vocabulary.symbols("".join(rng.choices("abcdehinorst", k=rng.randint(129, 200))))
        want = token_counts.merged(list(symbols), vocabulary.ranks)
        assert token_counts.merged_long(symbols, vocabulary.ranks) == want


def test_counts_of_edge_rows(spark):
    tokenizer = Tokenizer.from_file(VOCABULARY)
    vocabulary = token_counts.prove(VOCABULARY)
    got = token_counts.count_tokens(documents(spark, edge_rows()), vocabulary).collect()
    for (i, t), r in zip(edge_rows(), got, strict=True):
        n = len(tokenizer.encode(t or "", add_special_tokens=False).ids)
        assert tuple(r) == (i, len((t or "").encode()), n, n > 2048)
    assert token_counts.count_tokens(documents(spark, []), vocabulary).count() == 0


def test_pieces_are_those_of_the_library(texts):
    model = library.SentencePieceProcessor(model_file=MODEL)
    loaded = pieces.load(MODEL)
    for ids, t in zip(pieces.encode_texts(texts, MODEL), texts, strict=True):
        assert ids == model.encode(t), repr(t[:60])
        assert pieces.decode(ids, loaded) == model.decode(ids)


def test_any_ids_are_decoded_as_by_the_library():
    model, loaded = library.SentencePieceProcessor(model_file=MODEL), pieces.load(MODEL)
    rng = random.Random(5)
    for _ in range(400):
        ids = [rng.randrange(3, 300 if rng.random() < 0.7 else 32_000) for _ in range(9)]
        assert pieces.decode(ids, loaded) == model.decode(ids), ids


def test_long_texts_come_in_segments(monkeypatch):
    model = library.SentencePieceProcessor(model_file=MODEL)
    text = prose(8, 3000).replace(" the ", "   the  ")
    segments = list(pieces.segments(text, 500))
    assert len(segments) > 10 and "".join(segments) == pieces.SPACE + text.replace(" ", pieces.SPACE)
    found = [pieces._STRINGS.findall(s) for s in segments]
    encoder = pieces.Encoder(pieces.load(MODEL))
    encoder.learn(s for part in found for s in part)
    assert [i for part in found for s in part for i in encoder[s]] == model.encode(text)


def test_suffix_ranges_are_all_occurrences():
    import numpy as np

    text = "banana bandana"
    code = np.array([ord(c) for c in text])
    order = pieces.suffixes(code, 4)
    words = ["an", "ana", "ban", "x", "d", "nana"]
    patterns = np.zeros((len(words), 4), np.int64)
    for row, w in enumerate(words):
        patterns[row, : len(w)] = [ord(c) for c in w]
    low, high = pieces.ranges(code, order, patterns)
    for w, a, b in zip(words, low, high):
        want = [i for i in range(len(text)) if text.startswith(w, i)]
        assert sorted(order[a:b].tolist()) == want


def test_pieces_of_edge_rows(spark):
    model = library.SentencePieceProcessor(model_file=MODEL)
    docs = documents(spark, edge_rows())
    got = pieces.encode(docs, MODEL).collect()
    for (i, t), r in zip(edge_rows(), got, strict=True):
        assert r.doc_id == i and r.text == t and r.pieces == model.encode(t or "")
        assert r.n_pieces == len(r.pieces)
    assert set(CLASHING) <= set(got[0].asDict())
    trip = pieces.round_trip(docs, MODEL).collect()
    for (i, t), r in zip(edge_rows(), trip, strict=True):
        assert r.doc_id == i and r.same == ("▁" not in (t or ""))
    assert pieces.round_trip(documents(spark, []), MODEL).count() == 0


def test_a_worker_that_encodes_stays_small():
    """Memory beyond that of the model, after 600,000 different strings; a process of its own is measured."""
    code = """
import random, re, sys
from renalis.llm import sentencepiece as pieces
def anonymous():
    text = open("/proc/self/smaps_rollup").read()
    return sum(map(int, re.findall(r"Pss_Anon: +([0-9]+)", text))) // 1024
pieces.encode_texts(["a few words"], sys.argv[1])
before, rng = anonymous(), random.Random(0)
for _ in range(6):
    texts = [" ".join("".join(rng.choices("abcdefghij", k=8)) for _ in range(1000)) for _ in range(100)]
    found = pieces.encode_texts(texts, sys.argv[1])
    assert all(found)
print(anonymous() - before)
"""
    done = subprocess.run(
        [sys.executable, "-c", code, MODEL], cwd=ROOT, capture_output=True, text=True, check=True
    )
    assert int(done.stdout) < 160
