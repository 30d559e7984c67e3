from __future__ import annotations

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from renalis.llm import bytebpe
from tests.llm.rows import by_id, documents, edge_rows, prose

PATH = public_tokenizers.path("byte_bpe_50k.tiktoken")


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bytebpe.load_ranks(PATH),
        special_tokens={},
    )


def ids_of(spark, work, rows, **more):
    docs = documents(spark, rows)
    return by_id(bytebpe.encode(docs, PATH, work, **more))


def test_merges_are_those_of_the_library(library):
    ranks = bytebpe.load_ranks(PATH)
    rng = random.Random(4)
    for n in [1, 2, 3, 8, 95, 96, 97, 200, 3000]:
        for letters in ["ab", "theing", "é漢x", "\t"]:  # one pre-token each
            word = "".join(rng.choice(letters) for _ in range(n))
            assert bytebpe.merge(word.encode(), ranks) == library.encode_ordinary(word)


def test_integers_come_back():
    rng = np.random.default_rng(1)
    for arrays in [
        [np.empty(0, np.int64)],
        [np.array([0, 127, 128, 16383, 16384, (1 << 21) - 1, 1 << 21, (1 << 28) - 1])],
        [rng.integers(0, 1 << 20, 1000), np.empty(0, np.int64), rng.integers(0, 50, 7)],
    ]:
        back = bytebpe._unpacked(bytebpe._packed(*arrays), len(arrays))
        assert all((a == b).all() and len(a) == len(b) for a, b in zip(arrays, back))
    words = [b"", b"a", "é".encode(), b"\x00", b"word" * 100]
    assert bytebpe._unpacked_words(bytebpe._packed_words(words)) == words


def test_edge_rows(spark, work, library):
    found = ids_of(spark, work, edge_rows())
    wanted = {}
    for i, text in edge_rows():
        wanted.setdefault(i, []).append(library.encode_ordinary(text or ""))
    assert found.keys() == wanted.keys()
    for i, lists in wanted.items():
        assert sorted(list(r.ids) for r in found[i]) == sorted(lists)


def test_white_space_and_all_characters(spark, work, library):
    rng = random.Random(7)
    odd = [" ", "  ", "\n", " \n", "\t", "\x1c", " \x1f ", "\xa0", "'s", "'LL", "a", "b7", "é", "!", "…", "½", "​"]
    texts = ["".join(rng.choice(odd) for _ in range(rng.randint(1, 60))) for _ in range(400)]
    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    texts += ["".join(map(chr, points[i : i + 40_000])) for i in range(0, len(points), 40_000)]
    texts += ["<|endoftext|>", " <|endoftext|> x"]
    found = ids_of(spark, work, list(enumerate(texts)))
    for i, text in enumerate(texts):
        assert list(found[i][0].ids) == library.encode_ordinary(text), repr(text[:80])


def test_blocks_buckets_and_long_texts(spark, work, library, monkeypatch):
    monkeypatch.setattr(bytebpe, "BLOCK", 5000)
    monkeypatch.setattr(bytebpe, "PLACES", 300)
    monkeypatch.setattr(bytebpe, "KNOWN", 20)
    texts = [prose(i % 7, 300 + i) for i in range(40)] + ["", None, prose(9, 250_000)]
    found = ids_of(spark, work, list(enumerate(texts)), buckets=3)
    for i, text in enumerate(texts):
        assert list(found[i][0].ids) == library.encode_ordinary(text or ""), i


def test_round_trip_and_digests(spark, work, library):
    rows = edge_rows()
    decoded = bytebpe.decode(bytebpe.encode(documents(spark, rows), PATH, work), PATH)
    assert sorted(bytes(r.decoded) for r in decoded.collect()) == sorted(
        (t or "").encode() for _, t in rows
    )
    found = by_id(bytebpe.digests(decoded))
    ids = library.encode_ordinary(rows[0][1])
    assert tuple(found[1][0])[1:] == (
        len(ids),
        hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
        hashlib.sha256(rows[0][1].encode()).hexdigest(),
    )
    assert found[3][0].n_tokens == 0 and found[3][0].ids_sha256 == hashlib.sha256(b"").hexdigest()


def test_decoding_nulls_and_unknown_ids(spark):
    rows = spark.createDataFrame([(1, None), (2, []), (3, [0, 50255])], "doc_id long, ids array<int>")
    found = by_id(bytebpe.decode(rows, PATH))
    assert bytes(found[1][0].decoded) == b"" == bytes(found[2][0].decoded)
    assert len(found[3][0].decoded) > 1
    wrong = spark.createDataFrame([(1, [60000])], "doc_id long, ids array<int>")
    with pytest.raises(Exception, match="out of bounds|vocabulary"):
        bytebpe.decode(wrong, PATH).collect()


def test_empty_table(spark, work):
    encoded = bytebpe.encode(documents(spark, []), PATH, work)
    assert bytebpe.digests(bytebpe.decode(encoded, PATH)).collect() == []
