from __future__ import annotations

import hashlib

import numpy as np

from renalis.llm import winnowing
from tests.llm.rows import documents, edge_rows, prose


def by_definition(text: str) -> list[tuple[int, int]]:
    """Smallest hash of each window, the rightmost of ties, with its position."""
    if not text:
        return []
    code = [ord(c) for c in text] + [0] * (winnowing.K - len(text))
    hashes = []
    for i in range(len(code) - winnowing.K + 1):
        v = 0
        for c in code[i : i + winnowing.K]:
            v = (v * winnowing._BASE + c * 0xD6E8FEB86659FD93) % 2**64
        v ^= v >> 32
        hashes.append(v * 0xFF51AFD7ED558CCD % 2**64 >> 32)
    out = []
    for i in range(max(1, len(hashes) - winnowing.WINDOW + 1)):
        window = hashes[i : i + winnowing.WINDOW]
        least = min(window)
        chosen = (least, i + max(j for j, h in enumerate(window) if h == least))
        if not out or out[-1] != chosen:
            out.append(chosen)
    return out


def pairs(chosen: np.ndarray) -> list[tuple[int, int]]:
    text = winnowing.as_text(chosen)
    return [(int(text[i : i + 8], 16), int(text[i + 8 : i + 16], 16)) for i in range(0, len(text), 16)]


def test_windows():
    for text in ["", "a", "abc" * 4, "a" * 100, "ab" * 200, prose(1, 200), "é🙂" * 50]:
        assert pairs(winnowing.winnow(text)) == by_definition(text)


def test_long_texts_are_handled_in_steps(monkeypatch):
    text = prose(2, 800) + "z" * 500
    whole = winnowing.winnow(text)
    monkeypatch.setattr(winnowing, "STEP", 97)
    assert (winnowing.winnow(text) == whole).all()


def test_match_guarantee():
    shared = prose(3, 60)[: winnowing.K + winnowing.WINDOW - 1]
    a, b = prose(4, 100) + shared + prose(5, 90), prose(6, 33) + shared + prose(7, 70)
    in_a, in_b = (dict(pairs(winnowing.winnow(t))) for t in (a, b))
    common = in_a.keys() & in_b.keys()
    assert any(a[in_a[h] : in_a[h] + winnowing.K] == b[in_b[h] : in_b[h] + winnowing.K] for h in common)


def expected(rows):
    """Rows by id and hash of the text, each with its successor, the last with the first."""
    order = sorted(rows, key=lambda r: r[0])
    out = {}
    for (i, t), (_, following) in zip(order, order[1:] + order[:1]):
        half = len(t) // 2
        other = t[: len(t) - half] + following[:half]
        chosen, new = winnowing.winnow(t), winnowing.winnow(other)
        sets = [set(h for h, _ in pairs(c)) for c in (chosen, new, winnowing.winnow(following))]

        def like(x, y):
            return len(x & y) / len(x | y) if x | y else 1.0

        out[i] = (
            len(t), hashlib.sha256(other.encode()).hexdigest(), winnowing.as_text(chosen),
            winnowing.as_text(new), like(sets[0], sets[1]), like(sets[0], sets[2]),
        )
    return out


def check(spark, rows):
    got = winnowing.fingerprints(documents(spark, rows)).collect()
    want = expected([(i, t or "") for i, t in rows])
    assert len(got) == len(rows)
    for r in got:
        assert tuple(r)[1:] == want[r.doc_id], r.doc_id


def test_successors(spark):
    rows = [(i * i * 7 % 100_003, prose(i, i % 40)) for i in range(700)]
    rows[5] = (rows[5][0], None)
    check(spark, rows)


def test_few_rows(spark):
    check(spark, [(7, "only one text here")])
    check(spark, [(7, None)])
    check(spark, [(2, "a much longer text than the next one"), (-5, "é")])
    assert winnowing.fingerprints(documents(spark, [])).count() == 0


def test_edge_rows(spark):
    got = winnowing.fingerprints(documents(spark, edge_rows())).collect()
    assert len(got) == len(edge_rows())
    texts = {}
    for i, t in edge_rows():
        texts.setdefault(i, set()).add(winnowing.as_text(winnowing.winnow(t or "")))
    for r in got:
        assert r.fingerprint in texts[r.doc_id]
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1


def test_one_shuffle_of_texts(spark):
    docs = documents(spark, [(i, prose(i, 30)) for i in range(50)])
    plan = winnowing.fingerprints(docs)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
