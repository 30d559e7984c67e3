from __future__ import annotations

import random
import re

import numpy as np
import pytest

from renalis.llm import components, near_dedup
from tests.llm.rows import documents, edge_rows, prose


def sets_by_definition(text, size=2):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    words = [re.sub("[A-Z]", lambda m: m.group().lower(), w) for w in words]
    if not words:
        return frozenset()
    n = min(size, len(words))
    return frozenset(tuple(words[i : i + n]) for i in range(len(words) - n + 1))


def components_by_definition(rows, size=2, percent=80):
    sets = [(i, sets_by_definition(t, size)) for i, t in rows]
    root = {i: i for i, _ in rows}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, (i, x) in enumerate(sets):
        for j, y in sets[:a]:
            common = len(x & y)
            if common and 100 * common >= percent * (len(x) + len(y) - common):
                p, q = sorted((find(i), find(j)))
                root[q] = p
    return {i: (len(x), find(i)) for i, x in sets}


def edited(text, share, seed):
    rng = random.Random(seed)
    return " ".join(f"w{rng.randrange(9999)}" if rng.random() < share else w for w in text.split())


def check(spark, work, rows, size=2):
    got = near_dedup.near_duplicates(documents(spark, rows), work, size=size).collect()
    assert len(got) == len(rows)
    want = components_by_definition(rows, size)
    for r in got:
        assert (r.n_shingles, r.component_id) == want[r.doc_id], r.doc_id
        assert r.kept == (r.doc_id == r.component_id)


def test_groups_chains_and_borders(spark, work):
    rows = [(i, prose(i, 20 + i % 150)) for i in range(150)]
    n = 1000
    for i in range(12):  # near copies of many degrees, short and long
        base = prose(500 + i, 15 * (i + 1))
        for j, share in enumerate([0, 0, 0.005, 0.01, 0.02, 0.05, 0.08, 0.12, 0.2]):
            rows.append((n, edited(base, share, n)))
            n += 1
    words = [f"c{i}" for i in range(101)]
    for i in range(8):  # a chain, each close to the next only
        rows.append((n, " ".join(words[i * 6 : i * 6 + 60])))
        n += 1
    for k in (1, 2, 3, 4, 5):  # sets of few shingles, and ones at the very border
        rows += [(n, " ".join(words[:k])), (n + 1, " ".join(words[: k + 1]).upper())]
        n += 2
    random.Random(1).shuffle(rows)
    check(spark, work, rows)
    check(spark, work, rows, size=5)


def test_a_large_group_of_near_copies(spark, work):
    base = prose(77, 120)
    rows = [(i, edited(base, 0.03, i)) for i in range(400)]
    rows += [(1000 + i, base) for i in range(300)] + [(2000 + i, prose(i, 60)) for i in range(100)]
    check(spark, work, rows)


def test_blocks_of_a_bucket(spark, work, monkeypatch):
    """Links found in cells of any size connect what all links together connect."""
    rng = np.random.default_rng(8)
    base = rng.integers(0, 2**64, 90, dtype=np.uint64)
    sets = [
        np.unique(np.append(base[: 90 - i % 12], rng.integers(0, 2**64, 3 + i % 12, dtype=np.uint64)))
        for i in range(60)
    ]
    label = [i // 7 for i in range(60)]
    total = sum(map(len, sets))
    rows = [
        (1, i, label[i], 60, total, near_dedup.registers(s).tobytes(), s.astype(np.int64).tobytes())
        for i, s in enumerate(sets)
    ]
    members = spark.createDataFrame(
        rows, "key long, rep long, label long, c long, s long, registers binary, members binary"
    )

    def connected(links):
        root = list(range(9))
        for a, b in links:
            p, q = sorted((root[label[a]], root[label[b]]))
            root = [p if r == q else r for r in root]
        return root

    every = []
    for i in range(60):
        for j in range(i):
            n = len(np.intersect1d(sets[i], sets[j]))
            if label[i] != label[j] and 100 * n >= 80 * (len(sets[i]) + len(sets[j]) - n):
                every.append((j, i))
    assert every and len(set(connected(every))) < 9
    for cell, hashes in ((1000, 1 << 20), (7, 1 << 20), (1000, total // 5)):
        monkeypatch.setattr(near_dedup, "CELL", cell)
        monkeypatch.setattr(near_dedup, "CELL_HASHES", hashes)
        monkeypatch.setattr(near_dedup, "COLUMNS", 16)
        found = [tuple(r) for r in near_dedup.links_in_buckets(members, 80).collect()]
        assert set(found) <= set(every) and connected(found) == connected(every)


def test_several_texts_under_one_id(spark, work):
    a, b, c = prose(1, 80), prose(2, 80), prose(3, 80)
    # 5 has a copy of 3's text and one of its own; 7 has two of its own, one of which 8 repeats.
    rows = [(3, a), (5, a), (5, b), (7, c), (7, prose(4, 80)), (8, c + " end"), (9, b)]
    got = near_dedup.near_duplicates(documents(spark, rows), work).collect()
    assert sorted((r.doc_id, r.component_id) for r in got) == [
        (3, 3), (5, 3), (5, 5), (7, 7), (7, 7), (8, 7), (9, 5)
    ]
    kept = near_dedup.keep_first(documents(spark, rows), work).collect()
    assert sorted((r.doc_id, r.text) for r in kept) == sorted(
        [(3, a), (5, b), (7, c), (7, prose(4, 80))]
    )


def test_classes_that_share_their_smallest_id(spark, work):
    """Both texts of 4 stand for their class, and each is linked with other ids."""
    a, b = prose(1, 90), prose(2, 90)
    rows = [(4, a), (4, b), (6, a + " x"), (2, b + " y"), (9, b + " z"), (11, a + " w")]
    got = near_dedup.near_duplicates(documents(spark, rows), work).collect()
    found = {(r.doc_id, r.component_id) for r in got}
    assert found == {(4, 4), (6, 4), (11, 4), (4, 2), (2, 2), (9, 2)}
    kept = near_dedup.keep_first(documents(spark, rows), work).collect()
    assert sorted((r.doc_id, r.text) for r in kept) == [(2, b + " y"), (4, a)]


def test_first_rows_of_repeated_rows_and_rows_without_id(spark, work):
    a, b = prose(1, 60), prose(2, 60)
    rows = [(None, a), (None, a), (1, a), (None, b), (None, b), (None, None), (None, None), (2, ""),
            (3, prose(3, 60)), (3, prose(3, 60)), (3, prose(3, 60))]
    docs = documents(spark, rows)
    kept = near_dedup.keep_first(docs, work)
    assert kept.columns == docs.columns
    want = [(None, None), (None, None), (1, a), (None, b), (2, ""), (3, prose(3, 60))]
    assert sorted(map(str, ((r.doc_id, r.text) for r in kept.collect()))) == sorted(map(str, want))
    assert near_dedup.keep_first(documents(spark, []), work).count() == 0
    assert near_dedup.keep_first(documents(spark, edge_rows()), work).count() > 5


def test_long_texts_at_the_border(spark, work):
    """Sets of 180,000 shingles that are 80 % alike are linked; with one word less in common not."""
    first, second = ([f"{c}{j}" for j in range(200_001)] for c in "ab")
    rows = [
        (1, " ".join(first[:180_001])), (2, " ".join(first[20_000:])),  # 160,000 of 200,000
        (3, " ".join(second[:180_001])), (4, " ".join([*second[20_001:], "new"])),
    ]
    sets = [sets_by_definition(t) for _, t in rows]
    shares = [len(x & y) / len(x | y) for x, y in (sets[:2], sets[2:])]
    assert shares[0] == 0.8 and 0.79999 < shares[1] < 0.8
    got = near_dedup.near_duplicates(documents(spark, rows), work).collect()
    assert sorted((r.doc_id, r.component_id) for r in got) == [(1, 1), (2, 1), (3, 3), (4, 4)]


def test_edge_rows(spark, work):
    got = near_dedup.near_duplicates(documents(spark, edge_rows()), work).collect()
    assert len(got) == len(edge_rows())
    found = {}
    for r in got:
        found.setdefault(r.doc_id, set()).add((r.n_shingles, r.component_id, r.kept))
    assert found[1] == {(2, 1, True)} and found[8] == {(2, 1, False)}
    for i in (2, 3, 4):
        assert found[i] == {(0, i, True)}
    assert {c for _, c, _ in found[6]} == {5} and found[7] == {(1, 7, True)}
    assert {(c, k) for _, c, k in found[9]} == {(9, True)}
    assert found[None] == {(2, 1, False), (0, None, True)}


def test_empty_tables(spark, work):
    assert near_dedup.near_duplicates(documents(spark, []), work).count() == 0
    only = near_dedup.near_duplicates(documents(spark, [(1, None), (2, "  ")]), work).collect()
    assert sorted((r.doc_id, r.component_id, r.kept) for r in only) == [(1, 1, True), (2, 2, True)]


def test_registers():
    rng = np.random.default_rng(1)
    hashes = np.unique(rng.integers(0, 2**64, 5000, dtype=np.uint64))
    got = near_dedup.registers(hashes)
    least = {}
    for h in hashes.tolist():
        least[h >> 56] = min(least.get(h >> 56, 2**64), h)
    for b in range(256):
        rest = (least[b] & (1 << 56) - 1) >> 8
        zeros = 48 - rest.bit_length()
        mantissa = (rest << zeros + 1 & (1 << 48) - 1) >> 38
        assert got[b] == 1 + zeros * 1024 + mantissa
    assert not near_dedup.registers(hashes[:0]).any()


def random_pair(rng, union, different):
    """Two sets of hashes whose union and difference have these sizes."""
    hashes = rng.integers(0, 2**64, union, dtype=np.uint64)
    cut = rng.integers(0, different + 1)
    return np.unique(hashes[cut:]), np.unique(np.append(hashes[:cut], hashes[different:]))


@pytest.mark.parametrize("share", [0.3, 0.6, 0.9])
def test_estimate(share):
    rng = np.random.default_rng(2)
    pairs = [random_pair(rng, 900, int(900 * (1 - share))) for _ in range(200)]
    a, b = (np.stack([near_dedup.registers(p[i]) for p in pairs]) for i in (0, 1))
    found, used = near_dedup.estimate(a, b)
    assert abs(found.mean() - share) < 0.01 and used.min() > 200


@pytest.mark.parametrize("union", [5, 9, 10, 14, 20, 28, 35, 50, 62, 75, 100, 200, 400, 2000])
def test_pairs_at_the_border_meet(union):
    rng = np.random.default_rng(union)
    for _ in range(300):
        keys = [
            near_dedup.band_keys(near_dedup.registers(h), h)
            for h in random_pair(rng, union, union // 5)
        ]
        assert np.intersect1d(*keys).size


def test_a_common_phrase_does_not_make_texts_meet():
    rng = np.random.default_rng(4)
    met = 0
    common = rng.integers(0, 2**64, 20, dtype=np.uint64)
    for _ in range(300):
        x, y = (
            np.unique(np.append(common, rng.integers(0, 2**64, 80, dtype=np.uint64)))
            for _ in range(2)
        )
        met += bool(
            np.intersect1d(*(near_dedup.band_keys(near_dedup.registers(h), h) for h in (x, y))).size
        )
    assert met < 6


def test_components(spark, work):
    links = [(1, 2), (2, 3), (3, 4), (4, 5), (10, 11), (11, 10), (7, 20), (20, 15), (15, 9), (2, 1)]
    links += [(100 + i, 101 + i) for i in range(60)]
    frame = spark.createDataFrame(links, "a long, b long")
    got = {r.id: r.label for r in components.components(frame, work, "t").collect()}
    assert {got[i] for i in (1, 2, 3, 4, 5)} == {1} and got[11] == got[10] == 10
    assert {got[i] for i in (7, 9, 15, 20)} == {7}
    assert {got[100 + i] for i in range(61)} == {100}
    assert components.components(frame.limit(0), work, "e").count() == 0


def test_only_members_that_may_have_a_link_need_their_sets(spark, work, monkeypatch):
    # Of bucket 1, members 0 and 1 are near copies in different components; 2 is a near copy in the
    # component of 0, and with 3 to 39 shares nothing. Bucket 2 has unlike members only.
    base = prose(1, 300)
    texts = [base, edited(base, 0.01, 1), edited(base, 0.01, 2)] + [prose(9 + i, 300) for i in range(37)]
    label = [0, 1, 0] + list(range(3, 40))
    sets = [near_dedup.shingles(t) for t in texts]
    whole = spark.createDataFrame(
        [(i, h.tobytes()) for i, h in enumerate(sets)], "rep long, members binary"
    )
    rows = [(1, i, label[i], len(sets[i]), 40, 12000) for i in range(40)]
    rows += [(2, i, label[i], len(sets[i]), 20, 6000) for i in range(20, 40)]
    members = spark.createDataFrame(rows, "key long, rep long, label long, n long, c long, s long")
    members = members.join(near_dedup.halved(whole), "rep")
    for cell in (1000, 6):
        monkeypatch.setattr(near_dedup, "CELL", cell)
        found = near_dedup.asked_in_buckets(members, 80).collect()
        assert sorted(tuple(r) for r in found) == [(1, 0), (1, 1), (1, 2)]


def test_hashes_that_differ_in_their_lower_half_only_are_compared_whole(spark):
    """Equal halves in one set hide hashes; the bound counts them, and loses no pair."""
    a = np.array([(7 << 32) + i for i in range(10)] + [9 << 32], np.uint64)
    b = a[:9]
    whole = spark.createDataFrame([(0, a.tobytes()), (1, b.tobytes())], "rep long, members binary")
    rows = spark.createDataFrame(
        [(1, 0, 0, 11, 2, 20), (1, 1, 1, 9, 2, 20)],
        "key long, rep long, label long, n long, c long, s long",
    ).join(near_dedup.halved(whole), "rep")
    assert sorted(r.rep for r in near_dedup.asked_in_buckets(rows, 80).collect()) == [0, 1]


def test_sets_of_members_without_likely_links_are_not_dealt(spark, work, monkeypatch):
    """Texts that share a band and not enough else meet in cells by halves, not by their whole sets."""
    seen = []
    through = near_dedup.links_in_buckets

    def watched(members, percent):
        seen.extend(members.select("rep").distinct().collect())
        return through(members, percent)

    monkeypatch.setattr(near_dedup, "links_in_buckets", watched)
    # 72 in 100 words of each two agree at the same places: their estimate is close to the border.
    shared = " ".join(f"s{i}" for i in range(240))
    rows = [(i, f"{shared} {prose(i, 45)}") for i in range(60)]
    check(spark, work, rows)
    assert not seen


def test_two_members_meet_in_one_of_their_buckets(spark, work, monkeypatch):
    """Unlike enough to have no link, alike enough for many common buckets: sets are dealt once."""
    seen = []
    through = near_dedup.asked_in_buckets

    def watched(members, percent):
        seen.extend(tuple(r) for r in members.select("key", "rep").collect())
        return through(members, percent)

    monkeypatch.setattr(near_dedup, "asked_in_buckets", watched)
    base = prose(1, 600)
    rows = [(1, base), (2, edited(base, 0.07, 1))]
    keys = [near_dedup.band_keys(near_dedup.registers(h), h) for h in map(near_dedup.shingles, dict(rows).values())]
    assert len(common := np.intersect1d(*keys)) > 3
    check(spark, work, rows)
    assert sorted(seen) == [(common.min(), 1), (common.min(), 2)]


def test_likely_members_of_a_bucket(spark, monkeypatch):
    # 0 and 1 share keys 1 to 3 and 2 is in 2 and 3 only: 0 and 1 meet in 1, 2 with each of them in 2. 3 is
    # in the component of 0, 4 shares nothing, and 5 is as a part of 0 too small.
    base = prose(1, 600)
    texts = [base, edited(base, 0.01, 1), edited(base, 0.01, 2), base, prose(5, 600), base[: len(base) // 2]]
    sets = [near_dedup.shingles(t) for t in texts]
    label = [0, 1, 2, 0, 4, 5]
    registers = [(i, near_dedup.registers(h).tobytes()) for i, h in enumerate(sets)]
    rows = [(k, i, label[i], len(sets[i]), 6, 3600) for k in (1, 2, 3) for i in (0, 1)]
    rows += [(k, 2, 2, len(sets[2]), 6, 3600) for k in (2, 3)]
    rows += [(4, i, label[i], len(sets[i]), 6, 3600) for i in (0, 3, 4, 5)]
    members = spark.createDataFrame(rows, "key long, rep long, label long, n long, c long, s long")
    short = near_dedup.shortened(spark.createDataFrame(registers, "rep long, registers binary"))
    members = near_dedup.with_lower_keys(members).join(short, "rep")
    for cell in (1000, 2):
        monkeypatch.setattr(near_dedup, "CELL", cell)
        found = near_dedup.likely_in_buckets(members, 80).collect()
        assert sorted(tuple(r) for r in found) == [(1, 0), (1, 1), (2, 0), (2, 1), (2, 2)]
