from __future__ import annotations

import zlib
from collections import Counter, defaultdict

import pytest

from renalis.llm import sharding
from tests.llm.rows import documents, edge_rows, prose


def test_every_row_has_a_place_and_shards_are_near_equal(spark, work):
    rows = [(i, prose(i, 5 + i * 7 % 90)) for i in range(3000)]
    rows += [(10_000 + i, rows[0][1]) for i in range(1500)]  # a third are copies of one text
    texts = dict(rows)
    got = sharding.assign(documents(spark, rows), 40, work).collect()
    assert len(got) == len(rows)
    loads, places = Counter(), defaultdict(list)
    for r in got:
        t = texts[r.doc_id].encode()
        assert (r.size, r.text_crc32) == (len(t) + 16, zlib.crc32(t))
        assert r.law == "bytes" and r.grown_shard is None
        loads[r.shard] += r.size
        places[r.shard].append(r.slot)
    assert sorted(loads) == list(range(40))
    for p in places.values():
        assert sorted(p) == list(range(len(p)))
    mean = sum(loads.values()) / 40
    assert max(loads.values()) < 1.05 * mean and min(loads.values()) > 0.95 * mean


def test_versions_of_the_map(spark, work):
    docs = documents(spark, [(i, prose(i, 20)) for i in range(500)])
    sizes = work.cut(sharding.slot_sizes(sharding.records(docs)), "sizes")
    maps = sharding.SlotMaps(spark, work.folder("maps"))
    first = maps.store(sharding.initial_map(spark, 8))
    second = maps.store(sharding.rebalance(first, sizes, 8))
    same = maps.store(sharding.rebalance(second, sizes, 8))
    grown = maps.store(sharding.rebalance(same, sizes, 9))
    tables = [{r[0]: r[1] for r in maps.read(v).collect()} for v in (1, 2, 3, 4)]
    assert all(sorted(t) == list(range(sharding.SLOTS)) for t in tables)
    assert tables[0] == {r[0]: r[1] for r in first.collect()}
    held = {r.virtual_slot: r.bytes for r in sizes.collect()}

    def moved(a, b):
        return sum(held[s] for s in held if a[s] != b[s]) / sum(held.values())

    assert moved(tables[1], tables[2]) < 0.02  # balanced already
    assert 0.05 < moved(tables[2], tables[3]) < 0.25  # a ninth goes to the new shard
    assert set(tables[3].values()) == set(range(9))


@pytest.mark.parametrize("shards", [1, 7])
def test_edge_rows(spark, work, shards):
    got = sharding.assign(documents(spark, edge_rows()), shards, work).collect()
    assert len(got) == len(edge_rows())
    want = Counter((i, len((t or "").encode()) + 16) for i, t in edge_rows())
    assert Counter((r.doc_id, r.size) for r in got) == want
    places = defaultdict(list)
    for r in got:
        places[r.shard].append(r.slot)
    assert all(sorted(p) == list(range(len(p))) for p in places.values())


def test_empty_table(spark, work):
    assert sharding.assign(documents(spark, []), 40, work).count() == 0


def test_no_python_on_the_way(spark, work):
    plan = sharding.assign(documents(spark, edge_rows()), 3, work)
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert not any(w in text for w in ("Python", "Arrow", "Pandas"))


def test_stored_maps_are_opened_and_edited(spark, work):
    rows = [(i, prose(i, 20)) for i in range(3000)]
    path = work.folder("maps")

    def placed(shards, rows):
        maps = sharding.SlotMaps(spark, path)
        got = sharding.assign(documents(spark, rows), shards, work, maps=maps).collect()
        return {r.doc_id: (r.shard, r.size) for r in got}, maps.latest

    first, version = placed(8, rows)
    again, later = placed(8, rows + [(10_000 + i, prose(i, 20)) for i in range(30)])
    assert (version, later) == (2, 3)
    total = sum(size for _, size in first.values())
    moved = sum(size for i, (shard, size) in first.items() if again[i][0] != shard)
    assert moved < total / 50
    # One shard more takes a ninth; little else changes its place.
    grown, last = placed(9, rows)
    assert last == 4
    into = sum(size for i, (shard, size) in grown.items() if shard == 8)
    other = sum(s for i, (shard, s) in grown.items() if shard not in (8, again[i][0]))
    assert abs(into - total / 9) < total / 90 and other < total / 20


def test_a_broken_version_is_written_again(spark, work, tmp_path):
    maps = sharding.SlotMaps(spark, str(tmp_path))
    maps.store(sharding.initial_map(spark, 4))
    (tmp_path / "version=2").mkdir()
    (tmp_path / "version=2" / "part-0.parquet").write_bytes(b"half")
    again = sharding.SlotMaps(spark, str(tmp_path))
    assert again.latest == 1
    again.store(sharding.initial_map(spark, 5))
    assert sharding.SlotMaps(spark, str(tmp_path)).read().count() == sharding.SLOTS
