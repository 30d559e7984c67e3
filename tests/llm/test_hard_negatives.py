from __future__ import annotations

import math

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from renalis.llm import hard_negatives, oracle, registry
from renalis.llm.hard_negatives import Packed, mine

SCHEMA = "vec_id long, embedding array<float>, label int, id string, q string, `group` string, key int"


def by_hand(rows) -> list[tuple]:
    data = {}
    for v, e, label in rows:
        if v is None or label is None or e is None:
            continue
        if all(x is not None and math.isfinite(x) for x in e):
            q = [math.floor(256 * float(np.float32(x))) for x in e]
            data[v, label, tuple(q)] = q
    out = []
    for anchor in data:
        if anchor[0] % 100:
            continue
        score = {k: sum(a * b for a, b in zip(data[anchor], q)) for k, q in data.items()}
        ranked = sorted(score, key=lambda k: (-score[k], k[0]))
        for p in [k for k in ranked if k[1] == anchor[1] and k != anchor][:5]:
            fits = [
                k for k in ranked
                if k[1] != anchor[1] and 80 * score[p] <= 100 * score[k] <= 100 * score[p]
            ]
            for i, k in enumerate(fits[:5]):
                out.append((anchor[0], p[0], i + 1, k[0], score[p], score[k]))
    return sorted(out)


def mined(spark, work, rows):
    df = spark.createDataFrame([(*r, "x", "x", "x", 1) for r in rows], SCHEMA)
    return sorted(tuple(r) for r in mine(df, F.col("vec_id") % 100 == 0, work).collect())


def vectors(n, dims=8, scale=1.0, seed=0, labels=4):
    rng = np.random.default_rng(seed)
    e = np.abs(rng.normal(size=(n, dims))) * scale + rng.normal(size=(n, dims)) * 0.2
    return [(i, [float(x) for x in np.float32(v)], int(rng.integers(labels))) for i, v in enumerate(e)]


def test_packed_scores_are_exact():
    rng = np.random.default_rng(3)
    for size, n, dims in [(1, 5, 1), (300, 2500, 64), (1 << 20, 1030, 7)]:
        q, anchors = rng.integers(-size, size, (n, dims)), rng.integers(-size, size, (4, dims))
        ids, labels, keys = np.arange(n), rng.integers(0, 3, n), np.arange(n)
        packed = Packed.of([ids, labels, keys], q, size)
        every = np.ones(len(packed.words), bool)
        for a in anchors:
            assert (packed.scores(a.tolist(), every) == q[packed.ids] @ a).all()


def test_against_brute_force(spark, work, monkeypatch):
    monkeypatch.setattr(hard_negatives, "GROUP", 100)
    monkeypatch.setattr(hard_negatives, "LANES", 16)
    rows = vectors(700)
    assert mined(spark, work, rows) == by_hand(rows) != []


def test_ties_repeated_rows_and_ids(spark, work):
    rows = [(i, [1.0, 0.5], i % 2) for i in range(30)]
    rows += [(0, [1.0, 0.5], 0)] * 4 + [(7, [1.0, 0.25], 0), (0, [0.9, 0.5], 1)]
    assert mined(spark, work, rows) == by_hand(rows) != []


def test_rows_that_take_no_part(spark, work):
    inf, nan = float("inf"), float("nan")
    rows = vectors(60)
    rows += [
        (100, None, 1), (200, [1.0] * 8, None), (300, [nan] + [1.0] * 7, 1), (400, [1.0, None], 1),
        (500, [-inf] * 8, 1), (None, [1.0] * 8, 1), (601, [inf] * 8, 2),
    ]
    got = mined(spark, work, rows)
    assert got == by_hand(rows) and {r[0] for r in got} <= {0}


def test_lengths_signs_and_large_components(spark, work):
    rows = vectors(40) + [(100, [], 1), (101, [1.0], 1), (200, [3e4] * 9, 2), (201, [-3e4, 2e4], 2)]
    assert mined(spark, work, rows) == by_hand(rows)
    low = [(i, [-1.0 - i / 50] * 3, i % 3) for i in range(50)]  # negative components alone
    assert mined(spark, work, low) == by_hand(low)
    with pytest.raises(Exception, match="would not fit"):
        mined(spark, work, [(0, [1e13], 0), (1, [1e13], 0), (2, [1e13], 1)])


def test_few_rows(spark, work):
    assert mined(spark, work, []) == []
    assert mined(spark, work, [(0, [1.0], 1)]) == []
    assert mined(spark, work, [(0, [1.0], 1), (1, [1.0], 1)]) == []
    assert mined(spark, work, [(1, [1.0], 1), (2, [1.0], 2)]) == []  # no anchor


def test_sql(spark):
    path = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.sql(f"create view embeddings as select * from '{path}/embeddings.parquet'")
    got = registry.op11_kronecker_hard_negatives(spark, path).collect()
    assert sorted(tuple(r) for r in got) == sorted(con.sql(oracle.HARD_NEGATIVES).fetchall())
