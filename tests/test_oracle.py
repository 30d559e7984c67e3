"""Registered queries against DuckDB on the smallest test tables.

RENALIS_ALL_QUERIES=1 runs all of them, which takes some twenty minutes.
"""

from __future__ import annotations

import glob
import os

import duckdb
import pytest

from verification import queries

DATA = "/root/testdata/sf0.001"
CORE = [
    "initial_cohort", "scr_mean", "all_scr_egfr", "aki_scr_egfr", "baseline_first",
    "baseline_prior_2d", "exclude_all", "eligible", "rank_stages", "stages_daily", "aki_onsets",
    "aki_onsets_postgres", "aki_onsets_tsql", "consort_bc", "collect_labs", "collect_prescribing",
    "shift_onsets", "class_weight", "stratified_folds", "roc_auc", "audit_pre_esrd", "halving_rungs",
    "grid_parameters", "load_cdm", "export_csv", "stored_matrix",
    "consort", "aki_onsets_sliced", "export_manifest",
]
REGISTRY = queries.registry()
CHOSEN = list(REGISTRY) if os.environ.get("RENALIS_ALL_QUERIES") else CORE

pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in glob.glob(f"{DATA}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.sql(f"create view {name} as select * from '{path}'")
    return con


def ordered(rows):
    return sorted(rows, key=lambda r: [(v is None, str(v)) for v in r])


@pytest.mark.parametrize("name", CHOSEN)
def test_query(spark, duck, name):
    query = REGISTRY[name]
    df = query.run(spark, DATA)
    columns = sorted(df.columns)
    got = ordered(tuple(r) for r in df.select(*columns).collect())
    sql = query.sql()
    if sql is None:
        assert got
        return
    answer = duck.sql(sql)
    assert sorted(answer.columns) == columns
    want = ordered(answer.project(", ".join(f'"{c}"' for c in columns)).fetchall())
    assert got == want


def test_every_query_has_a_known_step():
    for name, query in REGISTRY.items():
        if query.step:
            assert query.sql().startswith("with"), name
