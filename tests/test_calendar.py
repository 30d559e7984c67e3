"""The index of days, the filter of patients, and the scans that use them."""

from __future__ import annotations

import random
import re
from datetime import date, timedelta

import pytest
from pyspark.sql import functions as F

from renalis.functions.membership import Membership, membership
from renalis.operators import cohort
from renalis.operators.calendar import DayIndex, day_index
from renalis.plans.pipeline import Extraction, collect_all, collect_one
from tests.conftest import frame, person, scr, stay, table
from tests.test_plans import NO_BROADCAST, executed, parquet_site, plan, settings

EPOCH = date(1970, 1, 1)


@pytest.mark.parametrize(
    "n, span, more",
    [(0, 1, []), (1, 1, []), (60, 30_000, [date(9999, 12, 31), date(1, 1, 1)]), (900, 2000, [])],
)
def test_days_and_slots_of_intervals(spark, n, span, more):
    rng = random.Random(n)
    days = sorted({date(1960, 1, 1) + timedelta(rng.randrange(span)) for _ in range(n)} | set(more))
    rows = spark.createDataFrame([(d,) for d in days for _ in range(2)] + [(None,)], "d date")
    intervals = [
        (a := date(1955, 1, 1) + timedelta(rng.randrange(33_000)), a + timedelta(rng.randint(-5, 900)))
        for _ in range(200)
    ]
    intervals += [(date(1, 1, 1), date(9999, 12, 31)), (date(1950, 1, 1), date(1955, 1, 1)), (None, None)]
    index = DayIndex.of(day_index(rows, "d"))
    a, b = F.col("a"), F.col("b")
    found = spark.createDataFrame(intervals, "a date, b date").select(
        "a", "b", index.days_within(a, b).alias("days"), index.slots_within(a, b).alias("slots")
    )
    used = sorted({(d - EPOCH).days // 32 for d in days})
    for r in found.collect():
        if r.a is None:
            assert not r.days and not r.slots
            continue
        low, high = ((x - EPOCH).days // 32 for x in (r.a, r.b))
        assert (r.days or []) == [d for d in days if r.a <= d <= r.b]
        assert (r.slots or []) == [s for s in used if low <= s <= high]


def test_membership_never_misses_a_key(spark):
    keys = frame(spark, "PATID:string", [(f"p{i}",) for i in range(0, 600, 3)] + [(None,)])
    words = membership(keys, "PATID", bits=1 << 14)
    assert len(words.first().words) == 256
    asked = frame(spark, "PATID:string", [(f"p{i}",) for i in range(600)] + [(None,)])
    kept = {
        r.PATID for r in asked.filter(Membership.of(words, 1 << 14).may_have("PATID")).collect()
    }
    assert {f"p{i}" for i in range(0, 600, 3)} <= kept and None not in kept
    assert len(kept) < 230
    nothing = Membership.of(membership(keys.limit(0), "PATID", bits=64), 64)
    assert asked.filter(nothing.may_have("PATID")).count() == 0


@pytest.fixture
def cdm(spark, work):
    """One patient with stays, and two thousand rows of patients without."""
    others = [scr(f"q{i}", "2015-01-02", "2015-01-02 08:00", 1.0) for i in range(2000)]
    return parquet_site(
        spark,
        work,
        ENCOUNTER=[stay("e", "p", "2015-01-01 05:00", "2015-01-09 10:00")],
        DEMOGRAPHIC=[person("p")],
        LAB_RESULT_CM=[
            scr("p", "2015-01-02", "2015-01-02 08:00", 1.0),
            scr("p", "2015-01-03", "2015-01-03 08:00", 1.6),
            *others,
        ],
        DIAGNOSIS=[{"PATID": "p", "DX": "N18.1", "DX_TYPE": "10", "ADMIT_DATE": "2014-11-01"}],
    )


def schemas(spark, df, column: str) -> list[list[str]]:
    """Columns that each scan of a table with this column reads, subqueries included."""
    with settings(spark, spark__sql__maxMetadataStringLength="4000"):
        found = re.findall(r"ReadSchema: struct<([^\n]*)>", plan(df))
    read = [[f.split(":")[0] for f in s.split(",")] for s in found]
    return [names for names in read if column in names]


def test_labs_are_read_once_and_their_dates_alone(spark, work, cdm, oracle_cfg):
    x = Extraction(spark, cdm, oracle_cfg, work)
    lab = cdm["LAB_RESULT_CM"]
    days = x.days.of("LAB_RESULT_CM", "LAB_ORDER_DATE")
    assert x.days.of("LAB_RESULT_CM", "LAB_ORDER_DATE") is days
    assert schemas(spark, day_index(lab, "LAB_ORDER_DATE"), "LAB_ORDER_DATE") == [["LAB_ORDER_DATE"]]
    # What is matched reads the written index and filter, and the labs a single time.
    matched = cohort.scr_in_stays(lab, x.stays, oracle_cfg, days, x.likely)
    (read,) = schemas(spark, matched, "LAB_ORDER_DATE")
    assert "RESULT_NUM" in read


def test_each_output_reads_its_table_once(spark, work, cdm, oracle_cfg):
    x = Extraction(spark, cdm, oracle_cfg, work)
    onsets = x.onsets
    outputs = collect_all(onsets, cdm, oracle_cfg, work)
    for name, column in [
        ("AKI_DX", "DX_TYPE"), ("AKI_DX_CURRENT", "DX_TYPE"), ("AKI_LAB", "RESULT_NUM"),
        ("AKI_LAB_SCR", "RESULT_NUM"), ("AKI_PX", "PX_TYPE"),
    ]:
        assert len(schemas(spark, outputs[name], column)) == 1, name
        assert outputs[name].exceptAll(collect_one(name, onsets, cdm, oracle_cfg)).count() == 0


def test_rows_of_other_patients_stay_at_the_scan(spark, work, cdm, oracle_cfg):
    x = Extraction(spark, cdm, oracle_cfg, work)
    days, likely = x.days.of("LAB_RESULT_CM", "LAB_ORDER_DATE"), x.likely
    lab = cdm["LAB_RESULT_CM"]
    asked = [cohort.scr_in_stays(lab, x.stays, oracle_cfg, days, f) for f in (None, likely)]
    rows = lambda df: sorted(map(tuple, df.collect()), key=str)
    assert rows(asked[0]) == rows(asked[1]) != []
    assert "getbit" in plan(asked[1]).lower()
    assert lab.count() == 2002 and lab.filter(likely.may_have("PATID")).count() < 20
    with settings(spark, **NO_BROADCAST):
        assert "NestedLoop" not in executed(asked[1])
    diagnoses = table(spark, "DIAGNOSIS", [{"PATID": "nobody"}, {"PATID": "p"}, {}])
    assert [r.PATID for r in diagnoses.filter(likely.may_have("PATID")).collect()] == ["p"]
