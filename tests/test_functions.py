from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from renalis.functions import codes
from renalis.functions.clinical import age_years, egfr, ratio_to_stage, scr_ratio
from renalis.functions.time import combine_date_time, days_between, hours_between
from tests.conftest import frame, ts


@pytest.mark.parametrize(
    "birth, at, rounded, calendar, complete",
    [
        ("1950-07-01", "2010-06-30", 60, 60, 59),
        ("1950-07-01", "2010-07-01", 60, 60, 60),
        ("1950-12-31", "2010-01-01", 59, 60, 59),
        ("1960-02-29", "2001-02-28", 41, 41, 40),
    ],
)
def test_age_modes(spark, birth, at, rounded, calendar, complete):
    df = frame(spark, "b:date a:date", [(birth, at)])
    ages = [age_years(F.col("a"), F.col("b"), m) for m in ("rounded", "calendar", "complete")]
    assert tuple(df.select(*ages).first()) == (rounded, calendar, complete)


def test_day_modes(spark):
    df = frame(
        spark,
        "a:ts b:ts",
        [
            ("2020-01-01 12:00", "2020-01-03 06:00"),
            ("2020-01-03 06:00", "2020-01-01 12:00"),
            ("2020-01-01 12:00", "2020-01-03 12:00"),
        ],
    )
    a, b = F.col("a"), F.col("b")
    got = df.select(*[days_between(a, b, m) for m in ("exact", "whole", "boundary")]).collect()
    assert [tuple(r) for r in got] == [(1, 1, 2), (-2, -1, -2), (2, 2, 2)]


def test_hour_modes(spark):
    df = frame(spark, "a:ts b:ts", [("2020-01-01 10:50", "2020-01-01 12:10")])
    modes = [hours_between(F.col("a"), F.col("b"), m) for m in ("exact", "boundary")]
    assert tuple(df.select(*modes).first()) == (1, 2)


def test_combine_date_time(spark):
    df = frame(spark, "d:date t:string", [("2020-02-03", "07:05"), ("2020-02-03", None)])
    day, time = F.col("d"), F.col("t")
    got = df.select(
        combine_date_time(day, time), combine_date_time(day, time, "midnight")
    ).collect()
    assert tuple(got[0]) == (ts("2020-02-03 07:05"),) * 2
    assert tuple(got[1]) == (None, ts("2020-02-03 00:00"))


def test_time_columns_ignore_the_session_zone(spark):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        # 2020-03-08 has 23 hours in that zone.
        df = frame(spark, "a:ts b:ts", [("2020-03-07 12:00", "2020-03-09 12:00")])
        assert df.select(days_between(F.col("a"), F.col("b"), "exact")).first()[0] == 2
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_egfr(spark):
    df = frame(
        spark, "s:double a:int sex:string race:string",
        [(1.0, 60, "M", "05"), (1.0, 60, "F", "03"), (2.0, 18, "M", None)],
    )
    args = F.col("s"), F.col("a"), F.col("sex"), F.col("race")
    plain, rounded = zip(*df.select(egfr(*args), egfr(*args, True)).collect())
    base = 175 * 60**-0.203
    assert plain[0] == pytest.approx(base, abs=1e-4)
    assert plain[1] == pytest.approx(base * 0.742 * 1.212, abs=1e-4)
    assert plain[2] == pytest.approx(175 * 2**-1.154 * 18**-0.203, abs=1e-4)
    assert rounded[0] == pytest.approx(175 * 0.44, abs=1e-9)


def test_ratio_borders(spark):
    """Half up on the decimal value, also where its double lies below."""
    cases = {
        (1.44, 1.0): (1.4, 0), (1.45, 1.0): (1.5, 1), (1.94, 1.0): (1.9, 1), (1.95, 1.0): (2.0, 2),
        (2.94, 1.0): (2.9, 2), (2.95, 1.0): (3.0, 3), (0.87, 0.6): (1.5, 1), (1.74, 1.2): (1.5, 1),
    }
    df = frame(spark, "s:double b:double", list(cases))
    ratio = scr_ratio(F.col("s"), F.col("b"))
    got = {(r[0], r[1]): (r[2], r[3]) for r in df.select("s", "b", ratio, ratio_to_stage(ratio)).collect()}
    assert got == cases


@pytest.mark.parametrize("name", list(codes.CODE_SETS))
def test_code_match_agrees_with_the_listing(spark, name):
    probes = set()
    for rules in codes.CODE_SETS.values():
        for _, _, values in rules:
            for v in values:
                probes |= {v, v + "9", "X" + v, v[:-1]}
    df = spark.createDataFrame(
        [(s, p) for s in ("09", "10", "CH") for p in sorted(probes)], "kind string, code string"
    )
    got = {(r[0], r[1]) for r in df.filter(codes.code_match(name, "kind", "code")).collect()}
    test = {"exact": str.__eq__, "prefix": str.startswith, "contains": str.__contains__}
    want = {
        (s, p)
        for s in ("09", "10", "CH")
        for p in probes
        for system, kind, values in codes.CODE_SETS[name]
        if s == system and any(test[kind](p, v) for v in values)
    }
    assert got == want


def test_code_table(spark):
    table = codes.code_sets(spark)
    counts = {r[0]: r[1] for r in table.groupBy("set_name").count().collect()}
    assert counts["SCR_LOINC"] == 7 and counts["VITAL_CODES"] == 45 and counts["VITAL_NAMES"] == 8
    assert counts["BURN_DX"] == 27 and counts["TRANSPLANT_PX"] == 29


def test_codes_of_the_study():
    """Literal values, as the check SQL takes its lists from the library."""
    sets = {
        name: sorted(c for _, _, listed in rules for c in listed)
        for name, rules in codes.CODE_SETS.items()
    }
    assert sets["ESRD_DX"] == ["585.6", "N18.6"]
    assert sets["RRT_DX"] == [
        "996.81", "T86.10", "T86.11", "T86.12", "V42.0", "V45.1", "V56.", "Z49.31", "Z94.0", "Z99.2",
    ]
    assert sets["DIALYSIS_PX"] == [
        "39.93", "39.95", "54.98", "5A1D00Z", "5A1D60Z", "5A1D70Z", "5A1D80Z", "5A1D90Z", "90935",
        "90937", "9094", "9095", "9096", "9097", "9098", "9099",
    ]
    assert {n: len(c) for n, c in sets.items()} == {
        "ESRD_DX": 2, "RRT_DX": 10, "DIALYSIS_PX": 16, "TRANSPLANT_PX": 29, "BURN_DX": 27,
    }
