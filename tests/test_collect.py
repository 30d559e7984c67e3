from __future__ import annotations

from dataclasses import replace

import pytest

from renalis import preset
from renalis.operators import collect, deid
from renalis.plans.pipeline import collect_all, collect_one, deidentify_all
from renalis.sources.schemas import SCHEMAS
from tests.conftest import d, frame, person, table

ONSET = (
    "PATID:string ENCOUNTERID:string ADMIT_DATE:date ADMIT_YEAR:string DISCHARGE_DATE:date "
    "SERUM_CREAT_BASE:double NONAKI_ANCHOR:date AKI1_ONSET:date AKI2_ONSET:date AKI3_ONSET:date"
)


def onset(spark, *rows):
    full = [(p, e, a, a[:4], z, base, n, s1, s2, s3) for p, e, a, z, base, n, s1, s2, s3 in rows]
    return frame(spark, ONSET, full)


STAY = ("p", "e", "2015-01-10", "2015-01-15", 1.0, "2015-01-12", None, None, None)


def test_observation_window(spark):
    df = onset(
        spark,
        STAY,
        ("p", "f", "2015-01-10", "2015-01-15", 1.0, None, "2015-01-11", None, "2015-01-20"),
        ("p", "g", "2015-01-10", "2015-01-15", 1.0, None, "2015-01-20", "2015-01-12", None),
    )
    ends = {r.ENCOUNTERID: r.win_end for r in collect.observation_window(df).collect()}
    assert ends == {"e": d("2015-01-16"), "f": d("2015-01-21"), "g": d("2015-01-16")}


@pytest.mark.parametrize(
    "output, source, column, first, last",
    [
        ("AKI_VITAL", "OBS_CLIN", "OBSCLIN_START_DATE", "2014-12-11", "2015-01-16"),
        ("AKI_VITAL_OLD", "VITAL", "MEASURE_DATE", "2014-12-11", "2015-01-16"),
        ("AKI_PX", "PROCEDURES", "PX_DATE", "2015-01-10", "2015-01-16"),
        ("AKI_DX", "DIAGNOSIS", "ADMIT_DATE", "2014-01-10", "2015-01-09"),
        ("AKI_DX_CURRENT", "DIAGNOSIS", "DX_DATE", "2015-01-10", "2015-01-16"),
        ("AKI_DX_CURRENT_ADMIT_DATE", "DIAGNOSIS", "ADMIT_DATE", "2015-01-10", "2015-01-16"),
        ("AKI_LAB", "LAB_RESULT_CM", "LAB_ORDER_DATE", "2015-01-10", "2015-01-16"),
        ("AKI_LAB_SCR", "LAB_RESULT_CM", "LAB_ORDER_DATE", "2014-01-10", "2015-01-16"),
        ("AKI_PMED", "PRESCRIBING", "RX_ORDER_DATE", "2014-12-11", "2015-01-16"),
        ("AKI_DMED", "DISPENSING", "DISPENSE_DATE", "2014-12-11", "2015-01-16"),
        ("AKI_AMED", "MED_ADMIN", "MEDADMIN_START_DATE", "2014-12-11", "2015-01-16"),
    ],
)
def test_window_borders(spark, oracle_cfg, output, source, column, first, last):
    from datetime import timedelta

    need = {
        "OBSCLIN_CODE": "8480-6", "LAB_LOINC": "2160-0", "RESULT_UNIT": "mg", "RESULT_NUM": 1.0,
        "SPECIMEN_SOURCE": "BLOOD", "RXNORM_CUI": "1", "RX_START_DATE": "2015-01-10", "NDC": "1",
        "MEDADMIN_CODE": "1", "MEDADMIN_STOP_DATE": "2015-01-11",
    }
    day = timedelta(days=1)
    rows = []
    for when in (d(first) - day, d(first), d(last), d(last) + day, None):
        row = {k: v for k, v in need.items() if k in SCHEMAS[source].names}
        rows.append({**row, "PATID": "p", column: str(when) if when else None})
        rows.append({**row, "PATID": "other", column: str(when) if when else None})
    got = collect_one(output, onset(spark, STAY), {source: table(spark, source, rows)}, oracle_cfg)
    assert sorted(r[column] for r in got.collect()) == [d(first), d(last)]
    assert got.columns[0] == "ONSETS_ENCOUNTERID" and got.columns[-1] == "DAYS_SINCE_ADMIT"


def test_duplicate_onset_rows(spark, oracle_cfg):
    """Two baselines of a stay repeat the rows of outputs that are not distinct."""
    twice = onset(spark, STAY, (*STAY[:4], 1.1, *STAY[5:]))
    rows = [{"PATID": "p", "DX_DATE": "2015-01-12", "DX": "I10"}]
    cdm = {"DIAGNOSIS": table(spark, "DIAGNOSIS", rows)}
    assert collect_one("AKI_DX_CURRENT", twice, cdm, oracle_cfg).count() == 2
    px = {"PROCEDURES": table(spark, "PROCEDURES", [{"PATID": "p", "PX_DATE": "2015-01-12"}] * 2)}
    assert collect_one("AKI_PX", twice, px, oracle_cfg).count() == 1


def test_long_stay_and_overlapping_stays(spark, oracle_cfg):
    df = onset(
        spark,
        ("p", "long", "2015-01-10", "2016-12-31", 1.0, "2015-02-01", None, None, None),
        ("p", "short", "2016-05-01", "2016-05-04", 1.0, "2016-05-02", None, None, None),
    )
    rows = [{"PATID": "p", "MEASURE_DATE": day} for day in ("2015-06-01", "2016-05-02")]
    got = collect_one("AKI_VITAL_OLD", df, {"VITAL": table(spark, "VITAL", rows)}, oracle_cfg)
    pairs = sorted((r.ONSETS_ENCOUNTERID, str(r.MEASURE_DATE)) for r in got.collect())
    assert pairs == [("long", "2015-06-01"), ("long", "2016-05-02"), ("short", "2016-05-02")]


def test_window_that_a_placeholder_date_keeps_open(spark, oracle_cfg):
    df = onset(
        spark,
        ("p", "open", "2015-01-10", "9999-12-30", 1.0, "2015-02-01", None, None, None),
        STAY,
    )
    rows = [{"PATID": "p", "PX_DATE": day} for day in ("2015-01-09", "2015-01-12", "2019-05-02")]
    got = collect_one("AKI_PX", df, {"PROCEDURES": table(spark, "PROCEDURES", rows)}, oracle_cfg)
    pairs = sorted((r.ONSETS_ENCOUNTERID, str(r.PX_DATE)) for r in got.collect())
    assert pairs == [("e", "2015-01-12"), ("open", "2015-01-12"), ("open", "2019-05-02")]


def test_vital_codes(spark, oracle_cfg):
    rows = [
        {"PATID": "p", "OBSCLIN_START_DATE": "2015-01-11", "OBSCLIN_CODE": c}
        for c in ("8480-6", "SMOKING", "99999-9", None)
    ]
    cdm = {"OBS_CLIN": table(spark, "OBS_CLIN", rows)}
    got = collect_one("AKI_VITAL", onset(spark, STAY), cdm, oracle_cfg)
    assert sorted(r.OBSCLIN_CODE for r in got.collect()) == ["8480-6", "SMOKING"]


def test_prescribing(spark):
    base = {"PATID": "p", "RXNORM_CUI": "1", "RX_ORDER_DATE": "2015-01-10",
            "RX_START_DATE": "2015-01-11", "RX_ORDER_TIME": "08:00"}
    rows = [
        {**base, "PRESCRIBINGID": "half", "RX_QUANTITY": 5.0, "RX_DAYS_SUPPLY": 2.0,
         "RX_END_DATE": "2015-01-13"},
        {**base, "PRESCRIBINGID": "zero", "RX_QUANTITY": 5.0, "RX_DAYS_SUPPLY": 0.0,
         "RX_END_DATE": "2015-01-20"},
        {**base, "PRESCRIBINGID": "no_days", "RX_QUANTITY": 5.0},
        {**base, "PRESCRIBINGID": "no_quantity", "RX_DAYS_SUPPLY": 5.0},
        {**base, "PRESCRIBINGID": "no_time", "RX_ORDER_TIME": None},
        {**base, "PRESCRIBINGID": "no_start", "RX_START_DATE": None},
        {**base, "PRESCRIBINGID": "no_cui", "RXNORM_CUI": None},
    ]
    cdm = {"PRESCRIBING": table(spark, "PRESCRIBING", rows)}
    got = {}
    for name in ("oracle", "postgres", "tsql"):
        df = collect_one("AKI_PMED", onset(spark, STAY), cdm, preset(name))
        got[name] = {
            r.PRESCRIBINGID: (r.RX_QUANTITY_DAILY, r.RX_END_DATE_MOD) for r in df.collect()
        }
    assert got["oracle"] == {
        "half": (3.0, d("2015-01-13")), "zero": (None, d("2015-01-15")),
        "no_days": (None, None), "no_quantity": (None, None), "no_time": (None, None),
    }
    assert got["postgres"]["no_days"] == (None, d("2015-01-15"))
    assert "no_time" not in got["postgres"] and "no_time" not in got["tsql"]
    assert got["tsql"]["half"] == (3.0, "20150113") and got["tsql"]["no_days"] == (None, None)


def test_death_and_demographics(spark, oracle_cfg):
    onsets = onset(
        spark, STAY, ("q", "f", *STAY[2:]), ("r", "g", *STAY[2:]), ("s", "h", *STAY[2:])
    )
    death = table(spark, "DEATH", [
        {"PATID": "p", "DEATH_DATE": "2015-01-20", "DEATH_SOURCE": "L"},
        {"PATID": "p", "DEATH_DATE": "2015-01-21", "DEATH_SOURCE": "N"},
    ])
    demo = table(spark, "DEMOGRAPHIC", [
        person("p", "1925-06-01"), person("q", "1925-01-01"), person("r", "1914-01-01"),
    ])
    dead = collect.collect_death(onsets, death).collect()
    assert sorted((r.ONSETS_ENCOUNTERID, r.PATID, r.DDAYS_SINCE_ENC) for r in dead if r.PATID) == [
        ("e", "p", 5), ("e", "p", 6),
    ]
    assert sorted(r.ONSETS_ENCOUNTERID for r in dead if r.PATID is None) == ["f", "g", "h"]
    rows = collect.collect_demographics(onsets, demo, death, oracle_cfg).collect()
    ages = {(r.ONSETS_ENCOUNTERID, r.AGE) for r in rows}
    assert ages == {("e", 90), ("f", 90), ("g", 90), ("h", None)} and len(rows) == 5
    complete = collect.collect_demographics(onsets, demo, death, preset("postgres")).collect()
    assert {(r.ONSETS_ENCOUNTERID, r.AGE) for r in complete} == {
        ("e", 89), ("f", 90), ("g", 90), ("h", None),
    }


def full_site(spark):
    one = {"PATID": "p", "ENCOUNTERID": "e"}
    day = {
        "PROCEDURES": {"PX_DATE": "2015-01-11"},
        "DIAGNOSIS": {"DX_DATE": "2015-01-11", "ADMIT_DATE": "2014-12-01"},
        "LAB_RESULT_CM": {"LAB_ORDER_DATE": "2015-01-11", "SPECIMEN_DATE": "2015-01-11",
                          "RESULT_DATE": "2015-01-12", "RESULT_NUM": 1.0, "RESULT_UNIT": "mg",
                          "SPECIMEN_SOURCE": "BLOOD", "LAB_LOINC": "2160-0"},
        "OBS_CLIN": {"OBSCLIN_START_DATE": "2015-01-11", "OBSCLIN_CODE": "HT"},
        "VITAL": {"MEASURE_DATE": "2015-01-11"},
        "PRESCRIBING": {"RX_ORDER_DATE": "2015-01-11", "RX_START_DATE": "2015-01-11",
                        "RXNORM_CUI": "1", "RX_END_DATE": "2015-01-13"},
        "DISPENSING": {"DISPENSE_DATE": "2015-01-11", "NDC": "1"},
        "MED_ADMIN": {"MEDADMIN_START_DATE": "2015-01-11", "MEDADMIN_STOP_DATE": "2015-01-11",
                      "MEDADMIN_CODE": "1"},
        "DEATH": {"DEATH_DATE": "2015-03-01"},
        "DEMOGRAPHIC": {"BIRTH_DATE": "1950-01-01"},
    }
    return {
        name: table(
            spark, name, [{k: v for k, v in {**one, **row}.items() if k in SCHEMAS[name].names}]
        )
        for name, row in day.items()
    }


def test_sites_without_optional_tables(spark, oracle_cfg):
    cdm = full_site(spark)
    for name in ("OBS_CLIN", "PRESCRIBING", "DISPENSING", "MED_ADMIN"):
        del cdm[name]
    got = collect_all(onset(spark, STAY), cdm, oracle_cfg)
    assert sorted(got) == [
        "AKI_DEMO", "AKI_DEMO_DEATH", "AKI_DX", "AKI_DX_CURRENT", "AKI_DX_CURRENT_ADMIT_DATE",
        "AKI_LAB", "AKI_LAB_SCR", "AKI_PX", "AKI_VITAL_OLD",
    ]


@pytest.mark.parametrize("name", ["oracle", "postgres"])
def test_one_shift_per_patient_across_all_tables(spark, name):
    cfg = preset(name)
    onsets = onset(spark, STAY, (STAY[0], "f", "2016-01-10", "2016-01-15", *STAY[4:]))
    raw = {"AKI_ONSETS": onsets, **collect_all(onsets, full_site(spark), cfg)}
    moved = deidentify_all(onsets, {k: v for k, v in raw.items() if k != "AKI_ONSETS"}, "s3", cfg)
    assert sorted(moved) == sorted(f"DEID_{n}" for n in deid.SHIFTED_DATES)
    shifts = set()
    for table_name, dates in deid.SHIFTED_DATES.items():
        before = raw[table_name].filter("PATID is not null").collect()
        after = moved[f"DEID_{table_name}"].collect()
        assert len(before) == len(after)
        key = "ENCOUNTERID" if table_name == "AKI_ONSETS" else "ONSETS_ENCOUNTERID"
        by_key = {r[key]: r for r in after}
        for r in before:
            for c in dates:
                if c in r.asDict() and r[c] is not None:
                    shifts.add((by_key[r[key]][c] - r[c]).days)
    assert len(shifts) == 1 and cfg.shift_lo <= shifts.pop() <= cfg.shift_hi


def test_shift_range_and_salt(spark, oracle_cfg):
    people = spark.range(4000).selectExpr("'P' || id as PATID")
    one = {r[0]: r[1] for r in deid.date_shift_table(people, "a", oracle_cfg).collect()}
    two = {r[0]: r[1] for r in deid.date_shift_table(people, "b", oracle_cfg).collect()}
    assert min(one.values()) == -365 and max(one.values()) == -1
    assert sum(one[p] == two[p] for p in one) < 100


def test_year_policy_and_text_dates(spark, oracle_cfg):
    onsets = onset(spark, ("p", "e", "2015-01-01", *STAY[3:]))
    shift = frame(spark, "PATID:string date_shift:int", [("p", -10)])
    years = {
        policy: deid.shift_table(
            "AKI_ONSETS", onsets, shift, replace(oracle_cfg, admit_year_policy=policy)
        ).first().asDict().get("ADMIT_YEAR")
        for policy in ("recompute", "drop", "keep")
    }
    assert years == {"recompute": "2014", "drop": None, "keep": "2015"}
    text = frame(spark, "PATID:string RX_END_DATE_MOD:string", [("p", "20150105"), (None, None)])
    moved = deid.shift_table("AKI_PMED", text, shift, preset("tsql")).collect()
    assert [r.RX_END_DATE_MOD for r in moved] == ["20141226"]
