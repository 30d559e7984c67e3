from __future__ import annotations

from dataclasses import replace
from datetime import date

import pytest

from renalis import preset
from renalis.operators import cohort, exclusions
from renalis.plans.pipeline import Extraction
from tests.conftest import d, person, scr, site, stay, table, ts


def ids(df, column="ENCOUNTERID"):
    return sorted(r[column] for r in df.collect())


def extraction(spark, work, cfg, **rows):
    rows.setdefault("DEMOGRAPHIC", [person("p")])
    return Extraction(spark, site(spark, **rows), cfg, work)


def test_initial_cohort_rules(spark, oracle_cfg):
    enc = table(spark, "ENCOUNTER", [
        stay("ok", "p", "2015-01-01 08:00", "2015-01-05 10:00"),
        stay("short", "p", "2015-02-01 08:00", "2015-02-02 23:00"),
        stay("two_days", "p", "2015-03-01 23:00", "2015-03-03 01:00"),
        stay("outpatient", "p", "2015-04-01 08:00", "2015-04-09 08:00", "AV"),
        stay("early", "p", "2009-12-31 08:00", "2010-01-05 08:00"),
        stay("late", "p", "2022-01-01 08:00", "2022-01-05 08:00"),
        stay("child", "kid", "2015-01-01 08:00", "2015-01-05 08:00"),
        stay("stranger", "nobody", "2015-01-01 08:00", "2015-01-05 08:00"),
    ])
    demo = table(spark, "DEMOGRAPHIC", [person("p"), person("kid", "2000-01-01")])
    assert ids(cohort.initial_cohort(enc, demo, oracle_cfg)) == ["ok", "two_days"]


def test_one_admission_per_discharge_date(spark, oracle_cfg):
    enc = table(spark, "ENCOUNTER", [
        stay("second", "p", "2015-01-02 08:00", "2015-01-09 10:00"),
        stay("first", "p", "2015-01-01 08:00", "2015-01-09 11:00"),
        stay("no_time", "p", "2015-01-01", "2015-01-09 11:00"),
    ])
    demo = table(spark, "DEMOGRAPHIC", [person("p")])
    assert ids(cohort.initial_cohort(enc, demo, oracle_cfg)) == ["first"]
    assert len(ids(cohort.initial_cohort(enc, demo, preset("tsql")))) == 3


def test_creatinine_filter(spark, oracle_cfg):
    good = scr("p", "2015-01-01", "2015-01-01 08:00", 1.0)
    lab = table(spark, "LAB_RESULT_CM", [
        {**good, "LAB_RESULT_CM_ID": "good"},
        {**good, "LAB_RESULT_CM_ID": "mg", "RESULT_UNIT": "mg"},
        {**good, "LAB_RESULT_CM_ID": "umol", "RESULT_UNIT": "umol/L"},
        {**good, "LAB_RESULT_CM_ID": "no_unit", "RESULT_UNIT": None},
        {**good, "LAB_RESULT_CM_ID": "urine", "SPECIMEN_SOURCE": "URINE"},
        {**good, "LAB_RESULT_CM_ID": "no_source", "SPECIMEN_SOURCE": None},
        {**good, "LAB_RESULT_CM_ID": "zero", "RESULT_NUM": 0.0},
        {**good, "LAB_RESULT_CM_ID": "other", "LAB_LOINC": "2951-2"},
    ])
    kept = cohort.serum_creatinine_filter(lab, oracle_cfg)
    assert ids(kept, "LAB_RESULT_CM_ID") == ["good", "mg"]
    kept = cohort.serum_creatinine_filter(lab, preset("tsql"))
    assert ids(kept, "LAB_RESULT_CM_ID") == ["good"]


@pytest.mark.parametrize("admit, matched", [("05:00", 0), ("00:00", 1)])
def test_lab_ordered_on_the_admission_day(spark, work, oracle_cfg, admit, matched):
    x = extraction(
        spark, work, oracle_cfg,
        ENCOUNTER=[stay("e", "p", f"2015-01-01 {admit}", "2015-01-05 10:00")],
        LAB_RESULT_CM=[scr("p", "2015-01-01", "2015-01-01 08:00", 1.0)],
    )
    assert x.matched.count() == matched


def test_discharge_day_counts(spark, work, oracle_cfg):
    x = extraction(
        spark, work, oracle_cfg,
        ENCOUNTER=[stay("e", "p", "2015-01-01 05:00", "2015-01-05 00:00")],
        LAB_RESULT_CM=[
            scr("p", "2015-01-05", "2015-01-05 08:00", 1.0),
            scr("p", "2015-01-06", "2015-01-06 08:00", 1.0),
        ],
    )
    assert x.matched.count() == 1


def test_lab_in_two_overlapping_stays(spark, work, oracle_cfg):
    x = extraction(
        spark, work, oracle_cfg,
        ENCOUNTER=[
            stay("a", "p", "2015-01-01 05:00", "2015-01-05 10:00"),
            stay("b", "p", "2015-01-02 05:00", "2015-01-06 10:00"),
        ],
        LAB_RESULT_CM=[scr("p", "2015-01-03", "2015-01-03 08:00", 1.0)],
    )
    assert ids(x.matched) == ["a", "b"]


def test_two_results_of_one_specimen_count_once(spark, work, oracle_cfg):
    labs = [
        scr("p", "2015-01-02", "2015-01-02 08:00", 1.2, "2015-01-02 09:00"),
        scr("p", "2015-01-02", "2015-01-02 08:00", 1.0, "2015-01-02 10:00"),
    ]
    enc = [stay("e", "p", "2015-01-01 05:00", "2015-01-09 10:00")]
    x = extraction(spark, work, oracle_cfg, ENCOUNTER=enc, LAB_RESULT_CM=labs)
    assert ids(cohort.enough_scr(x.matched, x.cfg)) == []
    labs.append(scr("p", "2015-01-03", "2015-01-03 08:00", 1.1))
    y = extraction(spark, work, oracle_cfg, ENCOUNTER=enc, LAB_RESULT_CM=labs)
    assert ids(cohort.enough_scr(y.matched, y.cfg)) == ["e"]
    # Two result times of the first specimen are two baselines, and multiply the later rows.
    assert y.baseline.count() == 2
    assert y.eligible.count() == 6
    assert sorted(r.rn for r in y.scr_egfr.collect()) == [1, 1, 2]


def test_mean_of_equal_times_and_baseline_extremes(spark, work, oracle_cfg):
    labs = [
        scr("p", "2015-01-02", "2015-01-02 08:00", 1.0, ENCOUNTERID="e"),
        scr("p", "2015-01-02", "2015-01-02 08:00", 1.4, ENCOUNTERID="e"),
        scr("p", "2015-01-02", "2015-01-02 08:00", 0.8, ENCOUNTERID="other"),
        scr("p", "2015-01-03", "2015-01-03 08:00", 2.0, ENCOUNTERID="e"),
    ]
    enc = [stay("e", "p", "2015-01-01 05:00", "2015-01-09 10:00")]
    x = extraction(spark, work, oracle_cfg, ENCOUNTER=enc, LAB_RESULT_CM=labs)
    assert sorted(r.SERUM_CREAT for r in x.matched.collect()) == [0.8, 1.2, 2.0]
    base = x.baseline.first()
    rates = {r.SERUM_CREAT: r.EGFR for r in x.matched.collect()}
    assert (base.SERUM_CREAT, base.EGFR) == (0.8, rates[0.8])


@pytest.mark.parametrize("rule, kept", [("distinct_times", []), ("rank", ["e"])])
def test_min_scr_rule_counts_order_dates_or_specimen_times(spark, work, oracle_cfg, rule, kept):
    cfg = replace(oracle_cfg, min_scr_rule=rule)
    labs = [
        scr("p", "2015-01-02", "2015-01-03 08:00", 1.0),
        scr("p", "2015-01-03", "2015-01-03 08:00", 1.0),
    ]
    enc = [stay("e", "p", "2015-01-01 05:00", "2015-01-09 10:00")]
    x = extraction(spark, work, cfg, ENCOUNTER=enc, LAB_RESULT_CM=labs)
    assert ids(cohort.enough_scr(x.matched, cfg)) == kept


def test_missing_specimen_time(spark, work, oracle_cfg):
    labs = [
        {**scr("p", "2015-01-02", "2015-01-02 08:00", 1.0), "SPECIMEN_TIME": None},
        scr("p", "2015-01-02", "2015-01-02 09:00", 1.1),
        scr("p", "2015-01-03", "2015-01-03 09:00", 1.2),
    ]
    enc = [stay("e", "p", "2015-01-01 05:00", "2015-01-09 10:00")]
    null = replace(oracle_cfg, missing_time="null")
    for cfg, first in ((null, "2015-01-02 09:00"), (oracle_cfg, "2015-01-02 00:00")):
        x = extraction(spark, work, cfg, ENCOUNTER=enc, LAB_RESULT_CM=labs)
        assert [r.SPECIMEN_DATE_TIME for r in x.first_scr.collect()] == [ts(first)]


@pytest.mark.parametrize(("name", "found"), [("oracle", 1), ("postgres", 0), ("tsql", 0)])
def test_missing_admission_time(spark, work, name, found):
    """Midnight in one dialect; in the others a stay that no time is inside of."""
    enc = [stay("e", "p", "2015-01-01", "2015-01-09 10:00")]
    labs = [scr("p", "2015-01-01", "2015-01-01 08:00", 1.0, ENCOUNTERID="x")]
    x = extraction(spark, work, preset(name), ENCOUNTER=enc, LAB_RESULT_CM=labs)
    assert x.matched.count() == found


def test_lab_match_presets(spark, work):
    labs = [
        scr("p", "2015-01-02", "2015-01-02 08:00", 1.0, ENCOUNTERID="e"),
        scr("p", "2015-01-03", "2015-01-03 08:00", 1.1, ENCOUNTERID="f"),
        scr("p", "2015-01-04", "2015-01-04 08:00", 1.2, ENCOUNTERID=None),
    ]
    enc = [stay("e", "p", "2015-01-01 05:00", "2015-01-09 10:00")]
    counts = {
        name: extraction(
            spark, work, preset(name), ENCOUNTER=enc, LAB_RESULT_CM=labs
        ).matched.count()
        for name in ("oracle", "postgres", "tsql")
    }
    assert counts == {"oracle": 3, "postgres": 3, "tsql": 2}


def test_prior_day_baseline(spark, work):
    labs = [
        scr("p", "2015-01-01", "2014-12-31 20:00", 0.7, ENCOUNTERID="x"),
        scr("p", "2015-01-01", "2014-12-31 20:00", 0.9, ENCOUNTERID="y"),
        scr("p", "2014-12-30", "2014-12-30 20:00", 0.5, ENCOUNTERID="x"),
        scr("p", "2015-01-02", "2015-01-02 08:00", 1.2, ENCOUNTERID="e"),
        scr("p", "2015-01-03", "2015-01-03 08:00", 1.3, ENCOUNTERID="e"),
    ]
    enc = [stay("e", "p", "2015-01-01 05:00", "2015-01-09 10:00")]
    x = extraction(spark, work, preset("tsql"), ENCOUNTER=enc, LAB_RESULT_CM=labs)
    base = x.baseline.collect()
    assert [(r.SERUM_CREAT, r.LAB_ORDER_DATE, r.days_prior) for r in base] == [
        (0.9, d("2015-01-01"), 1)
    ]


ENC = [stay("e", "p", "2015-01-10 05:00", "2015-01-20 10:00")]
LABS = [
    scr("p", "2015-01-11", "2015-01-11 08:00", 1.0),
    scr("p", "2015-01-12", "2015-01-12 08:00", 1.1),
]


def labels(spark, work, cfg, **rows):
    rows = {"ENCOUNTER": ENC, "LAB_RESULT_CM": LABS, **rows}
    x = extraction(spark, work, cfg, **rows)
    return sorted(r.EXCLUD_TYPE for r in x.exclude_all.collect())


def dx(code, kind, day, source="FI"):
    return {"PATID": "p", "DX": code, "DX_TYPE": kind, "ADMIT_DATE": day, "DX_SOURCE": source}


def px(code, kind, day):
    return {"PATID": "p", "PX": code, "PX_TYPE": kind, "PX_DATE": day}


@pytest.mark.parametrize(
    "row, want",
    [
        (dx("585.6", "09", "2015-01-09"), ["Pre_ESRD"]),
        (dx("585.6", "09", "2015-01-10"), []),
        (dx("585.6", "10", "2015-01-09"), []),
        (dx("Z99.2", "10", "2001-01-01"), ["Pre_RRT"]),
        (dx("T20.1", "10", "2015-01-10", "AD"), ["Burn_patients"]),
        (dx("T20.1", "10", "2015-01-10", "FI"), []),
        (dx("T20.1", "10", "2015-01-09", "AD"), []),
    ],
)
def test_diagnosis_rules(spark, work, oracle_cfg, row, want):
    assert labels(spark, work, oracle_cfg, DIAGNOSIS=[row]) == want


@pytest.mark.parametrize(
    "row, oracle, postgres, tsql",
    [
        (px("90935", "CH", "2015-01-09"), ["Pre_RRT"], ["Pre_RRT"], ["Pre_renal_failure"]),
        (px("50360", "CH", "2015-01-10"), ["RRT_within_48hr"], ["RRT_within_48hr"],
         ["Renal_transplant_within_48hr"]),
        # Dialysis in the first days only counts in one preset.
        (px("90935", "CH", "2015-01-10"), [], [], ["Renal_transplant_within_48hr"]),
        # First specimen 01-11 08:00: the bound is 01-13 08:00, or 01-13 for the one that cuts.
        (px("50360", "CH", "2015-01-13"), ["RRT_within_48hr"], [],
         ["Renal_transplant_within_48hr"]),
        (px("50360", "CH", "2015-01-14"), [], [], []),
    ],
)
def test_procedure_rules(spark, work, row, oracle, postgres, tsql):
    labs = [{**r, "ENCOUNTERID": "e"} for r in LABS]
    for name, want in (("oracle", oracle), ("postgres", postgres), ("tsql", tsql)):
        assert labels(spark, work, preset(name), PROCEDURES=[row], LAB_RESULT_CM=labs) == want, name


def test_low_egfr_and_single_value_rules(spark, work, oracle_cfg):
    high = [{**LABS[0], "RESULT_NUM": 8.0}, LABS[1]]
    assert labels(spark, work, oracle_cfg, LAB_RESULT_CM=high) == ["Initial_GFR_below_15"]
    one = [{**LABS[0], "ENCOUNTERID": "e"}]
    assert labels(spark, work, oracle_cfg, LAB_RESULT_CM=one) == []
    assert labels(spark, work, preset("tsql"), LAB_RESULT_CM=one) == ["Less_than_2_SCr"]


def test_exclusions_and_eligible_are_disjoint(spark, work, oracle_cfg):
    x = extraction(
        spark, work, oracle_cfg,
        ENCOUNTER=[*ENC, stay("later", "p", "2016-01-10 05:00", "2016-01-20 10:00")],
        LAB_RESULT_CM=[
            *LABS,
            scr("p", "2016-01-11", "2016-01-11 08:00", 1.0),
            scr("p", "2016-01-12", "2016-01-12 08:00", 1.0),
        ],
        DIAGNOSIS=[dx("585.6", "09", "2015-06-01")],
    )
    assert ids(x.exclude_all) == ["later"]
    assert set(ids(x.eligible)) == {"e"}
    excluded = exclusions.excl_pre_esrd(x.init, x.cdm["DIAGNOSIS"])
    audit = exclusions.exclusion_audit("pre_esrd", excluded, x.init, x.cdm["DIAGNOSIS"])
    assert [tuple(r)[:3] for r in audit.collect()] == [("later", "09", "585.6")]


def test_window_start_does_not_reach_before_the_study(spark, work):
    cfg = preset("oracle", window_start=date(2015, 1, 10))
    x = extraction(spark, work, cfg, ENCOUNTER=ENC, LAB_RESULT_CM=LABS)
    assert x.matched.count() == 2


@pytest.mark.parametrize("name", ["oracle", "postgres", "tsql"])
def test_stay_that_a_placeholder_date_keeps_open(spark, work, name):
    enc = [
        stay("open", "p", "2015-01-01 05:00", "9999-12-31 10:00"),
        stay("e", "p", "2016-01-01 05:00", "2016-01-09 10:00"),
    ]
    labs = [
        scr("p", day, f"{day} 08:00", 1.0, ENCOUNTERID="x")
        for day in ("2014-12-31", "2015-01-01", "2015-01-02", "2016-01-05", "2019-05-05")
    ]
    x = extraction(spark, work, preset(name), ENCOUNTER=enc, LAB_RESULT_CM=labs)
    got = sorted((r.ENCOUNTERID, str(r.LAB_ORDER_DATE)) for r in x.matched.collect())
    assert got == [
        ("e", "2016-01-05"), ("open", "2015-01-02"), ("open", "2016-01-05"), ("open", "2019-05-05"),
    ]
