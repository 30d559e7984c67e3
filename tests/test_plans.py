"""Shape of the physical plans, and the behaviour with hot keys."""

from __future__ import annotations

import re
from contextlib import contextmanager

import pytest
from pyspark.sql import functions as F

from renalis.operators import cohort, collect, exclusions
from renalis.plans.pipeline import Extraction, collect_one
from tests.conftest import person, scr, site, stay, table


@contextmanager
def settings(spark, **conf):
    conf = {k.replace("__", "."): v for k, v in conf.items()}
    before = {k: spark.conf.get(k, None) for k in conf}
    for k, v in conf.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


NO_BROADCAST = {"spark__sql__autoBroadcastJoinThreshold": "-1"}


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def executed(df) -> str:
    df.collect()
    return plan(df).split("== Initial Plan ==")[0]


def without_subqueries(text: str) -> str:
    """The lines of a plan but for those of its scalar subqueries, which read a date column."""
    kept, skipped = [], None
    for line in text.splitlines():
        depth = len(line) - len(line.lstrip(" :+-"))
        if skipped is not None and depth > skipped:
            continue
        skipped = depth if line.lstrip(" :+-").startswith(("Subquery", "ReusedSubquery")) else None
        if skipped is None:
            kept.append(line)
    return "\n".join(kept)


def shuffles(text: str) -> int:
    return len(re.findall(r"Exchange (?:hash|range|Single)", without_subqueries(text)))


def parquet_site(spark, work, **rows):
    return {n: work.cut(df, f"src_{n}") for n, df in site(spark, **rows).items()}


@pytest.fixture
def cdm(spark, work):
    return parquet_site(
        spark,
        work,
        ENCOUNTER=[stay("e", "p", "2015-01-01 05:00", "2015-01-09 10:00")],
        DEMOGRAPHIC=[person("p")],
        LAB_RESULT_CM=[
            scr("p", "2015-01-02", "2015-01-02 08:00", 1.0),
            scr("p", "2015-01-03", "2015-01-03 08:00", 1.6),
        ],
    )


def test_filters_and_columns_reach_the_scans(spark, work, cdm, oracle_cfg):
    with settings(spark, spark__sql__maxMetadataStringLength="2000"):
        _check_scans(spark, work, cdm, oracle_cfg)


def _check_scans(spark, work, cdm, oracle_cfg):
    text = plan(cohort.initial_cohort(cdm["ENCOUNTER"], cdm["DEMOGRAPHIC"], oracle_cfg))
    assert "In(ENC_TYPE, [EI,IP,IS])" in text
    assert "GreaterThanOrEqual(ADMIT_DATE,2010-01-01)" in text
    x = Extraction(spark, cdm, oracle_cfg, work)
    text = plan(cohort.scr_in_stays(cdm["LAB_RESULT_CM"], x.stays, oracle_cfg))
    assert "GreaterThan(RESULT_NUM,0.0)" in text
    assert "GreaterThanOrEqual(LAB_ORDER_DATE,2010-01-01)" in text
    assert "RAW_FACILITY_CODE" not in text
    text = plan(collect_one("AKI_PX", x.onsets, cdm, oracle_cfg))
    assert "GreaterThanOrEqual(PX_DATE,2010-01-01)" in text


def test_lab_rows_cross_the_network_once(spark, work, cdm, oracle_cfg):
    with settings(spark, **NO_BROADCAST):
        x = Extraction(spark, cdm, oracle_cfg, work)
        stays = x.stays
        text = executed(cohort.scr_in_stays(cdm["LAB_RESULT_CM"], stays, oracle_cfg))
    assert shuffles(text) == 2, text
    assert "Cartesian" not in text and "NestedLoop" not in text


def test_rank_one_filters_limit_before_the_shuffle(spark, work, cdm, oracle_cfg):
    with settings(spark, **NO_BROADCAST):
        x = Extraction(spark, cdm, oracle_cfg, work)
        text = plan(x.first_scr)
    assert text.count("WindowGroupLimit") >= 2


def test_staging_reuses_one_partitioning(spark, work, cdm, oracle_cfg):
    with settings(spark, **NO_BROADCAST):
        x = Extraction(spark, cdm, oracle_cfg, work)
        screened = x.screened
        assert screened.count() == 1
        text = executed(x.stages_daily)
    assert "Cartesian" not in text and "NestedLoop" not in text
    # matched and eligible baselines, once per branch of the union at most.
    assert shuffles(text) <= 3, text


def test_code_tables_are_read_once_for_all_rules(spark, work, cdm, oracle_cfg):
    text = plan(exclusions.code_history(cdm["DIAGNOSIS"], cdm["PROCEDURES"], oracle_cfg))
    # A hash aggregate sends each day of a patient once; the sets are built from what is left.
    assert text.count("FileScan") == 2 and shuffles(text) == 2
    tree = [line for line in text.splitlines() if "Aggregate" in line or "Exchange" in line]
    assert "HashAggregate" in tree[-1] and "ObjectHash" not in tree[-1]


def test_distinct_of_a_collection_needs_no_shuffle(spark, work, cdm, oracle_cfg):
    with settings(spark, **NO_BROADCAST):
        x = Extraction(spark, cdm, oracle_cfg, work)
        onsets = x.onsets
        text = executed(collect_one("AKI_PX", onsets, cdm, oracle_cfg))
    # One for the procedures, at most two for the windows (their own distinct).
    assert shuffles(text) <= 3, text


def test_no_python_in_the_plans(spark, work, cdm, oracle_cfg):
    x = Extraction(spark, cdm, oracle_cfg, work)
    for df in (x.aki_onsets, x.consort("BC"), collect_one("AKI_LAB", x.onsets, cdm, oracle_cfg)):
        assert "Python" not in plan(df) and "Pandas" not in plan(df)


SMALL_SKEW = {
    **NO_BROADCAST,
    "spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes": "20KB",
    "spark__sql__adaptive__skewJoin__skewedPartitionFactor": "2",
    "spark__sql__adaptive__advisoryPartitionSizeInBytes": "20KB",
    "spark__sql__adaptive__coalescePartitions__parallelismFirst": "false",
}


def test_hot_patient_in_the_lab_match(spark, work, oracle_cfg):
    """A third of the labs of one patient over a year spread over the day key by themselves."""
    enc = table(spark, "ENCOUNTER", [
        stay("hot", "p0", "2015-01-01 00:00", "2015-12-31 10:00"),
        *[stay(f"e{i}", f"p{i}", "2015-01-01 00:00", "2015-01-20 10:00") for i in range(1, 60)],
    ])
    demo = table(spark, "DEMOGRAPHIC", [person(f"p{i}") for i in range(60)])
    lab = (
        spark.range(6000)
        .withColumn("PATID", F.expr("if(id % 3 = 0, 'p0', 'p' || (id % 59 + 1))"))
        .withColumn("day", F.expr("cast(if(id % 3 = 0, id % 360, id % 19) as int)"))
        .selectExpr(
            "PATID", "'x' as ENCOUNTERID", "'2160-0' as LAB_LOINC", "'mg/dL' as RESULT_UNIT",
            "'BLOOD' as SPECIMEN_SOURCE", "cast(1 + id % 7 as double) as RESULT_NUM",
            "date_add(date'2015-01-01', day) as LAB_ORDER_DATE",
            "date_add(date'2015-01-01', day) as SPECIMEN_DATE",
            "lpad(cast(cast(id % 23 as int) as string), 2, '0') || ':00' as SPECIMEN_TIME",
            "date_add(date'2015-01-01', day) as RESULT_DATE", "'23:00' as RESULT_TIME",
        )
    )
    stays = work.cut(cohort.initial_cohort(enc, demo, oracle_cfg, traits=True), "stays")
    got = cohort.scr_in_stays(lab, stays, oracle_cfg)
    want = (
        lab.groupBy("PATID", "LAB_ORDER_DATE", "SPECIMEN_TIME")
        .agg(F.round(F.avg("RESULT_NUM"), 6).alias("SERUM_CREAT"))
        .count()
    )
    assert got.count() == want


def test_hot_slot_is_split_by_adaptive_execution(spark, work, oracle_cfg):
    """One patient and month with most rows: the join partition is split, the result is whole."""
    px = work.cut(
        spark.range(60000).selectExpr(
            "cast(id as string) as PROCEDURESID",
            "if(id % 3 <> 0, 'hot', 'p' || (id % 500)) as PATID",
            "date_add(date'2015-01-02', cast(id % 4 as int)) as PX_DATE",
            "sha2(cast(id as string), 256) as RAW_PX",
        ),
        "px",
    )
    rows = [("hot" if i == 0 else f"p{i}", f"e{i}") for i in range(500)]
    onsets = work.cut(
        spark.createDataFrame(rows, "PATID string, ENCOUNTERID string").selectExpr(
            "*", "date'2015-01-01' as ADMIT_DATE", "date'2015-01-09' as DISCHARGE_DATE",
            "date'2015-01-05' as NONAKI_ANCHOR", "cast(null as date) as AKI1_ONSET",
            "cast(null as date) as AKI2_ONSET", "cast(null as date) as AKI3_ONSET",
        ),
        "onsets",
    )
    with settings(spark, **SMALL_SKEW):
        got = collect.collect_window(
            onsets, px, collect.COLLECTIONS["AKI_DX_CURRENT"].__class__(
                "T", "PROCEDURES", "PX_DATE", distinct=False
            ), oracle_cfg,
        )
        text = executed(got)
        assert "skew=true" in text, text
        names = {r[0] for r in rows}
        want = px.filter(F.col("PATID").isin(*names)).count()
        assert got.count() == want
        distinct = collect_one("AKI_PX", onsets, {"PROCEDURES": px}, oracle_cfg)
        text = executed(distinct)
        assert "skew=true" in text, text
        assert distinct.count() == want


def test_hot_stay_in_the_staging(spark, work, oracle_cfg):
    """One stay with most of the creatinine rows: its partition is split and reduced early."""
    from renalis.operators import staging

    matched = work.cut(
        spark.range(60000).selectExpr(
            "'p' || if(id % 3 <> 0, 0, 1 + id % 500) as PATID",
            "'e' || if(id % 3 <> 0, 0, 1 + id % 500) as ENCOUNTERID",
            "round(0.5 + (id * 37 % 100) / 40, 2) as SERUM_CREAT", "50.0D as EGFR",
            "timestamp_ntz'2015-01-01 00:00:00'"
            " + make_dt_interval(0, 0, cast(id * 7919 % 20000 as int), 0) as SPECIMEN_DATE_TIME",
        ).withColumn("RESULT_DATE_TIME", F.col("SPECIMEN_DATE_TIME")),
        "matched",
    )
    base = work.cut(
        spark.range(501).selectExpr(
            "'e' || id as ENCOUNTERID", "timestamp_ntz'2015-01-01 00:00:00' as ADMIT_DATE_TIME",
            "timestamp_ntz'2015-02-01 00:00:00' as DISCHARGE_DATE_TIME", "1.0D as SERUM_CREAT",
            "timestamp_ntz'2015-01-01 00:00:00' as SPECIMEN_DATE_TIME",
            "timestamp_ntz'2015-01-01 00:00:00' as RESULT_DATE_TIME",
        ),
        "base",
    )

    def worst():
        points = staging.daily_candidates(cohort.eligible(matched, base), oracle_cfg)
        return staging.worst_per_day(points, oracle_cfg)

    plain = sorted(map(str, worst().collect()))
    with settings(spark, **SMALL_SKEW):
        df = worst()
        text = executed(df)
        assert "skew=true" in text, text
        assert sorted(map(str, df.collect())) == plain


def test_hot_patient_in_the_initial_cohort(spark, work, oracle_cfg):
    enc = work.cut(
        spark.range(40000).selectExpr(
            "'e' || id as ENCOUNTERID", "'p' || if(id % 3 <> 0, 0, 1 + id % 500) as PATID",
            "'IP' as ENC_TYPE", "date_add(date'2011-01-01', cast(id % 3000 as int)) as ADMIT_DATE",
            "'08:00' as ADMIT_TIME",
            "date_add(date'2011-01-01', cast(id % 3000 + 2 + id % 5 as int)) as DISCHARGE_DATE",
            "'09:00' as DISCHARGE_TIME",
        ),
        "enc",
    )
    demo = work.cut(
        spark.range(501).selectExpr("'p' || id as PATID", "date'1950-01-01' as BIRTH_DATE"), "demo"
    )
    plain = cohort.initial_cohort(enc, demo, oracle_cfg).count()
    assert plain == enc.select("PATID", "DISCHARGE_DATE").distinct().count()
    with settings(spark, **SMALL_SKEW):
        df = cohort.initial_cohort(enc, demo, oracle_cfg)
        text = executed(df)
        assert "skew=true" in text, text
        assert df.count() == plain


@pytest.mark.parametrize("output", ["AKI_PX", "AKI_LAB"])
def test_open_ended_window_reads_the_wide_table_once(spark, work, oracle_cfg, cdm, output):
    """One wide read for windows of every length, and one of the date column alone."""
    cdm["PROCEDURES"] = work.cut(
        table(spark, "PROCEDURES", [{"PATID": "p", "PX_DATE": "2015-01-05", "PX": "x"}]), "px"
    )
    x = Extraction(spark, cdm, oracle_cfg, work)
    onsets = work.cut(
        x.aki_onsets.withColumn("DISCHARGE_DATE", F.lit("9999-12-30").cast("date")), "open"
    )
    with settings(spark, **NO_BROADCAST):
        text = plan(collect_one(output, onsets, cdm, oracle_cfg))
    spec = collect.COLLECTIONS[output]
    scans = {m for m in re.findall(r"FileScan parquet \[([^\]]*)\]", text) if spec.date_col in m}
    wide = {m for m in scans if "PATID" in m}
    assert len(wide) == 1
    assert without_subqueries(text).count(f"FileScan parquet [{wide.pop()}]") == 1
    # The filters of a collection may need columns besides the date.
    assert all(len(m.split(",")) <= 4 for m in scans if "PATID" not in m)


def test_nothing_runs_while_a_collection_is_planned(spark, work, oracle_cfg, cdm):
    onsets = Extraction(spark, cdm, oracle_cfg, work).onsets
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("planning", "planning")
    collect_one("AKI_LAB", onsets, cdm, oracle_cfg)
    assert not tracker.getJobIdsForGroup("planning")
