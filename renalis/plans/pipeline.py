"""The three runs: extract the cohort, collect its records, shift the dates."""

from __future__ import annotations

import calendar
from dataclasses import dataclass
from datetime import date, timedelta
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from renalis.config import CohortConfig
from renalis.functions.membership import Membership, membership
from renalis.operators import attrition, cohort, collect, deid, exclusions, staging
from renalis.operators.calendar import DayIndex, day_index
from renalis.session import Workspace, folder_exists, tune

Cdm = dict[str, DataFrame]


class DayIndexes:
    """The days that occur in the date columns of a site, each column read once and its index written."""

    def __init__(self, cdm: Cdm, work: Workspace):
        self.cdm, self.work = cdm, work
        self.known: dict[tuple[str, str], DayIndex] = {}

    def of(self, table: str, date_col: str) -> DayIndex:
        key = (table, date_col)
        if key not in self.known:
            days = day_index(self.cdm[table], date_col)
            self.known[key] = DayIndex.of(self.work.cut(days, f"days_{table}_{date_col}"))
        return self.known[key]


class Extraction:
    """Cohort extraction step by step. Steps are built on first use.

    Some steps are cut, that is written and read back: those that several later steps read, and
    small ones that are joined with a large table. A join of two plain scans is what AQE can split
    where a key is hot, and whose small side it can broadcast by measured size. The lab, diagnosis
    and procedure tables are read once each.
    """

    def __init__(self, spark: SparkSession, cdm: Cdm, cfg: CohortConfig, work: Workspace):
        self.spark, self.cdm, self.cfg, self.work = spark, cdm, cfg, work
        self.days = DayIndexes(cdm, work)

    @cached_property
    def stays(self) -> DataFrame:
        """The initial cohort with the traits of its patients."""
        stays = cohort.initial_cohort(
            self.cdm["ENCOUNTER"], self.cdm["DEMOGRAPHIC"], self.cfg, traits=True
        )
        return self.work.cut(stays, "initial_cohort")

    @cached_property
    def initial_cohort(self) -> DataFrame:
        return self.stays.drop(*cohort.TRAITS)

    @cached_property
    def likely(self) -> Membership:
        """Which patients can be in the cohort: what the scans of the clinical tables ask."""
        return Membership.of(self.work.cut(membership(self.stays, "PATID"), "likely"))

    @cached_property
    def all_scr(self) -> DataFrame:
        """Creatinine history as far back as the later steps look, for slices to share."""
        days_back = 2 if self.cfg.baseline_mode == "prior_2d" else 0
        patients = self.work.cut(
            self.stays.select("PATID", *cohort.TRAITS).distinct(), "patients"
        )
        scr = cohort.all_scr_egfr(
            self.cdm["LAB_RESULT_CM"],
            patients,
            cfg=self.cfg,
            since=self.cfg.window_start - timedelta(days=days_back),
            likely=self.likely,
        )
        return self.work.cut(scr, "all_scr")

    @cached_property
    def matched(self) -> DataFrame:
        if self.cfg.lab_match == "patient" and self.cfg.baseline_mode == "first":
            days = self.days.of("LAB_RESULT_CM", "LAB_ORDER_DATE")
            rows = cohort.scr_in_stays(self.cdm["LAB_RESULT_CM"], self.stays, self.cfg, days, self.likely)
            return self.work.cut(rows, "matched")
        return self.scr_by_stay.filter("in_stay").drop("in_stay")

    @cached_property
    def scr_by_stay(self) -> DataFrame:
        """Creatinine next to the stays, for presets that match by encounter or look a day back."""
        lab, days = self.cdm["LAB_RESULT_CM"], self.days.of("LAB_RESULT_CM", "LAB_ORDER_DATE")
        rows = cohort.scr_by_stay(lab, self.stays, self.guests, self.cfg, days, self.likely)
        return self.work.cut(rows, "scr_by_stay")

    @cached_property
    def guests(self) -> DataFrame | None:
        """Stays that labs of other patients name; None, and no further look at the labs, without any."""
        if self.cfg.lab_match == "patient":
            return None
        lab = self.cdm["LAB_RESULT_CM"]
        contested = cohort.contested_stays(lab, self.stays, self.cfg, self.likely)
        contested = self.work.cut(contested, "contested")
        if contested.isEmpty():
            return None
        guests = cohort.guest_stays(lab, contested, self.stays, self.cfg, self.likely)
        return self.work.cut(guests, "guests")

    @property
    def prior_scr(self) -> DataFrame:
        """Where a value of the day before a stay's first one is, if there is one.

        As it is earlier than the first, it does not match the stay.
        """
        return self.scr_by_stay.filter("not in_stay")

    @cached_property
    def scr_egfr(self) -> DataFrame:
        return cohort.aki_scr_egfr(self.matched, self.cfg)

    @cached_property
    def first_scr(self) -> DataFrame:
        return cohort.first_scr(self.matched, self.cfg)

    @cached_property
    def baseline(self) -> DataFrame:
        if self.cfg.baseline_mode == "prior_2d":
            return cohort.baseline_prior_2d(self.first_scr, self.prior_scr)
        return cohort.baseline_first(self.first_scr)

    @cached_property
    def init(self) -> DataFrame:
        return cohort.eligible_start(
            self.initial_cohort, cohort.require_two_scr(self.matched, self.cfg)
        )

    @cached_property
    def code_history(self) -> DataFrame:
        history = exclusions.code_history(
            exclusions.coded_diagnoses(self.cdm["DIAGNOSIS"]),
            exclusions.coded_procedures(self.cdm["PROCEDURES"]),
            self.cfg,
            self.stays,
            self.likely,
        )
        return self.work.cut(history, "code_history")

    @cached_property
    def screened(self) -> DataFrame:
        flags = exclusions.screen_stays(self.baseline, self.code_history, self.matched, self.cfg)
        return self.work.cut(flags, "screened")

    @cached_property
    def exclude_all(self) -> DataFrame:
        return exclusions.exclude_all(self.screened, self.cfg)

    @cached_property
    def eligible_base(self) -> DataFrame:
        return exclusions.not_excluded(self.screened)

    @cached_property
    def eligible(self) -> DataFrame:
        """With the rank rn, which no later step needs."""
        return cohort.eligible(self.matched, self.eligible_base, self.cfg)

    @cached_property
    def eligible_unranked(self) -> DataFrame:
        # The baselines already come from qualifying stays only.
        return cohort.eligible(self.matched, self.eligible_base)

    @cached_property
    def rrt(self) -> DataFrame:
        """First transplant day per eligible baseline, from the screening's pass."""
        return staging.rrt_of_baselines(self.eligible_base)

    @cached_property
    def stage_events(self) -> DataFrame:
        return staging.stage_events(self.eligible_unranked, self.rrt, self.cfg)

    @cached_property
    def rank_stages(self) -> DataFrame:
        return staging.rank_stages(self.stage_events, self.cfg)

    @cached_property
    def worst_per_day(self) -> DataFrame:
        events = staging.daily_candidates(self.eligible_unranked, self.cfg)
        if self.cfg.rrt_stage3:
            events = events.unionByName(staging.rrt_events(self.rrt).select(*staging.EVENT))
        return staging.worst_per_day(events, self.cfg)

    @cached_property
    def stages_daily(self) -> DataFrame:
        return staging.stages_daily(self.worst_per_day)

    @cached_property
    def aki_onsets(self) -> DataFrame:
        return staging.aki_onsets(self.stages_daily, self.cfg)

    @cached_property
    def onsets(self) -> DataFrame:
        """The onset table, written, for the many readers of the collection step."""
        return self.work.cut(self.aki_onsets, "aki_onsets")

    @cached_property
    def marks(self) -> DataFrame:
        # Each qualifying stay has a screened baseline.
        return attrition.marks(
            self.initial_cohort, self.screened, self.exclude_all, self.onsets, self.cfg
        )

    @cached_property
    def counts(self) -> DataFrame:
        """Attrition of both eras, counted once."""
        return self.work.cut(attrition.consort(self.marks), "consort")

    def consort(self, era: str) -> DataFrame:
        return attrition.of_era(self.counts, era)


class Slice(Extraction):
    """The part of an extraction that concerns stays admitted in a span of days.

    What looks back beyond the span, or across stays, is the whole extraction's: which stays form the
    cohort, the creatinine history, the history of codes, the calendars. From the match on each step
    works stay by stay. Stays without an admission time belong to the first slice.
    """

    def __init__(self, whole: Extraction, low: date, high: date, first: bool, work: Workspace):
        super().__init__(whole.spark, whole.cdm, whole.cfg, work)
        self.whole, self.low, self.high, self.first = whole, low, high, first
        self.days = whole.days

    @cached_property
    def stays(self) -> DataFrame:
        admitted = F.col("ADMIT_DATE_TIME").cast("date")
        inside = admitted.between(F.lit(self.low), F.lit(self.high))
        if self.first:
            inside = inside | admitted.isNull()
        return self.work.cut(self.whole.stays.filter(inside), "initial_cohort")

    @cached_property
    def all_scr(self) -> DataFrame:
        return self.whole.all_scr

    @cached_property
    def scr_by_stay(self) -> DataFrame:
        """From the history, which is averaged once for all slices."""
        days = self.days.of("LAB_RESULT_CM", "LAB_ORDER_DATE")
        rows = cohort.match_labs_to_encounter(self.all_scr, self.initial_cohort, self.cfg, days)
        return self.work.cut(rows.withColumn("in_stay", F.lit(True)), "matched")

    @property
    def prior_scr(self) -> DataFrame:
        return self.all_scr

    @cached_property
    def code_history(self) -> DataFrame:
        return self.whole.code_history


@dataclass
class CohortResult:
    """The deliverables of an extraction."""

    onsets: DataFrame
    consort_bc: DataFrame
    consort_ad: DataFrame


def extract(spark: SparkSession, cdm: Cdm, cfg: CohortConfig, work: Workspace) -> CohortResult:
    """The results read tables of ``work``: clear it after their last use."""
    run = Extraction(tune(spark), cdm, cfg, work)
    return CohortResult(run.onsets, run.consort(attrition.BEFORE), run.consort(attrition.AFTER))


def spans(low: date, high: date, months: int) -> list[tuple[date, date]]:
    """Consecutive spans of days of so many months each, the last one cut at the end."""
    found, start = [], low
    while start <= high:
        year, month = divmod(low.year * 12 + low.month - 1 + months * (len(found) + 1), 12)
        after = date(year, month + 1, min(low.day, calendar.monthrange(year, month + 1)[1]))
        found.append((start, min(high, after - timedelta(days=1))))
        start = after
    return found


def extract_slices(
    spark: SparkSession, cdm: Cdm, cfg: CohortConfig, work: Workspace, out: str, months: int = 12
) -> CohortResult:
    """extract() slice by slice of the study window, for sites whose whole cohort is too much at once.

    Match, ranks and staging hold the stays of one slice; the results are those of the whole run. Each
    slice is a partition under ``out``, written once: a run that was lost goes on with the first slice
    that is not there. ``out`` belongs to one site and configuration; delete the partition of a slice
    to have it made again. Encounter identifiers are taken to name one stay.
    """
    whole = Extraction(tune(spark), cdm, cfg, work)
    for number, (low, high) in enumerate(spans(cfg.window_start, cfg.window_end, months)):
        targets = {name: f"{out}/{name}/admitted={low}" for name in ("onsets", "marks")}
        missing = [n for n, t in targets.items() if not folder_exists(spark, f"{t}/_SUCCESS")]
        if not missing:
            continue
        with Workspace(spark) as own:
            part = Slice(whole, low, high, number == 0, own)
            tables = {"onsets": part.onsets, "marks": part.marks}
            for name in missing:
                tables[name].write.mode("overwrite").parquet(targets[name])
    stored = spark.read.option("basePath", f"{out}/marks").parquet(f"{out}/marks")
    counts = work.cut(attrition.consort(stored.drop("admitted")), "consort")
    onsets = spark.read.option("basePath", f"{out}/onsets").parquet(f"{out}/onsets").drop("admitted")
    return CohortResult(
        onsets, attrition.of_era(counts, attrition.BEFORE), attrition.of_era(counts, attrition.AFTER)
    )


def collect_one(
    name: str,
    onsets: DataFrame,
    cdm: Cdm,
    cfg: CohortConfig,
    days: DayIndexes | None = None,
    patients: Membership | None = None,
) -> DataFrame | None:
    """One windowed output; None where the site has no such table."""
    spec = collect.COLLECTIONS[name]
    if spec.table not in cdm:
        return None
    index = days.of(spec.table, spec.date_col) if days else None
    return collect.collect_window(
        onsets, cdm[spec.table], spec, cfg, cfg.window_start, index, patients
    )


def collect_all(
    onsets: DataFrame, cdm: Cdm, cfg: CohortConfig, work: Workspace | None = None
) -> dict[str, DataFrame]:
    """All outputs for which the site has the source table.

    With a workspace, outputs of one table share the index of its days, else each reads the dates; and
    scans drop the rows of patients without an onset row.
    """
    tune(onsets.sparkSession)
    days = DayIndexes(cdm, work) if work else None
    patients = Membership.of(work.cut(membership(onsets, "PATID"), "likely")) if work else None
    tables = {
        "AKI_DEMO_DEATH": collect.collect_death(onsets, cdm["DEATH"]),
        "AKI_DEMO": collect.collect_demographics(onsets, cdm["DEMOGRAPHIC"], cdm["DEATH"], cfg),
    }
    for name in collect.COLLECTIONS:
        table = collect_one(name, onsets, cdm, cfg, days, patients)
        if table is not None:
            tables[name] = table
    return tables


def deidentify_all(
    onsets: DataFrame, collected: dict[str, DataFrame], salt: str, cfg: CohortConfig
) -> dict[str, DataFrame]:
    return deid.deidentify({"AKI_ONSETS": onsets, **collected}, salt, cfg)
