"""Exclusion rules, evaluated per stay against one row of code history per patient."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from renalis.config import CohortConfig
from renalis.functions.codes import code_match, in_any_set
from renalis.functions.membership import Membership
from renalis.operators.cohort import enough_scr

# Flag columns of the screened stays.
LOW_EGFR, ESRD, RRT = "low_egfr", "esrd", "rrt"
RRT_48H, BURN, FEW_SCR = "rrt_48h", "burn", "few_scr"


def coded_diagnoses(diagnosis: DataFrame) -> DataFrame:
    """The diagnoses whose code some rule looks at, picked before they are joined or shuffled."""
    return diagnosis.filter(in_any_set(["ESRD_DX", "RRT_DX", "BURN_DX"], "DX_TYPE", "DX"))


def coded_procedures(procedures: DataFrame) -> DataFrame:
    """The procedures whose code some rule looks at, picked before they are joined or shuffled."""
    return procedures.filter(in_any_set(["DIALYSIS_PX", "TRANSPLANT_PX"], "PX_TYPE", "PX"))


def _diagnosis_days(diagnosis: DataFrame) -> DataFrame:
    esrd = code_match("ESRD_DX", "DX_TYPE", "DX")
    rrt = code_match("RRT_DX", "DX_TYPE", "DX")
    burn = code_match("BURN_DX", "DX_TYPE", "DX") & (F.col("DX_SOURCE") == "AD")
    day = F.to_date("ADMIT_DATE")
    # No filter on the codes: where they are computed, it would compute them anew in each comparison.
    return diagnosis.select(
        "PATID",
        F.when(esrd, day).alias("ESRD"),
        F.when(rrt, day).alias("RRT_DX"),
        F.when(burn, day).alias("BURN"),
    )


def _procedure_days(procedures: DataFrame, cfg: CohortConfig) -> DataFrame:
    transplant = code_match("TRANSPLANT_PX", "PX_TYPE", "PX")
    dialysis = code_match("DIALYSIS_PX", "PX_TYPE", "PX")
    counted = transplant | dialysis if cfg.rrt48_counts_dialysis else transplant
    day = F.to_date("PX_DATE")
    return procedures.select(
        "PATID",
        F.when(transplant | dialysis, day).alias("RRT_PX"),
        F.when(transplant, day).alias("TRANSPLANT"),
        F.when(counted, day).alias("RRT48"),
    )


# History column -> the day column it summarises, and how.
_FROM_DIAGNOSES = {
    "FIRST_ESRD": ("ESRD", F.min),
    "FIRST_RRT_DX": ("RRT_DX", F.min),
    "BURN_DAYS": ("BURN", F.collect_list),
}
_FROM_PROCEDURES = {
    "FIRST_RRT_PX": ("RRT_PX", F.min),
    "TRANSPLANT_DAYS": ("TRANSPLANT", F.collect_list),
    "RRT48_DAYS": ("RRT48", F.collect_list),
}


def _kinds(days: DataFrame) -> DataFrame:
    """(PATID, kind, day) of the codes that count; all other rows end here."""
    kinds = [
        F.struct(F.lit(c).alias("kind"), F.col(c).alias("day")) for c in days.columns if c != "PATID"
    ]
    each = days.select("PATID", F.inline(F.array(*kinds)))
    return each.filter("day is not null")


def _per_patient(kinds: DataFrame, summary: dict) -> DataFrame:
    """Lists of days are built last, from rows that are distinct already.

    Each kind and day of a patient is sent on once, however many codes there are.
    """
    return (
        kinds.distinct()
        .groupBy("PATID")
        .agg(
            *[
                how(F.when(F.col("kind") == kind, F.col("day"))).alias(name)
                for name, (kind, how) in summary.items()
            ]
        )
    )


def diagnosis_history(diagnosis: DataFrame) -> DataFrame:
    """One row per patient: first ESRD and RRT diagnosis dates, and the days of burn admissions.

    "A diagnosis before the admission" only needs the first date, so the pre-aggregated minimum
    replaces the semi-join; a set of dates cannot exceed the calendar.
    """
    return _per_patient(_kinds(_diagnosis_days(coded_diagnoses(diagnosis))), _FROM_DIAGNOSES)


def procedure_history(procedures: DataFrame, cfg: CohortConfig) -> DataFrame:
    """One row per patient: first dialysis or transplant, and the days the later rules look at."""
    days = _procedure_days(coded_procedures(procedures), cfg)
    return _per_patient(_kinds(days), _FROM_PROCEDURES)


def code_history(
    diagnosis: DataFrame,
    procedures: DataFrame,
    cfg: CohortConfig,
    patients: DataFrame | None = None,
    likely: Membership | None = None,
) -> DataFrame:
    """Both histories in one row per patient: one pass over each table, one shuffle for both.

    ``patients`` (PATID) limits it to the cohort's; ``likely`` drops most others at the scan.
    """
    if likely is not None:
        diagnosis, procedures = (t.filter(likely.may_have("PATID")) for t in (diagnosis, procedures))
    days = _diagnosis_days(diagnosis).unionByName(
        _procedure_days(procedures, cfg), allowMissingColumns=True
    )
    kinds = _kinds(days)
    if patients is not None:
        kinds = kinds.join(patients.select("PATID"), "PATID", "left_semi")
    return _per_patient(kinds, {**_FROM_DIAGNOSES, **_FROM_PROCEDURES})


def _admit_day() -> Column:
    return F.to_date("ADMIT_DATE_TIME")


def _before_admission(first_date: str) -> Column:
    return F.coalesce(F.col(first_date) < _admit_day(), F.lit(False))


def _within_48h(first_time: str, cfg: CohortConfig) -> Column:
    bound = F.col(first_time) + F.expr("INTERVAL 2 DAYS")
    if cfg.rrt48_trunc:
        bound = F.date_add(F.to_date(first_time), 2)
    hit = F.exists("RRT48_DAYS", lambda d: (d >= _admit_day()) & (d < bound))
    return F.coalesce(hit, F.lit(False))


def _burn_admission() -> Column:
    return F.coalesce(F.array_contains("BURN_DAYS", _admit_day()), F.lit(False))


def _low_egfr(value: Column, cfg: CohortConfig) -> Column:
    return value <= cfg.egfr_cut if cfg.egfr_cut_inclusive else value < cfg.egfr_cut


def excl_low_egfr(first: DataFrame, cfg: CohortConfig) -> DataFrame:
    """Stays whose first eGFR is under the cut."""
    return first.filter(_low_egfr(F.col("EGFR"), cfg)).select("ENCOUNTERID").distinct()


def excl_pre_esrd(init: DataFrame, diagnosis: DataFrame) -> DataFrame:
    """Stays of patients with an end-stage renal disease diagnosis before the admission day."""
    history = diagnosis_history(diagnosis).select("PATID", "FIRST_ESRD")
    return init.join(history, "PATID").filter(_before_admission("FIRST_ESRD")).select("ENCOUNTERID")


def excl_pre_rrt_dx(init: DataFrame, diagnosis: DataFrame) -> DataFrame:
    """Stays of patients with a dialysis or transplant diagnosis before the admission day."""
    history = diagnosis_history(diagnosis).select("PATID", "FIRST_RRT_DX")
    return (
        init.join(history, "PATID").filter(_before_admission("FIRST_RRT_DX")).select("ENCOUNTERID")
    )


def excl_pre_rrt_px(init: DataFrame, procedures: DataFrame, cfg: CohortConfig) -> DataFrame:
    """Stays of patients with a dialysis or transplant procedure before the admission day."""
    history = procedure_history(procedures, cfg).select("PATID", "FIRST_RRT_PX")
    return (
        init.join(history, "PATID").filter(_before_admission("FIRST_RRT_PX")).select("ENCOUNTERID")
    )


def excl_pre_rrt(
    init: DataFrame, diagnosis: DataFrame, procedures: DataFrame, cfg: CohortConfig
) -> DataFrame:
    return (
        excl_pre_rrt_dx(init, diagnosis)
        .unionByName(excl_pre_rrt_px(init, procedures, cfg))
        .distinct()
    )


def excl_rrt_48h(first: DataFrame, procedures: DataFrame, cfg: CohortConfig) -> DataFrame:
    """Stays with a renal procedure from the admission day to 48 hours after the first specimen."""
    history = procedure_history(procedures, cfg).select("PATID", "RRT48_DAYS")
    stays = first.select("ENCOUNTERID", "PATID", "ADMIT_DATE_TIME", "SPECIMEN_DATE_TIME").distinct()
    hit = _within_48h("SPECIMEN_DATE_TIME", cfg)
    return stays.join(history, "PATID").filter(hit).select("ENCOUNTERID").distinct()


def excl_burn(init: DataFrame, diagnosis: DataFrame) -> DataFrame:
    """Stays admitted with a burn."""
    history = diagnosis_history(diagnosis).select("PATID", "BURN_DAYS")
    return init.join(history, "PATID").filter(_burn_admission()).select("ENCOUNTERID").distinct()


def excl_few_scr(matched: DataFrame, cfg: CohortConfig) -> DataFrame:
    """Stays with a single creatinine time (presets that exclude them here)."""
    return (
        matched.select("ENCOUNTERID")
        .distinct()
        .join(enough_scr(matched, cfg), "ENCOUNTERID", "left_anti")
    )


def first_transplant_day(cfg: CohortConfig) -> Column:
    """First transplant day of the patient, within the stay where the preset says so."""
    days = F.col("TRANSPLANT_DAYS")
    if cfg.rrt_bounded:
        days = F.filter(
            days,
            lambda d: d.cast("timestamp_ntz").between(
                F.col("ADMIT_DATE_TIME"), F.col("DISCHARGE_DATE_TIME")
            ),
        )
    return F.array_min(days)


def screen_stays(
    baseline: DataFrame, history: DataFrame, matched: DataFrame, cfg: CohortConfig
) -> DataFrame:
    """The baselines with a flag per rule, and the first transplant day in the stay.

    One join answers all rules; the result serves eligibility, staging and the attrition counts.
    """
    stay = Window.partitionBy("ENCOUNTERID")
    stays = baseline.withColumn("FIRST_EGFR", F.min("FIRST_EGFR").over(stay))
    few = F.lit(False)
    if cfg.min_scr_rule == "exclusion":
        enough = enough_scr(matched, cfg).withColumn("enough", F.lit(True))
        stays = stays.join(enough, "ENCOUNTERID", "left")
        few = F.col("enough").isNull()
    return stays.join(history, "PATID", "left").select(
        *[c for c in baseline.columns if c not in ("FIRST_TIME", "FIRST_EGFR")],
        _low_egfr(F.col("FIRST_EGFR"), cfg).alias(LOW_EGFR),
        _before_admission("FIRST_ESRD").alias(ESRD),
        (_before_admission("FIRST_RRT_DX") | _before_admission("FIRST_RRT_PX")).alias(RRT),
        _within_48h("FIRST_TIME", cfg).alias(RRT_48H),
        _burn_admission().alias(BURN),
        few.alias(FEW_SCR),
        first_transplant_day(cfg).alias("RRT_DATE"),
    )


def rule_labels(cfg: CohortConfig) -> dict[str, list[str]]:
    """Label -> the flags that earn it."""
    if cfg.merge_renal_failure:
        labels = {
            "Initial_GFR_below_15": [LOW_EGFR],
            "Pre_renal_failure": [ESRD, RRT],
            "Renal_transplant_within_48hr": [RRT_48H],
        }
    else:
        labels = {
            "Initial_GFR_below_15": [LOW_EGFR],
            "Pre_ESRD": [ESRD],
            "Pre_RRT": [RRT],
            "RRT_within_48hr": [RRT_48H],
        }
    labels["Burn_patients"] = [BURN]
    if cfg.min_scr_rule == "exclusion":
        labels["Less_than_2_SCr"] = [FEW_SCR]
    return labels


def exclude_all(screened: DataFrame, cfg: CohortConfig) -> DataFrame:
    """(ENCOUNTERID, EXCLUD_TYPE), one row per stay and rule that hits, with the admission."""
    hits = []
    for label, flags in rule_labels(cfg).items():
        hits.append(F.when(reduce(or_, [F.col(f) for f in flags]), F.lit(label)))
    labelled = screened.select(
        "ENCOUNTERID", "ADMIT_DATE_TIME", F.explode(F.array(*hits)).alias("EXCLUD_TYPE")
    )
    return labelled.filter(F.col("EXCLUD_TYPE").isNotNull()).distinct()


def not_excluded(screened: DataFrame) -> DataFrame:
    """The screened baselines that no rule hits."""
    hit = reduce(or_, [F.col(f) for f in (LOW_EGFR, ESRD, RRT, RRT_48H, BURN, FEW_SCR)])
    return screened.filter(~hit)


@dataclass(frozen=True)
class AuditedRule:
    """A rule of earlier codes: where its code rows are, and which count."""

    table: str
    columns: tuple[str, str, str]  # code system, code, date
    sets: tuple[str, ...]

    def codes(self) -> Column:
        return reduce(or_, [code_match(name, *self.columns[:2]) for name in self.sets])


AUDITED = {
    "pre_esrd": AuditedRule("DIAGNOSIS", ("DX_TYPE", "DX", "ADMIT_DATE"), ("ESRD_DX",)),
    "pre_rrt_dx": AuditedRule("DIAGNOSIS", ("DX_TYPE", "DX", "ADMIT_DATE"), ("RRT_DX",)),
    "pre_rrt_px": AuditedRule(
        "PROCEDURES", ("PX_TYPE", "PX", "PX_DATE"), ("TRANSPLANT_PX", "DIALYSIS_PX")
    ),
}


def exclusion_audit(
    rule: str, excluded: DataFrame, init: DataFrame, rows: DataFrame, every_code: bool = False
) -> DataFrame:
    """The codes behind an exclusion: ENCOUNTERID of the excluded stay, code system, code, date.

    Codes of the rule's sets only, which keeps the list in proportion to them; ``every_code`` lists
    all codes of the patients instead.
    """
    spec = AUDITED[rule]
    stays = init.select("ENCOUNTERID", "PATID").join(
        excluded.select("ENCOUNTERID"), "ENCOUNTERID", "left_semi"
    )
    listed = rows if every_code else rows.filter(spec.codes())
    return stays.join(listed.select("PATID", *spec.columns), "PATID").select(
        "ENCOUNTERID", *spec.columns
    )
