"""Run parameters. One pipeline, three presets: the rule variants that sites use."""

from __future__ import annotations

from dataclasses import dataclass, replace
from datetime import date


@dataclass(frozen=True)
class CohortConfig:
    # Study window and the date that splits the attrition counts in two eras.
    window_start: date = date(2010, 1, 1)
    window_end: date = date(2021, 12, 31)
    split_date: date = date(2019, 12, 31)

    # Initial cohort.
    enc_types: tuple[str, ...] = ("EI", "IP", "IS")
    min_stay_days: int = 2
    min_age: int = 18
    age_mode: str = "rounded"  # rounded | calendar | complete
    demo_age_mode: str = "rounded"
    dedupe_discharge: bool = True
    extra_encounter_cols: tuple[str, ...] = ()
    missing_time: str = "null"  # null | midnight

    # Serum creatinine.
    scr_units: tuple[str, ...] = ("MG/DL", "MG")
    egfr_round: bool = False
    keep_lab_encounter: bool = False
    lab_match: str = "patient"  # patient | union | union_all
    min_scr_rule: str = "distinct_times"  # distinct_times | rank | exclusion
    scr_nulls_last: bool = True  # place of a missing specimen time in the order
    baseline_mode: str = "first"  # first | prior_2d

    # Exclusions.
    egfr_cut: float = 15.0
    egfr_cut_inclusive: bool = False
    merge_renal_failure: bool = False
    rrt48_counts_dialysis: bool = False
    rrt48_trunc: bool = False

    # Staging.
    diff_mode: str = "exact"  # exact | whole | boundary
    ratio_window: str = "from_base"  # from_base | whole_days | from_admit
    rrt_stage3: bool = True
    rrt_bounded: bool = True
    stage_nulls_first: bool = True

    # Collection.
    least_null_mode: str = "null"  # null | ignore
    end_date_as_text: bool = False
    pmed_require_time: bool = False

    # De-identification: range of the shift in days, and what to do with ADMIT_YEAR.
    shift_lo: int = -365
    shift_hi: int = -1
    admit_year_policy: str = "recompute"  # recompute | drop | keep

    @property
    def scr_label(self) -> str:
        return "Has_at_least_1_SCr" if self.min_scr_rule == "exclusion" else "Has_at_least_2_SCr"


PRESETS: dict[str, CohortConfig] = {
    # Its date function takes a missing time as midnight; the others' give NULL.
    "oracle": CohortConfig(missing_time="midnight"),
    "postgres": CohortConfig(
        age_mode="calendar",
        demo_age_mode="complete",
        keep_lab_encounter=True,
        lab_match="union",
        min_scr_rule="rank",
        rrt48_trunc=True,
        diff_mode="whole",
        ratio_window="whole_days",
        least_null_mode="ignore",
        pmed_require_time=True,
        shift_lo=-364,
    ),
    "tsql": CohortConfig(
        age_mode="complete",
        demo_age_mode="complete",
        dedupe_discharge=False,
        extra_encounter_cols=(
            "ENC_TYPE",
            "DISCHARGE_DISPOSITION",
            "DISCHARGE_STATUS",
            "DRG",
            "DRG_TYPE",
            "ADMITTING_SOURCE",
        ),
        scr_units=("MG/DL",),
        egfr_round=True,
        keep_lab_encounter=True,
        lab_match="union_all",
        min_scr_rule="exclusion",
        scr_nulls_last=False,
        baseline_mode="prior_2d",
        egfr_cut_inclusive=True,
        merge_renal_failure=True,
        rrt48_counts_dialysis=True,
        diff_mode="boundary",
        ratio_window="from_admit",
        rrt_stage3=False,
        rrt_bounded=False,
        stage_nulls_first=False,
        end_date_as_text=True,
        pmed_require_time=True,
    ),
}


def preset(name: str, **changes) -> CohortConfig:
    """A preset with some of its fields replaced."""
    return replace(PRESETS[name], **changes)
