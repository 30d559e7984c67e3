"""Clinical records around each stay: interval joins of the large tables with the onset table."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from renalis.config import CohortConfig
from renalis.functions.clinical import age_years
from renalis.functions.codes import VITAL_CODES, VITAL_NAMES
from renalis.functions.membership import Membership
from renalis.operators.calendar import DayIndex, day_index, slot_of
from renalis.operators.cohort import is_serum_creatinine

TOP_CODED_AGE = 90


def observation_window(onsets: DataFrame) -> DataFrame:
    """Adds win_end: the day after the later of the discharge and the highest stage's onset."""
    event = F.coalesce("AKI3_ONSET", "AKI2_ONSET", "AKI1_ONSET", "NONAKI_ANCHOR")
    return onsets.withColumn("win_end", F.date_add(F.greatest(event, "DISCHARGE_DATE"), 1))


@dataclass(frozen=True)
class Collection:
    """One registered output of the generic window join."""

    output: str
    table: str
    date_col: str
    lo: int = 0  # first day, relative to admission
    hi: int | None = None  # last day, relative to admission; None: win_end
    since_col: str | None = None  # date behind DAYS_SINCE_ADMIT, if not date_col
    keep: Callable[[CohortConfig], Column] | None = None
    derived: Callable[[CohortConfig], dict[str, Column]] | None = None
    distinct: bool = True
    exported: bool = True
    required: tuple[str, ...] = field(default=())


def _end_date(cfg: CohortConfig) -> Column:
    """The prescription's end, cut at the discharge."""
    end, discharge = F.col("RX_END_DATE"), F.col("DISCHARGE_DATE")
    earlier = F.least(discharge, end)
    if cfg.least_null_mode == "null":
        earlier = F.when(end.isNotNull() & discharge.isNotNull(), earlier)
    return F.date_format(earlier, "yyyyMMdd") if cfg.end_date_as_text else earlier


def _prescription(cfg: CohortConfig) -> dict[str, Column]:
    daily = F.when(
        F.col("RX_DAYS_SUPPLY") > 0, F.round(F.col("RX_QUANTITY") / F.col("RX_DAYS_SUPPLY"))
    )
    return {"RX_END_DATE_MOD": _end_date(cfg), "RX_QUANTITY_DAILY": daily}


def _has_order_time(cfg: CohortConfig) -> Column:
    return F.col("RX_ORDER_TIME").isNotNull() if cfg.pmed_require_time else F.lit(True)


COLLECTIONS: dict[str, Collection] = {
    c.output: c
    for c in [
        Collection(
            "AKI_VITAL", "OBS_CLIN", "OBSCLIN_START_DATE", lo=-30, distinct=False,
            keep=lambda cfg: F.col("OBSCLIN_CODE").isin(*VITAL_CODES, *VITAL_NAMES),
        ),
        Collection("AKI_VITAL_OLD", "VITAL", "MEASURE_DATE", lo=-30, distinct=False),
        Collection("AKI_PX", "PROCEDURES", "PX_DATE"),
        Collection("AKI_DX", "DIAGNOSIS", "ADMIT_DATE", lo=-365, hi=-1, distinct=False),
        Collection("AKI_DX_CURRENT", "DIAGNOSIS", "DX_DATE", distinct=False),
        Collection(
            "AKI_DX_CURRENT_ADMIT_DATE", "DIAGNOSIS", "ADMIT_DATE", distinct=False, exported=False
        ),
        Collection("AKI_LAB", "LAB_RESULT_CM", "LAB_ORDER_DATE", since_col="SPECIMEN_DATE"),
        Collection(
            "AKI_LAB_SCR", "LAB_RESULT_CM", "LAB_ORDER_DATE", lo=-365, since_col="SPECIMEN_DATE",
            keep=is_serum_creatinine,
        ),
        Collection(
            "AKI_PMED", "PRESCRIBING", "RX_ORDER_DATE", lo=-30, since_col="RX_START_DATE",
            required=("RXNORM_CUI", "RX_START_DATE"), keep=_has_order_time, derived=_prescription,
        ),
        Collection("AKI_DMED", "DISPENSING", "DISPENSE_DATE", lo=-30, required=("NDC",)),
        Collection(
            "AKI_AMED", "MED_ADMIN", "MEDADMIN_START_DATE", lo=-30,
            required=("MEDADMIN_CODE", "MEDADMIN_STOP_DATE"),
        ),
    ]
}


def collect_window(
    onsets: DataFrame,
    source: DataFrame | None,
    spec: Collection,
    cfg: CohortConfig,
    since: date | None = None,
    index: DayIndex | None = None,
    patients: Membership | None = None,
) -> DataFrame | None:
    """Rows of a clinical table whose date lies in a stay's window, next to the stay.

    The windows, the small side, are copied to the time slots they touch and in which the large side
    has rows; the large side computes its single slot. The equi-join on (PATID, slot) then spreads a
    patient with very many rows over the calendar and never compares rows that are years apart.
    Windows of any length take this way: one that a far future date keeps open costs no more copies
    than there are slots in the data.

    ``since`` is the first admission day of the onsets, which bounds the scan of the large table.
    ``index`` tells which days occur in the table, so that outputs of one table share it; without one
    it is made of the date column. ``patients`` drops most rows of other patients at the scan.
    """
    if source is None:
        return None
    when = F.col(spec.date_col)
    rows = source
    for condition in _conditions(spec, cfg):
        rows = rows.filter(condition)
    if patients is not None:
        rows = rows.filter(patients.may_have("PATID"))
    if since is not None:
        rows = rows.filter(when >= F.lit(since + timedelta(days=spec.lo)))

    first = F.date_add("ADMIT_DATE", spec.lo)
    last = F.col("win_end") if spec.hi is None else F.date_add("ADMIT_DATE", spec.hi)
    windows = observation_window(onsets).select(
        F.col("ENCOUNTERID").alias("ONSETS_ENCOUNTERID"),
        "PATID",
        "ADMIT_DATE",
        "DISCHARGE_DATE",
        first.alias("win_first"),
        last.alias("win_last"),
    )
    if spec.distinct:
        windows = windows.distinct()
    inside = (F.col("row.PATID") == F.col("win.PATID")) & F.col(f"row.{spec.date_col}").between(
        F.col("win_first"), F.col("win_last")
    )
    index = index or DayIndex.of(day_index(source, spec.date_col))
    slots = index.slots_within(F.col("win_first"), F.col("win_last"))
    windows = windows.withColumn("slot", F.explode(slots))
    rows = rows.withColumn("slot", slot_of(when))
    same_slot = F.col("row.slot") == F.col("win.slot")
    joined = rows.alias("row").join(windows.alias("win"), inside & same_slot)
    return _collected(joined, source, spec, cfg).drop("slot")


def _collected(
    joined: DataFrame, source: DataFrame, spec: Collection, cfg: CohortConfig
) -> DataFrame:
    derived = spec.derived(cfg) if spec.derived else {}
    result = joined.select(
        "ONSETS_ENCOUNTERID",
        *[f"row.{c}" for c in source.columns],
        *[column.alias(name) for name, column in derived.items()],
        F.datediff(f"row.{spec.since_col or spec.date_col}", "win.ADMIT_DATE").alias(
            "DAYS_SINCE_ADMIT"
        ),
        "row.slot",
    )
    if spec.distinct:
        # With PATID and slot among the columns, the distinct needs no shuffle of its own.
        result = result.distinct()
    return result


def _conditions(spec: Collection, cfg: CohortConfig) -> list[Column]:
    conditions = [F.col(c).isNotNull() for c in spec.required]
    if spec.keep is not None:
        conditions.append(spec.keep(cfg))
    return conditions


def collect_death(onsets: DataFrame, death: DataFrame) -> DataFrame:
    """Deaths of the cohort's patients; stays of living patients keep a row of NULLs."""
    return (
        onsets.select("ENCOUNTERID", "PATID", "DISCHARGE_DATE")
        .distinct()
        .alias("stay")
        .join(death.alias("dth"), F.col("stay.PATID") == F.col("dth.PATID"), "left")
        .select(
            F.col("stay.ENCOUNTERID").alias("ONSETS_ENCOUNTERID"),
            "dth.*",
            F.datediff("dth.DEATH_DATE", "stay.DISCHARGE_DATE").alias("DDAYS_SINCE_ENC"),
        )
        .distinct()
    )


def collect_demographics(
    onsets: DataFrame, demographic: DataFrame, death: DataFrame, cfg: CohortConfig
) -> DataFrame:
    """Demographics of each stay with the age at admission, top-coded, and the death date."""
    age = age_years(F.col("stay.ADMIT_DATE"), F.col("demo.BIRTH_DATE"), cfg.demo_age_mode)
    dth = death.select("PATID", "DEATH_DATE", "DEATH_DATE_IMPUTE", "DEATH_SOURCE").distinct()
    return (
        onsets.select("ENCOUNTERID", "PATID", "ADMIT_DATE", "DISCHARGE_DATE")
        .distinct()
        .alias("stay")
        .join(demographic.alias("demo"), F.col("stay.PATID") == F.col("demo.PATID"), "left")
        .join(dth.alias("dth"), F.col("stay.PATID") == F.col("dth.PATID"), "left")
        .select(
            F.col("stay.ENCOUNTERID").alias("ONSETS_ENCOUNTERID"),
            F.when(age >= TOP_CODED_AGE, TOP_CODED_AGE).otherwise(age).alias("AGE"),
            "demo.*",
            "dth.DEATH_DATE",
            F.datediff("dth.DEATH_DATE", "stay.DISCHARGE_DATE").alias("DDAYS_SINCE_ENC"),
            "dth.DEATH_DATE_IMPUTE",
            "dth.DEATH_SOURCE",
        )
        .distinct()
    )
