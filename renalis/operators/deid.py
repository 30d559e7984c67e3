"""Per-patient date shifting."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from renalis.config import CohortConfig

# Date columns to shift, by exported table.
SHIFTED_DATES: dict[str, list[str]] = {
    "AKI_ONSETS": [
        "ADMIT_DATE", "DISCHARGE_DATE", "NONAKI_ANCHOR", "AKI1_ONSET", "AKI2_ONSET", "AKI3_ONSET",
    ],
    "AKI_DEMO_DEATH": ["DEATH_DATE"],
    "AKI_DEMO": ["BIRTH_DATE", "DEATH_DATE"],
    "AKI_PX": ["ADMIT_DATE", "PX_DATE"],
    "AKI_VITAL": ["OBSCLIN_START_DATE", "OBSCLIN_STOP_DATE"],
    "AKI_DX": ["ADMIT_DATE", "DX_DATE"],
    "AKI_LAB": ["LAB_ORDER_DATE", "SPECIMEN_DATE", "RESULT_DATE"],
    "AKI_PMED": ["RX_ORDER_DATE", "RX_START_DATE", "RX_END_DATE", "RX_END_DATE_MOD"],
    "AKI_AMED": ["MEDADMIN_START_DATE", "MEDADMIN_STOP_DATE"],
    "AKI_DMED": ["DISPENSE_DATE"],
    "AKI_DX_CURRENT": ["ADMIT_DATE", "DX_DATE"],
    "AKI_LAB_SCR": ["LAB_ORDER_DATE", "SPECIMEN_DATE", "RESULT_DATE"],
    "AKI_VITAL_OLD": ["MEASURE_DATE"],
}


def patient_shift(salt: str, cfg: CohortConfig, patid: str = "PATID") -> Column:
    """Days to shift a patient's dates by: a keyed hash mapped to [shift_lo, shift_hi].

    A function of the patient and the secret salt alone: every table, task and retry agrees on it
    without a lookup. The salt must not be stored with the output.
    """
    digest = F.sha2(F.concat(F.lit(f"{salt}:"), F.col(patid)), 256)
    number = F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")
    return (number % (cfg.shift_hi - cfg.shift_lo + 1) + cfg.shift_lo).cast("int")


def date_shift_table(onsets: DataFrame, salt: str, cfg: CohortConfig) -> DataFrame:
    """(PATID, date_shift), one row per patient of the cohort."""
    return onsets.select("PATID").distinct().withColumn("date_shift", patient_shift(salt, cfg))


def _shifted(df: DataFrame, dates: list[str], shift: Column) -> dict[str, Column]:
    moved = {}
    for name in dates:
        if name not in df.columns:
            continue
        if dict(df.dtypes)[name] == "string":  # compact yyyyMMdd text
            day = F.to_date(F.col(name), "yyyyMMdd")
            moved[name] = F.date_format(F.date_add(day, shift), "yyyyMMdd")
        else:
            moved[name] = F.date_add(name, shift)
    return moved


def shift_dates(df: DataFrame, dates: list[str], shift: Column | DataFrame) -> DataFrame:
    """Move the listed dates by the patient's shift and keep the other columns.

    With a column the shift is computed in place, without a join. With a table (PATID, date_shift),
    such as one that already exists, it is joined; both drop rows that name no patient.
    """
    if isinstance(shift, Column):
        return df.filter(F.col("PATID").isNotNull()).withColumns(_shifted(df, dates, shift))
    joined = df.join(shift.select("PATID", "date_shift"), "PATID")
    return joined.withColumns(_shifted(df, dates, F.col("date_shift"))).select(*df.columns)


def _apply_year_policy(onsets: DataFrame, cfg: CohortConfig) -> DataFrame:
    """The true admission year gives away part of the shift, so it is not kept by default."""
    if cfg.admit_year_policy == "keep" or "ADMIT_YEAR" not in onsets.columns:
        return onsets
    if cfg.admit_year_policy == "drop":
        return onsets.drop("ADMIT_YEAR")
    return onsets.withColumn("ADMIT_YEAR", F.date_format("ADMIT_DATE", "yyyy"))


def shift_table(
    name: str, df: DataFrame, shift: Column | DataFrame, cfg: CohortConfig
) -> DataFrame:
    """De-identified version of one exported table."""
    moved = shift_dates(df, SHIFTED_DATES[name], shift)
    return _apply_year_policy(moved, cfg) if name == "AKI_ONSETS" else moved


def deidentify(
    tables: dict[str, DataFrame], salt: str, cfg: CohortConfig, shifts: DataFrame | None = None
) -> dict[str, DataFrame]:
    """DEID_* versions of all exported tables that are present."""
    shift = patient_shift(salt, cfg) if shifts is None else shifts
    return {
        f"DEID_{name}": shift_table(name, df, shift, cfg)
        for name, df in tables.items()
        if name in SHIFTED_DATES
    }
