"""Column lists of the common-data-model tables, by type. Anything unlisted is text."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

# The tables' columns. '@' marks a date, '#' a number.
_COLUMNS = {
    "ENCOUNTER": """ENCOUNTERID PATID @ADMIT_DATE ADMIT_TIME @DISCHARGE_DATE DISCHARGE_TIME ENC_TYPE
        DISCHARGE_DISPOSITION DISCHARGE_STATUS DRG DRG_TYPE ADMITTING_SOURCE""",
    "DEMOGRAPHIC": """PATID @BIRTH_DATE BIRTH_TIME SEX SEXUAL_ORIENTATION GENDER_IDENTITY HISPANIC
        BIOBANK_FLAG RACE PAT_PREF_LANGUAGE_SPOKEN RAW_SEX RAW_SEXUAL_ORIENTATION
        RAW_GENDER_IDENTITY RAW_HISPANIC RAW_RACE RAW_PAT_PREF_LANGUAGE_SPOKEN""",
    "DEATH": "PATID @DEATH_DATE DEATH_DATE_IMPUTE DEATH_SOURCE DEATH_MATCH_CONFIDENCE",
    "PROCEDURES": """PROCEDURESID PATID ENCOUNTERID ENC_TYPE @ADMIT_DATE PROVIDERID @PX_DATE PX
        PX_TYPE PX_SOURCE PPX RAW_PX RAW_PX_TYPE RAW_PPX""",
    "OBS_CLIN": """OBSCLINID PATID ENCOUNTERID OBSCLIN_PROVIDERID @OBSCLIN_START_DATE
        OBSCLIN_START_TIME @OBSCLIN_STOP_DATE OBSCLIN_STOP_TIME OBSCLIN_TYPE OBSCLIN_CODE
        OBSCLIN_RESULT_QUAL OBSCLIN_RESULT_TEXT OBSCLIN_RESULT_SNOMED #OBSCLIN_RESULT_NUM
        OBSCLIN_RESULT_MODIFIER OBSCLIN_RESULT_UNIT OBSCLIN_ABN_IND RAW_OBSCLIN_NAME
        RAW_OBSCLIN_CODE RAW_OBSCLIN_TYPE RAW_OBSCLIN_RESULT RAW_OBSCLIN_MODIFIER RAW_OBSCLIN_UNIT
        OBSCLIN_SOURCE""",
    "DIAGNOSIS": """DIAGNOSISID PATID ENCOUNTERID ENC_TYPE @ADMIT_DATE @DX_DATE PROVIDERID DX DX_TYPE
        DX_SOURCE DX_ORIGIN PDX DX_POA RAW_DX RAW_DX_TYPE RAW_DX_SOURCE RAW_ORIGDX RAW_PDX
        RAW_DX_POA""",
    "LAB_RESULT_CM": """LAB_RESULT_CM_ID PATID ENCOUNTERID SPECIMEN_SOURCE LAB_LOINC PRIORITY
        RESULT_LOC LAB_PX LAB_PX_TYPE @LAB_ORDER_DATE @SPECIMEN_DATE SPECIMEN_TIME @RESULT_DATE
        RESULT_TIME RESULT_QUAL RESULT_SNOMED #RESULT_NUM RESULT_MODIFIER RESULT_UNIT NORM_RANGE_LOW
        NORM_MODIFIER_LOW NORM_RANGE_HIGH NORM_MODIFIER_HIGH ABN_IND RAW_LAB_NAME RAW_LAB_CODE
        RAW_PANEL RAW_RESULT RAW_UNIT RAW_ORDER_DEPT RAW_FACILITY_CODE LAB_LOINC_SOURCE
        LAB_RESULT_SOURCE""",
    "PRESCRIBING": """PRESCRIBINGID PATID ENCOUNTERID RX_PROVIDERID @RX_ORDER_DATE RX_ORDER_TIME
        @RX_START_DATE @RX_END_DATE #RX_DOSE_ORDERED RX_DOSE_ORDERED_UNIT #RX_QUANTITY RX_DOSE_FORM
        #RX_REFILLS #RX_DAYS_SUPPLY RX_FREQUENCY RX_PRN_FLAG RX_ROUTE RX_BASIS RXNORM_CUI RX_SOURCE
        RX_DISPENSE_AS_WRITTEN RAW_RX_MED_NAME RAW_RX_FREQUENCY RAW_RXNORM_CUI RAW_RX_QUANTITY
        RAW_RX_NDC RAW_RX_DOSE_ORDERED RAW_RX_DOSE_ORDERED_UNIT RAW_RX_ROUTE RAW_RX_REFILLS""",
    "MED_ADMIN": """MEDADMINID PATID ENCOUNTERID PRESCRIBINGID MEDADMIN_PROVIDERID
        @MEDADMIN_START_DATE MEDADMIN_START_TIME @MEDADMIN_STOP_DATE MEDADMIN_STOP_TIME
        MEDADMIN_TYPE MEDADMIN_CODE #MEDADMIN_DOSE_ADMIN MEDADMIN_DOSE_ADMIN_UNIT MEDADMIN_ROUTE
        MEDADMIN_SOURCE RAW_MEDADMIN_MED_NAME RAW_MEDADMIN_CODE RAW_MEDADMIN_DOSE_ADMIN
        RAW_MEDADMIN_DOSE_ADMIN_UNIT RAW_MEDADMIN_ROUTE""",
    "DISPENSING": """DISPENSINGID PATID PRESCRIBINGID @DISPENSE_DATE NDC #DISPENSE_SUP #DISPENSE_AMT
        #DISPENSE_DOSE_DISP DISPENSE_DOSE_DISP_UNIT DISPENSE_ROUTE RAW_NDC RAW_DISPENSE_DOSE_DISP
        RAW_DISPENSE_DOSE_DISP_UNIT RAW_DISPENSE_ROUTE DISPENSE_SOURCE""",
    "VITAL": """VITALID PATID ENCOUNTERID @MEASURE_DATE MEASURE_TIME VITAL_SOURCE #HT #WT #DIASTOLIC
        #SYSTOLIC #ORIGINAL_BMI BP_POSITION SMOKING TOBACCO TOBACCO_TYPE RAW_VITAL_SOURCE RAW_HT
        RAW_WT RAW_DIASTOLIC RAW_SYSTOLIC RAW_BP_POSITION RAW_SMOKING RAW_TOBACCO
        RAW_TOBACCO_TYPE""",
}

_TYPES = {"@": T.DateType(), "#": T.DoubleType()}


def _struct(listing: str) -> T.StructType:
    return T.StructType(
        [T.StructField(w.lstrip("@#"), _TYPES.get(w[0], T.StringType())) for w in listing.split()]
    )


SCHEMAS: dict[str, T.StructType] = {name: _struct(text) for name, text in _COLUMNS.items()}

REQUIRED_TABLES = [
    "ENCOUNTER", "DEMOGRAPHIC", "LAB_RESULT_CM", "DIAGNOSIS", "PROCEDURES", "DEATH",
]
OPTIONAL_TABLES = ["OBS_CLIN", "VITAL", "PRESCRIBING", "DISPENSING", "MED_ADMIN"]


def conform(df: DataFrame, table: str) -> DataFrame:
    """Upper-case names and the listed types; extra site columns pass through unchanged."""
    wanted = {f.name: f.dataType for f in SCHEMAS[table].fields}
    columns = []
    for name, kind in df.dtypes:
        upper = name.upper()
        target = wanted.get(upper)
        column = df[name]
        if target is not None and kind != target.simpleString():
            column = column.cast(target)
        columns.append(column.alias(upper))
    return df.select(*columns)


def missing_columns(df: DataFrame, table: str, needed: list[str]) -> list[str]:
    present = {c.upper() for c in df.columns}
    return [c for c in needed if c not in present]
