"""Common-data-model views over the test tables, in SQL that Spark and DuckDB both run.

Integer arithmetic only, so that both sides start from the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from renalis.functions.codes import CODE_SETS


def _clock(minutes: str) -> str:
    """'HH:MM' text of a minute of the day."""
    return (
        f"lpad(cast(cast(floor(({minutes}) / 60) as int) as string), 2, '0') || ':' || "
        f"lpad(cast(({minutes}) % 60 as string), 2, '0')"
    )


def _plus(day: str, days: str) -> str:
    return f"({day} + cast({days} as int))"


def _when(cond: str, value: str) -> str:
    return f"case when {cond} then {value} end"


_ROW_ID = (
    "cast(l_orderkey as string) || '-' || cast(l_partkey as string) || '-' || "
    "cast(l_suppkey as string) || '-' || cast(l_linenumber as string) || '-' || "
    "cast(cast(l_quantity as int) as string)"
)
_PATID = "'P' || cast(o_custkey as string)"
_ENCOUNTERID = "'E' || cast(o_orderkey as string)"
_OD = "cast(o_orderdate as date)"
_LINES = "from lineitem join orders on l_orderkey = o_orderkey"


def _row(key: str) -> str:
    return f"{_ROW_ID} as {key}, {_PATID} as PATID, {_ENCOUNTERID} as ENCOUNTERID"


def _codes(sets: dict[int, list[str]], other: tuple[str, str]) -> tuple[str, str]:
    """Code and code system of a record: each code of the sets, by l_partkey and l_suppkey.

    sets: which codes go to records whose l_partkey % 100 is the key; other: the code for the rest in
    the system of an even and of an odd l_suppkey. A prefix gets a digit behind it.
    """
    code, kind = [], []
    for part, names in sets.items():
        each = [
            (system, c + ("1" if how == "prefix" else ""))
            for name in names
            for system, how, codes in CODE_SETS[name]
            for c in codes
        ]
        place = f"cast(l_suppkey % {len(each)} as int) + 1"
        for target, at in ((code, 1), (kind, 0)):
            listed = ",".join(x[at] for x in each)
            target.append(f"when {part} then split_part('{listed}', ',', {place})")
    return (
        f"case l_partkey % 100 {' '.join(code)} else "
        f"case when l_suppkey % 2 = 0 then '{other[0]}' else '{other[1]}' end end",
        f"case l_partkey % 100 {' '.join(kind)} else "
        "case when l_suppkey % 2 = 0 then '09' else '10' end end",
    )


_DX, _DX_TYPE = _codes({0: ["ESRD_DX"], 1: ["RRT_DX"], 2: ["BURN_DX"]}, ("401.9", "I10"))
_PX, _PX_TYPE = _codes({3: ["DIALYSIS_PX"], 4: ["TRANSPLANT_PX"]}, ("99.21", "99213"))
# Every 211th stay is over 400 days long, every 307th leaves a window of over 1200 days.
_STAY_DAYS = (
    "(case when o_orderkey % 211 = 0 then 500 when o_orderkey % 307 = 0 then 1300 "
    "else o_orderkey % 12 end)"
)
# A third of the lab results were ordered in a contact of their own.
_LAB_ENCOUNTERID = (
    "case when l_linenumber % 3 = 0 then 'L' else 'E' end || cast(l_orderkey as string)"
)

_SPECIMEN_MINUTE = "l_partkey * 13 % 1440"
_RESULT_MINUTE = f"(({_SPECIMEN_MINUTE}) + 60)"

VIEWS: dict[str, str] = {
    "DEMOGRAPHIC": f"""
        select 'P' || cast(c_custkey as string) as PATID,
               {_plus("date '1915-01-01'", "c_custkey * 7919 % 22000")} as BIRTH_DATE,
               case when c_custkey % 2 = 0 then 'F' else 'M' end as SEX,
               '0' || cast(c_nationkey % 5 + 1 as string) as RACE
        from customer""",
    "ENCOUNTER": f"""
        select {_ENCOUNTERID} as ENCOUNTERID, {_PATID} as PATID,
               {_OD} as ADMIT_DATE,
               {_when("o_orderkey % 61 <> 0", _clock("o_orderkey * 37 % 1440"))} as ADMIT_TIME,
               {_plus(_OD, _STAY_DAYS)} as DISCHARGE_DATE,
               {_when("o_orderkey % 67 <> 0", _clock("o_orderkey * 53 % 1440"))}
                   as DISCHARGE_TIME,
               case o_orderpriority when '1-URGENT' then 'EI' when '2-HIGH' then 'IP'
                    when '3-MEDIUM' then 'IS' when '4-NOT SPECIFIED' then 'ED'
                    when '5-LOW' then 'AV' end as ENC_TYPE,
               case when o_orderkey % 9 = 0 then 'E' else 'A' end as DISCHARGE_DISPOSITION,
               o_orderstatus as DISCHARGE_STATUS,
               cast(o_orderkey % 900 + 100 as string) as DRG, '02' as DRG_TYPE,
               {_when("o_orderkey % 4 <> 0", "'HO'")} as ADMITTING_SOURCE
        from orders""",
    "LAB_RESULT_CM": f"""
        select {_ROW_ID} as LAB_RESULT_CM_ID, {_PATID} as PATID,
               {_LAB_ENCOUNTERID} as ENCOUNTERID,
               case when l_partkey % 25 = 0 then 'URINE' else 'SER_PLAS' end as SPECIMEN_SOURCE,
               case when l_partkey % 10 = 9 then '2951-2' else '2160-0' end as LAB_LOINC,
               {_plus(_OD, "l_linenumber")} as LAB_ORDER_DATE,
               {_plus(_OD, "l_linenumber")} as SPECIMEN_DATE,
               {_when("(l_partkey + l_suppkey) % 17 <> 0", _clock(_SPECIMEN_MINUTE))}
                   as SPECIMEN_TIME,
               {_plus(_OD, f"l_linenumber + floor({_RESULT_MINUTE} / 1440)")} as RESULT_DATE,
               {_when("(l_partkey + l_suppkey) % 19 <> 0", _clock(f"{_RESULT_MINUTE} % 1440"))}
                   as RESULT_TIME,
               0.5e0 + l_quantity / 20 as RESULT_NUM,
               case l_suppkey % 20 when 0 then 'umol/L' when 1 then 'MG' else 'mg/dL' end
                   as RESULT_UNIT
        {_LINES}""",
    "DIAGNOSIS": f"""
        select {_row("DIAGNOSISID")},
               case when l_linenumber = 1 then {_OD} else cast(l_shipdate as date) end
                   as ADMIT_DATE,
               {_plus(_OD, "l_linenumber - 1")} as DX_DATE,
               {_DX} as DX, {_DX_TYPE} as DX_TYPE,
               case l_returnflag when 'A' then 'AD' when 'N' then 'FI' else 'DI' end as DX_SOURCE
        {_LINES}""",
    "PROCEDURES": f"""
        select {_row("PROCEDURESID")}, {_OD} as ADMIT_DATE,
               {_plus(_OD, "l_linenumber")} as PX_DATE,
               {_PX} as PX, {_PX_TYPE} as PX_TYPE
        {_LINES}""",
    "DEATH": f"""
        select 'P' || cast(c_custkey as string) as PATID,
               {_plus("date '1996-01-01'", "c_custkey * 31 % 2200")} as DEATH_DATE,
               'N' as DEATH_DATE_IMPUTE,
               case when c_custkey % 2 = 0 then 'L' else 'N' end as DEATH_SOURCE,
               'E' as DEATH_MATCH_CONFIDENCE
        from customer where c_custkey % 5 = 0""",
    "OBS_CLIN": f"""
        select {_row("OBSCLINID")},
               {_plus(_OD, "l_linenumber - 4")} as OBSCLIN_START_DATE,
               {_plus(_OD, "l_linenumber - 3")} as OBSCLIN_STOP_DATE,
               case l_linenumber when 1 then '8480-6' when 2 then '8462-4' when 3 then '29463-7'
                    when 4 then 'SMOKING' else '99999-9' end as OBSCLIN_CODE,
               l_quantity as OBSCLIN_RESULT_NUM
        {_LINES}""",
    "VITAL": f"""
        select {_row("VITALID")}, {_plus(_OD, "10 * (l_linenumber - 5)")} as MEASURE_DATE,
               l_quantity + 40 as WT
        {_LINES}""",
    "PRESCRIBING": f"""
        select {_row("PRESCRIBINGID")},
               {_plus(_OD, "l_linenumber - 4")} as RX_ORDER_DATE,
               {_when("l_suppkey % 7 <> 0", "'08:00'")} as RX_ORDER_TIME,
               {_when("l_partkey % 13 <> 0", _plus(_OD, "l_linenumber - 3"))} as RX_START_DATE,
               {_when("l_suppkey % 5 <> 0", _plus(_OD, "l_linenumber - 4 + l_quantity"))}
                   as RX_END_DATE,
               2 * l_quantity as RX_QUANTITY,
               cast(cast(l_quantity as int) % 10 as double) as RX_DAYS_SUPPLY,
               {_when("l_partkey % 10 <> 0", "cast(l_partkey as string)")} as RXNORM_CUI
        {_LINES}""",
    "DISPENSING": f"""
        select {_row("DISPENSINGID")}, {_plus(_OD, "l_linenumber - 4")} as DISPENSE_DATE,
               {_when("l_partkey % 11 <> 0", "cast(l_partkey as string)")} as NDC,
               l_quantity as DISPENSE_AMT
        {_LINES}""",
    "MED_ADMIN": f"""
        select {_row("MEDADMINID")},
               {_plus(_OD, "l_linenumber - 1")} as MEDADMIN_START_DATE,
               {_when("l_suppkey % 9 <> 0", _plus(_OD, "l_linenumber"))} as MEDADMIN_STOP_DATE,
               {_when("l_partkey % 17 <> 0", "cast(l_partkey as string)")} as MEDADMIN_CODE
        {_LINES}""",
}

BASE_TABLES = ["customer", "orders", "lineitem"]


class Views(dict):
    """The views as DataFrames over the Parquet files of one scale, each built on first use."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        super().__init__()
        self.spark, self.sf_dir = spark, sf_dir

    def __missing__(self, name: str) -> DataFrame:
        text, used = VIEWS[name], {}
        for table in BASE_TABLES:
            # Named DataFrame arguments stand in for the tables, without registering views.
            bound = text.replace(f"from {table}", f"from {{{table}}}")
            bound = bound.replace(f"join {table} ", f"join {{{table}}} ")
            if bound != text:
                used[table] = self.spark.read.parquet(f"{self.sf_dir}/{table}.parquet")
            text = bound
        self[name] = self.spark.sql(text, **used)
        return self[name]

    def __contains__(self, name: object) -> bool:
        # A view is there before its first use: callers ask before they build it.
        return name in VIEWS

    def get(self, name: str, default=None):
        return self[name] if name in VIEWS else default


def load_views(spark: SparkSession, sf_dir: str) -> Views:
    return Views(spark, sf_dir)
