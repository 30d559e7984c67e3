"""Plain DuckDB SQL for every step, as the independent answer the Spark plans are checked against.

Each step is a named query over earlier ones. The SQL takes the direct route (pairwise joins, one
window per question), not the rewritten plans of the library.
"""

from __future__ import annotations

import re

from renalis.config import CohortConfig
from renalis.functions.codes import CODE_SETS, SCR_LOINC, VITAL_CODES, VITAL_NAMES
from renalis.operators.deid import SHIFTED_DATES
from renalis.sources.schemas import SCHEMAS
from verification import matrix
from verification.views import VIEWS

SALT = "check-only"


def _list(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


def _codes(name: str, kind: str, code: str) -> str:
    """Code-set predicate as one regular expression per code system."""
    tests = []
    for system, match, codes in CODE_SETS[name]:
        body = "|".join(c.replace(".", "[.]") for c in codes)
        pattern = {"exact": f"^({body})$", "prefix": f"^({body})", "contains": f"({body})"}[match]
        tests.append(f"({kind} = '{system}' and regexp_matches({code}, '{pattern}'))")
    return "(" + " or ".join(tests) + ")"


def _age(at: str, birth: str, mode: str) -> str:
    if mode == "rounded":
        return f"cast(round(date_diff('day', {birth}, {at}) / 365.25) as integer)"
    if mode == "calendar":
        return f"cast(year({at}) - year({birth}) as integer)"
    return f"cast(date_sub('year', {birth}, {at}) as integer)"


def _stamp(day: str, time: str, cfg: CohortConfig) -> str:
    if cfg.missing_time == "midnight":
        time = f"coalesce({time}, '00:00')"
    return f"cast(strftime({day}, '%Y-%m-%d') || ' ' || {time} as timestamp)"


def _seconds(start: str, end: str) -> str:
    return f"date_diff('second', {start}, {end})"


def _days(start: str, end: str, mode: str) -> str:
    if mode == "boundary":
        return f"cast(date_diff('day', cast({start} as date), cast({end} as date)) as integer)"
    cut = "trunc" if mode == "whole" else "floor"
    return f"cast({cut}({_seconds(start, end)} / 86400) as integer)"


_ADMIT, _DISCHARGE = "ADMIT_DATE_TIME", "DISCHARGE_DATE_TIME"
_WIN_END = (
    "cast(greatest(coalesce(o.AKI3_ONSET, o.AKI2_ONSET, o.AKI1_ONSET, o.NONAKI_ANCHOR), "
    "o.DISCHARGE_DATE) + 1 as date)"
)


def _scr_predicate(cfg: CohortConfig) -> str:
    return (
        f"LAB_LOINC in ({_list(SCR_LOINC)}) and upper(RESULT_UNIT) in ({_list(cfg.scr_units)}) "
        "and SPECIMEN_SOURCE <> 'URINE' and RESULT_NUM > 0"
    )


def _cohort_steps(cfg: CohortConfig) -> dict[str, str]:
    one_per_discharge = (
        """qualify row_number() over (partition by PATID, DISCHARGE_DATE
               order by ADMIT_DATE, ADMIT_TIME nulls last, ENCOUNTERID) = 1"""
        if cfg.dedupe_discharge
        else ""
    )
    extra = "".join(f", {c}" for c in cfg.extra_encounter_cols)
    owner = "ENCOUNTERID, " if cfg.keep_lab_encounter else ""
    scr_term, age_term = "pow(SERUM_CREAT, -1.154)", "pow(cast(AGE as double), -0.203)"
    if cfg.egfr_round:
        scr_term, age_term = f"round({scr_term}, 2)", f"round(round({age_term}, 3), 2)"
    spec_order = "nulls last" if cfg.scr_nulls_last else "nulls first"
    rank = f"""dense_rank() over (partition by ENCOUNTERID
                   order by LAB_ORDER_DATE, SPECIMEN_DATE_TIME {spec_order})"""

    in_stay = f"s.LAB_ORDER_DATE between c.{_ADMIT} and c.{_DISCHARGE}"
    values = "s.SERUM_CREAT, s.EGFR, s.LAB_ORDER_DATE, s.SPECIMEN_DATE_TIME, s.RESULT_DATE_TIME"
    stay = f"c.ENCOUNTERID, c.{_ADMIT}, c.{_DISCHARGE}"
    by_patient = f"""select c.PATID, {stay}, {values} from initial_cohort c
            join all_scr_egfr s on s.PATID = c.PATID and {in_stay}"""
    by_encounter = f"""select s.PATID, {stay}, {values} from initial_cohort c
            join all_scr_egfr s on s.ENCOUNTERID = c.ENCOUNTERID and {in_stay}"""
    matched = {
        "patient": by_patient,
        "union": f"{by_patient} union {by_encounter}",
        "union_all": f"{by_patient} and s.ENCOUNTERID <> c.ENCOUNTERID union {by_encounter}",
    }[cfg.lab_match]
    kept = {
        "distinct_times": "ENCOUNTERID in (select ENCOUNTERID from matched group by ENCOUNTERID"
        " having count(distinct SPECIMEN_DATE_TIME) > 1)",
        "rank": "ENCOUNTERID in (select ENCOUNTERID from ranked where rn > 1)",
        "exclusion": "true",
    }[cfg.min_scr_rule]

    steps = {
        "initial_cohort": f"""
            select ENCOUNTERID, PATID, age_at_admit, {_stamp("ADMIT_DATE", "ADMIT_TIME", cfg)} as {_ADMIT},
                   {_stamp("DISCHARGE_DATE", "DISCHARGE_TIME", cfg)} as {_DISCHARGE},
                   cast(DISCHARGE_DATE - ADMIT_DATE as integer) as los{extra}
            from (select e.*, {_age("e.ADMIT_DATE", "d.BIRTH_DATE", cfg.age_mode)} as age_at_admit
                  from ENCOUNTER e join DEMOGRAPHIC d using (PATID)
                  where e.DISCHARGE_DATE >= e.ADMIT_DATE + {cfg.min_stay_days}
                    and e.ENC_TYPE in ({_list(cfg.enc_types)})
                    and e.ADMIT_DATE between date '{cfg.window_start}' and date '{cfg.window_end}'
                  {one_per_discharge})
            where age_at_admit >= {cfg.min_age}""",
        "scr_mean": f"""
            select PATID, ENCOUNTERID, LAB_ORDER_DATE, SPECIMEN_DATE, SPECIMEN_TIME, RESULT_DATE,
                   RESULT_TIME, round(avg(RESULT_NUM), 6) as RESULT_NUM
            from LAB_RESULT_CM
            where {_scr_predicate(cfg)} and PATID in (select PATID from initial_cohort)
            group by all""",
        "all_scr_egfr": f"""
            select distinct PATID, {owner}SERUM_CREAT,
                   round(175.0 * {scr_term} * {age_term} * if(SEX = 'F', 0.742, 1.0)
                         * if(RACE = '03', 1.212, 1.0), {10 if cfg.egfr_round else 4}) as EGFR,
                   LAB_ORDER_DATE, {_stamp("SPECIMEN_DATE", "SPECIMEN_TIME", cfg)} as SPECIMEN_DATE_TIME,
                   {_stamp("RESULT_DATE", "RESULT_TIME", cfg)} as RESULT_DATE_TIME
            from (select m.*, m.RESULT_NUM as SERUM_CREAT, d.SEX, d.RACE,
                         {_age("m.LAB_ORDER_DATE", "d.BIRTH_DATE", cfg.age_mode)} as AGE
                  from scr_mean m join DEMOGRAPHIC d on d.PATID = m.PATID)
            where AGE >= {cfg.min_age}""",
        "matched": matched,
        "ranked": f"select *, {rank} as rn from matched",
        "aki_scr_egfr": f"""
            select distinct PATID, ENCOUNTERID, SERUM_CREAT, EGFR, LAB_ORDER_DATE,
                   SPECIMEN_DATE_TIME, RESULT_DATE_TIME, {_ADMIT}, cast(rn as integer) as rn
            from ranked where {kept}""",
        "init": "select * from initial_cohort semi join aki_scr_egfr using (ENCOUNTERID)",
        "first_scr": f"""
            select a.*, c.{_DISCHARGE} from aki_scr_egfr a join initial_cohort c using (ENCOUNTERID)
            where a.rn = 1""",
        "baseline_first": f"""
            select PATID, ENCOUNTERID, {_ADMIT}, {_DISCHARGE}, LAB_ORDER_DATE, SPECIMEN_DATE_TIME,
                   RESULT_DATE_TIME, min(SERUM_CREAT) as SERUM_CREAT, max(EGFR) as EGFR
            from first_scr group by all""",
        "baseline_prior_2d": f"""
            with prior as (
                select f.ENCOUNTERID, s.*, date_diff('day', s.LAB_ORDER_DATE, f.LAB_ORDER_DATE) as gap
                from (select distinct ENCOUNTERID, PATID, LAB_ORDER_DATE from first_scr) f
                join (select * exclude (ENCOUNTERID) from all_scr_egfr) s
                  on s.PATID = f.PATID and s.LAB_ORDER_DATE < f.LAB_ORDER_DATE
                 and date_diff('day', s.LAB_ORDER_DATE, f.LAB_ORDER_DATE) < 2)
            select f.PATID, f.ENCOUNTERID, f.{_ADMIT}, f.{_DISCHARGE},
                   coalesce(p.LAB_ORDER_DATE, f.LAB_ORDER_DATE) as LAB_ORDER_DATE,
                   coalesce(p.SPECIMEN_DATE_TIME, f.SPECIMEN_DATE_TIME) as SPECIMEN_DATE_TIME,
                   coalesce(p.RESULT_DATE_TIME, f.RESULT_DATE_TIME) as RESULT_DATE_TIME,
                   cast(p.gap as integer) as days_prior,
                   max(coalesce(p.SERUM_CREAT, f.SERUM_CREAT)) as SERUM_CREAT,
                   min(coalesce(p.EGFR, f.EGFR)) as EGFR
            from first_scr f left join prior p on p.ENCOUNTERID = f.ENCOUNTERID
            group by all""",
    }
    steps["baseline"] = f"select * from baseline_{cfg.baseline_mode}"
    return steps


def _exclusion_steps(cfg: CohortConfig) -> dict[str, str]:
    cut = "<=" if cfg.egfr_cut_inclusive else "<"
    bound = (
        "cast(f.SPECIMEN_DATE_TIME as date) + 2"
        if cfg.rrt48_trunc
        else "f.SPECIMEN_DATE_TIME + interval 2 day"
    )
    transplant, dialysis = _codes("TRANSPLANT_PX", "PX_TYPE", "PX"), _codes(
        "DIALYSIS_PX", "PX_TYPE", "PX"
    )
    early = f"({transplant} or {dialysis})" if cfg.rrt48_counts_dialysis else transplant

    def before(table: str, day: str, codes: str) -> str:
        return f"""select distinct i.ENCOUNTERID from init i join {table} t on t.PATID = i.PATID
            where {codes} and t.{day} < cast(i.{_ADMIT} as date)"""

    steps = {
        "excl_low_egfr": f"""select distinct ENCOUNTERID from aki_scr_egfr
            where rn = 1 and EGFR {cut} {cfg.egfr_cut}""",
        "excl_pre_esrd": before("DIAGNOSIS", "ADMIT_DATE", _codes("ESRD_DX", "DX_TYPE", "DX")),
        "excl_pre_rrt_dx": before("DIAGNOSIS", "ADMIT_DATE", _codes("RRT_DX", "DX_TYPE", "DX")),
        "excl_pre_rrt_px": before("PROCEDURES", "PX_DATE", f"({transplant} or {dialysis})"),
        "excl_pre_rrt": "select * from excl_pre_rrt_dx union select * from excl_pre_rrt_px",
        "excl_rrt_48h": f"""
            select distinct f.ENCOUNTERID from first_scr f join PROCEDURES p on p.PATID = f.PATID
            where {early} and p.PX_DATE >= cast(f.{_ADMIT} as date) and p.PX_DATE < {bound}""",
        "excl_burn": f"""
            select distinct i.ENCOUNTERID from init i
            join DIAGNOSIS t on t.PATID = i.PATID and t.ADMIT_DATE = cast(i.{_ADMIT} as date)
            where t.DX_SOURCE = 'AD' and {_codes("BURN_DX", "DX_TYPE", "DX")}""",
        "excl_few_scr": """select ENCOUNTERID from aki_scr_egfr group by ENCOUNTERID
            having max(rn) <= 1""",
    }
    if cfg.merge_renal_failure:
        labels = {
            "Less_than_2_SCr": "excl_few_scr",
            "Initial_GFR_below_15": "excl_low_egfr",
            "Pre_renal_failure": "(select * from excl_pre_esrd union select * from excl_pre_rrt)",
            "Renal_transplant_within_48hr": "excl_rrt_48h",
            "Burn_patients": "excl_burn",
        }
    else:
        labels = {
            "Initial_GFR_below_15": "excl_low_egfr",
            "Pre_ESRD": "excl_pre_esrd",
            "Pre_RRT": "excl_pre_rrt",
            "RRT_within_48hr": "excl_rrt_48h",
            "Burn_patients": "excl_burn",
        }
    steps["exclude_all"] = " union all ".join(
        f"select ENCOUNTERID, '{label}' as EXCLUD_TYPE from {source}"
        for label, source in labels.items()
    )
    dx, px = ("DX_TYPE", "DX", "ADMIT_DATE"), ("PX_TYPE", "PX", "PX_DATE")
    audited = {
        "pre_esrd": ("DIAGNOSIS", dx, _codes("ESRD_DX", "DX_TYPE", "DX")),
        "pre_rrt_dx": ("DIAGNOSIS", dx, _codes("RRT_DX", "DX_TYPE", "DX")),
        "pre_rrt_px": ("PROCEDURES", px, f"({transplant} or {dialysis})"),
    }
    for rule, (table, columns, codes) in audited.items():
        listed = ", ".join(f"t.{c}" for c in columns)
        for suffix, which in (("", codes), ("_every_code", "true")):
            steps[f"audit_{rule}{suffix}"] = f"""
                select i.ENCOUNTERID, {listed} from init i join {table} t on t.PATID = i.PATID
                where i.ENCOUNTERID in (select ENCOUNTERID from excl_{rule}) and {which}"""
    steps["eligible"] = f"""
        select a.PATID, a.ENCOUNTERID, b.{_ADMIT}, b.{_DISCHARGE},
               b.SERUM_CREAT as SERUM_CREAT_BASE, b.SPECIMEN_DATE_TIME as SPECIMEN_DATE_TIME_BASE,
               b.RESULT_DATE_TIME as RESULT_DATE_TIME_BASE, a.SERUM_CREAT, a.EGFR,
               a.SPECIMEN_DATE_TIME, a.RESULT_DATE_TIME, a.rn
        from aki_scr_egfr a join baseline b on b.ENCOUNTERID = a.ENCOUNTERID
        where a.ENCOUNTERID not in (select ENCOUNTERID from exclude_all)"""
    return steps


def _staging_steps(cfg: CohortConfig) -> dict[str, str]:
    nulls = "nulls first" if cfg.stage_nulls_first else "nulls last"
    severity = f"AKI_STAGE desc, SERUM_CREAT desc {nulls}, SERUM_CREAT_INC desc {nulls}"
    ids = f"PATID, ENCOUNTERID, {_ADMIT}, {_DISCHARGE}, SERUM_CREAT_BASE"
    base_time = "SPECIMEN_DATE_TIME_BASE as SERUM_CREAT_BASE_DATE_TIME"
    bound = f"and p.PX_DATE between e.{_ADMIT} and e.{_DISCHARGE}" if cfg.rrt_bounded else ""
    gap = _seconds("x.SPECIMEN_DATE_TIME", "y.SPECIMEN_DATE_TIME")
    near = {
        "exact": f"{gap} > 0 and {gap} <= 172800",
        "whole": f"{gap} / 3600.0 between 0.001 and 48",
        "boundary": "y.SPECIMEN_DATE_TIME > x.SPECIMEN_DATE_TIME and "
        "cast(y.SPECIMEN_DATE_TIME as date) - cast(x.SPECIMEN_DATE_TIME as date) <= 2",
    }[cfg.diff_mode]
    after_base = _seconds("SPECIMEN_DATE_TIME_BASE", "SPECIMEN_DATE_TIME")
    week = {
        "from_base": f"SPECIMEN_DATE_TIME_BASE >= {_ADMIT} and {after_base} > 0"
        f" and {after_base} <= 604800",
        "whole_days": f"SPECIMEN_DATE_TIME_BASE >= {_ADMIT} and "
        + _days("SPECIMEN_DATE_TIME_BASE", "SPECIMEN_DATE_TIME", "whole")
        + " between 1 and 7",
        "from_admit": f"SPECIMEN_DATE_TIME_BASE < {_ADMIT} and SPECIMEN_DATE_TIME > {_ADMIT} and "
        + _days(_ADMIT, "SPECIMEN_DATE_TIME", "boundary")
        + " <= 7",
    }[cfg.ratio_window]
    micro = "cast(round({} * 1000000) as bigint)"
    scr, base = micro.format("SERUM_CREAT"), micro.format("SERUM_CREAT_BASE")
    hours = (
        f"cast(date_diff('hour', {_ADMIT}, SPECIMEN_DATE_TIME) as integer)"
        if cfg.diff_mode == "boundary"
        else f"cast(round({_seconds(_ADMIT, 'SPECIMEN_DATE_TIME')} / 3600) as integer)"
    )
    with_rrt = (
        f"""union all by name
            select {ids}, {base_time}, 3 as AKI_STAGE,
                   cast(SPECIMEN_DATE_TIME as timestamp) as SPECIMEN_DATE_TIME from rrt_stage3"""
        if cfg.rrt_stage3
        else ""
    )
    ties = """SPECIMEN_DATE_TIME, SERUM_CREAT nulls last, SERUM_CREAT_INC nulls last,
        SERUM_CREAT_RBASE nulls last, SERUM_CREAT_BASE, SERUM_CREAT_BASE_DATE_TIME nulls last"""
    steps = {
        "rrt_stage3": f"""
            select {", ".join("e." + c for c in ids.split(", "))}, e.SPECIMEN_DATE_TIME_BASE,
                   min(p.PX_DATE) as SPECIMEN_DATE_TIME
            from eligible e join PROCEDURES p on p.PATID = e.PATID
            where {_codes("TRANSPLANT_PX", "p.PX_TYPE", "p.PX")} {bound}
            group by all""",
        "rolling_48h_pairs": f"""
            select distinct {", ".join("x." + c for c in ids.split(", "))}, x.{base_time},
                   x.SERUM_CREAT as SERUM_CREAT_RBASE, y.SERUM_CREAT,
                   y.SERUM_CREAT - x.SERUM_CREAT as SERUM_CREAT_INC, 0 as AKI_STAGE,
                   y.SPECIMEN_DATE_TIME, y.RESULT_DATE_TIME
            from eligible x join eligible y on x.ENCOUNTERID = y.ENCOUNTERID and {near}""",
        "ratio_stage": f"""
            select *, case when SERUM_CREAT_INC >= 3 then 3 when SERUM_CREAT_INC >= 2 then 2
                           when SERUM_CREAT_INC >= 1.5 then 1 else 0 end as AKI_STAGE
            from (select distinct {ids}, {base_time}, cast(null as double) as SERUM_CREAT_RBASE,
                         SERUM_CREAT, floor((20 * {scr} + {base}) / (2 * {base})) / 10.0e0
                             as SERUM_CREAT_INC,
                         SPECIMEN_DATE_TIME, RESULT_DATE_TIME
                  from eligible where {week})""",
        "stage_events": f"""
            select * from rolling_48h_pairs union all by name select * from ratio_stage
            {with_rrt}""",
        "timed": f"""
            select *, {hours} as HOUR_SINCE_ADMIT,
                   cast(floor({_seconds(_ADMIT, "SPECIMEN_DATE_TIME")} / 43200) as integer)
                       as HDAY_SINCE_ADMIT,
                   {_days(_ADMIT, "SPECIMEN_DATE_TIME", cfg.diff_mode)} as DAY_SINCE_ADMIT
            from stage_events""",
        "rank_stages": f"""
            select *, cast(dense_rank() over (partition by PATID, ENCOUNTERID, HDAY_SINCE_ADMIT
                               order by {severity}) as integer) as rn_hday,
                   cast(dense_rank() over (partition by PATID, ENCOUNTERID, DAY_SINCE_ADMIT
                               order by {severity}) as integer) as rn_day
            from timed""",
        "worst_per_day": """
            select distinct * exclude (RESULT_DATE_TIME, HOUR_SINCE_ADMIT, HDAY_SINCE_ADMIT, rn_hday,
                                       rn_day)
            from rank_stages where rn_day = 1""",
        "stages_daily": f"""
            select * exclude (SPECIMEN_DATE_TIME),
                   cast(SPECIMEN_DATE_TIME as date) as SPECIMEN_DATE,
                   cast(row_number() over (partition by ENCOUNTERID, AKI_STAGE
                       order by DAY_SINCE_ADMIT, {ties}) as integer) as rn_asc,
                   cast(row_number() over (partition by ENCOUNTERID, AKI_STAGE
                       order by DAY_SINCE_ADMIT desc, {ties}) as integer) as rn_desc,
                   max(AKI_STAGE) over (partition by ENCOUNTERID) as AKI_STAGE_max
            from worst_per_day""",
        "onset_events": """
            select * from stages_daily
            where (AKI_STAGE_max > 0 and AKI_STAGE > 0 and rn_asc = 1)
               or (AKI_STAGE_max = 0 and rn_desc = 1)""",
    }
    names = {
        0: ("NONAKI_ANCHOR", "NON_AKI_SCR", "NON_AKI_INC"),
        1: ("AKI1_ONSET", "AKI1_SCR", "AKI1_INC"),
        2: ("AKI2_ONSET", "AKI2_SCR", "AKI2_INC"),
        3: ("AKI3_ONSET", "AKI3_SCR", "AKI3_INC"),
    }
    cells = ", ".join(
        f"min(SPECIMEN_DATE) filter (AKI_STAGE = {s}) as {onset}, "
        f"max(SERUM_CREAT) filter (AKI_STAGE = {s}) as {scr_name}, "
        f"max(SERUM_CREAT_INC) filter (AKI_STAGE = {s}) as {inc}"
        for s, (onset, scr_name, inc) in names.items()
    )
    steps["pivot_onsets"] = f"select ENCOUNTERID, {cells} from onset_events group by ENCOUNTERID"
    since = ", ".join(
        f"cast({onset} - ADMIT_DATE as integer) as {name}_SINCE_ADMIT"
        for onset, name in [
            ("NONAKI_ANCHOR", "NONAKI"),
            ("AKI1_ONSET", "AKI1"),
            ("AKI2_ONSET", "AKI2"),
            ("AKI3_ONSET", "AKI3"),
        ]
    )
    steps["raw_onset"] = f"""
        select *, {since}
        from (select distinct PATID, ENCOUNTERID, cast({_ADMIT} as date) as ADMIT_DATE,
                     cast({_DISCHARGE} as date) as DISCHARGE_DATE, SERUM_CREAT_BASE
              from stages_daily) left join pivot_onsets using (ENCOUNTERID)"""
    far = 100000
    later1 = f"least(coalesce(AKI2_SINCE_ADMIT, {far}), coalesce(AKI3_SINCE_ADMIT, {far}))"
    keep1 = f"AKI1_SINCE_ADMIT < {later1}"
    keep2 = f"AKI2_SINCE_ADMIT < coalesce(AKI3_SINCE_ADMIT, {far})"
    pruned = ", ".join(
        f"case when {keep} then AKI{s}_{part} end as AKI{s}_{part}"
        for s, keep in ((1, keep1), (2, keep2))
        for part in ("ONSET", "SINCE_ADMIT", "SCR", "INC")
    )
    steps["aki_onsets"] = f"""
        select distinct PATID, ENCOUNTERID, ADMIT_DATE, strftime(ADMIT_DATE, '%Y') as ADMIT_YEAR,
               DISCHARGE_DATE, SERUM_CREAT_BASE, NONAKI_ANCHOR, NONAKI_SINCE_ADMIT, NON_AKI_SCR,
               NON_AKI_INC, {pruned},
               case when ADMIT_DATE <= date '{cfg.split_date}' then 1 else 0 end as BCCOVID,
               AKI3_ONSET, AKI3_SINCE_ADMIT, AKI3_SCR, AKI3_INC
        from raw_onset"""
    return steps


def _attrition_steps(cfg: CohortConfig) -> dict[str, str]:
    steps = {}
    for era, sign, flag in (("bc", "<=", 1), ("ad", ">", 0)):
        member = f"{_ADMIT} {sign} timestamp '{cfg.split_date} 00:00:00'"
        one, two, three = (f"AKI{s}_ONSET is not null" for s in (1, 2, 3))
        groups = {
            "Total": "true",
            "nonAKI": f"not ({one}) and not ({two}) and not ({three})",
            "AKI1": one,
            "nonAKI_to_AKI2": f"not ({one}) and {two}",
            "AKI1_to_AKI2": f"{one} and {two}",
            "nonAKI_to_AKI3": f"not ({one}) and not ({two}) and {three}",
            "nonAKI_to_AKI2_to_AKI3": f"not ({one}) and {two} and {three}",
            "AKI1_to_AKI2_to_AKI3": f"{one} and {two} and {three}",
        }
        steps[f"attrition_initial_{era}"] = f"""
            select 'Initial' as CNT_TYPE, count(distinct ENCOUNTERID) as ENC_CNT
            from initial_cohort where {member}"""
        steps[f"attrition_scr_{era}"] = f"""
            select '{cfg.scr_label}' as CNT_TYPE, count(distinct ENCOUNTERID) as ENC_CNT
            from aki_scr_egfr where {member}"""
        steps[f"attrition_exclusions_{era}"] = f"""
            select x.EXCLUD_TYPE as CNT_TYPE, count(distinct x.ENCOUNTERID) as ENC_CNT
            from exclude_all x join initial_cohort c using (ENCOUNTERID) where {member}
            group by x.EXCLUD_TYPE"""
        steps[f"attrition_outcomes_{era}"] = " union all ".join(
            f"select '{label}' as CNT_TYPE, count(distinct ENCOUNTERID) as ENC_CNT "
            f"from aki_onsets where BCCOVID = {flag} and {cond}"
            for label, cond in groups.items()
        )
        steps[f"consort_{era}"] = " union all ".join(
            f"(select * from attrition_{part}_{era})"
            for part in ("initial", "scr", "exclusions", "outcomes")
        )
    steps["consort"] = " union all ".join(
        f"select '{era.upper()}' as ERA, * from consort_{era}" for era in ("bc", "ad")
    )
    return steps


def _collect_steps(cfg: CohortConfig) -> dict[str, str]:
    def window(table, day, lo, hi=_WIN_END, since=None, where="true", extra="", distinct=True):
        return f"""
            select {"distinct" if distinct else ""} o.ENCOUNTERID as ONSETS_ENCOUNTERID, t.*{extra},
                   cast(t.{since or day} - o.ADMIT_DATE as integer) as DAYS_SINCE_ADMIT
            from aki_onsets o join {table} t on t.PATID = o.PATID
            where t.{day} between o.ADMIT_DATE - {lo} and {hi} and {where}"""

    end = "least(o.DISCHARGE_DATE, t.RX_END_DATE)"
    if cfg.least_null_mode == "null":
        end = f"case when t.RX_END_DATE is not null then {end} end"
    if cfg.end_date_as_text:
        end = f"strftime({end}, '%Y%m%d')"
    has_time = "and t.RX_ORDER_TIME is not null" if cfg.pmed_require_time else ""
    age = _age("o.ADMIT_DATE", "d.BIRTH_DATE", cfg.demo_age_mode)
    return {
        "collect_death": """
            select distinct o.ENCOUNTERID as ONSETS_ENCOUNTERID, t.*,
                   cast(t.DEATH_DATE - o.DISCHARGE_DATE as integer) as DDAYS_SINCE_ENC
            from aki_onsets o left join DEATH t on t.PATID = o.PATID""",
        "collect_demographics": f"""
            select distinct o.ENCOUNTERID as ONSETS_ENCOUNTERID, least({age}, 90) as AGE, d.*,
                   t.DEATH_DATE, cast(t.DEATH_DATE - o.DISCHARGE_DATE as integer) as DDAYS_SINCE_ENC,
                   t.DEATH_DATE_IMPUTE, t.DEATH_SOURCE
            from aki_onsets o left join DEMOGRAPHIC d on d.PATID = o.PATID
            left join DEATH t on t.PATID = o.PATID""",
        "collect_obs_clin": window(
            "OBS_CLIN", "OBSCLIN_START_DATE", 30, distinct=False,
            where=f"t.OBSCLIN_CODE in ({_list(VITAL_CODES + VITAL_NAMES)})",
        ),
        "collect_vital": window("VITAL", "MEASURE_DATE", 30, distinct=False),
        "collect_procedures": window("PROCEDURES", "PX_DATE", 0),
        "collect_dx_history": window(
            "DIAGNOSIS", "ADMIT_DATE", 365, hi="o.ADMIT_DATE - 1", distinct=False
        ),
        "collect_dx_current": window("DIAGNOSIS", "DX_DATE", 0, distinct=False),
        "collect_dx_current_by_admit": window("DIAGNOSIS", "ADMIT_DATE", 0, distinct=False),
        "collect_labs": window("LAB_RESULT_CM", "LAB_ORDER_DATE", 0, since="SPECIMEN_DATE"),
        "collect_scr_history": window(
            "LAB_RESULT_CM", "LAB_ORDER_DATE", 365, since="SPECIMEN_DATE",
            where=_scr_predicate(cfg),
        ),
        "collect_prescribing": window(
            "PRESCRIBING", "RX_ORDER_DATE", 30, since="RX_START_DATE",
            where=f"t.RXNORM_CUI is not null and t.RX_START_DATE is not null {has_time}",
            extra=f""", {end} as RX_END_DATE_MOD, case when t.RX_DAYS_SUPPLY > 0
                   then round(t.RX_QUANTITY / t.RX_DAYS_SUPPLY) end as RX_QUANTITY_DAILY""",
        ),
        "collect_dispensing": window("DISPENSING", "DISPENSE_DATE", 30, where="t.NDC is not null"),
        "collect_med_admin": window(
            "MED_ADMIN", "MEDADMIN_START_DATE", 30,
            where="t.MEDADMIN_CODE is not null and t.MEDADMIN_STOP_DATE is not null",
        ),
        "observation_window": f"""
            select distinct o.ENCOUNTERID, o.PATID, o.ADMIT_DATE, {_WIN_END} as win_end
            from aki_onsets o""",
    }


# De-identified table -> the collected step it shifts.
SHIFT_SOURCES = {
    "AKI_ONSETS": ("shift_onsets", "aki_onsets"),
    "AKI_DEMO_DEATH": ("shift_demo_death", "collect_death"),
    "AKI_DEMO": ("shift_demo", "collect_demographics"),
    "AKI_PX": ("shift_px", "collect_procedures"),
    "AKI_VITAL": ("shift_vital", "collect_obs_clin"),
    "AKI_DX": ("shift_dx", "collect_dx_history"),
    "AKI_LAB": ("shift_lab", "collect_labs"),
    "AKI_PMED": ("shift_pmed", "collect_prescribing"),
    "AKI_AMED": ("shift_amed", "collect_med_admin"),
    "AKI_DMED": ("shift_dmed", "collect_dispensing"),
    "AKI_DX_CURRENT": ("shift_dx_current", "collect_dx_current"),
    "AKI_LAB_SCR": ("shift_lab_scr", "collect_scr_history"),
    "AKI_VITAL_OLD": ("shift_vital_old", "collect_vital"),
}


def _deid_steps(cfg: CohortConfig) -> dict[str, str]:
    span = cfg.shift_hi - cfg.shift_lo + 1
    steps = {
        "date_shift_table": f"""
            select distinct PATID, cast(cast('0x' || substr(sha256('{SALT}:' || PATID), 1, 15)
                                             as bigint) % {span} + ({cfg.shift_lo}) as integer)
                                       as date_shift
            from aki_onsets"""
    }
    for table, (name, source) in SHIFT_SOURCES.items():
        moved = [
            f"cast(s.{c} + h.date_shift as date) as {c}"
            for c in SHIFTED_DATES[table]
            if not (table == "AKI_VITAL_OLD" and c not in ("MEASURE_DATE",))
        ]
        if table == "AKI_ONSETS":
            moved.append("strftime(s.ADMIT_DATE + h.date_shift, '%Y') as ADMIT_YEAR")
        steps[name] = f"""
            select s.* replace ({", ".join(moved)})
            from {source} s join date_shift_table h on h.PATID = s.PATID"""
    return steps


def _source_steps() -> dict[str, str]:
    death = sorted(["ONSETS_ENCOUNTERID", *SCHEMAS["DEATH"].names, "DDAYS_SINCE_ENC"])
    sized = " || ".join(
        f"length({text}) || ':' || {text}"
        for text in (f"coalesce(cast({c} as varchar), '')" for c in death)
    )
    stored = ["ENCOUNTER", "DEMOGRAPHIC", "LAB_RESULT_CM", "DIAGNOSIS", "PROCEDURES", "DEATH", "VITAL"]
    return {
        "load_cdm": " union all ".join(
            f"select '{name}' as table_name, count(*) as n_rows, "
            f"count(distinct PATID) as n_patients from {name}"
            for name in stored
        ),
        "export_csv": "select cast(columns(*) as varchar) from collect_death",
        "export_manifest": f"""
            select 'AKI_DEMO_DEATH' as "TABLE", count(*) as N_ROWS, true as INTACT,
                   cast(sum(cast('0x' || substr(md5({sized}), 1, 15) as bigint)) as varchar) as CHECKSUM
            from collect_death""",
    }


def _model_steps() -> dict[str, str]:
    return {
        "matrix": matrix.MATRIX_SQL,
        "class_weight": matrix.WEIGHT_SQL,
        "stratified_folds": matrix.FOLDS_SQL,
        "roc_auc": matrix.AUC_SQL,
        "boolean_features": matrix.KINDS_SQL,
        "halving_rungs": matrix.RUNGS_SQL,
        "grid_parameters": matrix.GRID_SQL,
        "stored_matrix": matrix.STORED_SQL,
        "run_settings": matrix.SETTINGS_SQL,
    }


def steps(cfg: CohortConfig) -> dict[str, str]:
    """All steps of a preset, in an order in which each only uses earlier ones."""
    return {
        **VIEWS,
        **_cohort_steps(cfg),
        **_exclusion_steps(cfg),
        **_staging_steps(cfg),
        **_attrition_steps(cfg),
        **_collect_steps(cfg),
        **_deid_steps(cfg),
        **_source_steps(),
        **_model_steps(),
    }


def statement(cfg: CohortConfig, target: str, final: str | None = None) -> str:
    """One statement for a step: WITH the steps it needs, SELECT from it."""
    available = steps(cfg)
    needed: set[str] = set()
    queue = [target, *re.findall(r"\w+", final or "")]
    while queue:
        name = queue.pop()
        if name in needed or name not in available:
            continue
        needed.add(name)
        queue += re.findall(r"\w+", available[name])
    ctes = ",\n".join(
        f"{name} as materialized ({text})" for name, text in available.items() if name in needed
    )
    return f"with {ctes}\n{final or f'select * from {target}'}"
