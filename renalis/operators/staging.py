"""Kidney-injury stages per lab event, the worst per day, and the onset of each stage per stay."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from renalis.config import CohortConfig
from renalis.functions.clinical import ratio_to_stage, scr_ratio
from renalis.functions.time import (
    DAY_SECONDS,
    days_between,
    epoch_day,
    epoch_seconds,
    hours_between,
    second_of_day,
    seconds_between,
)
from renalis.operators.exclusions import first_transplant_day, procedure_history

BASE = ["SERUM_CREAT_BASE", "SERUM_CREAT_BASE_DATE_TIME"]
STAY = ["PATID", "ENCOUNTERID", "ADMIT_DATE_TIME", "DISCHARGE_DATE_TIME"]
VALUES = ["SERUM_CREAT_RBASE", "SERUM_CREAT", "SERUM_CREAT_INC"]
EVENT = STAY + BASE + VALUES + ["AKI_STAGE", "SPECIMEN_DATE_TIME"]
ROLLING_SECONDS = 2 * DAY_SECONDS


def _base_time() -> Column:
    return F.col("SPECIMEN_DATE_TIME_BASE").alias("SERUM_CREAT_BASE_DATE_TIME")


def _min_gap(cfg: CohortConfig) -> int:
    """Shortest gap in whole seconds between a value and its rolling baseline."""
    # 0.001 hours is 3.6 seconds.
    return 4 if cfg.diff_mode == "whole" else 1


def rrt_stage3(baseline: DataFrame, procedures: DataFrame, cfg: CohortConfig) -> DataFrame:
    """First transplant day within the stay, per eligible baseline."""
    days = procedure_history(procedures, cfg).select("PATID", "TRANSPLANT_DAYS")
    return rrt_of_baselines(
        baseline.join(days, "PATID").withColumn("RRT_DATE", first_transplant_day(cfg))
    )


def rrt_of_baselines(baseline: DataFrame) -> DataFrame:
    """The baselines that already know their RRT_DATE, as stage 3 rows."""
    return (
        baseline.filter(F.col("RRT_DATE").isNotNull())
        .select(
            *STAY,
            F.col("SERUM_CREAT").alias("SERUM_CREAT_BASE"),
            F.col("SPECIMEN_DATE_TIME").alias("SPECIMEN_DATE_TIME_BASE"),
            F.col("RRT_DATE").alias("SPECIMEN_DATE_TIME"),
        )
        .distinct()
    )


def rrt_events(rrt: DataFrame) -> DataFrame:
    """The transplant days as stage 3 events without values."""
    empty = F.lit(None).cast("double")
    return rrt.select(
        *STAY,
        "SERUM_CREAT_BASE",
        _base_time(),
        *[empty.alias(c) for c in VALUES],
        F.lit(3).alias("AKI_STAGE"),
        F.col("SPECIMEN_DATE_TIME").cast("timestamp_ntz").alias("SPECIMEN_DATE_TIME"),
        F.lit(None).cast("timestamp_ntz").alias("RESULT_DATE_TIME"),
    )


def rolling_48h_pairs(eligible: DataFrame, cfg: CohortConfig) -> DataFrame:
    """Each value next to the earlier values of its stay in the 48 hours before it, as stage 0.

    The earlier side is copied to the time slots its window reaches and joined on (stay, slot), so
    values of one long stay that lie further apart are never compared.
    """
    boundary = cfg.diff_mode == "boundary"

    def slot(ts: Column) -> Column:
        if boundary:
            return epoch_day(ts).cast("long")
        return F.floor(epoch_seconds(ts) / F.lit(ROLLING_SECONDS))

    reach = 2 if boundary else 1
    taken = F.col("SPECIMEN_DATE_TIME")
    earlier = (
        eligible.select(
            *STAY,
            "SERUM_CREAT_BASE",
            _base_time(),
            F.col("SERUM_CREAT").alias("SERUM_CREAT_RBASE"),
            taken.alias("RBASE_TIME"),
        )
        .distinct()
        .withColumn("first_slot", slot(F.col("RBASE_TIME")))
        .withColumn("slot", F.explode(F.sequence("first_slot", F.col("first_slot") + reach)))
    )
    later = (
        eligible.select("ENCOUNTERID", "SERUM_CREAT", "SPECIMEN_DATE_TIME", "RESULT_DATE_TIME")
        .distinct()
        .withColumn("slot", slot(taken))
    )
    if boundary:
        near = (F.datediff("SPECIMEN_DATE_TIME", "RBASE_TIME") <= 2) & (taken > F.col("RBASE_TIME"))
    else:
        near = seconds_between(F.col("RBASE_TIME"), taken).between(_min_gap(cfg), ROLLING_SECONDS)
    return (
        earlier.join(later, ["ENCOUNTERID", "slot"])
        .filter(near)
        .select(
            *STAY,
            *BASE,
            "SERUM_CREAT_RBASE",
            "SERUM_CREAT",
            (F.col("SERUM_CREAT") - F.col("SERUM_CREAT_RBASE")).alias("SERUM_CREAT_INC"),
            F.lit(0).alias("AKI_STAGE"),
            "SPECIMEN_DATE_TIME",
            "RESULT_DATE_TIME",
        )
        .distinct()
    )


def _in_ratio_window(cfg: CohortConfig) -> Column:
    admit, base, taken = (
        F.col("ADMIT_DATE_TIME"),
        F.col("SPECIMEN_DATE_TIME_BASE"),
        F.col("SPECIMEN_DATE_TIME"),
    )
    if cfg.ratio_window == "from_admit":
        return (base < admit) & (F.datediff(taken, admit) <= 7) & (taken > admit)
    if cfg.ratio_window == "whole_days":
        return (base >= admit) & days_between(base, taken, "whole").between(1, 7)
    return (base >= admit) & seconds_between(base, taken).between(1, 7 * DAY_SECONDS)


def ratio_stage(eligible: DataFrame, cfg: CohortConfig) -> DataFrame:
    """Stage of each value by its ratio to the stay's baseline, within a week."""
    ratio = scr_ratio(F.col("SERUM_CREAT"), F.col("SERUM_CREAT_BASE"))
    return (
        eligible.filter(_in_ratio_window(cfg))
        .select(
            *STAY,
            "SERUM_CREAT_BASE",
            _base_time(),
            F.lit(None).cast("double").alias("SERUM_CREAT_RBASE"),
            "SERUM_CREAT",
            ratio.alias("SERUM_CREAT_INC"),
            ratio_to_stage(ratio).alias("AKI_STAGE"),
            "SPECIMEN_DATE_TIME",
            "RESULT_DATE_TIME",
        )
        .distinct()
    )


def stage_events(eligible: DataFrame, rrt: DataFrame | None, cfg: CohortConfig) -> DataFrame:
    """All staged events: rolling pairs, ratios and, if the preset says so, transplants."""
    events = rolling_48h_pairs(eligible, cfg).unionByName(ratio_stage(eligible, cfg))
    if cfg.rrt_stage3 and rrt is not None:
        events = events.unionByName(rrt_events(rrt))
    return events


def time_since_admit(events: DataFrame, cfg: CohortConfig) -> DataFrame:
    admit, taken = F.col("ADMIT_DATE_TIME"), F.col("SPECIMEN_DATE_TIME")
    half_days = seconds_between(admit, taken) / F.lit(DAY_SECONDS // 2)
    return events.withColumns(
        {
            "HOUR_SINCE_ADMIT": hours_between(admit, taken, cfg.diff_mode),
            "HDAY_SINCE_ADMIT": F.floor(half_days).cast("int"),
            "DAY_SINCE_ADMIT": days_between(admit, taken, cfg.diff_mode),
        }
    )


def _worst_first(cfg: CohortConfig) -> list[Column]:
    def down(name: str) -> Column:
        column = F.col(name)
        return column.desc_nulls_first() if cfg.stage_nulls_first else column.desc_nulls_last()

    return [F.col("AKI_STAGE").desc(), down("SERUM_CREAT"), down("SERUM_CREAT_INC")]


def rank_stages(events: DataFrame, cfg: CohortConfig) -> DataFrame:
    """Events with the rank of their severity in the half-day and in the day of the stay."""
    stay = ["PATID", "ENCOUNTERID"]
    half_day = Window.partitionBy(*stay, "HDAY_SINCE_ADMIT").orderBy(*_worst_first(cfg))
    day = Window.partitionBy(*stay, "DAY_SINCE_ADMIT").orderBy(*_worst_first(cfg))
    return time_since_admit(events, cfg).withColumns(
        {"rn_hday": F.dense_rank().over(half_day), "rn_day": F.dense_rank().over(day)}
    )


def daily_candidates(eligible: DataFrame, cfg: CohortConfig) -> DataFrame:
    """The staged events that can be the worst of a day, without building any pairs.

    At one specimen time only the highest value can win, and next to one value only its lowest
    predecessor of the 48 hours gives the largest increment. So each stay shrinks to one row per
    specimen time (map-side combined), and a range frame finds the predecessor.
    """
    stay_base = [*STAY, "SERUM_CREAT_BASE", "SPECIMEN_DATE_TIME_BASE"]
    points = (
        eligible.filter(F.col("SPECIMEN_DATE_TIME").isNotNull())
        .groupBy(*stay_base, "SPECIMEN_DATE_TIME")
        .agg(F.max("SERUM_CREAT").alias("SERUM_CREAT"), F.min("SERUM_CREAT").alias("lowest"))
    )
    taken = F.col("SPECIMEN_DATE_TIME")
    series = Window.partitionBy(*stay_base)
    lowest = F.min("lowest")
    if cfg.diff_mode == "boundary":
        same_day = (
            Window.partitionBy(*stay_base, F.to_date(taken))
            .orderBy(second_of_day(taken))
            .rangeBetween(Window.unboundedPreceding, -1)
        )
        days_before = series.orderBy(epoch_day(taken)).rangeBetween(-2, -1)
        rolling = F.least(lowest.over(days_before), lowest.over(same_day))
    else:
        frame = series.orderBy(epoch_seconds(taken)).rangeBetween(-ROLLING_SECONDS, -_min_gap(cfg))
        rolling = lowest.over(frame)
    scr = F.col("SERUM_CREAT")
    ratio = scr_ratio(scr, F.col("SERUM_CREAT_BASE"))
    by_pair = F.when(
        F.col("rolling").isNotNull(),
        F.struct(
            F.col("rolling").alias("SERUM_CREAT_RBASE"),
            (scr - F.col("rolling")).alias("SERUM_CREAT_INC"),
            F.lit(0).alias("AKI_STAGE"),
        ),
    )
    by_ratio = F.when(
        _in_ratio_window(cfg),
        F.struct(
            F.lit(None).cast("double").alias("SERUM_CREAT_RBASE"),
            ratio.alias("SERUM_CREAT_INC"),
            ratio_to_stage(ratio).alias("AKI_STAGE"),
        ),
    )
    return (
        points.withColumn("rolling", rolling)
        .withColumn("event", F.explode(F.array(by_pair, by_ratio)))
        .filter(F.col("event").isNotNull())
        .select(
            *STAY,
            "SERUM_CREAT_BASE",
            _base_time(),
            "event.SERUM_CREAT_RBASE",
            "SERUM_CREAT",
            "event.SERUM_CREAT_INC",
            "event.AKI_STAGE",
            "SPECIMEN_DATE_TIME",
        )
    )


def worst_per_day(events: DataFrame, cfg: CohortConfig) -> DataFrame:
    """The worst events of each day of a stay, ties kept.

    The rank filter becomes a group limit ahead of the shuffle, so a crowded day sends its top only.
    """
    day = Window.partitionBy("PATID", "ENCOUNTERID", "DAY_SINCE_ADMIT").orderBy(*_worst_first(cfg))
    since = days_between(F.col("ADMIT_DATE_TIME"), F.col("SPECIMEN_DATE_TIME"), cfg.diff_mode)
    return (
        events.select(*EVENT)
        .withColumn("DAY_SINCE_ADMIT", since)
        .withColumn("rn_day", F.dense_rank().over(day))
        .filter(F.col("rn_day") == 1)
        .drop("rn_day")
        .distinct()
    )


def stages_daily(worst: DataFrame) -> DataFrame:
    """Days of each stay and stage counted from the first and from the last, and the top stage."""
    ties = [
        F.col(c).asc_nulls_last()
        for c in ["SPECIMEN_DATE_TIME", "SERUM_CREAT", "SERUM_CREAT_INC"]
        + ["SERUM_CREAT_RBASE", *BASE]
    ]
    stage = Window.partitionBy("ENCOUNTERID", "AKI_STAGE")
    # The stay-wide maximum comes first: the stage windows then reuse its partitioning.
    return (
        worst.withColumn(
            "AKI_STAGE_max", F.max("AKI_STAGE").over(Window.partitionBy("ENCOUNTERID"))
        )
        .withColumn("rn_asc", F.row_number().over(stage.orderBy(F.col("DAY_SINCE_ADMIT"), *ties)))
        .withColumn(
            "rn_desc", F.row_number().over(stage.orderBy(F.col("DAY_SINCE_ADMIT").desc(), *ties))
        )
        .withColumn("SPECIMEN_DATE", F.to_date("SPECIMEN_DATE_TIME"))
        .drop("SPECIMEN_DATE_TIME")
    )


def _is_onset() -> Column:
    top, stage = F.col("AKI_STAGE_max"), F.col("AKI_STAGE")
    injured = (F.col("rn_asc") == 1) & (top > 0) & (stage > 0)
    spared = (F.col("rn_desc") == 1) & (top == 0) & (stage == 0)
    return injured | spared


def onset_events(daily: DataFrame) -> DataFrame:
    """First day of each stage of an injured stay; last day of a stay without injury."""
    return daily.filter(_is_onset())


# Output columns by stage: date, value, increment.
STAGE_COLUMNS = {
    0: ("NONAKI_ANCHOR", "NON_AKI_SCR", "NON_AKI_INC"),
    1: ("AKI1_ONSET", "AKI1_SCR", "AKI1_INC"),
    2: ("AKI2_ONSET", "AKI2_SCR", "AKI2_INC"),
    3: ("AKI3_ONSET", "AKI3_SCR", "AKI3_INC"),
}


def _cells(picked: Column | None = None) -> dict[str, Column]:
    """Aggregates that put each stage's date, value and increment in columns of their own."""
    cells = {}
    for stage, (onset, scr, inc) in STAGE_COLUMNS.items():
        here = F.col("AKI_STAGE") == stage
        if picked is not None:
            here = picked & here
        cells[onset] = F.min(F.when(here, F.col("SPECIMEN_DATE")))
        cells[scr] = F.max(F.when(here, F.col("SERUM_CREAT")))
        cells[inc] = F.max(F.when(here, F.col("SERUM_CREAT_INC")))
    return cells


def pivot_onsets(events: DataFrame) -> DataFrame:
    """One row per stay, stages as columns: date, value and increment in a single aggregation."""
    return events.groupBy("ENCOUNTERID").agg(*[c.alias(n) for n, c in _cells().items()])


def raw_onset(daily: DataFrame) -> DataFrame:
    """Stays with their stage onsets and days since admission, before pruning.

    The pivot runs as a window over the stay's days, so the days are computed once and neither the
    pivot nor the distinct shuffles again.
    """
    stay = Window.partitionBy("ENCOUNTERID")
    pivoted = daily.withColumns({n: c.over(stay) for n, c in _cells(_is_onset()).items()})
    stays = pivoted.select(
        "PATID",
        "ENCOUNTERID",
        F.to_date("ADMIT_DATE_TIME").alias("ADMIT_DATE"),
        F.to_date("DISCHARGE_DATE_TIME").alias("DISCHARGE_DATE"),
        "SERUM_CREAT_BASE",
        *_cells(),
    ).distinct()
    return stays.withColumns(
        {
            since: F.datediff(onset, "ADMIT_DATE")
            for onset, since in [
                ("NONAKI_ANCHOR", "NONAKI_SINCE_ADMIT"),
                ("AKI1_ONSET", "AKI1_SINCE_ADMIT"),
                ("AKI2_ONSET", "AKI2_SINCE_ADMIT"),
                ("AKI3_ONSET", "AKI3_SINCE_ADMIT"),
            ]
        }
    )


def prune_recovering(onsets: DataFrame) -> DataFrame:
    """Drop the onset of a stage that is not earlier than the onset of a higher one."""
    day = {s: F.col(f"AKI{s}_SINCE_ADMIT") for s in (1, 2, 3)}
    late1 = F.coalesce(day[1] >= day[2], F.lit(False)) | F.coalesce(day[1] >= day[3], F.lit(False))
    late2 = F.coalesce(day[2] >= day[3], F.lit(False))
    pruned = {}
    for stage, late in ((1, late1), (2, late2)):
        for part in ("ONSET", "SINCE_ADMIT", "SCR", "INC"):
            name = f"AKI{stage}_{part}"
            pruned[name] = F.when(~late, F.col(name))
    return onsets.withColumns(pruned)


def era_flag(onsets: DataFrame, cfg: CohortConfig) -> DataFrame:
    """BCCOVID: 1 for stays admitted up to the split date. ADMIT_YEAR: the year as text."""
    return onsets.withColumns(
        {
            "ADMIT_YEAR": F.date_format("ADMIT_DATE", "yyyy"),
            "BCCOVID": F.when(F.col("ADMIT_DATE") <= F.lit(cfg.split_date), 1).otherwise(0),
        }
    )


ONSET_COLUMNS = [
    "PATID", "ENCOUNTERID", "ADMIT_DATE", "ADMIT_YEAR", "DISCHARGE_DATE", "SERUM_CREAT_BASE",
    "NONAKI_ANCHOR", "NONAKI_SINCE_ADMIT", "NON_AKI_SCR", "NON_AKI_INC",
    "AKI1_ONSET", "AKI1_SINCE_ADMIT", "AKI1_SCR", "AKI1_INC",
    "AKI2_ONSET", "AKI2_SINCE_ADMIT", "AKI2_SCR", "AKI2_INC", "BCCOVID",
    "AKI3_ONSET", "AKI3_SINCE_ADMIT", "AKI3_SCR", "AKI3_INC",
]


def aki_onsets(daily: DataFrame, cfg: CohortConfig) -> DataFrame:
    """The onset table: one row per eligible stay and baseline value."""
    return era_flag(prune_recovering(raw_onset(daily)), cfg).select(*ONSET_COLUMNS).distinct()
