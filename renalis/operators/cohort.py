"""Initial cohort, creatinine history, matching of labs to stays, baseline, eligibility."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from renalis.config import CohortConfig
from renalis.functions.clinical import age_years, egfr, mean_scr
from renalis.functions.codes import SCR_LOINC
from renalis.functions.membership import Membership
from renalis.functions.time import combine_date_time
from renalis.operators.calendar import DayIndex, day_index, slot_of

LAB_TIMES = ["LAB_ORDER_DATE", "SPECIMEN_DATE", "SPECIMEN_TIME", "RESULT_DATE", "RESULT_TIME"]
STAY = ["PATID", "ENCOUNTERID", "ADMIT_DATE_TIME", "DISCHARGE_DATE_TIME"]
SCR = ["SERUM_CREAT", "EGFR", "LAB_ORDER_DATE", "SPECIMEN_DATE_TIME", "RESULT_DATE_TIME"]


TRAITS = ["BIRTH_DATE", "SEX", "RACE"]


def initial_cohort(
    encounter: DataFrame, demographic: DataFrame, cfg: CohortConfig, traits: bool = False
) -> DataFrame:
    """Adult inpatient stays of the window; of stays with one discharge date, the first admitted.

    ``traits`` keeps the patient's birth date, sex and race for the eGFR.
    """
    stays = encounter.filter(
        F.col("ENC_TYPE").isin(*cfg.enc_types)
        & F.col("ADMIT_DATE").between(F.lit(cfg.window_start), F.lit(cfg.window_end))
        & (F.datediff("DISCHARGE_DATE", "ADMIT_DATE") >= cfg.min_stay_days)
    )
    kept = TRAITS if traits else []
    stays = stays.join(demographic.select("PATID", *(kept or ["BIRTH_DATE"])), "PATID")
    if cfg.dedupe_discharge:
        # rank = 1 on row_number lets Spark keep one row per group before the shuffle.
        first = Window.partitionBy("PATID", "DISCHARGE_DATE").orderBy(
            F.col("ADMIT_DATE").asc_nulls_last(),
            F.col("ADMIT_TIME").asc_nulls_last(),
            F.col("ENCOUNTERID").asc(),
        )
        stays = stays.withColumn("rn", F.row_number().over(first)).filter(F.col("rn") == 1)
    return stays.select(
        "ENCOUNTERID",
        "PATID",
        age_years(F.col("ADMIT_DATE"), F.col("BIRTH_DATE"), cfg.age_mode).alias("age_at_admit"),
        combine_date_time(F.col("ADMIT_DATE"), F.col("ADMIT_TIME"), cfg.missing_time).alias(
            "ADMIT_DATE_TIME"
        ),
        combine_date_time(F.col("DISCHARGE_DATE"), F.col("DISCHARGE_TIME"), cfg.missing_time).alias(
            "DISCHARGE_DATE_TIME"
        ),
        F.datediff("DISCHARGE_DATE", "ADMIT_DATE").alias("los"),
        *cfg.extra_encounter_cols,
        *kept,
    ).filter(F.col("age_at_admit") >= cfg.min_age)


def is_serum_creatinine(cfg: CohortConfig) -> Column:
    """Predicate over LAB_RESULT_CM; a missing unit or specimen source does not pass."""
    return (
        F.col("LAB_LOINC").isin(*SCR_LOINC)
        & F.upper("RESULT_UNIT").isin(*cfg.scr_units)
        & (F.col("SPECIMEN_SOURCE") != "URINE")
        & (F.col("RESULT_NUM") > 0)
    )


def serum_creatinine_filter(lab: DataFrame, cfg: CohortConfig) -> DataFrame:
    return lab.filter(is_serum_creatinine(cfg))


def scr_mean(lab: DataFrame, cohort: DataFrame, cfg: CohortConfig) -> DataFrame:
    """Mean creatinine of cohort patients per lab encounter, order, specimen and result time."""
    return (
        serum_creatinine_filter(lab, cfg)
        .join(cohort.select("PATID"), "PATID", "left_semi")
        .groupBy("PATID", "ENCOUNTERID", *LAB_TIMES)
        .agg(mean_scr(F.col("RESULT_NUM")).alias("RESULT_NUM"))
    )


def cohort_patients(demographic: DataFrame, cohort: DataFrame) -> DataFrame:
    """The traits of the cohort's patients."""
    return demographic.select("PATID", *TRAITS).join(
        cohort.select("PATID"), "PATID", "left_semi"
    )


def all_scr_egfr(
    lab: DataFrame,
    patients: DataFrame,
    cfg: CohortConfig,
    since: date | None = None,
    likely: Membership | None = None,
) -> DataFrame:
    """All adult creatinine values of the cohort's patients with their eGFR.

    Lab rows are averaged first, keyed by patient and time, which map-side combine shrinks and which
    spreads a patient with very many of them. The traits then come to the means. ``since`` drops
    earlier orders at the scan, and ``likely`` most rows of other patients.
    """
    scr = serum_creatinine_filter(lab, cfg)
    if likely is not None:
        scr = scr.filter(likely.may_have("PATID"))
    if since is not None:
        scr = scr.filter(F.col("LAB_ORDER_DATE") >= F.lit(since))
    owner = ["ENCOUNTERID"] if cfg.keep_lab_encounter else []
    means = (
        scr.groupBy("PATID", "ENCOUNTERID", *LAB_TIMES)
        .agg(mean_scr(F.col("RESULT_NUM")).alias("SERUM_CREAT"))
        .join(patients, "PATID")
    )
    return _with_egfr(means, ["PATID", *owner], cfg).distinct()


def _with_egfr(means: DataFrame, keys: list[str], cfg: CohortConfig) -> DataFrame:
    """Adult values with eGFR and combined times; means holds the patients' traits."""
    age = age_years(F.col("LAB_ORDER_DATE"), F.col("BIRTH_DATE"), cfg.age_mode)
    taken = combine_date_time(F.col("SPECIMEN_DATE"), F.col("SPECIMEN_TIME"), cfg.missing_time)
    known = combine_date_time(F.col("RESULT_DATE"), F.col("RESULT_TIME"), cfg.missing_time)
    rate = egfr(
        F.col("SERUM_CREAT"), F.col("AGE_AT_SCR"), F.col("SEX"), F.col("RACE"), cfg.egfr_round
    )
    return (
        means.withColumn("AGE_AT_SCR", age)
        .filter(F.col("AGE_AT_SCR") >= cfg.min_age)
        .select(
            *keys,
            "SERUM_CREAT",
            rate.alias("EGFR"),
            "LAB_ORDER_DATE",
            taken.alias("SPECIMEN_DATE_TIME"),
            known.alias("RESULT_DATE_TIME"),
        )
    )


def stay_slots(
    cohort: DataFrame, index: DayIndex, keep: list[str] | None = None, days_before: int = 0
) -> DataFrame:
    """One row per stay and occurring slot of days that the stay, or the days before it, touch.

    first_day and last_day are the days whose midnight lies between admission and discharge.
    """
    admit, discharge = F.col("ADMIT_DATE_TIME"), F.col("DISCHARGE_DATE_TIME")
    admit_day = F.to_date(admit)
    first = F.when(admit_day.cast("timestamp_ntz") == admit, admit_day).otherwise(
        F.date_add(admit_day, 1)
    )
    slots = index.slots_within(F.date_sub("first_day", days_before), F.col("last_day"))
    return (
        cohort.select(
            *STAY, *(keep or []), first.alias("first_day"), F.to_date(discharge).alias("last_day")
        )
        .filter(F.col("first_day") <= F.col("last_day"))
        .withColumn("slot", F.explode(slots))
    )


def join_labs_to_stays(
    scr: DataFrame,
    cohort: DataFrame,
    index: DayIndex | None = None,
    keep: list[str] | None = None,
    days_before: int = 0,
) -> DataFrame:
    """Each lab row (lab.*) next to the stays of its patient (stay.*) that contain its order date.

    The stays, the small side, are copied to the slots of days they touch and in which labs were
    ordered; a lab has one slot. Joining on (PATID, slot) spreads a hot patient over the calendar and
    compares no rows further apart than a slot. Stays of any length take this way: a slot holds many
    days, so a long stay costs few copies. The index may hold more days than the labs given; without
    one, it is made of these. ``days_before`` adds the labs of so many days before the stay.
    """
    index = index or DayIndex.of(day_index(scr, "LAB_ORDER_DATE"))
    stays = stay_slots(cohort, index, keep, days_before)
    labs = scr.withColumn("slot", slot_of(F.col("LAB_ORDER_DATE")))
    first = F.date_sub("stay.first_day", days_before)
    matches = (
        (F.col("lab.PATID") == F.col("stay.PATID"))
        & (F.col("lab.slot") == F.col("stay.slot"))
        & F.col("lab.LAB_ORDER_DATE").between(first, F.col("stay.last_day"))
    )
    return labs.alias("lab").join(stays.alias("stay"), matches)


def match_labs_to_encounter(
    scr: DataFrame, cohort: DataFrame, cfg: CohortConfig, index: DayIndex | None = None
) -> DataFrame:
    """Pair each creatinine value with the stays that contain its order date, by preset rule."""
    owner = F.col("lab.ENCOUNTERID")
    columns = [f"stay.{c}" for c in STAY if c != "PATID"] + [f"lab.{c}" for c in SCR]

    joined = join_labs_to_stays(scr, cohort, index)
    if cfg.lab_match == "union_all":
        joined = joined.filter(owner != F.col("stay.ENCOUNTERID"))
    matched = joined.select("lab.PATID", *columns)
    if cfg.lab_match == "patient":
        return matched
    inside = F.col("LAB_ORDER_DATE").between(F.col("ADMIT_DATE_TIME"), F.col("DISCHARGE_DATE_TIME"))
    by_encounter = (
        scr.alias("lab")
        .join(cohort.alias("stay"), (owner == F.col("stay.ENCOUNTERID")) & inside)
        .select("lab.PATID", *columns)
    )
    return matched.unionByName(by_encounter).distinct()


def scr_in_stays(
    lab: DataFrame,
    cohort: DataFrame,
    cfg: CohortConfig,
    index: DayIndex | None = None,
    patients: Membership | None = None,
) -> DataFrame:
    """All three steps at once for presets that match by patient: filter, match, mean.

    Values of one order date share their stays, so matching before averaging changes nothing, and
    the lab rows cross the network once, by (PATID, slot): the mean and the distinct reuse that.
    ``cohort`` holds the patients' traits; ``patients`` drops most rows of others at the scan.
    """
    scr = _scr_since(lab, cfg, patients)
    return _matched_means(join_labs_to_stays(scr, cohort, index, TRAITS), [], cfg)


def _scr_since(
    lab: DataFrame, cfg: CohortConfig, patients: Membership | None, days_before: int = 0
) -> DataFrame:
    """Creatinine rows ordered in the window or so many days before it."""
    since = cfg.window_start - timedelta(days=days_before)
    scr = serum_creatinine_filter(lab, cfg).filter(F.col("LAB_ORDER_DATE") >= F.lit(since))
    return scr if patients is None else scr.filter(patients.may_have("PATID"))


def _matched_means(joined: DataFrame, marks: list[Column], cfg: CohortConfig) -> DataFrame:
    """Means with eGFR of labs next to stays; marks follow from the stay, the owner and the order."""
    matched = joined.select(
        # Both partitioning columns come from the lab side: their pairing stays visible.
        "lab.PATID",
        *[f"stay.{c}" for c in STAY if c != "PATID"],
        F.col("lab.ENCOUNTERID").alias("LAB_ENCOUNTERID"),
        *[f"lab.{c}" for c in LAB_TIMES],
        "lab.slot",
        *TRAITS,
        *marks,
        "RESULT_NUM",
    )
    # The slot follows from the order date: it splits no group and keeps the partitioning.
    keys = [c for c in matched.columns if c != "RESULT_NUM"]
    means = matched.groupBy(*keys).agg(mean_scr(F.col("RESULT_NUM")).alias("SERUM_CREAT"))
    marked = [c for c in keys if c not in {*STAY, "LAB_ENCOUNTERID", *LAB_TIMES, "slot", *TRAITS}]
    return _with_egfr(means, [*STAY, "slot", *marked], cfg).distinct().drop("slot")


def contested_stays(
    lab: DataFrame, cohort: DataFrame, cfg: CohortConfig, patients: Membership | None = None
) -> DataFrame:
    """The stays that some creatinine row of another patient names as its own.

    Rows shrink to the first and the last patient of an encounter before they travel.
    """
    owner = F.col("ENCOUNTERID").isNotNull()
    claims = (
        _scr_since(lab, cfg, patients)
        .filter(owner)
        .groupBy("ENCOUNTERID")
        .agg(F.min("PATID").alias("low"), F.max("PATID").alias("high"))
    )
    return (
        cohort.select(*STAY)
        .join(claims, "ENCOUNTERID")
        .filter((F.col("low") != F.col("PATID")) | (F.col("high") != F.col("PATID")))
        .select(*STAY)
        .distinct()
    )


def guest_stays(
    lab: DataFrame,
    contested: DataFrame,
    cohort: DataFrame,
    cfg: CohortConfig,
    patients: Membership | None = None,
) -> DataFrame:
    """Contested stays once for each other patient of the cohort whose rows name them, with his traits."""
    labs = _scr_since(lab, cfg, patients).select("ENCOUNTERID", "PATID")
    stays = contested.withColumnRenamed("PATID", "OWNER")
    traits = cohort.select("PATID", *TRAITS).distinct()
    return (
        labs.join(stays, "ENCOUNTERID")
        .filter(F.col("PATID") != F.col("OWNER"))
        .select(*STAY)
        .distinct()
        .join(traits, "PATID")
        .select(*STAY, *TRAITS)
    )


def scr_by_stay(
    lab: DataFrame,
    cohort: DataFrame,
    guests: DataFrame | None,
    cfg: CohortConfig,
    index: DayIndex | None = None,
    patients: Membership | None = None,
) -> DataFrame:
    """scr_in_stays() for the presets that match by encounter too, with the mark in_stay.

    Rows of a patient's own stays are found by patient, whatever encounter they name; a row that names
    the stay of another patient meets it among the ``guests``. So the lab rows cross the network once
    for both ways. Not in_stay are rows next to a stay that do not match it: those of the day before,
    where the preset's baseline asks for them.
    """
    days_before = 1 if cfg.baseline_mode == "prior_2d" else 0
    stays = cohort.select(*STAY, *TRAITS, F.lit(False).alias("guest"))
    if guests is not None:
        stays = stays.unionByName(guests.withColumn("guest", F.lit(True)))
    scr = _scr_since(lab, cfg, patients, days_before)
    joined = join_labs_to_stays(scr, stays, index, [*TRAITS, "guest"], days_before)

    owner = F.col("lab.ENCOUNTERID")
    matches = ~F.col("guest") | F.coalesce(owner == F.col("stay.ENCOUNTERID"), F.lit(False))
    if cfg.lab_match == "union_all":
        # By patient for the rows of other encounters, by encounter for its own: a row needs one.
        matches = matches & owner.isNotNull()
    in_stay = matches & (F.col("lab.LAB_ORDER_DATE") >= F.col("stay.first_day"))
    if not days_before:
        joined = joined.filter(in_stay)
    return _matched_means(joined, [in_stay.alias("in_stay")], cfg)


def enough_scr(matched: DataFrame, cfg: CohortConfig) -> DataFrame:
    """ENCOUNTERID of stays with at least two creatinine values, by the preset's rule.

    Counting distinct times only matters up to two, so min and max decide, with map-side combine.
    """
    order, taken = F.col("LAB_ORDER_DATE"), F.col("SPECIMEN_DATE_TIME")
    several_times = F.coalesce(F.min(taken) < F.max(taken), F.lit(False))
    if cfg.min_scr_rule == "distinct_times":
        several = several_times
    else:
        some_missing = (F.count(taken) > 0) & (F.count(taken) < F.count("*"))
        several = several_times | some_missing | (F.min(order) < F.max(order))
    return (
        matched.groupBy("ENCOUNTERID")
        .agg(several.alias("several"))
        .filter("several")
        .select("ENCOUNTERID")
    )


def require_two_scr(matched: DataFrame, cfg: CohortConfig) -> DataFrame:
    """Rows of stays with two values; with the 'exclusion' rule the stays are dropped later."""
    if cfg.min_scr_rule == "exclusion":
        return matched
    return matched.join(enough_scr(matched, cfg), "ENCOUNTERID", "left_semi")


def _scr_order(cfg: CohortConfig) -> list[Column]:
    taken = F.col("SPECIMEN_DATE_TIME")
    return [
        F.col("LAB_ORDER_DATE").asc(),
        taken.asc_nulls_last() if cfg.scr_nulls_last else taken.asc_nulls_first(),
    ]


def rank_scr(matched: DataFrame, cfg: CohortConfig) -> DataFrame:
    """Dense rank of the (order date, specimen time) pairs of each stay, as rn.

    The rank is taken over the distinct pairs, which map-side combine has already reduced to at most
    one per minute and order date, and joined back, so a stay with many rows is not sorted whole.
    """
    key = ["ENCOUNTERID", "LAB_ORDER_DATE", "SPECIMEN_DATE_TIME"]
    window = Window.partitionBy("ENCOUNTERID").orderBy(*_scr_order(cfg))
    ranks = matched.select(*key).distinct().withColumn("rn", F.dense_rank().over(window))
    same = [F.col(f"row.{c}").eqNullSafe(F.col(f"rank.{c}")) for c in key]
    return matched.alias("row").join(ranks.alias("rank"), same).select("row.*", "rank.rn")


def aki_scr_egfr(matched: DataFrame, cfg: CohortConfig) -> DataFrame:
    """Creatinine rows of the stays that qualify, with their rank in the stay."""
    return rank_scr(require_two_scr(matched, cfg), cfg)


def first_scr(matched: DataFrame, cfg: CohortConfig) -> DataFrame:
    """The rn = 1 rows of the qualifying stays, ties included.

    The rank filter becomes a group limit ahead of the shuffle: only first rows travel.
    """
    window = Window.partitionBy("ENCOUNTERID").orderBy(*_scr_order(cfg))
    first = matched.withColumn("rn", F.dense_rank().over(window)).filter(F.col("rn") == 1)
    if cfg.min_scr_rule == "exclusion":
        return first
    return first.join(enough_scr(matched, cfg), "ENCOUNTERID", "left_semi")


def baseline_first(first: DataFrame) -> DataFrame:
    """Baseline of a stay: the first creatinine in it (lowest value, highest eGFR of the time).

    FIRST_TIME and FIRST_EGFR, the lowest, describe the first creatinine for the exclusion rules.
    """
    return (
        first.groupBy(*STAY, "LAB_ORDER_DATE", "SPECIMEN_DATE_TIME", "RESULT_DATE_TIME")
        .agg(
            F.min("SERUM_CREAT").alias("SERUM_CREAT"),
            F.max("EGFR").alias("EGFR"),
            F.min("EGFR").alias("FIRST_EGFR"),
        )
        .withColumn("FIRST_TIME", F.col("SPECIMEN_DATE_TIME"))
    )


def baseline_prior_2d(first: DataFrame, all_scr: DataFrame) -> DataFrame:
    """Baseline from the day before the stay's first creatinine order, if the patient has one.

    Order dates carry no time, so "earlier, by less than two days" is the previous calendar day: an
    equi-join on (PATID, day) against values already reduced per specimen.
    """
    values = ["LAB_ORDER_DATE", "SPECIMEN_DATE_TIME", "RESULT_DATE_TIME"]
    prior = (
        all_scr.groupBy("PATID", *values)
        .agg(F.max("SERUM_CREAT").alias("SERUM_CREAT"), F.min("EGFR").alias("EGFR"))
        .withColumn("next_day", F.date_add("LAB_ORDER_DATE", 1))
    )
    matched = first.alias("own").join(
        prior.alias("prior"),
        (F.col("own.PATID") == F.col("prior.PATID"))
        & (F.col("own.LAB_ORDER_DATE") == F.col("prior.next_day")),
        "left",
    )
    chosen = [
        F.coalesce(F.col(f"prior.{c}"), F.col(f"own.{c}")).alias(c)
        for c in ["SERUM_CREAT", "EGFR", *values]
    ]
    return (
        matched.select(
            *[f"own.{c}" for c in STAY],
            *chosen,
            F.datediff("own.LAB_ORDER_DATE", "prior.LAB_ORDER_DATE").alias("days_prior"),
            F.col("own.SPECIMEN_DATE_TIME").alias("FIRST_TIME"),
            F.col("own.EGFR").alias("FIRST_EGFR"),
            F.col("own.LAB_ORDER_DATE").alias("first_order"),
        )
        # The first order follows from the chosen one and days_prior: it keeps the partitioning.
        .groupBy(*STAY, *values, "days_prior", "FIRST_TIME", "first_order")
        .agg(
            F.max("SERUM_CREAT").alias("SERUM_CREAT"),
            F.min("EGFR").alias("EGFR"),
            F.min("FIRST_EGFR").alias("FIRST_EGFR"),
        )
        .drop("first_order")
    )


def eligible_start(cohort: DataFrame, scr: DataFrame) -> DataFrame:
    """Stays of the cohort that still have creatinine rows."""
    return cohort.join(scr.select("ENCOUNTERID"), "ENCOUNTERID", "left_semi")


def eligible_baseline(baseline: DataFrame, exclusions: DataFrame) -> DataFrame:
    """Baselines of the stays that no rule excludes."""
    return baseline.join(exclusions.select("ENCOUNTERID"), "ENCOUNTERID", "left_anti")


def eligible(scr: DataFrame, base: DataFrame, cfg: CohortConfig | None = None) -> DataFrame:
    """Creatinine rows of the eligible stays next to the stay's baseline.

    ``base`` holds the baselines of eligible stays only, so no anti-join touches the lab rows. With
    ``cfg``, rows have their rank rn in the stay, which has all its rows here: only eligible ones are
    ranked.
    """
    base = base.select(
        "ENCOUNTERID",
        "ADMIT_DATE_TIME",
        "DISCHARGE_DATE_TIME",
        F.col("SERUM_CREAT").alias("SERUM_CREAT_BASE"),
        F.col("SPECIMEN_DATE_TIME").alias("SPECIMEN_DATE_TIME_BASE"),
        F.col("RESULT_DATE_TIME").alias("RESULT_DATE_TIME_BASE"),
    )
    own = ["PATID", "ENCOUNTERID", "SERUM_CREAT", "EGFR", "SPECIMEN_DATE_TIME", "RESULT_DATE_TIME"]
    if cfg is None:
        rank = ["rn"] if "rn" in scr.columns else []
        return scr.select(*own, *rank).join(base, "ENCOUNTERID")
    rows = scr.select(*own, "LAB_ORDER_DATE").join(base, "ENCOUNTERID")
    return rank_scr(rows, cfg).drop("LAB_ORDER_DATE")
