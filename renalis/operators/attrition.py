"""Attrition counts of the two eras, before and after the split date."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from renalis.config import CohortConfig

BEFORE, AFTER = "BC", "AD"


def _era(cfg: CohortConfig) -> Column:
    """By admission time against midnight of the split date, unlike the onset table's day rule."""
    split = F.lit(cfg.split_date).cast("timestamp_ntz")
    admit = F.col("ADMIT_DATE_TIME")
    return F.when(admit <= split, BEFORE).when(admit > split, AFTER)


def _in_era(era: str, cfg: CohortConfig) -> Column:
    return _era(cfg) == era


def _count(stays: DataFrame, label: str) -> DataFrame:
    return stays.agg(F.countDistinct("ENCOUNTERID").alias("ENC_CNT")).select(
        F.lit(label).alias("CNT_TYPE"), "ENC_CNT"
    )


def attrition_initial(cohort: DataFrame, era: str, cfg: CohortConfig) -> DataFrame:
    return _count(cohort.filter(_in_era(era, cfg)), "Initial")


def attrition_scr(init: DataFrame, era: str, cfg: CohortConfig) -> DataFrame:
    """Stays with the creatinine rows the preset asks for."""
    return _count(init.filter(_in_era(era, cfg)), cfg.scr_label)


def attrition_exclusions(exclusions: DataFrame, era: str, cfg: CohortConfig) -> DataFrame:
    """Stays per exclusion rule; a rule without hits gives no row."""
    return (
        exclusions.filter(_in_era(era, cfg))
        .groupBy(F.col("EXCLUD_TYPE").alias("CNT_TYPE"))
        .agg(F.countDistinct("ENCOUNTERID").alias("ENC_CNT"))
    )


def _courses() -> dict[str, Column]:
    """Courses of the injury. They overlap by definition."""
    one, two, three = (F.col(f"AKI{s}_ONSET").isNotNull() for s in (1, 2, 3))
    return {
        "Total": F.lit(True),
        "nonAKI": ~one & ~two & ~three,
        "AKI1": one,
        "nonAKI_to_AKI2": ~one & two,
        "AKI1_to_AKI2": one & two,
        "nonAKI_to_AKI3": ~one & ~two & three,
        "nonAKI_to_AKI2_to_AKI3": ~one & two & three,
        "AKI1_to_AKI2_to_AKI3": one & two & three,
    }


def attrition_outcomes(onsets: DataFrame, era: str) -> DataFrame:
    """Course of the injury, all counts in one pass."""
    groups = _courses()
    # The conditions depend on the stay alone, so reducing to one row per stay turns eight distinct
    # counts into sums.
    stays = (
        onsets.filter(F.col("BCCOVID") == (1 if era == BEFORE else 0))
        .groupBy("ENCOUNTERID")
        .agg(*[F.max(cond.cast("int")).alias(name) for name, cond in groups.items()])
    )
    counted = stays.agg(
        *[F.coalesce(F.sum(name), F.lit(0)).cast("long").alias(name) for name in groups]
    )
    pairs = [F.struct(F.lit(n).alias("CNT_TYPE"), F.col(n).alias("ENC_CNT")) for n in groups]
    return counted.select(F.inline(F.array(*pairs)))


def marks(
    cohort: DataFrame,
    init: DataFrame,
    exclusions: DataFrame,
    onsets: DataFrame,
    cfg: CohortConfig,
) -> DataFrame:
    """(ERA, CNT_TYPE, ENCOUNTERID): what each stay counts for, in either era.

    Counts that are listed even if they are zero have a row without a stay. Marks of parts of the
    cohort can be put together: a stay counts once.
    """
    era = _era(cfg).alias("ERA")
    course = F.when(F.col("BCCOVID") == 1, BEFORE).when(F.col("BCCOVID") == 0, AFTER)
    courses = _courses()
    taken = F.filter(
        F.array(*[F.when(cond, name) for name, cond in courses.items()]), lambda x: x.isNotNull()
    )
    listed = ["Initial", cfg.scr_label, *courses]
    none = cohort.sparkSession.range(1).select(
        F.explode(F.array(F.lit(BEFORE), F.lit(AFTER))).alias("ERA"),
        F.array(*map(F.lit, listed)).alias("types"),
    )
    return (
        cohort.select(era, F.lit("Initial").alias("CNT_TYPE"), "ENCOUNTERID")
        .unionByName(init.select(era, F.lit(cfg.scr_label).alias("CNT_TYPE"), "ENCOUNTERID"))
        .unionByName(exclusions.select(era, F.col("EXCLUD_TYPE").alias("CNT_TYPE"), "ENCOUNTERID"))
        .unionByName(
            onsets.select(course.alias("ERA"), F.explode(taken).alias("CNT_TYPE"), "ENCOUNTERID")
        )
        .unionByName(
            none.select("ERA", F.explode("types").alias("CNT_TYPE"))
            .withColumn("ENCOUNTERID", F.lit(None).cast("string"))
        )
        .filter("ERA is not null")
    )


def consort(marks: DataFrame) -> DataFrame:
    """(ERA, CNT_TYPE, ENC_CNT) of both eras, by one aggregate over the marks."""
    return marks.groupBy("ERA", "CNT_TYPE").agg(F.countDistinct("ENCOUNTERID").alias("ENC_CNT"))


def of_era(counts: DataFrame, era: str) -> DataFrame:
    """(CNT_TYPE, ENC_CNT) of one era."""
    return counts.filter(F.col("ERA") == era).select("CNT_TYPE", "ENC_CNT")
