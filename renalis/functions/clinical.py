"""Age, kidney function and creatinine ratio as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SCR_DIGITS = 6
EGFR_DIGITS = 4
# The product of rounded terms has at most ten decimals; rounding there never meets a tie.
EGFR_DIGITS_ROUNDED_TERMS = 10


def age_years(at: Column, birth: Column, mode: str) -> Column:
    """rounded: days / 365.25; calendar: difference of year numbers; complete: birthdays passed."""
    if mode == "rounded":
        return F.round(F.datediff(at, birth) / F.lit(365.25)).cast("int")
    if mode == "calendar":
        return F.year(at) - F.year(birth)

    def number(day: Column) -> Column:
        return F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)

    return F.floor((number(at) - number(birth)) / F.lit(10000)).cast("int")


def mean_scr(value: Column) -> Column:
    """Mean, rounded so that the order in which tasks add the values cannot show."""
    return F.round(F.avg(value), SCR_DIGITS)


def egfr(scr: Column, age: Column, sex: Column, race: Column, round_terms: bool = False) -> Column:
    """MDRD estimate of the glomerular filtration rate."""
    scr_term = F.pow(scr, F.lit(-1.154))
    age_term = F.pow(age.cast("double"), F.lit(-0.203))
    if round_terms:
        scr_term = F.round(scr_term, 2)
        # The age term passes through a three-digit decimal before it is rounded.
        age_term = F.round(F.round(age_term, 3), 2)
    sex_term = F.when(sex == "F", F.lit(0.742)).otherwise(F.lit(1.0))
    race_term = F.when(race == "03", F.lit(1.212)).otherwise(F.lit(1.0))
    digits = EGFR_DIGITS_ROUNDED_TERMS if round_terms else EGFR_DIGITS
    return F.round(F.lit(175.0) * scr_term * age_term * sex_term * race_term, digits)


def _units(scr: Column) -> Column:
    return F.round(scr * 10**SCR_DIGITS).cast("long")


def scr_ratio(scr: Column, base: Column) -> Column:
    """Creatinine over its baseline, to one digit, half up.

    Computed on whole millionths, so that a true 1.45 becomes 1.5 as in decimal arithmetic.
    """
    tenths = F.floor((_units(scr) * 20 + _units(base)) / (_units(base) * 2))
    return tenths / F.lit(10.0)


def ratio_to_stage(ratio: Column) -> Column:
    return (
        F.when(ratio >= 3.0, 3).when(ratio >= 2.0, 2).when(ratio >= 1.5, 1).otherwise(0).cast("int")
    )
