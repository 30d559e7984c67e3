"""Dates that occur in a table, for interval joins whose intervals may be open-ended.

An interval join becomes an equality by copying each interval to the days, or slots of days, in it. An
interval that a placeholder date keeps open would be copied to thousands of days that no record has,
so intervals are copied to days that occur only.

Which days occur is kept as an index of one row: the days in order, and for each slot of 32 days a mask
of its days and the number of days and of slots in use before it. The place of any date among the days
that occur is then one array access and one count of bits, whatever the length of the interval.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from renalis.functions.time import epoch_day

# Days of a slot: about the length of a window that starts at admission, a dozen to a year.
SLOT_DAYS = 32


def slot_of(day: Column) -> Column:
    return F.floor(epoch_day(day) / F.lit(SLOT_DAYS)).cast("int")


def day_index(rows: DataFrame, date_col: str) -> DataFrame:
    """One row that tells which days occur: first_slot, slots, days, used.

    `slots` holds every slot from the first to the last in use, as (mask, days_before, used_before);
    `days` the days, `used` the slots in use. Rows shrink to one per slot before they travel, so all of
    it is bounded by the calendar. No dates at all give a first_slot of null and empty arrays.
    """
    day = F.col(date_col).cast("date")
    bit = F.expr(f"shiftleft(1L, pmod(unix_date(cast(`{date_col}` as date)), {SLOT_DAYS}))")
    masks = (
        rows.filter(day.isNotNull())
        .select(slot_of(day).alias("slot"), bit.alias("bit"))
        .groupBy("slot")
        .agg(F.bit_or("bit").alias("mask"))
    )
    # A row for each slot in use, from here on: one window holds them all.
    order = Window.orderBy("slot")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    entries = masks.select(
        "slot",
        "mask",
        F.coalesce(F.sum(F.bit_count("mask")).over(before), F.lit(0)).cast("int").alias("days_before"),
        (F.row_number().over(order) - 1).alias("used_before"),
        (F.coalesce(F.lead("slot").over(order), F.col("slot") + 1) - F.col("slot") - 1).alias("gap"),
    )
    listed = entries.agg(F.array_sort(F.collect_list(F.struct(*entries.columns))).alias("e"))

    def spread(e: Column) -> Column:
        """The entry of a slot in use and those of the empty slots behind it."""
        own = F.struct(e["mask"].alias("mask"), e["days_before"].alias("days_before"),
                       e["used_before"].alias("used_before"))
        empty = F.struct(
            F.lit(0).cast("long").alias("mask"),
            (e["days_before"] + F.bit_count(e["mask"])).cast("int").alias("days_before"),
            (e["used_before"] + 1).alias("used_before"),
        )
        return F.concat(F.array(own), F.array_repeat(empty, e["gap"]))

    def days_of(e: Column) -> Column:
        places = F.filter(
            F.sequence(F.lit(0), F.lit(SLOT_DAYS - 1)),
            lambda i: F.call_function("getbit", e["mask"], i) == 1,
        )
        return F.transform(places, lambda i: F.date_from_unix_date(e["slot"] * SLOT_DAYS + i))

    return listed.select(
        F.get("e", F.lit(0))["slot"].alias("first_slot"),
        F.flatten(F.transform("e", spread)).alias("slots"),
        F.flatten(F.transform("e", days_of)).alias("days"),
        F.col("e.slot").alias("used"),
    )


@dataclass(frozen=True)
class DayIndex:
    """The days that occur, read by any number of expressions through one scalar subquery."""

    cell: Column

    @classmethod
    def of(cls, stored: DataFrame) -> DayIndex:
        """From the row that day_index() makes; where several queries read it, write it first."""
        return cls(stored.select(F.struct("*")).scalar())

    def _before(self, count: str, total: str, slot: Column, inside: Column | None = None) -> Column:
        """The count before a slot, and before a day of it by `inside`; 0 or all outside of the index."""
        at = slot - self.cell["first_slot"]
        entry = F.get(self.cell["slots"], F.greatest(at, F.lit(0)))
        found = entry[count] if inside is None else entry[count] + F.bit_count(
            entry["mask"].bitwiseAND(inside)
        )
        beyond = at >= F.size(self.cell["slots"])
        return F.when(beyond, F.size(self.cell[total])).when(at < 0, 0).otherwise(found)

    def _rank(self, day: Column) -> Column:
        """How many days that occur are earlier."""
        place = F.pmod(epoch_day(day), F.lit(SLOT_DAYS))
        earlier = F.call_function("shiftleft", F.lit(1).cast("long"), place) - 1
        return self._before("days_before", "days", slot_of(day), earlier)

    def days_within(self, first: Column, last: Column) -> Column:
        """The occurring days from first to last."""
        low, high = self._rank(first), self._rank(F.date_add(last, 1))
        return F.slice(self.cell["days"], low + 1, F.greatest(high - low, F.lit(0)))

    def slots_within(self, first: Column, last: Column) -> Column:
        """The slots with occurring days that the interval from first to last touches."""
        low = self._before("used_before", "used", slot_of(first))
        high = self._before("used_before", "used", slot_of(last) + 1)
        return F.slice(self.cell["used"], low + 1, F.greatest(high - low, F.lit(0)))
