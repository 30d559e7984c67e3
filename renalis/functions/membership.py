"""A filter of one row that says which keys cannot be in a set, to drop rows before they are shuffled."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BITS = 1 << 22  # half a megabyte at any size of the set; up to some million keys it drops most others


def _bit(place: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), place)


def membership(keys: DataFrame, column: str, bits: int = BITS) -> DataFrame:
    """One row `words`: an array of 64-bit words with a bit set for the hash of each key.

    Keys shrink to one row per word before they travel, and the words are as many at any number of
    keys. Null keys set no bit.
    """
    at = F.pmod(F.xxhash64(column), F.lit(bits))
    masks = (
        keys.filter(F.col(column).isNotNull())
        .select(F.floor(at / 64).alias("id"), _bit((at % 64).cast("int")).alias("bit"))
        .groupBy("id")
        .agg(F.bit_or("bit").alias("mask"))
    )
    every = keys.sparkSession.range(bits // 64).join(masks, "id", "left")
    filled = F.struct("id", F.coalesce("mask", F.lit(0).cast("long")).alias("mask"))
    return every.agg(F.array_sort(F.collect_list(filled)).alias("e")).select(
        F.col("e.mask").alias("words")
    )


@dataclass(frozen=True)
class Membership:
    """Reads the filter through a scalar subquery, in generated code, right behind a scan."""

    words: Column
    bits: int

    @classmethod
    def of(cls, stored: DataFrame, bits: int = BITS) -> Membership:
        return cls(stored.select("words").scalar(), bits)

    def may_have(self, column: str) -> Column:
        """False only for keys that are not in the set; false for null."""
        at = F.pmod(F.xxhash64(column), F.lit(self.bits))
        word = F.get(self.words, F.floor(at / 64).cast("int"))
        hit = F.call_function("getbit", word, (at % 64).cast("int")) == 1
        return F.col(column).isNotNull() & hit
