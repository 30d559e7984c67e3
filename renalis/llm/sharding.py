"""Sharding through fixed virtual slots: DataFrame operations only.

Records hash into a fixed number of slots, far more than there are shards. A small table says which
shard holds which slot. Records never change their slot; rebalancing edits the table. Every edit is
stored as a new version next to the old ones, so that readers can follow what moved.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from renalis.session import Workspace, folder_exists

SLOTS = 8192
OVERHEAD = 16  # bytes a record takes besides its text


def records(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, size, text_crc32 and the virtual slot of each row; a null text counts as no bytes.

    The slot depends on the id and the text, so that rows without an id, or many rows with one id,
    spread over the slots as well.
    """
    text = F.col(text_col)
    size = F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + OVERHEAD
    crc = F.crc32(F.encode(F.coalesce(text, F.lit("")), "UTF-8"))
    return docs.select(
        F.col(id_col).alias("id"),
        size.alias("size"),
        crc.alias("text_crc32"),
        F.pmod(F.xxhash64(id_col, text_col), F.lit(SLOTS)).cast("int").alias("virtual_slot"),
    )


def slot_sizes(rows: DataFrame) -> DataFrame:
    """(virtual_slot, bytes, rows) of every slot, empty ones included."""
    held = rows.groupBy("virtual_slot").agg(F.sum("size").alias("b"), F.count("*").alias("n"))
    every = rows.sparkSession.range(SLOTS).select(F.col("id").cast("int").alias("virtual_slot"))
    return every.join(held, "virtual_slot", "left").select(
        "virtual_slot",
        F.coalesce("b", F.lit(0)).alias("bytes"),
        F.coalesce("n", F.lit(0)).alias("rows"),
    )


def initial_map(spark: SparkSession, shards: int) -> DataFrame:
    """Version 1: slots dealt out in turn."""
    return spark.range(SLOTS).select(
        F.col("id").cast("int").alias("virtual_slot"), (F.col("id") % shards).cast("int").alias("shard")
    )


def rebalance(slot_map: DataFrame, sizes: DataFrame, shards: int) -> DataFrame:
    """The next version of the map, its shards near equal in bytes.

    Each shard keeps its slots, largest first, as far as they fit into the mean; the rest of the
    slots, the small ones, go one by one, largest first, to the shard that then has the least. A slot
    of a shard number that no longer exists is moved too. Both tables have SLOTS rows at any size of
    the data, so one group holds them all.
    """
    held = slot_map.join(F.broadcast(sizes), "virtual_slot")
    largest_first = [F.desc("bytes"), F.col("virtual_slot")]
    running = F.sum("bytes").over(
        W.partitionBy("shard").orderBy(*largest_first).rowsBetween(W.unboundedPreceding, 0)
    )
    mean = F.sum("bytes").over(W.partitionBy()) / F.lit(shards)
    stays = (F.col("shard") < shards) & (running <= mean)
    held = held.select("virtual_slot", "shard", "bytes", stays.alias("stays"))

    kept = F.when(F.col("stays"), F.struct("shard", "bytes"))
    loose = F.when(~F.col("stays"), F.struct((-F.col("bytes")).alias("b"), "virtual_slot"))
    state = held.agg(
        F.collect_list(kept).alias("kept"), F.array_sort(F.collect_list(loose)).alias("loose")
    ).select(
        "loose",
        F.aggregate(
            "kept",
            F.array_repeat(F.lit(0).cast("long"), shards),
            lambda load, x: F.transform(
                load, lambda b, i: b + F.when(i == x["shard"], x["bytes"]).otherwise(0)
            ),
        ).alias("load"),
    )

    def place(acc: F.Column, slot: F.Column) -> F.Column:
        load = F.transform(
            acc["load"], lambda b, i: b - F.when(i == acc["least"], slot["b"]).otherwise(0)
        )
        return F.struct(
            load.alias("load"),
            F.concat(acc["to"], F.array(acc["least"])).alias("to"),
            (F.array_position(load, F.array_min(load)) - 1).cast("int").alias("least"),
        )

    start = F.struct(
        F.col("load"),
        F.array().cast("array<int>").alias("to"),
        (F.array_position("load", F.array_min("load")) - 1).cast("int").alias("least"),
    )
    moved = state.select(
        "loose", F.aggregate("loose", start, place, lambda acc: acc["to"]).alias("to")
    ).select(F.inline(F.arrays_zip(F.col("loose.virtual_slot").alias("virtual_slot"), "to")))
    moved = moved.select(F.col("virtual_slot"), F.col("to").alias("shard"))
    return held.filter("stays").select("virtual_slot", "shard").unionByName(moved)


class SlotMaps:
    """Versions of the slot-to-shard map, each written once: one row per slot.

    A folder that holds versions is opened at the latest one that was written to its end. One writer
    at a time.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path, self.latest = spark, path, 0
        while folder_exists(spark, f"{path}/version={self.latest + 1}/_SUCCESS"):
            self.latest += 1

    def store(self, slot_map: DataFrame) -> DataFrame:
        target = f"{self.path}/version={self.latest + 1}"
        slot_map.repartition(1).write.mode("overwrite").parquet(target)  # of a write that broke off
        self.latest += 1
        return self.read()

    def read(self, version: int | None = None) -> DataFrame:
        path = f"{self.path}/version={version or self.latest}"
        return self.spark.read.schema("virtual_slot int, shard int").parquet(path)


def assign(
    docs: DataFrame,
    shards: int,
    work: Workspace,
    id_col: str = "doc_id",
    text_col: str = "text",
    maps: SlotMaps | None = None,
) -> DataFrame:
    """id, size, text_crc32, law, shard, slot, grown_shard, virtual_slot for every row.

    With maps that hold a version already, that is edited, so that what is placed stays where it is
    as far as the law allows, whatever was added since and however many shards there are now; else
    the slots are dealt out first. The map that holds for the result is the latest version.

    The law is `bytes`: sizes of the shards near equal, as far as whole virtual slots allow. `slot` is
    the row's place in its shard, gapless from 0: virtual slots follow each other in a shard, and
    rows are ordered by id inside a virtual slot, so that no sort holds more than a slot. Null texts
    and ids are rows like others; repeated rows share a virtual slot and take places after each
    other. An empty table gives no rows. Other columns are not read.
    """
    spark = docs.sparkSession
    rows = records(docs, id_col, text_col)
    sizes = work.cut(slot_sizes(rows).repartition(1), "slot_sizes")
    maps = maps or SlotMaps(spark, work.folder("slot_map"))
    held = maps.read() if maps.latest else maps.store(initial_map(spark, shards))
    maps.store(rebalance(held, sizes, shards))

    # Where each virtual slot begins in its shard; SLOTS rows, whatever the data.
    before = W.partitionBy("shard").orderBy("virtual_slot").rowsBetween(W.unboundedPreceding, -1)
    plan = maps.read().join(F.broadcast(sizes), "virtual_slot").select(
        "virtual_slot", "shard", F.coalesce(F.sum("rows").over(before), F.lit(0)).alias("begin")
    )
    inside = W.partitionBy("virtual_slot").orderBy("id", "size", "text_crc32")
    return (
        rows.withColumn("place", F.row_number().over(inside) - 1)
        .join(F.broadcast(plan), "virtual_slot")
        .select(
            F.col("id").alias(id_col),
            "size",
            "text_crc32",
            F.lit("bytes").alias("law"),
            "shard",
            (F.col("begin") + F.col("place")).cast("long").alias("slot"),
            F.lit(None).cast("int").alias("grown_shard"),
            "virtual_slot",
        )
    )
