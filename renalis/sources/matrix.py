"""Model matrices: Parquet, partitioned by the keys of a training setting."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

KEYS = ["site", "year", "stg", "fs", "oversample"]
SPLITS = ("train", "test")


def save_matrix(df: DataFrame, root: str, split: str) -> None:
    """Write the train or test rows of any number of settings; df holds the five key columns."""
    # One shuffle by setting, so that a setting's rows end in few files; AQE splits large ones.
    (
        df.hint("rebalance", *[F.col(k) for k in KEYS])
        .write.mode("overwrite")
        .partitionBy(*KEYS)
        .parquet(f"{root}/{split}")
    )


def load_matrix(
    spark: SparkSession, root: str, site: str, year: int, stg: str, fs: str, oversample: str
) -> tuple[DataFrame, DataFrame]:
    """Train and test rows of one setting; other settings' partitions are pruned."""
    setting = dict(zip(KEYS, (site, year, stg, fs, oversample)))
    frames = []
    for split in SPLITS:
        found = spark.read.parquet(f"{root}/{split}").schema
        # Keys are text: a site named 01 must not be read as the number 1.
        typed = [T.StructField(f.name, T.StringType()) if f.name in KEYS else f for f in found]
        df = spark.read.schema(T.StructType(typed)).parquet(f"{root}/{split}")
        for key, value in setting.items():
            df = df.filter(F.col(key) == str(value))
        frames.append(df.drop(*KEYS))
    return frames[0], frames[1]


def stored_settings(spark: SparkSession, root: str) -> list[dict[str, str]]:
    """The settings that have a matrix of training rows: a few keys each, from the partitions alone."""
    found = spark.read.parquet(f"{root}/train").schema
    typed = [T.StructField(f.name, T.StringType()) if f.name in KEYS else f for f in found]
    rows = spark.read.schema(T.StructType(typed)).parquet(f"{root}/train")
    return [r.asDict() for r in rows.select(*KEYS).distinct().orderBy(*KEYS).collect()]
