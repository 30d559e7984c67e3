"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from renalis.session import Workspace


def components(links: DataFrame, work: Workspace, name: str) -> DataFrame:
    """(id, label) of every id in links (a, b): label is the smallest id of its component.

    Each round every id takes the smallest label among its neighbours' and then the label of its
    label, so that distances halve. Rounds are written tables, which cut the lineage; only the number
    of changes comes to the driver. No links give no rows.
    """
    both = links.select("a", "b").unionByName(
        links.select(F.col("b").alias("a"), F.col("a").alias("b"))
    )
    labels = work.cut(
        both.groupBy(F.col("a").alias("id")).agg(F.min("b").alias("m")).select(
            "id", F.least("id", "m").alias("label")
        ),
        f"labels_{name}_0",
    )
    step = 0
    while True:
        step += 1
        near = (
            both.join(labels.withColumnRenamed("id", "a"), "a")
            .groupBy(F.col("b").alias("id"))
            .agg(F.min("label").alias("m"))
        )
        moved = labels.join(near, "id").select("id", F.least("label", "m").alias("now"), "label")
        jump = labels.select(F.col("id").alias("now"), F.col("label").alias("next"))
        moved = moved.join(jump, "now", "left").select(
            "id", F.least("now", F.coalesce("next", "now")).alias("label"), F.col("label").alias("old")
        )
        moved = work.cut(moved, f"labels_{name}_{step}")
        if moved.filter("label != old").isEmpty():
            return moved.select("id", "label")
        labels = moved.select("id", "label")
