"""Merkle manifest of a data set with a proof for every row, found by pointer jumping.

Rows become leaves, the leaves of a group a binary tree, and the roots of the groups the leaves of one
more tree. A proof lists, level by level, what stands beside a node. To find it, every node first holds
the segment up to its parent. A node's segment and that of the ancestor it ends at make one of twice
the length: so many self-joins as the height has binary digits carry all leaves to the root. After each
of them only nodes at multiples of the new distance are ancestors any more, so that next to the leaves
the other side of the joins soon is small.

Levels are hashed in blocks of 2^SPAN neighbours, so that a tree takes a few shuffles and no task holds
more than a block. Digests are kept as bytes and hashed as lower-case hex text.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from renalis.session import Workspace

SPAN = 10  # levels that are hashed at a time
SALTS = 64  # copies of an ancestor that many leaves share
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")


def h(text: Column) -> Column:
    return F.sha2(text, 256)


def hexed(digest: Column) -> Column:
    return F.lower(F.hex(digest))


def leaf(columns: list[Column]) -> Column:
    """Digest of a row's values: each `-` if null, else its size in bytes, a colon and the value."""
    parts = []
    for c in columns:
        text = c.cast("string")
        size = F.octet_length(text).cast("string")
        parts.append(F.coalesce(F.concat(size, F.lit(":"), text), F.lit("-")))
    return F.unhex(h(F.concat(*parts)))


def group_key(column: Column) -> Column:
    """Text without null that sorts as the column does, null first and else by bytes."""
    return F.coalesce(F.concat(F.lit("="), column.cast("string")), F.lit(""))


def placed(leaves: DataFrame, work: Workspace, name: str) -> DataFrame:
    """The leaves (grp, id, digest, ...) with `pos`, their place in the group by id, null first, and
    then digest, and `n`, the group's number of leaves.

    Leaves are sorted in ranges; places follow from the ranges' counts for each group, one row for a
    range and each group it begins. Rows that are alike in all of that stand side by side.
    """
    spark = leaves.sparkSession
    order = ["grp", "id", "digest"]
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = work.cut(
        leaves.repartitionByRange(parts, *order)
        .sortWithinPartitions(*order)
        .withColumn("at", F.monotonically_increasing_id())
        .withColumn("part", F.shiftright("at", 33)),
        f"merkle_sorted_{name}",
    )
    counts = ranged.groupBy("grp", "part").agg(F.min("at").alias("first"), F.count("*").alias("c"))
    before = F.sum("c").over(W.partitionBy("grp").orderBy("part").rowsBetween(W.unboundedPreceding, -1))
    shift = counts.select(
        "grp", "part",
        (F.coalesce(before, F.lit(0)) - F.col("first")).alias("shift"),
        F.sum("c").over(W.partitionBy("grp")).alias("n"),
    )
    found = ranged.join(shift, ["grp", "part"]).withColumn("pos", F.col("at") + F.col("shift"))
    return found.drop("at", "part", "shift")


def _power(k: Column) -> Column:
    return F.pow(F.lit(2.0), k).cast("long")


def _siblings(nodes: Column, j: Column) -> tuple[Column, Column]:
    """What stands left and right of the j-th node under its parent, null if nothing."""
    odd = (j % 2) == 1
    left = F.when(odd, F.get(nodes, j - 1))
    return left.alias("left"), F.when(~odd, F.get(nodes, j + 1)).alias("right")


def _hashed(base: DataFrame, payload: list[str]) -> DataFrame:
    """(grp, block, n, steps, items, levels) of blocks of neighbours: `levels` are the block's digests
    from the base upwards, `items` its base nodes with their payload."""
    item = F.struct("pos", "digest", *payload)
    blocks = base.groupBy("grp", F.shiftright("pos", SPAN).alias("block"), "n").agg(
        F.array_sort(F.collect_list(item)).alias("items")
    )
    height = F.when(F.col("n") > 1, F.length(F.bin(F.col("n") - 1))).otherwise(0)

    def parents(nodes: Column) -> Column:
        pairs = F.sequence(F.lit(0), F.floor((F.size(nodes) - 1) / 2).cast("int"))
        return F.transform(
            pairs,
            lambda i: F.unhex(
                h(F.concat(hexed(F.get(nodes, 2 * i)), F.coalesce(hexed(F.get(nodes, 2 * i + 1)), F.lit(""))))
            ),
        )

    steps = F.least(F.lit(SPAN), height).cast("int")
    upwards = F.when(F.col("steps") > 0, F.sequence(F.lit(1), F.col("steps"))).otherwise(
        F.array().cast("array<int>")
    )
    levels = F.aggregate(
        upwards,
        F.array(F.col("items.digest")),
        lambda found, _: F.concat(found, F.array(parents(F.element_at(found, -1)))),
    )
    return blocks.withColumn("steps", steps).withColumn("levels", levels)


@dataclass
class Trees:
    roots: DataFrame  # grp, digest
    leaves: DataFrame  # grp, pos, n, payload, digest, seg: the proof from leaf to the group's root
    nodes: DataFrame  # grp, level, pos, digest of all nodes above the leaves


def trees(found: DataFrame, payload: list[str], work: Workspace, name: str) -> Trees:
    """A tree for each group of placed leaves, and each leaf's segment up to its root.

    A segment is an array of (left, right), bottom first, one entry for a level; both are null where a
    node has nothing beside it. A group of one leaf has an empty segment.
    """
    base, level, most = work.cut(found, f"merkle_leaves_{name}"), 0, None
    low, ups, roots, nodes = None, [], [], []
    empty = F.array().cast("array<struct<left:binary,right:binary>>")
    while True:
        blocks = work.cut(_hashed(base, payload if level == 0 else []), f"merkle_{name}_{level}")
        top = F.element_at("levels", -1)
        width = _power(SPAN - F.col("steps"))  # nodes of the last level that a whole block has
        if level == 0:
            first = F.col("levels")[0]
            inside = F.transform(
                "items",
                lambda x, j: F.struct(x.alias("x"), F.struct(*_siblings(first, j)).alias("beside")),
            )
            low = blocks.select("grp", "n", F.inline(inside)).select(
                "grp", "n", "x.*",
                F.when(F.col("n") > 1, F.array("beside")).otherwise(empty).alias("seg"),
            )
        inner = F.flatten(
            F.transform(
                "levels",
                lambda nodes_, k: F.transform(
                    nodes_,
                    lambda d, j: F.struct(
                        (k + level).cast("int").alias("level"),
                        (F.col("block") * _power(SPAN - k) + j).alias("pos"),
                        d.alias("digest"),
                        F.array(F.struct(*_siblings(nodes_, j))).alias("seg"),
                        (k < F.col("steps")).alias("inside"),
                    ),
                ),
            )
        )
        every = blocks.select("grp", F.inline(inner)).filter(F.col("level") > level)
        nodes.append(every.select("grp", "level", "pos", "digest"))
        upper = blocks.select("grp", F.inline(inner)).filter("inside and level > 0")
        ups.append(upper.select("grp", "level", "pos", "seg"))
        following = blocks.select(
            "grp",
            F.ceil(F.col("n") / _power(F.col("steps"))).cast("long").alias("n"),
            F.inline(
                F.transform(
                    top, lambda d, j: F.struct((F.col("block") * width + j).alias("pos"), d.alias("digest"))
                )
            ),
        )
        roots.append(following.filter("n = 1").select("grp", "digest"))
        most = most or base.agg(F.max("n").alias("n")).first()["n"] or 0
        level += SPAN
        if most <= 1 << level:
            break
        base = work.cut(following.filter("n > 1"), f"merkle_base_{name}_{level}")
    up = _union(ups)
    height = max(0, int(most - 1).bit_length()) if most else 0
    return Trees(_union(roots), _jumped(low, up, height, work, name), _union(nodes))


def _union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def _jumped(low: DataFrame, up: DataFrame, height: int, work: Workspace, name: str) -> DataFrame:
    """The leaves with segments up to the root: after each round they span twice the distance."""
    low, up = work.cut(low, f"jump_low_{name}_1"), work.cut(up, f"jump_up_{name}_1")
    distance = 1
    while distance < height:

        def longer(nodes: DataFrame, level: Column, ancestors: DataFrame) -> DataFrame:
            """Nodes of the given level, their segments lengthened by their ancestors'."""
            keys = ["grp", "a_level", "a_pos"]
            right = ancestors.select(
                "grp", F.col("level").alias("a_level"), F.col("pos").alias("a_pos"),
                F.col("seg").alias("more"),
            )
            left = nodes.withColumn("a_level", level + distance).withColumn(
                "a_pos", F.shiftright("pos", distance)
            )
            if distance >= 16:  # up to 2^distance leaves share an ancestor, of which there are few
                right = right.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
                left = left.withColumn("salt", (F.col("pos") % SALTS).cast("int"))
                keys = [*keys, "salt"]
            joined = left.join(right, keys, "left")
            both = F.when(F.col("more").isNull(), F.col("seg")).otherwise(F.concat("seg", "more"))
            return joined.withColumn("seg", both).drop("a_level", "a_pos", "salt", "more")

        low = work.cut(
            longer(low, F.lit(0), up.filter(F.col("level") == distance)),
            f"jump_low_{name}_{2 * distance}",
        )
        if 2 * distance < height:
            there = F.col("level") % (2 * distance)
            up = work.cut(
                longer(up.filter(there == 0), F.col("level"), up.filter(there == distance)),
                f"jump_up_{name}_{2 * distance}",
            )
        distance *= 2
    return low


@dataclass
class Manifest:
    """Proofs of all rows; digests are bytes.

    proofs: grp, id, payload, digest (the leaf), pos, subroot, root, proof (array of left, right from
    the leaf to the root). nodes: grp, level, pos, digest above the leaves of each group.
    """

    proofs: DataFrame
    nodes: DataFrame


def build(leaves: DataFrame, payload: list[str], work: Workspace) -> Manifest:
    """Manifest of leaves (grp, id, digest, payload)."""
    lower = trees(placed(leaves, work, "rows"), ["id", *payload], work, "rows")
    roots = lower.roots.select(
        F.lit("").alias("grp"), F.col("grp").alias("id"), "digest"
    )
    upper = trees(placed(roots, work, "groups"), ["id"], work, "groups")
    tops = upper.leaves.select(
        "grp", F.col("id").alias("of"), F.col("digest").alias("subroot"), F.col("seg").alias("rest")
    )
    root = upper.roots.withColumnRenamed("digest", "root")
    tops = work.cut(tops.join(root, "grp").drop("grp").withColumnRenamed("of", "grp"), "merkle_tops")
    # A group may hold most leaves: its one row goes out in copies.
    copies = tops.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    proofs = (
        lower.leaves.withColumn("salt", (F.col("pos") % SALTS).cast("int"))
        .join(copies, ["grp", "salt"])
        .withColumn("proof", F.concat("seg", "rest"))
        .drop("salt", "seg", "rest", "n")
    )
    return Manifest(proofs, lower.nodes)


def siblings(proof: Column) -> Column:
    """Digests of all siblings of a proof, as hex text in a row."""
    return F.array_join(
        F.transform(
            proof,
            lambda s: F.concat(
                F.coalesce(hexed(s["left"]), F.lit("")), F.coalesce(hexed(s["right"]), F.lit(""))
            ),
        ),
        "",
    )


def fold(digest: Column, proof: Column) -> Column:
    """The root, as hex text, that a leaf and its proof lead to."""
    return F.aggregate(
        proof,
        hexed(digest),
        lambda node, s: h(
            F.concat(
                F.coalesce(hexed(s["left"]), F.lit("")), node, F.coalesce(hexed(s["right"]), F.lit(""))
            )
        ),
    )


def manifest(
    docs: DataFrame,
    work: Workspace,
    columns: tuple[str, ...] = COLUMNS,
    id_col: str = "doc_id",
    group_col: str = "lang",
) -> Manifest:
    """Manifest of a table: a leaf for each row of the values of `columns`, a tree for each group.

    Rows without an id come first in their group, rows with one id are ordered by their leaves, and
    repeated rows have leaves of their own. Null groups are a group, the first. An empty table has no
    proofs and no root. Other columns are not read.
    """
    leaves = docs.select(
        group_key(F.col(group_col)).alias("grp"),
        F.col(id_col).alias("id"),
        leaf([F.col(c) for c in columns]).alias("digest"),
    )
    return build(work.cut(leaves, "merkle_digests"), [], work)


def verify(proofs: DataFrame, digest: Column) -> DataFrame:
    """folded_root and verified: does the digest of each row, with its proof, lead to the root?"""
    folded = proofs.withColumn("folded_root", fold(digest, F.col("proof")))
    return folded.withColumn("verified", F.col("folded_root") == hexed(F.col("root")))


def audit(docs: DataFrame, work: Workspace) -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified for every document.

    The manifest is that of the documents as they are; verified are documents of which those whose id
    has a CRC-32 divisible by 7 have one character more in n_chars. Nulls, repeated rows and ids: as in
    manifest(); a row without an id is not changed.
    """
    values = [F.col(c) for c in COLUMNS]
    struck = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    changed = [F.col(c) + 1 if c == "n_chars" else F.col(c) for c in COLUMNS]
    own = leaf(values)
    leaves = docs.select(
        group_key(F.col("lang")).alias("grp"),
        F.col("doc_id").alias("id"),
        own.alias("digest"),
        F.when(struck, leaf(changed)).alias("again"),
    )
    found = build(work.cut(leaves, "merkle_digests"), ["again"], work).proofs
    return verify(found, F.coalesce("again", "digest")).select(
        F.col("id").alias("doc_id"),
        hexed(F.col("digest")).alias("leaf"),
        hexed(F.col("subroot")).alias("subroot"),
        hexed(F.col("root")).alias("root"),
        h(siblings(F.col("proof"))).alias("proof_sha256"),
        "folded_root",
        "verified",
    )
