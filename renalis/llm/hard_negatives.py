"""Hard negatives by exact integer products of packed vectors.

Components are integers. Those of many candidates, made positive by a bias, stand side by side in the
fields of one wide integer for each dimension. A wide integer times an anchor's component is that many
products at once, and the sum over the dimensions holds, field by field, the scores of all candidates
(Kronecker substitution). A field is wide enough for any sum, so none runs into the next.

Rows fall into groups of bounded size by hash. Anchors, the stated query set, are copied to every group
and stream past its packed rows; what a group finds for an anchor is a few rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from operator import mul

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from renalis.llm.common import sized
from renalis.session import Workspace

GROUP = 8192  # rows that share a task's memory in packed form
LANES = 1024  # candidates in one wide integer
POSITIVES = NEGATIVES = 5
SCALE = 256
SHARE = (80, 100)  # least score of a negative as a share of the positive's


def quantised(rows: DataFrame, anchor: Column) -> DataFrame:
    """(id, label, anchor, q) of the rows that take part: q are the components as integers.

    A row without an id or label, or whose vector is null or has a component that is null or not
    finite, takes no part.
    """
    part = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull()

    def finite(x: Column) -> Column:
        value = F.abs(x.cast("double"))
        return value.isNotNull() & (value < float("inf"))  # NaN is greater than infinity

    part = part & F.forall("embedding", finite)
    whole = F.transform("embedding", lambda x: F.floor(F.lit(SCALE) * x.cast("double")))
    return rows.filter(part).select(
        F.col("vec_id").cast("long").alias("id"),
        F.col("label").cast("long").alias("label"),
        F.coalesce(anchor, F.lit(False)).alias("anchor"),
        whole.alias("q"),
    )


def _matrix(column: pa.Array) -> np.ndarray:
    """Vectors as rows; shorter ones are filled with zeros."""
    sizes = np.array(column.value_lengths(), np.int64)
    values = np.array(column.flatten(), np.int64)
    if len(sizes) and (sizes == sizes[0]).all():
        return values.reshape(len(sizes), -1)
    out = np.zeros((len(sizes), int(sizes.max(initial=0))), np.int64)
    rows = np.repeat(np.arange(len(sizes)), sizes)
    out[rows, np.arange(len(values)) - np.repeat(np.cumsum(sizes) - sizes, sizes)] = values
    return out


@dataclass
class Packed:
    """Candidates, ordered by label, in the fields of wide integers: one integer for each dimension of
    LANES rows. `words` holds first row, end, the integers, and the bound in every field."""

    ids: np.ndarray
    labels: np.ndarray
    keys: np.ndarray
    bias: int
    width: int  # bytes of a field
    bound: int  # more than the size of any sum
    words: list[tuple[int, int, list[int], int]]

    @classmethod
    def of(cls, columns: list[np.ndarray], q: np.ndarray, largest: int) -> Packed:
        """Packs rows (ids, labels, keys) with their vectors; `largest` bounds the anchors' components."""
        order = np.lexsort((columns[0], columns[1]))
        ids, labels, keys = (c[order] for c in columns)
        bias = int(np.abs(q).max(initial=0))
        bound = max(1, q.shape[1]) * (2 * bias + 1) * (largest + 1)
        if bound >= 1 << 56:
            raise ValueError("components too large: scores would not fit into a long")
        width = 4 if bound < 1 << 30 else 8
        kind, words = f"<u{width}", []

        def wide(fields: np.ndarray) -> int:
            return int.from_bytes(np.ascontiguousarray(fields, kind).tobytes(), "little")

        for a in range(0, len(q), LANES):
            part = q[order[a : a + LANES]] + bias
            lift = wide(np.full(len(part), bound))
            words.append((a, a + len(part), [wide(c) for c in part.T], lift))
        return cls(ids, labels, keys, bias, width, bound, words)

    def scores(self, anchor: list[int], wanted: np.ndarray) -> np.ndarray:
        """Scores of the candidates in the words that are wanted; those of others stay 0."""
        out = np.zeros(len(self.ids), np.int64)
        kind = f"<u{self.width}"
        for word in np.flatnonzero(wanted).tolist():
            a, b, columns, lift = self.words[word]
            # The bound in every field keeps all fields of the sum positive.
            total = sum(map(mul, anchor, columns), lift)
            out[a:b] = np.frombuffer(total.to_bytes((b - a) * self.width, "little"), kind)
            out[a:b] -= self.bound + self.bias * sum(anchor[: len(columns)])
        return out

    def ends(self) -> tuple[np.ndarray, np.ndarray]:
        """Least and greatest label of each word."""
        first = np.array([w[0] for w in self.words], np.int64)
        last = np.array([w[1] - 1 for w in self.words], np.int64)
        return self.labels[first], self.labels[last]


def _groups(batches: Iterator[pa.RecordBatch], largest: int) -> Iterator[tuple[Packed, pa.RecordBatch]]:
    """Each group's packed candidates with every batch of anchors that follows them."""
    current, held, packed = None, [], None
    for batch in batches:
        group, kind = (np.array(batch.column(k), np.int64) for k in (0, 1))
        edges = np.flatnonzero(np.diff(group) | np.diff(kind)) + 1
        for a, b in zip([0, *edges.tolist()], [*edges.tolist(), len(group)]):
            part = batch.slice(a, b - a)
            if group[a] != current:
                current, held, packed = group[a], [], None
            if kind[a] == 0:
                held.append(part)
                continue
            if not held and packed is None:
                continue  # no candidate has this group
            if packed is None:
                whole = pa.Table.from_batches(held).combine_chunks()
                columns = [np.array(whole.column(k), np.int64) for k in (2, 3, 4)]
                packed = Packed.of(columns, _matrix(whole.column(5).combine_chunks()), largest)
                held = []
            yield packed, part


def _found(columns: list[list], names: list[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names)


def mine(rows: DataFrame, anchor: Column, work: Workspace) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    `rows` has vec_id, label, embedding; `anchor` says which rows are the query set. For each anchor
    and each of its POSITIVES best other rows of the same label, the NEGATIVES best rows of other
    labels whose scores lie between SHARE of the positive's score and that score. Ties go to the
    smaller id. Repeated rows count once; different rows with one id are rows of their own, and as
    anchors each has its own result. Vectors of different lengths are compared as if filled with
    zeros. A score must fit into 56 bits, else the job fails. No anchors, or no rows, give no rows;
    other columns are not read.
    """
    spark = rows.sparkSession
    sized(spark)
    key = F.xxhash64("id", "label", "q").alias("key")
    kept = work.cut(quantised(rows, anchor).distinct().select("*", key), "hard_negative_rows")
    most = F.max(F.when(F.col("anchor"), F.array_max(F.transform("q", F.abs))))
    known = kept.agg(F.count("*").alias("n"), most.alias("largest")).first()
    groups, largest = max(1, -(-known["n"] // GROUP)), int(known["largest"] or 0)
    every = F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("group")
    names = ["group", "kind", "id", "label", "key", "q"]
    candidates = kept.select(
        F.pmod("key", F.lit(groups)).cast("int").alias("group"), F.lit(0).alias("kind"), *names[2:]
    )

    def beside(anchors: DataFrame) -> DataFrame:
        """Candidates of each group, then all anchors."""
        both = candidates.unionByName(anchors, allowMissingColumns=True)
        return both.repartition("group").sortWithinPartitions("group", "kind")

    def positives(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for packed, anchors in _groups(batches, largest):
            least, greatest = packed.ends()
            out: list[list] = [[], [], [], []]
            for id_, label, key_, q in zip(*(anchors.column(k).to_pylist() for k in (2, 3, 4, 5))):
                scores = packed.scores(q, (least <= label) & (label <= greatest))
                other = (packed.labels == label) & ((packed.keys != key_) | (packed.ids != id_))
                place = np.flatnonzero(other)
                best = place[np.lexsort((packed.ids[place], -scores[place]))[:POSITIVES]]
                for column, values in zip(
                    out, ([id_] * len(best), [key_] * len(best), packed.ids[best], scores[best])
                ):
                    column.extend(values)
            yield _found(out, ["id", "key", "other", "score"])

    anchors = kept.filter("anchor").select(every, F.lit(1).alias("kind"), *names[2:])
    near = beside(anchors).mapInArrow(positives, "id long, key long, other long, score long")
    order = W.partitionBy("id", "key").orderBy(F.desc("score"), "other")
    near = near.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= POSITIVES)
    near = near.groupBy("id", "key").agg(
        F.array_sort(F.collect_list(F.struct("place", "other", "score"))).alias("best")
    )
    near = near.select(
        "id", "key", F.col("best.other").alias("p_id"), F.col("best.score").alias("p_score")
    )
    asked = work.cut(kept.filter("anchor").join(near, ["id", "key"]), "hard_negative_anchors")

    names_found = [
        "anchor_id", "key", "p", "positive_id", "positive_score", "negative_id", "negative_score",
    ]

    def negatives(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for packed, anchors in _groups(batches, largest):
            least, greatest = packed.ends()
            out: list[list] = [[], [], [], [], [], [], []]
            columns = (anchors.column(k).to_pylist() for k in range(2, 8))
            for id_, label, key_, q, p_ids, p_scores in zip(*columns):
                scores = packed.scores(q, (least != label) | (greatest != label))
                low = SHARE[1] * scores >= SHARE[0] * min(p_scores)
                place = np.flatnonzero((packed.labels != label) & low & (scores <= max(p_scores)))
                place = place[np.lexsort((packed.ids[place], -scores[place]))]
                ranked = scores[place]
                for p, (p_id, p_score) in enumerate(zip(p_ids, p_scores)):
                    fits = (ranked <= p_score) & (SHARE[1] * ranked >= SHARE[0] * p_score)
                    best = place[np.flatnonzero(fits)[:NEGATIVES]]
                    same = ([x] * len(best) for x in (id_, key_, p, p_id, p_score))
                    for column, values in zip(out, (*same, packed.ids[best], scores[best])):
                        column.extend(values)
            yield _found(out, names_found)

    anchors = asked.select(every, F.lit(1).alias("kind"), *names[2:], "p_id", "p_score")
    found = beside(anchors).mapInArrow(negatives, ", ".join(f"{n} long" for n in names_found))
    order = W.partitionBy("anchor_id", "key", "p").orderBy(F.desc("negative_score"), "negative_id")
    return (
        found.withColumn("rank", F.row_number().over(order))
        .filter(F.col("rank") <= NEGATIVES)
        .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
    )
