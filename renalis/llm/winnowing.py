"""Document fingerprints by winnowing.

The hashes of all k-grams of a text are cut down to the smallest of each window of w, the rightmost
where several are equal. Any passage of k + w - 1 characters that two texts share leaves them a common
fingerprint; positions tell where. The query also compares each text with its successor and with an
edited form, for which every text must meet the next one by id.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from renalis.llm.common import sized

K = 16  # characters of a gram, a power of two
WINDOW = 64  # hashes of a window, a power of two
STEP = 1 << 20  # windows of a text handled at a time
BLOCKS = 20_000  # most ranges of ids; their first ids pass through the driver
_BASE = 0x9E3779B97F4A7C15
_MASK = np.uint64(0xFFFFFFFF)


def gram_hashes(code: np.ndarray) -> np.ndarray:
    """32-bit hashes of all K-grams: a polynomial, built from those of half the length."""
    h = code.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93)
    size, power = 1, _BASE
    while size < K:
        h = h[:-size] * np.uint64(power) + h[size:]
        size, power = 2 * size, power * power % (1 << 64)
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xFF51AFD7ED558CCD)
    return h >> np.uint64(32)


def winnow(text: str | None) -> np.ndarray:
    """The chosen grams in order of position, each hash << 32 | (2^32 - 1 - position).

    In this form the least of a window is its smallest hash, and the rightmost of equal ones. A text
    shorter than K is one gram; one with fewer hashes than a window is one window; an empty or null
    text has none.
    """
    if not text:
        return np.empty(0, np.uint64)
    code = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    if len(code) < K:
        code = np.concatenate([code, np.zeros(K - len(code), np.uint32)])
    chosen = []
    for start in range(0, max(1, len(code) - K - WINDOW + 2), STEP):
        part = code[start : start + STEP + WINDOW + K - 2]
        hashes = gram_hashes(part)
        place = _MASK - np.arange(start, start + len(hashes), dtype=np.uint64)
        key = (hashes << np.uint64(32)) | place
        if len(key) < WINDOW:
            chosen.append(key.min(keepdims=True))
            continue
        size = 1
        while size < WINDOW:
            key = np.minimum(key[:-size], key[size:])
            size *= 2
        chosen.append(key[np.append(True, key[1:] != key[:-1])])
    if len(chosen) == 1:
        return chosen[0]
    key = np.concatenate(chosen)
    return key[np.append(True, key[1:] != key[:-1])]


def as_text(chosen: np.ndarray) -> str:
    """16 hex digits for each chosen gram: its hash and its position."""
    out = np.empty((len(chosen), 2), ">u4")
    out[:, 0] = chosen >> np.uint64(32)
    out[:, 1] = _MASK - (chosen & _MASK)
    return out.tobytes().hex()


def hash_set(chosen: np.ndarray) -> np.ndarray:
    return np.unique(chosen >> np.uint64(32))


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Jaccard similarity of two sorted sets of hashes; 1 if both are empty."""
    if not len(a) and not len(b):
        return 1.0
    common = len(np.intersect1d(a, b, assume_unique=True))
    return common / (len(a) + len(b) - common)


def edited(text: str, following: str) -> str:
    """The last half of the code points replaced by the first as many of the next text."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def with_successors(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Rows (block, extra, id, text) such that in a block, ordered, every row meets the next by id.

    Ids fall into ranges; the first row of each range is copied to the end of the one before, as an
    extra row, and the very first to the end of the last. Texts are shuffled once. Only the first id
    of each range, at most BLOCKS numbers, passes through the driver.
    """
    spark = docs.sparkSession
    least = -(2**63)
    key = F.coalesce(F.col(id_col).cast("long"), F.lit(least).cast("long"))
    rows = docs.select(
        F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"), key.alias("k")
    )
    n = max(1, min(BLOCKS, 16 * int(spark.conf.get("spark.sql.shuffle.partitions"))))
    keys = rows.select("k")
    shares = [i / n for i in range(1, n)] or [0.5]
    cuts = keys.agg(F.percentile_approx("k", shares, 10 * n).alias("at")).first()["at"] or [0]
    splits = [-float("inf"), *sorted({float(c) for c in cuts}), float("inf")]
    ranges = Bucketizer(splits=splits, inputCol="d", outputCol="b")

    def ranged(df: DataFrame) -> DataFrame:
        found = ranges.transform(df.withColumn("d", F.col("k").cast("double")))
        return found.withColumn("block", F.col("b").cast("int")).drop("d", "b")

    firsts = sorted(ranged(keys).groupBy("block").agg(F.min("k").alias("k")).collect())
    heads = spark.createDataFrame(
        [(r["k"], firsts[i - 1]["block"]) for i, r in enumerate(firsts)], "k long, before int"
    )
    both = ranged(rows).join(F.broadcast(heads), "k", "left")  # one row for each range
    own = F.struct(F.col("block").alias("block"), F.lit(0).alias("extra"))
    copy = F.struct(F.col("before").alias("block"), F.lit(1).alias("extra"))
    places = F.when(F.col("before").isNull(), F.array(own)).otherwise(F.array(own, copy))
    return both.select("id", "text", "k", F.inline(places))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    Rows are in ascending order of the id; those without one come first, and rows with equal ids are
    ordered by a hash of the text. A single row is its own successor. A null text is empty: no
    fingerprint, likeness 1 to another empty one and 0 to all else. Other columns are not read.
    """
    sized(docs.sparkSession, 1000)
    placed = (
        with_successors(docs, id_col, text_col)
        .withColumn("tie", F.xxhash64("text"))
        .repartition("block")
        .sortWithinPartitions("block", "extra", "k", "tie")
        .select("block", "extra", "id", "text")
    )
    names = [
        id_col, "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited",
        "near_next",
    ]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None  # block, extra, id, text, chosen grams, their hashes
        for batch in batches:
            out: list[tuple] = []
            columns = [batch.column(i) for i in range(4)]
            for block, extra, id_, text in zip(
                columns[0].to_pylist(), columns[1].to_pylist(), columns[2], columns[3].to_pylist()
            ):
                chosen = winnow(text)
                row = (block, extra, id_, text, chosen, hash_set(chosen))
                if last is not None and last[0] == block:
                    if last[1]:
                        continue
                    other = edited(last[3], text)
                    new = winnow(other)
                    out.append(
                        (
                            last[2].as_py(), len(last[3]),
                            hashlib.sha256(other.encode("utf-8", "surrogatepass")).hexdigest(),
                            as_text(last[4]), as_text(new),
                            likeness(last[5], hash_set(new)), likeness(last[5], row[5]),
                        )
                    )
                last = row
            if out:
                kinds = [pa.int64(), pa.int64(), *[pa.string()] * 3, *[pa.float64()] * 2]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(zip(*out), kinds)], names
                )

    schema = (
        f"`{id_col}` long, n_chars long, edited_sha256 string, fingerprint string, "
        "edited_fingerprint string, near_edited double, near_next double"
    )
    return placed.mapInArrow(run, schema)
