"""Near duplicates by HyperMinHash.

The hashed word shingles of a text fall into buckets. A register keeps, of the smallest hash of its
bucket, the number of leading zeros and the bits that follow: 16 bits instead of 64. Registers go into
bands, texts that agree in a band meet, a Jaccard estimate that takes accidental agreement of the
short registers into account sorts out most of the wrong ones, and full sets confirm the rest.

Most texts leave buckets empty, and a band of fixed places would then hold one register or two, which
any two texts with a common phrase share. A band is therefore a run of registers that are not empty,
with their places.

Texts with equal sets are one class and go through all this as one. In a crowded bucket members are
first compared with a single centre, the member that shares most with others, so a group of thousands
of near copies costs as many comparisons and not their square. What the confirmed links join into one
component needs no further comparison. Members of one bucket that are still in different components
are then compared with each other, in blocks of bounded size inside the tasks: by a byte of each register, by
halves of the hashes, which bound what sets share, and by the whole sets of those members alone that
these allow a link.
What a block finds is exact; it passes on links between components and nothing else.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from renalis.functions.membership import Membership, membership
from renalis.llm.common import claim, cuts, map_texts, sized, trim
from renalis.llm.components import components
from renalis.session import Workspace

BUCKETS = 256  # by the first 8 bits of a hash
MANTISSA = 10  # bits kept behind the leading zeros
# Runs of a sketch, by the number of registers that are not empty: up to `own` of them belong to the
# level, and sketches of up to `reach` join it, which their near duplicates may have. Few registers
# start a run each, many at STARTS fixed places; at 0.8, of (1 - 0.8^5)^51 pairs no run agrees.
LEVELS = [(24, 32, 3), (51, 72, 4), (BUCKETS, BUCKETS, 5)]  # own, reach, registers of a run
STARTS = 51
TINY = 9  # sets of so few shingles also meet by what is left without one of them, which is exact
CELL = 1024  # members of a bucket that are compared with as many at a time
CELL_HASHES = 2_000_000  # and shingles that their sets hold, on average
COLUMNS = 1024  # hashes of a cell that are counted at a time
BEYOND = 1 << 62  # ids are smaller
MARGIN = 5.0  # standard deviations by which an estimate may fall short
CACHE = 400_000  # words whose hashes a worker keeps
_P = np.uint64(0x9E3779B97F4A7C15)
_Q = np.uint64(0xFF51AFD7ED558CCD)


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


_words = _Hashes()


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * _Q
    return x ^ (x >> np.uint64(29))


def shingles(text: str | None, size: int = 2) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the runs of `size` words; of all words if there are fewer.

    Words stand between the six ASCII white-space characters, with A-Z lower-cased, and nothing else.
    """
    if not text:
        return np.empty(0, np.uint64)
    claim("near_dedup", _words.clear)
    parts = []
    for piece in cuts(text):
        words = piece.encode("utf-8", "surrogatepass").lower().split()
        parts.append(np.fromiter(map(_words.__getitem__, words), np.uint64, len(words)))
    if len(_words) > CACHE:
        _words.clear()
    h = np.concatenate(parts)
    if not len(h):
        return h
    size = min(size, len(h))
    n = len(h) - size + 1
    x = np.full(n, size, np.uint64)
    for j in range(size):
        x = _mixed((x ^ h[j : j + n]) * _P)
    return np.unique(x)


def registers(hashes: np.ndarray) -> np.ndarray:
    """One 16-bit register for each bucket: 0 if empty, else zeros and mantissa of the least hash."""
    out = np.zeros(BUCKETS, np.uint16)
    if not len(hashes):
        return out
    bucket = (hashes >> np.uint64(56)).astype(np.int64)
    first = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1]))  # sorted: the least of each
    # 48 bits behind the bucket's 8 are exact as floating point, which finds the leading one.
    value = ((hashes[first] & np.uint64((1 << 56) - 1)) >> np.uint64(8)).astype(np.float64)
    fraction, exponent = np.frexp(value)
    zeros = np.where(value > 0, 48 - exponent, 48)
    rest = np.where(value > 0, (fraction * 2 - 1) * (1 << MANTISSA), 0).astype(np.int64)
    out[bucket[first]] = 1 + zeros * (1 << MANTISSA) + rest
    return out


def _folded(tag: int, columns: list[np.ndarray]) -> np.ndarray:
    key = np.full(len(columns[0]), tag, np.uint64)
    for c in columns:
        key = _mixed((key ^ c) * _P)
    return key


def band_keys(found: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Keys of the bands of a sketch, each once."""
    at = np.flatnonzero(found)
    if not len(at):
        return np.empty(0, np.int64)
    placed = (at.astype(np.uint64) << np.uint64(16)) | found[at]
    keys, under = [], 0
    for own, reach, size in LEVELS:
        if under < len(at) <= reach:
            first = np.arange(len(at))
            if own == BUCKETS:
                places = np.arange(STARTS) * BUCKETS // STARTS
                first = np.unique(np.searchsorted(at, places) % len(at))
            run = [placed[(first + j) % len(at)] for j in range(size)]
            keys.append(_folded(size, run))
        under = own
    if len(hashes) <= TINY:
        total = hashes.sum(dtype=np.uint64)
        keys.append(_folded(1, [np.append(total - hashes, total)]))
    return np.unique(np.concatenate(keys)).astype(np.int64)


def estimate(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Jaccard estimate of pairs of register rows, and the number of buckets it rests on.

    Two different least hashes agree in zeros and mantissa with a chance of about 1/3 of 2^-MANTISSA,
    so that many of the buckets that both fill are taken off the agreeing ones.
    """
    used = ((a > 0) | (b > 0)).sum(axis=1)
    both = ((a > 0) & (b > 0)).sum(axis=1)
    equal = ((a == b) & (a > 0)).sum(axis=1)
    return corrected(equal, both, used), used


def corrected(equal: np.ndarray, both: np.ndarray, used: np.ndarray) -> np.ndarray:
    """The share of equal registers, without those expected to be equal by accident."""
    chance = (both - equal) / (3.0 * (1 << MANTISSA))
    return np.maximum(equal - chance, 0) / np.maximum(used, 1)


def least_estimate(percent: int, used: np.ndarray) -> np.ndarray:
    """The estimate below which a pair of the similarity asked for does not fall."""
    threshold = percent / 100
    return threshold - MARGIN * np.sqrt(threshold * (1 - threshold) / np.maximum(used, 1))


# ---- steps ----------------------------------------------------------------------------------------


def sketches(docs: DataFrame, size: int, id_col: str, text_col: str) -> DataFrame:
    """(id, text_key, n, set_hash, registers, keys) of each row."""
    names = ["id", "text_key", "n", "set_hash", "registers", "keys"]

    def convert(batch: pa.RecordBatch) -> pa.RecordBatch:
        counts, whole, short, keys = [], [], [], []
        for text in batch.column(1).to_pylist():
            h = shingles(text, size)
            found = registers(h)
            counts.append(len(h))
            whole.append(xxhash.xxh3_128_digest(h.tobytes()) if len(h) else None)
            short.append(found.tobytes())
            keys.append(band_keys(found, h))
        columns = [
            batch.column(0), batch.column(2), pa.array(counts, pa.int64()), pa.array(whole, pa.binary()),
            pa.array(short, pa.binary()), _lists(keys),
        ]
        return pa.RecordBatch.from_arrays(columns, names)

    rows = docs.select(
        F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.xxhash64(text_col).alias("text_key")
    )
    return map_texts(
        rows,
        rows.columns,
        convert,
        "id long, text_key long, n long, set_hash binary, registers binary, keys array<long>",
    )


def _lists(parts: list[np.ndarray]) -> pa.ListArray:
    border = np.cumsum([0] + [len(p) for p in parts]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(border), pa.array(np.concatenate(parts)))


def _pairs(x: F.Column, y: F.Column) -> list[F.Column]:
    return [F.least(x, y).alias("a"), F.greatest(x, y).alias("b")]


def _sizes_allow(n: F.Column, m: F.Column, percent: int) -> F.Column:
    """The smaller set is at least the share of the larger that the similarity asks for."""
    return 100 * F.least(n, m) >= percent * F.greatest(n, m)


def likely(pairs: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """Pairs whose estimate is not far below the similarity asked for."""
    sides = [
        classes.select(F.col("rep").alias(c), F.col("registers").alias(f"r{c}")) for c in ("a", "b")
    ]

    def convert(batch: pa.RecordBatch) -> pa.RecordBatch:
        a, b = (
            np.stack([np.frombuffer(r, np.uint16) for r in batch.column(i).to_pylist()])
            for i in (2, 3)
        )
        found, used = estimate(a, b)
        keep = pa.array(found >= least_estimate(percent, used))
        return batch.select(["a", "b"]).filter(keep)

    joined = pairs.join(sides[0], "a").join(sides[1], "b")
    return map_texts(joined, ["a", "b", "ra", "rb"], convert, "a long, b long")


def _counts(tokens: list[np.ndarray]) -> np.ndarray:
    """How many tokens each two of some sorted lists without repeats have in common."""
    size = np.array([len(x) for x in tokens])
    owner = np.repeat(np.arange(len(tokens)), size)
    column, count = np.unique(np.concatenate(tokens), return_inverse=True, return_counts=True)[1:]
    number = np.cumsum(count > 1) - 1  # of the tokens that more than one list has
    kept = count[column] > 1
    owner, column = owner[kept], number[column[kept]]
    common = np.zeros((len(tokens), len(tokens)), np.float32)
    by_column = np.argsort(column, kind="stable")
    owner, column = owner[by_column], column[by_column]
    for low in range(0, int(column[-1]) + 1 if len(column) else 0, COLUMNS):
        at = slice(*np.searchsorted(column, [low, low + COLUMNS]))
        part = np.zeros((len(tokens), COLUMNS), np.float32)
        part[owner[at], column[at] - low] = 1
        common += part @ part.T
    return common


def _estimated(sketches_: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """estimate() of each two of some register rows."""
    filled = (sketches_ > 0).astype(np.float32)
    both = filled @ filled.T
    place = np.arange(sketches_.shape[1], dtype=np.uint32) << np.uint32(16)
    equal = _counts([(place | row)[row > 0] for row in sketches_])
    np.fill_diagonal(equal, filled.sum(axis=1))
    used = filled.sum(axis=1)[:, None] + filled.sum(axis=1) - both
    return corrected(equal, both, used), used


def _numbered(labels: list[int]) -> np.ndarray:
    return np.unique(np.array(labels), return_inverse=True)[1]


def _open(members: list[tuple]) -> np.ndarray:
    """Which two members (block, rep, label, ...) of one cell are still to be compared.

    Those of different labels, and in a cell of two blocks of different blocks.
    """
    block, label = np.array([m[0] for m in members]), _numbered([m[2] for m in members])
    differ = label[:, None] != label
    if block[0] != block[-1]:
        differ &= block[:, None] != block
    return differ


def _links(members: list[tuple], percent: int) -> list[tuple[int, int]]:
    """Links (a, b) that join components of the members (block, rep, label, registers, set) of one cell.

    Members of one block, or else pairs of one from each of two. Pairs whose estimate lies far below
    the similarity are left out, all others compared by their sets. Of the links found, those that
    connect what the ones before have not.
    """
    if len(members) < 2:
        return []
    asked = _open(members)
    found, used = _estimated(np.stack([np.frombuffer(m[3], np.uint16) for m in members]))
    asked &= found >= least_estimate(percent, used)
    label = _numbered([m[2] for m in members])
    pairs = np.argwhere(np.triu(asked, 1))
    if not len(pairs):
        return []
    sets = {i: np.frombuffer(members[i][4], np.int64) for i in np.unique(pairs).tolist()}
    common = None
    if len(pairs) > 4 * len(sets):  # many: all at once
        rows = {i: row for row, i in enumerate(sets)}
        common = _counts(list(sets.values()))
    root = list(range(int(label.max()) + 1))

    def top(x: int) -> int:
        while root[x] != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    out = []
    for x, y in pairs.tolist():
        p, q = top(int(label[x])), top(int(label[y]))
        if p == q:
            continue
        if common is None:
            shared = len(np.intersect1d(sets[x], sets[y], assume_unique=True))
        else:
            shared = int(common[rows[x], rows[y]])
        if 100 * shared >= percent * (len(sets[x]) + len(sets[y]) - shared):
            root[p] = q
            out.append(tuple(sorted((members[x][1], members[y][1]))))
    return out


def _cells(
    members: DataFrame,
    values: list[str],
    work: Callable[[int, list[tuple]], Iterable[tuple]],
    columns: list[str],
) -> DataFrame:
    """The distinct pairs of numbers that `work` finds in the cells of members (key, rep, label, c, s and
    the values it asks for) of a bucket.

    c is the number of members of the bucket, s that of their shingles. They fall into blocks of about
    CELL members and CELL_HASHES shingles, and each two blocks meet in a cell, so a task holds two blocks
    at most, however large the bucket.
    """
    blocks = F.ceil(F.greatest(F.col("c") / F.lit(CELL), F.col("s") / F.lit(CELL_HASHES)))
    own = F.pmod(F.xxhash64("rep"), F.col("blocks")).cast("int")
    every = F.sequence(F.lit(0), F.col("blocks") - 1)
    cells = (
        members.withColumn("blocks", blocks.cast("int"))
        .withColumn("block", own)
        .withColumn("other", F.explode(every))
        .withColumn("low", F.least("block", "other"))
        .withColumn("high", F.greatest("block", "other"))
        .repartition("key", "low", "high")
        .sortWithinPartitions("key", "low", "high", "block", "rep")
        .select("key", "low", "high", "block", "rep", "label", *values)
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cell, rows, out = None, [], set()

        def done() -> None:
            out.update(work(cell[0], rows) if cell else ())

        for batch in batches:
            for key, low, high, *row in zip(*(c.to_pylist() for c in batch.columns)):
                if (key, low, high) != cell:
                    done()
                    cell, rows = (key, low, high), []
                rows.append(tuple(row))
        done()
        if out:
            found = [pa.array(c, pa.int64()) for c in zip(*out)]
            yield pa.RecordBatch.from_arrays(found, columns)
        rows.clear()
        trim()

    return cells.mapInArrow(run, ", ".join(f"{c} long" for c in columns)).distinct()


def shortened(classes: DataFrame) -> DataFrame:
    """(rep, short) for (rep, registers): a byte for each register, 0 if it is empty. Equal registers have
    equal bytes, so that an estimate by bytes is not below that by registers."""

    def convert(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint16)
        short = np.where(rows > 0, 1 + rows % 255, 0).astype(np.uint8).reshape(-1, BUCKETS)
        found = pa.array([row.tobytes() for row in short], pa.binary())
        return pa.RecordBatch.from_arrays([batch.column(0), found], ["rep", "short"])

    return map_texts(classes, ["rep", "registers"], convert, "rep long, short binary")


def likely_in_buckets(members: DataFrame, percent: int) -> DataFrame:
    """(key, rep) of the members whose sizes and estimate allow a link to one of their bucket in another
    component, with which they share no lower key: two members meet in the first of their buckets only.

    Members (key, rep, label, n, short, lower, c, s): short as shortened() has it, lower the keys of the
    rep's buckets that are below this one. _links() compares no pair whose estimate is left out.
    """

    def work(key: int, rows: list[tuple]) -> Iterator[tuple[int, int]]:
        if len(rows) < 2 or not (asked := _open(rows)).any():
            return
        n = np.array([m[3] for m in rows])
        asked &= 100 * np.minimum(n[:, None], n) >= percent * np.maximum(n[:, None], n)
        found, used = _estimated(np.stack([np.frombuffer(m[4], np.uint8) for m in rows]))
        asked &= found >= least_estimate(percent, used)
        asked &= _counts([np.array(m[5], np.int64) for m in rows]) == 0
        for i in np.flatnonzero(asked.any(axis=0)).tolist():
            yield key, rows[i][1]

    return _cells(members, ["n", "short", "lower"], work, ["key", "rep"])


def with_lower_keys(members: DataFrame) -> DataFrame:
    """Members (key, rep, ...) with the keys of the same rep that are below the row's, as `lower`."""
    every = members.groupBy("rep").agg(F.collect_set("key").alias("every"))  # of a sketch's few bands
    lower = F.array_sort(F.filter("every", lambda x: x < F.col("key")))
    return members.join(every, "rep").withColumn("lower", lower).drop("every")


def _only(members: DataFrame, asked: DataFrame) -> DataFrame:
    """The members (key, rep) asked for, with c and s of what is left of their buckets."""
    left = members.join(asked, ["key", "rep"]).drop("c", "s")
    sizes = left.groupBy("key").agg(F.count("*").alias("c"), F.sum("n").alias("s"))
    return left.join(sizes, "key")


def asked_in_buckets(members: DataFrame, percent: int) -> DataFrame:
    """(key, rep) of the members that may have a link to one of their bucket in another component.

    Members (key, rep, label, n, half, c, s), see halved(). A pair that is left out has no link: its
    sets share no more hashes than halves, and those that equal halves hide in one set.
    """

    def work(key: int, rows: list[tuple]) -> Iterator[tuple[int, int]]:
        if len(rows) < 2 or not (asked := _open(rows)).any():
            return
        halves = [np.frombuffer(m[4], np.uint32) for m in rows]
        n = np.array([m[3] for m in rows])
        hidden = n - np.array([len(h) for h in halves])
        most = _counts(halves).astype(np.int64) + np.minimum(hidden[:, None], hidden)
        asked &= 100 * most >= percent * (n[:, None] + n - most)
        for i in np.flatnonzero(asked.any(axis=0)).tolist():
            yield key, rows[i][1]

    return _cells(members, ["n", "half"], work, ["key", "rep"])


def links_in_buckets(members: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) between components, of members (key, rep, label, registers, members, c, s) of a bucket."""
    return _cells(
        members, ["registers", "members"], lambda key, rows: _links(rows, percent), ["a", "b"]
    )


def halved(sets: DataFrame) -> DataFrame:
    """(rep, half) for (rep, members): the upper 32 bits of a set's hashes, in order, each once."""

    def convert(batch: pa.RecordBatch) -> pa.RecordBatch:
        halves = [
            np.unique(np.frombuffer(v.as_buffer(), np.uint64) >> np.uint64(32)).astype(np.uint32)
            for v in batch.column(1)
        ]
        found = pa.array([h.tobytes() for h in halves], pa.binary())
        return pa.RecordBatch.from_arrays([batch.column(0), found], ["rep", "half"])

    return map_texts(sets, ["rep", "members"], convert, "rep long, half binary")


def full_sets(docs: DataFrame, ids: DataFrame, size: int, id_col: str, text_col: str) -> DataFrame:
    """(id, repeated, members) for classes (rep, id, set_hash, repeated): by rep the full set, as 8 bytes
    for each hash in order. An id may have several texts, of which that with the set_hash counts."""
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))

    def convert(batch: pa.RecordBatch) -> pa.RecordBatch:
        sets = [shingles(t, size).astype(np.int64).tobytes() for t in batch.column(1).to_pylist()]
        own = [xxhash.xxh3_128_digest(s) for s in sets]
        same = pa.array([a == b for a, b in zip(own, batch.column(2).to_pylist())], pa.bool_())
        columns = [batch.column(4), batch.column(3), pa.array(sets, pa.binary())]
        return pa.RecordBatch.from_arrays(columns, ["id", "repeated", "members"]).filter(same)

    asked = texts.join(ids, "id").select("id", "text", "set_hash", "repeated", "rep")
    return map_texts(asked, asked.columns, convert, "id long, repeated boolean, members binary")


def _once(rows: DataFrame, key: str) -> DataFrame:
    """Rows of repeated keys once; only these are shuffled."""
    again = rows.filter("repeated").dropDuplicates([key])
    return rows.filter("not repeated").unionByName(again).drop("repeated")


def _among(rows: DataFrame, column: str, ids: DataFrame, work: Workspace, name: str) -> DataFrame:
    """Rows whose column can be among the first column of ids: others are dropped before a join's shuffle."""
    words = work.cut(membership(ids, ids.columns[0]), f"among_{name}")
    return rows.filter(Membership.of(words).may_have(column))


def _ends(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.explode(F.array("a", "b")).alias("id"))


def confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs whose full sets are similar enough."""
    sides = [sets.select(F.col("id").alias(c), F.col("members").alias(f"m{c}")) for c in ("a", "b")]

    def convert(batch: pa.RecordBatch) -> pa.RecordBatch:
        keep = []
        for x, y in zip(batch.column(2), batch.column(3)):
            a, b = (np.frombuffer(v.as_buffer(), np.int64) for v in (x, y))
            common = len(np.intersect1d(a, b, assume_unique=True))
            keep.append(100 * common >= percent * (len(a) + len(b) - common))
        return batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    joined = pairs.join(sides[0], "a").join(sides[1], "b")
    return map_texts(joined, ["a", "b", "ma", "mb"], convert, "a long, b long")


def near_duplicates(
    docs: DataFrame,
    work: Workspace,
    size: int = 2,
    percent: int = 80,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """id, n_shingles, component_id, kept for every row.

    Texts are linked if 100 * intersection >= percent * union of their sets of shingles. component_id
    is the smallest id that links lead to, and the row with that id is kept. Texts that are null,
    empty or without words have no set and are linked with nothing. Different texts under one id are
    rows of their own, linked only by what they say; keep_first() chooses among rows, not ids. Rows
    without an id join the component of equal texts that have one, and else stay by themselves, with a
    null component_id, and kept. Ids are integers. An empty table gives no rows.
    """
    return _found(docs, work, size, percent, id_col, text_col).select(
        F.col("id").alias(id_col), "n_shingles", "component_id", "kept"
    )


def keep_first(
    docs: DataFrame,
    work: Workspace,
    size: int = 2,
    percent: int = 80,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """The table with one row of each group of near duplicates, and all rows without words.

    Of a group the row with the smallest id stays, null last; of different texts under that id one, and
    of rows that repeat id and text one. Another text under the id of a row that goes is not touched.
    """
    found = work.cut(_found(docs, work, size, percent, id_col, text_col), "row_verdicts")
    group = F.coalesce(F.col("number").cast("string"), F.hex("set_hash"))
    rows = found.filter("n_shingles > 0").groupBy(group.alias("g"), "id", "text_key").agg(
        F.count("*").alias("m")
    )
    order = F.struct(F.col("id").isNull(), "id", "text_key")
    first = rows.groupBy("g").agg(F.min(order).alias("first"))
    # Of most groups all rows but the first go; a first row that is repeated stays once.
    named = F.struct(F.col("id").isNull(), "id", "text_key")
    verdict = rows.join(first, "g").withColumn("stays", named.eqNullSafe(F.col("first")))
    verdict = work.cut(
        verdict.filter("not stays or m > 1").groupBy("id", "text_key").agg(F.max("stays").alias("stays")),
        "row_changes",
    )
    keyed = docs.withColumn("near_dedup_key", F.xxhash64(text_col))
    same = F.col(id_col).eqNullSafe(verdict["id"]) & (F.col("near_dedup_key") == verdict["text_key"])
    words = work.cut(membership(verdict, "id"), "among_changes")
    # Most rows cannot be concerned, and need no join.
    asked = Membership.of(words).may_have(id_col) | F.col(id_col).isNull()
    untouched = keyed.filter(asked).join(verdict, same, "left_anti")
    stays = work.cut(verdict.filter("stays"), "rows_once")
    same = F.col(id_col).eqNullSafe(stays["id"]) & (F.col("near_dedup_key") == stays["text_key"])
    again = keyed.filter(asked).join(stays, same, "left_semi")
    again = again.dropDuplicates([id_col, "near_dedup_key"])
    every = keyed.filter(~asked).unionByName(untouched).unionByName(again)
    return every.drop("near_dedup_key")


def _found(
    docs: DataFrame, work: Workspace, size: int, percent: int, id_col: str, text_col: str
) -> DataFrame:
    """id, text_key, set_hash, n_shingles, number, component_id, kept for every row.

    number tells components apart whose smallest ids are one; it is null where no id has the set.
    """
    spark = docs.sparkSession
    sized(spark)
    every = work.cut(sketches(docs, size, id_col, text_col), "sketches")
    # Rows of one id and set first: copies without end of one row are one.
    sets = (
        every.filter("n > 0 and id is not null")
        .groupBy("set_hash", "id")
        .agg(F.count("*").alias("m"))
        .groupBy("set_hash")
        .agg(F.min(F.struct("id", "m")).alias("first"))
        .select("set_hash", F.col("first.id").alias("id"), (F.col("first.m") > 1).alias("repeated"))
    )
    # A class goes by its smallest id, or by a number beyond all ids where that is the id of several.
    alone = F.count("*").over(W.partitionBy("id")) == 1
    other = F.pmod(F.xxhash64("set_hash"), F.lit(BEYOND)) + BEYOND
    sets = sets.withColumn("rep", F.when(alone, F.col("id")).otherwise(other))
    sets = work.cut(sets, "sets")
    classes = every.select("id", "set_hash", "n", "registers", "keys").join(sets, ["id", "set_hash"])
    classes = _once(work.cut(classes, "classes"), "rep")

    # Buckets with more than one class, and the full sets of those in them.
    keys = classes.select(F.explode("keys").alias("key"), "rep", "n")
    counts = keys.groupBy("key").agg(F.count("*").alias("c"), F.sum("n").alias("s")).filter("c > 1")
    crowded = work.cut(keys.join(counts, "key"), "crowded")
    members = work.cut(crowded.select("rep").distinct().join(sets, "rep"), "members")
    asked = _among(docs, id_col, members.select("id"), work, "members")
    full = work.cut(full_sets(asked, members, size, id_col, text_col), "full_sets")
    full = _once(full, "id")

    # Round one: each member with the centre of its bucket.
    weight = crowded.groupBy("rep").agg(F.sum("c").alias("w"))
    weighed = crowded.join(weight, "rep")
    centres = weighed.groupBy("key").agg(
        F.max(F.struct("w", (-F.col("rep")).alias("r"), "n")).alias("x")
    ).select("key", (-F.col("x.r")).alias("centre"), F.col("x.n").alias("m"))
    spokes = (
        crowded.join(centres, "key")
        .filter((F.col("rep") != F.col("centre")) & _sizes_allow(F.col("n"), F.col("m"), percent))
        .select(*_pairs(F.col("rep"), F.col("centre")))
        .distinct()
    )
    spokes = work.cut(spokes, "spokes")
    sketched = _among(classes, "rep", _ends(spokes), work, "spokes")
    passed = work.cut(likely(spokes, sketched, percent), "likely")
    asked = _among(full, "id", _ends(passed), work, "likely")
    first = work.cut(confirmed(passed, asked, percent), "links_first")
    labels = components(first, work, "first")

    # Round two: members of one bucket that are in different components, each with each.
    at = crowded.join(labels, crowded.rep == labels.id, "left").select(
        "key", "rep", "n", "c", "s", F.coalesce("label", "rep").alias("label")
    )
    mixed = (
        at.groupBy("key")
        .agg(F.min("label").alias("low"), F.max("label").alias("high"))
        .filter("low < high")
        .select("key")
    )
    at = work.cut(at.join(mixed, "key", "left_semi"), "mixed")
    # A byte of each register rules out pairs at a fraction of what sets take, and of the buckets that two
    # members share leaves one; then halves of the hashes rule out, exactly, what needs no whole sets.
    sketched = _among(classes.select("rep", "registers"), "rep", at.select("rep"), work, "mixed_sketches")
    short = with_lower_keys(at).join(shortened(sketched), "rep")
    asked = work.cut(likely_in_buckets(short, percent), "likely_mixed")
    at = work.cut(_only(at, asked), "likely_members")
    whole = _among(full.withColumnRenamed("id", "rep"), "rep", at.select("rep"), work, "mixed_sets")
    asked = work.cut(asked_in_buckets(at.join(halved(whole), "rep"), percent), "asked")
    at = work.cut(_only(at, asked), "asked_members")
    sketched = _among(classes.select("rep", "registers"), "rep", at.select("rep"), work, "asked_sketches")
    whole = _among(whole, "rep", at.select("rep"), work, "asked_sets")
    at = at.join(sketched, "rep").join(whole, "rep")
    second = work.cut(links_in_buckets(at, percent), "links_second")
    labels = components(work.cut(first.unionByName(second), "links"), work, "all")

    # Of components with a class that goes by another number, the smallest id.
    odd = sets.filter(F.col("rep") >= BEYOND).select("rep", F.col("id").alias("own"))
    odd = labels.join(odd, labels.id == odd.rep).groupBy("label").agg(F.min("own").alias("own"))
    labels = labels.join(odd, "label", "left").select(
        F.col("id").alias("rep"),
        F.col("label").alias("number"),
        F.coalesce(F.least("label", "own"), "label").alias("label"),
    )
    belongs = every.select("id", "text_key", "set_hash", F.col("n").alias("n_shingles")).join(
        sets.select("set_hash", "rep", F.col("id").alias("own")), "set_hash", "left"
    )
    found = F.coalesce("label", "own", "id")
    return belongs.join(labels, "rep", "left").select(
        "id", "text_key", "set_hash", "n_shingles", F.coalesce("number", "rep").alias("number"),
        found.alias("component_id"),
        F.col("id").eqNullSafe(found).alias("kept"),
    )
