"""Byte-level BPE by one shuffle of distinct words.

Texts fall apart into pre-tokens, most of which occur many times. A block of texts keeps each of its
words once and turns a text into a list of places in the block's words. The words of all blocks, dealt
out by hash, meet in one task each, where a distinct word is merged once. The ids go back to the
blocks, and each text is put together again by its places. Decoding looks the ids up in the table of
token bytes.

Words travel many to a row: a block sends one row to each bucket of words it has, so that a frequent
word is one entry for each block, however often it occurs in it.
"""

from __future__ import annotations

import base64
import heapq
import re
import zlib
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from renalis.llm.common import CUT, map_texts, sized
from renalis.session import Workspace

BLOCK = 24 << 20  # characters of text in a block; a longer text is a block of its own
BUCKETS = 64  # least number of buckets that words are dealt into
KNOWN = 250_000  # words of a bucket that a task keeps, of each of two generations
PLACES = 1 << 19  # places of one row of packed texts
_SPACE = re.compile(r"(?<=\S) (?=\S)")
_TWO_SPACES = re.compile(r"\s\s")


@lru_cache(maxsize=2)
def load_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and their ids, which are also the order of the merges."""
    with open(path, "rb") as f:
        pairs = (line.split() for line in f if line.strip())
        return {base64.b64decode(token): int(rank) for token, rank in pairs}


def merge(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Ids of a word: the neighbours of the lowest rank become one, the leftmost first, to the end."""
    if (whole := ranks.get(word)) is not None:
        return [whole]
    if len(word) > 96:
        return _merge_long(word, ranks)
    get, none = ranks.get, 1 << 60
    parts = [word[i : i + 1] for i in range(len(word))]
    pairs = [get(a + b, none) for a, b in zip(parts, parts[1:])]
    while pairs and (best := min(pairs)) < none:
        i = pairs.index(best)
        parts[i : i + 2] = [parts[i] + parts[i + 1]]
        del pairs[i]
        if i:
            pairs[i - 1] = get(parts[i - 1] + parts[i], none)
        if i < len(pairs):
            pairs[i] = get(parts[i] + parts[i + 1], none)
    return [ranks[p] for p in parts]


def _merge_long(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """As merge(), with a heap of pairs: the time stays near the length."""
    parts: list[bytes | None] = [word[i : i + 1] for i in range(len(word))]
    before, after = list(range(-1, len(parts) - 1)), [*range(1, len(parts)), -1]
    heap: list[tuple[int, int, int]] = []  # rank, place of the left part, length of both

    def offer(i: int) -> None:
        if i >= 0 and (j := after[i]) >= 0:
            both = parts[i] + parts[j]
            if (rank := ranks.get(both)) is not None:
                heapq.heappush(heap, (rank, i, len(both)))

    for i in range(len(parts)):
        offer(i)
    while heap:
        _, i, length = heapq.heappop(heap)
        j = after[i] if parts[i] is not None else -1
        if j < 0 or len(parts[i]) + len(parts[j]) != length:
            continue
        parts[i], parts[j] = parts[i] + parts[j], None
        after[i] = after[j]
        if after[i] >= 0:
            before[after[i]] = i
        offer(i)
        offer(before[i])
    return [ranks[p] for p in parts if p is not None]


def _packed(*arrays: np.ndarray) -> bytes:
    """Integers from 0 to 2^28 - 1 as one compressed string, seven bits to a byte, small ones short."""
    sizes = np.array([len(a) for a in arrays], np.int64)
    values = np.concatenate([sizes, *arrays]).astype(np.int64)
    width = 1 + (values >= 1 << 7) + (values >= 1 << 14) + (values >= 1 << 21)
    ends = np.cumsum(width)
    out = np.empty(ends[-1], np.uint8)
    for k in range(int(width.max())):
        mine = width > k
        out[ends[mine] - 1 - k] = values[mine] >> 7 * k & 127 | (128 if k else 0)
    return zstandard.ZstdCompressor(level=9).compress(out.tobytes())


def _unpacked(data: bytes, arrays: int = 1) -> list[np.ndarray]:
    plain = np.frombuffer(zstandard.ZstdDecompressor().decompress(data), np.uint8)
    last = np.flatnonzero(plain < 128)
    width = np.diff(last, prepend=-1)
    values = plain[last].astype(np.int64)
    for k in range(1, int(width.max())):
        mine = np.flatnonzero(width > k)
        values[mine] |= (plain[last[mine] - k] & 127).astype(np.int64) << 7 * k
    ends = arrays + np.cumsum(values[:arrays])
    return [values[a:b] for a, b in zip([arrays, *ends[:-1]], ends)]


def _packed_words(words: list[bytes]) -> bytes:
    sizes = _packed(np.array([len(w) for w in words], np.uint32))
    body = zstandard.ZstdCompressor(level=9).compress(b"".join(words))
    return len(sizes).to_bytes(4, "little") + sizes + body


def _unpacked_words(data: bytes) -> list[bytes]:
    head = 4 + int.from_bytes(data[:4], "little")
    ends = np.cumsum(_unpacked(data[4:head])[0].astype(np.int64)).tolist()
    body = zstandard.ZstdDecompressor().decompress(data[head:])
    return [body[a:b] for a, b in zip([0, *ends[:-1]], ends)]


class _Lumps(dict):
    """Codes of strings that no pre-token crosses the ends of: the number of the only word, or
    -1 - an entry of `several`. The strings are those after a space, which belongs to them."""

    def __init__(self, pattern: str):
        super().__init__()
        self.find = regex.compile(pattern).findall
        self.numbers: dict[str, int] = {}
        self.several: list[np.ndarray] = []

    def code(self, text: str) -> int:
        numbers = self.numbers
        found = [numbers.setdefault(w, len(numbers)) for w in self.find(text)]
        if len(found) == 1:
            return found[0]
        self.several.append(np.array(found, np.int64))
        return -len(self.several)

    def __missing__(self, text: str) -> int:
        code = self.code(" " + text)
        if len(text) < 64:
            self[text] = code
        return code


class _Block:
    """Words of some texts, numbered as met, and the texts as lists of those numbers."""

    def __init__(self, pattern: str):
        self.lumps = _Lumps(pattern)
        self.ids: list[object] = []
        self.texts: list[np.ndarray] = []
        self.chars = 0

    def add(self, id_: object, text: str) -> None:
        self.chars += len(text)
        self.ids.append(id_)
        parts = []
        # A space between two characters that are none begins a pre-token whatever stands around.
        for k, piece in enumerate(_spaced(text)):
            strings = piece.split(" ") if not _TWO_SPACES.search(piece) else _SPACE.split(piece)
            codes = np.fromiter(map(self.lumps.__getitem__, strings), np.int64, len(strings))
            if k == 0:  # no space before the very first
                codes[0] = self.lumps.code(strings[0])
            parts.append(self._numbers(codes))
        self.texts.append(np.concatenate(parts).astype(np.int32))

    def _numbers(self, codes: np.ndarray) -> np.ndarray:
        odd = np.flatnonzero(codes < 0)
        if not len(odd):
            return codes
        lists = [self.lumps.several[-1 - c] for c in codes[odd].tolist()]
        sizes = np.ones(len(codes), np.int64)
        sizes[odd] = [len(x) for x in lists]
        out = np.repeat(codes, sizes)
        out[out < 0] = np.concatenate(lists)
        return out

    def rows(self, block: int, buckets: int) -> Iterator[tuple]:
        """(block, bucket, number, ids, data): words for each bucket, then the texts, many to a row.

        A word's place is its rank by frequency in its bucket, times the number of buckets, plus the
        bucket: frequent words have small places, which compress well, and places need no list.
        """
        self.lumps.clear()
        self.lumps.several.clear()
        words = [w.encode("utf-8") for w in self.lumps.numbers]
        self.lumps.numbers.clear()
        bucket = np.fromiter((zlib.crc32(w) % buckets for w in words), np.int64, len(words))
        sizes = np.array([len(t) for t in self.texts], np.int64)
        numbers = np.concatenate(self.texts)
        self.texts.clear()
        counts = np.zeros(len(words), np.int64)
        for a in range(0, len(numbers), PLACES):
            counts += np.bincount(numbers[a : a + PLACES], minlength=len(words))
        # Words of one frequency are sorted, so that neighbours begin alike.
        by_name = np.array(sorted(range(len(words)), key=words.__getitem__), np.int64)
        order = by_name[np.lexsort((-counts[by_name], bucket[by_name]))]
        starts = np.searchsorted(bucket[order], np.arange(buckets + 1))
        rank = np.empty(len(words), np.int64)
        rank[order] = np.arange(len(words)) - starts[bucket[order]]
        place = rank * buckets + bucket
        for b in range(buckets):
            if starts[b] < starts[b + 1]:
                mine = order[starts[b] : starts[b + 1]].tolist()
                yield block, b, None, None, _packed_words([words[i] for i in mine])
        ends = np.cumsum(sizes)
        cut = np.flatnonzero(np.diff((ends - sizes) // PLACES, prepend=-1)).tolist()
        for number, (a, b) in enumerate(zip(cut, [*cut[1:], len(sizes)])):
            mine = numbers[ends[a] - sizes[a] : ends[b - 1]]
            yield block, None, number, self.ids[a:b], _packed(sizes[a:b], place[mine])


def _spaced(text: str) -> Iterator[str]:
    """The text cut at spaces between two characters that are none, about CUT characters apart."""
    start = 0
    while len(text) - start > CUT and (space := _SPACE.search(text, start + CUT)):
        yield text[start : space.start()]
        start = space.end()
    yield text[start:]


class _Ids(dict):
    """Ids of the words a task has met, each merged once; memory holds two generations of them."""

    def __init__(self, ranks: dict[bytes, int]):
        super().__init__()
        self.ranks, self.older = ranks, {}

    def __missing__(self, word: bytes) -> list[int]:
        if len(self) >= KNOWN:
            self.older = dict(self)
            self.clear()
        ids = self.older.get(word) or merge(word, self.ranks)
        self[word] = ids
        return ids


def encode(
    docs: DataFrame,
    path: str,
    work: Workspace,
    id_col: str = "doc_id",
    text_col: str = "text",
    pattern: str = public_tokenizers.PATTERN,
    buckets: int | None = None,
) -> DataFrame:
    """id, ids (array<int>) of every row's whole text, special strings taken as ordinary text.

    A null or empty text has no ids. Ids of rows are passed through, null or repeated; an empty table
    gives no rows; other columns are not read. Blocks of texts are written once, so that their words
    and their texts agree whatever order the rows came in. `buckets` (at least the number of shuffle
    partitions, if not given) bounds the words that meet in a task.
    """
    spark = docs.sparkSession
    sized(spark)
    n = buckets or max(BUCKETS, int(spark.conf.get("spark.sql.shuffle.partitions")))
    kind = docs.schema[id_col].dataType.simpleString()
    sent = spark.sparkContext.broadcast(load_ranks(path))  # a fixed vocabulary
    columns = ["block", "bucket", "number", "ids", "data"]

    def batch_of(rows: list[tuple], types: list[pa.DataType], names: list[str]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, made, block = TaskContext.get().partitionId() << 24, 0, _Block(pattern)
        types = None

        def ended() -> Iterator[pa.RecordBatch]:
            rows, size = [], 0
            for row in block.rows(base + made, n):
                rows.append(row)
                size += len(row[-1])
                if size > 4 << 20 or len(rows) > 2000:
                    yield batch_of(rows, types, columns)
                    rows, size = [], 0
            if rows:
                yield batch_of(rows, types, columns)

        for batch in batches:
            types = [pa.int64(), pa.int32(), pa.int32(), pa.list_(batch.column(0).type), pa.binary()]
            for id_, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                block.add(id_, text.as_py() or "")
                if block.chars >= BLOCK:
                    yield from ended()
                    made, block = made + 1, _Block(pattern)
        if block.texts:
            yield from ended()

    split_up = work.cut(
        docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(
            split, f"block long, bucket int, number int, ids array<{kind}>, data binary"
        ),
        "byte_bpe_blocks",
    )

    def merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, current = _Ids(sent.value), None
        for batch in batches:
            data = []
            for bucket, packed in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                if bucket != current:
                    known, current = _Ids(sent.value), bucket
                found = [known[w] for w in _unpacked_words(packed)]
                sizes = np.fromiter(map(len, found), np.int64, len(found))
                ids = np.fromiter(chain.from_iterable(found), np.int64, int(sizes.sum()))
                data.append(_packed(sizes, ids))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(data, pa.binary())],
                ["block", "bucket", "data"],
            )

    words = split_up.filter("number is null").select("block", "bucket", "data")
    words = words.repartition("bucket").sortWithinPartitions("bucket")
    words = words.mapInArrow(merged, "block long, bucket int, data binary")
    texts = split_up.filter("number is not null").select("block", "number", "ids", "data")
    both = (
        words.unionByName(texts, allowMissingColumns=True)
        .repartition("block")
        .sortWithinPartitions("block", F.asc_nulls_first("number"), "bucket")
        .select("block", "bucket", "number", "ids", "data")
    )

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, ready = None, False
        parts: list[tuple[int, np.ndarray, np.ndarray]] = []
        flat = starts = sizes = np.empty(0, np.int64)
        for batch in batches:
            lists = batch.column(3)
            for row, (block, bucket, number) in enumerate(
                zip(*(batch.column(k).to_pylist() for k in range(3)))
            ):
                data = batch.column(4)[row].as_py()
                if block != current:
                    current, parts, ready = block, [], False
                if number is None:
                    parts.append((bucket, *_unpacked(data, 2)))
                    continue
                if not ready:
                    flat, starts, sizes = _by_place(parts, n)
                    parts, ready = [], True
                words, place = _unpacked(data, 2)
                count = sizes[place]
                ends = np.concatenate([[0], np.cumsum(count)])
                ids = flat[np.repeat(starts[place] - ends[:-1], count) + np.arange(ends[-1])]
                bounds = ends[np.concatenate([[0], np.cumsum(words)])].astype(np.int32)
                found = pa.ListArray.from_arrays(pa.array(bounds), pa.array(ids, pa.int32()))
                yield pa.RecordBatch.from_arrays(
                    [lists.slice(row, 1).flatten(), found], ["id", "ids"]
                )

    return both.mapInArrow(joined, f"id {kind}, ids array<int>").withColumnRenamed("id", id_col)


def _by_place(
    parts: list[tuple[int, np.ndarray, np.ndarray]], buckets: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """All ids of a block's words; where those of each place start, and how many they are."""
    ranks = max((len(size) for _, size, _ in parts), default=0)
    starts, sizes = (np.zeros(ranks * buckets, np.int64) for _ in range(2))
    before = 0
    for bucket, size, ids in parts:
        places = np.arange(len(size)) * buckets + bucket
        sizes[places] = size
        starts[places] = before + np.cumsum(size, dtype=np.int64) - size
        before += len(ids)
    flat = np.concatenate([p[2] for p in parts]) if parts else np.empty(0, np.int64)
    return flat.astype(np.int32), starts, sizes


def decode(
    encoded: DataFrame, path: str, id_col: str = "doc_id", ids_col: str = "ids"
) -> DataFrame:
    """id, ids, decoded (binary): the ids joined with the table of token bytes, in their order.

    The table is that of a fixed vocabulary and goes to every task. Bytes of no ids, or of null, are
    empty; an id that the vocabulary does not hold is an error.
    """
    spark = encoded.sparkSession
    sized(spark)
    ranks = load_ranks(path)
    table: list[bytes | None] = [None] * (max(ranks.values()) + 1)
    for token, rank in ranks.items():
        table[rank] = token
    sent = spark.sparkContext.broadcast(pa.array(table, pa.large_binary()))
    kind = encoded.schema[id_col].dataType.simpleString()

    def look_up(batch: pa.RecordBatch) -> pa.RecordBatch:
        ids = batch.column(1)
        flat = ids.flatten()
        found = sent.value.take(flat)
        if found.null_count:
            raise ValueError("an id that is not in the vocabulary")
        sizes = np.diff(np.frombuffer(found.buffers()[1], np.int64)[: len(found) + 1])
        ends = np.concatenate([[0], np.cumsum(sizes)])
        each = np.array(ids.value_lengths().fill_null(0), np.int64)
        bounds = ends[np.concatenate([[0], np.cumsum(each)])]
        buffers = [None, pa.py_buffer(bounds.astype(np.int64)), found.buffers()[2]]
        decoded = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(batch), buffers)
        return pa.RecordBatch.from_arrays(
            [batch.column(0), ids, decoded.cast(pa.binary())], [id_col, ids_col, "decoded"]
        )

    schema = f"`{id_col}` {kind}, `{ids_col}` array<int>, decoded binary"
    return map_texts(encoded, [id_col, ids_col], look_up, schema)


def digests(decoded: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """id, n_tokens, ids_sha256 (decimal ids joined by a space), decoded_sha256."""
    return decoded.select(
        id_col,
        F.coalesce(F.size("ids"), F.lit(0)).cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
