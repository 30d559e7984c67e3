"""Benchmark decontamination by greedy string tiling.

A document is compared with each test item that shares a run of words with it. The longest common
passages are marked first, no word twice, until only runs below the least length are left; the share
of the item's words under tiles is its coverage. Tiles may stand in any order, so a passage whose
sentences were moved about is covered as well as one copied whole.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from renalis.llm.common import Chunks, claim, sized

SEED = 5  # words of a shared run, and of the shortest tile
COVERAGE = 0.8  # share of a test item under tiles from which a document counts as contaminated
BLOCK_WORDS = 2_000_000  # words of the items that a worker holds at a time
_BASE = np.uint64(0x9E3779B97F4A7C15)
# Ranges of the scripts that put no spaces between words (South-East Asian ones, kana, Han).
_UNSPACED = "\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\U00020000-\U0003ffff"
_WORDS = re.compile(rf"[{_UNSPACED}]|[^\W{_UNSPACED}]+")
Tile = tuple[int, int, int]  # start in the document, start in the item, words


def words_of(text: str) -> list[str]:
    """Runs of letters and digits in lower case; of scripts without spaces, each character."""
    return _WORDS.findall(text.lower())


def run_hashes(ids: np.ndarray, size: int) -> np.ndarray:
    """Karp-Rabin hashes of all runs of `size` words, those of longer runs from shorter ones."""
    h, have, power = ids.astype(np.uint64), 1, int(_BASE)
    parts: list[tuple[np.ndarray, int, int]] = []  # hashes of runs of 1, 2, 4 ... words
    while True:
        parts.append((h, have, power))
        if 2 * have > size:
            break
        h = h[:-have] * np.uint64(power) + h[have:]
        have, power = 2 * have, power * power % (1 << 64)
    n = len(ids) - size + 1
    out, at = np.zeros(max(n, 0), np.uint64), 0
    for h, have, power in reversed(parts):
        if size & have:
            out = out * np.uint64(power) + h[at : at + len(out)]
            at += have
    return out


def tiles(doc: np.ndarray, item: np.ndarray, least: int = SEED) -> list[Tile]:
    """Greedy tiling of word ids: longest matches first, ties by place in the item, then document.

    Each round takes all maximal matches of the greatest length among unmarked words. The length to
    look for is found by halving over running hashes; equal hashes are confirmed word by word.
    """
    doc_free, item_free = np.ones(len(doc), bool), np.ones(len(item), bool)
    found: list[Tile] = []

    def unmarked(size: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """Places and hashes of the unmarked runs of this size, of the item and of the document."""
        out = []
        for ids, free in ((item, item_free), (doc, doc_free)):
            ends = np.cumsum(np.append(0, ~free))
            at = np.flatnonzero(ends[size:] == ends[: len(ends) - size])
            out.append((at, run_hashes(ids, size)[at]))
        return out

    def same(i: int, j: int, size: int) -> bool:
        return np.array_equal(item[i : i + size], doc[j : j + size])

    def matches(size: int) -> bool:
        """Whether any unmarked runs of this size are equal."""
        (at, hashes), (doc_at, doc_hashes) = unmarked(size)
        common, i, j = np.intersect1d(hashes, doc_hashes, return_indices=True)
        if not len(common):
            return False
        if same(int(at[i[0]]), int(doc_at[j[0]]), size):
            return True
        return any(  # a hash that two runs share by accident
            same(x, y, size)
            for h in common
            for x in at[hashes == h].tolist()
            for y in doc_at[doc_hashes == h].tolist()
        )

    def mark(size: int) -> None:
        """Marks equal runs by place in the item; each takes the first place in the document left.

        Places that are marked stay so, and each run's list of places is walked once, however often
        the run is repeated.
        """
        (at, hashes), (doc_at, doc_hashes) = unmarked(size)
        hit = np.isin(doc_hashes, hashes)
        places = defaultdict(list)
        for j, h in zip(doc_at[hit].tolist(), doc_hashes[hit].tolist()):
            places[h].append(j)
        next_place = dict.fromkeys(places, 0)
        for i, h in zip(at.tolist(), hashes.tolist()):
            if h not in places or not item_free[i : i + size].all():
                continue
            mine, k = places[h], next_place[h]
            while k < len(mine) and not (doc_free[mine[k]] and doc_free[mine[k] : mine[k] + size].all()):
                k += 1
            next_place[h] = k
            while k < len(mine) and not (
                doc_free[mine[k] : mine[k] + size].all() and same(i, mine[k], size)
            ):
                k += 1
            if k < len(mine):
                j = mine[k]
                item_free[i : i + size] = doc_free[j : j + size] = False
                found.append((j, i, size))

    longest = min(len(doc), len(item))
    while longest >= least:
        low, high = least - 1, longest
        while low < high:  # the greatest length with a match
            size = (low + high + 1) // 2
            low, high = (size, high) if matches(size) else (low, size - 1)
        if low < least:
            break
        mark(low)
        longest = low
    return found


@dataclass
class Block:
    """Some test items, indexed by the hashes of their seeds."""

    items: list[tuple[object, np.ndarray]]  # id, word ids
    words: dict[str, int]
    least: int
    seeds: np.ndarray  # sorted hashes
    owner: np.ndarray  # the item and the place of each seed
    place: np.ndarray
    short: dict[int, dict[int, list[int]]]  # words, hash, items of so few words

    @classmethod
    def of(cls, rows: list[tuple[object, str | None]], least: int = SEED) -> Block:
        """Items of fewer words than a seed have one seed, all of their words."""
        words: dict[str, int] = {}
        items, hashes, owner, place = [], [], [], []
        short: dict[int, dict[int, list[int]]] = defaultdict(lambda: defaultdict(list))
        for id_, text in rows:
            found = words_of(text or "")
            if not found:
                continue
            ids = np.array([words.setdefault(w, len(words) + 1) for w in found], np.int64)
            if len(ids) < least:
                short[len(ids)][int(run_hashes(ids, len(ids))[0])].append(len(items))
                items.append((id_, ids))
                continue
            hashes.append(run_hashes(ids, least))
            owner.append(np.full(len(hashes[-1]), len(items)))
            place.append(np.arange(len(hashes[-1])))
            items.append((id_, ids))
        none = np.empty(0, np.int64)
        seeds = np.concatenate(hashes) if hashes else none.astype(np.uint64)
        order = np.argsort(seeds, kind="stable")
        owner, place = (np.concatenate(x) if x else none for x in (owner, place))
        plain = {n: dict(of) for n, of in short.items()}
        return cls(items, words, least, seeds[order], owner[order], place[order], plain)

    def number(self, word: str) -> int:
        """Id of a document's word; all words that no item has are 0."""
        return self.words.get(word, 0)

    def candidates(self, doc: np.ndarray, coverage: float) -> list[int]:
        """Items whose words under shared seeds reach the coverage: every tile lies under seeds."""
        if len(doc) < self.least or not len(self.seeds):
            return []
        hashes = run_hashes(doc, self.least)
        left = np.searchsorted(self.seeds, hashes, "left")
        hit = self.seeds[np.minimum(left, len(self.seeds) - 1)] == hashes
        if not hit.any():
            return []
        hashes = np.unique(hashes[hit])
        left = np.searchsorted(self.seeds, hashes, "left")
        right = np.searchsorted(self.seeds, hashes, "right")
        rows = np.concatenate([np.arange(a, b) for a, b in zip(left, right)])
        under = defaultdict(set)
        for o, p in zip(self.owner[rows].tolist(), self.place[rows].tolist()):
            under[o].update(range(p, p + self.least))
        return [o for o, s in under.items() if len(s) >= coverage * len(self.items[o][1])]


    def whole(self, doc: np.ndarray) -> Iterator[tuple[int, Tile]]:
        """Items of fewer words than a seed that stand in the document, where they do first."""
        for n, items in self.short.items():
            hashes = run_hashes(doc, n)
            for at in np.flatnonzero(np.isin(hashes, np.fromiter(items, np.uint64, len(items)))):
                for item in items[int(hashes[at])]:
                    if np.array_equal(self.items[item][1], doc[at : at + n]):
                        yield item, (int(at), 0, n)


_workers: dict[int, Chunks] = {}


def _ids(text: str, block: Block) -> np.ndarray:
    """Word ids of a text; the worker keeps those of strings it has met."""
    claim("tiling", _workers.clear)
    found = _workers.get(id(block))
    if found is None:
        _workers.clear()
        found = _workers[id(block)] = Chunks(words_of, block.number)
    return found.ids(text)


def compare(
    text: str | None, block: Block, coverage: float = COVERAGE, short: bool = True
) -> Iterator[tuple[object, float, list[Tile]]]:
    """(item id, coverage, tiles) of the items that the text covers far enough.

    With `short`, also items of fewer words than a seed, which the text must hold as they are.
    """
    if not text:
        return
    doc = _ids(text, block)
    for n in block.candidates(doc, coverage):
        id_, item = block.items[n]
        found = tiles(doc, item, block.least)
        share = sum(size for _, _, size in found) / len(item)
        if share >= coverage:
            yield id_, share, found
    for n, tile in dict(reversed([*block.whole(doc)])).items() if short else ():
        yield block.items[n][0], 1.0, [tile]


def blocks(
    spark: SparkSession,
    items: DataFrame,
    id_col: str,
    text_col: str,
    least: int = SEED,
    most: int = BLOCK_WORDS,
) -> Iterator[Block]:
    """The items in blocks of about `most` words, so that each can be sent to the workers.

    The number of blocks comes from the size of the whole table; a benchmark has one as a rule.
    """
    rows = items.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    words = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = int(words // (4 * most)) + 1
    for i in range(n):
        part = rows if n == 1 else rows.filter(F.pmod(F.xxhash64("id", "text"), F.lit(n)) == i)
        yield Block.of([(r["id"], r["text"]) for r in part.collect()], least)


def contaminated(
    docs: DataFrame,
    items: DataFrame,
    least: int = SEED,
    coverage: float = COVERAGE,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_id_col: str = "item_id",
    item_text_col: str = "text",
) -> DataFrame:
    """(id, item id, coverage, n_tiles, longest_tile) for each document and item it covers.

    Every whole text is compared with every item. Null and empty texts and items match nothing; words
    are runs of letters and digits in lower case, and single characters of scripts without spaces. Of an
    item of fewer than `least` words all must stand in the text in a row. Long runs of one word, or of a
    repeated phrase, are tiled like others, in time that stays near the lengths. Rows with equal ids or texts are compared each for itself, as are repeated items. Other columns are not
    read.
    """
    spark = docs.sparkSession
    sized(spark)
    kinds = [
        frame.schema[c].dataType.simpleString() for frame, c in ((docs, id_col), (items, item_id_col))
    ]
    schema = (
        f"`{id_col}` {kinds[0]}, `{item_id_col}` {kinds[1]}, "
        "coverage double, n_tiles long, longest_tile long"
    )
    out = None
    types = [
        *(to_arrow_type(f.schema[c].dataType) for f, c in ((docs, id_col), (items, item_id_col))),
        pa.float64(), pa.int64(), pa.int64(),
    ]
    names = [id_col, item_id_col, "coverage", "n_tiles", "longest_tile"]
    for block in blocks(spark, items, item_id_col, item_text_col, least):
        sent = spark.sparkContext.broadcast(block)

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                rows = [
                    (id_.as_py(), item, share, len(found), max(t[2] for t in found))
                    for id_, text in zip(batch.column(0), batch.column(1).to_pylist())
                    for item, share, found in compare(text, sent.value, coverage)
                ]
                if rows:
                    columns = [pa.array(c, t) for c, t in zip(zip(*rows), types)]
                    yield pa.RecordBatch.from_arrays(columns, names)

        found = docs.select(id_col, text_col).mapInArrow(run, schema)
        out = found if out is None else out.unionByName(found)
    return out


def clean(
    docs: DataFrame,
    items: DataFrame,
    text_col: str = "text",
    least: int = SEED,
    coverage: float = COVERAGE,
) -> DataFrame:
    """The rows of docs that cover no item, all columns as they are; null texts stay.

    Items of fewer than `least` words take no document away, as clean texts hold them as well. The verdict is a matter of the text alone, so it is made where the row is, without a shuffle.
    """
    spark = docs.sparkSession
    sized(spark)
    at = docs.columns.index(text_col)
    out = docs
    for block in blocks(spark, items, "item_id", "text", least):
        sent = spark.sparkContext.broadcast(block)

        def run(batches: Iterator[pa.RecordBatch], sent=sent) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                texts = batch.column(at).to_pylist()
                found = (next(compare(t, sent.value, coverage, False), None) for t in texts)
                keep = [f is None for f in found]
                yield batch.filter(pa.array(keep, pa.bool_()))

        out = out.mapInArrow(run, docs.schema)
    return out
