"""What several of the text operators share: reading tables, Arrow maps, cutting long texts."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Texts longer than this are walked in cuts at white space, so that lists of words stay small.
CUT = 1 << 20
_SPACE = " \t\n\r"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cuts(text: str, size: int = CUT) -> Iterator[str]:
    """The whole text in pieces of about `size` characters, each but the last ending in white space.

    A piece without any white space grows until there is some, so no word is ever cut.
    """
    start, n = 0, len(text)
    while n - start > size:
        ends = [e for s in _SPACE if (e := text.find(s, start + size)) >= 0]
        if not ends:
            break
        yield text[start : min(ends) + 1]
        start = min(ends) + 1
    yield text[start:] if start else text


class Chunks(dict):
    """Ids of words, looked up by the strings between white space that hold them.

    Splitting at white space is far cheaper than finding words, and most strings hold one word, so a
    string's words are found once and their ids kept: one id as it is, several or none as an entry of
    a list. A worker keeps `most` strings and then starts anew. Words must not contain white space;
    those numbered below 0 are left out.
    """

    def __init__(
        self, words_of: Callable[[str], list[str]], number: Callable[[str], int], most: int = 300_000
    ):
        super().__init__()
        self.words_of, self.number, self.most = words_of, number, most
        self.several: list[np.ndarray] = []

    def __missing__(self, chunk: str) -> int:
        ids = [i for i in map(self.number, self.words_of(chunk)) if i >= 0]
        if len(ids) == 1:
            code = ids[0]
        else:
            self.several.append(np.array(ids, np.int64))
            code = -len(self.several)
        self[chunk] = code
        return code

    def ids(self, text: str) -> np.ndarray:
        if len(self) > self.most:
            self.clear()
            self.several = []
        parts = []
        for piece in cuts(text):
            chunks = piece.split()
            codes = np.fromiter(map(self.__getitem__, chunks), np.int64, len(chunks))
            odd = np.flatnonzero(codes < 0)
            if len(odd):
                lists = [self.several[-1 - c] for c in codes[odd].tolist()]
                sizes = np.ones(len(codes), np.int64)
                sizes[odd] = [len(x) for x in lists]
                codes = np.repeat(codes, sizes)
                codes[codes < 0] = np.concatenate(lists)
            parts.append(codes)
        return np.concatenate(parts)


_claims: dict[str, Callable[[], None]] = {}


def claim(name: str, clear: Callable[[], None]) -> None:
    """Says that a worker now serves this operator: what it keeps for others is dropped.

    Workers outlive the stages of a pipeline, and their memory is that of one operator at a time.
    """
    if name not in _claims:
        for drop in _claims.values():
            drop()
        _claims.clear()
        trim()
        _claims[name] = clear


def trim() -> None:
    """Gives memory that a worker has freed back to the machine, which it shares with the executor."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    if give_back := getattr(ctypes.CDLL(None), "malloc_trim", None):  # there with glibc only
        give_back(0)


def map_texts(
    df: DataFrame,
    columns: list[str],
    convert: Callable[[pa.RecordBatch], pa.RecordBatch | None],
    schema: str,
) -> DataFrame:
    """`convert` over Arrow batches of the named columns; Spark bounds a batch by rows and bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows and (out := convert(batch)) is not None:
                yield out

    return df.select(*columns).mapInArrow(run, schema)


def sized(spark: SparkSession, records: int = 2000) -> None:
    """Bounds for Arrow batches: long texts make a batch large before rows do."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(records))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(16 << 20))


def utf8_size(column: str) -> F.Column:
    return F.coalesce(F.octet_length(F.col(column)), F.lit(0)).cast("long")
