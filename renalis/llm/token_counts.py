"""Token counts without tokens: whole-token shortcut for a byte-level BPE with word ends.

Most words of a text are one token each. Which strings of the vocabulary always come out as exactly
one token is proved once, ahead of the run, by applying the merges to every one of them. A pre-token
that is such a string counts one; only the rest is merged, and each distinct string once per worker.

Tables and pattern come from the tokenizer's file; normalization and special strings follow it.
"""

from __future__ import annotations

import json
import unicodedata
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from renalis.llm.common import claim, cuts, map_texts, sized

CACHE = 700_000  # strings of either kind whose counts a worker keeps
LIMIT = 2048
# What split() takes for white space and the pattern does not.
_ODD_SPACE = "\x1c\x1d\x1e\x1f"


def byte_letters() -> list[str]:
    """The letter that stands for each byte: itself where printable, else one from 256 upwards."""
    own = {*range(33, 127), *range(161, 173), *range(174, 256)}
    others = (b for b in range(256) if b not in own)
    letter = {b: chr(b) for b in own} | {b: chr(256 + i) for i, b in enumerate(others)}
    return [letter[b] for b in range(256)]


def merged(symbols: list[str], ranks: dict[tuple[str, str], int]) -> list[str]:
    """The symbols after all merges: always the pair of the lowest rank, the leftmost first."""
    get, none = ranks.get, len(ranks)
    pairs = [get(p, none) for p in zip(symbols, symbols[1:])]
    while pairs and (best := min(pairs)) < none:
        i = pairs.index(best)
        symbols[i : i + 2] = [symbols[i] + symbols[i + 1]]
        del pairs[i]
        if i:
            pairs[i - 1] = get((symbols[i - 1], symbols[i]), none)
        if i < len(pairs):
            pairs[i] = get((symbols[i], symbols[i + 1]), none)
    return symbols


@dataclass
class Vocabulary:
    whole: frozenset[str]  # pre-tokens proved to be one token
    ranks: dict[tuple[str, str], int]
    letters: list[str]
    end: str
    pattern: str
    specials: list[str]
    key: str

    def symbols(self, pre_token: str) -> list[str]:
        found = [self.letters[b] for b in pre_token.encode("utf-8", "replace")]
        found[-1] += self.end
        return found

    def count(self, pre_token: str) -> int:
        return 1 if pre_token in self.whole else len(merged_long(self.symbols(pre_token), self.ranks))


def merged_long(symbols: list[str], ranks: dict[tuple[str, str], int]) -> list[str]:
    """As merged(); for long strings by a heap, so that the time stays near the length."""
    if len(symbols) <= 128:
        return merged(symbols, ranks)
    import heapq

    text: list[str | None] = list(symbols)
    left, right = list(range(-1, len(text) - 1)), [*range(1, len(text)), -1]
    heap = [
        (r, i) for i, p in enumerate(zip(symbols, symbols[1:])) if (r := ranks.get(p, -1)) >= 0
    ]
    heapq.heapify(heap)
    while heap:
        rank, i = heapq.heappop(heap)
        j = right[i] if text[i] is not None else -1
        if j < 0 or ranks.get((text[i], text[j]), -1) != rank:
            continue
        text[i], text[j] = text[i] + text[j], None
        right[i] = right[j]
        if right[i] >= 0:
            left[right[i]] = i
            if (r := ranks.get((text[i], text[right[i]]), -1)) >= 0:
                heapq.heappush(heap, (r, i))
        if left[i] >= 0 and (r := ranks.get((text[left[i]], text[i]), -1)) >= 0:
            heapq.heappush(heap, (r, left[i]))
    return [t for t in text if t is not None]


@lru_cache(maxsize=2)
def prove(path: str) -> Vocabulary:
    """Reads a tokenizer file and finds the strings that encode alone as one token.

    A vocabulary entry with the word end is a whole token if the merges, applied to its bytes, end in
    that entry alone and its letters stand for valid UTF-8 that the pattern leaves in one piece.
    """
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    model = spec["model"]
    steps = [s.get("type") for s in spec["normalizer"]["normalizers"]]
    if steps != ["NFC", "Replace", "Lowercase"] or model["unk_token"] or model["dropout"]:
        raise ValueError(f"{path}: not a lower-casing BPE with word ends")
    end, letters = model["end_of_word_suffix"], byte_letters()
    ranks = {tuple(pair): i for i, pair in enumerate(model["merges"])}
    pattern = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
    byte = {letter: b for b, letter in enumerate(letters)}
    whole = set()
    for entry in model["vocab"]:
        body = entry[: -len(end)] if entry.endswith(end) else ""
        if not body:
            continue
        try:
            word = bytes(byte[c] for c in body).decode("utf-8")
        except (KeyError, UnicodeDecodeError):
            continue
        symbols = [*body[:-1], body[-1] + end]
        if merged(symbols, ranks) == [entry] and regex.findall(pattern, word) == [word]:
            whole.add(word)
    specials = [t["content"] for t in spec["added_tokens"]]
    return Vocabulary(frozenset(whole), ranks, letters, end, pattern, specials, path)


def normalized(text: str) -> str:
    """NFC, then lower case character by character: a final sigma gets no form of its own.

    White space needs no step: the pattern drops it.
    """
    return unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()


class _Strings(dict):
    """Tokens of each pre-token; whole tokens from the start, the rest as met."""

    def __init__(self, vocabulary: Vocabulary):
        super().__init__(dict.fromkeys(vocabulary.whole, 1))
        self.vocabulary = vocabulary

    def __missing__(self, pre_token: str) -> int:
        n = self[pre_token] = self.vocabulary.count(pre_token)
        return n


class _Counts(dict):
    """Tokens of each string between white space, which no pre-token crosses."""

    def __init__(self, vocabulary: Vocabulary):
        super().__init__()
        self.vocabulary = vocabulary
        self.strings = _Strings(vocabulary)
        self.find = regex.compile(vocabulary.pattern).findall
        self.split = regex.compile("|".join(map(regex.escape, vocabulary.specials))).split

    def __missing__(self, chunk: str) -> int:
        n = sum(map(self.strings.__getitem__, self.find(normalized(chunk))))
        if len(chunk) < 64:
            self[chunk] = n
        return n

    def tokens(self, text: str) -> int:
        parts = self.split(text) if any(s in text for s in self.vocabulary.specials) else [text]
        total = len(parts) - 1  # each special string is one token
        for part in parts:
            for piece in cuts(part):
                if any(c in piece for c in _ODD_SPACE):
                    total += self.__missing__(piece)
                else:
                    total += sum(map(self.__getitem__, piece.split()))
        if len(self) > CACHE:
            self.clear()
        if len(self.strings) > CACHE:
            self.strings = _Strings(self.vocabulary)
        return total


_workers: dict[str, _Counts] = {}


def count_tokens(
    docs: DataFrame, vocabulary: Vocabulary, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """id, n_bytes, n_tokens, over_limit of every row's whole text.

    A null text counts as empty: no bytes, no tokens. Special strings of the tokenizer inside a text
    are one token each. Ids are passed through, null or repeated; other columns are not read.
    """
    spark = docs.sparkSession
    sized(spark)
    sent = spark.sparkContext.broadcast(vocabulary)  # a fixed vocabulary of 49,000 strings

    def convert(batch: pa.RecordBatch) -> pa.RecordBatch:
        claim("token_counts", _workers.clear)
        key = sent.value.key
        counts = _workers.get(key)
        if counts is None:
            _workers.clear()
            counts = _workers[key] = _Counts(sent.value)
        n_bytes, n_tokens = [], []
        for text in batch.column(1).to_pylist():
            n_bytes.append(len(text.encode("utf-8")) if text else 0)
            n_tokens.append(counts.tokens(text) if text else 0)
        over = np.array(n_tokens, np.int64) > LIMIT
        return pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                pa.array(n_bytes, pa.int64()),
                pa.array(n_tokens, pa.int64()),
                pa.array(over, pa.bool_()),
            ],
            [id_col, "n_bytes", "n_tokens", "over_limit"],
        )

    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"`{id_col}` {kind}, n_bytes long, n_tokens long, over_limit boolean"
    return map_texts(docs, [id_col, text_col], convert, schema)
