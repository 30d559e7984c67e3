"""Encoding and decoding with the pieces of a SentencePiece BPE model, by suffix-array matching.

The distinct strings of a batch are put one after the other and their suffixes sorted. Every piece of
the vocabulary is then found by binary search as a range of suffixes, which gives all its occurrences
at once: the edges of a lattice. Sorted by where they end, they are relaxed in order: an edge reaches
its end if the piece may follow the one that reached its start.

"May follow" makes this exact for byte-pair encoding. The pieces of a text are the one sequence in
which every two neighbours, encoded alone, stay as they are: no merge ever crossed their border. That
is decided from the order of the merges that made the two pieces.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from renalis.llm.common import CUT, claim, map_texts, sized, trim

SPACE = "▁"
BLOCK = 1 << 18  # characters that are indexed at a time
CACHE = 100_000  # strings whose pieces a worker keeps, of each of two generations
_BORDER = 0x110000  # stands between strings; no character has this code
# No piece has a space after another character, so no merge crosses such a border.
_STRINGS = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")


class Pieces:
    """The vocabulary: strings, the order of their merges, and how each was made."""

    def __init__(self, path: str):
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = model.get_piece_size()
        self.names = [model.id_to_piece(i) for i in range(n)]
        self.bytes = {int(self.names[i][3:5], 16): i for i in range(n) if model.is_byte(i)}
        self.byte = {i: b for b, i in self.bytes.items()}
        self.shown = [name.replace(SPACE, " ") for name in self.names]
        normal = [
            i for i in range(n)
            if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i))
        ]
        if any(SPACE in self.names[i].lstrip(SPACE) for i in normal) or len(self.bytes) != 256:
            raise ValueError(f"{path}: not a model with spaces in front and byte fallback")
        self.ids = {self.names[i]: i for i in normal}
        # Merges go by score; equal scores have equal ranks, and the leftmost goes first.
        scores = sorted({-model.get_score(i) for i in normal})
        order = {s: r for r, s in enumerate(scores)}
        self.rank = {i: order[-model.get_score(i)] for i in normal}
        self.unknown = n  # stands for any one character that is no piece
        self.start = n + 1  # stands before the first piece
        # (left, right) of the last merge of each piece that encodes as itself; None for characters.
        self.made: dict[int, tuple[int, int] | None] = {}
        for i in normal:
            parts = self._merge(self.names[i])
            if parts is not False:
                self.made[i] = parts
        own = sorted(self.made, key=lambda i: self.names[i])
        self.sizes = np.zeros(n + 2, np.int64)
        self.sizes[own] = [len(self.names[i]) for i in own]
        self.sizes[self.unknown] = 1
        self.own = np.array(own)
        longest = int(self.sizes.max())
        self.codes = np.zeros((len(own), longest), np.int64)
        for row, i in enumerate(own):
            self.codes[row, : len(self.names[i])] = [ord(c) for c in self.names[i]]
        self.single = np.sort([ord(self.names[i]) for i in own if len(self.names[i]) == 1])
        self.number = list(range(n + 2))  # one object for each id
        self.follows = _Follows(self)

    def _merge(self, text: str) -> tuple[int, int] | None | bool:
        """How the merges make the whole text one piece; False if they don't."""
        parts, last = list(text), None
        while len(parts) > 1:
            best = min(
                (
                    (self.rank[i], at)
                    for at, (a, b) in enumerate(zip(parts, parts[1:]))
                    if (i := self.ids.get(a + b)) is not None
                ),
                default=None,
            )
            if best is None:
                return False
            at = best[1]
            last = (self.ids.get(parts[at], -1), self.ids.get(parts[at + 1], -1))
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return last


class _Follows:
    """Whether one piece may follow another, for many pairs at once; key: first * 2^20 + second.

    Answers are kept in a table of fixed size, a slot for many keys, where the latest key stays.
    """

    SLOTS = 1 << 20

    def __init__(self, pieces: Pieces):
        n = pieces.start + 1
        self.always = np.array([pieces.start, pieces.unknown])
        self.unknown = pieces.unknown
        # The last merge of each piece, -1 for characters, and its rank.
        self.left, self.right, self.rank = (np.full(n, -1, np.int64) for _ in range(3))
        for i, parts in pieces.made.items():
            if parts is not None:
                self.left[i], self.right[i] = parts
        for i, rank in pieces.rank.items():
            self.rank[i] = rank
        self.most = int(self.rank.max()) + 1
        # All pairs of pieces that put together are a piece.
        ids, found = pieces.ids, {}
        for name, i in ids.items():
            for k in range(1, len(name)):
                a, b = ids.get(name[:k]), ids.get(name[k:])
                if a is not None and b is not None:
                    found[a << 20 | b] = i
        self.pairs = np.array(sorted(found), np.int64)
        self.across = self.rank[[found[k] for k in self.pairs.tolist()]]
        self.keys = np.full(self.SLOTS, -1, np.int64)
        self.answers = np.zeros(self.SLOTS, bool)

    def __call__(self, keys: np.ndarray) -> np.ndarray:
        slots = (keys * 0x9E3779B97F4A7C1 >> 20) % self.SLOTS
        known = self.keys[slots] == keys
        found = self.answers[slots]
        if not known.all():
            unknown = np.flatnonzero(~known)
            new, back = np.unique(keys[unknown], return_inverse=True)
            answers = self.stay(new >> 20, new & 0xFFFFF)
            found[unknown] = answers[back]
            # One key for a slot, so that key and answer are of the same.
            slots, first = np.unique((new * 0x9E3779B97F4A7C1 >> 20) % self.SLOTS, return_index=True)
            self.keys[slots], self.answers[slots] = new[first], answers[first]
        return found

    def stay(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Undoes the merges of both pieces, the latest first, and looks for one across the border.

        At any time the border has the last part of the left piece and the first part of the right one
        beside it. If their merge comes before the one just undone, it would have been made. Of equal
        ranks the left merge comes first.
        """
        out = np.ones(len(left), bool)
        live = np.flatnonzero(~(np.isin(left, self.always) | (right == self.unknown)))
        left, right = left[live], right[live]
        limit = np.full(len(live), self.most + 1)
        while len(live):
            key = left << 20 | right
            at = np.minimum(np.searchsorted(self.pairs, key), len(self.pairs) - 1)
            crossed = (self.pairs[at] == key) & (self.across[at] < limit)
            out[live[crossed]] = False
            a, b = self.left[left] >= 0, self.left[right] >= 0
            on = np.flatnonzero(~crossed & (a | b))
            live, left, right, a, b = live[on], left[on], right[on], a[on], b[on]
            undo = ~b | (a & (self.rank[left] > self.rank[right]))
            limit = np.where(undo, self.rank[left], self.rank[right] + 1)
            left, right = np.where(undo, self.right[left], left), np.where(undo, right, self.left[right])
        return out


@lru_cache(maxsize=2)
def load(path: str) -> Pieces:
    return Pieces(path)


# ---- suffix array and lattice ---------------------------------------------------------------------


def suffixes(code: np.ndarray, depth: int) -> np.ndarray:
    """Start of every suffix, in the order of their first `depth` characters, by prefix doubling."""
    letters = np.zeros(_BORDER + 1, np.int64)
    letters[code] = 1
    kinds = int(letters.sum()) + 1
    rank = np.cumsum(letters)[code]  # of the first character; 0 stands after the end
    size, packed = 1, kinds
    # As many characters as an integer holds are compared at once.
    while size < depth and packed * packed < 1 << 62:
        rank, packed = rank * packed + _after(rank, size), packed * packed
        size *= 2
    while size < depth:
        rank = np.unique(rank, return_inverse=True)[1].astype(np.int64) + 1
        rank = rank * (len(code) + 2) + _after(rank, size)
        size *= 2
    return np.argsort(rank, kind="stable")


def _after(rank: np.ndarray, size: int) -> np.ndarray:
    """The ranks `size` places further on."""
    out = np.zeros_like(rank)
    out[:-size] = rank[size:]
    return out


def ranges(code: np.ndarray, order: np.ndarray, patterns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """[low, high) among the sorted suffixes for each pattern (rows of codes, 0 after the end).

    Character by character: among suffixes that share what was matched so far, the next character is
    sorted, and binary search finds where it begins and ends, for all patterns at once.
    """
    padded = np.append(code, np.full(patterns.shape[1] + 1, -1))
    low = np.zeros(len(patterns), np.int64)
    high = np.full(len(patterns), len(order), np.int64)
    live = np.arange(len(patterns))
    for at in range(patterns.shape[1]):
        live = live[(patterns[live, at] > 0) & (low[live] < high[live])]
        if not len(live):
            break
        wanted = patterns[live, at]
        found = []
        for upper in (False, True):
            a, b = low[live].copy(), high[live].copy()
            while (open_ := a < b).any():
                mid = (a + b) >> 1
                here = padded[order[np.minimum(mid, len(order) - 1)] + at]
                right = (here <= wanted) if upper else (here < wanted)
                a = np.where(open_ & right, mid + 1, a)
                b = np.where(open_ & ~right, mid, b)
            found.append(a)
        low[live], high[live] = found
    return low, high


def encode_strings(strings: list[str], pieces: Pieces) -> list[tuple[int, ...]]:
    """Piece ids of each string: index, match, sort, relax, and read back from the ends.

    A character that is no piece comes as its bytes.
    """
    sizes = np.array([len(s) for s in strings])
    joined = "\n".join(strings).encode("utf-32-le", "surrogatepass")
    code = np.frombuffer(joined, np.uint32).astype(np.int64)
    begin = np.cumsum(sizes + 1) - (sizes + 1)
    code[begin[1:] - 1] = _BORDER

    order = suffixes(code, pieces.codes.shape[1])
    low, high = ranges(code, order, pieces.codes)
    count = np.maximum(high - low, 0)
    which = np.repeat(np.arange(len(count)), count)
    slot = np.arange(len(which)) - np.repeat(np.cumsum(count) - count, count) + low[which]
    start, piece = order[slot], pieces.own[which]
    del order, low, high, count, which, slot  # as large as the lattice, and no longer needed
    odd = np.flatnonzero(~np.isin(code, pieces.single) & (code != _BORDER))
    start = np.concatenate([start, odd])
    piece = np.concatenate([piece, np.full(len(odd), pieces.unknown)])
    end = start + pieces.sizes[piece]

    place = end - np.repeat(begin, sizes + 1)[start]  # in its string
    small = np.uint16 if len(sizes) and sizes.max() < 1 << 16 else np.int64  # sorted by radix
    by_end = np.argsort(place.astype(small), kind="stable")
    start, piece, end, place = start[by_end], piece[by_end], end[by_end], place[by_end]
    del by_end
    # The piece that ends before each position; a border's place serves as the end of its string.
    last = np.full(len(code) + 1, -1, np.int64)
    last[begin] = pieces.start
    ends = np.full(len(code) + 1, -1, np.int64)
    follows = pieces.follows
    steps = np.searchsorted(place, np.arange(1, int(sizes.max(initial=0)) + 2))
    for a, b in zip(steps[:-1], steps[1:]):
        if a == b:
            continue
        s = start[a:b]
        before = np.where(ends[s] >= 0, ends[s], last[s])
        live = np.flatnonzero(before >= 0)
        key = (before[live] << 20) | piece[a:b][live]
        chosen = live[follows(key)]
        ends[end[a:b][chosen]] = piece[a:b][chosen]

    at, owner = begin + sizes, np.arange(len(strings))
    found: list[tuple[np.ndarray, np.ndarray]] = []
    while True:
        open_ = at > begin[owner]
        at, owner = at[open_], owner[open_]
        if not len(at):
            break
        found.append((owner, ends[at]))
        at = at - pieces.sizes[ends[at]]
    if not found:
        return [()] * len(strings)
    owners = np.concatenate([o for o, _ in found])
    tokens = np.concatenate([t for _, t in found])
    step = np.repeat(np.arange(len(found)), [len(o) for o, _ in found])
    by_string = np.lexsort((-step, owners))
    tokens, owners = tokens[by_string], owners[by_string]
    odd = set(owners[tokens == pieces.unknown].tolist())
    tokens = list(map(pieces.number.__getitem__, tokens.tolist()))
    border = np.cumsum(np.bincount(owners, minlength=len(strings))).tolist()
    out = [tuple(tokens[a:b]) for a, b in zip([0, *border[:-1]], border)]
    for i in odd:
        out[i] = _with_bytes(strings[i], out[i], pieces)
    return out


def _with_bytes(string: str, ids: tuple[int, ...], pieces: Pieces) -> tuple[int, ...]:
    out, at = [], 0
    for i in ids:
        if i == pieces.unknown:
            out += [pieces.bytes[b] for b in string[at].encode("utf-8", "replace")]
        else:
            out.append(i)
        at += int(pieces.sizes[i])
    return tuple(out)


class Encoder(dict):
    """Piece ids of strings met before; new ones of a batch are matched together.

    When it is full, its strings become the older generation, from which those that are met again come
    back; only what two generations have not met is dropped.
    """

    def __init__(self, pieces: Pieces):
        super().__init__()
        self.pieces = pieces
        self.older: dict[str, tuple[int, ...]] = {}

    def learn(self, strings: Iterable[str]) -> None:
        if len(self) > CACHE:
            self.older = dict(self)
            self.clear()
        new = [s for s in dict.fromkeys(strings) if s not in self]
        if self.older:
            known = {s: ids for s in new if (ids := self.older.get(s)) is not None}
            self.update(known)
            new = [s for s in new if s not in known]
        a = 0
        while a < len(new):
            b, size = a, 0
            while b < len(new) and (size == 0 or size + len(new[b]) < BLOCK):
                size += len(new[b]) + 1
                b += 1
            self.update(zip(new[a:b], encode_strings(new[a:b], self.pieces)))
            a = b


def segments(text: str, size: int = CUT) -> Iterator[str]:
    """The text as the model sees it: a space in front, spaces as their mark, nothing else changed.

    Long texts come in segments that end before a run of spaces, which no piece crosses from the left.
    """
    at, lead = 0, SPACE
    while at < len(text):
        end = text.find(" ", at + size)
        while 0 < end < len(text) and text[end - 1] == " ":
            end = text.find(" ", end + 1)
        end = len(text) if end < 0 else end
        yield lead + text[at:end].replace(" ", SPACE)
        at, lead = end, ""


def decode(ids: Iterable[int], pieces: Pieces) -> str:
    """The text of piece ids: marks back to spaces, bytes put together, the space in front dropped.

    Bytes that are no UTF-8 become replacement characters, one for each.
    """
    ids = list(ids)
    if pieces.byte.keys().isdisjoint(ids):
        text = "".join(map(pieces.shown.__getitem__, ids))
    else:
        out, held = [], bytearray()
        for i in ids:
            if i in pieces.byte:
                held.append(pieces.byte[i])
                continue
            if held:
                out.append(_from_bytes(bytes(held)))
                held.clear()
            out.append(pieces.shown[i])
        text = "".join(out) + _from_bytes(bytes(held))
    return text[1:] if ids and pieces.shown[ids[0]].startswith(" ") else text


def _from_bytes(held: bytes) -> str:
    out = []
    while held:
        try:
            out.append(held.decode("utf-8"))
            break
        except UnicodeDecodeError as error:
            out += [held[: error.start].decode("utf-8"), "\ufffd"]
            held = held[error.start + 1 :]
    return "".join(out)


# ---- application ----------------------------------------------------------------------------------

_workers: dict[str, Encoder] = {}


def encode_texts(texts: list[str | None], path: str) -> list[list[int]]:
    """Piece ids of each text, all in one batch; a null text has none."""
    claim("sentencepiece", _workers.clear)
    encoder = _workers.get(path)
    if encoder is None:
        _workers.clear()
        encoder = _workers[path] = Encoder(load(path))
    found: list[list[int]] = [[] for _ in texts]
    waiting: list[tuple[int, list[str]]] = []
    once: dict[str, str] = {}  # texts repeat their strings: one object waits for all that are equal
    held = 0

    def flush() -> None:
        encoder.learn(once)
        for i, strings in waiting:
            found[i].extend(chain.from_iterable(map(encoder.__getitem__, strings)))
        waiting.clear()
        once.clear()

    for i, text in enumerate(texts):
        for segment in segments(text or ""):
            strings = _STRINGS.findall(segment)
            waiting.append((i, list(map(once.setdefault, strings, strings))))
            del strings
            held += len(segment)
            if held > 4 * CUT:
                flush()
                held = 0
    flush()
    trim()  # a lattice is many times as large as what is kept of it
    return found


def encode(docs: DataFrame, path: str, text_col: str = "text") -> DataFrame:
    """The table with `pieces` (array of ids) and `n_pieces` behind its columns.

    A column of one of these names is replaced. path: the model file, which every executor must have.
    A null or empty text has no pieces. Rows are independent of each other, ids are not read.
    """
    sized(docs.sparkSession, 1000)
    kept = docs.drop("pieces", "n_pieces")
    at = kept.columns.index(text_col)

    def convert(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = encode_texts(batch.column(at).to_pylist(), path)
        columns = [
            pa.array(found, pa.list_(pa.int32())), pa.array([len(x) for x in found], pa.int64())
        ]
        names = [*batch.schema.names, "pieces", "n_pieces"]
        return pa.RecordBatch.from_arrays([*batch.columns, *columns], names)

    schema = T.StructType(
        [
            *kept.schema.fields,
            T.StructField("pieces", T.ArrayType(T.IntegerType())),
            T.StructField("n_pieces", T.LongType()),
        ]
    )
    return map_texts(kept, [f"`{c}`" for c in kept.columns], convert, schema)


def round_trip(
    docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """id, n_pieces, pieces_sha256, decoded_sha256, same for every row's whole text.

    pieces_sha256: of the ids, joined by commas; decoded_sha256: of the decoded text in UTF-8; same:
    whether that is the text, which fails only for texts with the mark of a space in them. A null text
    counts as empty and has no pieces. Ids are passed through, null or repeated.
    """
    sized(docs.sparkSession, 1000)

    def convert(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = batch.column(1).to_pylist()
        pieces = load(path)
        names = list(map(str, range(len(pieces.names))))
        rows = []
        for text, ids in zip(texts, encode_texts(texts, path)):
            decoded = decode(ids, pieces)
            joined = ",".join(map(names.__getitem__, ids))
            rows.append(
                (
                    len(ids),
                    hashlib.sha256(joined.encode()).hexdigest(),
                    hashlib.sha256(decoded.encode("utf-8", "surrogatepass")).hexdigest(),
                    decoded == (text or ""),
                )
            )
        kinds = [pa.int64(), pa.string(), pa.string(), pa.bool_()]
        columns = [pa.array(c, t) for c, t in zip(zip(*rows), kinds)]
        names = [id_col, "n_pieces", "pieces_sha256", "decoded_sha256", "same"]
        return pa.RecordBatch.from_arrays([batch.column(0), *columns], names)

    kind = docs.schema[id_col].dataType.simpleString()
    schema = (
        f"`{id_col}` {kind}, n_pieces long, pieces_sha256 string, decoded_sha256 string, same boolean"
    )
    return map_texts(docs, [id_col, text_col], convert, schema)
