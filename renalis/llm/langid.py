"""Language identification of words and documents with a linear-chain conditional random field.

Every word of a text gets a label. Its evidence comes from prefixes, suffixes, character n-grams and
a lexicon; learned transitions tie neighbours together, so that a short foreign passage inside a text
is labelled as such. Forward-backward gives the marginal of each label at each word, and a document's
language is the label with the largest share of them.

Labels of training rows are known per document only. Training sequences are therefore spliced from
passages of different documents: that is code-switched text with known labels, from which the chance
of a switch can be learned.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from renalis.llm.common import Chunks, claim, cuts, map_texts, sized, trim

UNKNOWN = "und"
BUCKETS = 1 << 16  # hashed features
FLOOR = 12.0  # evidence against a label, in nats, that one word can give at most
EVERY = 4  # steps after which messages are scaled
BLOCK = 32  # words whose transfer matrices are multiplied before documents are chained
GROUP = 1 << 19  # words handled at a time
CACHE = 200_000  # distinct words whose evidence a worker keeps

# The training sample: documents of each language, passages of each document, words of a passage.
DOCS_PER_LANG, PASSAGES, PASSAGE_WORDS = 300, 3, 24
SALTS = 64

# Familiarity: parts of the sample that are scored by the others, lengths of passages that have a bound,
# share of the held-out passages below it, slack in spreads, held-out words that a bound needs at least.
PARTS, LENGTHS, BELOW, SLACK, LEAST = 4, (1, 2, 4, 8, 16, 24), 0.001, 1.0, 200
STRANGE = -10.0  # familiarity, in spreads below the middle, that one word can have at least
SMOOTHING, ALPHABET = 4.0, 4096

_WORDS = re.compile(r"[^\W\d_]+")


def words_of(text: str) -> list[str]:
    return _WORDS.findall(text.lower())


_TAGS = {"prefix": 11, "suffix": 12, "gram": 13, "lexicon": 14}
_ODD = np.uint64(0x9E3779B97F4A7C15)


def _hashed(tag: int, *codes: np.ndarray) -> np.ndarray:
    """Bucket of a feature: its kind and its characters, mixed."""
    h = np.full(codes[0].shape, tag, np.uint64)
    for c in codes:
        h = (h ^ c) * _ODD
        h ^= h >> np.uint64(29)
    return ((h * _ODD) >> np.uint64(48)).astype(np.int64) % BUCKETS


def features(
    words: list[str], lexicon: dict[str, int]
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(word, bucket, value) of each feature of distinct words.

    Affixes and a hit in the lexicon count one each. The 2- and 3-grams of a word, with its borders,
    share a weight, so that long words don't outvote others.
    """
    size = np.array([len(w) for w in words])
    text = "".join(f"<{w}>" for w in words).encode("utf-32-le", "surrogatepass")
    code = np.frombuffer(text, np.uint32).astype(np.uint64)
    start = np.cumsum(size + 2) - (size + 2)
    owner = np.repeat(np.arange(len(words)), size + 2)
    weight = 1 / np.sqrt(2 * size + 1)
    parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for n in (2, 3):
        at = np.flatnonzero(owner[: len(owner) - n + 1] == owner[n - 1 :])
        bucket = _hashed(_TAGS["gram"], *(code[at + j] for j in range(n)))
        parts.append((owner[at], bucket, weight[owner[at]]))
    for kind, most in (("prefix", 3), ("suffix", 4)):
        for n in range(1, most + 1):
            which = np.flatnonzero(size >= n)
            at = start[which] + (1 if kind == "prefix" else 1 + size[which] - n)
            bucket = _hashed(_TAGS[kind], *(code[at + j] for j in range(n)))
            parts.append((which, bucket, np.ones(len(which))))
    label = np.array([lexicon.get(w, -1) for w in words])
    known = np.flatnonzero(label >= 0)
    parts.append((known, _hashed(_TAGS["lexicon"], label[known].astype(np.uint64)), np.ones(len(known))))
    return tuple(np.concatenate(x) for x in zip(*parts))


def _sums(owner: np.ndarray, values: np.ndarray, weights: np.ndarray, n: int) -> np.ndarray:
    """Evidence of n words: the weighted sums of their features' rows."""
    return np.stack(
        [np.bincount(owner, values * weights[:, i], n) for i in range(weights.shape[1])], 1
    )


def _trigrams(words: list[str]) -> tuple[np.ndarray, tuple[np.ndarray, ...]]:
    """(word, three characters) of each 3-gram of the words with their borders."""
    text = "".join(f"<{w}>" for w in words).encode("utf-32-le", "surrogatepass")
    code = np.frombuffer(text, np.uint32).astype(np.int64)
    owner = np.repeat(np.arange(len(words)), np.array([len(w) + 2 for w in words], np.int64))
    at = np.flatnonzero(owner[:-2] == owner[2:])
    return owner[at], (code[at], code[at + 1], code[at + 2])


def _keys(a: np.ndarray, b: np.ndarray, c: np.ndarray) -> list[np.ndarray]:
    """What is counted: the 3-gram and its context, the 2-gram and its context, the character."""
    return [a << 42 | b << 21 | c, a << 21 | b, b << 21 | c, b, c]


class _Grams:
    """Counts of the characters' 3-grams by label, exact: a code point has 21 bits."""

    def __init__(self, words: list[str], label: np.ndarray, k: int):
        owner, chars = _trigrams(words)
        self.totals = np.bincount(label[owner], minlength=k).astype(float)
        self.tables = []
        for keys in _keys(*chars):
            found, at = np.unique(keys, return_inverse=True)
            counts = np.bincount(at * k + label[owner], minlength=(len(found) + 1) * k)
            self.tables.append((found, counts.reshape(-1, k)))  # the last row is that of no gram

    def score(self, words: list[str]) -> np.ndarray:
        """Mean log chance of the characters of each word under each label."""
        owner, chars = _trigrams(words)
        n = []
        for (found, counts), keys in zip(self.tables, _keys(*chars)):
            at = np.searchsorted(found, keys)
            hit = found[np.minimum(at, len(found) - 1)] == keys
            n.append(counts[np.where(hit, at, len(found))])
        p = (n[4] + SMOOTHING / ALPHABET) / (self.totals + SMOOTHING)
        p = (n[2] + SMOOTHING * p) / (n[3] + SMOOTHING)
        p = (n[0] + SMOOTHING * p) / (n[1] + SMOOTHING)
        size = np.bincount(owner, minlength=len(words))
        return _sums(owner, np.ones(len(owner)), np.log(p), len(words)) / size[:, None]


def _better_half(near: np.ndarray, starts: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Mean familiarity of the better half of the words of each passage."""
    place = np.arange(LENGTHS[-1])
    inside = place < size[:, None]
    words = near[np.minimum(starts[:, None] + place, len(near) - 1)]
    words = -np.sort(np.where(inside, -words, np.inf), axis=1)
    half = (size + 1) // 2
    return np.where(place < half[:, None], words, 0.0).sum(axis=1) / half


@dataclass
class Familiarity:
    """How well words are known, and below what a passage is in none of the learned languages.

    A word's familiarity is its score under the label that it fits best, in spreads from the middle of
    the held-out words of that label. A passage's is the mean of the better half of its words, so that
    keys, names and quotations don't make a text strange. The bounds are low quantiles of those of
    held-out passages.
    """

    grams: _Grams
    middle: np.ndarray
    spread: np.ndarray
    bounds: np.ndarray | None = None  # for passages of LENGTHS words and more

    def of(self, words: list[str]) -> np.ndarray:
        return self.scaled(self.grams.score(words))

    def scaled(self, score: np.ndarray) -> np.ndarray:
        return np.clip(((score - self.middle) / self.spread).max(axis=1), STRANGE, 1.0)

    def known(self, near: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        """Of each word, whether its passage is known; texts are cut into passages of 24 words."""
        most = LENGTHS[-1]
        pieces = -(-lengths // most)
        first = np.repeat(np.cumsum(pieces) - pieces, pieces)
        order = np.arange(pieces.sum()) - first
        size = np.minimum(most, np.repeat(lengths, pieces) - order * most)
        mean = _better_half(near, np.cumsum(size) - size, size)
        bound = self.bounds[np.searchsorted(LENGTHS, size, side="right") - 1]
        return np.repeat(mean >= bound, size)


def familiarity(passages: list[tuple[str, list[str], int]], labels: list[str]) -> Familiarity | None:
    """Learned from (lang, words, part); each part is scored by the others. None for tiny samples."""
    passages = sorted((lang, words, part) for lang, words, part in passages if words)
    k, number = len(labels), {label: i for i, label in enumerate(labels)}
    words = [w for _, ws, _ in passages for w in ws]
    sizes = [len(ws) for _, ws, _ in passages]
    label = np.repeat(np.array([number[lang] for lang, _, _ in passages], np.int64), sizes)
    part = np.repeat(np.array([p for _, _, p in passages], np.int64), sizes)
    score = np.full((len(words), k), -np.inf)
    for p in range(PARTS):
        rest, here = np.flatnonzero(part != p), np.flatnonzero(part == p)
        if len(rest) and len(here):
            grams = _Grams([words[i] for i in rest], label[rest], k)
            score[here] = np.where(grams.totals > 0, grams.score([words[i] for i in here]), -np.inf)
    own = score[np.arange(len(words)), label]
    if np.isfinite(own).sum() < LEAST:
        return None
    middle, spread = np.full(k, np.nan), np.full(k, np.nan)
    for i in range(k):
        of_label = own[(label == i) & np.isfinite(own)]
        if len(of_label) >= LEAST // 4:
            low, middle[i], high = np.quantile(of_label, (0.25, 0.5, 0.75))
            spread[i] = max((high - low) / 1.349, 0.1)
    # Labels with too little to tell are measured like the others.
    middle = np.where(np.isnan(middle), np.nanmin(middle), middle)
    spread = np.where(np.isnan(spread), np.nanmax(spread), spread)
    found = Familiarity(_Grams(words, label, k), middle, spread)
    near = np.where(np.isfinite(own), found.scaled(score), np.nan)
    ends = np.cumsum(sizes)
    bounds = []
    for n in LENGTHS:
        at = [j for end, size in zip(ends, sizes) for j in range(end - size, end - n + 1, n)]
        at = np.array([j for j in at if not np.isnan(near[j : j + n]).any()], np.int64)
        if len(at):
            means = _better_half(near, at, np.full(len(at), n))
            bounds.append(np.quantile(means, BELOW) - SLACK)
        else:
            bounds.append(bounds[-1])
    found.bounds = np.array(bounds)
    return found


@dataclass
class Model:
    labels: list[str]
    weights: np.ndarray  # feature bucket x label
    transitions: np.ndarray  # log weight of label after label
    lexicon: dict[str, int] = field(default_factory=dict)  # word -> its most frequent label
    key: str = ""
    familiar: Familiarity | None = None  # if given, words of strange passages are in no language

    def psi(self, words: list[str]) -> np.ndarray:
        """exp(evidence), the largest of each word 1."""
        owner, bucket, value = features(words, self.lexicon)
        e = _sums(owner, value, self.weights[bucket], len(words))
        return np.exp(np.maximum(e - e.max(axis=1, keepdims=True), -FLOOR)).astype(np.float32)


class _Evidence(dict):
    """Row of each word seen so far in a table of exp(evidence); grows by use, cleared when full."""

    def __init__(self, model: Model):
        super().__init__()
        self.model = model
        self.new: list[str] = []
        self.rows = np.empty((0, len(model.labels)), np.float32)
        self.near = np.empty(0)  # familiarity of the words, if the model has any
        self.ids = Chunks(words_of, self.__getitem__).ids

    def __missing__(self, word: str) -> int:
        if any(map(str.isalpha, word)):
            row = len(self.rows) + len(self.new)
            self.new.append(word)
        else:  # numerals that are word characters, but no letters
            row = -1
        self[word] = row
        return row

    def table(self) -> np.ndarray:
        if self.new:
            self.rows = np.concatenate([self.rows, self.model.psi(self.new)])
            if self.model.familiar:
                self.near = np.concatenate([self.near, self.model.familiar.of(self.new)])
            self.new = []
        return self.rows


def marginals(psi: np.ndarray, lengths: np.ndarray, transitions: np.ndarray) -> np.ndarray:
    """Marginals of each label at each word by forward-backward, exact for texts of any length.

    psi: exp(evidence) of the words of all documents, one after the other; lengths: words of each
    document, none zero. Documents fall into blocks of BLOCK words. The transfer matrices of a block
    are multiplied for all blocks at once, then chained along each document; the messages inside the
    blocks follow from those at their borders. Arrays are laid out label first.
    """
    k = psi.shape[1]
    a = np.ascontiguousarray(np.exp(transitions - transitions.max()), dtype=np.float32)
    at_label = np.ascontiguousarray(psi.T)
    n_blocks = -(-lengths // BLOCK)
    first = np.cumsum(n_blocks) - n_blocks
    starts = np.cumsum(lengths) - lengths
    order = np.arange(n_blocks.sum()) - np.repeat(first, n_blocks)  # of a block in its document
    at = np.repeat(starts, n_blocks) + order * BLOCK
    size = np.minimum(BLOCK, np.repeat(lengths, n_blocks) - order * BLOCK)
    # Long blocks first: those that have a t-th word are then a prefix.
    by_size = np.argsort(-size, kind="stable")
    place = np.empty_like(by_size)
    place[by_size] = np.arange(len(by_size))
    at, size = at[by_size], size[by_size]
    live = [int(np.searchsorted(-size, -t, side="left")) for t in range(BLOCK)]

    def scaled(x: np.ndarray, t: int) -> None:
        if t % EVERY == EVERY - 1:
            x /= np.maximum(x.max(axis=tuple(range(x.ndim - 1)), keepdims=True), 1e-30)

    # Product of the transfer matrices of each block: [to, from, block].
    product = np.broadcast_to(np.eye(k, dtype=np.float32)[:, :, None], (k, k, len(at))).copy()
    for t, n in enumerate(live):
        p = np.take(at_label, at[:n] + t, axis=1)
        moved = (a.T @ product[:, :, :n].reshape(k, -1)).reshape(k, k, n) * p[:, None, :]
        scaled(moved, t)
        product[:, :, :n] = moved

    # Messages into and out of each block, along the documents.
    into = np.full((len(at), k), 1 / k, np.float32)
    back = np.ones((len(at), k), np.float32)
    chain = np.ascontiguousarray(np.moveaxis(product, 2, 0))  # [block, to, from]
    longest = np.argsort(-n_blocks, kind="stable")
    counts = n_blocks[longest]
    reach = [int(np.searchsorted(-counts, -j, side="left")) for j in range(int(counts[0]))]
    for j in range(1, len(reach)):
        b = place[first[longest[: reach[j]]] + j]
        before = place[first[longest[: reach[j]]] + j - 1]
        v = np.einsum("nlk,nk->nl", chain[before], into[before])
        into[b] = v / np.maximum(v.sum(axis=1, keepdims=True), 1e-30)
    for j in range(len(reach) - 1, 0, -1):
        b = place[first[longest[: reach[j]]] + j]
        before = place[first[longest[: reach[j]]] + j - 1]
        v = np.einsum("nlk,nl->nk", chain[b], back[b])
        back[before] = v / np.maximum(v.sum(axis=1, keepdims=True), 1e-30)

    out = np.empty_like(at_label)
    message = np.ascontiguousarray(into.T)
    for t, n in enumerate(live):
        message = (a.T @ message[:, :n]) * np.take(at_label, at[:n] + t, axis=1)
        scaled(message, t)
        out[:, at[:n] + t] = message
    message = np.ascontiguousarray(back.T)
    for t in range(BLOCK - 1, -1, -1):
        n = live[t]
        here = at[:n] + t
        now = message[:, :n]
        out[:, here] *= now
        moved = a @ (now * np.take(at_label, here, axis=1))
        scaled(moved, t)
        message[:, :n] = moved
    out /= np.maximum(out.sum(axis=0), 1e-30)
    return out.T


# ---- training -------------------------------------------------------------------------------------


def held_out(id_col: str = "doc_id") -> F.Column:
    """A third of the documents, by id; a document without an id is in neither part."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string")) % 3 == 1, F.lit(False))


def training_passages(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang"
) -> DataFrame:
    """(lang, words, part): passages spread over whole texts of a bounded sample of the labelled rows.

    At most DOCS_PER_LANG documents of each language, those with the smallest hashed ids. They are
    chosen on ids alone, in SALTS parts of each language first and then among those parts' choices, so
    that no task sees more of a common language than its share.
    """
    usable = (
        F.col(id_col).isNotNull()
        & (F.crc32(F.col(id_col).cast("string")) % 3 != 1)
        & F.col(lang_col).isNotNull()
        & F.col(text_col).isNotNull()
    )
    rows = docs.filter(usable).select(
        F.col(id_col).alias("id"),
        F.col(lang_col).alias("lang"),
        F.col(text_col).alias("text"),
        F.pmod(F.shiftright(F.xxhash64(id_col), 8), F.lit(PARTS)).cast("int").alias("part"),
    )
    hashed = rows.select("id", "lang", F.xxhash64("id").alias("h"))
    chosen = hashed.withColumn("salt", F.pmod("h", F.lit(SALTS)))
    for group in (["lang", "salt"], ["lang"]):
        nth = F.row_number().over(W.partitionBy(*group).orderBy("h", "id"))
        chosen = chosen.withColumn("n", nth).filter(F.col("n") <= DOCS_PER_LANG)
    chosen = chosen.select("id", "lang").distinct()
    texts = rows.join(F.broadcast(chosen), ["id", "lang"], "left_semi")

    def passages(batch: pa.RecordBatch) -> pa.RecordBatch:
        langs, out, parts = [], [], []
        for lang, text, part in zip(*(c.to_pylist() for c in batch.columns)):
            words = [w for piece in cuts(text) for w in words_of(piece)]
            n = min(PASSAGES, -(-len(words) // PASSAGE_WORDS))
            for j in range(n):
                start = (len(words) - PASSAGE_WORDS) * j // max(1, n - 1) if n > 1 else 0
                out.append(words[max(0, start) : max(0, start) + PASSAGE_WORDS])
                langs.append(lang)
                parts.append(part)
        return pa.RecordBatch.from_arrays(
            [
                pa.array(langs, pa.string()),
                pa.array(out, pa.list_(pa.string())),
                pa.array(parts, pa.int32()),
            ],
            ["lang", "words", "part"],
        )

    schema = "lang string, words array<string>, part int"
    return map_texts(texts, ["lang", "text", "part"], passages, schema)


def fit(passages: list[tuple[str, list[str]]], rounds: int = 40, seed: int = 7) -> Model:
    """Maximum likelihood with a Gaussian prior, by Adam on the sample. Same passages, same model."""
    passages = sorted((lang, words) for lang, words in passages if words)
    labels = sorted({lang for lang, _ in passages})
    k = len(labels)
    number = {label: i for i, label in enumerate(labels)}
    seen = [Counter() for _ in labels]
    for lang, words in passages:
        seen[number[lang]].update(words)
    totals = sum(seen, Counter())
    lexicon = {
        w: max(range(k), key=lambda i: (seen[i][w], -i)) for w, n in totals.items() if n >= 3
    }
    model = Model(labels, np.zeros((BUCKETS, k), np.float32), np.zeros((k, k)), lexicon)
    if k < 2:
        return model

    # Splice: three passages a sequence, cut to random lengths, in random order.
    rng = np.random.default_rng(seed)
    order = rng.permutation(len(passages))
    sequences: list[list[tuple[str, int]]] = []
    for i in range(0, len(order), 3):
        parts = [passages[j] for j in order[i : i + 3]]
        sequences.append(
            [(w, number[lang]) for lang, ws in parts for w in ws[: int(rng.integers(4, PASSAGE_WORDS + 1))]]
        )
    vocabulary = {w: i for i, w in enumerate(sorted({w for s in sequences for w, _ in s}))}
    owner, bucket, value = features(list(vocabulary), lexicon)
    used, at = np.unique(bucket, return_inverse=True)

    length = max(map(len, sequences))
    ids = np.zeros((len(sequences), length), np.int64)
    gold = np.zeros((len(sequences), length), np.int64)
    live = np.zeros((len(sequences), length), bool)
    for i, s in enumerate(sequences):
        ids[i, : len(s)] = [vocabulary[w] for w, _ in s]
        gold[i, : len(s)] = [g for _, g in s]
        live[i, : len(s)] = True
    target = np.eye(k)[gold]
    words_total = live.sum()
    gold_pairs = np.zeros((k, k))
    both = live[:, 1:]
    np.add.at(gold_pairs, (gold[:, :-1][both], gold[:, 1:][both]), 1)

    weights, transitions = np.zeros((len(used), k)), np.zeros((k, k))
    state = [np.zeros_like(weights), np.zeros_like(weights), np.zeros((k, k)), np.zeros((k, k))]
    for step in range(1, rounds + 1):
        table = _sums(owner, value, weights[at], len(vocabulary))
        psi = np.exp(np.maximum(table - table.max(axis=1, keepdims=True), -FLOOR))[ids]
        a = np.exp(transitions)
        alpha, beta = np.empty_like(psi), np.ones_like(psi)
        message = np.full((len(ids), k), 1 / k)
        for t in range(length):
            moved = (message @ a) * psi[:, t]
            message = np.where(live[:, t, None], moved / moved.sum(1, keepdims=True), message)
            alpha[:, t] = message
        expected = np.zeros((k, k))
        for t in range(length - 2, -1, -1):
            right = psi[:, t + 1] * beta[:, t + 1]
            on = live[:, t + 1]
            pair = alpha[:, t, :, None] * a * right[:, None, :]
            expected += (pair / pair.sum((1, 2), keepdims=True))[on].sum(0)
            moved = right @ a.T
            beta[:, t] = np.where(on[:, None], moved / moved.sum(1, keepdims=True), 1.0)
        gamma = alpha * beta
        gamma /= gamma.sum(2, keepdims=True)
        error = ((gamma - target) * live[:, :, None]).reshape(-1, k)
        flat = ids.reshape(-1)
        by_word = np.stack([np.bincount(flat, error[:, i], len(vocabulary)) for i in range(k)], 1)
        grad = np.stack(
            [np.bincount(at, value * by_word[owner, i], len(used)) for i in range(k)], 1
        )
        pairs = ((grad / words_total + 1e-6 * weights), (expected - gold_pairs) / words_total)
        for i, (g, x) in enumerate(zip(pairs, (weights, transitions))):
            m, v = state[2 * i], state[2 * i + 1]
            m += 0.1 * (g - m)
            v += 0.01 * (g * g - v)
            x -= 0.15 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
    model.weights[used] = weights
    model.transitions = transitions
    return model


def train(docs: DataFrame, rejecting: bool = False, **columns: str) -> Model:
    """A model of the sample's passages; their number has a fixed bound for each language.

    With `rejecting`, the model also knows what is in none of the languages, if there is enough to learn
    that from.
    """
    rows = training_passages(docs, **columns).collect()
    model = fit([(r["lang"], list(r["words"])) for r in rows])
    if rejecting:
        passages = [(r["lang"], list(r["words"]), r["part"]) for r in rows]
        model.familiar = familiarity(passages, model.labels)
    model.key = f"{zlib.crc32(model.weights.tobytes())}-{len(rows)}-{model.familiar is not None}"
    return model


# ---- application ----------------------------------------------------------------------------------

_workers: dict[str, _Evidence] = {}


def _evidence(model: Model, most: float = float("inf")) -> _Evidence:
    """The worker's table for this model: one model at a time, emptied when over `most` words."""
    claim("langid", _workers.clear)
    found = _workers.get(model.key)
    if found is None or len(found) > most:
        _workers.clear()
        del found
        trim()
        found = _workers[model.key] = _Evidence(model)
    return found


def label_texts(texts: list[str | None], model: Model) -> list[np.ndarray]:
    """Marginals (words x labels) for each text; no rows for a text without letters.

    They are zero in strange passages, if the model tells these.
    """
    k = len(model.labels)
    out: list[np.ndarray] = [np.empty((0, k), np.float32)] * len(texts)
    waiting: list[tuple[int, np.ndarray]] = []

    def flush() -> None:
        if waiting:
            lengths = np.array([len(ids) for _, ids in waiting])
            ids = np.concatenate([ids for _, ids in waiting])
            evidence = _evidence(model)
            done = marginals(evidence.table()[ids], lengths, model.transitions)
            if model.familiar:
                done = done * model.familiar.known(evidence.near[ids], lengths)[:, None]
            for (i, _), part in zip(waiting, np.split(done, np.cumsum(lengths)[:-1])):
                out[i] = part
            waiting.clear()

    words = 0
    for i, text in enumerate(texts):
        if not text or k == 0:
            continue
        ids = _evidence(model).ids(text)
        if len(ids):
            waiting.append((i, ids))
            words += len(ids)
            if words >= GROUP:
                flush()
                words = 0
                _evidence(model, CACHE)
    flush()
    _evidence(model, CACHE)
    return out


def predict(
    docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """id, lang_pred, score, n_words for every row.

    score: the share of the language in the marginals of all words. A null or empty text, one without
    letters, and any text if there was nothing to learn from get `und` with score 0. Equal texts get
    equal results; the id is passed through, null or repeated, and other columns are not read.
    """
    spark = docs.sparkSession
    sized(spark)
    sent = spark.sparkContext.broadcast(model)

    def convert(batch: pa.RecordBatch) -> pa.RecordBatch:
        model = sent.value
        langs, scores, counts = [], [], []
        for part in label_texts(batch.column(1).to_pylist(), model):
            mass = part.sum(axis=0, dtype=np.float64)
            best = int(mass.argmax()) if len(part) else -1
            langs.append(model.labels[best] if len(part) else UNKNOWN)
            scores.append(float(min(1.0, mass[best] / len(part))) if len(part) else 0.0)
            counts.append(len(part))
        return pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(langs), pa.array(scores), pa.array(counts, pa.int64())],
            [id_col, "lang_pred", "score", "n_words"],
        )

    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"`{id_col}` {kind}, lang_pred string, score double, n_words long"
    return map_texts(docs, [id_col, text_col], convert, schema)


def label_words(
    docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """id and, for each word of the text in order, its label and that label's marginal."""
    spark = docs.sparkSession
    sized(spark)
    sent = spark.sparkContext.broadcast(model)

    def convert(batch: pa.RecordBatch) -> pa.RecordBatch:
        model = sent.value
        parts = label_texts(batch.column(1).to_pylist(), model)
        labels = [[model.labels[i] for i in p.argmax(1)] if len(p) else [] for p in parts]
        chances = [p.max(1).astype(np.float64).tolist() if len(p) else [] for p in parts]
        return pa.RecordBatch.from_arrays(
            [
                batch.column(0),
                pa.array(labels, pa.list_(pa.string())),
                pa.array(chances, pa.list_(pa.float64())),
            ],
            [id_col, "labels", "marginals"],
        )

    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"`{id_col}` {kind}, labels array<string>, marginals array<double>"
    return map_texts(docs, [id_col, text_col], convert, schema)


def identify(spark: SparkSession, docs: DataFrame) -> DataFrame:
    """Per document: doc_id, held_out, lang_pred, score, n_words; learned without the held-out third."""
    model = train(docs)
    kept = docs.select("doc_id", "text")
    return predict(kept, model).select(
        "doc_id", held_out().alias("held_out"), "lang_pred", "score", "n_words"
    )


def keep_identified(docs: DataFrame, min_score: float, text_col: str = "text") -> DataFrame:
    """The rows whose text has a language with at least this score, all columns as they are.

    Words of passages that are strange to all learned languages count for none. The verdict is a matter of the text alone and is made where the row is, without a shuffle.
    """
    spark = docs.sparkSession
    sent = spark.sparkContext.broadcast(train(docs, rejecting=True, text_col=text_col))
    sized(spark)
    at = docs.columns.index(text_col)

    def convert(batch: pa.RecordBatch) -> pa.RecordBatch:
        keep = [
            len(part) > 0 and part.sum(axis=0).max() >= min_score * len(part)
            for part in label_texts(batch.column(at).to_pylist(), sent.value)
        ]
        return batch.filter(pa.array(keep, pa.bool_()))

    return map_texts(docs, [f"`{c}`" for c in docs.columns], convert, docs.schema)
