"""Rows that every text operator must bear."""

from __future__ import annotations

import random

# Columns that no operator reads, named like those that operators make.
CLASHING = [
    "id", "n", "key", "rep", "label", "a", "b", "slot", "shard", "size", "block", "extra", "score",
    "n_tokens", "pieces", "spans", "component_id", "kept", "lang_pred", "value", "digest", "host",
]

WORDS = "the of and to in it is on that by for with this from are was be as at which".split()


def prose(seed: int, words: int) -> str:
    rng = random.Random(seed)
    made = ["".join(rng.choices(["ing", "er", "th", "an", "re", "on"], k=3)) for _ in range(200)]
    return " ".join(rng.choice(WORDS if rng.random() < 0.4 else made) for _ in range(words))


def documents(spark, rows, langs=None):
    """doc_id, text, lang, source, n_chars and the clashing columns."""
    langs = langs or {}
    data = [
        (i, t, langs.get(i), "src", len(t) if t else 0, *["x"] * len(CLASHING)) for i, t in rows
    ]
    columns = ", ".join(f"`{c}` string" for c in CLASHING)
    return spark.createDataFrame(
        data, f"doc_id long, text string, lang string, source string, n_chars long, {columns}"
    )


def edge_rows():
    """Nulls, empty texts, a very long one, one endless word, repeated rows and ids, odd characters."""
    long = prose(1, 60_000)
    return [
        (1, "One short text."), (2, None), (3, ""), (4, " \t\r\n "), (5, long), (6, long),
        (7, "x" * 40_000), (8, "One short text."), (8, "One short text."), (9, "Another text."),
        (9, "A text with the same id."), (None, "One short text."), (None, None),
        (10, "ÉCOLE straße ΑΣ İ ½ 漢字 🙂 \x00 \x1c ▁ é"), (11, "1234 5678 !!! ..."),
    ]


def by_id(df):
    """Rows without an id or with a repeated one come as lists."""
    found = {}
    for r in df.collect():
        found.setdefault(r[0], []).append(r)
    return found
