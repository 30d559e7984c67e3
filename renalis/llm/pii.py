"""Personal data in plain and disguised form, with spans in the source text.

Plain identifiers are found by pattern. For the disguised ones two transducers rewrite the text: one
maps look-alike characters, foreign digits and invisible characters, the other spelled digits and
at/dot disguises. Each keeps, for every piece of its output, where it came from, so that a span found
in the rewritten text maps back to characters of the source. Whatever is found needs a rewritten piece
in it and may not overlap a plain span.
"""

from __future__ import annotations

import hashlib
import re
import sys
import unicodedata
from bisect import bisect_right
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame

from renalis.llm.common import map_texts, sized

KINDS = ("email", "ip", "card", "phone")
Span = tuple[str, int, int]

# ---- plain identifiers ----------------------------------------------------------------------------

_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A match can only begin where a run of digits does; this keeps long runs linear.
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_NOT_DIGIT = re.compile("[^0-9]")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else d * 2 - 9 * (d > 4)
    return total % 10 == 0


def _emails(text: str) -> list[Span]:
    """From each @: the domain after it, the run of local characters before it."""
    found: list[Span] = []
    end, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (m := _DOMAIN.match(text, at)):
            end = m.end()
            found.append(("email", start, end))
        else:
            end = max(end, at + 1)
        at = text.find("@", end)
    return found


def plain_spans(text: str) -> list[Span]:
    """Leftmost matches of each kind that do not overlap; failing ones are dropped."""
    found = _emails(text) if "@" in text else []
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p[-4:]) <= 255 for p in m.group().split(".")):
            found.append(("ip", m.start(), m.end()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 12:
            digits = m.group().replace(" ", "").replace("-", "")
            if 12 <= len(digits) <= 19 and luhn(digits):
                found.append(("card", m.start(), m.end()))
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= len(_NOT_DIGIT.sub("", m.group())) <= 15:
                found.append(("phone", m.start(), m.end()))
    return found


# ---- transducers ----------------------------------------------------------------------------------

# Cyrillic and Greek letters that look like Latin ones.
_LOOK_ALIKES = (
    "аa еe оo рp сc уy хx іi ѕs јj ԁd һh ԛq ԝw ӏl ɡg "
    "АA ВB ЕE КK МM НH ОO РP СC ТT УY ХX ІI ЅS ЈJ "
    "αa οo ρp νv υu ιi κk τt ΑA ΒB ΕE ΖZ ΗH ΙI ΚK ΜM ΝN ΟO ΡP ΤT ΥY ΧX"
)
# Marks in the place of @ . - + and a space; characters that are not seen.
_MARKS = {"﹫": "@", "。": ".", "․": ".", "·": ".", "﹒": ".", "−": "-", "﹢": "+", " ": " ", " ": " "}
_UNSEEN = "­​‌‍⁠﻿"


def _characters() -> dict[str, str]:
    """What the first transducer maps: the fixed values, and by rule digits and full-width forms."""
    found = {pair[0]: pair[1] for pair in _LOOK_ALIKES.split()} | _MARKS
    found |= dict.fromkeys(_UNSEEN, "")
    found |= {chr(c): "-" for c in range(0x2010, 0x2016)}
    found |= {chr(c): chr(c - 0xFEE0) for c in range(0xFF01, 0xFF5F)}
    found |= {chr(0x1D400 + i): unicodedata.normalize("NFKC", chr(0x1D400 + i)) for i in range(0x2A4)}
    for c in range(128, sys.maxunicode + 1):
        digit = unicodedata.decimal(chr(c), None)
        if digit is not None:
            found[chr(c)] = str(int(digit))
    return {k: v for k, v in found.items() if k != v and v.isascii()}


_MAPPED = _characters()

# The digits in words, in four languages; then the words for a dot and a plus.
_NUMBERS = (
    ("zero one two three four five six seven eight nine", "dot", "plus"),
    ("null eins zwei drei vier fünf sechs sieben acht neun", "punkt", "plus"),
    ("cero uno dos tres cuatro cinco seis siete ocho nueve", "punto", "más"),
    ("zéro un deux trois quatre cinq six sept huit neuf", "point", "plus"),
)
# What stands for @ in languages other than English, and the words for a dot there.
_AT_WORDS, _DOT_WORDS = "arroba|arobase|arrobase|arobas|klammeraffe|ät", "punkt|punto|point"
_OPEN, _CLOSE = r"[ \t]*[\[({<][ \t]*", r"[ \t]*[\])}>][ \t]*"
_BETWEEN = r"(?:[ \t]*[-,][ \t]*|[ \t]+)"


class _Numbers:
    """Spelled digits of a language, and the patterns that read them."""

    def __init__(self, words: str, dot: str, plus: str):
        self.digits = {w: str(i) for i, w in enumerate(words.split())}
        self.sign = plus
        one = "(?:" + "|".join(self.digits) + ")"
        word_dot = rf"(?:[ \t]+{dot}[ \t]+|{_OPEN}(?:{dot}|\.){_CLOSE}|[ \t]*\.[ \t]*)"
        self.part = re.compile(rf"{one}|[0-9]+", re.I)
        self.run = re.compile(rf"\b{one}(?:{_BETWEEN}(?:{one}|[0-9]+))*\b", re.I)
        self.dot_after = re.compile(word_dot, re.I)
        self.before = re.compile(rf"(?:{word_dot}|\b{plus}[ \t]+|\+)\Z", re.I)
        self.plus = re.compile(rf"\b{plus}[ \t]+(?=[0-9])", re.I)


_LANGUAGES = [_Numbers(*row) for row in _NUMBERS]
_DIGIT = "(?:" + "|".join(_LANGUAGES[0].digits) + ")"
# Ends of domains after which a bare "at" with plain dots is taken for a disguise.
_ENDS = (
    "com|org|net|edu|gov|mil|info|biz|io|ai|co|uk|de|fr|es|eu|ch|nl|ca|au|jp|cn|ru|br|pl|se|pt|example"
)
# Where a dot is spelled or bracketed, any end of letters will do. Words before and after
# a spelled dot that show prose ("at the dot of one"); none of the latter is an end of domains.
_NO_DOMAIN = (
    "the|a|an|this|that|these|those|each|every|any|some|no|another|which|what|polka|my|your|his|her|its"
    "|our|their|ten|eleven|twelve|thirteen|fourteen|fifteen|sixteen|seventeen|eighteen|nineteen"
    "|(?:twen|thir|for|fif|six|seven|eigh|nine)ty(?:-[a-z]+)?"
)
_NO_END = (
    "of|and|or|for|on|with|from|if|an|the|this|that|these|those|then|than|but|when|while|where|which"
    "|was|were|are|has|had|have|can|will|would|could|should|not|he|she|we|they|his|her|its|our|their|your"
    "|above|below|into|onto|until|after|before|because"
)
_ANY_DOT = rf"(?:[ \t]+dot[ \t]+|{_OPEN}dot{_CLOSE}|\.)"
_MORE = rf"(?:{_ANY_DOT}[A-Za-z0-9-]+){{0,5}}"
_ANY_END = r"(?:[A-Za-z]{2,}|xn--[A-Za-z0-9-]+)(?![A-Za-z0-9_]|-[A-Za-z0-9])"
_SPELLED_AFTER = (
    rf"(?:[A-Za-z0-9-]+{_MORE}{_OPEN}dot{_CLOSE}(?:[A-Za-z0-9-]+\.){{0,5}}{_ANY_END}"
    rf"|(?!(?:{_NO_DOMAIN})[ \t])[A-Za-z0-9-]+{_MORE}[ \t]+dot[ \t]+"
    rf"(?:[A-Za-z0-9-]+\.){{0,5}}(?!(?:{_NO_END})\b){_ANY_END}"
    rf"|(?=[A-Za-z0-9.-]*(?:[ \t]+dot[ \t]|{_OPEN}dot))[A-Za-z0-9-]+{_MORE}{_ANY_DOT}(?:{_ENDS})\b)"
)
_AFTER_AT = rf"(?:[A-Za-z0-9-]+{_MORE}{_ANY_DOT}(?:{_ENDS})\b|{_SPELLED_AFTER})"
_DISGUISE = re.compile(
    rf"(?P<at>(?<=[A-Za-z0-9]){_OPEN}(?:at|@){_CLOSE}(?=[A-Za-z0-9])"
    rf"|(?<=[A-Za-z0-9])[ \t]+at[ \t]+"
    rf"(?={_AFTER_AT}))"
    rf"|(?P<dot>(?<=[A-Za-z0-9])(?:{_OPEN}(?:dot|\.){_CLOSE}|[ \t]+dot[ \t]+)(?=[A-Za-z0-9]))"
    rf"|(?P<plus>\bplus[ \t]+(?=[0-9]|{_DIGIT}\b))",
    re.I | re.A,
)
# A bare "at" before plain dots alone is common in prose. It counts only with evidence: a name before it
# that no word looks like, or a word before the name that asks for an address. Those words
# in four languages, and words that are no name.
_DOMAIN_SPELLED = re.compile(_SPELLED_AFTER, re.I | re.A)
_DOMAIN_PLAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+", re.A)
_NAME = re.compile(r"[A-Za-z0-9._%+-]+\Z", re.A)
_NAME_LIKE = re.compile(r"(?=.*[A-Za-z])(?!(?:[A-Za-z]\.)+[A-Za-z]?\Z).*[0-9._+].*", re.A)
_CUE = re.compile(
    r"\b(?:e-?mails?|mails?|mailto|contact|write|reach|address|kontakt|kontaktiere|schreib|schreibe|schreiben"
    r"|adresse|correo|contacto|escribe|escriba|escribir|dirección|courriel|contactez|écrire|écris|écrivez)"
    r"(?:[ \t]+(?:to|is|sie|an|à|a|ist|es|est))*[ \t]*[:=]?[ \t]*\Z",
    re.I,
)
_NO_NAME = frozenset(
    "me us you him her them it one someone anyone mich uns sie ihn nos me moi nous vous le la les".split()
)
# Addresses of other languages: the sign in a word of its own, or "at" before a spelled German dot.
_FOREIGN_DOT = rf"(?:[ \t]+(?:{_DOT_WORDS})[ \t]+|{_OPEN}(?:{_DOT_WORDS}|\.){_CLOSE}|\.)"
_FOREIGN_MAIL = re.compile(
    rf"(?<=[A-Za-z0-9])(?P<before>[ \t]+(?:{_DOT_WORDS})[ \t]+[A-Za-z0-9_-]+)?"
    rf"(?:(?P<at>[ \t]+(?:{_AT_WORDS})[ \t]+|{_OPEN}(?:{_AT_WORDS}){_CLOSE})"
    rf"[A-Za-z0-9-]+(?:{_FOREIGN_DOT}[A-Za-z0-9-]+){{1,5}}"
    rf"|(?P<german>[ \t]+at[ \t]+|{_OPEN}(?:at|@){_CLOSE})"
    rf"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*(?:[ \t]+punkt[ \t]+|{_OPEN}punkt{_CLOSE})"
    rf"[A-Za-z0-9-]+(?:{_FOREIGN_DOT}[A-Za-z0-9-]+){{0,4}})",
    re.I,
)
_FOREIGN_IP = re.compile(rf"\b[0-9]{{1,3}}(?:[ \t]+(?:{_DOT_WORDS})[ \t]+[0-9]{{1,3}}){{3}}\b", re.I)
_FOREIGN_SIGN = re.compile(rf"(?:[ \t]+|{_OPEN})(?:{_DOT_WORDS})(?:{_CLOSE}|[ \t]+)|{_OPEN}\.{_CLOSE}", re.I)
_DOTTED = re.compile(r"[ \t]+[A-Za-z0-9-]+\.", re.A)
_BRACKETED = re.compile(r"[\[({<][ \t]*(?:at|@|\.|dot)[ \t]*[\])}>]", re.I | re.A)
_LONGEST_DISGUISE = 40


@dataclass
class Rewritten:
    """A text and, for each of its pieces, the source range it stands for."""

    text: str
    begins: list[int]  # of each piece in the text
    pieces: list[tuple[int, int, bool]]  # source start and end, whether rewritten

    def source(self, start: int, end: int) -> tuple[int, int, bool]:
        """Source range of text[start:end], and whether anything was rewritten or removed in it."""
        i, j = bisect_right(self.begins, start) - 1, bisect_right(self.begins, end - 1) - 1
        first, last = self.pieces[i], self.pieces[j]
        begin = first[0] if first[2] else first[0] + start - self.begins[i]
        stop = last[1] if last[2] else last[0] + end - self.begins[j]
        rewritten = any(p[2] for p in self.pieces[i : j + 1])
        return begin, stop, rewritten or stop - begin != end - start


def rewrite(text: str, edits: list[tuple[int, int, str]]) -> Rewritten:
    """The text with each (start, end, replacement) applied; edits in order, not overlapping.

    An edit that leaves nothing is not a piece: spans that go over it cover its source as well.
    """
    out, begins, pieces = [], [], []
    at = size = 0
    for start, end, new in [*edits, (len(text), len(text), "")]:
        for old, stop, value, changed in ((at, start, text[at:start], False), (start, end, new, True)):
            if value:
                begins.append(size)
                pieces.append((old, stop, changed))
                out.append(value)
                size += len(value)
        at = end
    return Rewritten("".join(out), begins, pieces)


def _lower(text: str) -> str:
    """Lower case, of the same length."""
    low = text.lower()
    if len(low) != len(text):
        low = "".join(c if len(c.lower()) != 1 else c.lower() for c in text)
    return low


def _standing(low: str, word: str) -> list[int]:
    """Where the word stands alone. Plain search, as most texts have few or none."""
    found, at = [], low.find(word)
    while at >= 0:
        end = at + len(word)
        if not low[max(0, at - 1) : at].isalnum() and not low[end : end + 1].isalnum():
            found.append(at)
        at = low.find(word, end)
    return found


def _may_be_disguised(text: str) -> bool:
    """False only if _DISGUISE has no match: none of its signs stands anywhere in the text."""
    low = _lower(text)
    return (
        "plus" in low
        or bool(_standing(low, "dot"))
        or _BRACKETED.search(text) is not None
        or any(_DOTTED.match(text, at + 2) for at in _standing(low, "at"))
    )


def _spelled(text: str, language: _Numbers, anchors: list[int]) -> list[tuple[int, int, str]]:
    """Edits that write spelled digits as figures: three in a row, or some beside a dot or plus."""
    edits, until = [], 0
    for anchor in anchors:
        m = language.run.match(text, anchor) if anchor >= until else None
        if m is None:
            continue
        until = m.end()
        parts = language.part.findall(m.group())
        beside = len(parts) < 3 and (
            language.dot_after.match(text[m.end() : m.end() + _LONGEST_DISGUISE])
            or language.before.search(text[max(0, m.start() - _LONGEST_DISGUISE) : m.start()])
        )
        if len(parts) >= 3 or beside:
            figures = "".join(language.digits.get(p.lower(), p) for p in parts)
            edits.append((m.start(), m.end(), figures))
    return edits


def _foreign(text: str, low: str) -> list[tuple[int, int, str]]:
    """Edits for the signs of addresses in other languages, only where they make one."""
    edits = []
    if any(w in low for w in _DOT_WORDS.split("|") + _AT_WORDS.split("|")):
        for m in _FOREIGN_MAIL.finditer(text):
            a, b = m.span("at") if m.group("at") else m.span("german")
            edits += [(d.start(), d.end(), ".") for d in _FOREIGN_SIGN.finditer(text, m.start(), a)]
            edits.append((a, b, "@"))
            edits += [(d.start(), d.end(), ".") for d in _FOREIGN_SIGN.finditer(text, b, m.end())]
        for m in _FOREIGN_IP.finditer(text):
            edits += [(d.start(), d.end(), ".") for d in _FOREIGN_SIGN.finditer(text, *m.span())]
    for language in _LANGUAGES[1:]:
        if language.sign in low:
            edits += [(m.start(), m.end(), "+") for m in language.plus.finditer(text)]
    edits = sorted(set(edits))
    return [e for i, e in enumerate(edits) if not i or e[0] >= edits[i - 1][1]]


def _evident(text: str, at: int) -> bool:
    """Whether what stands before a bare "at" shows that it is an address."""
    name = _NAME.search(text, max(0, at - 64), at)
    if name is None:
        return False
    if _NAME_LIKE.match(name.group().strip("._%+-")):
        return True
    before = text[max(0, name.start() - 48) : name.start()]
    return name.group().lower() not in _NO_NAME and _CUE.search(before) is not None


def disguised_spans(text: str, plain: list[Span]) -> tuple[list[Span], list[Span]]:
    """What the rewritten text shows besides the plain spans, in source characters; and what may be an
    address, but stands as words of prose do."""
    steps: list[Rewritten] = []
    now = text

    def apply(edits: list[tuple[int, int, str]]) -> None:
        nonlocal now
        if edits:
            steps.append(rewrite(now, edits))
            now = steps[-1].text

    def to_source(start: int, end: int) -> tuple[int, int, bool]:
        changed = False
        for step in reversed(steps):
            start, end, touched = step.source(start, end)
            changed |= touched
        return start, end, changed

    if not text.isascii() and (odd := _MAPPED.keys() & set(text)):
        one = re.compile("[" + "".join(map(re.escape, odd)) + "]")
        apply([(m.start(), m.end(), _MAPPED[m.group()]) for m in one.finditer(now)])
    for language in _LANGUAGES:
        low = _lower(now)
        words = sorted(at for word in language.digits for at in _standing(low, word))
        apply(_spelled(now, language, words))
    apply(_foreign(now, _lower(now)))
    unsure: list[Span] = []
    if _may_be_disguised(now):
        signs, edits = {"at": "@", "dot": ".", "plus": "+"}, []
        for m in _DISGUISE.finditer(now):
            bare = m.lastgroup == "at" and m.group().strip(" \t").lower() == "at"
            if bare and not (_DOMAIN_SPELLED.match(now, m.end()) or _evident(now, m.start())):
                name = _NAME.search(now, max(0, m.start() - 64), m.start())
                domain = _DOMAIN_PLAIN.match(now, m.end())
                if name and domain:
                    unsure.append(("email", *to_source(name.start(), domain.end())[:2]))
            else:
                edits.append((m.start(), m.end(), signs[m.lastgroup]))
        apply(edits)
    if not steps:
        return [], unsure
    found = []
    taken = sorted((s, e) for _, s, e in plain)
    for kind, start, end in plain_spans(now):
        start, end, changed = to_source(start, end)
        i = bisect_right(taken, (end,)) - 1
        clear = all(e <= start or s >= end for s, e in taken[max(0, i - 3) : i + 1])
        if changed and clear:
            found.append((kind, start, end))
    return found, unsure


def ordered(spans: list[Span]) -> list[Span]:
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def as_text(spans: list[Span]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)


def spans_of(text: str) -> tuple[list[Span], list[Span]]:
    """(plain, all) spans of a text, each by start and then kind."""
    return every_span(text)[:2]


def every_span(text: str) -> tuple[list[Span], list[Span], list[Span]]:
    """(plain, all, unsure) spans of a text, each by start and then kind; unsure ones are not in all."""
    plain = plain_spans(text)
    disguised, unsure = disguised_spans(text, plain)
    return ordered(plain), ordered(plain + disguised), ordered(unsure)


def masked(text: str, spans: list[Span]) -> str:
    """The text with each span replaced by its kind; of overlapping spans, one mark for all."""
    out, at, until = [], 0, 0
    for kind, start, end in spans:
        if start >= until:
            out += [text[at:start], f"<{kind.upper()}>"]
        until = at = max(until, end)
    return "".join([*out, text[at:]])


# ---- application ----------------------------------------------------------------------------------


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_disguised, unsure for every row.

    The counts and the digest are those of the plain spans, `spans` lists these and the disguised
    ones, `unsure` words that may be an address but read like prose ("a talk at python.org"); they are
    not masked. Positions are code points, ends exclusive. A null or empty text has no spans. Equal texts
    get equal results; ids are passed through, null or repeated; other columns are not read.
    """
    sized(docs.sparkSession)

    def convert(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows = []
        for text in batch.column(1).to_pylist():
            plain, every, unsure = every_span(text or "")
            kinds = [kind for kind, _, _ in plain]
            digest = hashlib.sha256(as_text(plain).encode()).hexdigest()
            rows.append(
                (
                    *map(kinds.count, KINDS), digest, as_text(every), len(every) - len(plain),
                    as_text(unsure),
                )
            )
        kinds = [*[pa.int64()] * 4, pa.string(), pa.string(), pa.int64(), pa.string()]
        names = [
            id_col, *(f"n_{kind}" for kind in KINDS), "base_sha256", "spans", "n_disguised", "unsure"
        ]
        columns = [pa.array(c, t) for c, t in zip(zip(*rows), kinds)]
        return pa.RecordBatch.from_arrays([batch.column(0), *columns], names)

    kind = docs.schema[id_col].dataType.simpleString()
    counts = ", ".join(f"n_{k} long" for k in KINDS)
    schema = f"`{id_col}` {kind}, {counts}, base_sha256 string, spans string, n_disguised long"
    schema += ", unsure string"
    return map_texts(docs, [id_col, text_col], convert, schema)


def mask(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The table with every span of the text replaced by <EMAIL>, <IP>, <CARD> or <PHONE>.

    All other columns stay as they are. A null text stays null.
    """
    sized(docs.sparkSession)
    at = docs.columns.index(text_col)

    def convert(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = batch.column(at).to_pylist()
        new = [masked(t, spans_of(t)[1]) if t else t for t in texts]
        return batch.set_column(at, text_col, pa.array(new, pa.string()))

    return map_texts(docs, [f"`{c}`" for c in docs.columns], convert, docs.schema)
