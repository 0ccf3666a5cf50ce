"""Personal data in whole texts, disguised forms included, with spans of the original text.

Plain identifiers are found by fixed patterns.  Disguised ones are found through
transducers: a text in which a disguise may occur is rewritten step by step
(homoglyphs and full-width forms to ASCII, spelled digits to digits, ``at``/``dot`` and
bracketed marks to ``@`` and ``.``) while an array keeps, for every character of the
result, the span of the original it stands for.  The same patterns then run over the
result and their matches are mapped back to the original text; a mapped
span is added unless it is, or lies in, a plain span of its kind.

Every pattern takes time linear in the text: runs are only entered at their
start, and an ``@`` or ``+`` is looked for first.

Defined results: a null or empty text has no spans; repeated rows are searched each;
extra columns are ignored.  Offsets count code points, ends are exclusive.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from tessera.llm.common import map_arrow

KINDS = ("email", "ip", "card", "phone")
Span = tuple[str, int, int]

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
#: Stretches that can hold an address or a card number.
_NUMBERS = re.compile(r"[0-9][0-9 .-]{6,}")
_IP = re.compile(r"(?<![0-9])[0-9]+(?:\.[0-9]+){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")


def luhn(digits: str) -> bool:
    values = [int(d) for d in reversed(digits)]
    return sum(values[::2] + [d * 2 - 9 * (d > 4) for d in values[1::2]]) % 10 == 0


def emails(text: str) -> Iterator[tuple[int, int]]:
    at, free = text.find("@"), 0
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        found = _DOMAIN.match(text, at + 1) if start < at else None
        if found:
            yield start, found.end()
            free = found.end()
        else:
            free = max(free, start)  # what was scanned holds no further start
        at = text.find("@", max(at + 1, free))


def numbers(text: str) -> Iterator[Span]:
    for stretch in _NUMBERS.finditer(text):
        a, b = stretch.span()
        if text.count(".", a, b) >= 3:
            for m in _IP.finditer(text, a, b):
                if all(len(p.lstrip("0")) <= 3 and int(p[-3:] if len(p) > 3 else p) <= 255 for p in m[0].split(".")):
                    yield "ip", *m.span()
        if b - a >= 16:
            for m in _CARD.finditer(text, a, b):
                digits = re.sub("[ -]", "", m[0]) if m.end() - m.start() < 64 else ""
                if 16 <= len(digits) <= 19 and luhn(digits):
                    yield "card", *m.span()


def base_spans(text: str) -> list[Span]:
    """Plain identifiers, by kind and start."""
    found: list[Span] = [("email", a, b) for a, b in emails(text)] if "@" in text else []
    found += numbers(text)
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 8 <= sum(map(str.isdigit, m[0])) <= 15:
                found.append(("phone", *m.span()))
    return sorted(found, key=lambda s: (KINDS.index(s[0]), s[1]))


# ---- transducers -------------------------------------------------------------------------------------------------

#: Letters of other scripts that look like ASCII letters.
_LOOKALIKES = dict(
    zip(
        "аеорсухіјѕԁһӏАВЕКМНОРСТХІЈЅαεοινρτυκχΑΒΕΖΗΙΚΜΝΟΡΤΥΧ",
        "aeopcyxijsdhlABEKMHOPCTXIJSaeoivptukxABEZHIKMNOPTYX",
    )
)
#: Full-width ASCII, and the other digits and points that stand for ASCII ones.
_FOLD = {chr(0xFF01 + i): chr(0x21 + i) for i in range(94)} | _LOOKALIKES | dict(zip("﹫。․٠١٢٣٤٥٦٧٨٩۰۱۲۳۴۵۶۷۸۹", "@..01234567890123456789"))
_FOLD |= {chr(0x1D7CE + i): str(i % 10) for i in range(50)}
_INVISIBLE = "​‌‍⁠﻿­"
_HOMOGLYPH = re.compile("[" + re.escape("".join(_FOLD)) + _INVISIBLE + "]")
#: English names of the digits.
_DIGIT_WORDS = dict(zip("zero one two three four five six seven eight nine oh".split(), "01234567890"))
_ONE_DIGIT = "(?:" + "|".join(_DIGIT_WORDS) + ")"
#: Seven or more spelled digits in a row, maybe after "plus".
_SPELLED = re.compile(rf"(?i)\b(?:plus[ ,-]{{1,3}})?{_ONE_DIGIT}(?:[ ,-]{{1,3}}{_ONE_DIGIT}){{6,}}\b")
_SPELLED_WORD = re.compile(rf"(?i)plus|{_ONE_DIGIT}")
_OPEN, _CLOSE = r"[\[({<]", r"[\])}>]"
#: at and dot in brackets, with spaces around at will; dot between spaces counts between parts of a host name.
_AT = re.compile(rf"(?i)\s{{0,3}}{_OPEN}\s?(?:at|@)\s?{_CLOSE}\s{{0,3}}|\s{{1,3}}at\s{{1,3}}(?=[a-z0-9-]+(?:\s{{1,3}}dot\s|\s{{0,3}}{_OPEN}\s?(?:dot|\.)\s?{_CLOSE}))")
_DOT = re.compile(rf"(?i)\s{{0,3}}{_OPEN}\s?(?:dot|\.)\s?{_CLOSE}\s{{0,3}}|(?<=[a-z0-9])\s{{1,3}}dot\s{{1,3}}(?=[a-z0-9])")
_HOST = re.compile("[A-Za-z0-9-]+")
_MAY_AT = re.compile(rf"(?i){_OPEN}\s?(?:at|@)\s?{_CLOSE}|\sat\s")


class Tape:
    """A text under rewriting and, for each of its characters, the span of the original behind it."""

    def __init__(self, text: str):
        self.text = text
        self.start, self.end = np.arange(len(text)), np.arange(1, len(text) + 1)

    def replace(self, edits: list[tuple[int, int, str]]) -> None:
        """Put a string in place of each span (in order, not overlapping); the string stands for the whole span."""
        if not edits:
            return
        text, starts, ends, at = [], [], [], 0
        for a, b, new in edits:
            text += [self.text[at:a], new]
            starts += [self.start[at:a], np.full(len(new), self.start[a])]
            ends += [self.end[at:a], np.full(len(new), self.end[b - 1])]
            at = b
        self.text = "".join([*text, self.text[at:]])
        self.start, self.end = (np.concatenate([*parts, rest]) for parts, rest in ((starts, self.start[at:]), (ends, self.end[at:])))


def fold_homoglyphs(tape: Tape) -> None:
    tape.replace([(*m.span(), _FOLD.get(m[0], "")) for m in _HOMOGLYPH.finditer(tape.text)])


def read_digits(tape: Tape) -> None:
    edits = []
    for run in _SPELLED.finditer(tape.text):
        at, words = run.start(), [*_SPELLED_WORD.finditer(tape.text, *run.span())]
        for m in words:
            if m.start() > at:
                edits.append((at, m.start(), ""))
            edits.append((*m.span(), "+" if m[0].lower() == "plus" else _DIGIT_WORDS[m[0].lower()]))
            at = m.end()
    tape.replace(edits)


def read_marks(tape: Tape) -> None:
    tape.replace([(*m.span(), "@") for m in _AT.finditer(tape.text)])
    if "@" in tape.text:
        # a spelled point counts only in the stretch behind an @
        edits, free = [], 0
        for at in (i for i, c in enumerate(tape.text) if c == "@"):
            stop = at + 1
            # label, spelled point, label and so on: each begins where the one before ends, so long labels cost their length
            while (label := _HOST.match(tape.text, max(stop, free))) and (m := _DOT.match(tape.text, label.end())):
                edits.append((*m.span(), "."))
                stop = free = m.end()
        tape.replace(edits)


def disguised_spans(text: str) -> list[Span]:
    """Identifiers that only show after rewriting, as spans of ``text``."""
    tape = Tape(text)
    folded = not text.isascii() and _HOMOGLYPH.search(text)
    if folded:
        fold_homoglyphs(tape)
    lower = tape.text.lower()
    digits = sum(w in lower for w in ("zero", "two", "three", "four", "five", "six", "seven", "eight", "nine")) and _SPELLED.search(tape.text)
    if digits:
        read_digits(tape)
    marks = _MAY_AT.search(tape.text) and ("dot" in lower or "." in lower)
    if marks:
        read_marks(tape)
    if tape.text == text:
        return []
    return [(kind, int(tape.start[a]), int(tape.end[b - 1])) for kind, a, b in base_spans(tape.text)]


def find(text: str) -> tuple[list[Span], list[Span]]:
    """Base spans, and all spans with the disguised ones among them."""
    base = base_spans(text)
    found = disguised_spans(text)
    if not found:
        return base, base
    # plain spans of a kind don't overlap, so the last that starts no later is the only one that can hold a span
    every, plain = set(), {k: ([s[1] for s in base if s[0] == k], [s[2] for s in base if s[0] == k]) for k in KINDS}
    for kind, a, b in found:
        starts, ends = plain[kind]
        at = bisect_right(starts, a) - 1
        if at < 0 or ends[at] < b:
            every.add((kind, a, b))
    return base, sorted([*base, *every], key=lambda s: (KINDS.index(s[0]), *s[1:]))


def joined(spans: list[Span]) -> str:
    return ",".join(f"{k}:{a}:{b}" for k, a, b in spans)


def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        counts, digests, spans = [], [], []
        for text in b.column("text").to_pylist():
            base, every = find(text or "")
            counts.append([sum(s[0] == k for s in base) for k in KINDS])
            digests.append(sha256(joined(base).encode()).hexdigest())
            spans.append(joined(every))
        columns = [pa.array([c[i] for c in counts], pa.int64()) for i in range(len(KINDS))]
        yield pa.RecordBatch.from_arrays(
            [b.column("doc_id"), *columns, pa.array(digests, pa.string()), pa.array(spans, pa.string())],
            names=["doc_id", *(f"n_{k}" for k in KINDS), "base_sha256", "spans"],
        )


def find_spans(docs: DataFrame) -> DataFrame:
    """Per row of ``docs`` (``doc_id, text``): base counts, digest of the base spans, and all spans."""
    counts = ", ".join(f"n_{k} long" for k in KINDS)
    return map_arrow(docs.select("doc_id", "text"), scan, f"doc_id {dict(docs.dtypes)['doc_id']}, {counts}, base_sha256 string, spans string")
