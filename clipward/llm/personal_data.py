"""Personal data in texts, plain or disguised, with spans in the source text.

Plain identifiers are found in the text as it is. Then transducers rewrite the text, each keeping for every
character it writes the source range it stands for:

1. ``plain_characters``: look-alike, full-width and other-script characters become ASCII, invisible ones go.
2. ``plain_digits``: two or more number words or short digit groups in a row become digits ("plus four
   nine, double seven"); "point" or "dot" between them becomes a point.
3. ``plain_addresses``: "(at)", "[dot]" and bare "at" and "dot" inside an address become @ and points.

After each, the same detectors run on the result, and their spans are mapped back. Plain spans always
stay. A mapped one is added where it touches no span of its kind; an address, or what look-alikes were
part of, also where it holds such spans whole and more (a longer address of which a part was plain).

Every detector takes time in proportion to the text: possessive groups and looking behind keep long runs
from being tried at every place.

Cases: null and empty texts hold nothing; an identifier with a part out of range is dropped without trying
shorter ones; equal rows give equal spans; very long texts are one row's work; ids are not used, so null or
equal ones do no harm; empty tables give empty tables; other columns are kept (an output column replaces
a column of the same name).
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from clipward.llm.frames import add_arrow_columns

KINDS = ("email", "ip", "card", "phone")

# ---------------------------------------------------------------- detectors

_LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_NOT_DIGIT = re.compile(r"[^0-9]+")
_DOUBLED = [sum(divmod(2 * d, 10)) for d in range(10)]


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """From each @ outward: the run of local characters before it, then the domain."""
    done, at = 0, text.find("@")
    while at >= 0:
        before = text[done:at]
        start = done + len(before.rstrip(_LOCAL))
        domain = _DOMAIN.match(text, at + 1) if start < at else None
        if domain:
            yield start, domain.end()
        done = domain.end() if domain else at + 1
        at = text.find("@", done)


def _ips(text: str) -> Iterator[tuple[int, int]]:
    for m in _IP.finditer(text):
        parts = [p.lstrip("0") for p in m.group().split(".")]
        if all(len(p) <= 3 and int(p or 0) <= 255 for p in parts):
            yield m.span()


def _passes_luhn(digits: str) -> bool:
    own = [int(d) for d in reversed(digits)]
    return (sum(own[::2]) + sum(_DOUBLED[d] for d in own[1::2])) % 10 == 0


def _cards(text: str) -> Iterator[tuple[int, int]]:
    for m in _CARD.finditer(text):
        digits = _NOT_DIGIT.sub("", m.group())
        if 14 <= len(digits) <= 19 and _passes_luhn(digits):
            yield m.span()


def _phones(text: str) -> Iterator[tuple[int, int]]:
    for m in _PHONE.finditer(text):
        if 10 <= len(_NOT_DIGIT.sub("", m.group())) <= 15:
            yield m.span()


DETECTORS: dict[str, Callable[[str], Iterator[tuple[int, int]]]] = {
    "email": _emails,
    "ip": _ips,
    "card": _cards,
    "phone": _phones,
}


def detect(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of all plain identifiers, by kind."""
    return [(kind, a, b) for kind in KINDS for a, b in DETECTORS[kind](text)]


# ---------------------------------------------------------------- transducers


@dataclass
class Mapped:
    """A text and, for each of its characters, the source range it stands for."""

    text: str
    start: np.ndarray
    end: np.ndarray

    @staticmethod
    def identity(text: str) -> Mapped:
        places = np.arange(len(text) + 1, dtype=np.int32)
        return Mapped(text, places[:-1], places[1:])

    def rewrite(self, edits: list[tuple[int, int, str]]) -> Mapped:
        """With ``text[a:b]`` replaced, for ascending disjoint (a, b, written).

        What is written stands for the whole range it replaces.
        """
        if not edits:
            return self
        texts, starts, ends, done = [], [], [], 0
        for a, b, written in edits:
            texts += (self.text[done:a], written)
            n = len(written)
            starts += (self.start[done:a], np.full(n, self.start[a]))
            ends += (self.end[done:a], np.full(n, self.end[b - 1]))
            done = b
        return Mapped(
            "".join([*texts, self.text[done:]]),
            np.concatenate([*starts, self.start[done:]]),
            np.concatenate([*ends, self.end[done:]]),
        )

    def source(self, a: int, b: int) -> tuple[int, int]:
        return int(self.start[a:b].min()), int(self.end[a:b].max())


# Letters of other scripts that look like the ASCII letters below them.
_LOOK_ALIKES = (
    ("АВЕЅІЈКМНОРСТХУаеѕіјорсухһԁԛԝ", "ABESIJKMHOPCTXYaesijopcyxhdqw"),  # Cyrillic
    ("ΑΒΕΖΗΙΚΜΝΟΡΤΥΧαιορνυ", "ABEZHIKMNOPTYXaiopvu"),  # Greek
    ("․‧∙。", "...."),
    ("‐‑‒–—−", "------"),
)
# Characters without width.
_INVISIBLE = "­͏᠎​‌‍‎‏⁠﻿"
_ALIKE = {c: p for odd, plain in _LOOK_ALIKES for c, p in zip(odd, plain, strict=True)}
_ALIKE |= dict.fromkeys(_INVISIBLE, "")
_ODD = re.compile(r"[^\x00-\x7f]+")


def plain_character(c: str) -> str:
    """The ASCII form of one character, or itself."""
    known = _ALIKE.get(c)
    if known is not None:
        return known
    digit = unicodedata.decimal(c, None)
    if digit is not None:
        return str(digit)
    folded = unicodedata.normalize("NFKC", c)
    return folded if folded.isascii() and folded.isprintable() else c


def plain_characters(given: Mapped) -> Mapped:
    if given.text.isascii():
        return given
    odd = {c: plain_character(c) for c in set(given.text) if c > "\x7f"}
    odd = {c: p for c, p in odd.items() if c != p}
    if not odd:
        return given
    spots = (
        (m.start() + i, c) for m in _ODD.finditer(given.text) for i, c in enumerate(m.group())
    )
    return given.rewrite([(i, i + 1, odd[c]) for i, c in spots if c in odd])


# Number words of English, German, French and Spanish.
_NUMBERS = (
    "zero oh null zéro cero",
    "one eins un uno",
    "two zwei deux dos",
    "three drei trois tres",
    "four vier quatre cuatro",
    "five fünf cinq cinco",
    "six sechs seis",
    "seven sieben sept siete",
    "eight acht huit ocho",
    "nine neun neuf nueve",
)
_DIGIT = {word: str(d) for d, words in enumerate(_NUMBERS) for word in words.split()}
_TIMES = {"double": 2, "triple": 3}
_WORD = "|".join(sorted(_DIGIT, key=len, reverse=True))
_SPOKEN = rf"(?:(?:double|triple)[ -])?(?:{_WORD})(?!\w)"
_SHORT = r"[0-9]{1,4}(?![\w@])"
_GAP = r"(?:[ ,.\-\n]{1,2}|[ ]?(?:dot|point)[ ])"
# Members of a row of digits; a lone number word or a row without number words is left alone.
_ROW = re.compile(
    rf"(?<![\w.])(?:plus[ ](?={_SPOKEN}))?(?:{_SPOKEN}|{_SHORT})(?:{_GAP}(?:{_SPOKEN}|{_SHORT}))++", re.I
)
_MEMBER = re.compile(rf"(?P<plus>plus[ ])|(?P<spoken>{_SPOKEN})|(?P<short>[0-9]+)|(?P<gap>{_GAP})", re.I)
_HINT = re.compile(rf"(?<!\w)(?:{_WORD})[ ,.\-\n]{{1,2}}(?:{_WORD}|double|triple|[0-9]|dot|point)", re.I)


def plain_digits(given: Mapped) -> Mapped:
    if not _HINT.search(given.text):
        return given
    edits = []
    for row in _ROW.finditer(given.text):
        members = list(_MEMBER.finditer(given.text, *row.span()))
        spoken = [m.lastgroup == "spoken" for m in members]
        for i, m in enumerate(members):
            said = m.group().lower()
            if spoken[i]:
                times, _, word = re.split("([ -])", said) if said[:6] in _TIMES else ("", "", said)
                edits.append((*m.span(), _DIGIT[word] * _TIMES.get(times, 1)))
            elif m.lastgroup == "plus":
                edits.append((*m.span(), "+"))
            elif m.lastgroup == "gap" and any(spoken[max(i - 1, 0) : i + 2]):
                point = "." in said or "o" in said
                edits.append((*m.span(), "." if point else ""))
    return given.rewrite(edits)


_OPEN, _CLOSE = r"[ ]{0,2}[\[({<][ ]{0,2}", r"[ ]{0,2}[\])}>][ ]{0,2}"
_LABEL = r"[A-Za-z0-9-]+"
_SIGN = re.compile(rf"{_OPEN}(?:(?P<at>at|@|arroba)|(?P<dot>dot|\.|punkt|punto|point)){_CLOSE}", re.I)
_BARE_AT = re.compile(rf"(?<=[A-Za-z0-9])[ ]{{1,2}}at[ ]{{1,2}}(?={_LABEL}(?:\.{_LABEL})*[ ]{{1,2}}dot[ ]{{1,2}}{_LABEL})", re.I)
_BARE_DOT = re.compile(r"[ ]{1,2}dot[ ]{1,2}", re.I)
_SPACED_DOMAIN = re.compile(rf"(?<=@){_LABEL}(?:(?:\.|[ ]{{1,2}}dot[ ]{{1,2}}){_LABEL})+", re.I)
_SPACED_LOCAL = re.compile(rf"(?<![\w.%+-])[A-Za-z0-9_%+-]++(?:[ ]{{1,2}}dot[ ]{{1,2}}[A-Za-z0-9_%+-]++){{1,4}}(?=@)", re.I)


def _dots(m: re.Match) -> list[tuple[int, int, str]]:
    return [(*dot.span(), ".") for dot in _BARE_DOT.finditer(m.string, *m.span())]


def plain_addresses(given: Mapped) -> Mapped:
    signs = [(*m.span(), "@" if m.group("at") else ".") for m in _SIGN.finditer(given.text)]
    given = given.rewrite(signs)
    given = given.rewrite([(*m.span(), "@") for m in _BARE_AT.finditer(given.text)])
    if "@" in given.text and _BARE_DOT.search(given.text):
        given = given.rewrite([e for m in _SPACED_DOMAIN.finditer(given.text) for e in _dots(m)])
        given = given.rewrite(
            [e for m in _SPACED_LOCAL.finditer(given.text)
             if given.end[m.end()] - given.start[m.end()] > 1 for e in _dots(m)]
        )
    return given


TRANSDUCERS = (plain_characters, plain_digits, plain_addresses)


def spans(text: str) -> list[tuple[str, int, int, bool]]:
    """(kind, start, end, plain) by start, then kind, then end."""
    base = detect(text)
    found = {span: True for span in base}
    given = Mapped.identity(text)
    for transducer in TRANSDUCERS:
        before, given = given, transducer(given)
        if given is before:
            continue
        known = {kind: _Spans(sorted(s[1:] for s in found if s[0] == kind)) for kind in KINDS}
        for kind, a, b in detect(given.text):
            a, b = given.source(a, b)
            # A number word beside a number is no part of it.
            whole = kind == "email" or transducer is plain_characters
            if known[kind].admits(a, b, whole):
                found[kind, a, b] = False
    rows = [(*span, plain) for span, plain in found.items()]
    return sorted(rows, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


class _Spans:
    """Spans of one kind, ascending by start."""

    def __init__(self, spans: list[tuple[int, int]]):
        self.starts, ends = (np.array([s[i] for s in spans], np.int64) for i in (0, 1))
        self.ends = np.maximum.accumulate(ends) if len(ends) else ends

    def admits(self, a: int, b: int, whole: bool) -> bool:
        """Whether a..b touches none of the spans or, if ``whole``, holds more than one of them does."""
        lo = int(np.searchsorted(self.ends, a, side="right"))
        hi = int(np.searchsorted(self.starts, b))
        if lo >= hi:
            return True
        inside = a <= self.starts[lo] and self.ends[hi - 1] <= b
        return bool(whole and inside and (hi - lo > 1 or b - a > self.ends[lo] - self.starts[lo]))


_SPAN = T.StructType(
    [
        T.StructField("kind", T.StringType()),
        T.StructField("start", T.LongType()),
        T.StructField("end", T.LongType()),
        T.StructField("plain", T.BooleanType()),
    ]
)


def masked(text: str, found: list[tuple[str, int, int, bool]]) -> str:
    """``text`` with every span replaced by its kind; of spans that overlap, the first names the whole."""
    parts, done = [], 0
    for kind, a, b, _ in found:
        if a >= done:
            parts += (text[done:a], f"<{kind}>")
        done = max(done, b)
    return "".join([*parts, text[done:]])


def find(
    docs: DataFrame, text: str = "text", found: str = "spans", mask: str | None = None
) -> DataFrame:
    """``docs`` with ``spans`` (kind, start, end, plain; code points, end exclusive).

    With ``mask``, also a column of that name: the text with the spans replaced (null stays null).
    """
    rows = docs.withColumn(text, docs[text].cast("string"))

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[list[pa.Array]]:
        for batch in batches:
            ends, flat, left = [0], [], []
            for value in batch.column(batch.schema.get_field_index(text)):
                said = value.as_py()
                own = spans(said) if said else []
                flat += own
                ends.append(len(flat))
                if mask is not None:
                    left.append(masked(said, own) if said else said)
            columns = list(zip(*flat)) or [()] * 4
            types = (pa.string(), pa.int64(), pa.int64(), pa.bool_())
            members = [pa.array(c, t) for c, t in zip(columns, types)]
            lists = pa.ListArray.from_arrays(
                pa.array(ends, pa.int32()), pa.StructArray.from_arrays(members, _SPAN.names)
            )
            yield [lists, *([pa.array(left, pa.string())] if mask is not None else [])]

    fields = [T.StructField(found, T.ArrayType(_SPAN))]
    if mask is not None:
        fields.append(T.StructField(mask, T.StringType()))
    return add_arrow_columns(rows, fields, make)
