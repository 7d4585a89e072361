"""Fill-in-the-middle rearrangement of texts, cut at unit boundaries found in a wavelet matrix.

Every character gets a class: line feed, other white space, sentence mark or anything else, and whether the
character is the last before white space (or the end). Units end at characters of certain classes; what
follows the last of them is a unit too. So the number of units before a place is a sum of ranks in the
wavelet matrix of the classes, and the place after a number of units is found by bisection on these sums.

Draws depend on the seed and the id only: the first four 8-digit groups of the hex SHA-256 of
``seed:id`` give the two cuts, whether the text stays plain, and which of the two forms it takes.
The text is rebuilt from the output and the form alone.

Cases: null texts count as empty; empty texts and texts that hold a sentinel stay plain; a null id
draws by ``seed:``; prefix, middle and suffix may be empty; equal ids draw alike; very long texts are one row's
work in a few bytes a character; empty tables give empty tables; other columns are kept (output
columns replace columns of the same name).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from clipward.llm.frames import add_arrow_columns
from clipward.llm.wavelet import WaveletMatrix

LEVELS = 3
LINE_FEED, BLANK, MARK, OTHER = range(4)
LAST = 4  # added to the class of a word's last character

#: Classes whose characters end a unit.
UNITS = {
    "line": (LINE_FEED,),
    "sentence": (LINE_FEED, MARK + LAST),
    "word": (MARK + LAST, OTHER + LAST),
    "char": (LINE_FEED, BLANK, MARK, OTHER, MARK + LAST, OTHER + LAST),
}

_SPACES = np.array([0x09, 0x0B, 0x0C, 0x0D, 0x20, 0x85, 0xA0, 0x2028, 0x2029, 0x3000], np.uint32)
_MARKS = np.array([ord(c) for c in ".!?…。！？"], np.uint32)
_SLICE = 1 << 20


@dataclass(frozen=True)
class Sentinels:
    prefix: str = "<P>"
    suffix: str = "<S>"
    middle: str = "<M>"

    def __iter__(self) -> Iterator[str]:
        return iter((self.prefix, self.suffix, self.middle))


def _class_table() -> np.ndarray:
    table = np.full(1 << 16, OTHER, np.uint8)
    table[_SPACES], table[_MARKS], table[0x0A] = BLANK, MARK, LINE_FEED
    return table


def classes(text: str, table: np.ndarray) -> np.ndarray:
    """The class of every character."""
    out = np.empty(len(text), np.uint8)
    for a in range(0, len(text), _SLICE):
        points = np.frombuffer(text[a : a + _SLICE].encode("utf-32-le", "surrogatepass"), "<u4")
        out[a : a + _SLICE] = table[np.minimum(points, len(table) - 1)]
    blank = np.append(out <= BLANK, True)
    out[~blank[:-1] & blank[1:]] += LAST
    return out


class Boundaries:
    """Units of one text: their number, and the place after each number of them."""

    def __init__(self, text: str, unit: str, table: np.ndarray):
        self.ends = UNITS[unit]
        codes = classes(text, table)
        self.matrix = WaveletMatrix(codes, LEVELS)
        closed = self.matrix.count(self.ends, len(text))
        self.n = closed + (len(text) > 0 and int(codes[-1]) not in self.ends)

    def place(self, k: int) -> int:
        return self.matrix.after(self.ends, k)


def draws(seed: int, key: object) -> list[int]:
    """Four unsigned integers of 32 bits."""
    digest = hashlib.sha256(f"{seed}:{'' if key is None else key}".encode()).hexdigest()
    return [int(digest[i : i + 8], 16) for i in range(0, 32, 8)]


def rearrange(prefix: str, middle: str, suffix: str, form: str, marks: Sentinels) -> str:
    if form == "spm":
        return f"{marks.suffix}{suffix}{marks.prefix}{prefix}{marks.middle}{middle}"
    return f"{marks.prefix}{prefix}{marks.suffix}{suffix}{marks.middle}{middle}"


def restore(output: str, form: str, marks: Sentinels = Sentinels()) -> str:
    """The text that ``output`` was made from. No part holds a sentinel, so each stands there once."""
    if form == "plain":
        return output
    first, second = (marks.suffix, marks.prefix) if form == "spm" else (marks.prefix, marks.suffix)
    one, rest = output.removeprefix(first).split(second, 1)
    two, middle = rest.split(marks.middle, 1)
    prefix, suffix = (two, one) if form == "spm" else (one, two)
    return prefix + middle + suffix


def transform(
    docs: DataFrame,
    id_col: str = "doc_id",
    text: str = "text",
    unit: str = "line",
    seed: int = 7,
    rate: int = 100,
    spm_rate: int = 50,
    marks: Sentinels = Sentinels(),
) -> DataFrame:
    """``docs`` with ``n`` (units), ``form``, ``prefix_chars``, ``middle_chars``, ``output`` and ``restored``.

    ``rate`` per cent of the texts are rearranged, ``spm_rate`` per cent of them with the suffix first.
    """
    rows = docs.withColumn(text, docs[text].cast("string"))

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[list[pa.Array]]:
        table = _class_table()
        for batch in batches:
            keys = batch.column(batch.schema.get_field_index(id_col)).to_pylist()
            units, forms, sizes, outputs, back = [], [], [], [], []
            for key, value in zip(keys, batch.column(batch.schema.get_field_index(text))):
                said = value.as_py() or ""
                bounds = Boundaries(said, unit, table)
                h1, h2, h3, h4 = draws(seed, key)
                if not said or h3 % 100 >= rate or any(m in said for m in marks):
                    form, size, output = "plain", (None, None), said
                else:
                    a, b = sorted((h1 % (bounds.n + 1), h2 % (bounds.n + 1)))
                    a, b = bounds.place(a), bounds.place(b)
                    form, size = "spm" if h4 % 100 < spm_rate else "psm", (a, b - a)
                    output = rearrange(said[:a], said[a:b], said[b:], form, marks)
                units.append(bounds.n)
                forms.append(form)
                sizes.append(size)
                outputs.append(output)
                back.append(restore(output, form, marks))
            yield [
                pa.array(units, pa.int64()),
                pa.array(forms, pa.string()),
                pa.array([s[0] for s in sizes], pa.int64()),
                pa.array([s[1] for s in sizes], pa.int64()),
                pa.array(outputs, pa.string()),
                pa.array(back, pa.string()),
            ]

    fields = [
        T.StructField("n", T.LongType()),
        T.StructField("form", T.StringType()),
        T.StructField("prefix_chars", T.LongType()),
        T.StructField("middle_chars", T.LongType()),
        T.StructField("output", T.StringType()),
        T.StructField("restored", T.StringType()),
    ]
    return add_arrow_columns(rows, fields, make)
