"""Removal of word windows that start in an earlier document too, by difference-cover anchors.

A window is ``WINDOW`` consecutive words. Positions whose residue modulo ``PERIOD`` is in the
difference cover carry an anchor, the hash of the ``ANCHOR`` words that begin there. For any two
positions there is a shift below the period that puts both on cover positions, and window and
anchor lengths leave room for it: equal windows always share an anchor at the same distance. So only
anchors are compared between all documents (3 of 7 positions), and only windows around a shared
anchor are extended to full length and compared. An occurrence goes if its window's smallest
document id is smaller than its own.

Window identity is a 64-bit hash of the words' 64-bit hashes; the chance that a given window is
confused is the number of compared windows over 2**64.

Cases: null text has no words; documents with fewer words than a window lose nothing; a null id is
larger than any other id and two null ids are equal; rows with equal ids never remove words from
each other; repeated rows follow from that; overlaps count once; judgement is on the input, not on
what is left; empty tables give empty tables; other columns, whatever their names, are kept (the
output columns replace columns of the same name).
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from clipward.llm import hashing, units
from clipward.llm.units import Units

WINDOW = 13
PERIOD = 7
COVER = (1, 2, 4)
ANCHOR = WINDOW - PERIOD + 1

_LAST = np.iinfo(np.int64).max
_LOW16 = np.uint64(0xFFFF)


class _Words:
    """Word hashes of a unit's documents with their places."""

    def __init__(self, rows: pa.RecordBatch, id_col: str, text: str):
        texts = rows.column(rows.schema.get_field_index(text)).to_pylist()
        self.texts = [(t or "").encode() for t in texts]
        ids = rows.column(rows.schema.get_field_index(id_col)).to_pylist()
        self.ids = np.array([_LAST if i is None else i for i in ids], np.int64)
        data, starts = hashing.joined(self.texts)
        self.lo, self.hi, self.hashes = hashing.words(data)
        self.doc_starts = starts
        self.doc = np.searchsorted(starts, self.lo, side="right") - 1
        first = np.searchsorted(self.doc, np.arange(len(self.texts)))
        self.counts = np.diff([*first, len(self.doc)])
        self.first = first
        self.position = np.arange(len(self.doc)) - first[self.doc]

    def whole(self, size: int) -> np.ndarray:
        """Whether a run of ``size`` words from here stays in its document."""
        n = len(self.doc) - size + 1
        return self.doc[:n] == self.doc[size - 1 :] if n > 0 else np.zeros(0, bool)

    def anchors(self) -> tuple[np.ndarray, np.ndarray]:
        """Cover positions and their anchors (leading 48 bits: they only select candidates)."""
        whole = self.whole(ANCHOR)
        at = np.flatnonzero(whole & np.isin(self.position[: len(whole)] % PERIOD, COVER))
        return at, hashing.window_hashes(self.hashes, ANCHOR)[at] & ~_LOW16

    def windows(self) -> tuple[np.ndarray, np.ndarray]:
        at = np.flatnonzero(self.whole(WINDOW))
        return at, hashing.window_hashes(self.hashes, WINDOW)[at]


def _by_key(keys: np.ndarray, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys, ascending, with their least and greatest id."""
    order = np.argsort(keys, kind="stable")
    keys, ids = keys[order], ids[order]
    first = np.flatnonzero(np.diff(keys, prepend=~keys[:1]) != 0)
    if not len(first):
        return keys, ids, ids
    return keys[first], np.minimum.reduceat(ids, first), np.maximum.reduceat(ids, first)


def _groups(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First places of the runs of equal ascending keys, and the run of each entry."""
    new = np.ones(len(keys), bool)
    new[1:] = keys[1:] != keys[:-1]
    return np.flatnonzero(new), np.cumsum(new) - 1


def _shared_anchors(packed: Units, id_col: str, text: str) -> DataFrame:
    n_buckets = packed.n_buckets

    def make(unit: int, rows: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        held = _Words(rows, id_col, text)
        at, keys = held.anchors()
        keys, lo, hi = _by_key(keys, held.ids[held.doc[at]])
        if len(keys):
            yield units.entry_batch(unit, keys, [(lo < hi).astype(np.int64)], n_buckets)

    def decide(keys: np.ndarray, values: list[np.ndarray]):
        first, run = _groups(keys)
        sizes = np.diff([*first, len(keys)])
        again = (sizes > 1) | (np.maximum.reduceat(values[0], first) > 0)
        return again[run], []

    return units.shared(units.each_unit(packed, make, units.ENTRY), decide)


def _earlier_windows(packed: Units, anchors: DataFrame, id_col: str, text: str) -> DataFrame:
    n_buckets = packed.n_buckets

    def make(unit: int, rows: pa.RecordBatch, answer: list[dict]) -> Iterator[pa.RecordBatch]:
        again, _ = units.answered(answer)
        if not len(again):
            return
        held = _Words(rows, id_col, text)
        at, keys = held.anchors()
        at = at[units.find(keys, again)[0]]
        # An anchor at a lies in the windows that start at a - (PERIOD - 1) .. a.
        near = hashing.covered(np.maximum(at - PERIOD + 1, 0), PERIOD, len(held.doc))
        start, keys = held.windows()
        kept = near[start]
        keys, lo, hi = _by_key(keys[kept], held.ids[held.doc[start[kept]]])
        if len(keys):
            yield units.entry_batch(unit, keys, [lo, hi], n_buckets)

    def decide(keys: np.ndarray, values: list[np.ndarray]):
        first, run = _groups(keys)
        least = np.minimum.reduceat(values[0], first)[run]
        return least < values[1], [least]

    return units.shared(units.each_unit(packed, make, units.ENTRY, (anchors,)), decide)


def remove_repeats(
    docs: DataFrame, id_col: str = "doc_id", text: str = "text", single_spaces: bool = False
) -> DataFrame:
    """``docs`` with ``text`` cut, and ``n_words`` and ``n_removed``.

    Removed words go with the white space after them. ``single_spaces`` joins all kept words by one
    space instead of keeping the original white space.
    """
    names = ("n_words", "n_removed")
    kept = docs.drop(*names).withColumn(text, docs[text].cast("string"))
    packed = units.pack(kept, text)
    anchors = _shared_anchors(packed, id_col, text)
    earlier = _earlier_windows(packed, anchors, id_col, text)

    def make(unit: int, rows: pa.RecordBatch, answer: list[dict]) -> Iterator[pa.RecordBatch]:
        held = _Words(rows, id_col, text)
        keys, values = units.answered(answer)
        start, found = held.windows()
        hit, at = units.find(found, keys)
        if hit.any():
            start, at = start[hit], at[hit]
            start = start[values[0][at] < held.ids[held.doc[start]]]
        else:
            start = start[:0]
        gone = hashing.covered(start, WINDOW, len(held.doc))
        removed = np.bincount(held.doc[gone], minlength=len(held.texts))
        texts = []
        for i, whole in enumerate(held.texts):
            a, n = held.first[i], held.counts[i]
            if single_spaces:
                texts.append(b" ".join(compress(whole.split(), ~gone[a : a + n])))
            elif removed[i]:
                texts.append(_cut(whole, held.lo[a : a + n] - held.doc_starts[i], gone[a : a + n]))
            else:
                texts.append(whole)
        place = rows.schema.get_field_index(text)
        was = rows.column(place)
        cut = pa.array([t.decode() for t in texts], pa.string())
        new = pa.compute.if_else(was.is_valid(), cut, pa.scalar(None, pa.string()))
        columns = [new if i == place else c for i, c in enumerate(rows.columns)]
        counts = [pa.array(held.counts, pa.int64()), pa.array(removed, pa.int64())]
        yield pa.RecordBatch.from_arrays([*columns, *counts], [*rows.schema.names, *names])

    schema = T.StructType([*packed.schema.fields, *(T.StructField(n, T.LongType()) for n in names)])
    return units.each_unit(packed, make, schema, (earlier,))


def _cut(text: bytes, starts: np.ndarray, gone: np.ndarray) -> bytes:
    """``text`` without the words marked gone and the white space after them."""
    bounds = np.append(starts, len(text))
    change = np.flatnonzero(np.diff(gone.astype(np.int8), prepend=0, append=0))
    parts, at = [], 0
    for a, b in zip(change[::2], change[1::2]):
        parts.append(text[at : bounds[a]])
        at = bounds[b]
    return b"".join([*parts, text[at:]])
