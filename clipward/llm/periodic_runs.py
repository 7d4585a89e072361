"""Periodic runs of words by seeds on diagonals, and texts with such runs collapsed.

A run is a stretch of words with smallest period q (words q apart are equal) that neither neighbour
extends, of at least ``max(MIN_WORDS, MIN_PERIODS * q)`` words. On the diagonal of lag q, its words
match their partners q ahead over at least ``max(24 - q, 2 * q)`` places, so never over less than 16.

* Seeds. Windows of k words are indexed per document, k being an overlap that every run of the scale must have:
  16 for periods up to 16, then 32 for 17 to 32, 64 for 33 to 64 and so on. As k is never below the
  period, the next occurrence of a seed inside a run lies exactly q ahead (two periods of one stretch
  would share a divisor), so each place is paired with its next occurrence only. A document of one repeated
  word makes as many pairs as it has places, not their square.
* Extension. Pairs are taken by lag and place and extended both ways along their diagonal, in
  word comparisons. A table holds how far each lag is covered; pairs below it are not extended again.
* Scales. A window of 2k words can only repeat where its first k words do, so each scale looks at what the
  last one left, and most documents end after the first.

Words are compared by 64-bit hashes.

Cases: null and empty texts have no words and no runs and collapse to an empty text; equal rows give
equal results; very long texts are one row's work in O(n log n); null ids do no harm, ids are not used; empty tables give
empty tables; other columns are kept (output columns replace columns of the same name).
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from clipward.llm import hashing
from clipward.llm.frames import add_arrow_columns

MIN_WORDS = 24
MIN_PERIODS = 3
SEED = 16  # least overlap of a run with itself, one period on

_DOC = np.uint64(0x9E3779B97F4A7C15)
_RUN = T.StructType([T.StructField(n, T.LongType(), False) for n in ("start", "length", "period")])


def _next_places(keys: np.ndarray, places: np.ndarray) -> np.ndarray:
    """For each of the ascending ``places``: the next one with the same key, or -1."""
    order = np.argsort(keys, kind="stable")
    same = keys[order[1:]] == keys[order[:-1]]
    following = np.full(len(keys), -1, np.int64)
    following[order[:-1][same]] = places[order[1:][same]]
    return following


def _reach(words: np.ndarray, a: int, b: int, limit: int, step: int) -> int:
    """How many words from ``a`` and ``b`` on are pairwise equal in one direction, at most ``limit``."""
    done, size = 0, 64
    while done < limit:
        n = min(size, limit - done)
        if step > 0:
            differ = words[a + done : a + done + n] != words[b + done : b + done + n]
        else:
            differ = (words[a - done - n + 1 : a - done + 1] != words[b - done - n + 1 : b - done + 1])[::-1]
        at = int(differ.argmax())
        if differ[at]:
            return done + at
        done, size = done + n, size * 4
    return done


def runs(words: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, length, period) of all runs by start, then period.

    ``words`` holds word hashes of documents one after another, ``begins`` where each document begins.
    """
    ends = np.append(begins[1:], len(words)).astype(np.int64)
    doc = np.repeat(np.arange(len(begins)), ends - begins)
    found: list[tuple[int, int, int]] = []
    places, size, least = np.arange(len(words)), SEED, 1
    while len(places):
        places = places[places + size <= ends[doc[places]]]
        keys = hashing.window_hashes(words, size)[places]
        following = _next_places(hashing.mix(keys + doc[places].astype(np.uint64) * _DOC), places)
        lag = following - places
        seed = (following >= 0) & (lag >= least) & (lag <= size)
        at, lag = places[seed], lag[seed]
        order = np.lexsort((at, lag))
        at, lag = at[order], lag[order]
        # A seed one place after another of its lag lies on a stretch that is already covered.
        fresh = np.ones(len(at), bool)
        fresh[1:] = (lag[1:] != lag[:-1]) | (at[1:] != at[:-1] + 1)
        covered: dict[int, int] = {}
        for i, q in zip(at[fresh].tolist(), lag[fresh].tolist()):
            if i < covered.get(q, 0):
                continue
            first, end = int(begins[doc[i]]), int(ends[doc[i]])
            ahead = _reach(words, i, i + q, end - i - q, 1)
            behind = _reach(words, i - 1, i - 1 + q, i - first, -1)
            covered[q] = i + ahead
            length = behind + ahead + q
            if length >= max(MIN_WORDS, MIN_PERIODS * q):
                found.append((i - behind, length, q))
        # Larger windows repeat only where these do.
        places = np.union1d(places[following >= 0], following[following >= 0])
        size, least = 2 * size, size + 1
    table = np.array(sorted(found, key=lambda r: (r[0], r[2])), np.int64).reshape(-1, 3)
    return table[:, 0], table[:, 1], table[:, 2]


def collapse(
    docs: DataFrame, text: str = "text", found: str = "runs", collapsed: str = "collapsed", n_words: str = "n_words"
) -> DataFrame:
    """``docs`` with ``n_words``, ``runs`` (start, length, period; in words) and ``collapsed``.

    ``collapsed`` keeps the first period of every run and all words outside runs, joined by one space.
    """
    rows = docs.withColumn(text, docs[text].cast("string"))

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[list[pa.Array]]:
        for batch in batches:
            column = batch.column(batch.schema.get_field_index(text))
            texts = [(t or "").encode() for t in column.to_pylist()]
            data, starts = hashing.joined(texts)
            lo, _, words = hashing.words(data)
            doc = np.searchsorted(starts, lo, side="right") - 1
            counts = np.bincount(doc, minlength=len(texts))
            begins = np.cumsum(counts) - counts
            start, length, period = runs(words, begins)
            change = np.zeros(len(words) + 1, np.int64)
            np.add.at(change, start + period, 1)
            np.add.at(change, start + length, -1)
            kept = np.cumsum(change[:-1]) == 0
            own = doc[start]
            cuts = np.searchsorted(own, np.arange(len(texts) + 1))
            left = []
            for i, whole in enumerate(texts):
                said = whole.split()
                if cuts[i] < cuts[i + 1]:
                    said = compress(said, kept[begins[i] : begins[i] + counts[i]])
                left.append(b" ".join(said).decode())
            members = [pa.array(v, pa.int64()) for v in (start - begins[own], length, period)]
            fields = [pa.field(f.name, pa.int64(), False) for f in _RUN.fields]
            lists = pa.ListArray.from_arrays(
                pa.array(cuts, pa.int32()), pa.StructArray.from_arrays(members, fields=fields)
            )
            lists = lists.cast(pa.list_(pa.field("element", pa.struct(fields), False)))
            yield [pa.array(counts, pa.int64()), lists, pa.array(left, pa.string())]

    columns = [
        T.StructField(n_words, T.LongType()),
        T.StructField(found, T.ArrayType(_RUN, False)),
        T.StructField(collapsed, T.StringType()),
    ]
    return add_arrow_columns(rows, columns, make)
