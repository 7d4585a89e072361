"""Removal of every byte covered by a long string that occurs more than once.

Bounded prefixes from a Burrows-Wheeler transform: inside a block of texts, a breadth-first search
extends intervals of the transform backward, one symbol a level. The level at which a suffix-array
boundary is first met is the common prefix there, so values come out in increasing order; the search
stops at the threshold, and boundaries it never met separate suffixes that share at least that much.

How the corpus gets into blocks that are small and still hold every pair of equal strings:

* Anchors. Of each 400-byte window, the 200-byte substrings with the least hash are anchors. Equal
  windows have equal anchors at equal distances. An anchor's context is the 200 bytes on both sides of
  it, which holds every window it lies in. Anchors that occur once cannot be in a repeated window.
* Equal contexts are counted as one: if a context occurs twice, all its windows do. Only anchors
  with several different contexts remain, and each different context is sent once.
* Blocks. Contexts of one anchor meet in one block. All its windows that are equal lie at
  the same distance from the anchor, so symbols are eight bytes long, on a grid that begins at the
  anchor. The transform finds runs of 49 equal symbols; the eight bytes beside a run tell which of
  the eight windows around it are equal.
* An anchor with more than ``HOT`` different contexts is not put into one block. Its windows are
  compared by hash among the units instead, which is exact too (up to 64-bit hashes).

Anchor and context identity are 64-bit hashes.

Cases: null text counts as empty and stays null; texts shorter than the threshold lose nothing;
matches never cross documents; a string that repeats inside one document counts, overlaps too;
repeated rows remove each other; ids are not used, so null or equal ids do no harm; if a cut falls
inside a character, the text column drops the broken bytes while ``kept`` has them; empty tables give empty
tables; other columns are kept (output columns replace columns of the same name).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clipward.llm import hashing, units
from clipward.llm.units import Units

LENGTH = 400
ANCHOR = 200
SIDE = LENGTH - ANCHOR
SYMBOL = 8
RUN = LENGTH // SYMBOL - 1  # whole symbols inside a window, wherever it starts
HOT = 1024
BLOCK_BYTES = 1 << 20
SLICE = 1 << 19

_ONE = np.uint64(1)


# ---------------------------------------------------------------- bounded common prefixes


def suffix_order(symbols: np.ndarray, depth: int) -> np.ndarray:
    """Suffixes in the order of their first ``depth`` symbols at least (prefix doubling)."""
    n = len(symbols)
    rank = symbols.astype(np.int64)
    order = np.argsort(rank, kind="stable")
    reach = 1
    while reach < depth:
        after = np.zeros(n, np.int64)
        if reach < n:
            after[: n - reach] = rank[reach:] + 1
        key = rank * (max(n, int(rank.max()) + 1) + 2) + after
        order = np.argsort(key, kind="stable")
        key = key[order]
        rank[order] = np.cumsum(np.append(False, key[1:] != key[:-1]))
        reach *= 2
        if rank[order[-1]] == n - 1:
            break
    return order


def bounded_prefixes(symbols: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray]:
    """Suffix order and common prefix with the suffix before, ``limit`` standing for that or more."""
    n = len(symbols)
    order = suffix_order(symbols, limit + 1)
    place = np.empty(n, np.int64)
    place[order] = np.arange(n)
    before = symbols[order - 1]  # the transform; the first suffix wraps to the last symbol
    back = place[order - 1]  # where the suffix that is one symbol longer stands
    common = np.full(n + 1, limit, np.int64)
    common[[0, n]] = 0
    lo, hi = np.array([0]), np.array([n])
    for level in range(limit):
        if not len(lo):
            break
        sizes = hi - lo
        owner = np.repeat(np.arange(len(lo)), sizes)
        rows = np.arange(len(owner)) - np.repeat(np.cumsum(sizes) - sizes, sizes) + lo[owner]
        to = back[rows]
        turn = np.argsort(owner * (n + 1) + to)
        owner, to, symbol = owner[turn], to[turn], before[rows[turn]]
        last = np.append((owner[1:] != owner[:-1]) | (symbol[1:] != symbol[:-1]), True)
        first = np.append(True, last[:-1])
        lo, hi = to[first], to[last] + 1
        new = (hi < n) & (common[hi] == limit)
        lo, hi = lo[new], hi[new]
        common[hi] = level
    return order, common[:n]


# ---------------------------------------------------------------- anchors and contexts


def _sliding(values: np.ndarray, width: int, best: np.ufunc) -> np.ndarray:
    """``best`` over every run of ``width`` values."""
    n = len(values)
    rows = np.pad(values, (0, -n % width), mode="edge").reshape(-1, width)
    ahead = best.accumulate(rows, axis=1).ravel()
    behind = best.accumulate(rows[:, ::-1], axis=1)[:, ::-1].ravel()
    return best(behind[: n - width + 1], ahead[width - 1 : n])


_ANCHORS = ("at", "key", "context")


class _Contexts:
    """Anchors of a unit with the range and the identity of their contexts.

    ``found`` holds the anchors where an earlier pass has stored them.
    """

    def __init__(self, rows: pa.RecordBatch, text: str, found: bytes | None = None):
        texts = rows.column(rows.schema.get_field_index(text)).to_pylist()
        self.texts = [(t or "").encode() for t in texts]
        sizes = np.fromiter(map(len, self.texts), np.int64, len(self.texts))
        self.ends = np.cumsum(sizes)
        self.starts = self.ends - sizes
        self.data = np.frombuffer(b"".join(self.texts), np.uint8)
        if found is None:
            parts = [self._slice(a) for a in range(0, len(self.data), SLICE)]
            if not parts:
                parts = [(np.empty(0, np.int64),) + (np.empty(0, np.uint64),) * 2]
            self.at, self.key, self.context = map(np.concatenate, zip(*parts))
        else:
            self.at, self.key, self.context = _anchors(units.unpack_rows(found))
        self.pair = _pairs(self.key, self.context)
        own = np.searchsorted(self.ends, self.at, side="right")
        self.lo = np.maximum(self.at - SIDE, self.starts[own])
        self.hi = np.minimum(self.at + LENGTH, self.ends[own])

    def pack(self) -> bytes:
        """What ``found`` takes."""
        columns = [pa.array(self.at)] + [pa.array(c.view(np.int64)) for c in (self.key, self.context)]
        return units.pack_rows(pa.RecordBatch.from_arrays(columns, _ANCHORS))

    def _slice(self, begin: int):
        """Anchors at begin .. begin + SLICE, from a range that holds their contexts."""
        a, b = max(0, begin - LENGTH), min(len(self.data), begin + SLICE + LENGTH)
        n = b - a
        if n < LENGTH:
            return np.empty(0, np.int64), np.empty(0, np.uint64), np.empty(0, np.uint64)
        sums = hashing.byte_sums(self.data[a:b])
        place = np.arange(n - ANCHOR + 1)
        gram = hashing.byte_hashes(sums, place, place + ANCHOR) | _ONE
        least = _sliding(gram, SIDE + 1, np.minimum)
        doc = np.searchsorted(self.ends, np.arange(a, b), side="right")
        least[doc[: n - LENGTH + 1] != doc[LENGTH - 1 :]] = 0  # windows that cross documents
        side = np.zeros(SIDE, np.uint64)
        chosen = _sliding(np.concatenate([side, least, side]), SIDE + 1, np.maximum) == gram
        at = np.flatnonzero(chosen) + a
        at = at[(at >= begin) & (at < begin + SLICE)]
        own = doc[at - a]
        lo = np.maximum(at - SIDE, self.starts[own])
        hi = np.minimum(at + LENGTH, self.ends[own])
        context = hashing.byte_hashes(sums, lo - a, hi - a) + (at - lo).astype(np.uint64)
        # Least hashes are all small; mixed, they spread over the buckets.
        return at, hashing.mix(gram[at - a]), context


def _anchors(rows: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Places, keys and contexts of a unit's stored anchors."""
    at, key, context = (c.to_numpy() for c in rows.columns)
    return at, key.view(np.uint64), context.view(np.uint64)


def _pairs(key: np.ndarray, context: np.ndarray) -> np.ndarray:
    """Identity of an anchor in its context."""
    return hashing.mix(key + hashing.mix(context))


def _runs(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First places of the runs of equal ascending keys, and the run of each entry."""
    new = np.ones(len(keys), bool)
    new[1:] = keys[1:] != keys[:-1]
    return np.flatnonzero(new), np.cumsum(new) - 1


def _repeated_keys(keys: np.ndarray, values: list[np.ndarray]):
    """Answers keys that occur more than once, with a mark for the first unit that has each."""
    first, run = _runs(keys)
    leads = np.zeros(len(keys), np.int64)
    leads[first] = 1
    return (np.add.reduceat(values[0], first) > 1)[run], [leads]


_STORED = T.StructType(
    [T.StructField("unit", T.LongType()), T.StructField("payload", T.BinaryType())]
)


def _stored_anchors(packed: Units, text: str) -> Units:
    """Anchors of every unit, found once; four later passes read them."""

    def make(unit: int, rows: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        payload = _Contexts(rows, text).pack()
        yield pa.RecordBatch.from_arrays([pa.array([unit]), pa.array([payload], pa.binary())], _STORED.names)

    frame = units.by_unit(units.each_unit(packed, make, _STORED), "anchors")
    return Units(frame.select("unit", "payload"), _STORED, packed.n_bytes)


def _pair_entries(known: Units) -> DataFrame:
    """Answers the contexts that occur more than once."""
    n_buckets = known.n_buckets

    def make(unit: int, rows: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        _, key, context = _anchors(rows)
        keys, times = np.unique(_pairs(key, context), return_counts=True)
        if len(keys):
            yield units.entry_batch(unit, keys, [np.minimum(times, 2)], n_buckets)

    return units.shared(units.each_unit(known, make, units.ENTRY), _repeated_keys)


def _shared_anchors(known: Units, pairs: DataFrame, hot: int) -> DataFrame:
    """Answers anchors that have several contexts, one of them unique, and whether they are hot."""
    n_buckets = known.n_buckets

    def make(unit: int, rows: pa.RecordBatch, answer: list[dict]) -> Iterator[pa.RecordBatch]:
        _, key, context = _anchors(rows)
        if not len(key):
            return
        again, _ = units.answered(answer)
        pair = _pairs(key, context)
        single = ~units.find(pair, again)[0]
        order = np.lexsort((pair, key))
        key, pair = key[order], pair[order]
        new_pair = np.ones(len(pair), np.int64)
        new_pair[1:] = (pair[1:] != pair[:-1]) | (key[1:] != key[:-1])
        first, _ = _runs(key)
        yield units.entry_batch(
            unit,
            key[first],
            [
                np.add.reduceat(new_pair, first),
                np.maximum.reduceat(single[order].astype(np.int64), first),
                np.minimum.reduceat(pair, first).view(np.int64),
                np.maximum.reduceat(pair, first).view(np.int64),
            ],
            n_buckets,
        )

    def decide(keys: np.ndarray, values: list[np.ndarray]):
        first, run = _runs(keys)
        n, single, low, high = values
        several = np.minimum.reduceat(low.view(np.uint64), first) != np.maximum.reduceat(
            high.view(np.uint64), first
        )
        open_ = several & (np.maximum.reduceat(single, first) > 0)
        is_hot = np.add.reduceat(n, first) > hot
        return open_[run], [is_hot.astype(np.int64)[run]]

    return units.shared(units.each_unit(known, make, units.ENTRY, (pairs,)), decide)


class _Marks:
    """Of a unit's anchors: repeated as a whole, sent to a block, dealt by windows."""

    def __init__(self, held: _Contexts, pairs: list[dict], anchors: list[dict]):
        again, leads = units.answered(pairs)
        known, at = units.find(held.pair, again)
        self.whole = known
        leader = np.where(known, leads[0][at], 1) if len(again) else np.ones(len(known))
        shared, hot = units.answered(anchors)
        open_, at = units.find(held.key, shared)
        is_hot = open_ & (hot[0][at] > 0) if len(shared) else open_
        first = np.zeros(len(known), bool)
        first[np.unique(held.pair, return_index=True)[1]] = True
        send = open_ & first & (leader > 0)
        self.sent = np.flatnonzero(send & ~is_hot)
        self.dealt = np.flatnonzero(send & is_hot)


def _window_keys(held: _Contexts, chosen: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Starts and keys of all windows of the chosen anchors: content, anchor and distance."""
    for part in np.array_split(chosen, -(-len(chosen) // 512)) if len(chosen) else []:
        n = held.hi[part] - held.lo[part] - LENGTH + 1
        own = np.repeat(part, n)
        start = np.arange(len(own)) - np.repeat(np.cumsum(n) - n, n) + held.lo[own]
        away = (held.at[own] - start).astype(np.uint64)
        window = _window_hashes(held.data, start)
        yield start, hashing.mix(window + hashing.mix(held.key[own] + away))


def _hot_windows(
    packed: Units, known: DataFrame, pairs: DataFrame, anchors: DataFrame, text: str
) -> DataFrame:
    """Answers the repeated windows of hot anchors."""
    n_buckets = packed.n_buckets

    def make(unit, rows, known_here, pairs_here, anchors_here) -> Iterator[pa.RecordBatch]:
        if not anchors_here:
            return
        held = _Contexts(rows, text, known_here)
        keys = [k for _, k in _window_keys(held, _Marks(held, pairs_here, anchors_here).dealt)]
        if keys:
            keys, times = np.unique(np.concatenate(keys), return_counts=True)
            yield units.entry_batch(unit, keys, [np.minimum(times, 2)], n_buckets)

    return units.shared(
        units.each_unit(packed, make, units.ENTRY, (known, pairs, anchors)), _repeated_keys
    )


_SENT = T.StructType(
    [
        T.StructField("block", T.IntegerType()),
        T.StructField("unit", T.LongType()),
        T.StructField("anchor", T.LongType()),
        T.StructField("pair", T.LongType()),
        T.StructField("left", T.IntegerType()),
        T.StructField("context", T.BinaryType()),
    ]
)


def _sent(
    packed: Units, known: DataFrame, pairs: DataFrame, anchors: DataFrame, text: str, n_blocks: int
) -> DataFrame:
    """One copy of each different context of the anchors that have several."""
    shift = np.uint64(64 - (n_blocks.bit_length() - 1))

    def make(unit, rows, known_here, pairs_here, anchors_here) -> Iterator[pa.RecordBatch]:
        if not anchors_here:
            return
        held = _Contexts(rows, text, known_here)
        sent = _Marks(held, pairs_here, anchors_here).sent
        contexts = [held.data[a:b].tobytes() for a, b in zip(held.lo[sent], held.hi[sent])]
        key = held.key[sent]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array((key >> shift).astype(np.int32)),
                pa.array(np.full(len(sent), unit, np.int64)),
                pa.array(key.view(np.int64)),
                pa.array(held.pair[sent].view(np.int64)),
                pa.array((held.at[sent] - held.lo[sent]).astype(np.int32)),
                pa.array(contexts, pa.binary()),
            ],
            _SENT.names,
        )

    return units.each_unit(packed, make, _SENT, (known, pairs, anchors))


def _window_hashes(data: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Hashes of the windows at ``start``, taken span by span of the ranges they lie in."""
    out = np.empty(len(start), np.uint64)
    order = np.argsort(start, kind="stable")
    at = 0
    while at < len(start):
        a = int(start[order[at]])
        end = int(np.searchsorted(start[order], a + SLICE, side="right"))
        own = order[at:end]
        sums = hashing.byte_sums(data[a : a + SLICE + LENGTH])
        out[own] = hashing.byte_hashes(sums, start[own] - a, start[own] - a + LENGTH)
        at = end
    return out


# ---------------------------------------------------------------- blocks


def _equal_windows(anchor: np.ndarray, left: np.ndarray, contexts: list[bytes]):
    """(context, distance of the window's start before the anchor) of windows that are repeated."""
    sizes = np.fromiter(map(len, contexts), np.int64, len(contexts))
    grid = left % SYMBOL
    n_symbols = (sizes - grid) // SYMBOL
    _, symbols = np.unique(
        np.concatenate(
            [np.frombuffer(c, "<u8", n, g) for c, n, g in zip(contexts, n_symbols, grid)]
        ),
        return_inverse=True,
    )
    # Each context ends with a symbol of its own, so no common prefix runs over an end.
    ends = np.cumsum(n_symbols)
    text = np.insert(symbols, ends, symbols.max() + 1 + np.arange(len(contexts)))
    order, common = bounded_prefixes(text, RUN)
    of = np.repeat(np.arange(len(contexts)), n_symbols + 1)
    step = np.arange(len(text)) - (ends - n_symbols + np.arange(len(contexts)))[of]
    whole = (step + RUN <= n_symbols[of])[order]
    group = np.cumsum(common < RUN)[whole]
    own, step = of[order][whole], step[order][whole]
    alike = np.bincount(group)[group] > 1
    group, own, step = group[alike], own[alike], step[alike]
    if not len(own):
        return own, own
    run = grid[own] + step * SYMBOL  # first byte of the run in its context
    starts = np.cumsum(sizes) - sizes
    data = np.frombuffer(b"".join([*contexts, bytes(SYMBOL)]), np.uint8)
    found = []
    for ahead in range(SYMBOL):
        inside = (run >= ahead) & (run + LENGTH - ahead <= sizes[own])
        o, r = own[inside], run[inside]
        place = np.arange(SYMBOL)
        place = np.where(place < ahead, place - ahead, place + RUN * SYMBOL - ahead)
        beside = data[(starts[o] + r)[:, None] + place].view("<u8").ravel()
        key = (anchor[o], group[inside], left[o] - r, beside)
        turn = np.lexsort(key)
        same = np.ones(max(len(turn) - 1, 0), bool)
        for k in key:
            same &= k[turn][1:] == k[turn][:-1]
        twice = np.append(same, False) | np.append(False, same)
        turn = turn[twice[: len(turn)]]
        found.append((o[turn], (left[o] - r + ahead)[turn]))
    return tuple(np.concatenate(f) for f in zip(*found))


def _repeated(sent: DataFrame) -> DataFrame:
    """Answers (pair; first distance, number of distances) of repeated windows, by unit."""

    def run(table: pa.Table) -> pa.Table:
        names = ("unit", "anchor", "pair", "left")
        unit, anchor, pair, left = (table.column(n).to_numpy() for n in names)
        own, away = np.empty(0, np.int64), np.empty(0, np.int64)
        # Only anchors with two contexts here can have equal windows.
        _, at, n = np.unique(anchor, return_inverse=True, return_counts=True)
        several = np.flatnonzero(n[at] > 1)
        if len(several):
            contexts = table.column("context").take(pa.array(several)).to_pylist()
            own, away = _equal_windows(anchor[several], left[several].astype(np.int64), contexts)
            own = several[own]
        unit, pair = unit[own], pair[own].view(np.uint64)
        order = np.lexsort((away, pair, unit))
        unit, pair, away = unit[order], pair[order], away[order]
        new = np.ones(len(unit), bool)
        new[1:] = (unit[1:] != unit[:-1]) | (pair[1:] != pair[:-1]) | (away[1:] != away[:-1] + 1)
        first = np.flatnonzero(new)
        length = np.diff([*first, len(unit)])
        unit, pair, away = unit[first], pair[first], away[first].astype(np.int64)
        names, cuts = np.unique(unit, return_index=True)
        cuts = list(zip(cuts, [*cuts[1:], len(unit)]))
        return pa.table(
            {
                "unit": pa.array(names, pa.int64()),
                "keys": pa.array([units.pack_ints(pair[a:b], True) for a, b in cuts], pa.binary()),
                "values": pa.array(
                    [[units.pack_ints(v[a:b]) for v in (away, length)] for a, b in cuts],
                    pa.list_(pa.binary()),
                ),
            }
        )

    found = sent.groupBy("block").applyInArrow(
        run, "unit long, keys binary, values array<binary>"
    )
    return found.groupBy("unit").agg(F.collect_list(F.struct("keys", "values")).alias("answer"))


# ---------------------------------------------------------------- the operator


def _gone(held: _Contexts, pairs, anchors, hot, found: list[dict]) -> np.ndarray:
    """Which bytes of a unit lie in a repeated window."""
    marks = _Marks(held, pairs, anchors)
    change = np.zeros(len(held.data) + 1, np.int64)
    np.add.at(change, held.lo[marks.whole], 1)
    np.add.at(change, held.hi[marks.whole], -1)
    again, _ = units.answered(hot)
    for start, keys in _window_keys(held, marks.dealt if len(again) else marks.dealt[:0]):
        start = start[units.find(keys, again)[0]]
        np.add.at(change, start, 1)
        np.add.at(change, start + LENGTH, -1)
    own, values = units.answered(found)
    if len(own):
        order = np.argsort(held.pair)
        mine = held.pair[order]
        a, b = np.searchsorted(mine, own), np.searchsorted(mine, own, side="right")
        run = np.repeat(np.arange(len(own)), b - a)
        nth = np.arange(len(run)) - np.repeat(np.cumsum(b - a) - (b - a), b - a)
        at = held.at[order[a[run] + nth]]
        away, length = values[0][run], values[1][run]
        np.add.at(change, at - away - length + 1, 1)
        np.add.at(change, at - away + LENGTH, -1)
    return np.cumsum(change[:-1]) > 0


def remove_repeats(
    docs: DataFrame, text: str = "text", kept: str = "kept", hot: int = HOT
) -> DataFrame:
    """``docs`` with ``kept`` binary, ``n_bytes``, ``n_removed`` and ``n_spans``.

    ``text`` becomes the kept bytes as text.
    """
    counts = ("n_bytes", "n_removed", "n_spans")
    rows = docs.drop(kept, *counts).withColumn(text, docs[text].cast("string"))
    packed = units.pack(rows, text)
    n_blocks = 1 << max(6, (packed.n_bytes // BLOCK_BYTES).bit_length())
    contexts = _stored_anchors(packed, text)
    known = contexts.frame.withColumnRenamed("payload", "answer")
    # Stored, since three later passes read them.
    pairs = units.by_unit(_pair_entries(contexts), "pairs")
    anchors = units.by_unit(_shared_anchors(contexts, pairs, hot), "shared")
    windows = _hot_windows(packed, known, pairs, anchors, text)
    found = _repeated(_sent(packed, known, pairs, anchors, text, n_blocks))

    def make(unit, rows, known_here, *answers) -> Iterator[pa.RecordBatch]:
        held = _Contexts(rows, text, known_here)
        gone = _gone(held, *answers)
        left, removed, spans = [], [], []
        for whole, a, b in zip(held.texts, held.starts, held.ends):
            marks = gone[a:b]
            n = int(marks.sum())
            removed.append(n)
            spans.append(int((np.diff(marks.astype(np.int8), prepend=0) == 1).sum()) if n else 0)
            left.append(held.data[a:b][~marks].tobytes() if n else whole)
        place = rows.schema.get_field_index(text)
        was = rows.column(place)
        cut = pa.array([t.decode(errors="ignore") for t in left], pa.string())
        new = pa.compute.if_else(was.is_valid(), cut, pa.scalar(None, pa.string()))
        columns = [new if i == place else c for i, c in enumerate(rows.columns)]
        sizes = held.ends - held.starts
        extra = [pa.array(left, pa.binary()), *(pa.array(v, pa.int64()) for v in (sizes, removed, spans))]
        yield pa.RecordBatch.from_arrays(
            [*columns, *extra], [*rows.schema.names, kept, *counts]
        )

    schema = T.StructType(
        [
            *packed.schema.fields,
            T.StructField(kept, T.BinaryType()),
            *(T.StructField(c, T.LongType()) for c in counts),
        ]
    )
    return units.each_unit(packed, make, schema, (known, pairs, anchors, windows, found))
