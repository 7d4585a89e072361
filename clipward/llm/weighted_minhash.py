"""Near-duplicate documents by consistent weighted sampling over TF-IDF shingles.

A document is its set of five-word shingles, each weighing its count times an inverse document
frequency over all documents, 1 + ln((1 + N) / (1 + df)) / ln(1 + N). The scale keeps a rare shingle
at no more than twice a common one; otherwise copies in a large group would count as unlike because
what they share is frequent. Per sample, every shingle draws r, c (gamma) and beta (uniform) from its hash;
t = floor(ln w / r + beta), ln a = ln c - r (t - beta) - r, and the least a gives the sample (shingle, t).
Two documents agree on a sample with their weighted Jaccard similarity.

``BANDS`` bands of ``ROWS`` samples propose pairs, in two rounds. First, within a band key, each unit of
documents and then each bucket compares sample lists and proposes, per document, its two nearest
earlier documents, so a group of m documents makes at most 2m pairs. Every pair is verified with the
exact weighted Jaccard similarity; classes are the connected components of the verified links. Then
every band key that still holds more than one class proposes all its pairs of different classes, one
document for equal vectors of a class; they are verified too. So a pair that shares a band key is left
out only if it is refused exactly, in one class already, or too unlike in total weight or in weight by hash
class: the sum of the class-wise minima bounds what two documents can share, so most pairs are refused
exactly without sending a vector. Keys with
many such documents are compared in blocks of ``CELL``; their pairs grow with the square of the
documents that are alike enough for a key and yet in different classes.

Cases: documents with fewer than five words are one shingle; documents without words (null or empty
text) are alone in their class; equal texts are linked; a class is named by its smallest document id
(nulls last; a class of null ids has a null name); repeated rows are documents of their own and fall
into one class; empty tables give empty tables; other columns are kept where rows are returned.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clipward.llm import graphs, hashing, units
from clipward.llm.frames import stored
from clipward.llm.units import Units

SHINGLE = 5
BANDS = 10
ROWS = 3
THRESHOLD = 0.8
LIKELY = 0.6  # share of equal samples from which a pair is verified
BLOCK = 256
CELL = 1024  # documents of a key compared at once in the second round
VECTORS = 4096  # vectors sent to a unit at once
REQUESTS = 65536  # vectors asked of a unit at once
CLASSES = 256  # hash classes of the weight bound
MANY_CLASSES = 4096  # the same for documents with more shingles than this
FEW = 192  # up to so many shingles, only classes in use are listed, out of FINE_CLASSES
FINE_CLASSES = 65536
SAMPLED = 1 << 16  # shingles sampled at once, about

_SEED = 0x9E3779B97F4A7C15
_ROW_BITS = 21  # more than a unit's rows


@dataclass
class _Vectors:
    """Shingles of a unit's documents: document, hash (ascending within it), weight."""

    doc: np.ndarray
    key: np.ndarray
    count: np.ndarray
    n_docs: int

    def first(self) -> np.ndarray:
        return np.searchsorted(self.doc, np.arange(self.n_docs + 1))


def _shingles(rows: pa.RecordBatch, text: str, drop_bits: int) -> _Vectors:
    texts = rows.column(rows.schema.get_field_index(text)).to_pylist()
    data, starts = hashing.joined([(t or "").encode() for t in texts])
    lo, _, words = hashing.words(data)
    doc = np.searchsorted(starts, lo, side="right") - 1
    grams = hashing.window_hashes(words, SHINGLE)
    whole = doc[: len(grams)] == doc[SHINGLE - 1 :] if len(grams) else np.zeros(0, bool)
    key, own = grams[whole], doc[: len(grams)][whole]
    n_words = np.bincount(doc, minlength=len(texts))
    first = np.searchsorted(doc, np.arange(len(texts)))
    short = np.flatnonzero((n_words > 0) & (n_words < SHINGLE))
    if len(short):
        ones = [hashing.window_hashes(words[a : a + n], n) for a, n in zip(first[short], n_words[short].tolist())]
        place = np.searchsorted(own, short)
        key, own = np.insert(key, place, np.concatenate(ones)), np.insert(own, place, short)
    key = key >> np.uint64(drop_bits) << np.uint64(drop_bits)
    # Documents stand in order, so each is sorted in its place.
    cuts = np.flatnonzero(np.diff(own, prepend=-1, append=len(texts))).tolist()
    for a, b in zip(cuts[:-1], cuts[1:]):
        key[a:b].sort()
    new = np.ones(len(key), bool)
    new[1:] = (key[1:] != key[:-1]) | (own[1:] != own[:-1])
    at = np.flatnonzero(new)
    return _Vectors(own[at], key[at], np.diff(at, append=len(key)), len(texts))


def _frequencies(held: _Vectors, answer: list[dict]) -> np.ndarray:
    keys, values = units.answered(answer)
    known, at = units.find(held.key, keys)
    return np.where(known, values[0][at], 1) if len(keys) else np.ones(len(held.key), np.int64)


def _weigh(count: np.ndarray, df: np.ndarray, n_all: int) -> np.ndarray:
    return count * (1 + np.log((1 + n_all) / (1 + df)) / math.log(1 + n_all))


_LISTED, _DENSE, _LONG = range(3)  # kinds of weight profiles


def profiles(held: _Vectors, weight: np.ndarray) -> list[bytes]:
    """Per document, the weight of its shingles by hash class, one byte a class, rounded up.

    The sum of the class-wise minima of two documents is never less than the weight they share. A
    profile is its kind, the weight that a step stands for, for few shingles the classes, and the steps.
    """
    first, out = held.first(), []
    for a, b in zip(first[:-1], first[1:]):
        kind = _LISTED if b - a <= FEW else _LONG if b - a > MANY_CLASSES else _DENSE
        n = (FINE_CLASSES, CLASSES, MANY_CLASSES)[kind]
        own = (hashing.mix(held.key[a:b]) & np.uint64(n - 1)).astype(np.int64)
        listed = b""
        if kind == _LISTED:
            used, own = np.unique(own, return_inverse=True)
            listed, n = used.astype("<u2").tobytes(), len(used)
        sums = np.bincount(own, weight[a:b], minlength=n)
        step = max(float(sums.max(initial=0)), 1e-300) / 255
        steps = np.minimum(np.ceil(sums / step), 255).astype(np.uint8)
        out.append(bytes([kind]) + np.float64(step * (1 + 1e-12)).tobytes() + listed + steps.tobytes())
    return out


def _levels(profile: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Classes of a profile, as fine as it has them, and their weights."""
    step = np.frombuffer(profile, np.float64, 1, 1)[0]
    if profile[0] == _LISTED:
        n = (len(profile) - 9) // 3
        classes = np.frombuffer(profile, "<u2", n, 9).astype(np.int64)
        return classes, np.frombuffer(profile, np.uint8, n, 9 + 2 * n) * step
    steps = np.frombuffer(profile, np.uint8, offset=9)
    return np.arange(len(steps)), steps * step


def may_reach(profiles: list[bytes], weight: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Which pairs (x, y) are not refused by the bound on the weight they share.

    Exact: a pair at the threshold or above is never refused. Profiles of one kind are compared class by
    class, others in the classes common to all kinds.
    """
    kinds = np.fromiter((p[0] for p in profiles), np.int64, len(profiles))
    fine = {i: _levels(profiles[i]) for i in np.unique(np.concatenate([x, y])).tolist()}
    coarse: dict[int, np.ndarray] = {}

    def folded(i: int) -> np.ndarray:
        if i not in coarse:
            coarse[i] = np.bincount(fine[i][0] & (CLASSES - 1), fine[i][1], minlength=CLASSES)
        return coarse[i]

    bound = np.zeros(len(x))
    order = np.argsort(x, kind="stable")
    cuts = np.flatnonzero(np.append(True, x[order][1:] != x[order][:-1]))
    here = np.zeros(FINE_CLASSES)
    for part in np.split(order, cuts[1:]):
        i, others = int(x[part[0]]), y[part]
        alike = kinds[others] == kinds[i]
        if alike.any():
            classes, levels = fine[i]
            here[classes] = levels
            for at in np.array_split(np.flatnonzero(alike), -(-int(alike.sum()) // 1024)):
                found = [fine[j] for j in others[at].tolist()]
                sizes = np.array([len(c) for c, _ in found])
                low = np.minimum(here[np.concatenate([c for c, _ in found])], np.concatenate([v for _, v in found]))
                bound[part[at]] = np.bincount(np.repeat(np.arange(len(at)), sizes), low, minlength=len(at))
            here[classes] = 0
        for at in np.flatnonzero(~alike).tolist():
            bound[part[at]] = np.minimum(folded(i), folded(int(others[at]))).sum()
    least = THRESHOLD / (1 + THRESHOLD) * (1 - 1e-6)
    return bound >= least * (weight[x] + weight[y])


def samples(key: np.ndarray, weight: np.ndarray, first: np.ndarray, n: int) -> np.ndarray:
    """``n`` consistent weighted samples of each vector; row i covers first[i] .. first[i + 1]."""
    full = np.flatnonzero(np.diff(first) > 0)
    out = np.zeros((len(first) - 1, n), np.uint64)
    # Whole vectors, few at a time, so that the many passes stay in the processor's cache.
    part = (first[full] - first[0]) // SAMPLED
    for rows in np.split(full, np.flatnonzero(np.diff(part)) + 1) if len(full) else []:
        a, b = first[rows[0]], first[rows[-1] + 1]
        out[rows] = _drawn(key[a:b], weight[a:b], first[rows] - a, n)
    return out


def _drawn(key: np.ndarray, weight: np.ndarray, begins: np.ndarray, n: int) -> np.ndarray:
    """Samples of the vectors, none empty, that start at ``begins``."""
    size, lengths = len(key), np.diff(begins, append=len(key))
    out = np.empty((len(begins), n), np.uint64)
    log_w = np.log(weight).astype(np.float32)
    z, y, bits = (np.empty(size, np.uint64) for _ in range(3))
    r, c, beta, t, drawn = (np.empty(size, np.float32) for _ in range(5))
    # Five uniform draws from two hashes; single precision is ample beside their 21 bits.
    unit, low = np.float32(2.0**-21), np.uint64((1 << 21) - 1)

    def draw(source: np.ndarray, shift: int, to: np.ndarray) -> np.ndarray:
        """A draw times 2**21."""
        np.right_shift(source, np.uint64(shift), out=bits)
        np.bitwise_and(bits, low, out=bits)
        np.copyto(to, bits.view(np.int64), casting="same_kind")
        to += np.float32(0.5)
        return to

    def minus_log(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """-ln of the product of two draws, in place of the first."""
        a *= b
        a *= unit * unit
        return np.negative(np.log(a, out=a), out=a)

    for k in range(n):
        np.add(key, np.uint64((_SEED * (2 * k + 1)) % 2**64), out=z)
        hashing.mix_in_place(z, bits)
        np.add(z, np.uint64(_SEED), out=y)
        hashing.mix_in_place(y, bits)
        minus_log(draw(z, 0, r), draw(z, 21, drawn))
        minus_log(draw(z, 42, c), draw(y, 0, drawn))
        np.log(c, out=c)
        draw(y, 21, beta)
        beta *= unit
        np.divide(log_w, r, out=t)
        t += beta
        np.floor(t, out=t)
        np.subtract(t, beta, out=drawn)
        drawn += np.float32(1)
        drawn *= r
        c -= drawn
        hit = np.flatnonzero(c == np.repeat(np.minimum.reduceat(c, begins), lengths))
        owner = np.searchsorted(begins, hit, side="right") - 1
        pick = hit[np.append(True, owner[1:] != owner[:-1])]
        step = t[pick].astype(np.int64).view(np.uint64)
        out[:, k] = hashing.mix(key[pick] + step * np.uint64(_SEED))
    return out


def band_keys(samples: np.ndarray) -> np.ndarray:
    """One key per document and band."""
    n = len(samples)
    keys = np.empty((n, BANDS), np.uint64)
    for b in range(BANDS):
        part = np.full(n, b + 1, np.uint64)
        for j in range(ROWS):
            part = hashing.mix(part * np.uint64(_SEED) + samples[:, b * ROWS + j])
        keys[:, b] = part
    return keys


def nearest(refs: np.ndarray, marks: np.ndarray, weight: np.ndarray) -> tuple[list, np.ndarray]:
    """Pairs (document, earlier document) that look alike, and which documents lead.

    Documents are taken in the order of ``refs``, in blocks: each is compared with the earlier ones of its
    block and with the leaders of the blocks before, and paired with the two most alike. A leader
    has no earlier partner.
    """
    pairs: list[tuple[int, int]] = []
    leads = np.empty(0, np.int64)
    for a in range(0, len(refs), BLOCK):
        block = np.arange(a, min(a + BLOCK, len(refs)))
        other = np.concatenate([leads, block])
        alike = np.zeros((len(block), len(other)))
        for j in range(0, len(other), BLOCK):
            part = other[j : j + BLOCK]
            alike[:, j : j + BLOCK] = (marks[block][:, None, :] == marks[part][None, :, :]).mean(2)
        ratio = np.minimum.outer(weight[block], weight[other]) / np.maximum.outer(
            weight[block], weight[other]
        )
        ok = (alike >= LIKELY) & (ratio >= THRESHOLD - 1e-9) & (refs[other][None, :] < refs[block][:, None])
        alike = np.where(ok, alike, -1.0)
        best = alike.argmax(axis=1)
        rows = np.arange(len(block))
        has = alike[rows, best] > 0
        pairs += zip(refs[block[has]].tolist(), refs[other[best[has]]].tolist())
        alike[rows, best] = -1
        best = alike.argmax(axis=1)
        again = alike[rows, best] > 0
        pairs += zip(refs[block[again]].tolist(), refs[other[best[again]]].tolist())
        leads = np.append(leads, block[~has])
    return pairs, leads


def _document_frequencies(packed: Units, text: str, drop_bits: int) -> DataFrame:
    n_buckets = packed.n_buckets

    def make(unit: int, rows: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        keys, df = np.unique(_shingles(rows, text, drop_bits).key, return_counts=True)
        if len(keys):
            yield units.entry_batch(unit, keys, [df.astype(np.int64)], n_buckets)

    def decide(keys: np.ndarray, values: list[np.ndarray]):
        new = np.append(True, keys[1:] != keys[:-1])
        total = np.add.reduceat(values[0], np.flatnonzero(new))[np.cumsum(new) - 1]
        return total > 1, [total]

    return units.by_unit(
        units.shared(units.each_unit(packed, make, units.ENTRY), decide), "frequencies"
    )


_SIGNED = T.StructType(
    [
        T.StructField("unit", T.LongType()),
        T.StructField("payload", T.BinaryType()),
        T.StructField("n", T.LongType()),
    ]
)
_PAIR = T.StructType([T.StructField("b", T.LongType()), T.StructField("a", T.LongType())])
_MEMBER = "key long, ref long, weight double, marks binary, b long, a long"


def _pair_batch(pairs: list) -> pa.RecordBatch:
    flat = np.array(pairs, np.int64).reshape(-1, 2)
    return pa.RecordBatch.from_arrays([pa.array(flat[:, 0]), pa.array(flat[:, 1])], ["b", "a"])


def _signatures(packed: Units, df: DataFrame, text: str, drop_bits: int, n_all: int) -> Units:
    """Per unit: total weight, band keys, 16-bit marks, vector hash and weight profile of every document."""

    def make(unit: int, rows: pa.RecordBatch, answer: list[dict]) -> Iterator[pa.RecordBatch]:
        held = _shingles(rows, text, drop_bits)
        weight = _weigh(held.count, _frequencies(held, answer), n_all)
        drawn = samples(held.key, weight, held.first(), BANDS * ROWS)
        total = np.bincount(held.doc, weight, minlength=held.n_docs)
        keys = band_keys(drawn)
        marks = (drawn & np.uint64(0xFFFF)).astype(np.uint16)
        same = np.zeros(held.n_docs, np.uint64)
        np.add.at(same, held.doc, hashing.mix(held.key + held.count.astype(np.uint64) * np.uint64(_SEED)))
        payload = units.pack_rows(
            pa.RecordBatch.from_arrays(
                [
                    pa.array(total),
                    pa.array([k.tobytes() for k in keys], pa.binary()),
                    pa.array([m.tobytes() for m in marks], pa.binary()),
                    pa.array(same.view(np.int64)),
                    pa.array(profiles(held, weight), pa.binary()),
                ],
                ["weight", "keys", "marks", "same", "profile"],
            )
        )
        yield pa.RecordBatch.from_arrays(
            [pa.array([unit]), pa.array([payload], pa.binary()), pa.array([held.n_docs])],
            _SIGNED.names,
        )

    signed = units.by_unit(units.each_unit(packed, make, _SIGNED, (df,)), "signatures")
    return Units(signed.select("unit", "payload"), packed.schema, packed.n_bytes)


def _signed(rows: pa.RecordBatch):
    """Documents with words: their rows, weights, band keys and marks."""
    weight = rows.column(0).to_numpy()
    full = np.flatnonzero(weight > 0)
    keys = np.frombuffer(b"".join(rows.column(1).to_pylist()), np.uint64).reshape(-1, BANDS)
    marks = np.frombuffer(b"".join(rows.column(2).to_pylist()), np.uint16).reshape(
        -1, BANDS * ROWS
    )
    return full, weight[full], keys[full], marks[full]


def _candidates(signed: Units) -> DataFrame:
    """Distinct pairs (b, a), a before b, that look alike by their samples."""
    n_buckets = signed.n_buckets

    def offer(unit: int, rows: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        _, _, keys, _ = _signed(rows)
        found, n = np.unique(keys, return_counts=True)
        if len(found):
            yield units.entry_batch(unit, found, [n.astype(np.int64)], n_buckets)

    def decide(keys: np.ndarray, values: list[np.ndarray]):
        new = np.append(True, keys[1:] != keys[:-1])
        total = np.add.reduceat(values[0], np.flatnonzero(new))[np.cumsum(new) - 1]
        return total > 1, []

    shared = units.shared(units.each_unit(signed, offer, units.ENTRY), decide)

    def inside(unit: int, rows: pa.RecordBatch, answer: list[dict]) -> Iterator[pa.RecordBatch]:
        again, _ = units.answered(answer)
        if not len(again):
            return
        full, weight, keys, marks = _signed(rows)
        refs = (unit << _ROW_BITS) + full
        at, band = np.nonzero(units.find(keys.ravel(), again)[0].reshape(keys.shape))
        key = keys[at, band]
        order = np.lexsort((at, key))
        key, at = key[order], at[order]
        cuts = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
        pairs, lead_key, lead = set(), [], []
        for a, b in zip(cuts, [*cuts[1:], len(key)]):
            group = at[a:b]
            if len(group) == 1:
                leads = np.zeros(1, np.int64)
            else:
                found, leads = nearest(refs[group], marks[group], weight[group])
                pairs.update(found)
            lead += group[leads].tolist()
            lead_key += [key[a]] * len(leads)
        n, m = len(lead), len(pairs)
        both = np.array(sorted(pairs), np.int64).reshape(-1, 2)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.array(lead_key, np.uint64).view(np.int64).tolist() + [None] * m, pa.int64()),
                pa.array(refs[lead].tolist() + [None] * m, pa.int64()),
                pa.array(weight[lead].tolist() + [None] * m, pa.float64()),
                pa.array([marks[i].tobytes() for i in lead] + [None] * m, pa.binary()),
                pa.array([None] * n + both[:, 0].tolist(), pa.int64()),
                pa.array([None] * n + both[:, 1].tolist(), pa.int64()),
            ],
            ["key", "ref", "weight", "marks", "b", "a"],
        )

    members = stored(units.each_unit(signed, inside, _MEMBER, (shared,)), "members")

    def across(table: pa.Table) -> pa.Table:
        table = table.sort_by([("key", "ascending"), ("ref", "ascending")])
        key, refs = table.column("key").to_numpy(), table.column("ref").to_numpy()
        weight = table.column("weight").to_numpy()
        marks = np.frombuffer(b"".join(table.column("marks").to_pylist()), np.uint16)
        marks = marks.reshape(len(key), -1)
        cuts = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
        pairs: set = set()
        for a, b in zip(cuts, [*cuts[1:], len(key)]):
            if b - a > 1:
                pairs.update(nearest(refs[a:b], marks[a:b], weight[a:b])[0])
        return pa.Table.from_batches([_pair_batch(sorted(pairs))])

    led = members.where("key IS NOT NULL").select("key", "ref", "weight", "marks")
    bucket = F.shiftrightunsigned("key", 64 - (n_buckets.bit_length() - 1))
    met = led.groupBy(bucket.alias("bucket")).applyInArrow(
        across, _PAIR
    )
    return met.unionByName(members.where("b IS NOT NULL").select("b", "a")).distinct()


_MET = (
    "cell long, key long, i int, j int, own int, ref long, root long, weight double, same long, profile binary"
)


def _unsettled(signed: Units, roots: DataFrame) -> DataFrame:
    """All pairs (b, a) of different classes that share a band key and may reach the threshold."""
    n_buckets = signed.n_buckets
    shift = np.uint64(64 - (n_buckets.bit_length() - 1))
    known = roots.groupBy(F.shiftright("node", _ROW_BITS).alias("unit")).agg(
        F.collect_list(F.struct("node", "root")).alias("answer")
    )

    def members(unit: int, rows: pa.RecordBatch, found: list[dict]):
        """One document per key, class and vector: key, row, ref, root, weight, vector hash."""
        full, weight, keys, _ = _signed(rows)
        refs = (unit << _ROW_BITS) + full
        root = {f["node"]: f["root"] for f in found}
        root = np.array([root.get(r, r) for r in refs.tolist()], np.int64)
        same = rows.column(3).to_numpy()[full]
        at = np.repeat(np.arange(len(full)), BANDS)
        key = keys.ravel()
        order = np.lexsort((at, same[at], root[at], key))
        key, at = key[order], at[order]
        new = np.ones(len(at), bool)
        new[1:] = (
            (key[1:] != key[:-1]) | (root[at[1:]] != root[at[:-1]]) | (same[at[1:]] != same[at[:-1]])
        )
        key, at = key[new], at[new]
        return key, refs[at], root[at], weight[at], same[at], full[at]

    def offer(unit: int, rows: pa.RecordBatch, found: list[dict]) -> Iterator[pa.RecordBatch]:
        key, _, root, *_ = members(unit, rows, found)
        if len(key):
            each, first, n = np.unique(key, return_index=True, return_counts=True)
            least, most = np.minimum.reduceat(root, first), np.maximum.reduceat(root, first)
            yield units.entry_batch(unit, each, [least, most, n.astype(np.int64)], n_buckets)

    def decide(keys: np.ndarray, values: list[np.ndarray]):
        new = np.append(True, keys[1:] != keys[:-1])
        first, group = np.flatnonzero(new), np.cumsum(new) - 1
        mixed = np.minimum.reduceat(values[0], first) < np.maximum.reduceat(values[1], first)
        return mixed[group], [np.add.reduceat(values[2], first)[group]]

    mixed = units.shared(units.each_unit(signed, offer, units.ENTRY, (known,)), decide)

    def deal(unit: int, rows: pa.RecordBatch, found: list[dict], answer: list[dict]):
        held, values = units.answered(answer)
        if not len(held):
            return
        key, ref, root, weight, same, row = members(unit, rows, found)
        hit, at = units.find(key, held)
        key, ref, root, weight, same, row = (c[hit] for c in (key, ref, root, weight, same, row))
        blocks = -(-values[0][at[hit]] // CELL)
        own = hashing.mix(root.view(np.uint64) * np.uint64(_SEED) + same.view(np.uint64))
        own = (own % blocks.astype(np.uint64)).astype(np.int64)
        copy = np.repeat(np.arange(len(key)), blocks)
        other = np.arange(len(copy)) - np.repeat(np.cumsum(blocks) - blocks, blocks)
        i, j = np.minimum(own[copy], other), np.maximum(own[copy], other)
        one = key[copy]
        cell = hashing.mix(hashing.mix(one + i.astype(np.uint64)) + j.astype(np.uint64))
        # Keys of one block share a cell by bucket; each cell of a larger key is a group.
        cell = np.where(blocks[copy] == 1, one >> shift, cell | np.uint64(1 << 63))
        columns = [cell.view(np.int64), one.view(np.int64), i.astype(np.int32), j.astype(np.int32)]
        columns += [own[copy].astype(np.int32), ref[copy], root[copy], weight[copy], same[copy]]
        profile, row = rows.column(4), row[copy]
        for a in range(0, len(copy), 1 << 12):
            part = slice(a, a + (1 << 12))
            yield pa.RecordBatch.from_arrays(
                [*(pa.array(c[part]) for c in columns), profile.take(pa.array(row[part]))],
                ["cell", "key", "i", "j", "own", "ref", "root", "weight", "same", "profile"],
            )

    met = units.each_unit(signed, deal, _MET, (known, mixed))

    def compare(table: pa.Table) -> pa.Table:
        profile = table.column("profile").to_pylist()
        c = {n: table.column(n).to_numpy() for n in table.column_names if n != "profile"}
        c["row"] = np.arange(len(profile))
        order = np.lexsort((c["ref"], c["same"], c["root"], c["own"], c["j"], c["i"], c["key"]))
        c = {n: v[order] for n, v in c.items()}

        def changes(*names: str) -> np.ndarray:
            new = np.ones(len(order), bool)
            new[1:] = np.any([c[n][1:] != c[n][:-1] for n in names], axis=0)
            return new

        once = changes("key", "i", "j", "own", "root", "same")
        begins = changes("key", "i", "j")[once]
        c = {n: v[once] for n, v in c.items()}
        cuts = np.flatnonzero(begins)
        out = []
        for a, b in zip(cuts, [*cuts[1:], len(begins)]):
            ref, root, weight, own, row = (c[n][a:b] for n in ("ref", "root", "weight", "own", "row"))
            seen = [profile[i] for i in row.tolist()]
            lone = c["i"][a] == c["j"][a]
            left = np.flatnonzero(own == c["i"][a])
            right = left if lone else np.flatnonzero(own == c["j"][a])
            for k in range(0, len(left), BLOCK):
                part = left[k : k + BLOCK]
                low = np.minimum.outer(weight[part], weight[right])
                high = np.maximum.outer(weight[part], weight[right])
                ok = (low >= (THRESHOLD - 1e-9) * high) & (root[part][:, None] != root[right][None, :])
                if lone:
                    ok &= ref[part][:, None] < ref[right][None, :]
                x, y = np.nonzero(ok)
                x, y = part[x], right[y]
                if len(x):
                    ok = may_reach(seen, weight, x, y)
                    x, y = x[ok], y[ok]
                x, y = ref[x], ref[y]
                out.append(np.stack([np.maximum(x, y), np.minimum(x, y)], 1))
        pairs = np.unique(np.concatenate([np.empty((0, 2), np.int64), *out]), axis=0)
        return pa.Table.from_batches([_pair_batch(pairs)])

    return met.groupBy("cell").applyInArrow(compare, _PAIR).distinct()


def weighted_jaccard(a: tuple, b: tuple) -> float:
    """Of two vectors (ascending keys, weights)."""
    known, at = units.find(a[0], b[0])
    low = np.minimum(a[1][known], b[1][at[known]]).sum()
    return float(low / (a[1].sum() + b[1].sum() - low))


def _rows_of(refs: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """The distinct rows that ``refs`` name, and where each is among them."""
    return np.unique(np.array(refs, np.int64) & ((1 << _ROW_BITS) - 1), return_inverse=True)


def _verified(packed: Units, pairs: DataFrame, df: DataFrame, text: str, drop_bits: int, n_all: int) -> DataFrame:
    """Pairs (b, a) whose weighted Jaccard similarity reaches the threshold."""
    unit_of = lambda c: F.shiftright(c, _ROW_BITS)
    salted = lambda *c: F.pmod(F.xxhash64(*c), F.col("parts"))
    asked = pairs.select(F.col("a").alias("ref"), unit_of("b").alias("to")).distinct()
    # A unit that is sent many vectors takes them in several parts.
    parts = asked.groupBy("to").agg(F.ceil(F.count("*") / VECTORS).alias("parts"))
    asked = asked.join(parts, "to").withColumn("part", salted("ref")).drop("parts")
    asked = stored(asked.withColumn("unit", unit_of("ref")), "asked")
    # So does a unit that many others ask, as the one of a large group's first member.
    shares = asked.groupBy("unit").agg(F.ceil(F.count("*") / REQUESTS).alias("parts"))
    requests = (
        asked.join(shares, "unit")
        .groupBy("unit", salted("ref", "to").alias("share"))
        .agg(F.collect_list(F.struct("ref", "to", "part")).alias("answer"))
    )

    def send(unit, rows, frequencies, requests) -> Iterator[pa.RecordBatch]:
        if not requests:
            return
        row, own = _rows_of([r["ref"] for r in requests])
        held = _shingles(rows.take(pa.array(row)), text, drop_bits)
        df, first = _frequencies(held, frequencies), held.first()
        row = own.tolist()
        cuts = [slice(first[i], first[i + 1]) for i in row]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([r["to"] for r in requests], pa.int64()),
                pa.array([r["part"] for r in requests], pa.int64()),
                pa.array([r["ref"] for r in requests], pa.int64()),
                pa.array([units.pack_ints(held.key[c], True) for c in cuts], pa.binary()),
                pa.array([units.pack_ints(held.count[c]) for c in cuts], pa.binary()),
                pa.array([units.pack_ints(df[c]) for c in cuts], pa.binary()),
            ],
            ["unit", "part", "ref", "keys", "counts", "df"],
        )

    vector = "ref long, keys binary, counts binary, df binary"
    sent = units.each_unit(packed, send, f"unit long, part long, {vector}", (df, requests))
    vectors = sent.select(
        "unit",
        "part",
        F.struct("ref", "keys", "counts", "df").alias("given"),
        F.lit(None).cast("struct<b: bigint, a: bigint>").alias("wanted"),
    )
    mine = (
        pairs.select(unit_of("b").alias("to"), F.col("a").alias("ref"), "b", "a")
        .join(parts, "to")
        .select(
            F.col("to").alias("unit"),
            salted("ref").alias("part"),
            F.lit(None).cast(vectors.schema["given"].dataType).alias("given"),
            F.struct("b", "a").alias("wanted"),
        )
    )
    # Dealt by unit, as the unit table is, so a vector is shuffled once.
    n = int(packed.frame.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    both = (
        vectors.unionByName(mine)
        .repartition(n, "unit")
        .groupBy("unit", "part")
        .agg(F.collect_list("given").alias("given"), F.collect_list("wanted").alias("wanted"))
        .select("unit", F.struct("given", "wanted").alias("answer"))
    )

    def verify(unit, rows, frequencies, answer) -> Iterator[pa.RecordBatch]:
        if not answer:
            return
        given, wanted = answer["given"], answer["wanted"]
        row, own = _rows_of([w["b"] for w in wanted])
        held = _shingles(rows.take(pa.array(row)), text, drop_bits)
        weight = _weigh(held.count, _frequencies(held, frequencies), n_all)
        first, kept, others = held.first(), [], {g["ref"]: g for g in given}
        for pair, i in sorted(zip(wanted, own.tolist()), key=lambda p: p[0]["a"]):
            other = others[pair["a"]]
            part = slice(first[i], first[i + 1])
            counts, df = (units.unpack_ints(other[c]).view(np.int64) for c in ("counts", "df"))
            vector = units.unpack_ints(other["keys"]), _weigh(counts, df, n_all)
            if weighted_jaccard((held.key[part], weight[part]), vector) >= THRESHOLD:
                kept.append((pair["b"], pair["a"]))
        if kept:
            yield _pair_batch(kept)

    return units.each_unit(packed, verify, _PAIR, (df, both))


def _classes(packed: Units, id_col: str, text: str) -> DataFrame:
    """(ref, id, root): the root is null for documents without links."""

    def places(unit: int, rows: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        n = rows.num_rows
        yield pa.RecordBatch.from_arrays(
            [
                pa.array((unit << _ROW_BITS) + np.arange(n)),
                rows.column(rows.schema.get_field_index(id_col)).cast(pa.int64()),
            ],
            ["ref", "id"],
        )

    refs = stored(units.each_unit(packed, places, "ref long, id long"), "places")
    n_all = refs.count()
    # Shingles keep 20 bits more than it takes to number them.
    drop_bits = max(0, 64 - 20 - max(packed.n_bytes // 4, 1).bit_length())
    df = _document_frequencies(packed, text, drop_bits)
    signed = _signatures(packed, df, text, drop_bits, n_all)
    pairs = stored(_candidates(signed), "pairs")
    links = stored(_verified(packed, pairs, df, text, drop_bits, n_all), "verified")
    roots = stored(graphs.components(links), "roots")
    rest = stored(_unsettled(signed, roots).join(pairs, ["b", "a"], "left_anti"), "rest")
    if not rest.isEmpty():
        more = stored(_verified(packed, rest, df, text, drop_bits, n_all), "verified")
        if not more.isEmpty():
            within = roots.select(F.col("node").alias("b"), F.col("root").alias("a"))
            roots = graphs.components(within.unionByName(more))
    return refs.join(roots.withColumnRenamed("node", "ref"), "ref", "left")


def classes(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(id, class_id) per document; the class is named by its smallest id."""
    packed = units.pack(docs.select(id_col, docs[text].cast("string").alias(text)), text)
    placed = _classes(packed, id_col, text)
    names = placed.where("root IS NOT NULL").groupBy("root").agg(F.min("id").alias("class_id"))
    named = placed.join(names, "root", "left")
    alone = F.col("root").isNull()
    return named.select(
        F.col("id").alias(id_col), F.when(alone, F.col("id")).otherwise(F.col("class_id")).alias("class_id")
    )


def keep_one(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with one document of each class, the one with the smallest id."""
    packed = units.pack(docs.withColumn(text, docs[text].cast("string")), text)
    placed = stored(_classes(packed, id_col, text).where("root IS NOT NULL"), "classes")
    first = placed.groupBy("root").agg(
        F.min(F.struct(F.col("id").isNull(), "id", "ref")).alias("first")
    )
    dropped = (
        placed.join(first.select("root", "first.ref"), ["root", "ref"], "left_anti")
        .groupBy(F.shiftright("ref", _ROW_BITS).alias("unit"))
        .agg(F.collect_list("ref").alias("answer"))
    )

    def make(unit: int, rows: pa.RecordBatch, gone: list[int]) -> Iterator[pa.RecordBatch]:
        keep = np.ones(rows.num_rows, bool)
        keep[np.array(gone, np.int64) & ((1 << _ROW_BITS) - 1)] = False
        yield rows.filter(pa.array(keep))

    return units.each_unit(packed, make, packed.schema, (dropped,))
