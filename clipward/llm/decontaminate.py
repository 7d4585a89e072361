"""Training passages that copy test items: the rarest word pairs as seeds, a counting bound, then Smith-Waterman.

Texts are lowered and cut into words of letters, digits and non-ASCII characters. A pair aligns with
match 2, mismatch and gap -1; the score is divided by the item's own, and kept from ``min_score`` on. So an
item of L words must reach P = max(2 L min_score, min(MIN_POINTS, 2 L)) points.

Where P = 2 L, only a whole copy counts and the whole item is one seed. Else every two neighbours of
the item are a seed, which the text may hold side by side or with one word between. Let an alignment
have m matches and, among its m - 1 steps from match to match, S seeds, u steps that pass over a word
of the item and v steps that pass over two or more words of the text only. It scores at most
2 m - u - 2 v, and m + u <= L, u + S <= m - 1, so S >= (2 P - L - 3) / 3; its text is at most 3 L - P
words long. So of the n seeds of an item any n - S + 1 include one of every accepted copy. One scan of the corpus
counts the items' seeds; the n - S + 1 rarest of each item are joined with the corpus in a second scan, and
where one is found, all seeds of the item are counted around it. Texts and items with S seeds so near each other are
aligned. Counts choose the seeds only, so the result does not depend on them. For ``min_score`` under 0.5 the bound falls to
one seed, which long items at less than 0.3 need not hold.

Hits are handled ``HITS`` at a time and their surroundings ``PLACES`` words at a time; long windows are aligned in
strips that overlap by the longest accepted copy. So memory does not grow with frequent pairs or long texts.

Test items are held in blocks of bounded size (``BLOCK_WORDS``); with more items there are more
blocks, each scanning the corpus twice, so what is broadcast never grows; the counts that reach the driver are those
of a block's seeds.

Cases: null or empty texts and items match nothing; items shorter than a seed match as a whole; ties
between windows of one document keep the best score, then the earliest place; repeated documents
each match, repeated items each under their id; null ids are kept as they are; empty tables give an
empty result; extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clipward.llm import hashing
from clipward.llm.frames import release, small_batches, stored

SEED_WORDS = 2
MIN_SCORE = 0.5
MIN_POINTS = 12
BLOCK_WORDS = 1 << 20
PART_BYTES = 2 << 20
HITS = 1 << 18
PLACES = 1 << 20
STRIP_SPANS = 4  # words of a strip, in spans of its item
CELLS = 1 << 17  # words of text that are aligned together
MATCH, MISS, GAP = 2, -1, -1

_SEPARATOR = np.ones(256, bool)
_SEPARATOR[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = False
_BITS = np.uint64(44)  # 2**20 places for the first look


@dataclass
class Items:
    """A block of test items: word hashes and the seeds to look for, ascending."""

    ids: list
    words: list[np.ndarray]
    seeds: np.ndarray
    item: np.ndarray
    place: np.ndarray
    size: np.ndarray
    needed: np.ndarray  # seeds an accepted copy holds at least, per item
    span: np.ndarray  # words of text it covers at most
    keys: np.ndarray  # every pair of every item that needs more than one, ascending

    @property
    def sizes(self) -> list[int]:
        return sorted(set(self.size.tolist()))


def _words_of(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Word hashes of all texts, the text of each, and where each text's words begin."""
    data, starts = hashing.joined([t.lower().encode() for t in texts])
    lo, _, hashes = hashing.words(data, _SEPARATOR)
    doc = np.searchsorted(starts, lo, side="right") - 1
    return hashes, doc, np.searchsorted(doc, np.arange(len(texts) + 1))


def read_items(rows: list, seed_words: int, min_score: float = MIN_SCORE) -> Items:
    ids, texts = [r[0] for r in rows], [r[1] or "" for r in rows]
    hashes, _, first = _words_of(texts)
    words = [hashes[a:b] for a, b in zip(first[:-1], first[1:])]
    seeds, item, place, size = [], [], [], []
    needed, span = np.ones(len(words), np.int64), np.zeros(len(words), np.int64)
    for i, w in enumerate(words):
        best = MATCH * len(w)
        least = max(math.ceil(best * min_score - 1e-9), min(MIN_POINTS, best))
        n = len(w) if least >= best else min(seed_words, len(w))
        if n:
            found = hashing.window_hashes(w, n)
            seeds.append(found)
            item += [i] * len(found)
            place += range(len(found))
            size += [n if least < best else -n] * len(found)
            span[i] = max(len(w), 3 * len(w) - least)
            if least < best:
                # The bound is that of pairs; other seeds are taken at the first hit.
                pairs = -(-(2 * least - len(w) - 3) // 3)
                needed[i] = max(1, pairs) if n == 2 else 1
    flat = np.concatenate([np.empty(0, np.uint64), *seeds])
    order = np.argsort(flat, kind="stable")
    item, place, size = (np.array(c, np.int64)[order] for c in (item, place, size))
    flat = flat[order]
    many = needed[item] > 1
    keys = np.unique(_key(flat[many], item[many]))
    return Items(ids, words, flat, item, place, size, needed, span, keys)


def _key(seeds: np.ndarray, item: np.ndarray) -> np.ndarray:
    """Hash of a seed in an item."""
    return seeds ^ hashing.mix(item.astype(np.uint64) + np.uint64(1))


def rarest(items: Items, counts: np.ndarray) -> Items:
    """``items`` with the seeds of each that every accepted copy holds one of, rarest first chosen.

    ``counts`` has the occurrences of each entry of ``items.seeds``.
    """
    order = np.lexsort((items.place, counts, items.item))
    item = items.item[order]
    first = np.searchsorted(item, item)
    n = np.searchsorted(item, item, side="right") - first
    kept = np.sort(order[np.arange(len(order)) - first < n - items.needed[item] + 1])
    return replace(items, **{c: getattr(items, c)[kept] for c in ("seeds", "item", "place", "size")})


def _lookup(items: Items) -> np.ndarray:
    seen = np.zeros(1 << 20, bool)
    seen[(items.seeds >> _BITS).astype(np.int64)] = True
    return seen


def _inside(doc: np.ndarray, places: np.ndarray, width: int) -> np.ndarray:
    """Whether ``width`` words from each place are in one document."""
    last = places + width - 1
    return (last < len(doc)) & (doc[places] == doc[np.minimum(last, len(doc) - 1)])


def _hits(
    items: Items, seen: np.ndarray, hashes: np.ndarray, grams: dict[int, np.ndarray], doc: np.ndarray
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(word position, item) of every seed in a document, about ``HITS`` at a time; pairs also with one
    word between. ``grams`` has the hashes of pairs by the words they cover."""
    at, item, held = [], [], 0
    for n in items.sizes:
        for width, found in grams.items() if n == 2 else ((abs(n), hashing.window_hashes(hashes, abs(n))),):
            near = np.flatnonzero(seen[(found >> _BITS).astype(np.int64)])
            near = near[_inside(doc, near, width)]
            lo = np.searchsorted(items.seeds, found[near])
            hi = np.searchsorted(items.seeds, found[near], side="right")
            near, lo, hi = near[hi > lo], lo[hi > lo], hi[hi > lo]
            for a, b in _runs(np.cumsum(hi - lo) // HITS):
                run, entry = _spread(lo[a:b], hi[a:b])
                right = items.size[entry] == n
                at.append(near[a:b][run][right])
                item.append(items.item[entry[right]])
                held += len(at[-1])
                if held >= HITS:
                    yield np.concatenate(at), np.concatenate(item)
                    at, item, held = [], [], 0
    if held:
        yield np.concatenate(at), np.concatenate(item)


def _spread(lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of the range and value, for all values of the ranges lo .. hi - 1."""
    size = hi - lo
    run = np.repeat(np.arange(len(lo)), size)
    return run, np.arange(len(run)) - (np.cumsum(size) - size)[run] + lo[run]


def _gathered(
    items: Items, grams: dict[int, np.ndarray], doc: np.ndarray, first: np.ndarray, at: np.ndarray, item: np.ndarray
) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(word position, item) of the seeds around each hit that are enough and near each other, by item and position."""
    order = np.lexsort((at, item))
    at, item = at[order], item[order]
    one = items.needed[item] == 1
    if one.any():
        yield at[one], item[one]
    at, item = at[~one], item[~one]
    if not len(at):
        return
    span = items.span[item]
    new = np.ones(len(at), bool)
    new[1:] = (np.diff(item) != 0) | (np.diff(doc[at]) != 0) | (np.diff(at) > 2 * span[1:])
    head = np.flatnonzero(new)
    tail = np.append(head[1:], len(at)) - 1
    own, wide = doc[at[head]], span[head]
    lo = np.maximum(first[own], at[head] - wide)
    hi = np.minimum(first[own + 1], at[tail] + wide + 1)
    for a, b in _runs(np.cumsum(hi - lo) // PLACES):
        run, place = _spread(lo[a:b], hi[a:b])
        its = item[head[a:b][run]]
        hit = np.zeros(len(place), bool)
        for width, found in grams.items():
            ok = np.flatnonzero(_inside(doc, place, width))
            key = _key(found[place[ok]], its[ok])
            known = np.minimum(np.searchsorted(items.keys, key), len(items.keys) - 1)
            hit[ok] |= items.keys[known] == key
        place, its = place[hit], its[hit]
        near = _near(items, doc[place], its, place)
        if near.any():
            yield place[near], its[near]


def _apart(hashes: np.ndarray) -> np.ndarray:
    """Hash of every word and the next but one, as if they were neighbours."""
    n = max(0, len(hashes) - 2)
    out = np.empty(n, np.uint64)
    for odd in (0, 1):
        pairs = hashing.window_hashes(hashes[odd::2], 2)
        out[odd::2] = pairs
    return out


def _near(items: Items, doc: np.ndarray, item: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Which hits, sorted by item and position, are in a span with enough of them."""
    ok = np.zeros(len(at), bool)
    for n in np.unique(items.needed[item]).tolist():
        mine = np.flatnonzero(items.needed[item] == n)
        if len(mine) < n:
            continue
        head, tail = mine[: len(mine) - n + 1], mine[n - 1 :]
        full = (
            (doc[head] == doc[tail])
            & (item[head] == item[tail])
            & (at[tail] - at[head] <= items.span[item[head]])
        )
        change = np.zeros(len(mine) + 1, np.int64)
        places = np.flatnonzero(full)
        np.add.at(change, places, 1)
        np.add.at(change, places + n, -1)
        ok[mine] = np.cumsum(change[:-1]) > 0
    return ok


_CANDIDATE = T.StructType(
    [
        T.StructField("row", T.LongType()),
        T.StructField("item", T.IntegerType()),
        T.StructField("start", T.LongType()),
        T.StructField("words", T.ArrayType(T.LongType())),
    ]
)


def _pairs(hashes: np.ndarray) -> dict[int, np.ndarray]:
    """Hashes of pairs by the words they cover."""
    return {2: hashing.window_hashes(hashes, 2), 3: _apart(hashes)}


def _parts(column: pa.Array) -> Iterator[tuple[int, list[str]]]:
    """The texts in parts of about ``PART_BYTES``, with the first row of each."""
    sizes = pc.fill_null(pc.binary_length(column), 0).to_numpy(False)
    for a, b in _runs(np.cumsum(sizes) // PART_BYTES):
        yield a, [t or "" for t in column.slice(a, b - a).to_pylist()]


def _counts(docs: DataFrame, text: str, shared) -> DataFrame:
    """(seed, n): how often the corpus has the pairs of the items."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = shared.value
        seen, seeds = _lookup(items), np.unique(items.seeds)
        counts = np.zeros(len(seeds) + 1, np.int64)
        for batch in batches:
            for _, texts in _parts(batch.column(0)):
                hashes, doc, _ = _words_of(texts)
                for width, found in _pairs(hashes).items():
                    near = np.flatnonzero(seen[(found >> _BITS).astype(np.int64)])
                    found = found[near[_inside(doc, near, width)]]
                    place = np.searchsorted(seeds, found)
                    place[(place == len(seeds)) | (seeds[np.minimum(place, len(seeds) - 1)] != found)] = len(seeds)
                    counts += np.bincount(place, minlength=len(counts))
        some = np.flatnonzero(counts[:-1])
        yield pa.RecordBatch.from_arrays(
            [pa.array(seeds[some].view(np.int64)), pa.array(counts[some])], ["seed", "n"]
        )
        release()

    small_batches(docs.sparkSession)
    found = docs.select(text).mapInArrow(run, "seed long, n long")
    return found.groupBy("seed").agg(F.sum("n").alias("n"))


def _scan(docs: DataFrame, ids: list[str], text: str, shared) -> DataFrame:
    """Candidate windows of ``docs`` with the id columns of their document."""
    schema = T.StructType([*(docs.schema[c] for c in ids), *_CANDIDATE.fields])

    def part(batch: pa.RecordBatch, texts: list[str], base: int, items: Items, seen: np.ndarray):
        hashes, doc, first = _words_of(texts)
        grams = _pairs(hashes)
        for hits in _hits(items, seen, hashes, grams, doc):
            for at, item in _gathered(items, grams, doc, first, *hits):
                yield candidates(batch, base, items, hashes, doc, first, at, item)

    def candidates(batch, base, items, hashes, doc, first, at, item) -> pa.RecordBatch:
        own, span = doc[at], items.span[item]
        new = np.ones(len(at), bool)
        new[1:] = (np.diff(own) != 0) | (np.diff(item) != 0) | (np.diff(at) > span[1:])
        begins = np.flatnonzero(new)
        rows: dict[str, list] = {n: [] for n in _CANDIDATE.names}
        picked = []
        for a, b in zip(begins, [*begins[1:], len(at)]):
            d, i, wide = own[a], item[a], span[a]
            end = min(first[d + 1], at[b - 1] + wide + 1)
            lo = max(first[d], at[a] - wide)
            while True:
                hi = min(end, lo + STRIP_SPANS * wide)
                picked.append(d)
                rows["row"].append(base + int(d))
                rows["item"].append(int(i))
                rows["start"].append(int(lo - first[d]))
                rows["words"].append(hashes[lo:hi].view(np.int64))
                if hi == end:
                    break
                lo = hi - wide
        columns = [
            batch.column(batch.schema.get_field_index(c)).take(pa.array(picked)) for c in ids
        ]
        made = [
            pa.array(rows["row"], pa.int64()),
            pa.array(rows["item"], pa.int32()),
            pa.array(rows["start"], pa.int64()),
            pa.array(rows["words"], pa.list_(pa.int64())),
        ]
        return pa.RecordBatch.from_arrays([*columns, *made], schema.names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = shared.value
        seen = _lookup(items)
        base = TaskContext.get().partitionId() << 40
        for batch in batches:
            for a, texts in _parts(batch.column(batch.schema.get_field_index(text))):
                yield from part(batch.slice(a, len(texts)), texts, base, items, seen)
                base += len(texts)
        release()

    small_batches(docs.sparkSession)
    return docs.select(*ids, text).mapInArrow(run, schema)


def _runs(group: np.ndarray) -> list[tuple[int, int]]:
    cuts = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), len(group)]
    return [(a, b) for a, b in zip(cuts[:-1], cuts[1:]) if b > a]


def _groups(lengths: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of at most 128 ascending lengths that are at most ``CELLS`` when padded, or one."""
    a = 0
    while a < len(lengths):
        b = min(a + 128, len(lengths))
        while b > a + 1 and (b - a) * lengths[b - 1] > CELLS:
            b = a + (b - a + 1) // 2
        yield a, b
        a = b


def align(items: list[np.ndarray], texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Best local alignment score of each pair, and the text position where it ends.

    All pairs advance together, one item word at a time. Inside a row, the chain of gaps is a
    running maximum of values that are lifted by one gap a place.
    """
    n, width, depth = len(items), max(map(len, texts)), max(map(len, items))
    grid = np.zeros((n, width), np.uint64)
    usable = np.zeros((n, width), bool)
    for i, t in enumerate(texts):
        grid[i, : len(t)], usable[i, : len(t)] = t, True
    lift = -GAP * np.arange(width)
    above = np.zeros((n, width + 1), np.int64)
    best, end = np.zeros(n, np.int64), np.zeros(n, np.int64)
    for j in range(depth):
        word = np.array([w[j] if j < len(w) else 0 for w in items], np.uint64)[:, None]
        live = np.array([j < len(w) for w in items])[:, None]
        step = np.where((grid == word) & usable & live, MATCH, MISS)
        row = np.maximum(np.maximum(above[:, :-1] + step, above[:, 1:] + GAP), 0)
        row = np.maximum.accumulate(row + lift, axis=1) - lift
        row = np.where(live & usable, row, 0)
        top = row.argmax(axis=1)
        score = row[np.arange(n), top]
        better = score > best
        best[better], end[better] = score[better], top[better]
        above[:, 1:] = row
    return best, end


def _aligned(candidates: DataFrame, ids: list[str], shared) -> DataFrame:
    schema = T.StructType(
        [
            *(candidates.schema[c] for c in ids),
            T.StructField("row", T.LongType()),
            T.StructField("item", T.IntegerType()),
            T.StructField("score", T.DoubleType()),
            T.StructField("points", T.LongType()),
            T.StructField("word_end", T.LongType()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items = shared.value
        for batch in batches:
            column = batch.column(batch.schema.get_field_index("words"))
            chosen = sorted(range(batch.num_rows), key=lambda i: len(column[i]))
            index = batch.column(batch.schema.get_field_index("item")).to_pylist()
            start = batch.column(batch.schema.get_field_index("start")).to_pylist()
            lengths = np.array([len(column[i]) for i in chosen], np.int64)
            for a, b in _groups(lengths):
                rows = chosen[a:b]
                words = [items.words[index[i]] for i in rows]
                texts = [column[i].values.to_numpy().view(np.uint64) for i in rows]
                points, end = align(words, texts)
                score = points / np.array([MATCH * len(w) for w in words])
                picked = batch.take(pa.array(rows))
                names = [*ids, "row", "item"]
                columns = [picked.column(picked.schema.get_field_index(c)) for c in names]
                ends = end + np.array([start[i] for i in rows]) + 1
                yield pa.RecordBatch.from_arrays(
                    [*columns, pa.array(score), pa.array(points), pa.array(ends)], schema.names
                )

    return candidates.mapInArrow(run, schema)


def find_copies(
    docs: DataFrame,
    items: DataFrame,
    ids: tuple[str, ...] = ("doc_id",),
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    seed_words: int = SEED_WORDS,
    min_score: float = MIN_SCORE,
) -> DataFrame:
    """(ids..., item_id, score, points, word_end), the best match per document and item.

    ``word_end`` is the word position in the document where the aligned part ends.
    """
    spark = docs.sparkSession
    docs = docs.select(*ids, docs[text].cast("string").alias(text))
    tests = items.select(
        F.col(item_id).cast("long").alias("item_id"), F.col(item_text).cast("string").alias("t")
    )
    total = tests.agg(F.sum(F.size(F.split(F.coalesce("t", F.lit("")), " ")))).first()[0] or 0
    n_blocks = max(1, -(-total // BLOCK_WORDS))
    found = None
    for b in range(n_blocks):
        mine = tests.where(F.pmod(F.xxhash64("item_id", "t"), F.lit(n_blocks)) == b)
        held = read_items([tuple(r) for r in mine.orderBy("item_id", "t").collect()], seed_words, min_score)
        if (held.needed > 1).any():
            counted = _counts(docs, text, spark.sparkContext.broadcast(held)).toPandas()
            seeds = counted["seed"].to_numpy(np.int64).view(np.uint64)
            order = np.argsort(seeds)
            counts = np.append(counted["n"].to_numpy(np.int64)[order], 0)
            place = np.searchsorted(seeds[order], held.seeds)
            known = np.append(seeds[order], np.uint64(0))[place] == held.seeds
            held = rarest(held, np.where(known, counts[place], 0))
        shared = spark.sparkContext.broadcast(held)
        candidates = stored(_scan(docs, list(ids), text, shared), "candidates")
        scored = _aligned(candidates, list(ids), shared)
        # Rows given as Arrow need no Python workers of their own.
        names = spark.createDataFrame(
            pa.table(
                {"item": pa.array(range(len(held.ids)), pa.int32()), "item_id": pa.array(held.ids, pa.int64())}
            )
        )
        enough = F.least(F.lit(MIN_POINTS), F.lit(MATCH) * F.col("points") / (F.col("score") * 2))
        best = (
            scored.where(
                (F.col("score") >= min_score) & (F.col("points") >= enough)
            )
            .groupBy(*ids, "row", "item")
            .agg(
                F.max(F.struct("score", "points", (-F.col("word_end")).alias("e"))).alias("best")
            )
            .join(F.broadcast(names), "item")
            .select(
                *ids,
                "item_id",
                "best.score",
                "best.points",
                (-F.col("best.e")).alias("word_end"),
            )
        )
        found = best if found is None else found.unionByName(best)
    return found
