"""Random forests grown and scored in one go, for searches over many and deep trees.

Features are cut into bins once. A tree is grown on a Poisson draw of the training rows, and the held-out rows go
down with them, without a count, until a leaf gives them its class shares. So a trial needs no stored forest: what
leaves a task is the sum of shares of each held-out row over the trees of the task.

Splits maximise the weighted decrease of the Gini impurity (that is, the purity of both sides) among a drawn subset
of the features of each node, with at least ``leaf_rows`` drawn rows on either side. The draw of a row depends on
(seed, tree, row key), the features of a node on (seed, tree, node), and shares are summed as whole numbers, so a result
does not depend on how rows or trees are dealt.

A tree of fewer than ``LOCAL`` rows is one task's work, and all tasks share one broadcast table of a byte a feature and
about 20 more a row. Larger trees are cut from above: the nodes of that size are split level by level, by one pass and one grouped
sum of histograms, and the rows of the smaller nodes below go to a task per node. ``GROUP`` bounds how many rows
of all trees are on the way at once.

Cases: null features count as the least value; rows without a class or with a weight of null or zero do not train;
constant features are never split; equal decreases go to the lower feature, then the lower bin.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clipward.operators import boosting
from clipward.session import stable

LOCAL = 262_144
BATCH = 65_536  # drawn rows of the trees that a task grows together
GROUP = 1 << 26
CELLS = 1 << 16  # histogram cells held at once
DENSE = 48  # nodes of this many rows have full histograms; smaller ones sort their rows
EQUAL = 1 - 1e-11  # scores this near are the same score
SHARE = 1 << 40  # a class share of one, as a whole number
_CDF = np.cumsum([math.exp(-1) / math.factorial(k) for k in range(16)])
_STEP = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class Growth:
    """Parameters of a forest; names as in the search space."""

    trees: int = 100
    depth: int = 8
    leaf_rows: int = 1
    feature_subset: str = "sqrt"
    seed: int = 42

    @staticmethod
    def of(params: Mapping[str, object], seed: int = 42) -> Growth:
        kinds = {"trees": int, "depth": int, "leaf_rows": int, "feature_subset": str}
        return Growth(**{"seed": seed, **{n: kind(params[n]) for n, kind in kinds.items() if n in params}})

    def n_columns(self, n_features: int) -> int:
        """How many features a node may choose from."""
        if self.feature_subset == "sqrt":
            return math.ceil(math.sqrt(n_features))
        if self.feature_subset == "log2":
            return max(1, math.ceil(math.log2(n_features)))
        return min(n_features, max(1, math.ceil(float(self.feature_subset) * n_features)))


# ---------------------------------------------------------------- draws


def _mixed(x: np.ndarray) -> np.ndarray:
    """Well spread 64 bits of each number."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _of_trees(trees: np.ndarray, seed: int) -> np.ndarray:
    start = np.array([seed], np.int64).view(np.uint64)
    return _mixed(_mixed(start + _STEP) + trees.astype(np.uint64) * _STEP)


def drawn(keys: np.ndarray, tree: int, seed: int) -> np.ndarray:
    """How often each row is in a tree: Poisson with mean one."""
    bits = _mixed(_mixed(keys.view(np.uint64)) + _of_trees(np.array([tree]), seed))
    return np.searchsorted(_CDF, (bits >> np.uint64(11)) * 2.0**-53, side="right")


def columns_of(trees: np.ndarray, nodes: np.ndarray, n_columns: int, n_features: int, seed: int) -> np.ndarray:
    """The features, in order, that each node may split."""
    own = _mixed(_of_trees(trees, seed + 1) + nodes.astype(np.uint64) * _STEP)
    bits = _mixed(own[:, None] + (np.arange(n_features, dtype=np.uint64) + np.uint64(1)) * _STEP)
    return np.sort(np.argsort(bits, axis=1)[:, :n_columns], axis=1)


# ---------------------------------------------------------------- splits


def scores(
    left: np.ndarray, total: np.ndarray, own: np.ndarray, weights: np.ndarray, leaf_rows: int
) -> tuple[np.ndarray, np.ndarray]:
    """Purity of both sides of each cell, 0 where a side is too small; and that of each slot, which a split must exceed.

    ``left`` is (classes, cells), ``total`` (classes, slots), and ``own`` the slot of each cell.
    """
    squares, least = weights**2, max(leaf_rows, 1)
    n, lw = np.stack([np.ones_like(weights), weights]) @ left
    lt = np.einsum("cu,cu->u", left, (total * squares[:, None]).take(own, axis=1))
    ll = squares @ np.square(left)
    tw, tt = weights @ total, squares @ np.square(total)
    rr = tt.take(own)
    rr -= 2 * lt
    rr += ll
    fits = (n >= least) & (n <= (total.sum(0) - least).take(own))
    rw = tw.take(own) - lw
    np.divide(ll, lw, out=ll, where=fits)
    np.divide(rr, rw, out=rr, where=fits)
    ll += rr
    ll *= fits
    return ll, tt / tw


def _dense(
    codes: np.ndarray, slot: np.ndarray, y: np.ndarray, count: np.ndarray, total: np.ndarray, weights: np.ndarray,
    leaf_rows: int, n_bins: int,
) -> tuple[np.ndarray, np.ndarray]:
    """(place among the columns or -1, bin) of the best split of each slot, from full histograms."""
    n_classes, n_slots = total.shape
    m = codes.shape[1]
    size = n_slots * m * n_bins
    counts = np.zeros(n_classes * size)
    step = max(1, CELLS // m)
    for i in range(0, len(slot), step):
        part = slice(i, i + step)
        cell = (slot[part, None] * m + np.arange(m)) * n_bins + codes[part] + y[part, None] * size
        counts += np.bincount(cell.ravel(), np.repeat(count[part], m), len(counts))
    return best_of(counts.reshape(n_classes, n_slots, m, n_bins), total, weights, leaf_rows)


def best_of(
    counts: np.ndarray, total: np.ndarray, weights: np.ndarray, leaf_rows: int
) -> tuple[np.ndarray, np.ndarray]:
    """(place among the columns or -1, bin) from counts by (class, slot, column, bin)."""
    n_classes, n_slots, m, n_bins = counts.shape
    left = counts.cumsum(3).reshape(n_classes, -1)
    score, whole = scores(left, total, np.repeat(np.arange(n_slots), m * n_bins), weights, leaf_rows)
    score = score.reshape(n_slots, -1)
    best = score.max(1)
    place = (score >= (best * EQUAL)[:, None]).argmax(1)
    return np.where(best > whole / EQUAL, place // n_bins, -1), place % n_bins


def _sorted(
    codes: np.ndarray, slot: np.ndarray, y: np.ndarray, count: np.ndarray, total: np.ndarray, weights: np.ndarray,
    leaf_rows: int, n_bins: int,
) -> tuple[np.ndarray, np.ndarray]:
    """As ``_dense``, from the bins that occur."""
    n_classes, n_slots = total.shape
    m = codes.shape[1]
    # Class and count ride in the lower bits, so one plain sort orders them too.
    packed = ((slot[:, None] * m + np.arange(m)) * n_bins + codes) << 32 | (y << 16 | count.astype(np.int64))[:, None]
    packed = np.sort(packed, axis=None)
    cell = packed >> 32
    first = np.r_[True, cell[1:] != cell[:-1]]
    at, cell = np.cumsum(first) - 1, cell[first]
    counts = np.bincount((packed >> 16 & 0xFFFF) * len(cell) + at, packed & 0xFFFF, n_classes * len(cell))
    counts = counts.reshape(n_classes, -1)
    # A group begins at zero: all of a slot's rows are in each of its columns, so the totals are what came before.
    group = cell // n_bins
    starts = np.searchsorted(group, np.arange(n_slots * m))
    counts[:, starts[1:]] -= np.repeat(total, m, axis=1)[:, :-1]
    own = group // m
    score, whole = scores(counts.cumsum(1), total, own, weights, leaf_rows)
    best = np.maximum.reduceat(score, starts[::m])
    hits = np.flatnonzero(score >= (best * EQUAL).take(own))[::-1]
    place = np.zeros(n_slots, np.int64)
    place[own[hits]] = hits  # the first hit of a slot is written last
    return np.where(best > whole / EQUAL, group[place] % m, -1), cell[place] % n_bins


def _splits(
    bins: np.ndarray, row: np.ndarray, slot: np.ndarray, y: np.ndarray, count: np.ndarray, total: np.ndarray,
    columns: np.ndarray, weights: np.ndarray, leaf_rows: int, n_bins: int,
) -> tuple[np.ndarray, np.ndarray]:
    """(feature or -1, bin) of each slot; rows are in slot order."""
    n_slots, m = columns.shape
    feature, cut = np.full(n_slots, -1), np.zeros(n_slots, np.int64)
    sizes = np.bincount(slot, minlength=n_slots)
    large = sizes >= DENSE
    for chosen, find in ((large, _dense), (~large, _sorted)):
        names = np.flatnonzero(chosen)
        if not len(names):
            continue
        rows = np.flatnonzero(chosen[slot])
        ends = np.cumsum(sizes[names])
        cost = len(weights) * m * (np.full(len(names), n_bins) if find is _dense else sizes[names])
        block = np.cumsum(cost) // CELLS
        edges = [0, *(np.flatnonzero(np.diff(block)) + 1), len(names)]
        for a, b in zip(edges, edges[1:]):
            part = rows[ends[a - 1] if a else 0 : ends[b - 1]]
            own = np.searchsorted(names[a:b], slot[part])
            codes = bins.ravel().take((row[part] * bins.shape[1])[:, None] + columns[names[a:b]].take(own, axis=0))
            place, at = find(codes, own, y[part], count[part], total[:, names[a:b]], weights, leaf_rows, n_bins)
            found = place >= 0
            feature[names[a:b][found]] = columns[names[a:b][found], place[found]]
            cut[names[a:b]] = at
    return feature, cut


# ---------------------------------------------------------------- trees


@dataclass
class Rows:
    """Binned rows; held-out ones have a place in the votes, the others -1."""

    keys: np.ndarray
    y: np.ndarray
    held: np.ndarray
    bins: np.ndarray


def whole_shares(total: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Class shares (nodes, classes) as whole numbers; zeros for a node without rows."""
    weighted = (total * weights[:, None]).T
    sums = weighted.sum(1, keepdims=True)
    return np.rint(np.divide(weighted, sums, out=np.zeros_like(weighted), where=sums > 0) * SHARE).astype(np.int64)


def grow(
    rows: Rows, row: np.ndarray, count: np.ndarray, slot: np.ndarray, tree: np.ndarray, node: np.ndarray,
    growth: Growth, weights: np.ndarray, n_bins: int, votes: np.ndarray,
) -> None:
    """Grow the trees below ``node`` of each slot and add the shares of held-out rows to ``votes``.

    ``row`` and ``count`` say which rows are in a slot and how often; they are in slot order.
    """
    n_classes, n_features = len(weights), rows.bins.shape[1]
    m = growth.n_columns(n_features)
    while len(row):
        n_slots = len(tree)
        y = rows.y[row]
        total = np.bincount(y * n_slots + slot, count, n_classes * n_slots).reshape(n_classes, n_slots)
        shallow = node < (1 << growth.depth)
        open_ = shallow & (total.sum(0) >= 2 * max(growth.leaf_rows, 1)) & ((total > 0).sum(0) > 1)
        feature, cut = np.full(n_slots, -1), np.zeros(n_slots, np.int64)
        if open_.any():
            names = np.flatnonzero(open_)
            part = np.flatnonzero(open_[slot])
            columns = columns_of(tree[names], node[names], m, n_features, growth.seed)
            own = (np.cumsum(open_) - 1)[slot[part]]
            feature[names], cut[names] = _splits(
                rows.bins, row[part], own, y[part], count[part], total[:, names], columns, weights, growth.leaf_rows, n_bins
            )
        inner = feature >= 0
        done = np.flatnonzero(~inner[slot] & (rows.held[row] >= 0))
        if len(done):
            np.add.at(votes, rows.held[row[done]], whole_shares(total, weights)[slot[done]])
        kept = inner[slot]
        row, count, old = row[kept], count[kept], slot[kept]
        right = rows.bins[row, feature[old]] > cut[old]
        child = 2 * (np.cumsum(inner) - 1)[old] + right
        # Rows are in slot order, so the left ones are too; each side moves behind what its children follow.
        sizes = np.bincount(child, minlength=2 * int(inner.sum()))
        ends = np.cumsum(sizes)
        at = np.empty(len(row), np.int64)
        for side, own in ((0, ~right), (1, right)):
            n = sizes[side::2]
            at[own] = np.repeat(ends[side::2] - np.cumsum(n), n) + np.arange(int(n.sum()))
        moved = np.empty_like(row), np.empty_like(count), np.empty_like(child)
        for new, values in zip(moved, (row, count, child)):
            new[at] = values
        row, count, slot = moved
        tree = np.repeat(tree[inner], 2)
        node = np.stack([2 * node[inner], 2 * node[inner] + 1], axis=1).ravel()


def votes_of(rows: Rows, trees: Sequence[int], growth: Growth, weights: np.ndarray, n_bins: int) -> np.ndarray:
    """Summed shares (held-out rows, classes) of whole trees, grown a batch at a time."""
    votes = np.zeros((int(rows.held.max(initial=-1)) + 1, len(weights)), np.int64)
    trains = rows.held < 0
    at_once = max(1, BATCH // max(len(rows.y), 1))
    for i in range(0, len(trees), at_once):
        batch = trees[i : i + at_once]
        parts = []
        for tree in batch:
            count = np.where(trains, drawn(rows.keys, tree, growth.seed), 0)
            taken = np.flatnonzero((count > 0) | ~trains)
            parts.append((taken, count[taken].astype(float)))
        slot = np.repeat(np.arange(len(batch)), [len(p[0]) for p in parts])
        row, count = (np.concatenate([p[j] for p in parts]) for j in (0, 1))
        grow(rows, row, count, slot, np.array(batch), np.ones(len(batch), np.int64), growth, weights, n_bins, votes)
    return votes


# ---------------------------------------------------------------- tables

_TABLE = "key long, class_id int, held boolean, bins binary"
_VOTES = "id long, class_id int, shares array<long>"


@dataclass(frozen=True)
class Table:
    """Binned training and held-out rows, stored, with what every forest on them shares."""

    rows: DataFrame  # id and the columns of _TABLE
    n_rows: int
    n_bins: int
    n_features: int
    weights: np.ndarray  # by class

    @property
    def n_classes(self) -> int:
        return len(self.weights)


def binned(
    train: DataFrame, held: DataFrame, n_features: int, n_classes: int, column: str = "features", key: str = "path"
) -> Table:
    """Rows with ``class_id`` to train on (their ``weight`` is that of the class) and rows to score."""
    usable = train.where(F.col("class_id").isNotNull() & (F.col("weight") > 0))
    edges = boosting.quantile_edges(usable, column, n_features)
    found = usable.groupBy("class_id").agg(F.max("weight").alias("w")).collect()  # one row a class
    weights = np.ones(n_classes)
    for r in found:
        weights[r["class_id"]] = r["w"]
    cutter = boosting.Boosted(edges, n_classes)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bins = cutter.binned(boosting._matrix(batch.column(3), n_features))
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], _binary(bins)], ["key", "class_id", "held", "bins"])

    names = F.xxhash64(key).alias("key"), F.col("class_id").cast("int")
    given = usable.select(*names, F.lit(False).alias("held"), column).union(
        held.select(*names, F.lit(True).alias("held"), column)
    )
    rows = stable(given.mapInArrow(cut, _TABLE).withColumn("id", F.monotonically_increasing_id()), "binned")
    return Table(rows, rows.count(), max(map(len, edges)) + 1, n_features, weights)


def _binary(bins: np.ndarray) -> pa.Array:
    fixed = pa.FixedSizeBinaryArray.from_buffers(
        pa.binary(bins.shape[1]), len(bins), [None, pa.py_buffer(np.ascontiguousarray(bins).tobytes())]
    )
    return fixed.cast(pa.binary())


def _rows(table: pa.Table | pa.RecordBatch, n_features: int) -> Rows:
    held = table["held"].to_pandas().to_numpy(bool)
    y = table["class_id"].to_pandas().fillna(0).to_numpy(np.int64)
    bins = np.frombuffer(b"".join(table["bins"].to_pylist()), np.uint8).reshape(-1, n_features)
    return Rows(table["key"].to_pandas().to_numpy(np.int64), y, np.where(held, np.cumsum(held) - 1, -1), bins)


def _voted(table: pa.Table, held: np.ndarray, votes: np.ndarray) -> pa.Table:
    chosen = pa.array(held >= 0)
    return pa.table(
        {
            "id": table["id"].filter(chosen),
            "class_id": table["class_id"].filter(chosen),
            "shares": pa.array(list(votes), pa.list_(pa.int64())),
        }
    )


def scored(table: Table, growth: Growth) -> DataFrame:
    """``id``, ``y_true`` and ``proba`` of the held-out rows: mean class shares over all trees."""
    votes = _whole_trees(table, growth) if table.n_rows < LOCAL else _cut_trees(table, growth)
    sums = [F.sum(F.element_at("shares", i + 1)) for i in range(table.n_classes)]
    summed = votes.groupBy("id", "class_id").agg(F.array(*sums).alias("s"))
    total = F.greatest(F.aggregate("s", F.lit(0).cast("long"), lambda a, v: a + v), F.lit(1))
    return summed.select("id", F.col("class_id").alias("y_true"), F.transform("s", lambda v: v / total).alias("proba"))


def _whole_trees(table: Table, growth: Growth) -> DataFrame:
    """Votes of tasks that each hold all rows and grow their part of the trees."""
    spark = table.rows.sparkSession
    tasks = min(growth.trees, 2 * spark.sparkContext.defaultParallelism)
    weights, n_bins, n_features = table.weights, table.n_bins, table.n_features

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        given = pa.Table.from_batches(list(batches))
        if given.num_rows:
            rows = _rows(given, n_features)
            trees = range(given["task"][0].as_py(), growth.trees, tasks)
            yield from _voted(given, rows.held, votes_of(rows, trees, growth, weights, n_bins)).to_batches()

    numbers = spark.range(0, tasks, 1, tasks).withColumnRenamed("id", "task")
    # Below LOCAL rows the table is small, and every task needs all of it.
    return numbers.crossJoin(F.broadcast(table.rows)).mapInArrow(run, _VOTES)


# ---------------------------------------------------------------- trees over many rows


@dataclass
class Top:
    """The upper splits of one tree, by heap number."""

    splits: dict[int, tuple[int, int]]

    def nodes(self, bins: np.ndarray) -> np.ndarray:
        """The node below the splits that each row falls to."""
        node = np.ones(len(bins), np.int64)
        if not self.splits:
            return node
        names = np.array(sorted(self.splits))
        feature, cut = np.array([self.splits[n] for n in names.tolist()]).T
        at = np.arange(len(bins))
        while len(at):
            place = np.minimum(np.searchsorted(names, node[at]), len(names) - 1)
            inner = names[place] == node[at]
            at, place = at[inner], place[inner]
            node[at] = 2 * node[at] + (bins[at, feature[place]] > cut[place])
        return node


def _cut_trees(table: Table, growth: Growth) -> DataFrame:
    """Votes of trees that are too large for one task, a group of trees at a time."""
    at_once = max(1, GROUP // table.n_rows)
    votes: DataFrame | None = None
    for first in range(0, growth.trees, at_once):
        trees = list(range(first, min(first + at_once, growth.trees)))
        tops, leaves = _tops(table, growth, trees)
        sums = [F.sum(F.element_at("shares", i + 1)) for i in range(table.n_classes)]
        part = _below(table, growth, tops, leaves)
        kept = stable(part.groupBy("id", "class_id").agg(F.array(*sums).alias("shares")), "votes")
        votes = kept if votes is None else votes.union(kept)
    return votes


def _tops(table: Table, growth: Growth, trees: Sequence[int]) -> tuple[dict[int, Top], dict[tuple[int, int], np.ndarray]]:
    """Splits of all nodes of at least LOCAL rows, and the shares of those that are leaves."""
    tops, leaves = {t: Top({}) for t in trees}, {}
    open_ = [(t, 1) for t in trees]
    for level in range(growth.depth):
        following = []
        for s in _best(table, growth, tops, open_).collect():  # one row per open node
            tree, node = s["tree"], s["node"]
            total, left = np.array(s["total"], float), np.array(s["left"], float)
            if s["feature"] < 0:
                leaves[tree, node] = whole_shares(total[:, None], table.weights)[0]
                continue
            tops[tree].splits[node] = s["feature"], s["cut"]
            for child, counts in ((2 * node, left), (2 * node + 1, total - left)):
                if counts.sum() < LOCAL:
                    continue
                if level + 1 < growth.depth:
                    following.append((tree, child))
                else:
                    leaves[tree, child] = whole_shares(counts[:, None], table.weights)[0]
        open_ = following
        if not open_:
            break
    return tops, leaves


def _best(table: Table, growth: Growth, tops: Mapping[int, Top], open_: Sequence[tuple[int, int]]) -> DataFrame:
    """The best split of every open (tree, node), with the counts by class of the node and its left side."""
    weights, n_bins, n_features = table.weights, table.n_bins, table.n_features
    n_classes, m = len(weights), growth.n_columns(table.n_features)
    names = np.array(sorted(open_))
    columns = columns_of(names[:, 0], names[:, 1], m, n_features, growth.seed)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(len(names) * n_classes * m * n_bins)
        for batch in batches:
            rows = _rows(batch, n_features)
            for tree in np.unique(names[:, 0]).tolist():
                first, last = np.searchsorted(names[:, 0], [tree, tree + 1])
                times = np.where(rows.held < 0, drawn(rows.keys, tree, growth.seed), 0)
                at = np.flatnonzero(times)
                node = tops[tree].nodes(rows.bins[at])
                place = np.minimum(np.searchsorted(names[first:last, 1], node) + first, last - 1)
                here = names[place, 1] == node
                at, place = at[here], place[here]
                codes = rows.bins[at[:, None], columns[place]]
                cell = ((place * n_classes + rows.y[at])[:, None] * m + np.arange(m)) * n_bins + codes
                np.add.at(counts, cell.ravel(), np.repeat(times[at], m).astype(float))
        for (tree, node), own in zip(names.tolist(), counts.reshape(len(names), -1)):
            yield pa.RecordBatch.from_pydict({"tree": [tree], "node": [node], "counts": [own.tobytes()]})

    def choose(key: tuple, parts: pa.Table) -> pa.Table:
        tree, node = (k.as_py() for k in key)
        counts = sum(np.frombuffer(p) for p in parts["counts"].to_pylist()).reshape(n_classes, 1, m, n_bins)
        total = counts[:, :, 0].sum(2)
        (place,), (cut,) = best_of(counts, total, weights, growth.leaf_rows)
        own = columns[np.flatnonzero((names == (tree, node)).all(1))[0]]
        left = counts[:, 0, place, : cut + 1].sum(1)
        return pa.table(
            {"tree": [tree], "node": [node], "feature": [int(own[place]) if place >= 0 else -1], "cut": [int(cut)],
             "total": [total[:, 0].tolist()], "left": [left.tolist()]}
        )

    sums = table.rows.mapInArrow(count, "tree long, node long, counts binary")
    return sums.groupBy("tree", "node").applyInArrow(
        choose, "tree long, node long, feature long, cut long, total array<double>, left array<double>"
    )


def _below(
    table: Table, growth: Growth, tops: Mapping[int, Top], leaves: Mapping[tuple[int, int], np.ndarray]
) -> DataFrame:
    """Votes of the nodes below the upper splits, each of them one task's work."""
    weights, n_bins, n_features = table.weights, table.n_bins, table.n_features

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = _rows(batch, n_features)
            for tree, top in tops.items():
                times = np.where(rows.held < 0, drawn(rows.keys, tree, growth.seed), 0)
                node = top.nodes(rows.bins)
                done = np.isin(node, [n for t, n in leaves if t == tree])
                at = np.flatnonzero((rows.held >= 0) | ((times > 0) & ~done))
                out = batch.select(["id", "class_id", "held", "key", "bins"]).take(pa.array(at))
                own = [pa.array(v) for v in (np.full(len(at), tree), node[at], times[at].astype(np.int32))]
                yield pa.RecordBatch.from_arrays([*own, *out.columns], ["tree", "node", "times", *out.schema.names])

    def finish(key: tuple, given: pa.Table) -> pa.Table:
        tree, node = (k.as_py() for k in key)
        rows = _rows(given, n_features)
        if (tree, node) in leaves:
            votes = np.tile(leaves[tree, node], (len(rows.y), 1))
        else:
            votes = np.zeros((int(rows.held.max()) + 1, len(weights)), np.int64)
            every, times = np.arange(len(rows.y)), given["times"].to_numpy().astype(float)
            root = np.zeros(len(every), np.int64), np.array([tree]), np.array([node])
            grow(rows, every, times, *root, growth, weights, n_bins, votes)
        return _voted(given, rows.held, votes)

    dealt = table.rows.mapInArrow(
        deal, "tree long, node long, times int, id long, class_id int, held boolean, key long, bins binary"
    )
    return dealt.groupBy("tree", "node").applyInArrow(finish, _VOTES)
