"""Second-order boosted trees for many classes, grown from grouped gradient histograms.

Features are cut into bins once, from one pass of quantiles. A round grows one tree per class, all of them
together and level by level: each level is one pass in which every task sums first and second derivatives of the
softmax loss per (class, node, feature, bin), and one grouped aggregate of these sums. What the driver holds is
the fitted state: bin edges and one best split per node. Splits maximise
GL^2 / (HL + l2) + GR^2 / (HR + l2) - G^2 / (H + l2) under a least second-derivative sum and row count per
child. With ``leaves``, a tree is cut back to the splits that growth by greatest gain would make first:
the split of a node does not depend on other nodes, so this equals leaf-wise growth within the depth.

Margins are stored every ``KEEP`` rounds, so a pass applies at most that many trees per class.

Cases: null features count as the least value; rows without a class or with a weight of null or zero do not
train; constant features are never split; equal gains go to the lower feature, then the lower bin.
"""

from __future__ import annotations

import heapq
import json
import math
import random
from collections.abc import Iterator, Mapping
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clipward.session import stable

BINS = 32
KEEP = 8
_SCALE = 1_000_000


@dataclass(frozen=True)
class Growth:
    """Parameters of a fit; names as in the search space."""

    trees: int = 100
    depth: int = 6
    rate: float = 0.1
    row_share: float = 1.0
    column_share: float = 1.0
    l2: float = 1.0
    child_weight: float = 1.0
    leaf_rows: int = 1
    leaves: int | None = None
    bins: int = BINS
    seed: int = 42

    @staticmethod
    def of(params: Mapping[str, object], seed: int = 42) -> Growth:
        kinds = {"trees": int, "depth": int, "leaf_rows": int, "leaves": int, "bins": int}
        known = {n: kinds.get(n, float)(v) for n, v in params.items() if n in Growth.__dataclass_fields__}
        return Growth(**{"seed": seed, **known})


@dataclass
class Tree:
    """Nodes by heap number: the root is 1, the children of i are 2i and 2i + 1."""

    feature: np.ndarray  # -1 for a leaf
    cut: np.ndarray  # bins up to this one go left
    weight: np.ndarray

    @staticmethod
    def empty(depth: int) -> Tree:
        n = 2 << depth
        return Tree(np.full(n, -1, np.int32), np.zeros(n, np.int32), np.zeros(n))

    def nodes(self, bins: np.ndarray) -> np.ndarray:
        """The leaf of every row."""
        at, rows = np.ones(len(bins), np.int64), np.arange(len(bins))
        for _ in range(len(self.feature).bit_length() - 2):
            f = self.feature[at]
            inner = f >= 0
            right = bins[rows, np.maximum(f, 0)] > self.cut[at]
            at = np.where(inner, 2 * at + right, at)
        return at


@dataclass
class Boosted:
    """A fitted model: bin edges per feature, and per round one tree for each class."""

    edges: list[np.ndarray]
    n_classes: int
    rounds: list[list[Tree]] = field(default_factory=list)

    def binned(self, features: np.ndarray) -> np.ndarray:
        columns = [np.searchsorted(e, features[:, i], side="left") for i, e in enumerate(self.edges)]
        return np.stack(columns, axis=1).astype(np.uint8)

    def margins(self, bins: np.ndarray, since: int = 0) -> np.ndarray:
        out = np.zeros((len(bins), self.n_classes))
        for trees in self.rounds[since:]:
            for k, tree in enumerate(trees):
                out[:, k] += tree.weight[tree.nodes(bins)]
        return out


def softmax(margins: np.ndarray) -> np.ndarray:
    e = np.exp(margins - margins.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """A list column of fixed width; null lists and null items become the least value."""
    filled = [v if v is not None else [None] * width for v in column.to_pylist()]
    table = np.array(filled, dtype=float).reshape(-1, width)
    return np.where(np.isnan(table), -np.inf, table)


def quantile_edges(rows: DataFrame, column: str, n_features: int, bins: int = BINS) -> list[np.ndarray]:
    """Bin edges of every feature from one pass; a value up to an edge lies below it."""
    shares = F.array(*[F.lit(i / bins) for i in range(1, bins)])
    wide = rows.select(*[F.element_at(column, i + 1).alias(f"x{i}") for i in range(n_features)])
    found = wide.agg(*[F.percentile_approx(f"x{i}", shares, 10_000).alias(f"x{i}") for i in range(n_features)]).first()
    return [np.unique(np.array(found[i] if found[i] is not None else [], float)) for i in range(n_features)]


_CELL = T.StructType(
    [
        T.StructField("k", T.IntegerType()),
        T.StructField("node", T.LongType()),
        T.StructField("feature", T.IntegerType()),
        T.StructField("bin", T.IntegerType()),
        T.StructField("g", T.DoubleType()),
        T.StructField("h", T.DoubleType()),
        T.StructField("n", T.DoubleType()),
    ]
)


def _histogram(
    batch: pa.RecordBatch, model: Boosted, since: int, growing: list[Tree], columns: list[list[int]], level: int
) -> Iterator[pa.RecordBatch]:
    """Sums of one batch per (class, node of ``level``, feature, bin)."""
    n_features, n_bins = len(model.edges), max(map(len, model.edges)) + 1
    bins = np.array(batch.column("bins").to_pylist(), np.int64).reshape(-1, n_features)
    margins = _matrix(batch.column("margins"), model.n_classes) + model.margins(bins, since)
    y, w = batch.column("class_id").to_numpy(), batch.column("weight").to_numpy()
    p = softmax(margins)
    for k, tree in enumerate(growing):
        node = tree.nodes(bins)
        here = np.flatnonzero(node >> level == 1)
        if not len(here):
            continue
        g = w[here] * (p[here, k] - (y[here] == k))
        h = w[here] * p[here, k] * (1 - p[here, k])
        own = np.asarray(columns[k])
        names, slot = np.unique(node[here], return_inverse=True)
        cell = ((slot[:, None] * len(own) + np.arange(len(own))) * n_bins + bins[here][:, own]).ravel()
        size = len(names) * len(own) * n_bins
        sums = [np.bincount(cell, np.repeat(v, len(own)), minlength=size) for v in (g, h, np.ones(len(here)))]
        used = np.flatnonzero(sums[2])
        rest, b = np.divmod(used, n_bins)
        slot, f = np.divmod(rest, len(own))
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.full(len(used), k, np.int32)),
                pa.array(names[slot]),
                pa.array(own[f].astype(np.int32)),
                pa.array(b.astype(np.int32)),
                *(pa.array(v[used]) for v in sums),
            ],
            _CELL.names,
        )


def best_splits(cells: DataFrame, growth: Growth) -> DataFrame:
    """The best split of every (class, node) from histogram cells, with the sums of both sides."""
    feature = ["k", "node", "feature"]
    summed = (
        cells.repartition(*feature)
        .groupBy(*feature, "bin")
        .agg(*[F.sum(c).alias(c) for c in ("g", "h", "n")])
    )
    whole, below = Window.partitionBy(*feature), Window.partitionBy(*feature).orderBy("bin")
    sides = summed.select(
        *feature,
        "bin",
        *[F.sum(c).over(below).alias(f"{c}l") for c in ("g", "h", "n")],
        *[F.sum(c).over(whole).alias(f"{c}a") for c in ("g", "h", "n")],
    )
    gr, hr, nr = (F.col(f"{c}a") - F.col(f"{c}l") for c in ("g", "h", "n"))
    fit = lambda g, h: g * g / (h + growth.l2)
    gain = fit(F.col("gl"), F.col("hl")) + fit(gr, hr) - fit(F.col("ga"), F.col("ha"))
    allowed = (
        (nr > 0)
        & (F.col("hl") >= growth.child_weight)
        & (hr >= growth.child_weight)
        & (F.col("nl") >= growth.leaf_rows)
        & (nr >= growth.leaf_rows)
    )
    scored = sides.withColumn("gain", F.when(allowed, F.round(gain, 9)).otherwise(-1.0))
    order = F.struct("gain", -F.col("feature"), -F.col("bin"))
    split = F.struct("feature", "bin", "gain", "gl", "hl", "ga", "ha")
    return scored.groupBy("k", "node").agg(F.max_by(split, order).alias("split")).select("k", "node", "split.*")


def keep_best(tree: Tree, gains: Mapping[int, float], leaves: int) -> None:
    """Cut ``tree`` back to the splits that come first by gain, until it has ``leaves`` leaves."""
    open_, kept = ([(-gains[1], 1)] if 1 in gains else []), set()
    while open_ and len(kept) + 1 < leaves:
        _, node = heapq.heappop(open_)
        kept.add(node)
        for child in (2 * node, 2 * node + 1):
            if child in gains:
                heapq.heappush(open_, (-gains[child], child))
    for node in gains:
        if node not in kept:
            tree.feature[node] = -1


def fit(
    rows: DataFrame, n_features: int, n_classes: int, growth: Growth, column: str = "features", key: str = "path"
) -> Boosted:
    """Fit on rows with ``class_id`` and ``weight``; ``key`` decides which rows a round samples."""
    usable = rows.where(F.col("class_id").isNotNull() & (F.col("weight") > 0))
    model = Boosted(quantile_edges(usable, column, n_features, growth.bins), n_classes)
    names = ["row", "class_id", "weight", "bins", "margins"]
    schema = "row long, class_id int, weight double, bins array<smallint>, margins array<double>"

    def start(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bins = model.binned(_matrix(batch.column(3), n_features)).astype(np.int16)
            zeros = np.zeros((batch.num_rows, n_classes))
            lists = [pa.array(list(v), t) for v, t in ((bins, pa.list_(pa.int16())), (zeros, pa.list_(pa.float64())))]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], *lists], names)

    given = usable.select(
        F.xxhash64(key).alias("row"), F.col("class_id").cast("int"), F.col("weight").cast("double"), column
    )
    table, since = stable(given.mapInArrow(start, schema), "binned"), 0
    for number in range(growth.trees):
        if number - since == KEEP:
            table, since = stable(_with_margins(table, model, since, schema, names), "margins"), number
        drawn = table
        if growth.row_share < 1:
            draw = F.pmod(F.xxhash64("row", F.lit(growth.seed), F.lit(number)), F.lit(_SCALE))
            drawn = table.where(draw < int(growth.row_share * _SCALE))
        model.rounds.append(_round(drawn, model, since, growth, number))
    return model


def _with_margins(table: DataFrame, model: Boosted, since: int, schema: str, names: list[str]) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bins = np.array(batch.column("bins").to_pylist(), np.int64).reshape(-1, len(model.edges))
            total = _matrix(batch.column("margins"), model.n_classes) + model.margins(bins, since)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:4], pa.array(list(total), pa.list_(pa.float64()))], names
            )

    return table.mapInArrow(run, schema)


def _round(table: DataFrame, model: Boosted, since: int, growth: Growth, number: int) -> list[Tree]:
    """One tree per class."""
    n_features = len(model.edges)
    trees = [Tree.empty(growth.depth) for _ in range(model.n_classes)]
    gains: list[dict[int, float]] = [{} for _ in trees]
    n_columns = max(1, math.ceil(growth.column_share * n_features))
    columns = [
        sorted(random.Random(f"{growth.seed}:{number}:{k}").sample(range(n_features), n_columns))
        for k in range(model.n_classes)
    ]
    for level in range(growth.depth):

        def run(batches: Iterator[pa.RecordBatch], level: int = level) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                yield from _histogram(batch, model, since, trees, columns, level)

        splits = best_splits(table.mapInArrow(run, _CELL), growth).collect()  # one row per open node
        for s in splits:
            leaf = lambda g, h: -growth.rate * g / (h + growth.l2)
            tree = trees[s["k"]]
            tree.weight[s["node"]] = leaf(s["ga"], s["ha"])
            if s["gain"] > 0:
                tree.feature[s["node"]], tree.cut[s["node"]] = s["feature"], s["bin"]
                tree.weight[2 * s["node"]] = leaf(s["gl"], s["hl"])
                tree.weight[2 * s["node"] + 1] = leaf(s["ga"] - s["gl"], s["ha"] - s["hl"])
                gains[s["k"]][s["node"]] = s["gain"]
        if not any(s["gain"] > 0 for s in splits):
            break
    if growth.leaves:
        for tree, own in zip(trees, gains):
            keep_best(tree, own, growth.leaves)
    return trees


def with_shares(rows: DataFrame, model: Boosted, column: str = "features") -> DataFrame:
    """``rows`` with ``proba``, the class shares of the margins; ``column`` goes."""
    kept = [f for f in rows.schema.fields if f.name not in (column, "proba")]
    at = rows.columns.index(column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bins = model.binned(_matrix(batch.column(at), len(model.edges)))
            shares = softmax(model.margins(bins)) if batch.num_rows else np.zeros((0, model.n_classes))
            columns = [batch.column(f.name) for f in kept]
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(list(shares), pa.list_(pa.float64()))], [*(f.name for f in kept), "proba"]
            )

    schema = T.StructType([*kept, T.StructField("proba", T.ArrayType(T.DoubleType()))])
    return rows.mapInArrow(run, schema)


def save(model: Boosted, spark: SparkSession, folder: str) -> None:
    """Store trees, edges and a ``metadata`` line that names the kind of model."""
    nodes = [
        (number, k, node, int(tree.feature[node]), int(tree.cut[node]), float(tree.weight[node]))
        for number, trees in enumerate(model.rounds)
        for k, tree in enumerate(trees)
        for node in range(len(tree.feature))
    ]
    schema = "round int, k int, node int, feature int, cut int, weight double"
    spark.createDataFrame(nodes, schema).write.mode("overwrite").parquet(f"{folder}/trees")
    edges = [(i, e.tolist()) for i, e in enumerate(model.edges)]
    spark.createDataFrame(edges, "feature int, edges array<double>").write.mode("overwrite").parquet(f"{folder}/edges")
    line = json.dumps({"class": f"{__name__}.{Boosted.__name__}", "n_classes": model.n_classes})
    spark.createDataFrame([(line,)], "value string").coalesce(1).write.mode("overwrite").text(f"{folder}/metadata")


def load(spark: SparkSession, folder: str) -> Boosted:
    """The model that ``save`` stored; its size is that of the fitted state."""
    about = json.loads(spark.read.text(f"{folder}/metadata").first()["value"])
    edges = spark.read.parquet(f"{folder}/edges").orderBy("feature").collect()
    model = Boosted([np.array(r["edges"], float) for r in edges], about["n_classes"])
    parts: dict[tuple[int, int], list] = {}
    for r in spark.read.parquet(f"{folder}/trees").orderBy("round", "k", "node").collect():
        parts.setdefault((r["round"], r["k"]), []).append(r)
    for (number, _), nodes in sorted(parts.items()):
        if number == len(model.rounds):
            model.rounds.append([])
        feature, cut, weight = (np.array([n[c] for n in nodes]) for c in ("feature", "cut", "weight"))
        model.rounds[number].append(Tree(feature.astype(np.int32), cut.astype(np.int32), weight))
    return model
