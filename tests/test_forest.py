"""Forests of a search: against brute force, however rows and trees are dealt, over the whole search space."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from clipward import constants as K
from clipward.operators import evaluation, forest, modeling, search
from clipward.operators.forest import Growth
from clipward.plans import training_queries as TQ

CLASSES, BINS, FEATURES = 4, 8, 6


def random_rows(n, n_held, seed=3):
    rng = np.random.default_rng(seed)
    held = np.r_[np.full(n, -1), np.arange(n_held)]
    y = rng.integers(0, CLASSES, n + n_held)
    bins = rng.integers(0, BINS, (n + n_held, FEATURES)).astype(np.uint8)
    bins[:, 2] = np.clip(2 * y + rng.integers(-1, 2, len(y)), 0, BINS - 1)
    return forest.Rows(rng.integers(-(2**62), 2**62, n + n_held), y, held, bins)


def brute_votes(rows, trees, growth, weights):
    """Every cut of every drawn feature, node by node."""
    votes = np.zeros((int((rows.held >= 0).sum()), CLASSES), np.int64)

    def below(tree, count, at, node, depth):
        total = np.bincount(rows.y[at], count[at], CLASSES) * 1.0
        best = (0.0, 0, 0)
        if depth < growth.depth and (total > 0).sum() > 1:
            whole = total * weights
            names = forest.columns_of(np.array([tree]), np.array([node]), growth.n_columns(FEATURES), FEATURES, growth.seed)
            for f in names[0]:
                for cut in range(BINS - 1):
                    left = np.bincount(rows.y[at], count[at] * (rows.bins[at, f] <= cut), CLASSES)
                    if min(left.sum(), (total - left).sum()) < growth.leaf_rows:
                        continue
                    sides = left * weights, (total - left) * weights
                    gini = [1 - (s**2).sum() / s.sum() ** 2 for s in (whole, *sides)]
                    gain = gini[0] - sum(s.sum() / whole.sum() * g for s, g in zip(sides, gini[1:]))
                    if round(gain, 10) > best[0]:
                        best = round(gain, 10), f, cut
        if best[0] > 0:
            right = rows.bins[at, best[1]] > best[2]
            below(tree, count, at[~right], 2 * node, depth + 1)
            below(tree, count, at[right], 2 * node + 1, depth + 1)
        else:
            held = rows.held[at]
            votes[held[held >= 0]] += forest.whole_shares(total[:, None], weights)[0]

    for tree in trees:
        count = np.where(rows.held < 0, forest.drawn(rows.keys, tree, growth.seed), 0)
        below(tree, count, np.flatnonzero((count > 0) | (rows.held >= 0)), 1, 0)
    return votes


@pytest.mark.parametrize("dense, cells", [(1, 1 << 18), (20, 300), (10**9, 1 << 18), (10**9, 300)])
@pytest.mark.parametrize("growth", [Growth(3, 24, 1, "0.5", 7), Growth(3, 3, 4, "sqrt", 1), Growth(3, 9, 2, "log2", 5)])
def test_trees_equal_brute_force(monkeypatch, growth, dense, cells):
    monkeypatch.setattr(forest, "DENSE", dense)
    monkeypatch.setattr(forest, "CELLS", cells)
    rows, weights = random_rows(140, 25), np.array([0.5, 1.0, 1.7, 0.9])
    got = forest.votes_of(rows, [0, 1, 5], growth, weights, BINS)
    assert np.array_equal(got, brute_votes(rows, [0, 1, 5], growth, weights))


def test_draws_and_features_of_nodes():
    keys = np.arange(200_000, dtype=np.int64)
    counts = forest.drawn(keys, 3, 42)
    assert counts.mean() == pytest.approx(1, abs=0.01) and counts.var() == pytest.approx(1, abs=0.02)
    assert abs(np.corrcoef(counts, forest.drawn(keys, 4, 42))[0, 1]) < 0.01
    nodes = np.arange(1, 20_001)
    columns = forest.columns_of(np.zeros(len(nodes), int), nodes, 8, 64, 42)
    assert (np.diff(columns, axis=1) > 0).all() and np.bincount(columns.ravel()).min() > 0.9 * 20_000 * 8 / 64
    assert [Growth(feature_subset=s).n_columns(64) for s in ("sqrt", "log2", "0.5")] == [8, 6, 32]


@pytest.fixture(scope="module")
def parts(spark):
    rng = np.random.default_rng(4)
    rows = []
    for i in range(420):
        x = (rng.normal(size=5) + [i % 3, 0, 0, 0, 0]).tolist()
        rows.append((f"p{i}", i % 3, [1.0, 0.7, 1.4][i % 3], x))
    rows[7] = ("p7", 1, 0.7, [None, 1.0, float("nan"), 0.0, 0.0])
    table = spark.createDataFrame(rows, "path string, class_id int, weight double, features array<float>")
    extra = [("n1", None, 1.0, [9.0] * 5), ("n2", 1, 0.0, [9.0] * 5)]  # these do not train
    train = table.where("substr(path, -1) <> '0'").union(spark.createDataFrame(extra, table.schema))
    return train, table.where("substr(path, -1) = '0'").drop("weight")


def scores_of(train, held, growth):
    table = forest.binned(train, held, 5, 3)
    given = dict(table.rows.where("held").select("id", "key").collect())
    return {given[r.id]: (r.y_true, tuple(r.proba)) for r in forest.scored(table, growth).collect()}


@pytest.mark.parametrize("subset, depth", [("0.5", 12), ("sqrt", 3)])
def test_scores_do_not_depend_on_how_rows_and_trees_are_dealt(monkeypatch, parts, subset, depth):
    train, held = parts
    growth = Growth(7, depth, 2, subset)
    whole = scores_of(train, held, growth)
    assert len(whole) == 42 and all(abs(sum(p) - 1) < 1e-9 for _, p in whole.values())
    assert scores_of(train.repartition(5), held.repartition(3), growth) == whole
    # Trees too large for a task: cut level by level, three at a time, the rest finished node by node.
    monkeypatch.setattr(forest, "LOCAL", 60)
    monkeypatch.setattr(forest, "GROUP", 1300)
    assert scores_of(train.repartition(4), held, growth) == whole
    monkeypatch.setattr(forest, "LOCAL", 1)
    assert scores_of(train, held, growth) == whole


def test_forest_without_rows_or_signal(spark, parts):
    train, held = parts
    assert scores_of(train, held.limit(0), Growth(2, 4)) == {}
    one = scores_of(train.where("class_id = 2"), held, Growth(3, 8))
    assert {p for _, p in one.values()} == {(0.0, 0.0, 1.0)}
    flat = train.withColumn("features", F.expr("transform(features, v -> cast(1 as float))"))
    assert len({p for _, p in scores_of(flat, held, Growth(3, 8)).values()}) == 1


def test_search_takes_the_whole_space(spark, sf_dir, monkeypatch):
    """Every trial of m6_search has the proposal of the unlimited space, and forests grow as large as proposed."""
    grown, score = [], forest.scored
    monkeypatch.setattr(forest, "scored", lambda table, growth: grown.append(growth) or score(table, growth))
    # The value of a trial does not matter here, so no tree is grown.
    monkeypatch.setattr(modeling, "macro_f1", lambda scored: len(grown) % 7 / 7)
    trials = [
        search.Trial(r.number, r.value, spark.createDataFrame([(r.params,)], "p string").select(F.from_json("p", "map<string,string>")).first()[0])
        for r in TQ.search(spark, sf_dir).collect()
    ]
    assert sorted(t.number for t in trials) == list(range(20)) and len(grown) == 20
    for t in trials:
        own = search.propose(K.SEARCH_SPACE["forest"], search.visible(trials, t.number, 4), t.number)
        assert {k: str(v) for k, v in own.items()} == dict(t.params)
        assert Growth.of(t.params) in grown
    assert max(g.trees for g in grown) >= 350 and max(g.depth for g in grown) >= 20 and min(g.trees for g in grown) >= 100


def test_search_learns_a_separable_table(spark):
    rng = np.random.default_rng(5)
    rows = [(f"p{i}", i // 3 % 10 + 1, "abc"[i % 3], False, (rng.normal(size=4) + 4 * (i % 3)).tolist()) for i in range(300)]
    table = spark.createDataFrame(rows, "path string, fold int, class string, is_augmented boolean, features array<float>")
    train, validation = table.where("fold < 9"), table.where("fold = 9")
    mapping = modeling.labels.label_map(train)
    trials = modeling.search("forest", train, validation, mapping, n_features=4, n_trials=2)
    best = evaluation.best_trial(trials).first()
    assert best["n_complete"] == 2 and best["value"] > 0.9 and all(int(r.params["trees"]) >= 100 for r in trials.collect())
