"""Boosted trees against a brute-force numpy version, and the adaptive search as a pure function."""

from __future__ import annotations

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from clipward import constants as K
from clipward.operators import boosting, evaluation, gaussian, search
from clipward.operators.boosting import Growth


def brute_tree(x, y, w, margins, k, growth, allowed):
    """(feature, cut, weight) by node, from sorted loops over every cut."""
    p = boosting.softmax(margins)[:, k]
    g, h = w * (p - (y == k)), w * p * (1 - p)
    nodes = {}

    def grow(node, rows, depth):
        ga, ha = g[rows].sum(), h[rows].sum()
        nodes[node] = [-1, 0, -growth.rate * ga / (ha + growth.l2), 0.0]
        if depth == growth.depth:
            return
        best = (0.0, 0, 0)
        for f in allowed:
            for cut in range(x[:, f].max()):
                left = rows[x[rows, f] <= cut]
                right = rows[x[rows, f] > cut]
                if min(len(left), len(right)) < max(growth.leaf_rows, 1):
                    continue
                hl, hr = h[left].sum(), h[right].sum()
                if min(hl, hr) < growth.child_weight:
                    continue
                gain = g[left].sum() ** 2 / (hl + growth.l2) + g[right].sum() ** 2 / (hr + growth.l2) - ga**2 / (ha + growth.l2)
                if round(gain, 9) > best[0]:
                    best = (round(gain, 9), f, cut)
        if best[0] > 0:
            nodes[node][0], nodes[node][1], nodes[node][3] = best[1], best[2], best[0]
            grow(2 * node, rows[x[rows, best[1]] <= best[2]], depth + 1)
            grow(2 * node + 1, rows[x[rows, best[1]] > best[2]], depth + 1)

    grow(1, np.arange(len(x)), 0)
    if growth.leaves:  # one leaf at a time, the greatest gain first
        kept, leaves = set(), [1]
        while len(kept) + 1 < growth.leaves:
            open_ = [n for n in leaves if nodes[n][0] >= 0]
            if not open_:
                break
            node = max(open_, key=lambda n: (nodes[n][3], -n))
            kept.add(node)
            leaves = [n for n in leaves if n != node] + [2 * node, 2 * node + 1]
        for n in nodes:
            if n not in kept:
                nodes[n][0] = -1
    return nodes


def brute_apply(nodes, row):
    node = 1
    while nodes[node][0] >= 0:
        node = 2 * node + int(row[nodes[node][0]] > nodes[node][1])
    return nodes[node][2]


@pytest.fixture(scope="module")
def small(spark):
    rng = np.random.default_rng(5)
    x = np.round(rng.normal(size=(90, 4)), 2)
    y = ((x[:, 0] > 0).astype(int) + (x[:, 1] * x[:, 2] > 0)).astype(int)
    w = rng.uniform(0.5, 2.0, 90)
    rows = [(f"r{i}", int(y[i]), float(w[i]), x[i].tolist()) for i in range(90)]
    table = spark.createDataFrame(rows, "path string, class_id int, weight double, features array<double>")
    return x, y, w, table


@pytest.mark.parametrize(
    "growth",
    [
        Growth(trees=3, depth=3, rate=0.3, bins=8),
        Growth(trees=2, depth=4, rate=0.5, bins=8, l2=3.0, child_weight=2.0, leaf_rows=5),
        Growth(trees=2, depth=4, rate=0.3, bins=8, leaves=4, child_weight=0.1, column_share=0.5),
    ],
)
def test_trees_equal_brute_force(small, growth):
    x, y, w, table = small
    model = boosting.fit(table.repartition(3), 4, 3, growth)
    bins = model.binned(x).astype(int)
    margins = np.zeros((90, 3))
    for number, trees in enumerate(model.rounds):
        step = np.zeros_like(margins)
        for k, tree in enumerate(trees):
            n = max(1, math.ceil(growth.column_share * 4))
            allowed = sorted(random.Random(f"{growth.seed}:{number}:{k}").sample(range(4), n))
            nodes = brute_tree(bins, y, w, margins, k, growth, allowed)
            for node, (feature, cut, weight, _) in nodes.items():
                inside = node == 1 or all(nodes[node >> i][0] >= 0 for i in range(1, node.bit_length()))
                if inside:
                    assert tree.feature[node] == feature and tree.weight[node] == pytest.approx(weight, abs=1e-9)
                    assert feature < 0 or tree.cut[node] == cut
            step[:, k] = [brute_apply(nodes, row) for row in bins]
            if growth.leaves:
                assert sum(f >= 0 for f in tree.feature) < growth.leaves
        margins += step
    assert model.margins(bins) == pytest.approx(margins, abs=1e-9)
    scored = boosting.with_shares(table, model).orderBy(F.expr("int(substr(path, 2))")).collect()
    assert np.array([r.proba for r in scored]) == pytest.approx(boosting.softmax(margins), abs=1e-9)


def test_margins_are_stored_between_rounds(small, monkeypatch):
    _, _, _, table = small
    growth = Growth(trees=5, depth=2, rate=0.5, bins=8, row_share=0.7)
    plain = boosting.fit(table, 4, 3, growth)
    monkeypatch.setattr(boosting, "KEEP", 2)
    kept = boosting.fit(table.repartition(4), 4, 3, growth)
    for a, b in zip(plain.rounds, kept.rounds):
        for left, right in zip(a, b):
            assert np.array_equal(left.feature, right.feature) and left.weight == pytest.approx(right.weight, abs=1e-9)


def test_boosting_edge_cases(spark):
    rows = [("a", 0, 1.0, [1.0, None]), ("b", 1, 1.0, [2.0, 5.0]), ("c", None, 1.0, [9.0, 1.0]), ("d", 1, 0.0, [3.0, 1.0]), ("e", 1, 1.0, None)]
    table = spark.createDataFrame(rows, "path string, class_id int, weight double, features array<double>")
    model = boosting.fit(table, 2, 2, Growth(trees=2, depth=2, child_weight=0.0))
    scored = boosting.with_shares(table, model).collect()
    assert len(scored) == 5 and all(abs(sum(r.proba) - 1) < 1e-9 for r in scored)
    assert boosting.with_shares(table.limit(0), model).count() == 0
    empty = boosting.fit(table.limit(0), 2, 2, Growth(trees=1, depth=2))
    assert boosting.with_shares(table, empty).first().proba == [0.5, 0.5]


# ---------------------------------------------------------------- search


def trials_of(space, n, value, seed=1):
    done = []
    for number in range(n):
        params = search.propose(space, search.visible(done, number, 4), number, seed)
        done.append(search.Trial(number, value(params), params))
    return done


@pytest.mark.parametrize("name", K.SEARCH_SPACE)
def test_proposals_stay_in_the_space_and_are_reproducible(name):
    space = K.SEARCH_SPACE[name]
    done = trials_of(space, 20, lambda p: sum(hash(str(v)) % 7 for v in p.values()) / 7)
    for t in done:
        # From the table alone: parameters as text, rows in any order.
        table = [search.Trial(d.number, d.value, {k: str(v) for k, v in d.params.items()}) for d in reversed(done)]
        assert search.propose(space, search.visible(table, t.number, 4), t.number, 1) == t.params
        for key, (kind, *bounds) in space.items():
            if kind == "choice":
                assert t.params[key] in bounds
            else:
                assert bounds[0] <= t.params[key] <= bounds[1]
                assert kind != "step" or (t.params[key] - bounds[0]) % bounds[2] == 0


def test_search_learns_from_completed_trials():
    space = {"a": ("real", 0.0, 1.0), "b": ("log", 1e-3, 1.0), "c": ("choice", "x", "y", "z"), "d": ("int", 1, 20)}

    def value(p):
        return -abs(p["a"] - 0.7) - abs(math.log10(p["b"]) + 1) / 3 + (p["c"] == "y") - abs(p["d"] - 5) / 20

    first, last = [], []
    for seed in range(12):
        scores = [t.value for t in trials_of(space, 40, value, seed)]
        first.append(np.mean(scores[:5]))
        last.append(np.mean(scores[-10:]))
    assert np.mean(last) > np.mean(first) + 0.4


def test_places_and_values_are_inverse():
    for spec in (("step", 100, 400, 50), ("int", 4, 24), ("real", 0.6, 1.0), ("log", 0.01, 0.3), ("int", 3, 3)):
        for u in np.linspace(0, 1, 41):
            v = search.value_at(spec, float(u))
            assert search.value_at(spec, search.place_of(spec, v)) == pytest.approx(v)
    ignored = search.Trial(0, math.nan, {})
    assert search.propose({"a": ("int", 1, 3)}, [ignored] * 9, 3) == search.propose({"a": ("int", 1, 3)}, [], 3)


# ---------------------------------------------------------------- one-scan cross-validation


def test_one_scan_equals_ten_separate_fits(spark):
    rng = np.random.default_rng(6)
    rows = []
    for i in range(240):
        c = int(rng.integers(0, 3))
        x = (rng.normal(size=5) * (1 + c) + c).tolist()
        rows.append((f"p{i}", i % 10 + 1, c, False, x))
        if i % 3 == 0:
            rows.append((f"p{i}_aug", i % 10 + 1, c, True, [v + 0.1 for v in x]))
    rows.append(("late", 4, 3, False, [9.0] * 5))  # a class that only fold 4 holds
    rows += [("n1", 1, 0, False, None), ("n2", 1, 0, False, [1.0, None, 1.0, 1.0, 1.0]), ("n3", 1, None, False, [1.0] * 5),
             ("n4", 1, 0, False, [float("nan")] * 5)]
    table = spark.createDataFrame(rows, "path string, fold int, class_id int, is_augmented boolean, features array<double>")
    got = {r.path: r for r in gaussian.cross_validate(table.repartition(5), 4, {"x": (0.3, 0.01)}).collect()}
    clean = [r for r in rows[:-4]]
    assert set(got) == {r[0] for r in clean if not r[3]}
    for fold in range(1, 11):
        train = [r for r in clean if r[1] != fold]
        classes = sorted({r[2] for r in train})
        x, y = np.array([r[4] for r in train]), np.array([r[2] for r in train])
        means = np.array([x[y == c].mean(0) for c in classes])
        own = np.array([x[y == c].var(0) for c in classes])
        counts = np.array([(y == c).sum() for c in classes])
        variance = 0.7 * own + 0.3 * (own * counts[:, None]).sum(0) / counts.sum() + 0.01
        for path, at, label, copy, features in clean:
            if at != fold or copy:
                continue
            v = -0.5 * (((np.array(features) - means) ** 2) / variance + np.log(variance)).sum(1)
            p = np.exp(v - v.max()) / np.exp(v - v.max()).sum()
            whole = [p[classes.index(k)] if k in classes else 0.0 for k in range(4)]
            assert got[path].proba == pytest.approx(whole, abs=1e-9)
            assert got[path].y_true == label and got[path].pred == int(np.argmax(whole))
    assert gaussian.cross_validate(table.limit(0), 4, {"x": (0.3, 0.01)}).count() == 0


def test_models_of_the_rotation_are_broadcast(spark, capsys):
    """A shuffle by fold would give each fold, and a search all of its rows, to one task."""
    rows = [(f"p{i}", i % 10 + 1, i % 3, False, [float(i % 7), float(i % 5)]) for i in range(60)]
    table = spark.createDataFrame(rows, "path string, fold long, class_id int, is_augmented boolean, features array<float>")
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    try:
        gaussian.cross_validate(table, 3, {"a": (0.5, 1e-3)}).explain()
    finally:
        spark.conf.set(key, before)
    assert "BroadcastHashJoin [fold" in capsys.readouterr().out


def test_closed_form_search_follows_from_its_table(spark):
    rng = np.random.default_rng(7)
    rows = [(f"p{i}", i % 10 + 1, i % 3, False, (rng.normal(size=3) + i % 3).tolist()) for i in range(200)]
    table = spark.createDataFrame(rows, "path string, fold int, class_id int, is_augmented boolean, features array<double>")
    trials = gaussian.search(table, 3, n_trials=9)
    known = search.completed(trials)
    assert sorted(t.number for t in known) == list(range(9))
    space = K.SEARCH_SPACE["gaussian"]
    for t in known:
        again = search.propose(space, search.visible(known, t.number, 4), t.number)
        assert {k: str(v) for k, v in again.items()} == t.params
        own = {"x": (float(t.params["shrink"]), float(t.params["smoothing"]))}
        scored = gaussian.cross_validate(table, 3, own).where("fold = 9")
        value = evaluation.classification_metrics(evaluation.confusion_counts(scored)).first()["f1_macro"]
        assert value == pytest.approx(t.value, abs=1e-12)
    assert {r.state for r in gaussian.search(table.where("fold <> 9"), 3, n_trials=2).collect()} == {"FAIL"}
