from __future__ import annotations

import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from clipward import constants as K
from clipward.functions import distribution as D
from clipward.operators import drift
from clipward.operators.monitor import rolling_monitor
from clipward.sources import prediction_log, reference_store


def _log(spark, labels, confidences=None):
    rows = [
        (i, c, None if confidences is None else float(confidences[i])) for i, c in enumerate(labels)
    ]
    return spark.createDataFrame(rows, "id long, label string, confidence double").withColumn(
        "model_name", F.lit("m")
    )


def _psi(spark, expected, actual):
    table = lambda d: spark.createDataFrame(list(d.items()), "label string, share double")
    return drift.population_stability(drift.align_categories(table(expected), table(actual))).first()[0]


def _ks(a, b):
    grid = np.concatenate([a, b])
    cdf = lambda s: np.searchsorted(np.sort(s), grid, "right") / len(s)
    return np.abs(cdf(a) - cdf(b)).max()


def test_psi_is_zero_on_itself_and_large_when_one_class_dominates(spark):
    prior = drift.published_reference().class_prior
    assert _psi(spark, prior, prior) == pytest.approx(0.0, abs=1e-12)
    assert _psi(spark, prior, {"siren": 1.0}) > 1.0


def test_psi_without_categories_fails(spark):
    with pytest.raises(Exception, match="at least one category"):
        _psi_empty = spark.createDataFrame([], "label string, share double")
        drift.population_stability(drift.align_categories(_psi_empty, _psi_empty)).collect()


@pytest.mark.parametrize("seed", range(4))
def test_ks_forms_agree_with_the_definition(spark, seed):
    rng = np.random.default_rng(seed)
    ref, live = rng.beta(8, 2, 200).round(2), rng.beta(2 + 2 * seed, 8, 150).round(2)
    frame = lambda s: spark.createDataFrame([(float(v),) for v in s], "v double")
    want = _ks(ref, live)
    assert drift.ks_two_sample(frame(ref), frame(live), "v").first()["ks"] == pytest.approx(want, abs=1e-12)
    got = drift.ks_to_samples(frame(live), "v", list(ref)).first()["ks"]
    assert got == pytest.approx(want, abs=1e-12)
    assert drift.ks_two_sample(frame(ref), frame(ref), "v").first()["ks"] == 0.0


def test_ks_with_an_empty_side_fails(spark):
    some = spark.createDataFrame([(1.0,)], "v double")
    with pytest.raises(Exception, match="non-empty"):
        drift.ks_two_sample(some, some.where("v > 2"), "v").collect()


def test_score_predictions(spark):
    reference = drift.published_reference()
    row = drift.score_predictions(_log(spark, ["dog_bark"] * 50 + ["siren"] * 50), reference).first()
    assert row["n_observations"] == 100 and row["psi_class"] > 0.5 and row["ks_confidence"] is None
    with pytest.raises(Exception, match="known label"):
        drift.score_predictions(_log(spark, ["cat"]), reference).collect()


def test_unknown_labels_are_reported_not_scored(spark):
    reference = drift.reference_from_counts({"a": 1, "b": 1}, ["a", "b"])
    row = drift.score_predictions(_log(spark, ["a", "b", "x", "x"]), reference).first()
    assert row["psi_class"] == pytest.approx(0.0, abs=1e-12)
    assert (row["n_observations"], row["n_unknown_labels"]) == (4, 2)


def test_monitor_waits_for_a_full_window(spark):
    reference = drift.published_reference()
    log = _log(spark, ["dog_bark", "siren", "dog_bark", "siren"], [0.9, 0.8, 0.7, 0.6])
    rows = rolling_monitor(log, reference, order=["id"], rows=3).orderBy("id").collect()
    assert [r["id"] for r in rows] == [2, 3]
    assert all(r["n_observations"] == 3 and r["psi_class"] > 0 and r["ks_confidence"] is None for r in rows)


def test_monitor_scores_each_window_like_a_batch(spark):
    rng = np.random.default_rng(3)
    labels = rng.choice(K.CLASS_NAMES, 60)
    confidence = rng.random(60).round(2)
    reference = drift.extended(drift.published_reference(), quantiles=[0.1, 0.5, 0.5, 0.9], n_confidences=4)
    got = rolling_monitor(_log(spark, labels.tolist(), confidence), reference, order=["id"], rows=20)
    for row in got.where("id % 13 = 0").collect():
        part = slice(row["id"] - 19, row["id"] + 1)
        want = drift.score_predictions(_log(spark, labels[part].tolist(), confidence[part]), reference).first()
        assert row["psi_class"] == pytest.approx(want["psi_class"], abs=1e-12)
        assert row["ks_confidence"] == pytest.approx(_ks(np.array([0.1, 0.5, 0.5, 0.9]), confidence[part]))


def _columns(spark, **values):
    names = list(values)
    rows = list(zip(*[map(float, v) for v in values.values()], strict=True))
    return spark.createDataFrame(rows, ", ".join(f"{n} double" for n in names))


@pytest.mark.parametrize("width", [1, 12])
def test_feature_drift_matches_numpy(spark, width):
    """Both the compiled (narrow) and the Arrow (wide) way, with non-finite values."""
    rng = np.random.default_rng(width)
    names = [f"x{i}" for i in range(width)]
    ref = {n: rng.normal(size=400) for n in names}
    live = {n: np.append(rng.normal(0.4 * i, 1.2, size=150), [np.nan, np.inf]) for i, n in enumerate(names)}
    table = drift.feature_histograms(_columns(spark, **ref), names, bins=8)
    stored = drift.collect_histograms(table)
    scores = {r["feature"]: r for r in drift.score_feature_columns(_columns(spark, **live), stored).collect()}
    for n in names:
        counts, edges = np.histogram(ref[n], bins=8)
        assert np.allclose(stored[n].edges, edges) and np.allclose(stored[n].density, counts / 400)
        good = live[n][np.isfinite(live[n])]
        actual = np.histogram(np.clip(good, edges[0], edges[-1]), bins=edges)[0] / len(good)
        e, a = np.maximum(counts / 400, 1e-6), np.maximum(actual, 1e-6)
        assert scores[n]["psi"] == pytest.approx(((a - e) * np.log(a / e)).sum(), abs=1e-9)
        repeats = np.maximum(np.round(counts / 400 * max(len(good), 32)), 1).astype(int)
        middles = np.repeat((edges[:-1] + edges[1:]) / 2, repeats)
        assert scores[n]["ks"] == pytest.approx(_ks(middles, good), abs=1e-12)


def test_same_draw_has_little_feature_drift(spark):
    x = np.random.default_rng(1).normal(size=400)
    df = _columns(spark, mfcc_0_mean=x)
    stored = drift.collect_histograms(drift.feature_histograms(df, ["mfcc_0_mean"], 8))
    row = drift.feature_drift_summary(drift.score_feature_columns(df, stored)).first()
    assert row["mean_psi"] < 0.05 and row["max_psi_feature"] == "mfcc_0_mean"


def test_constant_feature_gets_a_unit_range(spark):
    stored = drift.collect_histograms(drift.feature_histograms(_columns(spark, x=[2.0, 2.0]), ["x"], 4))
    assert stored["x"].edges == (1.5, 1.75, 2.0, 2.25, 2.5) and sum(stored["x"].density) == 1.0


def test_features_must_overlap(spark):
    stored = {"x": drift.Histogram((0.0, 1.0), (1.0,))}
    with pytest.raises(ValueError, match="overlapping"):
        drift.score_feature_columns(_columns(spark, y=[1.0]), stored)
    with pytest.raises(ValueError, match="no feature histograms"):
        drift.score_feature_columns(_columns(spark, y=[1.0]), {})
    with pytest.raises(ValueError):
        drift.Histogram((0.0,), ())


def test_log_scan_rules(spark, tmp_path):
    ok = {"event": "prediction", "status": "ok", "label": "siren", "confidence": 0.9}
    rows = [
        ok,
        {**ok, "confidence": None},
        {k: v for k, v in ok.items() if k != "status"},
        {**ok, "status": None},
        {**ok, "status": "http_400"},
        {**ok, "event": None},
        {**ok, "event": "health"},
        {**ok, "label": None},
        [1, 2],
        7,
    ]
    text = "\n\n".join(json.dumps(r) for r in rows) + "\n   \n"
    (tmp_path / "log.jsonl").write_text(text)
    got = prediction_log.read_log(spark, str(tmp_path)).collect()
    assert sorted(r["confidence"] for r in got) == [0.0, 0.9, 0.9, 0.9]
    bad = spark.createDataFrame([("{broken",)], "value string")
    with pytest.raises(Exception, match="not JSON"):
        prediction_log.parse_log(bad).collect()
    assert prediction_log.parse_log(bad, strict=False).count() == 0


def test_confidence_lines(spark):
    lines = spark.createDataFrame([(" 0.5 ",), ("",), ("1",)], "value string")
    assert [r[0] for r in prediction_log.parse_confidences(lines).collect()] == [0.5, 1.0]
    with pytest.raises(Exception, match="not a number"):
        prediction_log.parse_confidences(spark.createDataFrame([("x",)], "value string")).collect()


def test_published_label_log_has_no_drift(spark):
    counts = spark.createDataFrame(list(K.EVAL_FOLD_CLASS_COUNTS.items()), "class string, n long")
    log = prediction_log.parse_log(prediction_log.label_log(counts).select("value"))
    row = drift.score_predictions(log, drift.published_reference()).first()
    assert row["n_observations"] == 837 and row["psi_class"] == pytest.approx(0.0, abs=1e-12)


def test_build_reference_from_a_feature_table(spark, tmp_path):
    rows = [(10, "dog_bark", False, 1.0), (10, "siren", False, 2.0), (9, "drilling", False, 3.0), (10, "dog_bark", True, 4.0)]
    path = str(tmp_path / "tabular")
    spark.createDataFrame(
        rows, "fold int, class string, is_augmented boolean, mfcc_0_mean double"
    ).write.parquet(path)
    chain = [
        ("missing", reference_store.existing_table(spark, str(tmp_path / "none"))),
        ("processed", reference_store.existing_table(spark, path)),
    ]
    reference = reference_store.build_reference(chain, features=["mfcc_0_mean", "mfcc_1_mean"], bins=4)
    assert reference.class_counts["dog_bark"] == 1 and reference.class_counts["siren"] == 1
    assert list(reference.feature_histograms) == ["mfcc_0_mean"] and not drift.knows_confidence(reference)
    store = str(tmp_path / "reference")
    reference_store.dump_reference(drift.reference_row(spark, reference), store)
    assert reference_store.load_reference(reference_store.read_reference(spark, store)) == reference


def test_reference_without_any_source(spark):
    assert reference_store.build_reference([]).class_counts == K.EVAL_FOLD_CLASS_COUNTS
    with pytest.raises(FileNotFoundError):
        reference_store.build_reference([], features=["x"])


def test_weighted_points_cdf():
    points, cdf = D.weighted_points({2.0: 1, 1.0: 3})
    assert points == [1.0, 2.0] and cdf == [0.0, 0.75, 0.75, 1.0, 1.0]
