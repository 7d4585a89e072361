"""Models and streams end to end."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from clipward.operators import drift, evaluation, labels, modeling, splits
from clipward.operators import search as sampler
from clipward.operators.monitor import rolling_monitor
from clipward.plans import training_queries as TQ
from clipward.streaming import jobs, keyed


@pytest.fixture(scope="module")
def separable(spark):
    """Three classes apart from each other in four features, ten folds with copies."""
    rng = np.random.default_rng(2)
    rows = []
    for i in range(300):
        c = i % 3
        x = (rng.normal(size=4) + 4 * c).astype(float).tolist()
        rows.append((f"p{i}", i // 3 % 10 + 1, "abc"[c], False, x))
        if rows[-1][1] != 10:
            rows.append((f"p{i}_aug0", rows[-1][1], "abc"[c], True, x))
    return spark.createDataFrame(
        rows, "path string, fold int, class string, is_augmented boolean, features array<float>"
    ).persist()


@pytest.mark.parametrize(
    "name, params",
    [
        ("forest", {"trees": 8, "depth": 4}),
        ("boosted_depth", {"trees": 2, "depth": 2}),
        ("network", {"hidden": 8, "epochs": 40}),
    ],
)
def test_models_learn_and_give_probabilities(separable, name, params):
    train, held_out = splits.fold_split(separable)
    fitted = modeling.fit(name, params, train, labels.label_map(train), n_features=4)
    scored = fitted.evaluate(held_out).persist()
    assert modeling.macro_f1(scored) > 0.9
    total = F.aggregate("proba", F.lit(0.0), lambda a, v: a + v)
    assert scored.where(F.abs(total - 1) > 1e-9).count() == 0
    rows = modeling.prediction_rows(fitted.score(held_out), fitted).collect()
    assert all(set(r["probabilities"]) == {"a", "b", "c"} for r in rows)


def test_search_and_cross_validation(separable):
    parts = splits.four_way(separable)
    mapping = labels.label_map(parts["tune_train"])
    limits = {"trees": 100, "depth": 4}
    trials = modeling.search("forest", parts["tune_train"], parts["validation"], mapping, n_features=4, n_trials=2, limits=limits)
    best = evaluation.best_trial(trials).first()
    assert best["n_complete"] == 2 and best["value"] > 0.9
    scored = modeling.cross_validate("forest", {"trees": 3, "depth": 3}, separable, n_features=4, n_folds=3)
    assert evaluation.fold_metrics(scored, 3).where("f1_macro > 0.9").count() == 3
    assert scored.where("path LIKE '%aug%'").count() == 0


def test_trials_share_scaler_and_vectors(separable, monkeypatch):
    """What does not depend on a trial's parameters is made once."""
    parts = splits.four_way(separable)
    mapping = labels.stored_label_map(parts["tune_train"])
    calls, made = [], modeling.fit_array_scaler
    monkeypatch.setattr(modeling, "fit_array_scaler", lambda *a: calls.append(1) or made(*a))
    limits = {"trees": 2, "depth": 2}
    trials = modeling.search("forest", parts["tune_train"], parts["validation"], mapping, n_features=4, n_trials=3, limits=limits)
    assert trials.where("state = 'COMPLETE'").count() == 3 and len(calls) == 1


def test_rotation_is_dealt_over_the_cores(spark, separable, monkeypatch):
    """A table in one small file is not one task's work; how it was cut does not matter."""
    seen, store = {}, modeling.stable
    monkeypatch.setattr(modeling, "stable", lambda df, label="stable": seen.setdefault(label, df) is None or store(df, label))
    params = {"trees": 2, "depth": 2}
    scored = [
        modeling.cross_validate("forest", params, separable.repartition(n), n_features=4, n_folds=2).collect()
        for n in (1, 5)
    ]
    assert seen["rotation"].rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism
    first, second = ({r["path"]: r for r in rows} for rows in scored)
    assert first and first == second


def test_suggestions_are_reproducible_and_bounded():
    for number in range(20):
        a = modeling.suggest("forest", number, limits={"depth": 6})
        assert a == modeling.suggest("forest", number, limits={"depth": 6})
        assert 4 <= a["depth"] <= 6 and a["trees"] in range(100, 401, 50)
        assert 0.01 <= modeling.suggest("boosted_leaf", number)["rate"] <= 0.3
    with pytest.raises(ValueError):
        modeling.suggest("unknown", 0)


def test_stored_model(spark, separable, tmp_path):
    train, held_out = splits.fold_split(separable)
    fitted = modeling.fit("forest", {"trees": 3, "depth": 3}, train, labels.label_map(train), n_features=4)
    folder = str(tmp_path / "forest")
    fitted.save(folder)
    again = modeling.load_fitted(spark, folder, "forest")
    key = lambda m: sorted((r["path"], r["confidence"]) for r in m.score(held_out).collect())
    assert key(again) == key(fitted)
    with pytest.raises(ValueError, match="does not hold"):
        modeling.load_fitted(spark, folder, "network")
    with pytest.raises(FileNotFoundError, match="incomplete"):
        modeling.load_fitted(spark, str(tmp_path / "none"), "forest")


def test_stored_boosted_model(spark, separable, tmp_path):
    train, held_out = splits.fold_split(separable)
    params = {"trees": 2, "depth": 3, "leaves": 4, "l2": 0.5}
    fitted = modeling.fit("boosted_leaf", params, train, labels.label_map(train), n_features=4)
    folder = str(tmp_path / "boosted")
    fitted.save(folder)
    again = modeling.load_fitted(spark, folder, "boosted_leaf")
    key = lambda m: sorted((r["path"], r["confidence"]) for r in m.score(held_out).collect())
    assert key(again) == key(fitted)
    with pytest.raises(ValueError, match="does not hold"):
        modeling.load_fitted(spark, folder, "forest")


def test_search_proposals_follow_from_the_stored_table(separable):
    parts = splits.four_way(separable)
    mapping = labels.label_map(parts["tune_train"])
    args = parts["tune_train"], parts["validation"], mapping
    trials = modeling.search("boosted_depth", *args, n_features=4, n_trials=7, limits={"trees": 1, "depth": 2}, parallelism=3)
    known = sampler.completed(trials)
    assert sorted(t.number for t in known) == list(range(7))
    for t in known:
        seen = sampler.visible(known, t.number, 3)
        again = modeling.suggest("boosted_depth", t.number, 42, {"trees": 1, "depth": 2}, seen)
        assert {k: str(v) for k, v in again.items()} == t.params


def test_clip_forest_recognises_the_tones(spark, sf_dir):
    row = TQ.clip_holdout_metrics(spark, sf_dir).first()
    assert row["f1_macro"] > 0.8


def _log(spark, n, seed=0):
    rng = np.random.default_rng(seed)
    frame = pd.DataFrame(
        {
            "model_name": np.where(rng.random(n) < 0.7, "hot", "cold"),
            "ts": pd.Timestamp("2024-01-01") + pd.to_timedelta(np.arange(n), unit="min"),
            "event_id": np.arange(n),
            "label": rng.choice(["a", "b"], n),
            "confidence": rng.random(n),
        }
    )
    return spark.createDataFrame(frame).withColumn("ts", F.col("ts").cast("timestamp"))


def _reference(quantiles):
    base = drift.reference_from_counts({"a": 1, "b": 1}, ["a", "b"])
    return drift.extended(base, quantiles=quantiles, n_confidences=len(quantiles))


def test_monitor_stream_survives_a_restart(spark, tmp_path):
    """Three arrivals in separate runs over one checkpoint equal one batch run."""
    log = _log(spark, 300)
    reference = _reference([0.2, 0.5, 0.8])
    place = {k: str(tmp_path / k) for k in ("arrivals", "output", "state", "checkpoint")}
    for start in range(0, 300, 100):
        part = log.where(F.col("event_id").between(start, start + 99))
        part.coalesce(1).write.mode("append").parquet(place["arrivals"])
        arriving = spark.readStream.schema(log.schema).parquet(place["arrivals"])
        stream = {k: place[k] for k in ("output", "state", "checkpoint")}
        jobs.run_to_end(lambda s=stream: jobs.monitor_stream(arriving, reference, rows=30, **s))
    read = lambda df: sorted(
        (r["event_id"], round(r["psi_class"], 9), round(r["ks_confidence"], 9)) for r in df.collect()
    )
    assert read(spark.read.parquet(place["output"])) == read(rolling_monitor(log, reference, rows=30))


def test_event_time_monitor_ignores_the_order_of_arrival(spark, tmp_path):
    """Rows up to 50 minutes late, one run each over one checkpoint, equal the monitor over the ordered log."""
    log = _log(spark, 300).withColumn("label", F.when(F.col("event_id") % 41 != 7, F.col("label")))
    reference = _reference([0.2, 0.5, 0.8])
    place = {k: str(tmp_path / k) for k in ("arrivals", "output", "checkpoint")}
    turn = ((F.col("event_id") + F.pmod(F.hash("event_id"), F.lit(50))) / 70).cast("int")
    beat = log.where("event_id = 299").selectExpr(
        "'clock' AS model_name", "ts + INTERVAL 1 DAY AS ts", "-1L AS event_id", "CAST(NULL AS STRING) AS label", "0D AS confidence"
    )
    parts = [log.where(turn == t) for t in range(5)] + [beat]
    for part in parts:
        part.coalesce(1).write.mode("append").parquet(place["arrivals"])
        arriving = spark.readStream.schema(log.schema).parquet(place["arrivals"])
        shown = keyed.event_time_monitor(arriving, reference, delay="1 hour", rows=30)
        jobs.run_to_end(lambda s=shown: jobs.append_stream(s, place["output"], place["checkpoint"]))
    read = lambda df: sorted(
        (r["event_id"], r["ts"], round(r["psi_class"], 9), round(r["ks_confidence"], 9)) for r in df.collect()
    )
    want = read(rolling_monitor(log.where("label IS NOT NULL"), reference, rows=30))
    assert read(spark.read.parquet(place["output"])) == want and len(want) > 200


def test_state_of_the_event_time_monitor_is_packed():
    """Two binary values whatever the rows, not a boxed value per row and column; what is stored comes back."""
    n = 50_000
    rows = pd.DataFrame(
        {"us": np.arange(n) * 1000, "tie": np.arange(n), "label": ["click", "view"] * (n // 2), "confidence": np.arange(n) / n}
    )
    assert keyed._STATE == "wait binary, ring binary"
    stored = keyed._packed(rows), keyed._packed(rows.iloc[:0])
    assert len(stored[0]) < 20 * n
    waiting, ring = keyed._loaded(tuple(map(bytearray, stored)))
    assert waiting.equals(rows) and len(ring) == 0
    assert all(part.dtypes.equals(rows.dtypes) for part in (ring, *keyed._loaded(None)))


def test_last_rows(spark):
    got = jobs.last_rows(_log(spark, 200), "model_name", ["ts", "event_id"], 7).toPandas()
    want = _log(spark, 200).toPandas().sort_values("event_id").groupby("model_name").tail(7)
    assert sorted(got["event_id"]) == sorted(want["event_id"])


def test_windowed_counts_batch(spark):
    reference = _reference([0.4, 0.6])
    log = _log(spark, 200)
    table = jobs.score_windows(jobs.windowed_counts(log, reference, window="1 hour"), reference)
    direct = drift.score_predictions(log.withColumn("h", F.date_trunc("hour", "ts")), reference, ["h"])
    key = lambda df: sorted((round(r["psi_class"], 12), round(r["ks_confidence"], 12)) for r in df.collect())
    assert key(table) == key(direct)
