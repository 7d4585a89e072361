"""Contracts, splits, labels, weights, scaling, selection and incremental work."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from clipward.functions import columns as C
from clipward.operators import evaluation, labels, quality, scaling, splits
from clipward.session import scratch_path
from clipward.sources import incremental


@pytest.fixture(scope="module")
def contract(spark):
    return spark.createDataFrame(
        [(1, "a"), (2, "b"), (10, "a"), (3, "b")], "fold long, class string"
    )


def test_contract_accepts_and_names_the_first_failure(contract):
    check = lambda df=contract, **kw: quality.check_contract(
        df, **{"expected_rows": 4, "expected_classes": 2, **kw}
    )
    assert check() == {"num_rows": 4, "num_classes": 2}
    with pytest.raises(quality.ContractError, match="row_count"):
        check(expected_rows=3, expected_classes=9)
    with pytest.raises(quality.ContractError, match="fold_max"):
        check(fold_range=(1, 9))
    with pytest.raises(quality.ContractError, match="class_count"):
        check(expected_classes=4)
    with pytest.raises(quality.ContractError, match="fold"):
        check(contract.drop("fold"))


def test_missing_feature_columns_lists_five(contract):
    with pytest.raises(ValueError) as error:
        quality.require_columns(contract, ["fold", *"pqrstuv"])
    assert "'t'" in str(error.value) and "'u'" not in str(error.value)


@pytest.fixture(scope="module")
def clips(spark):
    rows = [(f, c, a) for f, c in ((1, "x"), (9, "y"), (10, "x")) for a in (False, True)]
    return spark.createDataFrame(rows, "fold int, class string, is_augmented boolean")


def test_fold_split_drops_copies_of_the_eval_fold(clips):
    train, held_out = splits.fold_split(clips)
    assert train.count() == 4 and held_out.collect() == [(10, "x", False)]
    with pytest.raises(ValueError):
        splits.fold_split(clips.drop("fold"))


def test_roles_equal_the_four_filters(clips):
    for role, part in splits.four_way(clips).items():
        rows = splits.with_roles(clips).where(F.col("role") == role).drop("role")
        assert sorted(rows.collect()) == sorted(part.collect())


def test_rotation_never_tests_on_copies(clips):
    rotated = splits.rotate_folds(clips)
    assert rotated.where("role = 'test' AND is_augmented").count() == 0
    assert rotated.where("role = 'train' AND fold = test_fold").count() == 0
    with pytest.raises(ValueError):
        splits.rotate_folds(clips, 1)


def test_unseen_label(clips):
    mapping = labels.label_map(clips.where("class = 'x'"))
    assert labels.encode_labels(clips, mapping, strict=False).where("class_id IS NULL").count() == 2
    with pytest.raises(Exception, match="unseen label: y"):
        labels.encode_labels(clips, mapping).collect()


def test_class_weights_count_absent_classes_as_one(spark, clips):
    mapping = spark.createDataFrame([("x", 0), ("y", 1), ("z", 2)], "class string, class_id int")
    got = {r["class"]: r["weight"] for r in labels.class_weights(clips, mapping).collect()}
    assert got == pytest.approx({"x": 7 / 12, "y": 7 / 6, "z": 7 / 3})


def test_scaler_uses_population_deviation_and_keeps_constants(spark):
    df = spark.createDataFrame([(1.0, 5.0), (3.0, 5.0)], "a double, b double")
    scaled = scaling.apply_scaler(df, scaling.fit_scaler(df, ["a", "b"]), ["a", "b"])
    assert sorted(map(tuple, scaled.collect())) == [(-1.0, 0.0), (1.0, 0.0)]


@pytest.mark.parametrize("width", [3, 20])
def test_wide_scaler(spark, width):
    x = np.random.default_rng(0).normal(size=(30, width))
    names = [f"c{i}" for i in range(width)]
    df = spark.createDataFrame(x.tolist(), names)
    rows = scaling.fit_scaler(df, names).orderBy("position").collect()
    f32 = x.astype(np.float32).astype(float)
    assert [r["feature"] for r in rows] == names
    assert np.allclose([r["mean"] for r in rows], f32.mean(0))
    assert np.allclose([r["scale"] for r in rows], f32.std(0))


def test_mel_statistics(spark):
    mels = np.random.default_rng(1).normal(-40, 10, (7, 12)).astype(np.float32)
    df = spark.createDataFrame([(m.tolist(),) for m in mels], "mel array<float>")
    row = scaling.fit_mel_stats(df).first()
    assert row["mean"] == pytest.approx(mels.astype(float).mean())
    assert row["std"] == pytest.approx(mels.astype(float).std())
    with pytest.raises(Exception, match="empty table"):
        scaling.fit_mel_stats(df.where("false")).collect()


def test_metrics_on_a_small_example(spark):
    truth, pred = [0, 1, 2, 0, 1, 2], [0, 1, 1, 0, 2, 2]
    rows = [(t, p, [1.0 if c == p else 0.0 for c in range(3)]) for t, p in zip(truth, pred, strict=True)]
    df = spark.createDataFrame(rows, "y_true int, pred int, proba array<double>")
    got = evaluation.classification_metrics(evaluation.confusion_counts(df)).first()
    assert got["accuracy"] == pytest.approx(4 / 6)
    assert got["f1_macro"] == pytest.approx((1 + 0.5 + 0.5) / 3)
    assert evaluation.roc_auc_ovr(df, 3).first()[0] == pytest.approx((1 + 0.625 + 0.625) / 3)
    undefined = evaluation.roc_auc_ovr(df.where("y_true < 2"), 3).first()[0]
    assert np.isnan(undefined)


def test_auc_against_all_pairs(spark):
    rng = np.random.default_rng(4)
    y, p = rng.integers(0, 2, 80), rng.random(80).round(1)
    rows = [(int(t), [1 - float(s), float(s)]) for t, s in zip(y, p, strict=True)]
    df = spark.createDataFrame(rows, "y_true int, proba array<double>")
    got = {r["class_id"]: r["auc"] for r in evaluation.roc_auc_per_class(df, 2).collect()}
    wins = (p[y == 1][:, None] > p[y == 0]) + 0.5 * (p[y == 1][:, None] == p[y == 0])
    assert got[1] == pytest.approx(wins.mean(), abs=1e-12)


def test_fold_aggregate(spark):
    df = spark.createDataFrame(
        [(1, 0.5, 0.6, float("nan")), (2, 0.7, 0.8, float("nan"))],
        "fold int, f1_macro double, accuracy double, roc_auc_ovr double",
    )
    got = {r["metric"]: (r["mean"], r["std"]) for r in evaluation.fold_aggregate(df).collect()}
    assert got["f1_macro"] == pytest.approx((0.6, 0.1)) and got["accuracy"] == pytest.approx((0.7, 0.1))
    assert "roc_auc_ovr" not in got
    with pytest.raises(Exception, match="no fold metrics"):
        evaluation.fold_aggregate(df.where("false")).collect()


def _results(spark, *rows):
    data = [(i, n, f"r{i}", m, "d") for i, (n, m) in enumerate(rows)]
    return spark.createDataFrame(
        data, "position int, model_name string, run_id string, metrics map<string,double>, dataset string"
    )


def test_winner_prefers_cv_and_the_earlier_of_equals(spark):
    table = _results(spark, ("rf", {"f1_macro": 0.4}), ("b", {"f1_macro": 0.2, "cv_f1_macro_mean": 0.7}), ("c", {"f1_macro": 0.7}))
    row = evaluation.select_winner(table).first()
    assert (row["model_name"], row["cv_f1_macro_mean"]) == ("b", 0.7)
    assert evaluation.leaderboard(table).where("winner").first()["model_name"] == "b"
    with pytest.raises(Exception, match="no training results"):
        evaluation.select_winner(table.where("false")).collect()


def test_upload_rules(spark):
    rows = [
        ("a.wav", "audio/wav", 10, "ok"),
        ("a.WAV", None, 10, "ok"),
        ("a.bin", "audio/x-wav; q=1", 10, "ok"),
        ("a.txt", "text/plain", 10, "http_400"),
        ("a.wav", "audio/wav", 0, "http_400"),
        ("a.wav", "audio/wav", 9 << 20, "http_413"),
        (None, None, 5, "http_400"),
    ]
    df = spark.createDataFrame(rows, "f string, c string, n long, want string")
    got = df.select(C.upload_status(F.col("f"), F.col("c"), F.col("n")).alias("got"), "want").collect()
    assert all(r["got"] == r["want"] for r in got)


def test_file_names(spark):
    df = spark.createDataFrame([("x/a.b.wav",), (".hidden",), ("plain",)], "p string")
    got = df.select(C.file_stem(F.col("p")), C.file_suffix(F.col("p"))).collect()
    assert [tuple(r) for r in got] == [("a.b", ".wav"), (".hidden", ""), ("plain", "")]


def test_incremental_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    first = spark.createDataFrame([(1, "a"), (2, "b")], "fold int, path string")
    incremental.write_new_partitions(first, path)
    todo = incremental.pending(first.union(spark.createDataFrame([(2, "c")], first.schema)), first, ["path"])
    assert [r["path"] for r in todo.collect()] == ["c"]
    incremental.write_new_partitions(todo, path)
    assert sorted(r["path"] for r in spark.read.parquet(path).collect()) == ["a", "c"]
    assert incremental.pending(first, first, ["path"], force=True).count() == 2


def test_scratch_is_below_the_shared_folder(spark):
    assert scratch_path(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))
