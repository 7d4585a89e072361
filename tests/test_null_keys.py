"""Null groups, missing confidences, unknown labels, and windows a stream leaves open."""

from __future__ import annotations

import datetime as dt
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from clipward.operators import drift, evaluation, labels, modeling, monitor
from clipward.operators.drift import Reference
from clipward.operators.ordering import exact_quantiles, number_rows, running_totals
from clipward.sources import prediction_log, reference_store
from clipward.streaming import jobs

PLAIN = Reference({"a": 3, "b": 1}, {"a": 0.6, "b": 0.3, "z": 0.1}, ("a", "b"))
FULL = drift.extended(PLAIN, quantiles=[0.0, 0.25, 0.5, 0.75, 1.0], n_confidences=5)


def log(spark, n=300, days=3):
    draw = random.Random(1)
    start = dt.datetime(2024, 1, 30)
    rows = [
        (
            [None, "m1", "m2"][draw.randrange(3)],
            start + dt.timedelta(seconds=i * 86400 * days // n),
            i,
            draw.choice(["a", "b", "a", "other"]),
            draw.random() if i % 7 else None,
        )
        for i in range(n)
    ]
    schema = "model_name string, ts timestamp, event_id long, label string, confidence double"
    return rows, spark.createDataFrame(rows, schema).repartition(5)


def test_null_groups_are_numbered_and_summed(spark):
    rows, df = log(spark)
    got = number_rows(df, ["ts", "event_id"], ["model_name"]).collect()
    for name in {r[0] for r in rows}:
        mine = sorted((r.ts, r.row_no) for r in got if r.model_name == name)
        assert [n for _, n in mine] == list(range(1, len(mine) + 1))
    counted = df.groupBy("model_name", F.col("event_id").alias("v")).agg(F.count(F.lit(1)).alias("n"))
    summed = running_totals(counted, ["v"], ["n"], ["model_name"]).collect()
    assert {r.model_name for r in summed} == {None, "m1", "m2"}
    assert all(r.total_n == sum(x[0] == r.model_name for x in rows) for r in summed)


def test_null_group_has_quantiles_and_a_distance(spark):
    rows, df = log(spark)
    got = exact_quantiles(df, "confidence", 3, ["model_name"]).where("model_name IS NULL").toPandas()
    values = [r[4] for r in rows if r[0] is None and r[4] is not None]
    assert np.allclose(got.sort_values("q_index")["value"], np.quantile(values, [0, 0.5, 1]))
    half = F.col("event_id") < 150
    ks = drift.ks_two_sample(df.where(half), df.where(~half), "confidence", ["model_name"])
    assert {r.model_name for r in ks.collect()} == {None, "m1", "m2"}


def test_quantile_plan_joins_on_values_only(spark):
    _, df = log(spark)
    plan = exact_quantiles(df, "confidence", 3)._jdf.queryExecution().optimizedPlan().toString()
    joins = [line for line in plan.splitlines() if "Join" in line]
    assert len(joins) == 1 and "__part" in joins[0]


def test_fold_metrics_keep_a_null_fold(spark):
    rows = [(None if i % 2 else 1, i % 2, i % 2, [0.3, 0.7]) for i in range(8)]
    rows += [(None, 0, 1, [0.6, 0.4]), (1, 1, 0, [0.5, 0.5])]
    scored = spark.createDataFrame(rows, "fold int, y_true int, pred int, proba array<double>")
    assert {r.fold for r in evaluation.fold_metrics(scored, 2).collect()} == {None, 1}


@pytest.mark.parametrize("reference", [PLAIN, FULL])
def test_rolling_monitor_takes_a_null_model(spark, reference):
    rows, df = log(spark)
    got = monitor.rolling_monitor(df, reference, rows=10).collect()
    for name in {r[0] for r in rows}:
        mine = [r for r in got if r.model_name == name]
        assert len(mine) == sum(r[0] == name for r in rows) - 9
        assert all((r.ks_confidence is None) == (reference is PLAIN) for r in mine)


def test_trailing_frame_takes_a_null_key(spark):
    rows, df = log(spark)
    sums = {"total": lambda w: F.sum("event_id").over(w)}
    got = monitor.trailing_frame(
        df.select("model_name", "ts", "event_id"), key="model_name", order=["ts"], rows=3, aggregates=sums
    ).toPandas()
    frame = pd.DataFrame(rows, columns=["model_name", "ts", "event_id", "l", "c"])
    mine = frame[frame.model_name.isna()].event_id.rolling(3, min_periods=1).sum()
    part = got[got.model_name.isna()].sort_values("ts")
    assert part.total.tolist() == mine.tolist()


@pytest.mark.parametrize("reference", [PLAIN, FULL])
def test_windows_score_like_batches(spark, reference):
    _, df = log(spark)
    counts = jobs.windowed_counts(df, reference, window="1 day")
    got = {r.window_start: r for r in jobs.score_windows(counts, reference).collect()}
    day = F.date_trunc("day", "ts")
    batch = drift.score_predictions(df.withColumn("day", day), reference, ["day"]).collect()
    assert len(batch) == len(got) == 3
    for row in batch:
        other = got[row.day]
        assert np.isclose(row.psi_class, other.psi_class)
        assert row.n_unknown_labels == other.n_unknown_labels > 0
        assert row.n_observations == other.n_observations
        if reference is PLAIN:
            assert row.ks_confidence is None and other.ks_confidence is None
        else:
            assert np.isclose(row.ks_confidence, other.ks_confidence)


def test_open_windows_complete_a_stream(spark, tmp_path):
    """The log spans the 31st and two months."""
    _, df = log(spark)
    df.write.parquet(str(tmp_path / "in"))
    arriving = spark.readStream.schema(df.schema).parquet(str(tmp_path / "in"))
    counts = jobs.windowed_counts(arriving, FULL, window="1 day")
    out = str(tmp_path / "out")
    jobs.run_to_end(lambda: jobs.append_stream(counts, out, str(tmp_path / "cp")))
    schema = "window_start timestamp, kind string, code int, n long"
    closed = spark.read.schema(schema).parquet(out)
    every = jobs.windowed_counts(df, FULL, window="1 day")
    whole = closed.unionByName(jobs.open_windows(every, closed))
    assert sorted(map(tuple, whole.collect())) == sorted(map(tuple, every.collect()))
    assert whole.select("window_start").distinct().count() == 3


def test_labels_are_strict_about_nulls(spark):
    df = spark.createDataFrame([("b",), (None,), ("a",)], "class string")
    mapping = labels.label_map(df)
    assert {tuple(r) for r in mapping.collect()} == {("a", 0), ("b", 1)}
    with pytest.raises(Exception, match="unseen label: null"):
        labels.encode_labels(df, mapping).collect()
    weights = labels.class_weights(df.dropna(), mapping)
    odd = spark.createDataFrame([(0,), (None,)], "class_id int")
    with pytest.raises(Exception, match="no class for id: null"):
        labels.with_sample_weights(odd, weights).collect()


def test_balancing_keeps_every_row(spark):
    rows = [(f"p{i}", 0.2 if i % 5 else 1.0) for i in range(1000)]
    got = modeling.balanced(spark.createDataFrame(rows, "path string, weight double")).toPandas()
    times = got.groupby("path").size()
    assert len(times) == 1000 and set(times[[f"p{i}" for i in range(1000) if i % 5]]) == {1}
    assert set(times[[f"p{i}" for i in range(0, 1000, 5)]]) <= {5, 6}


def test_log_times_round_trip(spark):
    moment = dt.datetime(2024, 1, 31, 23, 59, 59, 123000)
    df = spark.createDataFrame([(moment,)], "t timestamp").select(prediction_log.iso_time(F.col("t")).alias("ts"))
    assert df.first().ts == "2024-01-31T23:59:59.123Z"
    assert prediction_log.with_time(df).first()["at"] == moment
    odd = spark.createDataFrame([("soon",)], "ts string")
    assert prediction_log.with_time(odd).first()["at"] is None


def test_reference_metadata(spark):
    board = spark.createDataFrame(
        [("a", "r1", 0.2, False), ("b", "r2", 0.4, True)],
        "model_name string, run_id string, score double, winner boolean",
    )
    meta = reference_store.winner_meta(board)
    built = reference_store.build_reference([], meta=meta).meta
    assert built["winner_model_name"] == "b" and built["winner_run_id"] == "r2"
    assert dt.datetime.fromisoformat(built["built_at"])
