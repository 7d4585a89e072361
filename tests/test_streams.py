"""Text, vectors and matrices: routes, scoring of uploads, filters."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from clipward.operators import drift, matrices
from clipward.sources import prediction_log
from clipward.streaming import jobs, late_rows, log_routes, vector_scoring

LINES = {
    '{"label": "a", "confidence": 0.5}': "kept",
    '{"label": "a", "status": "ok", "confidence": null}': "kept",
    '{"label": "a", "status": null}': "not_ok",
    '{"label": "a", "status": "http_400"}': "not_ok",
    '{"label": null, "status": "ok"}': "no_label",
    '{"event": "start", "label": "a"}': "other_event",
    '{"event": "prediction", "label": "b", "extra": [1]}': "kept",
    "[1]": "not_object",
    "7": "not_object",
    "   ": "blank",
    "": "blank",
    '{"label": "a"': "malformed",
    "oops": "malformed",
}


def test_routes(spark):
    lines = spark.createDataFrame([(t, "x") for t in LINES] + [(None, "x")], "value string, route string")
    got = log_routes.routed(lines).collect()
    assert {r["value"]: r["route"] for r in got} == {**LINES, None: "blank"}
    assert all((r["confidence"] is not None) == (r["route"] == "kept") for r in got)
    kept = sorted((r["label"], r["confidence"]) for r in got if r["route"] == "kept")
    plain = prediction_log.parse_log(lines.select("value"), strict=False).select("label", "confidence").collect()
    assert kept == sorted(tuple(r) for r in plain) == [("a", 0.0), ("a", 0.5), ("b", 0.0)]
    assert log_routes.routed(lines.limit(0)).count() == 0


def test_routed_stream_over_two_runs(spark, tmp_path):
    place = {k: str(tmp_path / k) for k in ("lines", "output", "counts", "checkpoint")}
    for _ in range(2):
        spark.createDataFrame([(t,) for t in LINES], "value string").coalesce(1).write.mode("append").text(place["lines"])
        lines = log_routes.read_lines(spark, place["lines"])
        args = [place[k] for k in ("output", "counts", "checkpoint")]
        jobs.run_to_end(lambda s=lines, a=args: log_routes.route_stream(s, *a))
    stored = spark.read.parquet(place["output"])
    by_route = {r["route"]: r["count"] for r in stored.groupBy("route").count().collect()}
    want = {r: 2 * sum(x == r for x in LINES.values()) for r in log_routes.ROUTES}
    assert by_route == want
    seen = spark.read.parquet(place["counts"])
    assert seen.agg(*[F.sum(r).alias(r) for r in log_routes.ROUTES]).first().asDict() == want and seen.count() == 2
    aside = stored.where("route = 'malformed'").select("value", "file").distinct().collect()
    assert {r["value"] for r in aside} == {'{"label": "a"', "oops"}
    assert all(r["file"].endswith(".txt") for r in aside) and len(aside) == 4


@pytest.fixture(scope="module")
def scorer(spark):
    rng = np.random.default_rng(1)
    rows = [(c, (rng.normal(size=3) + 5 * c).tolist()) for c in range(2) for _ in range(40)]
    train = spark.createDataFrame(rows, "class_id int, features array<double>")
    return rows, vector_scoring.fit_scorer(train, 0.25, 1e-3)


def test_scorer_equals_the_formula(spark, scorer):
    rows, model = scorer
    found = {m["class_id"]: m for m in model.first()["model"]}
    x = {c: np.array([v for k, v in rows if k == c]) for c in range(2)}
    within = sum(((x[c] - x[c].mean(0)) ** 2).sum(0) for c in x) / 80
    for c in x:
        np.testing.assert_allclose(found[c]["means"], x[c].mean(0))
        np.testing.assert_allclose(found[c]["variances"], 0.75 * x[c].var(0) + 0.25 * within + 1e-3)


def test_upload_statuses(spark, scorer):
    nan = float("nan")
    uploads = spark.createDataFrame(
        [(1, [0.0, 0.1, 0.0], "x"), (2, [5.0, 5.0, 5.0], "x"), (3, None, "x"), (4, [1.0], "x"), (5, [], "x"),
         (6, [1.0, None, 1.0], "x"), (7, [1.0, nan, 1.0], "x"), (None, [5.0, 5.1, 5.0], None)],
        "upload_id long, embedding array<double>, status string",
    )
    score = lambda m, df=uploads: vector_scoring.score_vectors(df, m, ["a", "b"], size=3, model_name="g")
    got = {r["upload_id"]: r for r in score(scorer[1]).collect()}
    assert {k: (r["status"], r["label"]) for k, r in got.items()} == {
        1: ("ok", "a"), 2: ("ok", "b"), 3: ("http_400", None), 4: ("http_400", None), 5: ("http_400", None),
        6: ("error", None), 7: ("error", None), None: ("ok", "b"),
    }
    assert abs(sum(got[1]["probabilities"].values()) - 1) < 1e-12 and got[3]["probabilities"] is None
    bare = {r["status"] for r in score(scorer[1].limit(0)).collect()}
    assert bare == {"http_503", "http_400", "error"}
    assert score(scorer[1], uploads.limit(0)).count() == 0
    assert "Python" not in score(scorer[1])._jdf.queryExecution().executedPlan().toString()


def test_uploads_sent_or_run_twice_are_logged_once(spark, scorer, tmp_path):
    place = {k: str(tmp_path / k) for k in ("arrivals", "output", "checkpoint")}
    rows = spark.range(60).selectExpr(
        "id AS upload_id", "timestamp_seconds(1704067200 + id * 60) AS ts", "array(0D, 0D, CAST(id AS DOUBLE)) AS embedding"
    )
    for first in (0, 20, 40):
        # Each run sends ten uploads of the run before again, and its own twice.
        part = rows.where(F.col("upload_id").between(first - 10, first + 19))
        part.unionByName(part).coalesce(1).write.mode("append").parquet(place["arrivals"])
        arriving = spark.readStream.schema(rows.schema).parquet(place["arrivals"])
        jobs.run_to_end(
            lambda s=arriving: vector_scoring.once_only_log(
                s, scorer[1], ["a", "b"], output=place["output"], checkpoint=place["checkpoint"],
                delay="30 minutes", size=3, model_name="g",
            )
        )
    ids = sorted(r["upload_id"] for r in spark.read.parquet(place["output"]).collect())
    assert ids == list(range(60))
    # A batch whose commit was lost is run again and replaces its own output.
    last = max((tmp_path / "checkpoint" / "commits").glob("[0-9]*"), key=lambda p: int(p.name))
    for p in (last, last.with_name(f".{last.name}.crc")):
        p.unlink(missing_ok=True)
    jobs.run_to_end(
        lambda: vector_scoring.once_only_log(
            spark.readStream.schema(rows.schema).parquet(place["arrivals"]), scorer[1], ["a", "b"],
            output=place["output"], checkpoint=place["checkpoint"], delay="30 minutes", size=3, model_name="g",
        )
    )
    assert sorted(r["upload_id"] for r in spark.read.parquet(place["output"]).collect()) == ids


@pytest.mark.parametrize("height, width", [(8, 8), (5, 7), (3, 3)])
def test_filters_equal_plain_loops(spark, height, width):
    rng = np.random.default_rng(height)
    x = rng.normal(size=(height, width))
    df = spark.createDataFrame([(1, x.ravel().tolist()), (2, None)], "id int, m array<double>")
    got = {r["id"]: r["features"] for r in matrices.filter_features(df, "m", height, width).collect()}
    want = []
    for weights in matrices.FILTERS.values():
        k = np.array(weights).reshape(3, 3)
        out = np.array([[max(0.0, (x[r : r + 3, c : c + 3] * k).sum()) for c in range(width - 2)] for r in range(height - 2)])
        want += [out[2 * r : 2 * r + 2, 2 * c : 2 * c + 2].max() for r in range((height - 2) // 2) for c in range((width - 2) // 2)]
    assert got[2] is None and len(want) == matrices.feature_count(height, width)
    np.testing.assert_allclose(got[1], want, atol=1e-12)


def test_wrong_matrix_length(spark):
    df = spark.createDataFrame([([1.0],)], "m array<double>")
    with pytest.raises(Exception, match="64 values was expected, not 1"):
        matrices.filter_features(df, "m", 8, 8).collect()


def test_windows_and_late_rows_are_all_rows(spark, tmp_path):
    base = drift.reference_from_counts({"a": 1, "b": 1}, ["a", "b"])
    reference = drift.extended(base, quantiles=[0.2, 0.8], n_confidences=2)
    place = {k: str(tmp_path / k) for k in ("output", "late", "marks", "checkpoint")}
    # Minutes of each run; the window is ten minutes, the delay fifteen.
    runs = [[0, 5, 41], [26, 19, 20, 31, None], [100, 29], [84, 79, 80]]
    # 41 - 15 = 26, so the window up to 20 is closed; 29 ends at 30 and counts; 100 - 15 = 85 closes the one up to 80.
    late = [set(), {19, None}, set(), {79}]
    for i, minutes in enumerate(runs):
        rows = [(m, "ab"[j % 2], 0.5) for j, m in enumerate(minutes)] + [(1, None, 0.5)]
        part = spark.createDataFrame(rows, "minute int, label string, confidence double").withColumn(
            "ts", F.timestamp_seconds(F.lit(1704067200) + F.col("minute") * 60)
        )
        part.coalesce(1).write.mode("append").parquet(str(tmp_path / "arrivals"))
        arriving = spark.readStream.schema(part.schema).parquet(str(tmp_path / "arrivals"))
        jobs.run_to_end(
            lambda s=arriving: late_rows.count_with_late_rows(
                s, reference, window="10 minutes", delay="15 minutes", **place
            )
        )
        got = spark.read.parquet(f"{place['late']}/turn={i}").collect()
        assert {r["minute"] for r in got} == late[i]
    counts = late_rows.stored_counts(spark, place["output"])
    total = counts.where("kind = 'labels'").agg(F.sum("n")).first()[0]
    assert total + spark.read.parquet(place["late"]).count() == sum(len(m) for m in runs)
    assert late_rows.stored_counts(spark, place["output"]).where("kind = 'cells'").agg(F.sum("n")).first()[0] == total
