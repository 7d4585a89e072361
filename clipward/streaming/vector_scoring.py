"""Scoring of arriving feature vectors into a prediction log that holds every upload once."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from clipward.functions.columns import is_finite
from clipward.operators import gaussian
from clipward.operators.evaluation import top_class
from clipward.session import stable
from clipward.streaming.jobs import DEFAULT_DELAY


def fit_scorer(train: DataFrame, shrink: float, smoothing: float, column: str = "features") -> DataFrame:
    """One row ``model``: class ids with means and variances of all given rows; one scan, stored.

    ``train`` has ``class_id`` and the vector ``column``. Its size is classes x features, never the table's.
    """
    rows = train.withColumn("fold", F.lit(1))
    sums = stable(gaussian.statistics(gaussian.usable(rows, column), column), "statistics")
    # A fold without rows is left out of nothing, so its rotation model is that of all rows.
    nothing = [F.lit(0).cast(kind).alias(c) for c, kind in (("n", "long"), ("s", "double"), ("q", "double"))]
    none = sums.select(F.lit(0).alias("fold"), "class_id", "i", *nothing)
    models = gaussian.rotation_models(sums.unionByName(none), {"scorer": (shrink, smoothing)})
    return stable(models.where("test_fold = 0").select("model"), "scorer")


def score_vectors(
    uploads: DataFrame,
    model: DataFrame,
    classes: Sequence[str],
    *,
    size: int,
    model_name: str,
    column: str = "embedding",
) -> DataFrame:
    """Uploads (other columns, vector) to log rows: status, label, confidence, model_name, probabilities.

    A missing vector or one of another length is "http_400", a null or non-finite element "error", and without a
    model every sound vector is "http_503"; such rows have no label. Column expressions only, so a
    stream and a batch run the same plan. ``model`` is the one-row table of ``fit_scorer``.
    """
    kept = [c for c in uploads.columns if c not in (column, "status", "label", "confidence", "model_name", "probabilities")]
    right = F.coalesce(F.size(column) == size, F.lit(False))
    clean = F.coalesce(F.forall(column, lambda x: F.coalesce(is_finite(x.cast("double")), F.lit(False))), F.lit(False))
    # A global aggregate is one row, also over a model that was never fitted.
    one = model.agg(F.first("model").alias("model"))
    checked = uploads.crossJoin(F.broadcast(one)).withColumn(
        "status",
        F.when(~right, "http_400").when(~clean, "error").when(F.col("model").isNull(), "http_503").otherwise("ok"),
    )
    ok = F.col("status") == "ok"
    shown = checked.withColumn(column, F.when(ok, F.col(column)))
    scored = top_class(gaussian.with_shares(shown, column, len(classes)))
    names = F.lit(list(classes))
    return scored.select(
        *kept,
        "status",
        F.when(ok, F.element_at(names, F.col("pred") + 1)).alias("label"),
        F.when(ok, F.col("confidence")).alias("confidence"),
        F.lit(model_name).alias("model_name"),
        F.when(ok, F.map_from_arrays(names, "proba")).alias("probabilities"),
    )


def once_only_log(
    uploads: DataFrame,
    model: DataFrame,
    classes: Sequence[str],
    *,
    output: str,
    checkpoint: str,
    upload_id: str = "upload_id",
    ts: str = "ts",
    delay: str = DEFAULT_DELAY,
    **options: Mapping[str, object],
) -> StreamingQuery:
    """Score a stream of uploads into ``output``: one log row per upload id, whatever is sent or run twice.

    Uploads sent again within ``delay`` are dropped before scoring, keyed by the id and held only until the watermark
    passes, so the state does not grow with the table. A micro-batch is written under its id and replaced when it is run
    again, so a lost driver between write and commit gives no second row. Uploads later than the watermark are
    dropped by the engine. A null id is an id of its own.
    """
    fresh = uploads.withWatermark(ts, delay).dropDuplicatesWithinWatermark([upload_id])

    def step(batch: DataFrame, batch_id: int) -> None:
        score_vectors(batch, model, classes, **options).write.mode("overwrite").parquet(f"{output}/turn={batch_id}")

    return (
        fresh.writeStream.foreachBatch(step)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
