"""Structured Streaming jobs: rolling drift monitor, windowed drift, clip scoring."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from clipward import constants as K
from clipward import schemas as S
from clipward.functions import columns as C
from clipward.operators import clip_jobs, drift, modeling
from clipward.operators.monitor import rolling_monitor
from clipward.sources.tables import read_if_present

DEFAULT_DELAY = "10 minutes"


def monitor_stream(
    predictions: DataFrame,
    reference: drift.Reference,
    *,
    output: str,
    state: str,
    checkpoint: str,
    key: str = "model_name",
    order: Sequence[str] = ("ts", "event_id"),
    rows: int = K.MONITOR_WINDOW,
) -> StreamingQuery:
    """A snapshot for every arriving prediction over the last ``rows`` of its key.

    Predictions are taken in arrival order: by micro-batch, and by ``order`` within one.
    Each micro-batch runs the batch monitor on its rows and on the last ``rows - 1``
    stored rows of every key, so a busy key is spread over tasks as in batch mode. Output
    and tail are written per batch id and replaced when a batch is run again, so a restart
    after a lost executor or driver repeats a batch without duplicates.
    """
    columns = [key, *order, "label", "confidence"]

    def step(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        fresh = batch.select(*columns).withColumn("__turn", F.lit(int(batch_id)).cast("long"))
        fresh = fresh.persist(StorageLevel.MEMORY_AND_DISK)  # snapshots and tail read it
        before = read_if_present(session, f"{state}/turn={batch_id - 1}", fresh.schema)
        seen = fresh if before is None else fresh.unionByName(before)
        snapshots = rolling_monitor(seen, reference, key=key, order=["__turn", *order], rows=rows)
        new = snapshots.where(F.col("__turn") == batch_id).drop("__turn")
        new.write.mode("overwrite").parquet(f"{output}/turn={batch_id}")
        last_rows(seen, key, ["__turn", *order], rows - 1).write.mode("overwrite").parquet(
            f"{state}/turn={batch_id}"
        )
        fresh.unpersist()

    return (
        predictions.writeStream.foreachBatch(step)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def last_rows(df: DataFrame, key: str, order: Sequence[str], n: int) -> DataFrame:
    """The last ``n`` rows of every key, whatever the weight of a key.

    Rows are dealt to lanes by hash; each lane keeps its own last n, and only those few
    are ranked together.
    """
    latest = [F.col(c).desc() for c in order]
    lane = F.pmod(F.xxhash64(*order), F.lit(64))
    dealt = df.withColumn("__lane", lane)
    in_lane = Window.partitionBy(key, "__lane").orderBy(*latest)
    kept = dealt.withColumn("__n", F.row_number().over(in_lane)).where(F.col("__n") <= n)
    overall = Window.partitionBy(key).orderBy(*latest)
    return (
        kept.withColumn("__n", F.row_number().over(overall))
        .where(F.col("__n") <= n)
        .drop("__n", "__lane")
    )


def windowed_counts(
    predictions: DataFrame,
    reference: drift.Reference,
    *,
    window: str,
    delay: str = DEFAULT_DELAY,
    ts: str = "ts",
) -> DataFrame:
    """(window_start, kind, code, n): class and confidence-cell counts per tumbling window.

    The same expression serves streams and batches. In a stream, rows later than the
    watermark are dropped by the engine and counted in its progress metrics.
    """
    codes = F.array(
        *[
            F.struct(F.lit(kind).alias("kind"), code.cast("int").alias("code"))
            for kind, code in drift.prediction_codes(reference).items()
        ]
    )
    late = predictions.withWatermark(ts, delay) if predictions.isStreaming else predictions
    return (
        late.where(F.col("label").isNotNull())
        .select(ts, F.explode(codes).alias("x"))
        .groupBy(F.window(ts, window).alias("w"), "x.kind", "x.code")
        .agg(F.count(F.lit(1)).alias("n"))
        .select(F.col("w.start").alias("window_start"), "kind", "code", "n")
    )


def open_windows(counts: DataFrame, closed: DataFrame) -> DataFrame:
    """Rows of a batch of windowed counts whose window a stream has not emitted.

    An append-mode stream keeps the windows that the watermark has not passed; this completes
    its output once no more rows are expected. ``closed`` adds one row per emitted window.
    """
    return counts.join(closed.select("window_start").distinct(), "window_start", "left_anti")


def score_windows(counts: DataFrame, reference: drift.Reference) -> DataFrame:
    """(window_start, psi_class, ks_confidence, n_observations, n_unknown_labels) per window.

    The measures are those of ``drift.score_predictions``.
    """
    entry = lambda kind: F.map_from_entries(
        F.collect_list(F.when(F.col("kind") == kind, F.struct("code", "n")))
    )
    kinds = list(drift.prediction_codes(reference))
    per_window = counts.groupBy("window_start").agg(
        *[entry(kind).alias(kind) for kind in kinds],
        F.sum(F.when(F.col("kind") == "labels", F.col("n"))).alias("n_rows"),
    )
    return per_window.select("window_start", *drift.scores_of_counts(reference))


def append_stream(df: DataFrame, output: str, checkpoint: str) -> StreamingQuery:
    """Append a stream to a Parquet table, processing what is available and then stopping."""
    return (
        df.writeStream.format("parquet")
        .option("path", output)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )


def score_uploads(
    uploads: DataFrame, fitted: modeling.Fitted | None, *, max_bytes: int = K.MAX_UPLOAD_BYTES
) -> DataFrame:
    """Uploads (filename, content_type, wav, ...) to prediction-log rows; batch or stream.

    The upload rules decide first; only uploads that pass them are decoded and scored.
    Uploads are peak-normalised like training clips, so both see the same scale.
    """
    status = C.upload_status(
        F.col("filename"),
        F.col("content_type"),
        F.octet_length("wav"),
        model_ready=F.lit(fitted is not None),
        max_bytes=max_bytes,
    )
    kept = [c for c in uploads.columns if c != "wav"]
    checked = uploads.withColumn("rule", status)
    # Refused uploads are not sent to the decoder.
    decoded = checked.withColumn("wav", F.when(F.col("rule") == "ok", F.col("wav")))
    features = clip_jobs.extract_features(decoded, peak_normalize=True, keep=[*kept, "rule"])
    failed = F.col("reject_reason").isNotNull() & (F.col("rule") == "ok")
    rows = features.select(
        *kept,
        F.when(failed, "error").otherwise(F.col("rule")).alias("status"),
        F.array(
            *[F.coalesce(F.col(n), F.lit(0.0)).cast("float") for n in S.feature_names()]
        ).alias("features"),
    )
    if fitted is None:
        empty = {"label": "string", "confidence": "double", "model_name": "string"}
        return rows.drop("features").withColumns(
            {n: F.lit(None).cast(t) for n, t in empty.items()}
        )
    scored = modeling.prediction_rows(fitted.score(rows), fitted)
    ok = F.col("status") == "ok"
    return scored.select(
        *kept,
        "status",
        F.when(ok, F.col("label")).alias("label"),
        F.when(ok, F.col("confidence")).alias("confidence"),
        "model_name",
        F.when(ok, F.col("probabilities")).alias("probabilities"),
    )


def run_to_end(start: Callable[[], StreamingQuery]) -> None:
    """Start a query with an available-now trigger and wait until it has finished."""
    query = start()
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()
