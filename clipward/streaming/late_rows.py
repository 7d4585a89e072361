"""Windowed counts of a stream together with the rows that came too late for their window."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from clipward.operators import drift
from clipward.sources.tables import read_if_present
from clipward.streaming.jobs import DEFAULT_DELAY, windowed_counts

_MARK = "newest timestamp"


def count_with_late_rows(
    predictions: DataFrame,
    reference: drift.Reference,
    *,
    output: str,
    late: str,
    marks: str,
    checkpoint: str,
    window: str,
    delay: str = DEFAULT_DELAY,
    ts: str = "ts",
) -> StreamingQuery:
    """Partial counts per window in ``output``, late rows in ``late``; every row with a label is in one of them.

    A row is late when its window ends at or before the newest time of earlier micro-batches less ``delay``, the
    engine's own rule in append mode, where such rows are only a number in the progress metrics. Here they are stored
    whole with ``window_start``, ``window_end`` and ``limit``, the time they missed. The newest time is one value per
    micro-batch in ``marks``. All three are written under the batch id and replaced when a batch is run again. A
    micro-batch adds at most windows x codes rows of counts, combined before the shuffle.

    Cases: rows without a label take no part; a row without ``ts`` belongs to no window and is stored as late with
    nulls; the first micro-batch has no late rows but those; an empty micro-batch keeps the mark.
    """

    def step(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        rows = batch.where(F.col("label").isNotNull()).persist(StorageLevel.MEMORY_AND_DISK)
        before = read_if_present(session, f"{marks}/turn={batch_id - 1}", session.createDataFrame([], _MARK).schema)
        seen = before.first()["newest"] if before is not None else None
        limit = F.lit(seen).cast("timestamp") - F.expr(f"INTERVAL {delay}")
        timed = rows.withColumn("__w", F.window(ts, window)).select(
            *rows.columns,
            F.col("__w.start").alias("window_start"),
            F.col("__w.end").alias("window_end"),
            limit.alias("limit"),
        )
        is_late = F.coalesce(F.col("window_end") <= F.col("limit"), F.lit(False))
        # A window expression leaves out rows without a time.
        timeless = rows.where(F.col(ts).isNull()).withColumns(
            {n: F.lit(None).cast("timestamp") for n in ("window_start", "window_end", "limit")}
        )
        timed.where(is_late).unionByName(timeless).write.mode("overwrite").parquet(f"{late}/turn={batch_id}")
        counts = windowed_counts(timed.where(~is_late).select(*rows.columns), reference, window=window, ts=ts)
        counts.write.mode("overwrite").parquet(f"{output}/turn={batch_id}")
        newest = F.greatest(F.max(F.col(ts).cast("timestamp")), F.lit(seen).cast("timestamp"))
        rows.agg(newest.alias("newest")).write.mode("overwrite").parquet(f"{marks}/turn={batch_id}")
        rows.unpersist()

    return (
        predictions.writeStream.foreachBatch(step)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def stored_counts(spark: SparkSession, output: str) -> DataFrame:
    """(window_start, kind, code, n) over all micro-batches, as ``jobs.score_windows`` takes them."""
    parts = spark.read.parquet(output)
    return parts.groupBy("window_start", "kind", "code").agg(F.sum("n").alias("n"))
