"""Operational series of a prediction service, computed from its log.

Every series starts from panes: one aggregate per small time slice (and key). Trailing
windows are then combined from panes, so a row is read once however many windows it is in.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clipward import constants as K
from clipward.functions.columns import bucket_index


def totals(log: DataFrame) -> DataFrame:
    """One row: requests, errors, latency count and sum, predictions, confidence sum.

    Any status other than ok is an error; both kinds observe a latency.
    """
    ok = F.col("status") == "ok"
    return log.agg(
        F.count(F.lit(1)).alias("requests"),
        F.count_if(~ok).alias("errors"),
        F.count("latency_s").alias("latency_count"),
        F.sum("latency_s").alias("latency_sum"),
        F.count_if(ok).alias("predictions"),
        F.sum(F.when(ok, F.col("confidence"))).alias("confidence_sum"),
    )


def panes(log: DataFrame, slide: str, keys: Sequence[str] = ()) -> DataFrame:
    """(pane, keys, requests, errors, predictions, confidence_sum) per slice of ``slide``."""
    ok = F.col("status") == "ok"
    return (
        log.groupBy(F.window("ts", slide).alias("w"), *keys)
        .agg(
            F.count(F.lit(1)).alias("requests"),
            F.count_if(~ok).alias("errors"),
            F.count_if(ok).alias("predictions"),
            F.sum(F.when(ok, F.col("confidence"))).alias("confidence_sum"),
        )
        .withColumn("pane", F.col("w.start"))
        .drop("w")
    )


def trailing(
    paned: DataFrame, slide_seconds: int, window_seconds: int, keys: Sequence[str] = ()
) -> DataFrame:
    """Sums of the panes in every trailing window that holds at least one of them.

    A window is named by its end. A pane belongs to window_seconds / slide_seconds windows.
    """
    if window_seconds % slide_seconds:
        raise ValueError("the window must be a multiple of the slide")
    ends = F.transform(
        F.sequence(F.lit(1), F.lit(window_seconds // slide_seconds)),
        lambda i: F.col("pane") + F.make_dt_interval(secs=i * slide_seconds),
    )
    sums = [c for c in paned.columns if c != "pane" and c not in keys]
    return (
        paned.withColumn("window_end", F.explode(ends))
        .groupBy("window_end", *keys)
        .agg(*[F.sum(c).alias(c) for c in sums])
    )


def rates(windows: DataFrame, window_seconds: int) -> DataFrame:
    return windows.select(
        "window_end",
        (F.col("requests") / float(window_seconds)).alias("request_rate"),
        (F.col("errors") / float(window_seconds)).alias("error_rate"),
        F.col("requests").alias("request_increase"),
        F.col("errors").alias("error_increase"),
    )


def error_ratio(windows: DataFrame, window_seconds: int) -> DataFrame:
    per_second = lambda c: F.col(c) / float(window_seconds)
    ratio = per_second("errors") / F.greatest(per_second("requests"), F.lit(K.RATE_FLOOR))
    return windows.select("window_end", ratio.alias("error_ratio"))


def mean_confidence(windows: DataFrame, window_seconds: int) -> DataFrame:
    total = F.coalesce("confidence_sum", F.lit(0.0)) / float(window_seconds)
    count = F.col("predictions") / float(window_seconds)
    return windows.select(
        "window_end", (total / F.greatest(count, F.lit(K.RATE_FLOOR))).alias("mean_confidence")
    )


def bucket_histogram(
    log: DataFrame, value: str, bounds: Sequence[float], keys: Sequence[str | Column] = ()
) -> DataFrame:
    """(keys, le, cumulative) for every bound and +Inf; ``le`` is text.

    Rows are counted per bucket first. The cumulative form is built from that handful of
    counts per key, buckets without rows included.
    """
    counted = (
        log.where(F.col(value).isNotNull())
        .groupBy(*keys, bucket_index(F.col(value), bounds).alias("bucket"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    names = [c for c in counted.columns if c not in ("bucket", "n")]
    by_bucket = F.map_from_entries(F.collect_list(F.struct("bucket", "n")))
    labels = F.lit([f"{b:g}" for b in bounds] + ["+Inf"])
    size = len(bounds) + 1
    upto = lambda i: F.aggregate(
        F.sequence(F.lit(0), i),
        F.lit(0).cast("long"),
        lambda acc, j: acc + F.coalesce(F.try_element_at("m", j), F.lit(0)),
    )
    cumulative = F.transform(
        F.sequence(F.lit(0), F.lit(size - 1)),
        lambda i: F.struct(
            i.alias("bucket"), F.element_at(labels, i + 1).alias("le"), upto(i).alias("cumulative")
        ),
    )
    return (
        counted.groupBy(*names)
        .agg(by_bucket.alias("m"))
        .select(*names, F.inline(cumulative))
    )


def bucket_quantiles(
    histogram: DataFrame,
    bounds: Sequence[float],
    quantiles: Sequence[float],
    keys: Sequence[str] = (),
) -> DataFrame:
    """(keys, quantile, value) estimated from cumulative buckets.

    Linear inside the bucket that holds the rank; the first bucket starts at zero, and a
    rank in the +Inf bucket gives the largest finite bound.
    """
    rows = histogram.groupBy(*keys).agg(
        # len(bounds) + 1 entries per key.
        F.transform(
            F.array_sort(F.collect_list(F.struct("bucket", "cumulative"))), lambda x: x["cumulative"]
        ).alias("c")
    )
    finite = F.lit([float(b) for b in bounds])
    ranked = rows.withColumn("quantile", F.explode(F.lit(list(quantiles)))).withColumn(
        "rank", F.col("quantile") * F.element_at("c", -1)
    )
    # One-based position of the first bucket whose cumulative count reaches the rank.
    position = F.size(F.filter("c", lambda n: n < F.col("rank"))) + 1
    placed = ranked.withColumn("b", F.least(position, F.lit(len(bounds) + 1)))
    low = F.when(F.col("b") > 1, F.try_element_at(finite, F.greatest(F.col("b") - 1, F.lit(1)))).otherwise(0.0)
    below = F.when(F.col("b") > 1, F.element_at("c", F.greatest(F.col("b") - 1, F.lit(1)))).otherwise(0)
    inside = F.element_at("c", F.col("b")) - below
    width = F.try_element_at(finite, F.col("b")) - low
    value = F.when(F.col("b") > len(bounds), F.lit(float(bounds[-1]))).otherwise(
        low + width * (F.col("rank") - below) / inside
    )
    return placed.select(*keys, "quantile", value.alias("value"))


def class_totals(log: DataFrame, slide: str) -> DataFrame:
    """(pane, label, predictions, running_total) of successful predictions per class."""
    per_pane = (
        log.where((F.col("status") == "ok") & F.col("label").isNotNull())
        .groupBy(F.window("ts", slide)["start"].alias("pane"), "label")
        .agg(F.count(F.lit(1)).alias("predictions"))
    )
    # One row per class and pane: the number of panes bounds each group.
    so_far = Window.partitionBy("label").orderBy("pane").rowsBetween(Window.unboundedPreceding, 0)
    return per_pane.withColumn("running_total", F.sum("predictions").over(so_far))


def demo_summary(rows: DataFrame) -> DataFrame:
    """(n_ok, n_match, mean_latency_ms) of scored files; the mean is 0 without successes."""
    ok = F.col("status") == "ok"
    return rows.agg(
        F.count_if(ok).alias("n_ok"),
        F.count_if(ok & (F.col("label") == F.col("expected"))).alias("n_match"),
        F.coalesce(F.avg(F.when(ok, F.col("latency_ms"))), F.lit(0.0)).alias("mean_latency_ms"),
    )
