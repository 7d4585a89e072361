"""Service series from the prediction log."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clipward import constants as K
from clipward.operators import service
from clipward.plans import sql_views as Q
from clipward.plans import views as V
from clipward.plans.registry import r6, register, rounded
from clipward.plans.sql_views import query

HOUR, DAY = 3600, 86400

_WINDOWS = """
panes AS (
  SELECT date_trunc('hour', ts) AS pane, count(*) AS requests,
         count(*) FILTER (WHERE status <> 'ok') AS errors,
         count(*) FILTER (WHERE status = 'ok') AS predictions, sum(confidence) AS confidence_sum
  FROM pred GROUP BY pane),
w AS (
  SELECT pane + to_hours(i) AS window_end, sum(requests) AS requests, sum(errors) AS errors,
         sum(predictions) AS predictions, sum(confidence_sum) AS confidence_sum
  FROM panes, (SELECT unnest(range(1, {hours} + 1)) AS i) GROUP BY window_end)"""
_END = "strftime(window_end, '%Y-%m-%d %H:%M') AS window_end"


def _ended(df: DataFrame) -> DataFrame:
    return df.withColumn("window_end", F.date_format("window_end", "yyyy-MM-dd HH:mm"))


def _trailing(spark: SparkSession, sf_dir: str, seconds: int) -> DataFrame:
    paned = service.panes(V.pred(spark, sf_dir), "1 hour")
    return service.trailing(paned, HOUR, seconds)


@register(
    "t1_request_totals",
    query(
        Q.PRED,
        f"""SELECT count(*) AS requests, count(*) FILTER (WHERE status <> 'ok') AS errors,
             count(latency_s) AS latency_count, {Q.r6("sum(latency_s)")} AS latency_sum,
             count(*) FILTER (WHERE status = 'ok') AS predictions,
             {Q.r6("sum(confidence)")} AS confidence_sum FROM pred""",
    ),
)
def request_totals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(service.totals(V.pred(spark, sf_dir)), "latency_sum", "confidence_sum")


@register(
    "t2_rates_and_increases",
    query(
        Q.PRED, _WINDOWS.format(hours=24),
        f"""SELECT {_END}, {Q.r6("requests / 86400.0")} AS request_rate,
             {Q.r6("errors / 86400.0")} AS error_rate, CAST(requests AS BIGINT) AS request_increase,
             CAST(errors AS BIGINT) AS error_increase FROM w""",
    ),
)
def rates_and_increases(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = service.rates(_trailing(spark, sf_dir, DAY), DAY)
    return rounded(_ended(table), "request_rate", "error_rate")


@register(
    "t3_error_ratio",
    query(
        Q.PRED, _WINDOWS.format(hours=5),
        f"""SELECT {_END}, {Q.r6("(errors / 18000.0) / greatest(requests / 18000.0, 1e-9)")} AS error_ratio
        FROM w""",
    ),
)
def error_ratio(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = service.error_ratio(_trailing(spark, sf_dir, 5 * HOUR), 5 * HOUR)
    return rounded(_ended(table), "error_ratio")


@register(
    "t7_mean_confidence",
    query(
        Q.PRED, _WINDOWS.format(hours=5),
        f"""SELECT {_END}, {Q.r6("(coalesce(confidence_sum, 0) / 18000.0) / greatest(predictions / 18000.0, 1e-9)")}
             AS mean_confidence FROM w""",
    ),
)
def mean_confidence(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = service.mean_confidence(_trailing(spark, sf_dir, 5 * HOUR), 5 * HOUR)
    return rounded(_ended(table), "mean_confidence")


def _buckets(bounds) -> str:
    finite = ", ".join(f"({i}, '{b:g}', {b})" for i, b in enumerate(bounds))
    return f"(VALUES {finite}, ({len(bounds)}, '+Inf', CAST('Infinity' AS DOUBLE))) AS b(bucket, le, bound)"


@register(
    "t4_bucket_histograms",
    query(
        Q.PRED,
        f"""SELECT 'latency' AS metric, bucket, le, count(*) FILTER (WHERE latency_s <= bound) AS cumulative
        FROM pred, {_buckets(K.LATENCY_BUCKETS)} GROUP BY bucket, le
        UNION ALL
        SELECT 'confidence', bucket, le, count(*) FILTER (WHERE confidence <= bound)
        FROM pred, {_buckets(K.CONFIDENCE_BUCKETS)} GROUP BY bucket, le""",
    ),
)
def bucket_histograms(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = V.pred(spark, sf_dir)
    named = lambda df, name: df.select(F.lit(name).alias("metric"), *df.columns)
    latency = service.bucket_histogram(log, "latency_s", K.LATENCY_BUCKETS)
    confidence = service.bucket_histogram(log, "confidence", K.CONFIDENCE_BUCKETS)
    return named(latency, "latency").unionByName(named(confidence, "confidence"))


@register(
    "t6_latency_quantiles",
    query(
        Q.PRED,
        f"""cum AS (
          SELECT date_trunc('day', ts) AS day, bucket, bound,
                 count(*) FILTER (WHERE latency_s <= bound) AS c
          FROM pred, {_buckets(K.LATENCY_BUCKETS)} GROUP BY ALL),
        lagged AS (SELECT *, coalesce(lag(c) OVER w, 0) AS below, coalesce(lag(bound) OVER w, 0) AS low,
                          max(c) OVER (PARTITION BY day) AS total
                   FROM cum WINDOW w AS (PARTITION BY day ORDER BY bucket)),
        picked AS (SELECT * FROM lagged, (VALUES (0.5), (0.95), (0.99)) AS q(quantile)
                   WHERE c >= quantile * total
                   QUALIFY row_number() OVER (PARTITION BY day, quantile ORDER BY bucket) = 1)""",
        f"""SELECT strftime(day, '%Y-%m-%d') AS day, CAST(quantile AS DOUBLE) AS quantile,
             {Q.r6("CASE WHEN isinf(bound) THEN 10.0 ELSE low + (bound - low) * (quantile * total - below) / (c - below) END")}
               AS value FROM picked""",
    ),
)
def latency_quantiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    log = V.pred(spark, sf_dir).withColumn("day", F.date_format("ts", "yyyy-MM-dd"))
    histogram = service.bucket_histogram(log, "latency_s", K.LATENCY_BUCKETS, ["day"])
    table = service.bucket_quantiles(histogram, K.LATENCY_BUCKETS, [0.5, 0.95, 0.99], ["day"])
    return rounded(table, "value")


@register(
    "t8_predictions_by_class",
    query(
        Q.PRED,
        """p AS (SELECT date_trunc('hour', ts) AS pane, label, count(*) AS predictions
               FROM pred_ok GROUP BY ALL)""",
        f"""SELECT strftime(pane, '%Y-%m-%d %H:%M') AS pane, label, predictions,
             CAST(sum(predictions) OVER (PARTITION BY label ORDER BY p.pane) AS BIGINT) AS running_total,
             {Q.r6("predictions / 3600.0")} AS rate FROM p""",
    ),
)
def predictions_by_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = service.class_totals(V.pred(spark, sf_dir), "1 hour")
    return table.withColumns(
        {
            "rate": r6(F.col("predictions") / float(HOUR)),
            "pane": F.date_format("pane", "yyyy-MM-dd HH:mm"),
        }
    )


@register(
    "a13_demo_summary",
    query(
        Q.PRED,
        f"""SELECT count(*) FILTER (WHERE status = 'ok') AS n_ok,
             count(*) FILTER (WHERE status = 'ok' AND label = CASE k % 2 WHEN 0 THEN 'view' ELSE 'click' END)
               AS n_match,
             {Q.r6("coalesce(avg(CASE WHEN status = 'ok' THEN latency_s * 1000 END), 0)")} AS mean_latency_ms
        FROM pred""",
    ),
)
def demo_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = V.pred(spark, sf_dir).select(
        "status",
        "label",
        F.when(F.col("k") % 2 == 0, "view").otherwise("click").alias("expected"),
        (F.col("latency_s") * 1000).alias("latency_ms"),
    )
    return rounded(service.demo_summary(rows), "mean_latency_ms")
