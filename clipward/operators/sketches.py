"""Mergeable summaries: quantiles and distinct counts that are stored per period and merged later.

A period is scanned once. Any reference span or any set of folds is then answered from the
stored sketches, whose size depends on the accuracy asked for and not on the rows. Nulls are not counted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KLL_K = 200
KLL_RANK_ERROR = 0.0133 * 2  # of one rank at k = 200 with 99 % confidence, doubled for many ranks
HLL_LG = 12
HLL_ERROR = 3 * 1.04 / 2 ** (HLL_LG / 2)
THETA_LG = 12


def quantile_sketches(df: DataFrame, value: str, *period: str, k: int = KLL_K) -> DataFrame:
    """(period..., n, sketch): one row per period; ``value`` is a number."""
    known = df.where(F.col(value).isNotNull() & ~F.isnan(F.col(value).cast("double")))
    return known.groupBy(*period).agg(
        F.count(F.lit(1)).alias("n"),
        F.kll_sketch_agg_double(F.col(value).cast("double"), F.lit(k)).alias("sketch"),
    )


def merged_quantiles(sketches: DataFrame, n_quantiles: int, *by: str) -> DataFrame:
    """(by..., n, values): ``n_quantiles`` + 1 evenly spaced quantiles of all merged periods."""
    ranks = F.array(*(F.lit(i / n_quantiles) for i in range(n_quantiles + 1)))
    merged = sketches.groupBy(*by).agg(
        F.sum("n").alias("n"), F.kll_merge_agg_double("sketch").alias("sketch")
    )
    return merged.select(*by, "n", F.kll_sketch_get_quantile_double("sketch", ranks).alias("values"))


def rank_errors(df: DataFrame, value: str, quantiles: DataFrame) -> DataFrame:
    """(q_index, value, low, high): share of rows under and up to each value of one row of ``values``.

    One scan: a row counts into the interval between neighbouring values that it lies in.
    """
    side = F.broadcast(quantiles.select("values"))
    x = F.col(value).cast("double")
    cells = (
        df.where(x.isNotNull() & ~F.isnan(x))
        .crossJoin(side)
        .select(
            F.size(F.filter("values", lambda v: v < x)).alias("under"),
            F.size(F.filter("values", lambda v: v <= x)).alias("upto"),
        )
        .groupBy("under", "upto")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    # A row is up to value i when no more than i values are under it, and under it when no more than i are up to it.
    points = quantiles.select(F.posexplode("values").alias("q_index", "value"))
    return (
        points.join(F.broadcast(cells.groupBy().agg(F.collect_list(F.struct("under", "upto", "n")).alias("cells"))))
        .withColumn("total", _summed(F.col("cells"), lambda c: F.lit(True)))
        .select(
            "q_index",
            "value",
            (_summed(F.col("cells"), lambda c: c["upto"] <= F.col("q_index")) / F.col("total")).alias("low"),
            (_summed(F.col("cells"), lambda c: c["under"] <= F.col("q_index")) / F.col("total")).alias("high"),
        )
    )


def _summed(cells: Column, chosen) -> Column:
    counts = F.transform(F.filter(cells, chosen), lambda c: c["n"])
    return F.aggregate(counts, F.lit(0).cast("long"), lambda total, n: total + n)


def distinct_sketches(df: DataFrame, value: str, *period: str) -> DataFrame:
    """(period..., hll, theta): distinct values of ``value``, for unions and for overlaps."""
    return df.groupBy(*period).agg(
        F.hll_sketch_agg(value, HLL_LG).alias("hll"), F.theta_sketch_agg(value, THETA_LG).alias("theta")
    )


def merged_distinct(sketches: DataFrame, *by: str) -> DataFrame:
    """(by..., n_distinct), estimated; 99.7 % of estimates are within ``HLL_ERROR``."""
    return sketches.groupBy(*by).agg(F.hll_sketch_estimate(F.hll_union_agg("hll")).alias("n_distinct"))


def overlap(sketches: DataFrame, *by: str) -> DataFrame:
    """(by..., n_shared): values that all periods of a group hold; exact up to 2 ** ``THETA_LG`` distinct values."""
    return sketches.groupBy(*by).agg(
        F.theta_sketch_estimate(F.theta_intersection_agg("theta")).alias("n_shared")
    )
