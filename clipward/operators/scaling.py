"""Standardisation of wide feature tables and of matrices kept as flat arrays."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clipward.functions.columns import matrix_rows
from clipward.functions.wide import aggregate_columns


def as_float32(column: str) -> Column:
    """Training precision: the stored double goes through float32."""
    return F.col(column).cast("float").cast("double")


def fit_scaler(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """(position, feature, mean, scale): population deviation, and 1 where it is zero."""
    table = aggregate_columns(
        df,
        features,
        {"mean": F.avg, "deviation": F.stddev_pop},
        lambda c: c.cast("float").cast("double"),
    )
    scale = F.when(F.col("deviation") > 0, F.col("deviation")).otherwise(1.0)
    return table.select("position", "feature", "mean", scale.alias("scale"))


def scaler_row(scaler: DataFrame) -> DataFrame:
    """The scaler as one row of two arrays in feature order (one entry per column)."""
    ordered = F.array_sort(F.collect_list(F.struct("position", "mean", "scale")))
    return scaler.agg(ordered.alias("s")).select(
        F.col("s.mean").alias("means"), F.col("s.scale").alias("scales")
    )


def scale_matrix(df: DataFrame, scaler: DataFrame, column: str = "features") -> DataFrame:
    """Standardise a float32 array column; the scaler joins as a single row."""
    joined = df.crossJoin(F.broadcast(scaler_row(scaler)))
    centred = F.zip_with(column, "means", lambda x, m: x.cast("double") - m)
    scaled = F.zip_with(centred, "scales", lambda x, s: (x / s).cast("float"))
    return joined.withColumn(column, scaled).drop("means", "scales")


def apply_scaler(df: DataFrame, scaler: DataFrame, features: Sequence[str]) -> DataFrame:
    """Standardised float32 feature columns."""
    row = F.broadcast(scaler_row(scaler))
    scaled = {
        name: (
            (as_float32(name) - F.element_at("means", i + 1)) / F.element_at("scales", i + 1)
        ).cast("float")
        for i, name in enumerate(features)
    }
    return df.crossJoin(row).withColumns(scaled).select(*df.columns)


def feature_matrix(df: DataFrame, features: Sequence[str], name: str = "features") -> DataFrame:
    """The selected features as one float32 array."""
    return df.withColumn(name, F.array(*[F.col(c).cast("float") for c in features]))


def unflatten(df: DataFrame, flat: str = "mel", name: str = "rows") -> DataFrame:
    return df.withColumn(name, matrix_rows(F.col(flat), F.col("mel_height"), F.col("mel_width")))


def fit_mel_stats(
    df: DataFrame, flat: str = "mel", floor: float = 1e-8, shift: float = -40.0
) -> DataFrame:
    """One row (mean, std) over every cell of every matrix, in one scan.

    Each row is reduced to (n, mean, squared deviations) before the shuffle. The spread of
    the row means is summed around ``shift``, a value near the expected mean (decibels lie
    in -80..0), so that the subtraction at the end loses no digits.
    """
    n = F.size(flat).cast("double")
    total = F.aggregate(F.col(flat), F.lit(0.0), lambda acc, v: acc + v.cast("double"))
    squares = F.aggregate(
        F.col(flat),
        F.lit(0.0),
        lambda acc, v: acc + F.pow(v.cast("double") - F.col("m"), F.lit(2.0)),
    )
    parts = (
        df.where(F.size(flat) > 0)
        .select(flat, n.alias("n"), (total / n).alias("m"))
        .select("n", (F.col("m") - shift).alias("offset"), squares.alias("within"))
    )
    sums = parts.agg(
        F.sum("n").alias("cells"),
        F.sum(F.col("n") * F.col("offset")).alias("first"),
        F.sum(F.col("n") * F.col("offset") * F.col("offset")).alias("second"),
        F.sum("within").alias("within"),
    )
    empty = F.raise_error(F.lit("cannot fit matrix statistics on an empty table")).cast("double")
    center = F.col("first") / F.col("cells")
    variance = (F.col("within") + F.col("second")) / F.col("cells") - center * center
    return sums.select(
        F.coalesce(center + shift, empty).alias("mean"),
        F.greatest(F.sqrt(F.greatest(variance, F.lit(0.0))), F.lit(floor)).alias("std"),
    )


def normalize_mels(df: DataFrame, stats: DataFrame, flat: str = "mel") -> DataFrame:
    one_row = F.broadcast(stats.select(F.col("mean").alias("__m"), F.col("std").alias("__s")))
    return (
        df.crossJoin(one_row)
        .withColumn(
            flat,
            F.transform(
                F.col(flat), lambda v: ((v.cast("double") - F.col("__m")) / F.col("__s")).cast("float")
            ),
        )
        .drop("__m", "__s")
    )
