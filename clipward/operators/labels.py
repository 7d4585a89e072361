"""Label dimensions, class weights and the lookups that use them.

Dimension tables have one row per class. They are joined without hints: Spark broadcasts
them while their measured size allows it and shuffles them otherwise.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clipward.session import stable


def class_counts(df: DataFrame, label: str = "class") -> DataFrame:
    if label not in df.columns:
        raise ValueError(f"missing label column '{label}'")
    return df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))


def label_map(df: DataFrame, label: str = "class") -> DataFrame:
    """(class, class_id): sorted distinct labels numbered from zero; null is not a label.

    The window runs over distinct labels only, one row per class.
    """
    classes = df.select(F.col(label).cast("string").alias(label)).distinct().dropna()
    return classes.select(
        label, (F.row_number().over(Window.orderBy(label)) - 1).cast("int").alias("class_id")
    )


def stored_label_map(df: DataFrame, label: str = "class") -> DataFrame:
    """The label map as a written table, for jobs that look it up several times."""
    return stable(label_map(df, label), "labels")


def encode_labels(
    df: DataFrame, mapping: DataFrame, label: str = "class", *, strict: bool = True
) -> DataFrame:
    """Adds ``class_id``. An unseen label is an error, or null when not strict."""
    joined = df.join(mapping, label, "left")
    if not strict:
        return joined
    unseen = F.raise_error(F.concat(F.lit("unseen label: "), F.coalesce(F.col(label).cast("string"), F.lit("null")))).cast("int")
    return joined.withColumn("class_id", F.coalesce(F.col("class_id"), unseen))


def class_weights(df: DataFrame, mapping: DataFrame, label: str = "class") -> DataFrame:
    """(class, class_id, weight): sum(c) / (K * c) with every count raised to at least one.

    Classes without rows take part, and the sum is taken after raising.
    """
    counts = mapping.join(class_counts(df, label), label, "left").withColumn(
        "c", F.greatest(F.coalesce("n", F.lit(0)), F.lit(1)).cast("double")
    )
    totals = counts.agg(F.sum("c").alias("total"), F.count(F.lit(1)).alias("k"))
    # `totals` is a global aggregate, so it is one row.
    return counts.crossJoin(F.broadcast(totals)).select(
        label, "class_id", (F.col("total") / (F.col("k") * F.col("c"))).alias("weight")
    )


def with_sample_weights(encoded: DataFrame, weights: DataFrame) -> DataFrame:
    """Adds ``weight``; a row whose class id is null or has no weight is an error."""
    joined = encoded.join(weights.select("class_id", "weight"), "class_id", "left")
    return joined.withColumn("weight", F.coalesce("weight", _no_class("class_id").cast("double")))


def _no_class(column: str) -> Column:
    shown = F.coalesce(F.col(column).cast("string"), F.lit("null"))
    return F.raise_error(F.concat(F.lit("no class for id: "), shown))


def decode_ids(
    df: DataFrame, mapping: DataFrame, id_column: str, size: str, name: str = "class"
) -> DataFrame:
    """Class id to label, for ids inside the probability vector of the row.

    An id without a class is an error, a null id has a null label.
    """
    known = mapping.select(F.col("class_id").alias(id_column), F.col(name))
    inside = df.where((F.col(id_column) < F.col(size)) | F.col(id_column).isNull())
    label = F.when(F.col(id_column).isNull(), F.lit(None)).otherwise(
        F.coalesce(name, _no_class(id_column).cast("string"))
    )
    return inside.join(known, id_column, "left").withColumn(name, label)


def match_expected(predictions: DataFrame, expected: DataFrame, key: str) -> DataFrame:
    """Predictions beside the expected label of the same key, with a ``matched`` flag."""
    return predictions.join(expected, key).withColumn(
        "matched", F.col("label") == F.col("expected")
    )


def pairing_states(
    left: DataFrame, right: DataFrame, key: str, left_name: str, right_name: str
) -> DataFrame:
    """(key, state) over both tables: paired, or present on one side only.

    One grouping of the keys instead of a join, so repeated keys never multiply.
    """
    sides = left.select(key, F.lit(1).alias("l"), F.lit(0).alias("r")).unionByName(
        right.select(key, F.lit(0).alias("l"), F.lit(1).alias("r"))
    )
    state = (
        F.when(F.max("l") == 0, f"{right_name}_only")
        .when(F.max("r") == 0, f"{left_name}_only")
        .otherwise("paired")
    )
    return sides.groupBy(key).agg(state.alias("state"))
