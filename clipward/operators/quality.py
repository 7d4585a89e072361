"""Contract checks, quarantine routing, manifests and lineage rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clipward import constants as K
from clipward.operators.splits import original

CONTRACT_RULES = ("row_count", "fold_min", "fold_max", "class_count")


class ContractError(ValueError):
    """A table breaks the dataset contract."""


def table_statistics(
    df: DataFrame, fold: str = "fold", label: str = "class", *, approximate: bool = False
) -> DataFrame:
    """One row: rows, fold_min, fold_max, classes.

    Labels are counted per class first, so that the distinct count is a second, tiny
    aggregate; ``approximate`` is for label columns of unbounded cardinality.
    """
    if approximate:
        return df.agg(
            F.count(F.lit(1)).alias("num_rows"),
            F.min(fold).alias("fold_min"),
            F.max(fold).alias("fold_max"),
            F.approx_count_distinct(label).alias("num_classes"),
        )
    per_class = df.groupBy(label).agg(
        F.count(F.lit(1)).alias("n"), F.min(fold).alias("lo"), F.max(fold).alias("hi")
    )
    return per_class.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("num_rows"),
        F.min("lo").alias("fold_min"),
        F.max("hi").alias("fold_max"),
        F.count(label).alias("num_classes"),
    )


def contract_report(
    df: DataFrame,
    *,
    expected_rows: int = K.EXPECTED_ROWS,
    expected_classes: int = K.EXPECTED_CLASSES,
    fold_range: tuple[int, int] = (K.FOLD_MIN, K.FOLD_MAX),
    fold: str = "fold",
    label: str = "class",
) -> DataFrame:
    """(position, rule, observed, expected, ok), in the order the rules are checked."""
    for column in (fold, label):
        if column not in df.columns:
            raise ContractError(f"missing expected column '{column}', present: {df.columns}")
    low, high = fold_range
    stats = table_statistics(df, fold, label)

    def rule(position: int, observed: str, expected: int, ok: Column) -> Column:
        return F.struct(
            F.lit(position).alias("position"),
            F.lit(CONTRACT_RULES[position - 1]).alias("rule"),
            F.col(observed).cast("long").alias("observed"),
            F.lit(expected).cast("long").alias("expected"),
            F.coalesce(ok, F.lit(False)).alias("ok"),
        )

    rules = F.array(
        rule(1, "num_rows", expected_rows, F.col("num_rows") == expected_rows),
        rule(2, "fold_min", low, F.col("fold_min") >= low),
        rule(3, "fold_max", high, F.col("fold_max") <= high),
        rule(4, "num_classes", expected_classes, F.col("num_classes") == expected_classes),
    )
    return stats.select(F.inline(rules))


def check_contract(df: DataFrame, **expectations) -> dict[str, int]:
    """Raise on the first broken rule; otherwise return the row and class counts."""
    rules = contract_report(df, **expectations).orderBy("position").collect()  # four rows
    for row in rules:
        if not row["ok"]:
            raise ContractError(
                f"{row['rule']}: expected {row['expected']}, observed {row['observed']}"
            )
    seen = {row["rule"]: row["observed"] for row in rules}
    return {"num_rows": seen["row_count"], "num_classes": seen["class_count"]}


def require_columns(df: DataFrame, names: Sequence[str]) -> list[str]:
    """The given names, all present; an error lists the first five that are not."""
    present = set(df.columns)
    missing = [name for name in names if name not in present]
    if missing:
        raise ValueError(f"missing feature columns: {missing[:5]}")
    return list(names)


def available_columns(df: DataFrame, names: Sequence[str]) -> list[str]:
    present = set(df.columns)
    return [name for name in names if name in present]


def good_rows(processed: DataFrame) -> DataFrame:
    return processed.where(F.col("reject_reason").isNull()).drop("reject_reason")


def quarantine(processed: DataFrame) -> DataFrame:
    return processed.where(F.col("reject_reason").isNotNull())


def reject_counts(processed: DataFrame, *, fail_if_all: bool = True) -> DataFrame:
    """(reason, n) with ``ok`` for accepted rows; an error if nothing was accepted."""
    counts = processed.groupBy(
        F.coalesce("reject_reason", F.lit("ok")).alias("reason")
    ).agg(F.count(F.lit(1)).alias("n"))
    if not fail_if_all:
        return counts
    accepted = counts.agg(
        F.coalesce(F.sum(F.when(F.col("reason") == "ok", F.col("n"))), F.lit(0)).alias("accepted")
    )
    failure = F.raise_error(F.lit("every clip was rejected")).cast("long")
    return (
        counts.crossJoin(F.broadcast(accepted))  # one row
        .withColumn("n", F.when(F.col("accepted") > 0, F.col("n")).otherwise(failure))
        .drop("accepted")
    )


def interim_manifest(
    interim: DataFrame, *, dropped: int | Column = 0, eval_fold: int = K.EVAL_FOLD
) -> DataFrame:
    """One row of counts; classes are counted over originals. One scan, one tiny regroup."""
    plain = original(interim)
    per_class = interim.groupBy("class").agg(
        F.count(F.lit(1)).alias("written"),
        F.count_if(plain).alias("originals"),
        F.count_if(F.col("fold") != eval_fold).alias("train"),
        F.count_if((F.col("fold") == eval_fold) & plain).alias("evaluation"),
    )
    dropped = dropped if isinstance(dropped, Column) else F.lit(dropped)
    entry = F.when(F.col("originals") > 0, F.struct("class", F.col("originals").alias("n")))
    return per_class.agg(
        F.sum("written").alias("num_rows_written"),
        F.sum("originals").alias("num_original"),
        F.sum(F.col("written") - F.col("originals")).alias("num_augmented"),
        F.sum("train").alias("num_train_rows"),
        F.sum("evaluation").alias("num_eval_rows"),
        F.map_from_entries(F.array_sort(F.collect_list(entry))).alias("class_counts_all"),
    ).withColumn("num_dropped", dropped.cast("long"))


def feature_manifest(
    processed: DataFrame, feature_names: Sequence[str], parameters: dict[str, int]
) -> DataFrame:
    """One row: input, written and dropped rows of a feature job, with its parameters."""
    kept = F.col("reject_reason").isNull()
    row = processed.agg(
        F.count(F.lit(1)).alias("num_input_rows"),
        F.count_if(kept).alias("num_written"),
        F.count_if(~kept).alias("num_dropped"),
    )
    return row.withColumns(
        {
            **{name: F.lit(value) for name, value in parameters.items()},
            "feature_names": F.array(*[F.lit(n) for n in feature_names]),
        }
    )


def lineage_row(manifests: DataFrame, fingerprints: DataFrame) -> DataFrame:
    """Provenance in one row from (stage, revision, created_at, num_rows, num_input_rows)
    and (artifact, sha256) tables; a missing stage or artifact leaves nulls."""
    stage = lambda name, column: F.max(F.when(F.col("stage") == name, F.col(column)))
    digest = lambda name: F.max(F.when(F.col("artifact") == name, F.col("sha256")))
    stages = manifests.agg(
        stage("raw", "revision").alias("raw_revision"),
        stage("raw", "created_at").alias("raw_downloaded_at"),
        stage("interim", "created_at").alias("interim_created_at"),
        stage("interim", "num_rows").alias("interim_num_rows"),
        stage("processed", "created_at").alias("processed_created_at"),
        stage("processed", "num_rows").alias("processed_num_rows"),
        stage("processed", "num_input_rows").alias("processed_num_input_rows"),
    )
    artifacts = fingerprints.agg(
        digest("tabular").alias("tabular_sha256"), digest("mels").alias("mels_sha256")
    )
    # Both sides are global aggregates: one row each.
    return stages.crossJoin(F.broadcast(artifacts))
