"""Fold-aware splits and row filters. All of them are narrow: no shuffle."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clipward import constants as K
from clipward.functions.columns import is_finite


def _need(df: DataFrame, *columns: str) -> None:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"missing column(s): {', '.join(missing)}")


def original(df: DataFrame) -> Column:
    """Condition for rows that are not augmented copies; always true without the flag."""
    return ~F.col("is_augmented") if "is_augmented" in df.columns else F.lit(True)


def fold_split(
    df: DataFrame, eval_fold: int = K.EVAL_FOLD, fold: str = "fold"
) -> tuple[DataFrame, DataFrame]:
    """(train, eval). Augmented copies of the evaluation fold belong to neither."""
    _need(df, fold)
    return df.where(F.col(fold) != eval_fold), df.where(
        (F.col(fold) == eval_fold) & original(df)
    )


def fold_set(
    df: DataFrame, folds: Sequence[int], *, include_augmented: bool, fold: str = "fold"
) -> DataFrame:
    _need(df, fold)
    kept = F.col(fold).isin(*folds)
    return df.where(kept if include_augmented else kept & original(df))


def four_way(
    df: DataFrame,
    train_folds: Sequence[int] = K.TRAIN_FOLDS,
    val_fold: int = K.VAL_FOLD,
    eval_fold: int = K.EVAL_FOLD,
) -> dict[str, DataFrame]:
    return {
        "tune_train": fold_set(df, train_folds, include_augmented=True),
        "validation": fold_set(df, [val_fold], include_augmented=False),
        "refit": fold_set(df, [*train_folds, val_fold], include_augmented=True),
        "evaluation": fold_set(df, [eval_fold], include_augmented=False),
    }


def with_roles(
    df: DataFrame,
    train_folds: Sequence[int] = K.TRAIN_FOLDS,
    val_fold: int = K.VAL_FOLD,
    eval_fold: int = K.EVAL_FOLD,
) -> DataFrame:
    """The four sets in one pass: one output row per (row, role) it plays."""
    train, plain = F.col("fold").isin(*train_folds), original(df)
    val = F.col("fold") == val_fold
    roles = F.array_compact(
        F.array(
            F.when(train, F.lit("tune_train")),
            F.when(val & plain, F.lit("validation")),
            F.when(train | val, F.lit("refit")),
            F.when((F.col("fold") == eval_fold) & plain, F.lit("evaluation")),
        )
    )
    return df.withColumn("role", F.explode(roles))


def rotate_folds(df: DataFrame, n_folds: int = 10) -> DataFrame:
    """k-fold rotation: every row once per ``test_fold`` in which it plays a role."""
    if n_folds < 2:
        raise ValueError(f"n_folds must be at least 2, got {n_folds}")
    _need(df, "fold")
    spread = df.where(F.col("fold").between(1, n_folds)).withColumn(
        "test_fold", F.explode(F.sequence(F.lit(1), F.lit(n_folds)))
    )
    is_test = F.col("fold") == F.col("test_fold")
    role = F.when(is_test, F.lit("test")).otherwise(F.lit("train"))
    return spread.withColumn("role", role).where(~is_test | original(df))


def fold_originals(df: DataFrame, fold: int) -> DataFrame:
    _need(df, "fold", "class")
    return df.where((F.col("fold") == fold) & original(df))


def prefer_originals(df: DataFrame) -> DataFrame:
    """Drop augmented rows, unless that would leave nothing."""
    if "is_augmented" not in df.columns:
        return df
    flag = df.agg(
        (F.count_if(~F.col("is_augmented")) > 0).alias("__any_original")
    )
    # The flag table is one row by construction (a global aggregate).
    return (
        df.crossJoin(F.broadcast(flag))
        .where(~F.col("is_augmented") | ~F.col("__any_original"))
        .drop("__any_original")
    )


def finite_only(df: DataFrame, column: str) -> DataFrame:
    return df.where(is_finite(F.col(column)))


def first_filled_column(df: DataFrame, candidates: Sequence[str]) -> str | None:
    """The first candidate column that holds any value; the choice is per table, not per row."""
    present = [c for c in candidates if c in df.columns]
    if not present:
        return None
    row = df.agg(*[F.max(F.col(c).isNotNull()).alias(c) for c in present]).first()
    return next((c for c in present if row[c]), None)


def first_rows(df: DataFrame, n: int, order: Sequence[str]) -> DataFrame:
    """The first n rows under an explicit order (a top-n, not a full sort)."""
    return df.orderBy(*order).limit(n)
