"""Multi-class metrics, leaderboards and trial tables.

Everything except the rank metric is computed from confusion counts, a table of at most
classes squared rows per group, so the data is aggregated once and never sorted.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clipward import constants as K
from clipward.functions.columns import is_finite
from clipward.operators.ordering import join_on, running_totals


def confusion_counts(
    scored: DataFrame, truth: str = "y_true", pred: str = "pred", group: Sequence[str] = ()
) -> DataFrame:
    return scored.groupBy(*group, F.col(truth).alias("t"), F.col(pred).alias("p")).agg(
        F.count(F.lit(1)).alias("n")
    )


def confusion_matrix(
    scored: DataFrame, n_classes: int, truth: str = "y_true", pred: str = "pred"
) -> DataFrame:
    """(t, p, n) for every pair of the n_classes classes, zeros included."""
    ids = scored.sparkSession.range(n_classes).select(F.col("id").cast("int").alias("t"))
    every = F.sequence(F.lit(0), F.lit(n_classes - 1))
    grid = ids.withColumn("p", F.explode(every))
    counts = confusion_counts(scored, truth, pred)
    return grid.join(counts, ["t", "p"], "left").select(
        "t", "p", F.coalesce("n", F.lit(0)).cast("long").alias("n")
    )


def _ratio(top: Column, bottom: Column) -> Column:
    return F.when(bottom > 0, top / bottom).otherwise(0.0)


def classification_metrics(confusion: DataFrame, group: Sequence[str] = ()) -> DataFrame:
    """Accuracy and macro / weighted precision, recall and F1 from confusion counts.

    The class set is what occurs in truth or prediction; a zero denominator gives 0.
    """
    sides = confusion.select(
        *group,
        "n",
        F.explode(
            F.array(
                F.struct(F.col("t").alias("c"), F.lit(1).alias("is_truth")),
                F.struct(F.col("p").alias("c"), F.lit(0).alias("is_truth")),
            )
        ).alias("side"),
        (F.col("t") == F.col("p")).alias("hit"),
    )
    per_class = sides.groupBy(*group, F.col("side.c").alias("c")).agg(
        F.sum(F.when(F.col("side.is_truth") == 1, F.col("n")).otherwise(0)).alias("support"),
        F.sum(F.when(F.col("side.is_truth") == 0, F.col("n")).otherwise(0)).alias("predicted"),
        F.sum(F.when((F.col("side.is_truth") == 1) & F.col("hit"), F.col("n")).otherwise(0)).alias(
            "tp"
        ),
    )
    tp, support, predicted = F.col("tp"), F.col("support"), F.col("predicted")
    scored = per_class.select(
        *group,
        "tp",
        "support",
        _ratio(tp, predicted).alias("precision"),
        _ratio(tp, support).alias("recall"),
        _ratio(2 * tp, support + predicted).alias("f1"),
    )
    total = F.sum("support")
    weighted = lambda name: F.sum(F.col(name) * F.col("support")) / total
    return scored.groupBy(*group).agg(
        (F.sum("tp") / total).alias("accuracy"),
        F.avg("precision").alias("precision_macro"),
        F.avg("recall").alias("recall_macro"),
        F.avg("f1").alias("f1_macro"),
        weighted("precision").alias("precision_weighted"),
        weighted("recall").alias("recall_weighted"),
        weighted("f1").alias("f1_weighted"),
    )


def roc_auc_per_class(
    scored: DataFrame,
    n_classes: int,
    truth: str = "y_true",
    proba: str = "proba",
    group: Sequence[str] = (),
) -> DataFrame:
    """(group, class_id, auc): exact one-vs-rest AUC, ties counted one half.

    Rows with the same score are folded into one before anything is ordered, and the
    order is a distributed running total. A class without positives or without
    negatives has no AUC (null).
    """
    long = scored.select(*group, truth, F.posexplode(proba).alias("class_id", "score"))
    by_score = long.groupBy(*group, "class_id", F.col("score").cast("double").alias("score")).agg(
        F.count_if(F.col(truth) == F.col("class_id")).alias("pos"),
        F.count_if(F.col(truth) != F.col("class_id")).alias("neg"),
    )
    ranked = running_totals(by_score, ["score"], ["neg"], [*group, "class_id"])
    below = F.col("cum_neg") - F.col("neg") + F.col("neg") / 2
    auc = ranked.groupBy(*group, "class_id").agg(
        F.sum(F.col("pos") * below).alias("wins"),
        F.sum("pos").alias("pos"),
        F.sum("neg").alias("neg"),
    )
    pairs = F.col("pos").cast("double") * F.col("neg")
    return auc.where(F.col("class_id") < n_classes).select(
        *group, "class_id", F.when(pairs > 0, F.col("wins") / pairs).alias("auc")
    )


def roc_auc_ovr(
    scored: DataFrame,
    n_classes: int,
    truth: str = "y_true",
    proba: str = "proba",
    group: Sequence[str] = (),
) -> DataFrame:
    """(group, roc_auc_ovr): the unweighted mean over classes; NaN if any is undefined."""
    per_class = roc_auc_per_class(scored, n_classes, truth, proba, group)
    return per_class.groupBy(*group).agg(
        F.when(F.count("auc") == n_classes, F.avg("auc"))
        .otherwise(F.lit(float("nan")))
        .alias("roc_auc_ovr")
    )


def fold_metrics(
    scored: DataFrame, n_classes: int, fold: str = "fold", extra: Sequence[str] = ()
) -> DataFrame:
    """All eight metrics per test fold (and per ``extra`` key)."""
    group = [*extra, fold]
    basic = classification_metrics(confusion_counts(scored, group=group), group)
    return join_on(basic, roc_auc_ovr(scored, n_classes, group=group), group)


def fold_aggregate(
    metrics: DataFrame, names: Sequence[str] = K.FOLD_METRICS, group: Sequence[str] = ()
) -> DataFrame:
    """(group, metric, mean, std) over folds; non-finite values skipped, population deviation.

    A metric without a single finite value is left out; no rows at all is an error.
    """
    present = [n for n in names if n in metrics.columns]
    pairs = F.array(
        *[F.struct(F.lit(n).alias("metric"), F.col(n).cast("double").alias("value")) for n in present]
    )
    if not group:
        # One row per fold: gathered into a single row, so that an empty table is noticed
        # without computing the metrics twice.
        rows = metrics.agg(F.collect_list(F.struct(*present)).alias("rows"))
        fail = F.raise_error(F.lit("no fold metrics to aggregate")).cast(rows.schema["rows"].dataType)
        checked = F.when(F.size("rows") > 0, F.col("rows")).otherwise(fail)
        metrics = rows.select(F.inline(checked))
    long = metrics.select(*group, F.inline(pairs))
    return (
        long.where(is_finite(F.col("value")))
        .groupBy(*group, "metric")
        .agg(F.avg("value").alias("mean"), F.stddev_pop("value").alias("std"))
    )


def top_class(scored: DataFrame, proba: str = "proba") -> DataFrame:
    """Adds ``pred`` and ``confidence``; the first class wins a tie."""
    return scored.withColumns(
        {
            "pred": (F.array_position(F.col(proba), F.array_max(proba)) - 1).cast("int"),
            "confidence": F.array_max(proba),
        }
    )


def result_score(metrics: str = "metrics") -> Column:
    """Cross-validated macro F1 where recorded, else the holdout value, else -infinity."""
    return F.coalesce(
        F.try_element_at(F.col(metrics), F.lit("cv_f1_macro_mean")),
        F.try_element_at(F.col(metrics), F.lit("f1_macro")),
        F.lit(float("-inf")),
    )


def leaderboard(results: DataFrame, order: str = "position") -> DataFrame:
    """Run results with ``score``, ``place`` and a ``winner`` flag.

    ``results`` holds one row per trained model. Ties go to the earlier listing position.
    """
    ranked = Window.orderBy(F.col("score").desc(), F.col(order))
    return (
        results.withColumn("score", result_score())
        .withColumn("place", F.row_number().over(ranked))
        .withColumn("winner", F.col("place") == 1)
    )


def select_winner(results: DataFrame, order: str = "position") -> DataFrame:
    """The winning row with its published fields; an empty table is an error."""
    best = results.withColumn("score", result_score()).agg(
        F.max_by(
            F.struct("model_name", "run_id", "metrics", "score", "dataset"),
            F.struct("score", -F.col(order)),
        ).alias("w")
    )
    none = F.raise_error(F.lit("no training results to select a winner from"))
    metric = lambda name: F.try_element_at(F.col("w.metrics"), F.lit(name))
    return best.select(
        F.coalesce(F.col("w.model_name"), none.cast("string")).alias("model_name"),
        F.col("w.run_id").alias("run_id"),
        F.col("w.score").alias("score"),
        metric("f1_macro").alias("f1_macro"),
        metric("cv_f1_macro_mean").alias("cv_f1_macro_mean"),
        metric("cv_f1_macro_std").alias("cv_f1_macro_std"),
        F.col("w.dataset").alias("dataset"),
    )


def registry_tags(board: DataFrame) -> DataFrame:
    """(model_name, tag, value) rows as a model registry would hold them; blanks left out."""
    text = lambda name: F.col(name).cast("string")
    tags = F.array(
        F.struct(
            F.lit("f1_macro").alias("tag"),
            F.format_string(
                "%.6f", F.coalesce(F.try_element_at("metrics", F.lit("f1_macro")), F.lit(float("nan")))
            ).alias("value"),
        ),
        F.struct(F.lit("winner").alias("tag"), text("winner").alias("value")),
        F.struct(F.lit("alias").alias("tag"), F.when(F.col("winner"), "production").alias("value")),
        F.struct(F.lit("champion_run").alias("tag"), text("run_id").alias("value")),
    )
    return board.select("model_name", F.inline(tags)).where(
        F.coalesce(F.col("value"), F.lit("")) != ""
    )


def best_trial(trials: DataFrame) -> DataFrame:
    """The completed trial with the largest value; the lower number wins a tie."""
    done = trials.where((F.col("state") == "COMPLETE") & F.col("value").isNotNull())
    best = done.agg(
        F.max_by(
            F.struct("number", "value", "params"), F.struct("value", -F.col("number"))
        ).alias("b"),
        F.count(F.lit(1)).alias("n_complete"),
    )
    return best.select("b.number", "b.value", "b.params", "n_complete")
