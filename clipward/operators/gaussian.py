"""Cross-validation of a closed-form classifier from one scan of the training table.

The classifier models every feature of a class as normal; a class variance is blended with the variance within all
classes (``shrink``) and raised by ``smoothing``. What it needs are counts, sums and squares per (fold, class,
feature), so the statistics of a rotation are those of all folds less those of the test fold: ten models cost one
scan and one grouped aggregate, whose result has folds x classes x features rows. Copies count in the
statistics and are never tested. Classes have equal prior shares, as with balanced row weights.

Cases: null and non-finite features leave their row out of the statistics and out of the test; a row without a class or
fold takes no part; a class that only the test fold holds is never predicted there; a fold without originals is not
tested; empty tables give empty tables.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clipward import constants as K
from clipward.functions.columns import is_finite
from clipward.operators import splits
from clipward.operators.evaluation import classification_metrics, confusion_counts, top_class
from clipward.operators.search import TRIALS, completed, propose
from clipward.session import scratch_path, stable


def usable(rows: DataFrame, column: str = "features") -> DataFrame:
    """Rows with a class id, a fold and finite features only."""
    clean = F.forall(column, lambda x: F.coalesce(is_finite(x.cast("double")), F.lit(False)))
    known = F.col("class_id").isNotNull() & F.col("fold").isNotNull()
    return rows.where(known & F.coalesce(clean, F.lit(False)))


def statistics(rows: DataFrame, column: str = "features") -> DataFrame:
    """(fold, class_id, i, n, s, q): count, sum and sum of squares of feature i; one scan, one aggregate."""
    x = F.col("x").cast("double")
    return (
        rows.select("fold", "class_id", F.posexplode(column).alias("i", "x"))
        .groupBy("fold", "class_id", "i")
        .agg(F.count(F.lit(1)).alias("n"), F.sum(x).alias("s"), F.sum(x * x).alias("q"))
    )


def rotation_models(stats: DataFrame, settings: Mapping[str, tuple[float, float]]) -> DataFrame:
    """(setting, test_fold, model): an array of (class_id, means, variances) from all folds but one.

    ``settings`` maps a name to (shrink, smoothing). Tables here have at most
    settings x folds x classes x features rows, whatever the size of the training table.
    """
    spark = stats.sparkSession
    folds = stats.select(F.col("fold").alias("test_fold")).distinct()
    total = stats.groupBy("class_id", "i").agg(*[F.sum(c).alias(f"{c}a") for c in ("n", "s", "q")])
    own = stats.select(F.col("fold").alias("test_fold"), "class_id", "i", "n", "s", "q")
    less = lambda c: F.col(f"{c}a") - F.coalesce(F.col(c), F.lit(0))
    left = (
        total.join(F.broadcast(folds))
        .join(own, ["test_fold", "class_id", "i"], "left")
        .select("test_fold", "class_id", "i", *[less(c).alias(c) for c in ("n", "s", "q")])
        .where("n > 0")
    )
    mean = F.col("s") / F.col("n")
    spread = F.greatest(F.col("q") - F.col("s") * mean, F.lit(0.0))
    moments = left.select("test_fold", "class_id", "i", "n", mean.alias("mean"), spread.alias("spread"))
    within = moments.groupBy("test_fold", "i").agg((F.sum("spread") / F.sum("n")).alias("within"))
    named = spark.createDataFrame(
        [(name, float(a), float(b)) for name, (a, b) in settings.items()],
        "setting string, shrink double, smoothing double",
    )
    blended = (1 - F.col("shrink")) * F.col("spread") / F.col("n") + F.col("shrink") * F.col("within")
    parts = (
        moments.join(within, ["test_fold", "i"])
        .join(F.broadcast(named))
        .groupBy("setting", "test_fold", "class_id")
        .agg(
            F.array_sort(
                F.collect_list(F.struct("i", "mean", (blended + F.col("smoothing")).alias("variance")))
            ).alias("f")
        )
    )
    member = F.struct("class_id", F.col("f.mean").alias("means"), F.col("f.variance").alias("variances"))
    return parts.groupBy("setting", "test_fold").agg(F.array_sort(F.collect_list(member)).alias("model"))


def with_shares(rows: DataFrame, features: str, n_classes: int) -> DataFrame:
    """Adds ``proba``, the class shares of each row under its ``model``; classes the model lacks have none.

    One step a column, so that no step is worked out again inside another.
    """

    def log_likelihood(c: Column) -> Column:
        away = F.zip_with(features, c["means"], lambda x, m: (x.cast("double") - m) * (x.cast("double") - m))
        terms = F.zip_with(away, c["variances"], lambda d, v: d / v + F.log(v))
        return -0.5 * F.aggregate(terms, F.lit(0.0), lambda acc, t: acc + t)

    every = F.sequence(F.lit(0), F.lit(n_classes - 1))
    return (
        rows.withColumn("__v", F.transform("model", log_likelihood))
        .withColumn("__top", F.array_max("__v"))
        .withColumn("__e", F.transform("__v", lambda v: F.exp(v - F.col("__top"))))
        .withColumn("__sum", F.aggregate("__e", F.lit(0.0), lambda acc, e: acc + e))
        .withColumn("__known", F.map_from_arrays(F.col("model.class_id"), "__e"))
        .withColumn(
            "proba",
            F.transform(every, lambda k: F.coalesce(F.try_element_at("__known", k) / F.col("__sum"), F.lit(0.0))),
        )
        .drop("__v", "__top", "__e", "__sum", "__known")
    )


def cross_validate(
    rows: DataFrame,
    n_classes: int,
    settings: Mapping[str, tuple[float, float]],
    *,
    column: str = "features",
    keep: tuple[str, ...] = ("path",),
) -> DataFrame:
    """Scored originals of every fold under every setting: setting, ``keep``, fold, y_true, proba, pred, confidence.

    The statistics are stored, so the training table is scanned once for them and once for the scores.
    """
    clean = usable(rows, column)
    models = rotation_models(stable(statistics(clean, column), "statistics"), settings)
    # Settings x folds rows; a shuffle by fold would leave a task for each fold only.
    tested = clean.where(splits.original(clean)).join(F.broadcast(models), F.col("fold") == F.col("test_fold"))
    scored = with_shares(tested, column, n_classes)
    return top_class(scored.select("setting", *keep, "fold", F.col("class_id").alias("y_true"), "proba"))


def search(
    rows: DataFrame,
    n_classes: int,
    *,
    validation_fold: int = K.VAL_FOLD,
    n_trials: int = 20,
    batch: int = 4,
    seed: int = 42,
    column: str = "features",
) -> DataFrame:
    """Trial table (number, state, value, params) of an adaptive search over the whole space of this classifier.

    The statistics of all folds but the validation fold come from one scan; a batch of trials is scored together in
    one pass over the originals of that fold. Value is macro F1; a trial without a score has failed.
    """
    spark = rows.sparkSession
    clean = usable(rows, column)
    stats = stable(statistics(clean, column), "statistics")
    held_out = stable(clean.where(splits.original(clean) & (F.col("fold") == validation_fold)), "validation")
    path, space = scratch_path(spark, "trials"), K.SEARCH_SPACE["gaussian"]
    spark.createDataFrame([], TRIALS).write.parquet(path)
    for first in range(0, n_trials, batch):
        known = completed(spark.read.schema(TRIALS).parquet(path))
        drawn = {n: propose(space, known, n, seed) for n in range(first, min(first + batch, n_trials))}
        settings = {str(n): (p["shrink"], p["smoothing"]) for n, p in drawn.items()}
        models = rotation_models(stats, settings).where(F.col("test_fold") == validation_fold)
        # One row per trial of the batch; all held-out rows share their fold, so a shuffle by it is one task.
        tested = held_out.join(F.broadcast(models), F.col("fold") == F.col("test_fold"))
        scored = top_class(with_shares(tested, column, n_classes)).withColumn("y_true", F.col("class_id"))
        metrics = classification_metrics(confusion_counts(scored, group=["setting"]), ["setting"])
        values = {r["setting"]: r["f1_macro"] for r in metrics.collect()}  # one row per trial
        done = [
            (n, "COMPLETE" if str(n) in values else "FAIL", values.get(str(n)), {k: str(v) for k, v in p.items()})
            for n, p in drawn.items()
        ]
        spark.createDataFrame(done, TRIALS).coalesce(1).write.mode("append").parquet(path)
    return spark.read.schema(TRIALS).parquet(path)
