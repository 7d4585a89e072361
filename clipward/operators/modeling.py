"""Training and scoring jobs on ``pyspark.ml``: forests, boosted trees, a small network.

A fitted model is stored beside its scaler and its label map, so that a scoring job can
rebuild the whole chain from one folder.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.errors import AnalysisException
from pyspark.ml import Estimator, Model
from pyspark.ml.classification import (
    LogisticRegression,
    LogisticRegressionModel,
    MultilayerPerceptronClassificationModel,
    MultilayerPerceptronClassifier,
    RandomForestClassificationModel,
    RandomForestClassifier,
)
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clipward import constants as K
from clipward.operators import boosting, evaluation, forest, labels, scaling, splits
from clipward.operators import search as sampler
from clipward.operators.boosting import Boosted, Growth
from clipward.session import scratch_path, spread, stable

BOOSTED_MODELS = ("boosted_depth", "boosted_leaf")
TABULAR_MODELS = ("forest", *BOOSTED_MODELS)
MATRIX_MODELS = ("network",)
_LOADERS = {
    "forest": RandomForestClassificationModel,
    "boosted_depth": Boosted,
    "boosted_leaf": Boosted,
    "network": MultilayerPerceptronClassificationModel,
    "filters": LogisticRegressionModel,
}

def suggest(
    model_name: str,
    number: int,
    seed: int = 42,
    limits: Mapping[str, float] | None = None,
    completed: Sequence[sampler.Trial] = (),
) -> dict[str, object]:
    """Parameters of one trial: a function of the arguments only; random without ``completed`` trials.

    ``limits`` lowers the upper end of a range, for instance when the cluster cannot hold
    trees of full depth; what is used is recorded with the trial.
    """
    if model_name not in K.SEARCH_SPACE:
        raise ValueError(f"unknown model '{model_name}'")
    space = sampler.bounded(K.SEARCH_SPACE[model_name], limits)
    return sampler.propose(space, completed, number, seed)


def build_estimator(
    model_name: str, params: Mapping[str, object], n_features: int, n_classes: int, seed: int = 42
) -> Estimator:
    """The estimator for a parameter set; the network has no row weights, see ``balanced``."""
    columns = {"featuresCol": "vector", "labelCol": "class_id"}
    if model_name == "forest":
        return RandomForestClassifier(
            **columns,
            weightCol="weight",
            seed=seed,
            numTrees=int(params.get("trees", 100)),
            maxDepth=int(params.get("depth", 8)),
            minInstancesPerNode=int(params.get("leaf_rows", 1)),
            featureSubsetStrategy=str(params.get("feature_subset", "sqrt")),
        )
    if model_name == "network":
        return MultilayerPerceptronClassifier(
            **columns,
            layers=[n_features, int(params.get("hidden", 32)), n_classes],
            stepSize=float(params.get("step", 0.03)),
            maxIter=int(params.get("epochs", 30)),
            seed=seed,
        )
    if model_name == "filters":
        return LogisticRegression(
            **columns,
            weightCol="weight",
            family="multinomial",
            standardization=False,
            maxIter=int(params.get("epochs", 50)),
            regParam=float(params.get("l2", 1e-3)),
        )
    raise ValueError(f"unknown model '{model_name}'")


def training_rows(
    train: DataFrame, mapping: DataFrame, scaler: DataFrame, column: str = "features"
) -> DataFrame:
    """Encoded, weighted and standardised rows; weights come from these rows alone."""
    encoded = labels.encode_labels(train, mapping)
    weighted = labels.with_sample_weights(encoded, labels.class_weights(train, mapping))
    return scaling.scale_matrix(weighted, scaler, column)


def _vectors(df: DataFrame, column: str) -> DataFrame:
    return df.withColumn("vector", array_to_vector(F.col(column))).drop(column)


def fit_array_scaler(df: DataFrame, column: str, size: int) -> DataFrame:
    """``fit_scaler`` for features kept as one array column of known size."""
    names = [f"x{i}" for i in range(size)]
    wide = df.select(*[F.element_at(column, i + 1).alias(n) for i, n in enumerate(names)])
    return scaling.fit_scaler(wide, names)


def balanced(rows: DataFrame, key: str = "path") -> DataFrame:
    """Rows repeated in proportion to their weight, for learners without row weights.

    Weights are divided by the least one, so every row occurs at least once and the rarest
    class most often. The whole part is repeated and the rest adds a copy with that
    probability, decided by a hash of the row key, so the result does not depend on
    partitioning.
    """
    least = rows.agg(F.min("weight")).first()[0]
    scaled = F.col("weight") / F.lit(least)
    draw = F.pmod(F.xxhash64(key), F.lit(1_000_000)) / 1_000_000.0
    times = (F.floor(scaled) + F.when(draw < scaled - F.floor(scaled), 1).otherwise(0)).cast("int")
    copies = F.explode(F.sequence(F.lit(1), F.greatest(times, F.lit(1))))
    return rows.withColumn("__copy", copies).drop("__copy")


def with_probabilities(model: Model | Boosted, rows: DataFrame, n_classes: int, column: str) -> DataFrame:
    """Adds ``proba``, ``pred`` and ``confidence``; the first class wins ties. ``column`` goes."""
    if isinstance(model, Boosted):
        return evaluation.top_class(boosting.with_shares(rows, model, column))
    scored = model.transform(_vectors(rows, column))
    plain = scored.withColumn("proba", F.slice(vector_to_array("probability"), 1, n_classes))
    return evaluation.top_class(plain).drop("rawPrediction", "probability", "prediction", "vector")


@dataclass(frozen=True)
class Fitted:
    """A trained model with what is needed to score new rows."""

    name: str
    model: Model | Boosted
    scaler: DataFrame
    mapping: DataFrame
    n_classes: int

    def score(self, rows: DataFrame, column: str = "features") -> DataFrame:
        scaled = scaling.scale_matrix(rows, self.scaler, column)
        return with_probabilities(self.model, scaled, self.n_classes, column)

    def evaluate(self, rows: DataFrame, column: str = "features") -> DataFrame:
        """Scored rows with the true class id as ``y_true``."""
        encoded = labels.encode_labels(rows, self.mapping).withColumnRenamed("class_id", "y_true")
        return self.score(encoded, column)

    def save(self, folder: str) -> None:
        if isinstance(self.model, Boosted):
            boosting.save(self.model, self.scaler.sparkSession, f"{folder}/model")
        else:
            self.model.write().overwrite().save(f"{folder}/model")
        self.scaler.write.mode("overwrite").parquet(f"{folder}/scaler")
        self.mapping.write.mode("overwrite").parquet(f"{folder}/labels")


def fit(
    model_name: str,
    params: Mapping[str, object],
    train: DataFrame,
    mapping: DataFrame,
    *,
    n_features: int,
    column: str = "features",
    seed: int = 42,
) -> Fitted:
    """Fit scaler, weights and model on the given rows only."""
    if model_name in BOOSTED_MODELS:
        n_classes = mapping.count()
        scaler = stable(fit_array_scaler(train, column, n_features), "scaler")
        rows = training_rows(train, mapping, scaler, column)
        growth = Growth.of(params, seed)
        grown = boosting.fit(rows, n_features, n_classes, growth, column, "path" if "path" in rows.columns else column)
        return Fitted(model_name, grown, scaler, mapping, n_classes)
    scaler, n_classes, rows = _prepared(model_name, train, mapping, n_features, column)
    estimator = build_estimator(model_name, params, n_features, n_classes, seed)
    # Tree and network fitting scan the rows many times.
    kept = rows.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        model = estimator.fit(kept)
    finally:
        kept.unpersist()
    return Fitted(model_name, model, scaler, mapping, n_classes)


def _prepared(
    model_name: str, train: DataFrame, mapping: DataFrame, n_features: int, column: str
) -> tuple[DataFrame, int, DataFrame]:
    """(scaler, number of classes, rows to fit): what a fit needs before its parameters matter."""
    scaler = stable(fit_array_scaler(train, column, n_features), "scaler")
    rows = training_rows(train, mapping, scaler, column)
    if model_name in MATRIX_MODELS:
        rows = balanced(rows)
    return scaler, mapping.count(), _vectors(rows, column).select("vector", "class_id", "weight")


def _forest_table(train: DataFrame, validation: DataFrame, mapping: DataFrame, n_features: int) -> forest.Table:
    scaler = stable(fit_array_scaler(train, "features", n_features), "scaler")
    rows = training_rows(train, mapping, scaler)
    held = scaling.scale_matrix(labels.encode_labels(validation, mapping), scaler)
    key = "path" if "path" in train.columns else "features"
    return forest.binned(rows, held, n_features, mapping.count(), key=key)


def _dealt(df: DataFrame) -> DataFrame:
    return spread(df) if "path" in df.columns else df


def macro_f1(scored: DataFrame) -> float:
    row = evaluation.classification_metrics(evaluation.confusion_counts(scored)).first()
    return float(row["f1_macro"])


def search(
    model_name: str,
    train: DataFrame,
    validation: DataFrame,
    mapping: DataFrame,
    *,
    n_features: int,
    n_trials: int = 20,
    seed: int = 42,
    limits: Mapping[str, float] | None = None,
    parallelism: int = 4,
) -> DataFrame:
    """Trial table (number, state, value, params), value being macro F1 on the validation rows.

    ``parallelism`` trials run at a time as concurrent Spark jobs over the same persisted split. The table is stored
    after each batch, and the proposals of the next one are a function of what is stored.
    """
    spark = train.sparkSession
    kept = [_dealt(df).persist(StorageLevel.MEMORY_AND_DISK) for df in (train, validation)]
    path = scratch_path(spark, "trials")
    spark.createDataFrame([], sampler.TRIALS).write.parquet(path)
    shared: tuple[DataFrame, int, DataFrame] | None = None
    table: forest.Table | None = None
    # Scaler, weights and vectors are functions of the split alone, so all trials use the same ones.
    if model_name == "forest":
        table = _forest_table(*kept, mapping, n_features)
    elif model_name not in BOOSTED_MODELS:
        scaler, n_classes, rows = _prepared(model_name, kept[0], mapping, n_features, "features")
        shared = scaler, n_classes, rows.persist(StorageLevel.MEMORY_AND_DISK)
        kept.append(rows)

    def evaluated(params: dict[str, object]) -> DataFrame:
        if table is not None:
            return evaluation.top_class(forest.scored(table, forest.Growth.of(params, seed)))
        if shared is None:
            fitted = fit(model_name, params, kept[0], mapping, n_features=n_features, seed=seed)
        else:
            scaler, n_classes, rows = shared
            model = build_estimator(model_name, params, n_features, n_classes, seed).fit(rows)
            fitted = Fitted(model_name, model, scaler, mapping, n_classes)
        return fitted.evaluate(kept[1])

    def trial(number: int, params: dict[str, object]) -> tuple[int, str, float, dict[str, str]]:
        value = macro_f1(evaluated(params))
        return number, "COMPLETE", value, {k: str(v) for k, v in params.items()}

    try:
        with ThreadPoolExecutor(parallelism) as pool:
            for first in range(0, n_trials, parallelism):
                known = sampler.completed(spark.read.schema(sampler.TRIALS).parquet(path))
                batch = range(first, min(first + parallelism, n_trials))
                drawn = [suggest(model_name, n, seed, limits, known) for n in batch]
                rows = list(pool.map(trial, batch, drawn))
                spark.createDataFrame(rows, sampler.TRIALS).coalesce(1).write.mode("append").parquet(path)
    finally:
        for df in kept:
            df.unpersist()
    return spark.read.schema(sampler.TRIALS).parquet(path)


def refit_and_evaluate(
    model_name: str,
    params: Mapping[str, object],
    table: DataFrame,
    *,
    n_features: int,
    seed: int = 42,
) -> tuple[Fitted, DataFrame]:
    """Refit on train and validation folds with a new scaler, then score the eval fold once.

    The label map comes from the training folds.
    """
    parts = splits.four_way(table)
    mapping = labels.stored_label_map(parts["tune_train"])
    fitted = fit(model_name, params, parts["refit"], mapping, n_features=n_features, seed=seed)
    return fitted, fitted.evaluate(parts["evaluation"])


def cross_validate(
    model_name: str,
    params: Mapping[str, object],
    table: DataFrame,
    *,
    n_features: int,
    n_folds: int = 10,
    seed: int = 42,
    parallelism: int = 2,
) -> DataFrame:
    """Scored test rows of every rotation with their ``fold``; ids from one global label map.

    Scaler, weights and model are fitted again for every fold. Copies train but never test.
    """
    if n_folds < 2:
        raise ValueError(f"n_folds must be at least 2, got {n_folds}")
    mapping = labels.stored_label_map(table)
    table = stable(_dealt(table), "rotation")  # every fold reads it three times
    folds = list(range(1, n_folds + 1))

    def one(k: int) -> DataFrame:
        train = splits.fold_set(table, [f for f in folds if f != k], include_augmented=True)
        test = splits.fold_set(table, [k], include_augmented=False)
        fitted = fit(model_name, params, train, mapping, n_features=n_features, seed=seed)
        return fitted.evaluate(test).select("path", "fold", "y_true", "pred", "confidence", "proba")

    with ThreadPoolExecutor(parallelism) as pool:
        parts = list(pool.map(one, folds))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def family(model_name: str) -> str:
    if model_name in MATRIX_MODELS:
        return "matrix"
    if model_name in TABULAR_MODELS:
        return "tabular"
    raise ValueError(f"unknown model family for '{model_name}'")


def _exists(spark: SparkSession, path: str) -> bool:
    try:
        spark.read.text(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return False
    return True


def load_fitted(spark: SparkSession, folder: str, model_name: str) -> Fitted:
    """Load a stored model; its parts must be complete and of the named kind."""
    parts = ("model/metadata", "scaler", "labels")
    missing = [p.split("/")[0] for p in parts if not _exists(spark, f"{folder}/{p}")]
    if missing:
        raise FileNotFoundError(f"incomplete model folder {folder}: no {', '.join(missing)}")
    stored = spark.read.text(f"{folder}/model/metadata").first()["value"]
    loader = _LOADERS[model_name] if family(model_name) else None
    if f".{loader.__name__}" not in stored:
        raise ValueError(f"{folder} does not hold a {model_name} model")
    mapping = spark.read.parquet(f"{folder}/labels")
    whole = boosting.load(spark, f"{folder}/model") if loader is Boosted else loader.load(f"{folder}/model")
    return Fitted(
        model_name,
        whole,
        spark.read.parquet(f"{folder}/scaler"),
        mapping,
        mapping.count(),
    )


def load_winner(spark: SparkSession, results: DataFrame, models_dir: str) -> Fitted:
    """The model that the run results name as winner."""
    name = evaluation.select_winner(results).first()["model_name"]
    return load_fitted(spark, f"{models_dir}/{name}", name)


def pooled_mel(df: DataFrame, bands: int = 16, segments: int = 4) -> DataFrame:
    """Mel matrices averaged over blocks of bands and frames, as a short ``features`` array."""
    height, width = K.N_MELS // bands, -(-K.MEL_FRAMES // segments)

    def cell(i: Column) -> Column:
        band, segment = F.floor(i / segments).cast("int"), (i % segments).cast("int")
        # Row-major slices of one block; each is one band of one time segment.
        parts = F.transform(
            F.sequence(band * height, band * height + height - 1),
            lambda r: F.slice(
                "mel",
                r * K.MEL_FRAMES + segment * width + 1,
                F.least(F.lit(width), K.MEL_FRAMES - segment * width),
            ),
        )
        flat = F.flatten(parts)
        total = F.aggregate(flat, F.lit(0.0), lambda acc, v: acc + v.cast("double"))
        return (total / F.size(flat)).cast("float")

    return df.withColumn("features", F.transform(F.sequence(F.lit(0), F.lit(bands * segments - 1)), cell))


def prediction_rows(scored: DataFrame, fitted: Fitted) -> DataFrame:
    """(kept columns, label, confidence, model_name, probabilities by label)."""
    # The label list has one entry per class.
    names = fitted.mapping.agg(
        F.array_sort(F.collect_list(F.struct("class_id", "class"))).alias("m")
    ).select(F.col("m.class").alias("__names"))
    size = F.least(F.size("__names"), F.size("proba"))
    drop = ("__names", "proba", "pred")
    return (
        scored.crossJoin(F.broadcast(names))
        .withColumn("label", F.element_at("__names", F.col("pred") + 1))
        .withColumn("model_name", F.lit(fitted.name))
        .withColumn(
            "probabilities",
            F.map_from_arrays(F.slice("__names", 1, size), F.slice("proba", 1, size)),
        )
        .drop(*drop)
    )


def feature_array(df: DataFrame, names: Sequence[str]) -> DataFrame:
    return scaling.feature_matrix(df, names)
