"""Training, search, cross-validation, batch and streaming scoring, streaming drift."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clipward import constants as K
from clipward import schemas as S
from clipward.operators import evaluation, gaussian, labels, matrices, modeling, scaling, splits
from clipward.plans import clip_queries
from clipward.plans import sql_views as Q
from clipward.plans import views as V
from clipward.plans.drift_queries import (
    _POINTS,
    _PSI,
    _QUANTILES,
    _ROLLING,
    _ROLLING_KS,
    prediction_reference,
)
from clipward.plans.model_queries import _ALL, _metrics_sql
from clipward.plans.registry import r6, register, rounded
from clipward.plans.sql_views import query
from clipward.session import scratch_path, spread, stable
from clipward.sources import prediction_log
from clipward.streaming import jobs, keyed, late_rows, log_routes, vector_scoring

_SMALL = {"trees": 10, "depth": 5, "feature_subset": "sqrt"}
_BOOST = {"trees": 4, "depth": 4, "rate": 0.3, "row_share": 0.9, "column_share": 0.8, "l2": 1.0, "bins": 16}


def vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The vector table as training rows: 64 features in one array."""
    rows = V.feat(spark, sf_dir)
    return scaling.feature_matrix(rows, V.FEATURES).drop(*V.FEATURES)


def clip_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clip features as training rows: 84 features in one array."""
    rows = clip_queries.stored_features(spark, sf_dir)
    kept = [c for c in S.META_COLUMNS]
    return scaling.feature_matrix(rows, S.feature_names()).select(*kept, "features")


_HELD_OUT = query(
    Q.FEAT_META,
    """SELECT path, CAST(classID AS INTEGER) AS y_true, 10 AS n_proba, TRUE AS sound
    FROM feat_meta WHERE fold = 10""",
)


def _held_out(name: str, params: dict, rows: DataFrame, n_features: int) -> DataFrame:
    train, evaluation_rows = splits.fold_split(rows)
    mapping = labels.stored_label_map(train)
    fitted = modeling.fit(name, params, train, mapping, n_features=n_features)
    scored = fitted.evaluate(evaluation_rows)
    return _sound(scored)


def _sound(scored: DataFrame) -> DataFrame:
    """Scored rows with what holds for any model: ten shares that sum to one, the first largest wins."""
    total = F.aggregate("proba", F.lit(0.0), lambda a, p: a + p)
    best = F.array_max("proba")
    sound = (
        (F.abs(total - 1) < 1e-6)
        & F.forall("proba", lambda p: p.between(0.0, 1.0))
        & (F.array_position("proba", best) - 1 == F.col("pred"))
        & (F.col("confidence") == best)
    )
    return scored.select("path", "y_true", F.size("proba").alias("n_proba"), sound.alias("sound"))


@register("m1_random_forest", _HELD_OUT)
def random_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _held_out("forest", _SMALL, vectors(spark, sf_dir), V.N_FEATURES)


@register("m2_boosted_trees_depth", _HELD_OUT)
def boosted_trees_depth(spark: SparkSession, sf_dir: str) -> DataFrame:
    params = {**_BOOST, "child_weight": 2}
    return _held_out("boosted_depth", params, vectors(spark, sf_dir), V.N_FEATURES)


@register("m3_boosted_trees_leaf", _HELD_OUT)
def boosted_trees_leaf(spark: SparkSession, sf_dir: str) -> DataFrame:
    params = {**_BOOST, "leaf_rows": 10, "leaves": 8}
    return _held_out("boosted_leaf", params, vectors(spark, sf_dir), V.N_FEATURES)


@register("m4_matrix_network")
def matrix_network(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors as 8 x 8 matrices: filters, pooling, a weighted softmax head; held-out rows and their metrics."""
    rows = stable(matrices.filter_features(vectors(spark, sf_dir), "features", 8, 8), "responses")
    train, held_out = splits.fold_split(rows)
    n_features = matrices.feature_count(8, 8)
    fitted = modeling.fit("filters", {"epochs": 50}, train, labels.stored_label_map(train), n_features=n_features)
    scored = stable(fitted.evaluate(held_out).select("path", "y_true", "proba", "pred", "confidence"), "scored")
    # One row of metrics over the stored rows.
    metrics = evaluation.classification_metrics(evaluation.confusion_counts(scored))
    beside = scored.drop("proba").crossJoin(F.broadcast(metrics.select("accuracy", "f1_macro")))
    return rounded(beside, "confidence", "accuracy", "f1_macro")


_FILTERS_SQL = ", ".join(
    f"({k}, {j // 3}, {j % 3}, CAST({w} AS DOUBLE))"
    for k, weights in enumerate(matrices.FILTERS.values())
    for j, w in enumerate(weights)
)


@register(
    "m4_matrix_features",
    query(
        f"""filters AS (SELECT * FROM (VALUES {_FILTERS_SQL}) AS t(k, dr, dc, w)),
        cells AS (SELECT vec_id, i // 8 AS r, i % 8 AS c, CAST(embedding[i + 1] AS DOUBLE) AS x
                  FROM embeddings, (SELECT unnest(range(64)) AS i)),
        responses AS (
          SELECT vec_id, k, r - dr AS r, c - dc AS c, greatest(sum(w * x), 0) AS v FROM cells, filters
          WHERE r - dr BETWEEN 0 AND 5 AND c - dc BETWEEN 0 AND 5 GROUP BY ALL),
        pools AS (SELECT vec_id, k, r // 2 AS r, c // 2 AS c, max(v) AS v FROM responses GROUP BY ALL)""",
        f"""SELECT vec_id, CAST(k * 9 + r * 3 + c AS INTEGER) AS i, {Q.r6("v")} AS value FROM pools""",
    ),
)
def matrix_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pooled filter responses of every vector."""
    rows = matrices.filter_features(V.table(spark, sf_dir, "embeddings"), "embedding", 8, 8)
    return rounded(rows.select("vec_id", F.posexplode("features").alias("i", "value")), "value")


@register("m5_fit_and_score", _HELD_OUT)
def fit_and_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class shares and the first largest class of every held-out row, by a network."""
    params = {"hidden": 16, "epochs": 10}
    return _held_out("network", params, vectors(spark, sf_dir), V.N_FEATURES)


def clip_holdout_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Holdout metrics of a forest on clip features, which do carry the class."""
    _, held_out = splits.fold_split(clip_vectors(spark, sf_dir))
    scored = _clip_forest(spark, sf_dir).evaluate(held_out)
    return evaluation.classification_metrics(evaluation.confusion_counts(scored))


@register("m6_search")
def search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Twenty adaptive trials of a forest over its whole search space."""
    parts = splits.four_way(vectors(spark, sf_dir))
    trials = modeling.search(
        "forest",
        parts["tune_train"],
        parts["validation"],
        labels.stored_label_map(parts["tune_train"]),
        n_features=V.N_FEATURES,
    )
    return trials.select("number", "state", "value", F.to_json("params").alias("params"))


def _closed_form_trials(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = stable(spread(vectors(spark, sf_dir)), "vectors")
    return gaussian.search(labels.encode_labels(rows, labels.stored_label_map(rows)), 10)


@register("m6_closed_form_search")
def closed_form_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Twenty adaptive trials of the closed-form classifier over its whole search space."""
    trials = _closed_form_trials(spark, sf_dir)
    return trials.select("number", "state", "value", F.to_json("params").alias("params"))


@register("e10_searched_trial")
def searched_trial(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best trial of the closed-form search."""
    best = evaluation.best_trial(_closed_form_trials(spark, sf_dir))
    return best.select("number", r6("value").alias("value"), F.to_json("params").alias("params"), "n_complete")


@register("m7_refit_and_evaluate", _HELD_OUT)
def refit_and_evaluate(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, scored = modeling.refit_and_evaluate(
        "forest", _SMALL, vectors(spark, sf_dir), n_features=V.N_FEATURES
    )
    return _sound(scored)


@register(
    "m8_cross_validation",
    query(
        Q.FEAT_META,
        """SELECT path, CAST(classID AS INTEGER) AS y_true, 10 AS n_proba, TRUE AS sound
        FROM feat_meta WHERE NOT is_augmented""",
    ),
)
def cross_validation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every original row is tested in exactly one rotation."""
    scored = modeling.cross_validate(
        "forest", {"trees": 5, "depth": 4}, vectors(spark, sf_dir), n_features=V.N_FEATURES
    )
    return _sound(scored)


# --- one-scan cross-validation and the selection chain -------------------------------

#: Settings of the closed-form classifier that compete in the selection chain.
_SETTINGS = (("shared", 1.0, 1e-3), ("blended", 0.5, 1e-3), ("own", 0.0, 1e-3), ("smooth", 0.5, 1.0))


def _closed_form_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scored originals of every fold under each setting; stored, as metrics and predictions both read them."""
    rows = stable(spread(vectors(spark, sf_dir)), "vectors")
    encoded = labels.encode_labels(rows, labels.stored_label_map(rows))
    scored = gaussian.cross_validate(encoded, 10, {name: s for name, *s in _SETTINGS})
    listed = F.array(*[F.lit(name) for name, *_ in _SETTINGS])
    named = scored.withColumnRenamed("setting", "model_name")
    return stable(named.withColumn("position", F.array_position(listed, F.col("model_name")) - 1), "scored")


_VALUES = ", ".join(f"({i}, '{name}', {a}, {b})" for i, (name, a, b) in enumerate(_SETTINGS))
_CLOSED_FORM = f"""
settings AS (SELECT * FROM (VALUES {_VALUES}) AS t(m, model_name, shrink, smoothing)),
floats AS (SELECT path, CAST(classID AS INTEGER) AS class_id, fold, is_augmented, i,
                  CAST(CAST(x AS FLOAT) AS DOUBLE) AS x FROM feat_long),
stats AS MATERIALIZED (
  SELECT fold, class_id, i, count(*) AS n, sum(x) AS s, sum(x * x) AS q FROM floats GROUP BY ALL),
totals AS (SELECT class_id, i, sum(n) AS n, sum(s) AS s, sum(q) AS q FROM stats GROUP BY ALL),
others AS (
  SELECT f.fold, t.class_id, t.i, t.n - coalesce(o.n, 0) AS n, t.s - coalesce(o.s, 0) AS s, t.q - coalesce(o.q, 0) AS q
  FROM totals t CROSS JOIN (SELECT DISTINCT fold FROM stats) f
  LEFT JOIN stats o ON o.fold = f.fold AND o.class_id = t.class_id AND o.i = t.i),
moments AS (
  SELECT fold, class_id, i, n, s / n AS mean, greatest(q - s * (s / n), 0) AS spread FROM others WHERE n > 0),
within AS (SELECT fold, i, sum(spread) / sum(n) AS within FROM moments GROUP BY ALL),
models AS MATERIALIZED (
  SELECT m, fold, class_id, i, mean, (1 - shrink) * spread / n + shrink * within + smoothing AS variance
  FROM moments JOIN within USING (fold, i) CROSS JOIN settings),
likely AS (
  SELECT m, path, fold, any_value(f.class_id) AS y_true, g.class_id AS c,
         -0.5 * sum((x - mean) * (x - mean) / variance + ln(variance)) AS v
  FROM floats f JOIN models g USING (fold, i) WHERE NOT is_augmented GROUP BY m, path, fold, g.class_id),
scores_long AS MATERIALIZED (
  SELECT m, path AS vec_id, fold, y_true, c, e / sum(e) OVER (PARTITION BY m, path) AS p
  FROM (SELECT *, exp(v - max(v) OVER (PARTITION BY m, path)) AS e FROM likely)),
scores AS (
  SELECT m, vec_id, fold, y_true, c AS pred, p AS confidence FROM scores_long
  QUALIFY row_number() OVER (PARTITION BY m, vec_id ORDER BY p DESC, c) = 1)"""


@register(
    "m8_one_scan_scores",
    query(
        Q.FEAT_LONG, _CLOSED_FORM,
        f"""SELECT model_name, vec_id AS path, fold, y_true, pred, {Q.r6("confidence")} AS confidence
        FROM scores JOIN settings USING (m)""",
    ),
)
def one_scan_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every original scored by a model of the other nine folds, under four settings."""
    scored = _closed_form_scores(spark, sf_dir)
    return rounded(scored, "confidence").select("model_name", "path", "fold", "y_true", "pred", "confidence")


@register(
    "m8_one_scan_folds",
    query(
        Q.FEAT_LONG, _CLOSED_FORM, *_metrics_sql("m", "fold"),
        f"SELECT model_name, fold, {_ALL} FROM metrics JOIN auc USING (m, fold) JOIN settings USING (m)",
    ),
)
def one_scan_folds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All eight metrics of every rotation."""
    metrics = evaluation.fold_metrics(_closed_form_scores(spark, sf_dir), 10, extra=["model_name"])
    return rounded(metrics, *K.FOLD_METRICS)


def selection_results(scored: DataFrame) -> DataFrame:
    """Run results from scored rows: cross-validated mean and deviation, and the holdout values of fold 10."""
    keys = ["position", "model_name"]
    folds = evaluation.classification_metrics(
        evaluation.confusion_counts(scored, group=[*keys, "fold"]), [*keys, "fold"]
    )
    held_out = F.col("fold") == K.EVAL_FOLD
    values = folds.groupBy(*keys).agg(
        F.avg("f1_macro").alias("cv_f1_macro_mean"),
        F.stddev_pop("f1_macro").alias("cv_f1_macro_std"),
        F.max(F.when(held_out, F.col("f1_macro"))).alias("f1_macro"),
        F.max(F.when(held_out, F.col("accuracy"))).alias("accuracy"),
    )
    names = ("f1_macro", "accuracy", "cv_f1_macro_mean", "cv_f1_macro_std")
    entries = F.create_map(*[part for n in names for part in (F.lit(n), F.col(n))])
    return values.select(
        *keys,
        F.concat(F.lit("run-"), F.col("model_name")).alias("run_id"),
        entries.alias("metrics"),
        F.lit("vectors").alias("dataset"),
    )


_CHAIN = """
res AS (
  SELECT m, avg(f1_macro) AS cv_mean, stddev_pop(f1_macro) AS cv_std,
         max(CASE WHEN fold = 10 THEN f1_macro END) AS f1 FROM metrics GROUP BY m)"""


@register(
    "m11_selection_board",
    query(
        Q.FEAT_LONG, _CLOSED_FORM, _metrics_sql("m", "fold")[0], _CHAIN,
        f"""SELECT model_name, 'run-' || model_name AS run_id, {Q.r6("cv_mean")} AS score, {Q.r6("f1")} AS f1_macro,
             {Q.r6("cv_std")} AS cv_f1_macro_std,
             CAST(row_number() OVER (ORDER BY cv_mean DESC, m) AS INTEGER) AS place
        FROM res JOIN settings USING (m)""",
    ),
)
def selection_board(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The leaderboard of the models that were just cross-validated."""
    board = evaluation.leaderboard(selection_results(_closed_form_scores(spark, sf_dir)))
    value = lambda name: F.element_at("metrics", name)
    return board.select(
        "model_name",
        "run_id",
        r6("score").alias("score"),
        r6(value("f1_macro")).alias("f1_macro"),
        r6(value("cv_f1_macro_std")).alias("cv_f1_macro_std"),
        "place",
    )


@register(
    "m11_selected_predictions",
    query(
        Q.FEAT_LONG, _CLOSED_FORM, _metrics_sql("m", "fold")[0], _CHAIN,
        f"""SELECT model_name, vec_id AS path, y_true, pred, {Q.r6("confidence")} AS confidence
        FROM scores JOIN settings USING (m)
        WHERE fold = 10 AND m = (SELECT m FROM res ORDER BY cv_mean DESC, m LIMIT 1)""",
    ),
)
def selected_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Held-out predictions of the winning model."""
    scored = _closed_form_scores(spark, sf_dir)
    winner = evaluation.select_winner(selection_results(scored)).first()["model_name"]
    chosen = scored.where((F.col("model_name") == winner) & (F.col("fold") == K.EVAL_FOLD))
    return rounded(chosen, "confidence").select("model_name", "path", "y_true", "pred", "confidence")


@register("m7_holdout_metrics")
def holdout_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metrics of fold 10 for forest and boosted models refit on folds 1 to 9."""
    rows = stable(vectors(spark, sf_dir), "refit")
    models = (
        ("forest", _SMALL),
        ("boosted_depth", {**_BOOST, "child_weight": 2}),
        ("boosted_leaf", {**_BOOST, "leaf_rows": 10, "leaves": 8}),
    )
    parts = []
    for name, params in models:
        _, scored = modeling.refit_and_evaluate(name, params, rows, n_features=V.N_FEATURES)
        counts = evaluation.confusion_counts(scored)
        metrics = evaluation.classification_metrics(counts).crossJoin(evaluation.roc_auc_ovr(scored, 10))
        parts.append(metrics.select(F.lit(name).alias("model_name"), *K.FOLD_METRICS))
    return rounded(parts[0].unionByName(parts[1]).unionByName(parts[2]), *K.FOLD_METRICS)


def _clip_forest(spark: SparkSession, sf_dir: str) -> modeling.Fitted:
    rows = clip_vectors(spark, sf_dir)
    train, _ = splits.fold_split(rows)
    return modeling.fit("forest", _SMALL, train, labels.stored_label_map(train), n_features=84)


def vector_uploads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The vectors as uploads: some are cut short, some hold a value that is no number."""
    # Ten minutes apart, over twenty days and again from the first.
    at = F.timestamp_seconds(F.lit(1_704_067_200) + (F.col("vec_id") * 600) % (20 * 86_400))
    nothing = F.transform("embedding", lambda v: F.when(v < 0, float("nan")).otherwise(v).cast("float"))
    return V.table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("upload_id"),
        at.alias("ts"),
        F.when(F.col("vec_id") % 9 == 4, F.slice("embedding", 1, 63))
        .when(F.col("vec_id") % 11 == 3, nothing)
        .otherwise(F.col("embedding"))
        .alias("embedding"),
    )


def _scorer(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, list[str]]:
    """The closed-form classifier of folds 1 to 9 and its class names."""
    train, _ = splits.fold_split(vectors(spark, sf_dir))
    mapping = labels.stored_label_map(train)
    name, *setting = _SETTINGS[1]
    fitted = vector_scoring.fit_scorer(labels.encode_labels(train, mapping), *setting)
    return fitted, [r["class"] for r in mapping.orderBy("class_id").collect()]


_SCORER = {"size": V.N_FEATURES, "model_name": _SETTINGS[1][0]}

# Every original scored by the model of folds 1 to 9.
_SCORED_UPLOADS = (
    _CLOSED_FORM.replace(
        "JOIN models g USING (fold, i)",
        "JOIN (SELECT m, class_id, i, mean, variance FROM models WHERE fold = 10 AND m = 1) g USING (i)",
    )
    + """,
uploads AS (
  SELECT vec_id AS upload_id, 'audio/' || vec_id AS path,
         CASE WHEN vec_id % 9 = 4 THEN 'http_400'
              WHEN vec_id % 11 = 3 AND list_min(embedding) < 0 THEN 'error' ELSE 'ok' END AS status
  FROM embeddings),
logged AS (
  SELECT upload_id, status, CASE WHEN status = 'ok' THEN 'c' || pred END AS label,
         CASE WHEN status = 'ok' THEN confidence END AS confidence
  FROM uploads u LEFT JOIN scores s ON s.vec_id = u.path)"""
)
_LOG_ROWS = query(
    Q.FEAT_LONG, _SCORED_UPLOADS,
    f"""SELECT upload_id, status, label, {Q.r6("confidence")} AS confidence, 'blended' AS model_name FROM logged""",
)


@register("m9_batch_scoring", _LOG_ROWS)
def batch_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every uploaded vector with its status, class and share."""
    model, classes = _scorer(spark, sf_dir)
    scored = vector_scoring.score_vectors(vector_uploads(spark, sf_dir), model, classes, **_SCORER)
    return rounded(scored.drop("ts", "probabilities"), "confidence")


def _stream_of(table: DataFrame, files: int) -> DataFrame:
    """A stored copy of the table in several files, read back as a stream."""
    spark = table.sparkSession
    path = scratch_path(spark, "arrivals")
    table.repartition(files).write.parquet(path)
    return spark.readStream.schema(table.schema).option("maxFilesPerTrigger", 2).parquet(path)


@register("m10_streaming_scoring", _LOG_ROWS)
def streaming_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Vectors arrive in three restarted runs, every third one sent twice; the log has one row an upload."""
    model, classes = _scorer(spark, sf_dir)
    uploads = vector_uploads(spark, sf_dir)
    again = uploads.where(F.col("upload_id") % 3 == 0).withColumn("ts", F.col("ts") + F.expr("INTERVAL 3 HOURS"))
    path, output, checkpoint = (scratch_path(spark, n) for n in ("arrivals", "scored", "cp"))
    for part in _by_days(uploads.unionByName(again), 3):
        part.write.mode("append").parquet(path)
        arriving = spark.readStream.schema(uploads.schema).parquet(path)
        options = {"output": output, "checkpoint": checkpoint, "delay": "1 day", **_SCORER}
        jobs.run_to_end(
            lambda s=arriving, o=options: vector_scoring.once_only_log(s, model, classes, **o)
        )
    return rounded(spark.read.parquet(output).drop("ts", "probabilities", "turn"), "confidence")


@register(
    "m11_winner_model",
    query(Q.FEAT_META, "SELECT path, TRUE AS sound FROM feat_meta WHERE fold = 10"),
)
def winner_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two stored models, the winner of their results loaded again and used."""
    rows = vectors(spark, sf_dir)
    folder = scratch_path(spark, "models")
    train, held_out = splits.fold_split(rows)
    mapping = labels.stored_label_map(train)
    results = []
    for position, (name, params) in enumerate([("forest", _SMALL), ("network", {"hidden": 16})]):
        fitted = modeling.fit(name, params, train, mapping, n_features=V.N_FEATURES)
        fitted.save(f"{folder}/{name}")
        value = modeling.macro_f1(fitted.evaluate(held_out))
        results.append((position, name, f"run-{name}", {"f1_macro": value}, "clips"))
    table = spark.createDataFrame(
        results,
        "position int, model_name string, run_id string, metrics map<string,double>, dataset string",
    )
    winner = modeling.load_winner(spark, table, folder)
    scored = modeling.prediction_rows(winner.score(held_out), winner)
    best = table.orderBy(F.desc(F.col("metrics")["f1_macro"]), "position").first()["model_name"]
    sound = (
        (F.col("model_name") == best)
        & (F.col("confidence") == F.element_at("probabilities", F.col("label")))
        & (F.size("probabilities") == 10)
    )
    return scored.select("path", sound.alias("sound"))


# --- streams over the prediction log -------------------------------------------------


def _by_days(log: DataFrame, parts: int, ts: str = "ts") -> list[DataFrame]:
    """The log in consecutive runs of whole days."""
    day = F.to_date(ts)
    days = [r[0] for r in log.select(day.alias("d")).distinct().orderBy("d").collect()]
    width = max(1, -(-len(days) // parts))
    firsts = days[::width]
    return [
        log.where((day >= a) if b is None else (day >= a) & (day < b))
        for a, b in zip(firsts, [*firsts[1:], None])
    ]


@register(
    "t5_streaming_monitor",
    query(
        Q.PRED, _QUANTILES, _POINTS, _ROLLING, _ROLLING_KS,
        f"""SELECT model_name, event_id, {Q.r6("psi")} AS psi_class, {Q.r6("ks")} AS ks_confidence,
             CAST(100 AS BIGINT) AS filled FROM psi JOIN rks USING (event_id)""",
    ),
)
def streaming_monitor(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log arrives in five runs of days, a restarted micro-batch each; equals the batch monitor."""
    log = V.pred_ok(spark, sf_dir).select("model_name", "ts", "event_id", "label", "confidence")
    path, output = scratch_path(spark, "arrivals"), scratch_path(spark, "snapshots")
    state, checkpoint = scratch_path(spark, "tail"), scratch_path(spark, "cp")
    reference = prediction_reference(spark, sf_dir)
    for part in _by_days(log, 5):
        part.write.mode("append").parquet(path)
        arriving = spark.readStream.schema(log.schema).parquet(path)
        jobs.run_to_end(
            lambda arriving=arriving: jobs.monitor_stream(
                arriving, reference, output=output, state=state, checkpoint=checkpoint
            )
        )
    rows = spark.read.parquet(output)
    return rows.select(
        "model_name",
        "event_id",
        r6("psi_class").alias("psi_class"),
        r6("ks_confidence").alias("ks_confidence"),
        F.col("n_observations").alias("filled"),
    )


@register(
    "t5_event_time_monitor",
    query(
        Q.PRED, _QUANTILES, _POINTS, _ROLLING, _ROLLING_KS,
        f"""SELECT model_name, event_id, {Q.r6("psi")} AS psi_class, {Q.r6("ks")} AS ks_confidence,
             CAST(100 AS BIGINT) AS filled FROM psi JOIN rks USING (event_id)""",
    ),
)
def event_time_monitor(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log arrives up to 20 hours late and out of order, in four restarted runs; equals the batch monitor.

    A heartbeat two days after the last row moves the time past it.
    """
    log = V.pred_ok(spark, sf_dir).select(
        "model_name", F.col("ts").cast("timestamp").alias("ts"), "event_id", "label", "confidence"
    )
    late = F.make_interval(mins=F.pmod(F.hash("event_id"), F.lit(1200)))
    arriving_at = log.withColumn("arrives", F.col("ts") + late)
    beat = log.agg(
        F.lit("clock").alias("model_name"),
        (F.max("ts") + F.expr("INTERVAL 2 DAYS")).alias("ts"),
        F.lit(-1).cast("long").alias("event_id"),
        F.lit(None).cast("string").alias("label"),
        F.lit(0.0).alias("confidence"),
    )
    path, output = scratch_path(spark, "arrivals"), scratch_path(spark, "snapshots")
    checkpoint = scratch_path(spark, "cp")
    reference = prediction_reference(spark, sf_dir)
    for part in [*_by_days(arriving_at, 3, "arrives"), beat]:
        part.select(*log.columns).write.mode("append").parquet(path)
        arriving = spark.readStream.schema(log.schema).parquet(path)
        shown = keyed.event_time_monitor(arriving, reference, delay="1 day")
        jobs.run_to_end(lambda shown=shown: jobs.append_stream(shown, output, checkpoint))
    rows = spark.read.parquet(output)
    return rows.select(
        "model_name",
        "event_id",
        r6("psi_class").alias("psi_class"),
        r6("ks_confidence").alias("ks_confidence"),
        F.col("n_observations").alias("filled"),
    )


_LOG_LINES = """
kinds AS (
  SELECT label, confidence, status,
         CASE WHEN event_id % 50 = 0 THEN 'malformed' WHEN event_id % 50 = 1 THEN 'not_object'
              WHEN event_id % 50 = 2 THEN 'blank' WHEN event_id % 50 = 3 THEN 'other_event'
              WHEN status <> 'ok' THEN 'not_ok' ELSE 'kept' END AS route FROM pred)"""


@register(
    "s3_streaming_log",
    query(
        Q.PRED, _LOG_LINES,
        f"""SELECT route, CASE WHEN route = 'kept' THEN label END AS label, count(*) AS n,
             {Q.r6("sum(CASE WHEN route = 'kept' THEN confidence END)")} AS confidence_sum
        FROM kinds GROUP BY ALL""",
    ),
)
def streaming_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log as arriving text, some lines broken; every line by its route, the counts checked against the write's own."""
    kind = F.col("event_id") % 50
    line = prediction_log.log_line(
        ts=prediction_log.iso_time(F.col("ts")),
        status=F.col("status"),
        label=F.col("label"),
        confidence=F.col("confidence"),
        model_name=F.col("model_name"),
        latency_s=F.col("latency_s"),
        filename=F.concat(F.lit("f"), F.col("event_id").cast("string")),
        event=F.when(kind == 3, "heartbeat").otherwise("prediction"),
    )
    broken = (
        F.when(kind == 0, F.substring(line, 1, 25)).when(kind == 1, "[1, 2]").when(kind == 2, " ").otherwise(line)
    )
    path, output, counts = (scratch_path(spark, n) for n in ("lines", "routed", "counts"))
    prediction_log.write_log(V.pred(spark, sf_dir).repartition(4).select(broken.alias("value")), path)
    lines = log_routes.read_lines(spark, path, files_per_batch=2)
    jobs.run_to_end(lambda: log_routes.route_stream(lines, output, counts, scratch_path(spark, "cp")))
    rows = spark.read.parquet(output).groupBy("route", "label").agg(
        F.count(F.lit(1)).alias("n"), F.sum("confidence").alias("confidence_sum")
    )
    return rounded(rows, "confidence_sum")


@register(
    "v4_observed_counts",
    query(Q.PRED, _LOG_LINES, "SELECT route, count(*) AS n FROM kinds GROUP BY route UNION ALL SELECT 'no_label', 0"),
)
def observed_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts by route as the writing job itself observed them; no scan of what was written."""
    log = V.pred(spark, sf_dir)
    kind = F.col("event_id") % 50
    text = F.to_json(F.struct("label", "confidence", "status", F.when(kind == 3, "other").alias("event")))
    broken = F.when(kind == 0, F.substring(text, 1, 8)).when(kind == 1, "7").when(kind == 2, "").otherwise(text)
    rows = log_routes.routed(log.select(broken.alias("value")))
    found = log_routes.write_routed(rows, scratch_path(spark, "routed"))
    return spark.createDataFrame(list(found.items()), "route string, n long")


@register(
    "t9_live_scoring_input",
    query(
        Q.UPLOADS,
        """SELECT CASE WHEN size = 0 THEN 'http_400' WHEN size > 6000 THEN 'http_413'
             WHEN NOT (lower(filename) LIKE '%.wav' AND lower(filename) NOT LIKE '%/.wav')
               AND lower(trim(split_part(coalesce(content_type, ''), ';', 1)))
                   NOT IN ('audio/wav', 'audio/x-wav', 'audio/wave') THEN 'http_400'
             ELSE 'http_503' END AS status, count(*) AS n FROM up GROUP BY status""",
    ),
)
def live_scoring_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Web pages arrive as uploads while no model is loaded."""
    html = V.table(spark, sf_dir, "pages").select("page_id", F.col("html").cast("binary").alias("wav"))
    rows = V.uploads(spark, sf_dir).drop("size").join(html, "page_id")
    scored = jobs.score_uploads(_stream_of(rows, 4), None, max_bytes=6000)
    output = scratch_path(spark, "scored")
    jobs.run_to_end(lambda: jobs.append_stream(scored, output, scratch_path(spark, "cp")))
    return spark.read.parquet(output).groupBy("status").agg(F.count(F.lit(1)).alias("n"))


_DAILY = f"""
names AS (SELECT unnest(['click', 'purchase', 'signup', 'view']) AS label),
e AS (SELECT label, count(*) / sum(count(*)) OVER () AS expected FROM ref GROUP BY label),
d AS (SELECT date_trunc('day', ts) AS day, label, count(*) AS n FROM pred_ok GROUP BY ALL),
tot AS (SELECT day, sum(n) AS t FROM d GROUP BY day),
al AS (SELECT day, label, expected, coalesce(n, 0) / t AS actual
       FROM tot CROSS JOIN names JOIN e USING (label) LEFT JOIN d USING (day, label)),
p AS (SELECT day, {_PSI} AS psi FROM al GROUP BY day),
kd AS (
  SELECT date_trunc('day', ts) AS day, r, any_value(f_at) AS f_at, any_value(f_before) AS f_before,
         count(*) FILTER (WHERE confidence <= r) / count(*) AS le,
         count(*) FILTER (WHERE confidence < r) / count(*) AS lt
  FROM pred_ok, (SELECT DISTINCT * FROM pts) GROUP BY day, r),
k AS (SELECT day, max(greatest(abs(f_at - le), abs(f_before - lt))) AS ks FROM kd GROUP BY day)"""


@register(
    "t10_windowed_drift",
    query(
        Q.PRED, _QUANTILES, _POINTS, _DAILY,
        f"""SELECT strftime(day, '%Y-%m-%d') AS day, {Q.r6("psi")} AS psi_class, {Q.r6("ks")} AS ks_confidence,
             CAST(t AS BIGINT) AS n_observations
        FROM p JOIN k USING (day) JOIN tot USING (day)""",
    ),
)
def windowed_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily windows in append mode, completed by a batch over the windows still open."""
    reference = prediction_reference(spark, sf_dir)
    log = V.pred_ok(spark, sf_dir).select(F.col("ts").cast("timestamp").alias("ts"), "label", "confidence")
    path, output = scratch_path(spark, "arrivals"), scratch_path(spark, "windows")
    checkpoint = scratch_path(spark, "cp")
    for part in _by_days(log, 3):
        part.write.mode("append").parquet(path)
        arriving = spark.readStream.schema(log.schema).parquet(path)
        counts = jobs.windowed_counts(arriving, reference, window="1 day")
        jobs.run_to_end(
            lambda counts=counts: jobs.append_stream(counts, output, checkpoint)
        )
    closed = spark.read.schema("window_start timestamp, kind string, code int, n long").parquet(output)
    every = jobs.windowed_counts(log, reference, window="1 day")
    table = jobs.score_windows(closed.unionByName(jobs.open_windows(every, closed)), reference)
    shown = table.withColumn("day", F.date_format("window_start", "yyyy-MM-dd"))
    return rounded(shown.drop("window_start", "n_unknown_labels"), "psi_class", "ks_confidence")


@register(
    "t10_late_rows",
    query(
        Q.PRED,
        """arriving AS (
          SELECT ts, date_trunc('day', ts) AS day,
                 date_trunc('day', ts + CASE WHEN event_id % 7 = 0 THEN INTERVAL 9 DAYS ELSE INTERVAL 0 DAYS END) AS arrives
          FROM pred_ok),
        runs AS (
          SELECT ts, day, (dense_rank() OVER (ORDER BY arrives) - 1)
                          // (SELECT CAST(ceil(count(DISTINCT arrives) / 3.0) AS BIGINT) FROM arriving) AS run FROM arriving),
        marks AS (SELECT run, max(ts) AS newest FROM runs GROUP BY run),
        limits AS (
          SELECT a.run, max(b.newest) - INTERVAL 1 DAY AS late_before
          FROM marks a LEFT JOIN marks b ON b.run < a.run GROUP BY a.run)""",
        """SELECT strftime(day, '%Y-%m-%d') AS day,
             count(*) FILTER (WHERE NOT coalesce(day + INTERVAL 1 DAY <= late_before, FALSE)) AS n_counted,
             count(*) FILTER (WHERE coalesce(day + INTERVAL 1 DAY <= late_before, FALSE)) AS n_late
        FROM runs JOIN limits USING (run) GROUP BY day""",
    ),
)
def rows_too_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily windows over three restarted runs; every seventh row comes nine days after its time."""
    reference = prediction_reference(spark, sf_dir)
    log = V.pred_ok(spark, sf_dir).select(
        F.col("ts").cast("timestamp").alias("ts"), "event_id", "label", "confidence"
    )
    wait = F.make_interval(days=F.when(F.col("event_id") % 7 == 0, 9).otherwise(0))
    path = scratch_path(spark, "arrivals")
    place = {n: scratch_path(spark, n) for n in ("output", "late", "marks", "checkpoint")}
    for part in _by_days(log.withColumn("arrives", F.col("ts") + wait), 3, "arrives"):
        part.drop("arrives").write.mode("append").parquet(path)
        arriving = spark.readStream.schema(log.schema).parquet(path)
        jobs.run_to_end(
            lambda s=arriving: late_rows.count_with_late_rows(s, reference, window="1 day", delay="1 day", **place)
        )
    counted = late_rows.stored_counts(spark, place["output"]).where("kind = 'labels'").select(
        "window_start", "n", F.lit(0).cast("long").alias("m")
    )
    missed = spark.read.parquet(place["late"]).select(
        "window_start", F.lit(0).cast("long").alias("n"), F.lit(1).cast("long").alias("m")
    )
    return counted.unionByName(missed).groupBy(F.date_format("window_start", "yyyy-MM-dd").alias("day")).agg(
        F.sum("n").alias("n_counted"), F.sum("m").alias("n_late")
    )
