"""Labels, splits, weights, scaling, matrices and classification metrics."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clipward import constants as K
from clipward.functions import columns as C
from clipward.operators import evaluation as E
from clipward.operators import labels as L
from clipward.operators import scaling, sketches, splits
from clipward.operators.ordering import exact_quantiles
from clipward.plans import sql_views as Q
from clipward.plans import views as V
from clipward.plans.registry import r6, register, rounded
from clipward.plans.sql_views import query
from clipward.session import scratch_path

_ROW = ["path", "fold", "is_augmented"]


def _tagged(parts: dict[str, DataFrame], columns: list[str]) -> DataFrame:
    frames = [df.select(F.lit(name).alias("part"), *columns) for name, df in parts.items()]
    return reduce(DataFrame.unionByName, frames)


# --- splits --------------------------------------------------------------------------


@register(
    "p1_fold_split",
    query(
        Q.FEAT_META,
        """SELECT CASE WHEN fold <> 10 THEN 'train' ELSE 'eval' END AS part, path, fold, is_augmented
        FROM feat_meta WHERE fold <> 10 OR NOT is_augmented""",
    ),
)
def fold_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    train, evaluation = splits.fold_split(V.feat_meta(spark, sf_dir))
    return _tagged({"train": train, "eval": evaluation}, _ROW)


@register(
    "p2_fold_set",
    query(
        Q.FEAT_META,
        "SELECT path, fold, is_augmented FROM feat_meta WHERE fold IN (1, 2, 9) AND NOT is_augmented",
    ),
)
def fold_set(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = V.feat_meta(spark, sf_dir)
    return splits.fold_set(rows, [1, 2, 9], include_augmented=False).select(*_ROW)


@register(
    "p3_four_way_split",
    query(
        Q.FEAT_META,
        """SELECT 'tune_train' AS role, path, fold, is_augmented FROM feat_meta WHERE fold <= 8
        UNION ALL SELECT 'validation', path, fold, is_augmented FROM feat_meta
          WHERE fold = 9 AND NOT is_augmented
        UNION ALL SELECT 'refit', path, fold, is_augmented FROM feat_meta WHERE fold <= 9
        UNION ALL SELECT 'evaluation', path, fold, is_augmented FROM feat_meta
          WHERE fold = 10 AND NOT is_augmented""",
    ),
)
def four_way_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return splits.with_roles(V.feat_meta(spark, sf_dir)).select("role", *_ROW)


@register(
    "p4_fold_rotation",
    query(
        Q.FEAT_META,
        """SELECT CAST(k AS INTEGER) AS test_fold, CASE WHEN fold = k THEN 'test' ELSE 'train' END AS role,
             class, count(*) AS n
        FROM feat_meta, (SELECT unnest(range(1, 11)) AS k)
        WHERE fold <> k OR NOT is_augmented GROUP BY ALL""",
    ),
)
def fold_rotation(spark: SparkSession, sf_dir: str) -> DataFrame:
    rotated = splits.rotate_folds(V.feat_meta(spark, sf_dir))
    return rotated.groupBy("test_fold", "role", "class").agg(F.count(F.lit(1)).alias("n"))


@register(
    "p5_fold_originals",
    query(
        Q.FEAT_META,
        "SELECT path, fold, class FROM feat_meta WHERE fold = 9 AND NOT is_augmented",
    ),
)
def fold_originals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return splits.fold_originals(V.feat_meta(spark, sf_dir), K.VAL_FOLD).select("path", "fold", "class")


@register(
    "p6_prefer_originals",
    query(
        Q.FEAT_META,
        """SELECT 'mixed' AS part, path, fold, is_augmented FROM feat_meta WHERE NOT is_augmented
        UNION ALL SELECT 'only_copies', path, fold, is_augmented FROM feat_meta WHERE is_augmented""",
    ),
)
def prefer_originals(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = V.feat_meta(spark, sf_dir)
    return _tagged(
        {
            "mixed": splits.prefer_originals(rows),
            "only_copies": splits.prefer_originals(rows.where("is_augmented")),
        },
        _ROW,
    )


_BROKEN = """
broken AS (
  SELECT l_orderkey, l_linenumber,
         CASE l_orderkey % 7 WHEN 0 THEN CAST('NaN' AS DOUBLE) WHEN 1 THEN CAST('Infinity' AS DOUBLE)
           WHEN 2 THEN CAST('-Infinity' AS DOUBLE) WHEN 3 THEN NULL ELSE l_extendedprice END AS x
  FROM lineitem)"""


@register(
    "p7_finite_filter",
    query(
        _BROKEN,
        f"""SELECT l_linenumber, count(*) AS n, {Q.r6("avg(x)")} AS mean_x FROM broken
        WHERE x IS NOT NULL AND isfinite(x) GROUP BY l_linenumber""",
    ),
)
def finite_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("l_orderkey") % 7
    broken = V.lines(spark, sf_dir).select(
        "l_linenumber",
        F.when(kind == 0, float("nan"))
        .when(kind == 1, float("inf"))
        .when(kind == 2, float("-inf"))
        .when(kind != 3, F.col("l_extendedprice"))
        .alias("x"),
    )
    kept = splits.finite_only(broken, "x")
    return kept.groupBy("l_linenumber").agg(
        F.count(F.lit(1)).alias("n"), r6(F.avg("x")).alias("mean_x")
    )


@register(
    "p8_matrix_projection",
    query(
        Q.FEAT_LONG,
        f"""SELECT path, CAST(class[2:] AS INTEGER) AS class_id,
             {Q.r6("sum(CAST(CAST(x AS FLOAT) AS DOUBLE))")} AS total,
             {Q.r6("max(CASE WHEN i = 63 THEN CAST(CAST(x AS FLOAT) AS DOUBLE) END)")} AS last
        FROM feat_long GROUP BY path, class""",
    ),
)
def matrix_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = V.feat(spark, sf_dir)
    encoded = L.encode_labels(scaling.feature_matrix(rows, V.FEATURES), L.label_map(rows))
    total = F.aggregate("features", F.lit(0.0), lambda acc, x: acc + x.cast("double"))
    return encoded.select(
        "path",
        "class_id",
        r6(total).alias("total"),
        r6(F.element_at("features", 64).cast("double")).alias("last"),
    )


@register(
    "p9_matrix_rows",
    query(
        Q.FEAT_META,
        f"""SELECT vec_id, CAST(i AS INTEGER) AS row_no,
             {Q.r6("list_sum(CAST(embedding[i * 8 + 1 : i * 8 + 8] AS DOUBLE[]))")} AS row_sum,
             {Q.r6("CAST(embedding[i * 8 + 8] AS DOUBLE)")} AS row_last
        FROM vec, (SELECT unnest(range(8)) AS i)""",
    ),
)
def matrix_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = scaling.unflatten(V.feat_mel(spark, sf_dir))
    total = F.aggregate("r", F.lit(0.0), lambda acc, x: acc + x.cast("double"))
    return rows.select("vec_id", F.posexplode("rows").alias("row_no", "r")).select(
        "vec_id",
        "row_no",
        r6(total).alias("row_sum"),
        r6(F.element_at("r", 8).cast("double")).alias("row_last"),
    )


@register(
    "p11_first_filled_column",
    query(
        Q.PRED,
        f"""SELECT event_id, {Q.r6("confidence")} AS value, 'max_proba' AS chosen
        FROM pred WHERE confidence IS NOT NULL""",
    ),
)
def first_filled_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The log has an all-null ``confidence`` column, so the second candidate is taken."""
    rows = V.pred(spark, sf_dir).select(
        "event_id",
        F.lit(None).cast("double").alias("confidence"),
        F.col("confidence").alias("max_proba"),
    )
    chosen = splits.first_filled_column(rows, ["confidence", "max_proba"])
    return rows.where(F.col(chosen).isNotNull()).select(
        "event_id", r6(chosen).alias("value"), F.lit(chosen).alias("chosen")
    )


@register(
    "p12_row_limit",
    query(Q.FEAT_META, "SELECT path, fold, class FROM feat_meta ORDER BY path LIMIT 25"),
)
def row_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return splits.first_rows(V.feat_meta(spark, sf_dir), 25, ["path"]).select("path", "fold", "class")


# --- joins and lookups ---------------------------------------------------------------


@register(
    "j1_label_encode",
    query(
        Q.FEAT_META,
        """known AS (SELECT class, CAST(row_number() OVER (ORDER BY class) - 1 AS INTEGER) AS class_id
                   FROM (SELECT DISTINCT class FROM feat_meta WHERE class <> 'c9'))""",
        "SELECT path, class, class_id FROM feat_meta LEFT JOIN known USING (class)",
    ),
)
def label_encode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The map misses one class, whose rows get a null id in lenient mode."""
    rows = V.feat_meta(spark, sf_dir)
    mapping = L.label_map(rows.where("class <> 'c9'"))
    return L.encode_labels(rows, mapping, strict=False).select("path", "class", "class_id")


_WEIGHTS = """
classes AS (SELECT class, row_number() OVER (ORDER BY class) - 1 AS class_id
            FROM (SELECT DISTINCT class FROM feat_meta)),
cc AS (SELECT class, count(*) AS n FROM feat_meta WHERE fold <= 8 AND class <> 'c3' GROUP BY class),
w AS (SELECT class, class_id, greatest(coalesce(n, 0), 1) AS c FROM classes LEFT JOIN cc USING (class)),
weights AS (SELECT class, CAST(class_id AS INTEGER) AS class_id,
                   (SELECT sum(c) FROM w) / ((SELECT count(*) FROM w) * c) AS weight FROM w)"""


def _weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weights of a training split in which one known class has no rows."""
    rows = V.feat_meta(spark, sf_dir)
    return L.class_weights(rows.where("fold <= 8 AND class <> 'c3'"), L.label_map(rows))


@register(
    "a3_class_weights",
    query(Q.FEAT_META, _WEIGHTS, f"SELECT class, class_id, {Q.r6('weight')} AS weight FROM weights"),
)
def class_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(_weights(spark, sf_dir), "weight")


@register(
    "j2_sample_weights",
    query(
        Q.FEAT_META, _WEIGHTS,
        f"SELECT path, class, {Q.r6('weight')} AS weight FROM feat_meta JOIN weights USING (class)",
    ),
)
def sample_weights(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = V.feat_meta(spark, sf_dir)
    mapping = L.stored_label_map(rows)
    train = rows.where("fold <= 8 AND class <> 'c3'")
    weighted = L.with_sample_weights(
        L.encode_labels(rows, mapping), L.class_weights(train, mapping)
    )
    return rounded(weighted.select("path", "class", "weight"), "weight")


_LABELS = "ids AS (SELECT DISTINCT y_true AS pred, 'c' || y_true AS class FROM vec)"


@register(
    "j3_decode_prediction",
    query(
        Q.SCORES, _LABELS,
        f"SELECT vec_id, class, {Q.r6('confidence')} AS confidence FROM scores JOIN ids USING (pred)",
    ),
)
def decode_prediction(spark: SparkSession, sf_dir: str) -> DataFrame:
    mapping = L.label_map(V.feat_meta(spark, sf_dir))
    scored = V.scores(spark, sf_dir).withColumn("k", F.size("proba"))
    decoded = L.decode_ids(scored, mapping, "pred", "k")
    return decoded.select("vec_id", "class", r6("confidence").alias("confidence"))


@register(
    "j5_path_pairing",
    query(
        Q.FEAT_META,
        """t AS (SELECT path FROM feat_meta WHERE aug_index < 0 OR fold <> 3),
        m AS (SELECT path FROM feat_meta WHERE fold <> 5)""",
        """SELECT CASE WHEN t.path IS NULL THEN 'mel_only' WHEN m.path IS NULL THEN 'tabular_only'
             ELSE 'paired' END AS state, count(*) AS n
        FROM t FULL OUTER JOIN m USING (path) GROUP BY ALL""",
    ),
)
def path_pairing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Consistency of two feature outputs by path; both sides miss some rows here."""
    rows = V.feat_meta(spark, sf_dir)
    tabular = rows.where("aug_index < 0 OR fold <> 3").select("path")
    mels = rows.where("fold <> 5").select("path")
    return L.pairing_states(tabular, mels, "path", "tabular", "mel").groupBy("state").agg(
        F.count(F.lit(1)).alias("n")
    )


@register(
    "j7_expected_match",
    query(
        Q.SCORES,
        """SELECT vec_id || '.wav' AS filename, 'c' || pred AS label, 'c' || y_true AS expected,
             pred = y_true AS matched FROM scores""",
    ),
)
def expected_match(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = V.scores(spark, sf_dir)
    name = F.concat(F.col("vec_id").cast("string"), F.lit(".wav")).alias("filename")
    predictions = scored.select(name, F.concat(F.lit("c"), F.col("pred").cast("string")).alias("label"))
    expected = V.clip_rows(spark, sf_dir).select(
        F.col("slice_file_name").alias("filename"), F.col("class").alias("expected")
    )
    return L.match_expected(predictions, expected, "filename")


# --- aggregates ----------------------------------------------------------------------


@register(
    "a1_class_counts",
    query(Q.FEAT_META, "SELECT class, count(*) AS n FROM feat_meta GROUP BY class"),
)
def class_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.class_counts(V.feat_meta(spark, sf_dir))


@register(
    "a2_label_map",
    query(
        Q.FEAT_META,
        """SELECT class, CAST(row_number() OVER (ORDER BY class) - 1 AS INTEGER) AS class_id
        FROM (SELECT DISTINCT class FROM feat_meta)""",
    ),
)
def label_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    return L.label_map(V.feat_meta(spark, sf_dir))


@register("w3_sorted_labels", query(Q.FEAT_META, "SELECT string_agg(class, ',' ORDER BY class) AS classes FROM (SELECT DISTINCT class FROM feat_meta)"))
def sorted_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    distinct = V.feat_meta(spark, sf_dir).select("class").distinct()
    return distinct.agg(F.array_join(F.sort_array(F.collect_set("class")), ",").alias("classes"))


_SCALER = """
f32 AS (SELECT path, fold, is_augmented, i, CAST(CAST(x AS FLOAT) AS DOUBLE) AS x FROM feat_long),
sc AS (SELECT i, avg(x) AS mean, CASE WHEN stddev_pop(x) > 0 THEN stddev_pop(x) ELSE 1 END AS scale
       FROM f32 WHERE fold <= 8 GROUP BY i)"""


def _scaler(spark: SparkSession, sf_dir: str) -> DataFrame:
    train = splits.fold_set(V.feat(spark, sf_dir), K.TRAIN_FOLDS, include_augmented=True)
    return scaling.fit_scaler(train, V.FEATURES)


@register(
    "a4_scaler_fit",
    query(
        Q.FEAT_LONG, _SCALER,
        f"""SELECT CAST(i AS INTEGER) AS position, 'f' || i AS feature, {Q.r6("mean")} AS mean,
             {Q.r6("scale")} AS scale FROM sc""",
    ),
)
def scaler_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(_scaler(spark, sf_dir), "mean", "scale")


@register(
    "a5_scaler_apply",
    query(
        Q.FEAT_LONG, _SCALER,
        f"""SELECT path, CAST(i AS INTEGER) AS position,
             {"round(CAST(CAST((x - mean) / scale AS FLOAT) AS DOUBLE), 5) + 0.0"} AS z
        FROM f32 JOIN sc USING (i)""",
    ),
)
def scaler_apply(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fitted on the training folds, applied to every row."""
    matrix = scaling.feature_matrix(V.feat(spark, sf_dir), V.FEATURES)
    scaled = scaling.scale_matrix(matrix, _scaler(spark, sf_dir))
    return scaled.select("path", F.posexplode("features").alias("position", "z")).select(
        "path", "position", F.round(F.col("z").cast("double"), 5).alias("z")
    )


_CELLS = """
cells AS (SELECT vec_id, fold, i, CAST(embedding[i + 1] AS DOUBLE) AS x
          FROM vec, (SELECT unnest(range(64)) AS i)),
st AS (SELECT avg(x) AS mean, greatest(stddev_pop(x), 1e-8) AS std FROM cells WHERE fold <= 8)"""


def _mel_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scaling.fit_mel_stats(V.feat_mel(spark, sf_dir).where("fold <= 8"))


@register(
    "a6_mel_statistics",
    query(Q.FEAT_META, _CELLS, f"SELECT {Q.r6('mean')} AS mean, {Q.r6('std')} AS std FROM st"),
)
def mel_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(_mel_stats(spark, sf_dir), "mean", "std")


@register(
    "a7_mel_normalize",
    query(
        Q.FEAT_META, _CELLS.replace(" AS (SELECT", " AS MATERIALIZED (SELECT"),
        f"""SELECT vec_id, CAST(i // 8 AS INTEGER) AS mel_row, {", ".join(
            f"max(CASE WHEN i % 8 = {c} THEN round(CAST(CAST((x - mean) / std AS FLOAT) AS DOUBLE), 5) + 0.0 END) AS z{c}"
            for c in range(8))}
        FROM cells, st GROUP BY vec_id, i // 8""",
    ),
)
def mel_normalize(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = V.feat_mel(spark, sf_dir)
    scaled = scaling.normalize_mels(rows, _mel_stats(spark, sf_dir))
    by_row = F.transform(F.sequence(F.lit(0), F.lit(7)), lambda r: F.slice("mel", r * 8 + 1, 8))
    return scaled.select("vec_id", F.posexplode(by_row).alias("mel_row", "z")).select(
        "vec_id", "mel_row", *(F.round(F.col("z")[c].cast("double"), 5).alias(f"z{c}") for c in range(8))
    )


@register(
    "a9_confidence_quantiles",
    query(
        Q.PRED,
        f"""SELECT CAST(q AS INTEGER) AS q_index, {Q.r6("value")} AS value FROM (
          SELECT unnest(range(101)) AS q,
                 unnest(quantile_cont(confidence, [{", ".join(str(i / 100) for i in range(101))}])) AS value
          FROM pred_ok)""",
    ),
)
def confidence_quantiles(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = V.pred_ok(spark, sf_dir).select("confidence")
    return rounded(exact_quantiles(rows, "confidence", K.N_QUANTILES), "value")


@register(
    "a9_quantile_sketches",
    query(
        Q.PRED,
        """SELECT CAST(q AS INTEGER) AS q_index, n, n_days, TRUE AS within FROM
             (SELECT unnest(range(101)) AS q),
             (SELECT count(*) AS n, count(DISTINCT CAST(ts AS DATE)) AS n_days FROM pred_ok)""",
    ),
)
def quantile_sketches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Confidence quantiles merged from one stored sketch a day; each is checked against the exact ranks of all rows."""
    rows = V.pred_ok(spark, sf_dir).select("confidence", F.to_date("ts").alias("day"))
    path = scratch_path(spark, "day_sketches")
    sketches.quantile_sketches(rows, "confidence", "day").write.parquet(path)
    stored = spark.read.parquet(path)
    merged = sketches.merged_quantiles(stored, K.N_QUANTILES - 1)
    days = stored.agg(F.count(F.lit(1)).alias("n_days"))
    rank, bound = F.col("q_index") / (K.N_QUANTILES - 1), sketches.KLL_RANK_ERROR
    return (
        sketches.rank_errors(rows, "confidence", merged)
        .crossJoin(F.broadcast(merged.select("n")))
        .crossJoin(F.broadcast(days))
        .select(
            F.col("q_index").cast("int").alias("q_index"),
            "n",
            "n_days",
            ((F.col("low") <= rank + bound) & (F.col("high") >= rank - bound)).alias("within"),
        )
    )


@register(
    "a14_distinct_sketches",
    query(
        Q.FEAT_META,
        """SELECT a.fold, count(DISTINCT a.class) AS num_classes,
             count(DISTINCT CASE WHEN b.class IS NOT NULL THEN a.class END) AS shared_with_next,
             count(DISTINCT a.vec_id) AS num_vectors, TRUE AS within
           FROM feat_meta a LEFT JOIN (SELECT DISTINCT fold, class FROM feat_meta) b
             ON b.fold = a.fold + 1 AND b.class = a.class
           GROUP BY a.fold""",
    ),
)
def distinct_sketches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per fold: classes, classes shared with the next fold, and whether the sketched number of vectors is within its bound."""
    rows = V.feat_meta(spark, sf_dir)
    classes = sketches.distinct_sketches(rows, "class", "fold")
    pairs = classes.select("fold", "theta").unionByName(classes.select((F.col("fold") - 1).alias("fold"), "theta"))
    counted = pairs.groupBy("fold").agg(F.count(F.lit(1)).alias("n"))
    shared = sketches.overlap(pairs, "fold").join(counted, "fold").select(
        "fold", F.when(F.col("n") == 2, F.col("n_shared")).otherwise(0).cast("long").alias("shared_with_next")
    )
    vectors = sketches.merged_distinct(sketches.distinct_sketches(rows, "vec_id", "fold", "class"), "fold")
    exact = rows.groupBy("fold").agg(F.countDistinct("vec_id").alias("num_vectors"))
    number = F.theta_sketch_estimate("theta").alias("num_classes")
    error = F.abs(F.col("n_distinct") - F.col("num_vectors"))
    return (
        classes.select("fold", number)
        .join(shared, "fold")
        .join(vectors, "fold")
        .join(exact, "fold")
        .select(
            "fold",
            "num_classes",
            "shared_with_next",
            "num_vectors",
            (error <= F.lit(sketches.HLL_ERROR) * F.col("num_vectors") + 1).alias("within"),
        )
    )


# --- metrics -------------------------------------------------------------------------

_CLASS_METRICS = """
cm AS (SELECT m, fold, y_true AS t, pred AS p, count(*) AS n FROM scores GROUP BY ALL),
sides AS (SELECT m, fold, t AS c, n AS s, 0 AS q, CASE WHEN t = p THEN n ELSE 0 END AS tp FROM cm
          UNION ALL SELECT m, fold, p, 0, n, 0 FROM cm),
per AS (SELECT {keys} c, sum(s) AS s, sum(q) AS q, sum(tp) AS tp FROM sides GROUP BY ALL),
pr AS (SELECT *, CASE WHEN q > 0 THEN tp / q ELSE 0 END AS pre,
              CASE WHEN s > 0 THEN tp / s ELSE 0 END AS rec, 2 * tp / (s + q) AS f1 FROM per),
metrics AS (
  SELECT {keys} sum(tp) / sum(s) AS accuracy, avg(pre) AS precision_macro, avg(rec) AS recall_macro,
         avg(f1) AS f1_macro, sum(pre * s) / sum(s) AS precision_weighted,
         sum(rec * s) / sum(s) AS recall_weighted, sum(f1 * s) / sum(s) AS f1_weighted
  FROM pr {group})"""

_AUC = """
ranked AS (
  SELECT {keys} c, CASE WHEN y_true = c THEN 1 ELSE 0 END AS pos,
         rank() OVER w + (count(*) OVER (PARTITION BY {keys} c, p) - 1) / 2.0 AS r
  FROM scores_long WINDOW w AS (PARTITION BY {keys} c ORDER BY p)),
auc_class AS (
  SELECT {keys} c, (sum(r * pos) - sum(pos) * (sum(pos) + 1) / 2.0)
           / nullif(sum(pos) * sum(1 - pos), 0) AS auc
  FROM ranked GROUP BY {keys} c),
auc AS (SELECT {keys} CASE WHEN count(auc) = 10 THEN avg(auc) ELSE CAST('NaN' AS DOUBLE) END AS roc_auc_ovr
        FROM auc_class {group})"""


def _metrics_sql(*keys: str) -> tuple[str, str]:
    listed = "".join(f"{k}, " for k in keys)
    group = f"GROUP BY {', '.join(keys)}" if keys else ""
    return (
        _CLASS_METRICS.format(keys=listed, group=group),
        _AUC.format(keys=listed, group=group),
    )


_BASIC = K.FOLD_METRICS[:-1]
_ALL = ", ".join(f"{Q.r6(name)} AS {name}" for name in K.FOLD_METRICS)


@register(
    "e1_confusion_matrix",
    query(
        Q.SCORES,
        """grid AS (SELECT CAST(t AS INTEGER) AS t, CAST(p AS INTEGER) AS p
                  FROM (SELECT unnest(range(12)) AS t), (SELECT unnest(range(12)) AS p)),
        c AS (SELECT y_true AS t, pred AS p, count(*) AS n FROM scores GROUP BY ALL)""",
        "SELECT t, p, coalesce(n, 0) AS n FROM grid LEFT JOIN c USING (t, p)",
    ),
)
def confusion_matrix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return E.confusion_matrix(V.scores(spark, sf_dir), 12)


def _basic(spark: SparkSession, sf_dir: str, *names: str) -> DataFrame:
    confusion = E.confusion_counts(V.scores(spark, sf_dir))
    return rounded(E.classification_metrics(confusion).select(*names), *names)


def _basic_sql(*names: str) -> str:
    cols = ", ".join(f"{Q.r6(n)} AS {n}" for n in names)
    return query(Q.SCORES, _metrics_sql()[0], f"SELECT {cols} FROM metrics")


@register("e2_accuracy", _basic_sql("accuracy"))
def accuracy(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _basic(spark, sf_dir, "accuracy")


@register("e3_macro_metrics", _basic_sql("precision_macro", "recall_macro", "f1_macro"))
def macro_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _basic(spark, sf_dir, "precision_macro", "recall_macro", "f1_macro")


@register("e4_weighted_metrics", _basic_sql("precision_weighted", "recall_weighted", "f1_weighted"))
def weighted_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _basic(spark, sf_dir, "precision_weighted", "recall_weighted", "f1_weighted")


@register(
    "e5_roc_auc",
    query(Q.SCORES, _metrics_sql()[1], f"SELECT {Q.r6('roc_auc_ovr')} AS roc_auc_ovr FROM auc"),
)
def roc_auc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(E.roc_auc_ovr(V.scores(spark, sf_dir), 10), "roc_auc_ovr")


@register(
    "e6_fold_metrics",
    query(
        Q.SCORES, *_metrics_sql("fold"), f"SELECT fold, {_ALL} FROM metrics JOIN auc USING (fold)"
    ),
)
def fold_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rounded(E.fold_metrics(V.scores(spark, sf_dir), 10), *K.FOLD_METRICS)


@register(
    "e11_top_class",
    query(Q.SCORES, f"SELECT vec_id, pred, {Q.r6('confidence')} AS confidence FROM scores"),
)
def top_class(spark: SparkSession, sf_dir: str) -> DataFrame:
    return V.scores(spark, sf_dir).select("vec_id", "pred", r6("confidence").alias("confidence"))


_UNPIVOT = " UNION ALL ".join(
    f"SELECT m, fold, '{n}' AS metric, {n} AS value FROM metrics" for n in _BASIC
)
# Undefined values (no positives in a fold) are NaN and must not enter the mean.
_FOLDS = f"""
values_long AS ({_UNPIVOT} UNION ALL SELECT m, fold, 'roc_auc_ovr', roc_auc_ovr FROM auc),
cv AS (SELECT m, metric, avg(value) AS mean, stddev_pop(value) AS std FROM values_long
       WHERE isfinite(value) GROUP BY m, metric)"""


@register(
    "a12_fold_aggregate",
    query(
        Q.SCORES, *_metrics_sql("m", "fold"), _FOLDS,
        f"SELECT metric, {Q.r6('mean')} AS mean, {Q.r6('std')} AS std FROM cv",
    ),
)
def fold_aggregate(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = E.fold_aggregate(E.fold_metrics(V.scores(spark, sf_dir), 10))
    return rounded(table, "mean", "std")


# --- model selection: six models scored on the same rows -----------------------------


def run_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One result row per model: holdout metrics on fold 10; even models also have CV values.

    The table has one row per model, so everything after the confusion counts is tiny.
    """
    counts = E.confusion_counts(
        V.model_scores(spark, sf_dir), group=["position", "model_name", "fold"]
    )
    keys = ["position", "model_name"]
    by_fold = E.classification_metrics(counts, [*keys, "fold"])
    cross = by_fold.groupBy(*keys).agg(
        F.avg("f1_macro").alias("mean"),
        F.stddev_pop("f1_macro").alias("std"),
        F.max(F.when(F.col("fold") == K.EVAL_FOLD, F.col("f1_macro"))).alias("f1"),
        F.max(F.when(F.col("fold") == K.EVAL_FOLD, F.col("accuracy"))).alias("acc"),
    )
    holdout = F.create_map(F.lit("f1_macro"), F.col("f1"), F.lit("accuracy"), F.col("acc"))
    with_cv = F.map_concat(
        holdout,
        F.create_map(
            F.lit("cv_f1_macro_mean"), F.col("mean"), F.lit("cv_f1_macro_std"), F.col("std")
        ),
    )
    bare = F.create_map().cast("map<string,double>")
    return cross.select(
        *keys,
        F.concat(F.lit("run-"), F.col("model_name")).alias("run_id"),
        # Model 5 recorded nothing, odd models only the holdout, even ones also CV.
        F.when(F.col("position") == 5, bare)
        .when(F.col("position") % 2 == 0, with_cv)
        .otherwise(holdout)
        .alias("metrics"),
        F.struct(F.lit("clips").alias("dataset_id"), F.lit("tabular").alias("artifact")).alias(
            "dataset"
        ),
    )


_RESULTS = f"""
res AS (
  SELECT m, avg(f1_macro) AS cv_mean, stddev_pop(f1_macro) AS cv_std,
         max(CASE WHEN fold = 10 THEN f1_macro END) AS f1 FROM metrics GROUP BY m),
board AS (
  SELECT m, 'm' || m AS model_name, 'run-m' || m AS run_id, cv_mean, cv_std, f1,
         CASE WHEN m = 5 THEN CAST('-Infinity' AS DOUBLE) WHEN m % 2 = 0 THEN cv_mean ELSE f1 END AS score
  FROM res)"""
_MODEL_METRICS = _metrics_sql("m", "fold")[0]


@register(
    "e7_result_score",
    query(
        Q.MODEL_SCORES, _MODEL_METRICS, _RESULTS,
        "SELECT model_name, CASE WHEN isfinite(score) THEN round(score, 6) ELSE -1.0 END AS score FROM board",
    ),
)
def result_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Minus infinity is shown as -1 here."""
    score = E.result_score()
    return run_results(spark, sf_dir).select(
        "model_name", F.when(C.is_finite(score), r6(score)).otherwise(-1.0).alias("score")
    )


@register(
    "e8_select_winner",
    query(
        Q.MODEL_SCORES, _MODEL_METRICS, _RESULTS,
        f"""SELECT model_name, run_id, {Q.r6("score")} AS score, {Q.r6("f1")} AS f1_macro,
             CASE WHEN m % 2 = 0 THEN {Q.r6("cv_mean")} END AS cv_f1_macro_mean,
             CASE WHEN m % 2 = 0 THEN {Q.r6("cv_std")} END AS cv_f1_macro_std, 'clips' AS dataset_id
        FROM board ORDER BY board.score DESC, m LIMIT 1""",
    ),
)
def select_winner(spark: SparkSession, sf_dir: str) -> DataFrame:
    winner = E.select_winner(run_results(spark, sf_dir))
    flat = winner.withColumn("dataset_id", F.col("dataset.dataset_id")).drop("dataset")
    return rounded(flat, "score", "f1_macro", "cv_f1_macro_mean", "cv_f1_macro_std")


@register(
    "e9_leaderboard",
    query(
        Q.MODEL_SCORES, _MODEL_METRICS, _RESULTS,
        """b AS (SELECT *, row_number() OVER (ORDER BY score DESC, m) AS place FROM board)""",
        """SELECT model_name, CAST(place AS INTEGER) AS place, place = 1 AS winner FROM b""",
    ),
)
def leaderboard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return E.leaderboard(run_results(spark, sf_dir)).select("model_name", "place", "winner")


@register(
    "e9_registry_tags",
    query(
        Q.MODEL_SCORES, _MODEL_METRICS, _RESULTS,
        """b AS (SELECT *, row_number() OVER (ORDER BY score DESC, m) AS place FROM board)""",
        """SELECT model_name, 'winner' AS tag, CASE WHEN place = 1 THEN 'true' ELSE 'false' END AS value FROM b
        UNION ALL SELECT model_name, 'alias', 'production' FROM b WHERE place = 1
        UNION ALL SELECT model_name, 'champion_run', run_id FROM b
        UNION ALL SELECT model_name, 'f1_macro', CASE WHEN m = 5 THEN 'NaN' ELSE format('{:.6f}', f1) END FROM b""",
    ),
)
def registry_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return E.registry_tags(E.leaderboard(run_results(spark, sf_dir)))


@register(
    "e10_best_trial",
    query(
        Q.MODEL_SCORES, _MODEL_METRICS,
        """trials AS (SELECT m * 10 + fold AS number, f1_macro AS value,
                    CASE WHEN fold % 4 = 0 THEN 'FAIL' ELSE 'COMPLETE' END AS state, m, fold FROM metrics)""",
        f"""SELECT number, {Q.r6("value")} AS value, CAST(m AS VARCHAR) AS param_offset,
             (SELECT count(*) FROM trials WHERE state = 'COMPLETE') AS n_complete
        FROM trials WHERE state = 'COMPLETE' ORDER BY trials.value DESC, number LIMIT 1""",
    ),
)
def best_trial(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trials are the (model, fold) pairs; every fourth fold counts as a failed trial."""
    keys = ["position", "fold"]
    counts = E.confusion_counts(V.model_scores(spark, sf_dir), group=keys)
    trials = E.classification_metrics(counts, keys).select(
        (F.col("position") * 10 + F.col("fold")).alias("number"),
        F.col("f1_macro").alias("value"),
        F.when(F.col("fold") % 4 == 0, "FAIL").otherwise("COMPLETE").alias("state"),
        F.create_map(F.lit("offset"), F.col("position").cast("string")).alias("params"),
    )
    best = E.best_trial(trials)
    return best.select(
        "number", r6("value").alias("value"), F.element_at("params", "offset").alias("param_offset"), "n_complete"
    )


@register(
    "w2_first_maximum",
    query(
        Q.SCORES,
        f"""SELECT fold, vec_id, {Q.r6("confidence")} AS confidence FROM scores
        QUALIFY row_number() OVER (PARTITION BY fold ORDER BY round(scores.confidence, 2) DESC, vec_id) = 1""",
    ),
)
def first_maximum(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first row with the largest rounded confidence, by an aggregate and not a sort."""
    best = V.scores(spark, sf_dir).groupBy("fold").agg(
        F.max_by(
            F.struct("vec_id", "confidence"),
            F.struct(F.round("confidence", 2), -F.col("vec_id")),
        ).alias("b")
    )
    return best.select("fold", "b.vec_id", r6("b.confidence").alias("confidence"))


@register(
    "w5_originals_and_copies",
    query(
        Q.FEAT_META,
        "SELECT is_augmented, fold, count(*) AS n FROM feat_meta GROUP BY ALL",
    ),
)
def originals_and_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = V.clip_rows(spark, sf_dir)
    plain = rows.select("path", "fold", F.lit(False).alias("is_augmented"))
    copies = rows.where("fold <> 10").select(
        F.concat("path", F.lit("_aug0")).alias("path"), "fold", F.lit(True).alias("is_augmented")
    )
    return plain.unionByName(copies).groupBy("is_augmented", "fold").agg(
        F.count(F.lit(1)).alias("n")
    )
