"""Sources, sinks, incremental bookkeeping, contracts and manifests."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clipward import constants as K
from clipward.functions import columns as C
from clipward.operators import drift, quality, splits
from clipward.operators import labels as L
from clipward.plans import sql_views as Q
from clipward.plans import views as V
from clipward.plans.drift_queries import prediction_reference
from clipward.plans.registry import r6, register, rounded
from clipward.plans.sql_views import query
from clipward.session import scratch_path
from clipward.sources import fingerprints, incremental, prediction_log, reference_store, tables


def raw_clip_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contract columns over the vector table, plus one column a scan must not read."""
    rows = V.clip_rows(spark, sf_dir)
    return rows.select(
        F.struct(F.lit(None).cast("binary").alias("bytes"), F.col("path")).alias("audio"),
        "slice_file_name",
        (F.col("vec_id") + 1000).alias("fsID"),
        F.lit(0.0).alias("start"),
        (F.col("vec_id") % 4 + 1).cast("double").alias("end"),
        (F.col("vec_id") % 2 + 1).alias("salience"),
        "fold",
        "classID",
        "class",
        F.lit("unused").alias("comment"),
    )


@register(
    "s1_raw_clip_scan",
    query(
        Q.FEAT_META,
        """SELECT vec_id || '.wav' AS slice_file_name, vec_id + 1000 AS "fsID", 0.0::DOUBLE AS "start",
             CAST(vec_id % 4 + 1 AS DOUBLE) AS "end", vec_id % 2 + 1 AS salience, fold, classID AS "classID",
             class FROM vec""",
    ),
)
def raw_clip_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.project_raw_clips(raw_clip_table(spark, sf_dir)).drop("audio")


@register(
    "s2_feature_scan",
    query(
        Q.FEAT_LONG,
        f"""SELECT path, fold, class, {Q.r6("max(CASE WHEN i = 0 THEN x END)")} AS f0,
             {Q.r6("max(CASE WHEN i = 63 THEN x END)")} AS f63
        FROM feat_long GROUP BY path, fold, class""",
    ),
)
def feature_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feature table written once by fold, then a scan of five of its columns."""
    path = scratch_path(spark, "features")
    incremental.write_new_partitions(V.feat(spark, sf_dir).hint("rebalance", "fold"), path)
    rows = tables.read_features(spark, path, ["path", "fold", "class", "f0", "f63"])
    rows = rows.withColumn("fold", F.col("fold").cast("long"))
    return rounded(rows, "f0", "f63")


def _line(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log lines of every shape a reader meets, chosen by the ``k`` of the event."""
    kind = F.col("k") % 20
    plain = prediction_log.log_line(
        ts=F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"),
        status=F.when(kind != 2, F.col("status")),
        label=F.col("label"),
        confidence=F.when(kind != 3, F.col("confidence")),
        model_name=F.col("model_name"),
        latency_s=F.col("latency_s"),
        filename=F.concat(F.col("event_id").cast("string"), F.lit(".wav")),
        event=F.when(kind == 6, F.lit("health")).when(kind != 0, F.lit("prediction")),
    )
    text = (
        F.when(kind == 1, F.regexp_replace(plain, '"status":[^,]*,', ""))
        .when(kind == 4, F.concat(F.lit("["), plain, F.lit("]")))
        .when(kind == 5, F.lit("   "))
        .otherwise(plain)
    )
    return V.pred(spark, sf_dir).select("event_id", text.alias("value"))


@register(
    "s3_prediction_log_scan",
    query(
        Q.PRED,
        f"""SELECT event_id, label, {Q.r6("CASE WHEN k % 20 = 3 THEN 0 ELSE confidence END")} AS confidence,
             model_name
        FROM pred WHERE k % 20 NOT IN (2, 4, 5, 6) AND status = 'ok'""",
    ),
)
def prediction_log_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "log")
    prediction_log.write_log(_line(spark, sf_dir), path)
    parsed = prediction_log.read_log(spark, path)
    key = F.regexp_extract("filename", r"^(\d+)", 1).cast("long").alias("event_id")
    return rounded(parsed.select(key, "label", "confidence", "model_name"), "confidence")


@register(
    "s4_confidence_scan",
    query(
        Q.PRED,
        f"""SELECT count(*) AS n, {Q.r6("avg(confidence)")} AS mean, {Q.r6("max(confidence)")} AS high
        FROM pred_ok WHERE k % 10 <> 0""",
    ),
)
def confidence_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.concat(F.lit(" "), F.col("confidence").cast("string"), F.lit(" "))
    lines = V.pred_ok(spark, sf_dir).select(
        F.when(F.col("k") % 10 == 0, F.lit("  ")).otherwise(text).alias("value")
    )
    return prediction_log.parse_confidences(lines).agg(
        F.count(F.lit(1)).alias("n"),
        r6(F.avg("confidence")).alias("mean"),
        r6(F.max("confidence")).alias("high"),
    )


_NAMES = ", ".join(f"({i}, '{c}')" for i, c in enumerate(K.CLASS_NAMES))


@register(
    "s5_class_folder_scan",
    query(
        Q.FEAT_META,
        f"""names AS (SELECT * FROM (VALUES {_NAMES}) AS t(id, name))""",
        """SELECT CAST(id AS INTEGER) AS class_position, name AS expected, vec_id || '.wav' AS file_name
        FROM vec JOIN names ON id = classID
        WHERE vec_id % 11 NOT IN (0, 1)""",
    ),
)
def class_folder_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A listing with files at the top level and in unknown folders, which are ignored."""
    names = F.lit(list(K.CLASS_NAMES))
    folder = F.element_at(names, F.col("classID").cast("int") + 1)
    kind = F.col("vec_id") % 11
    path = F.concat_ws(
        "/",
        F.lit("file:/clips"),
        F.when(kind == 0, F.lit(None)).when(kind == 1, F.lit("other")).otherwise(folder),
        F.col("slice_file_name"),
    )
    files = V.clip_rows(spark, sf_dir).select(path.alias("path"))
    return tables.class_folder_clips(files).select("class_position", "expected", "file_name")


@register(
    "s10_prediction_log_sink",
    query(
        Q.PRED,
        """SELECT event_id, status, label, round(latency_s * 1000, 3) + 0.0 AS latency_ms,
             event_id || '.wav' AS filename, CAST(8 AS INTEGER) AS n_keys FROM pred""",
    ),
)
def prediction_log_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines written as text and read back as JSON."""
    line = prediction_log.log_line(
        ts=F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"),
        status=F.col("status"),
        label=F.col("label"),
        confidence=F.col("confidence"),
        model_name=F.col("model_name"),
        latency_s=F.col("latency_s"),
        filename=F.concat(F.col("event_id").cast("string"), F.lit(".wav")),
    )
    path = scratch_path(spark, "log")
    prediction_log.write_log(V.pred(spark, sf_dir).select(line.alias("value")), path)
    text = spark.read.text(path)
    field = lambda name: F.get_json_object("value", f"$.{name}")
    return text.select(
        F.regexp_extract(field("filename"), r"^(\d+)", 1).cast("long").alias("event_id"),
        field("status").alias("status"),
        field("label").alias("label"),
        field("latency_ms").cast("double").alias("latency_ms"),
        field("filename").alias("filename"),
        F.size(F.json_object_keys("value")).alias("n_keys"),
    )


@register(
    "s11_reference_round_trip",
    query(
        Q.PRED,
        """c AS (SELECT label, count(*) AS n FROM ref GROUP BY label)""",
        f"""SELECT label, n, {Q.r6("n / sum(n) OVER ()")} AS prior, CAST(101 AS INTEGER) AS n_quantiles,
             {Q.r6("(SELECT max(confidence) FROM ref)")} AS top FROM c""",
    ),
)
def reference_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stored without its prior, which the reader recomputes from the counts."""
    path = scratch_path(spark, "reference")
    row = drift.reference_row(spark, prediction_reference(spark, sf_dir))
    reference_store.dump_reference(row.drop("class_prior", "feature_histograms"), path)
    loaded = reference_store.read_reference(spark, path)
    exploded = loaded.select(
        F.explode("class_counts").alias("label", "n"), "class_prior", "confidence_quantiles"
    )
    return exploded.select(
        "label",
        "n",
        r6(F.element_at("class_prior", F.col("label"))).alias("prior"),
        F.size("confidence_quantiles").alias("n_quantiles"),
        r6(F.element_at("confidence_quantiles", -1)).alias("top"),
    )


@register(
    "s12_source_chain",
    query(
        Q.FEAT_META,
        """SELECT 'interim_metadata' AS source, class, count(*) AS n FROM feat_meta
        WHERE fold = 10 AND NOT is_augmented GROUP BY class""",
    ),
)
def source_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first table has no original rows in the fold, the path of the next is missing."""
    copies = lambda: V.feat_meta(spark, sf_dir).where("is_augmented")
    missing = reference_store.existing_table(spark, scratch_path(spark, "missing"))
    rows, source = reference_store.first_source(
        [
            ("processed_tabular", copies),
            ("older_run", missing),
            ("interim_metadata", lambda: V.feat_meta(spark, sf_dir)),
        ]
    )
    return L.class_counts(rows).select(F.lit(source).alias("source"), "class", "n")


@register(
    "s13_label_log",
    query(
        Q.FEAT_META,
        """SELECT class AS label, 0.0::DOUBLE AS confidence FROM feat_meta
        WHERE fold = 10 AND NOT is_augmented""",
    ),
)
def label_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class counts of the evaluation fold expanded to a log, then read as a log."""
    rows = splits.fold_originals(V.feat_meta(spark, sf_dir), K.EVAL_FOLD)
    lines = prediction_log.label_log(L.class_counts(rows))
    return prediction_log.parse_log(lines.select("value")).select("label", "confidence")


def _done(rows: DataFrame) -> DataFrame:
    """What an earlier run recorded: folds 1 to 6, fold 4 under an old revision."""
    return rows.where("fold <= 6").select(
        "path", F.when(F.col("fold") == 4, "r1").otherwise("r2").alias("revision")
    )


_DONE = """
done AS (SELECT path, CASE WHEN fold = 4 THEN 'r1' ELSE 'r2' END AS revision FROM feat_meta WHERE fold <= 6)"""


@register(
    "s14_pending_work",
    query(
        Q.FEAT_META, _DONE,
        """SELECT path, fold FROM feat_meta f WHERE NOT EXISTS
             (SELECT 1 FROM done d WHERE d.path = f.path AND d.revision = 'r2')""",
    ),
)
def pending_work(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = V.feat_meta(spark, sf_dir)
    inputs = rows.withColumn("revision", F.lit("r2"))
    return incremental.pending(inputs, _done(rows), ["path"], "revision").select("path", "fold")


@register(
    "s14_stage_completeness",
    query(
        Q.FEAT_META,
        """have AS (SELECT DISTINCT 'fold' || fold AS stage, CASE WHEN is_augmented THEN 'mels' ELSE 'tabular' END
                  AS output FROM feat_meta),
        need AS (SELECT * FROM (VALUES ('fold8'), ('fold9'), ('fold10'), ('fold11')) s(stage),
                 (VALUES ('tabular'), ('mels')) o(output))""",
        """SELECT stage, bool_and(have.stage IS NOT NULL) AS complete
        FROM need LEFT JOIN have USING (stage, output) GROUP BY need.stage""".replace(
            "SELECT stage,", "SELECT need.stage AS stage,"
        ),
    ),
)
def stage_completeness(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = V.feat_meta(spark, sf_dir)
    outputs = rows.select(
        F.concat(F.lit("fold"), F.col("fold").cast("string")).alias("stage"),
        F.when(F.col("is_augmented"), "mels").otherwise("tabular").alias("output"),
    )
    need = {f"fold{i}": ["tabular", "mels"] for i in (8, 9, 10, 11)}
    return incremental.complete_stages(outputs, need)


@register(
    "j8_new_work_join",
    query(
        Q.FEAT_META, _DONE,
        """SELECT fold, count(*) AS n FROM feat_meta f
        WHERE NOT EXISTS (SELECT 1 FROM done d WHERE d.path = f.path) GROUP BY fold""",
    ),
)
def new_work_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = V.feat_meta(spark, sf_dir)
    todo = incremental.pending(rows, _done(rows), ["path"])
    return todo.groupBy("fold").agg(F.count(F.lit(1)).alias("n"))


# --- contracts and manifests ---------------------------------------------------------


@register(
    "v1_contract_report",
    query(
        Q.FEAT_META,
        """s AS (SELECT count(*) AS n, min(fold) AS lo, max(fold) AS hi, count(DISTINCT class) AS k FROM vec)""",
        """SELECT CAST(1 AS INTEGER) AS position, 'row_count' AS rule, n AS observed, n AS expected, TRUE AS ok FROM s
        UNION ALL SELECT 2, 'fold_min', lo, 1, lo >= 1 FROM s
        UNION ALL SELECT 3, 'fold_max', hi, 9, hi <= 9 FROM s
        UNION ALL SELECT 4, 'class_count', k, 10, k = 10 FROM s""",
    ),
)
def contract_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One rule (the upper fold bound) is set to fail."""
    rows = V.clip_rows(spark, sf_dir)
    return quality.contract_report(rows, expected_rows=rows.count(), fold_range=(1, 9))


@register(
    "a14_table_statistics",
    query(
        Q.FEAT_META,
        """SELECT count(*) AS num_rows, min(fold) AS fold_min, max(fold) AS fold_max,
             count(DISTINCT class) AS num_classes FROM feat_meta""",
    ),
)
def table_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.table_statistics(V.feat_meta(spark, sf_dir))


@register(
    "v2_required_columns",
    query(
        Q.FEAT_LONG,
        f"""SELECT fold, CAST(64 AS INTEGER) AS n_columns, {Q.r6("sum(x)")} AS total
        FROM feat_long GROUP BY fold""",
    ),
)
def required_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = V.feat(spark, sf_dir)
    names = quality.require_columns(rows, V.FEATURES)
    row_sum = F.aggregate(F.array(*names), F.lit(0.0), lambda acc, x: acc + x)
    return rows.groupBy("fold").agg(
        F.lit(len(names)).alias("n_columns"), r6(F.sum(row_sum)).alias("total")
    )


@register(
    "v3_available_columns",
    query(
        Q.FEAT_LONG,
        f"""SELECT path, {Q.r6("max(CASE WHEN i = 2 THEN x END)")} AS f2,
             {Q.r6("max(CASE WHEN i = 5 THEN x END)")} AS f5
        FROM feat_long GROUP BY path""",
    ),
)
def available_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = V.feat(spark, sf_dir)
    names = quality.available_columns(rows, ["f2", "mfcc_0_mean", "f5", "f64"])
    return rounded(rows.select("path", *names), *names)


@register(
    "v5_upload_rules",
    query(
        Q.UPLOADS,
        """SELECT page_id,
             CASE WHEN size = 0 THEN 'http_400' WHEN size > 6000 THEN 'http_413'
               WHEN NOT (lower(filename) LIKE '%.wav' AND lower(filename) NOT LIKE '%/.wav')
                 AND lower(trim(split_part(coalesce(content_type, ''), ';', 1)))
                     NOT IN ('audio/wav', 'audio/x-wav', 'audio/wave') THEN 'http_400'
               WHEN page_id % 17 = 0 THEN 'http_503' WHEN page_id % 13 = 0 THEN 'error'
               ELSE 'ok' END AS status FROM up""",
    ),
)
def upload_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A limit of 6,000 bytes, so that some pages are too large.

    A name that is only ".wav" is a hidden file without a suffix.
    """
    status = C.upload_status(
        F.col("filename"),
        F.col("content_type"),
        F.col("size"),
        model_ready=F.col("page_id") % 17 != 0,
        decodes=F.col("page_id") % 13 != 0,
        max_bytes=6000,
    )
    return V.uploads(spark, sf_dir).select("page_id", status.alias("status"))


@register(
    "v6_interim_manifest",
    query(
        Q.FEAT_META,
        """c AS (SELECT class, count(*) AS n FROM feat_meta WHERE NOT is_augmented GROUP BY class)""",
        """SELECT count(*) AS num_rows_written, count(*) FILTER (WHERE NOT is_augmented) AS num_original,
             count(*) FILTER (WHERE is_augmented) AS num_augmented,
             count(*) FILTER (WHERE fold <> 10) AS num_train_rows,
             count(*) FILTER (WHERE fold = 10 AND NOT is_augmented) AS num_eval_rows,
             CAST(7 AS BIGINT) AS num_dropped,
             (SELECT string_agg(class || '=' || n, ',' ORDER BY class) FROM c) AS class_counts
        FROM feat_meta""",
    ),
)
def interim_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    row = quality.interim_manifest(V.feat_meta(spark, sf_dir), dropped=7)
    entries = F.transform(
        F.map_entries("class_counts_all"),
        lambda e: F.concat(e["key"], F.lit("="), e["value"].cast("string")),
    )
    return row.withColumn("class_counts", F.array_join(entries, ",")).drop("class_counts_all")


@register("v8_file_fingerprints")
def file_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = fingerprints.list_files(spark, sf_dir, "*.parquet")
    return fingerprints.fingerprint_files(files).select(
        C.file_name(F.col("path")).alias("file"), "exists", "size_bytes", "sha256", "digest_mode"
    )


@register("v9_content_fingerprint")
def content_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.content_fingerprint(V.table(spark, sf_dir, "lineitem"))


@register(
    "v10_lineage_row",
    query(
        Q.FEAT_META,
        """SELECT 'r2' AS raw_revision, CAST(NULL AS VARCHAR) AS raw_downloaded_at,
             CAST(NULL AS VARCHAR) AS interim_created_at, CAST(NULL AS BIGINT) AS interim_num_rows,
             '2024-01-02' AS processed_created_at,
             (SELECT count(*) FROM feat_meta WHERE fold <> 3) AS processed_num_rows,
             (SELECT count(*) FROM feat_meta) AS processed_num_input_rows,
             sha256(CAST((SELECT count(*) FROM feat_meta) AS VARCHAR)) AS tabular_sha256,
             CAST(NULL AS VARCHAR) AS mels_sha256""",
    ),
)
def lineage_row(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The interim manifest and the mel artifact are missing."""
    rows = V.feat_meta(spark, sf_dir)
    counts = rows.agg(
        F.count(F.lit(1)).alias("num_input_rows"), F.count_if(F.col("fold") != 3).alias("num_rows")
    )
    text = lambda value: F.lit(value).cast("string")
    processed = counts.select(
        F.lit("processed").alias("stage"), text(None).alias("revision"),
        F.lit("2024-01-02").alias("created_at"), "num_rows", "num_input_rows",
    )
    raw = counts.select(
        F.lit("raw").alias("stage"), F.lit("r2").alias("revision"), text(None).alias("created_at"),
        F.col("num_input_rows").alias("num_rows"), F.lit(None).cast("long").alias("num_input_rows"),
    )
    digests = counts.select(
        F.lit("tabular").alias("artifact"),
        F.sha2(F.col("num_input_rows").cast("string"), 256).alias("sha256"),
    )
    return quality.lineage_row(raw.unionByName(processed), digests)
