"""Typed views over the given tables: feature rows, scored rows, a prediction log, uploads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clipward.operators.evaluation import top_class

N_FEATURES = 64
FEATURES = [f"f{i}" for i in range(N_FEATURES)]
PRED_CLASSES = ("click", "purchase", "signup", "view")
LINE_FEATURES = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")
LINE_CUT = "1998-06-01"
PRED_CUT = "2024-01-11"
N_MODELS = 6


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id"),
        "embedding",
        F.concat(F.lit("c"), F.col("label").cast("string")).alias("class"),
        F.col("label").cast("long").alias("classID"),
        (F.col("vec_id") % 10 + 1).alias("fold"),
    )


def _copies(fold: Column) -> Column:
    """-1 is the original; folds other than 10 also have augmented copy 0."""
    return F.explode(F.when(fold != 10, F.array(F.lit(-1), F.lit(0))).otherwise(F.array(F.lit(-1))))


def clip_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Original rows only, without features."""
    return _vectors(spark, sf_dir).select(
        "vec_id",
        F.concat(F.lit("audio/"), F.col("vec_id").cast("string")).alias("path"),
        F.concat(F.col("vec_id").cast("string"), F.lit(".wav")).alias("slice_file_name"),
        "fold",
        "class",
        "classID",
    )


def feat_meta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feature-table rows (originals and augmented twins), meta columns only."""
    return _expand(_vectors(spark, sf_dir)).drop("embedding")


def _expand(df: DataFrame) -> DataFrame:
    stem = F.concat(F.lit("audio/"), F.col("vec_id").cast("string"))
    twin = F.col("aug_index") >= 0
    return (
        df.withColumn("aug_index", _copies(F.col("fold")))
        .withColumn("aug_index", F.col("aug_index").cast("long"))
        .withColumn("is_augmented", twin)
        .withColumn(
            "path",
            F.when(twin, F.concat(stem, F.lit("_aug"), F.col("aug_index").cast("string"))).otherwise(
                stem
            ),
        )
    )


def feat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wide feature table: 64 doubles, twins shifted by 0.1."""
    shift = F.when(F.col("is_augmented"), F.lit(0.1)).otherwise(F.lit(0.0))
    rows = _expand(_vectors(spark, sf_dir))
    return rows.withColumns(
        {
            name: F.element_at("embedding", i + 1).cast("double") + shift
            for i, name in enumerate(FEATURES)
        }
    ).drop("embedding")


def feat_mel(spark: SparkSession, sf_dir: str, height: int = 8, width: int = 8) -> DataFrame:
    """Originals with the vector as a flat height x width matrix."""
    return _vectors(spark, sf_dir).select(
        "vec_id",
        F.concat(F.lit("audio/"), F.col("vec_id").cast("string")).alias("path"),
        "fold",
        "class",
        F.col("embedding").alias("mel"),
        F.lit(height).alias("mel_height"),
        F.lit(width).alias("mel_width"),
    )


def softmax(values: Column) -> Column:
    shifted = F.transform(values, lambda v: F.exp(v.cast("double")))
    total = F.aggregate(shifted, F.lit(0.0), lambda acc, v: acc + v)
    return F.transform(shifted, lambda v: v / total)


def scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ten class probabilities per row from the first ten elements."""
    rows = _vectors(spark, sf_dir).select(
        "vec_id",
        "fold",
        F.col("classID").cast("int").alias("y_true"),
        softmax(F.slice("embedding", 1, 10)).alias("proba"),
    )
    return top_class(rows)


def model_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same rows scored by six models, each reading its own ten elements."""
    rows = (
        _vectors(spark, sf_dir)
        .withColumn("position", F.explode(F.sequence(F.lit(0), F.lit(N_MODELS - 1))))
        .select(
            "vec_id",
            "fold",
            "position",
            F.concat(F.lit("m"), F.col("position").cast("string")).alias("model_name"),
            F.col("classID").cast("int").alias("y_true"),
            softmax(F.slice("embedding", F.col("position") * 10 + 1, 10)).alias("proba"),
        )
    )
    return top_class(rows)


def signal(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A 64-sample signal per vector, centred on its own mean."""
    total = F.aggregate("embedding", F.lit(0.0), lambda acc, v: acc + v.cast("double"))
    return (
        table(spark, sf_dir, "embeddings")
        .select("vec_id", "embedding", (total / F.size("embedding")).alias("m"))
        .select(
            "vec_id",
            F.transform("embedding", lambda v: (v.cast("double") - F.col("m")).cast("float")).alias(
                "y"
            ),
        )
    )


def pred(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The prediction log as a table."""
    ok = F.col("event_type") != "error"
    k = F.get_json_object("props", "$.k").cast("int")
    return table(spark, sf_dir, "events").select(
        "event_id",
        "ts",
        "user_id",
        k.alias("k"),
        F.when(ok, F.col("event_type")).alias("label"),
        F.when(ok, F.lit("ok"))
        .when(k % 2 == 0, F.lit("http_400"))
        .otherwise(F.lit("error"))
        .alias("status"),
        F.when(ok, 1 - F.exp(-F.col("value") / 50)).alias("confidence"),
        (F.col("value") / 100).alias("latency_s"),
        F.concat(F.lit("m"), (F.col("user_id") % 3).cast("string")).alias("model_name"),
    )


def pred_ok(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pred(spark, sf_dir).where(F.col("status") == "ok")


def reference_and_live(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    cut = F.lit(PRED_CUT).cast("timestamp_ntz")
    return df.where(F.col("ts") < cut), df.where(F.col("ts") >= cut)


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_shipdate", *LINE_FEATURES
    )


def line_reference_and_live(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    cut = F.lit(LINE_CUT).cast("timestamp_ntz")
    return df.where(F.col("l_shipdate") < cut), df.where(F.col("l_shipdate") >= cut)


def uploads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Web pages as upload requests with a mix of content types."""
    kind = F.col("page_id") % 4
    return table(spark, sf_dir, "pages").select(
        "page_id",
        F.when(F.col("page_id") % 3 == 0, F.concat("url", F.lit(".WAV")))
        .otherwise(F.col("url"))
        .alias("filename"),
        F.octet_length("html").alias("size"),
        F.when(kind == 0, " Audio/WAV ; rate=16000")
        .when(kind == 1, "text/html")
        .when(kind == 2, "audio/x-wav")
        .alias("content_type"),
    )
