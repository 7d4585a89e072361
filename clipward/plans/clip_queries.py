"""Clip jobs on rendered clips, and their kernels on short signals."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clipward import constants as K
from clipward import schemas as S
from clipward.functions import columns as C
from clipward.functions import series, signal
from clipward.operators import clip_jobs, quality
from clipward.plans import sql_views as Q
from clipward.plans import views as V
from clipward.plans.clip_fixture import CLIPS_SQL, raw_clips
from clipward.plans.registry import r6, register, rounded
from clipward.plans.sql_views import query
from clipward.session import scratch_path, stable
from clipward.sources import tables


def interim(spark: SparkSession, sf_dir: str, copies: int = K.AUGMENT_COPIES) -> DataFrame:
    return clip_jobs.clean_and_augment(raw_clips(spark, sf_dir), copies=copies)


def stored_interim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Interim clips written once, so that later jobs do not clean them again."""
    path = scratch_path(spark, "interim")
    tables.write_interim(quality.good_rows(interim(spark, sf_dir)), path)
    rows = spark.read.parquet(path)
    return rows.withColumns({c: F.col(c).cast("long") for c in ("fold", "aug_index")})


def stored_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Features of originals and copies, written once."""
    path = scratch_path(spark, "features")
    rows = quality.good_rows(interim(spark, sf_dir)).withColumn(
        "aug_index", F.col("aug_index").cast("long")
    )
    quality.good_rows(clip_jobs.extract_features(rows)).write.parquet(path)
    return spark.read.parquet(path)


def originals(spark: SparkSession, sf_dir: str, **kinds) -> DataFrame:
    """Features of cleaned originals, without copies; ``kinds`` says which."""
    rows = quality.good_rows(interim(spark, sf_dir, copies=0))
    rows = rows.withColumn("aug_index", F.col("aug_index").cast("long"))
    return clip_jobs.extract_features(rows, **kinds)


def _key() -> Column:
    return F.regexp_extract("slice_file_name", r"^(\d+)", 1).cast("long").alias("vec_id")


_PAYLOADS = """
payload AS (
  SELECT 'audio/fold' || (page_id % 10 + 1) || '/' || page_id || '.wav' AS path,
         page_id % 10 + 1 AS fold, 'c' || page_id % 10 AS class, html, strlen(html) AS size
  FROM pages)"""


def payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Web pages as stored clips: their bytes are the payload."""
    rows = V.table(spark, sf_dir, "pages")
    fold = F.col("page_id") % 10 + 1
    return rows.select(
        clip_jobs.clip_path(fold, F.concat(F.col("page_id").cast("string"), F.lit(".wav"))).alias("path"),
        fold.alias("fold"),
        F.concat(F.lit("c"), (F.col("page_id") % 10).cast("string")).alias("class"),
        F.col("html").cast("binary").alias("wav"),
    )


@register(
    "s6_audio_join",
    query(_PAYLOADS, "SELECT path, class, size AS n_bytes, sha256(html) AS sha256 FROM payload"),
)
def audio_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metadata and payload kept apart, joined by relative path."""
    rows = payloads(spark, sf_dir)
    joined = tables.attach_audio(rows.select("path", "class"), rows.select("path", "wav"))
    size = F.octet_length("wav").cast("long").alias("n_bytes")
    return joined.select("path", "class", size, F.sha2("wav", 256).alias("sha256"))


@register(
    "s7_interim_sink",
    query(
        _PAYLOADS,
        """SELECT fold, count(*) AS n, CAST(sum(size) AS BIGINT) AS n_bytes,
             max(sha256(html)) AS last_sha256 FROM payload GROUP BY fold""",
    ),
)
def interim_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "interim")
    tables.write_interim(payloads(spark, sf_dir), path)
    rows = spark.read.parquet(path).withColumn("fold", F.col("fold").cast("long"))
    return rows.groupBy("fold").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.octet_length("wav")).cast("long").alias("n_bytes"),
        F.max(F.sha2("wav", 256)).alias("last_sha256"),
    )


@register(
    "s8_feature_sink",
    query(
        Q.FEAT_LONG,
        "t AS (SELECT count(DISTINCT path) AS n, sum(x) AS total FROM feat_long)",
        f"""SELECT 'tabular' AS output, n, CAST(71 AS INTEGER) AS n_columns, {Q.r6("total")} AS total FROM t
        UNION ALL SELECT 'mels', n, 10, {Q.r6("total")} FROM t""",
    ),
)
def feature_sink(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Both outputs from one stored feature pass, with the sum of what each holds."""
    name = F.concat(F.col("vec_id").cast("string"), F.lit(".wav"))
    rows = V.feat(spark, sf_dir).withColumn("slice_file_name", name)
    rows = rows.select(
        *S.META_COLUMNS,
        *V.FEATURES,
        F.array(*V.FEATURES).alias("mel"),
        F.lit(8).alias("mel_height"),
        F.lit(8).alias("mel_width"),
    )
    staged = stable(rows, "pass")
    tabular, mels = scratch_path(spark, "tabular"), scratch_path(spark, "mels")
    tables.write_features(staged, tabular, mels, V.FEATURES)
    values = {"tabular": F.array(*V.FEATURES), "mels": F.col("mel")}
    parts = {"tabular": spark.read.parquet(tabular), "mels": spark.read.parquet(mels)}
    counted = [
        df.agg(
            F.count(F.lit(1)).alias("n"),
            r6(F.sum(F.aggregate(values[name], F.lit(0.0), lambda a, x: a + x))).alias("total"),
        ).select(F.lit(name).alias("output"), "n", F.lit(len(df.columns)).alias("n_columns"), "total")
        for name, df in parts.items()
    ]
    return counted[0].unionByName(counted[1])


_SMALL_PART = 50_000  # rows


@register(
    "s9_compaction",
    query(
        """l AS (SELECT * FROM lineitem)""",
        f"""SELECT count(*) AS n, {Q.r6("sum(l_quantity)")} AS quantity, TRUE AS fewer_files FROM l""",
    ),
)
def compaction(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Many small parts rewritten as a few files; parts stay small, so a larger table has more of them."""
    many, few = scratch_path(spark, "many"), scratch_path(spark, "few")
    parts = V.table(spark, sf_dir, "lineitem").repartition(40)
    parts.write.option("maxRecordsPerFile", _SMALL_PART).parquet(many)
    tables.compact(spark.read.parquet(many), few)
    before = spark.read.parquet(many).select(F.input_file_name().alias("f")).distinct()
    after = spark.read.parquet(few).withColumn("f", F.input_file_name())
    size = before.agg(F.count(F.lit(1)).alias("n_before"))
    totals = after.agg(
        F.count(F.lit(1)).alias("n"),
        r6(F.sum("l_quantity")).alias("quantity"),
        F.count_distinct("f").alias("n_after"),
    )
    # Two one-row tables.
    joined = totals.crossJoin(F.broadcast(size))
    return joined.select("n", "quantity", (F.col("n_after") < F.col("n_before")).alias("fewer_files"))


@register(
    "v4_reject_routing",
    query(
        """d AS (SELECT CASE WHEN text IS NULL THEN 'missing' WHEN strlen(text) < 400 THEN 'short'
                    WHEN lang <> 'en' THEN 'language' ELSE 'ok' END AS reason FROM documents)""",
        "SELECT reason, count(*) AS n FROM d GROUP BY reason",
    ),
)
def reject_routing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents with a reason to reject them, routed by the same operator as clips."""
    reason = (
        F.when(F.col("text").isNull(), "missing")
        .when(F.octet_length("text") < 400, "short")
        .when(F.col("lang") != "en", "language")
    )
    rows = V.table(spark, sf_dir, "documents")
    return quality.reject_counts(rows.withColumn("reject_reason", reason))


@register(
    "v7_feature_manifest",
    query(
        Q.FEAT_LONG,
        "f AS (SELECT path, max(CASE WHEN i = 0 THEN x END) > 0 AS kept FROM feat_long GROUP BY path)",
        """SELECT count(*) AS num_input_rows, count(*) FILTER (WHERE kept) AS num_written,
             count(*) FILTER (WHERE NOT kept) AS num_dropped, CAST(13 AS INTEGER) AS n_mfcc,
             CAST(128 AS INTEGER) AS n_mels, CAST(64 AS INTEGER) AS n_features FROM f""",
    ),
)
def feature_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Manifest of a feature table whose rows with a first feature of zero or less are dropped."""
    rows = V.feat(spark, sf_dir).withColumn("reject_reason", F.when(F.col("f0") <= 0, "low"))
    row = quality.feature_manifest(rows, V.FEATURES, {"n_mfcc": K.N_MFCC, "n_mels": K.N_MELS})
    return row.withColumn("n_features", F.size("feature_names")).drop("feature_names")


@register(
    "c1_decode",
    query(Q.FEAT_META, CLIPS_SQL, "SELECT vec_id, n AS n_samples, CAST(channels AS BIGINT) AS channels, CAST(rate AS BIGINT) AS rate FROM sized WHERE kind NOT IN (0, 2)"),
)
def decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    table = clip_jobs.decode_report(raw_clips(spark, sf_dir))
    return table.where(F.col("reject_reason").isNull()).select(
        _key(), "n_samples", "channels", "rate"
    )


@register(
    "c2_clean",
    query(Q.FEAT_META, CLIPS_SQL, "SELECT vec_id, n16 AS n_samples, CAST(16000 AS BIGINT) AS rate, TRUE AS full_peak FROM good"),
)
def clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = quality.good_rows(interim(spark, sf_dir, copies=0))
    cleaned = rows.select(F.struct(F.col("wav").alias("bytes"), "path").alias("audio"), "slice_file_name")
    table = clip_jobs.decode_report(cleaned)
    return table.select(_key(), "n_samples", "rate", (F.col("peak") > 0.999).alias("full_peak"))


_EXPANSION = """
planned AS (
  SELECT vec_id, fold, vec_id || '.wav' AS name, copy FROM vec, (SELECT unnest(range(-1, 2)) AS copy)
  WHERE copy = -1 OR fold <> 10)"""
_SEED = "CASE WHEN copy >= 0 THEN CAST('0x' || substr(sha256('42:' || name || ':' || copy), 1, 8) AS BIGINT) END"


@register(
    "c3_augmentation_expansion",
    query(
        Q.FEAT_META, _EXPANSION,
        """SELECT 'audio/fold' || fold || '/' || vec_id ||
             CASE WHEN copy >= 0 THEN '_aug' || copy ELSE '' END || '.wav' AS path,
             CAST(copy AS INTEGER) AS aug_index, copy >= 0 AS is_augmented FROM planned""",
    ),
)
def augmentation_expansion(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = clip_jobs.expand_copies(V.clip_rows(spark, sf_dir).drop("path"), copies=2)
    return rows.select("path", "aug_index", "is_augmented")


@register(
    "c5_copy_seeds",
    query(
        Q.FEAT_META, _EXPANSION,
        f"SELECT vec_id, CAST(copy AS INTEGER) AS aug_index, {_SEED} AS seed FROM planned WHERE copy >= 0",
    ),
)
def copy_seeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = clip_jobs.expand_copies(V.clip_rows(spark, sf_dir).drop("path"), copies=2)
    return rows.where("is_augmented").select("vec_id", "aug_index", "seed")


@register(
    "c4_augmentation",
    query(
        Q.FEAT_META, CLIPS_SQL,
        """SELECT fold, count(*) AS n_copies, count(*) AS n_full_peak, count(*) AS n_near_length
        FROM good WHERE fold <> 10 GROUP BY fold""",
    ),
)
def augmentation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Copies have full peak, and a length within the speed range of their original."""
    rows = quality.good_rows(interim(spark, sf_dir)).where("is_augmented")
    packed = rows.select(
        F.struct(F.col("wav").alias("bytes"), "path").alias("audio"), "slice_file_name", "fold", "end"
    )
    table = clip_jobs.decode_report(packed, keep=["fold", "end"])
    ratio = F.col("n_samples") / (F.col("end") * K.SAMPLE_RATE)
    return table.groupBy("fold").agg(
        F.count(F.lit(1)).alias("n_copies"),
        F.count_if(F.col("peak") > 0.999).alias("n_full_peak"),
        F.count_if(ratio.between(0.9, 1.12)).alias("n_near_length"),
    )


_NUMBERS = "x AS (SELECT vec_id, i, CAST(x AS DOUBLE) AS x FROM sig)"


@register(
    "c6_pad_or_truncate",
    query(
        Q.SIGNAL, _NUMBERS,
        f"""SELECT vec_id, CAST(40 + vec_id % 50 AS INTEGER) AS size,
             {Q.r6("sum(CASE WHEN i < 40 + vec_id % 50 THEN x * (i + 1) ELSE 0 END)")} AS weighted,
             {Q.r6("CASE WHEN 40 + vec_id % 50 > 64 THEN 0.0 ELSE max(CASE WHEN i = 39 + vec_id % 50 THEN x END) END")}
               AS last
        FROM x GROUP BY vec_id""",
    ),
)
def pad_or_truncate(spark: SparkSession, sf_dir: str) -> DataFrame:
    size = (40 + F.col("vec_id") % 50).cast("int")
    rows = V.signal(spark, sf_dir).select("vec_id", C.pad_or_truncate(F.col("y"), size).alias("y"))
    weighted = F.aggregate(
        F.transform("y", lambda v, i: v.cast("double") * (i + 1)), F.lit(0.0), lambda acc, v: acc + v
    )
    return rows.select(
        "vec_id",
        F.size("y").alias("size"),
        r6(weighted).alias("weighted"),
        r6(F.element_at("y", -1).cast("double")).alias("last"),
    )


@register("c7_mfcc")
def mfcc(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = [n for n in S.feature_names() if n.startswith("mfcc_") and "delta" not in n]
    rows = originals(spark, sf_dir, tabular=names, matrix=False)
    return quality.good_rows(rows).select("path", *names)


@register("c9_chroma")
def chroma(spark: SparkSession, sf_dir: str) -> DataFrame:
    names = [n for n in S.feature_names() if n.startswith("chroma_")]
    rows = originals(spark, sf_dir, tabular=names, matrix=False)
    return quality.good_rows(rows).select("path", *names)


_SLOPES = """
slope AS (
  SELECT a.vec_id, a.i, sum((b.i - a.i) * b.x) / 60.0 AS d
  FROM x a JOIN x b ON b.vec_id = a.vec_id AND b.i BETWEEN a.i - 4 AND a.i + 4
  WHERE a.i BETWEEN 4 AND 59 GROUP BY a.vec_id, a.i),
slopes AS (SELECT x.vec_id, x.i, d FROM x JOIN slope s ON s.vec_id = x.vec_id
           AND s.i = least(greatest(x.i, 4), 59))"""


@register(
    "c8_delta",
    query(
        Q.SIGNAL, _NUMBERS, _SLOPES,
        f"""SELECT vec_id, {Q.r6("avg(d)")} AS mean, {Q.r6("stddev_pop(d)")} AS std,
             {Q.r6("max(CASE WHEN i = 0 THEN d END)")} AS first FROM slopes GROUP BY vec_id""",
    ),
)
def delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = V.signal(spark, sf_dir).select("vec_id", series.slopes(F.col("y")).alias("d"))
    means = rows.withColumn("mean", series.mean(F.col("d")))
    return rounded(
        means.select(
            "vec_id",
            "mean",
            series.deviation(F.col("d"), F.col("mean")).alias("std"),
            F.get("d", F.lit(0)).alias("first"),
        ),
        "mean",
        "std",
        "first",
    )


_DFT = """
windowed AS (
  SELECT vec_id, t, k, x * (0.5 - 0.5 * cos(2 * pi() * k / 64)) AS x FROM (
    SELECT vec_id, t, i - t * 64 + 32 AS k, x FROM x, (VALUES (0), (1)) AS f(t)
    WHERE i - t * 64 + 32 BETWEEN 0 AND 63)),
bins AS (
  SELECT vec_id, t, b, sqrt(pow(sum(x * cos(2 * pi() * b * k / 64)), 2)
                          + pow(sum(x * sin(2 * pi() * b * k / 64)), 2)) AS m
  FROM windowed, (SELECT unnest(range(33)) AS b) GROUP BY vec_id, t, b),
cen AS (SELECT vec_id, t, sum(b * m) / sum(m) AS c, sum(m) AS total FROM bins GROUP BY vec_id, t),
spread AS (SELECT vec_id, t, sqrt(sum(m * pow(b - c, 2)) / any_value(total)) AS w
           FROM bins JOIN cen USING (vec_id, t) GROUP BY vec_id, t),
run AS (SELECT vec_id, t, b, sum(m) OVER (PARTITION BY vec_id, t ORDER BY b) AS s, total
        FROM bins JOIN cen USING (vec_id, t)),
roll AS (SELECT vec_id, t, min(b) AS r FROM run WHERE s >= 0.85 * total GROUP BY vec_id, t)"""


@register(
    "c10_spectral_shape",
    query(
        Q.SIGNAL, _NUMBERS, _DFT,
        f"""SELECT vec_id, {Q.r6("avg(c)")} AS centroid_mean, {Q.r6("stddev_pop(c)")} AS centroid_std,
             {Q.r6("avg(w)")} AS bandwidth_mean, {Q.r6("stddev_pop(w)")} AS bandwidth_std,
             {Q.r6("avg(r)")} AS rolloff_mean, {Q.r6("stddev_pop(r)")} AS rolloff_std
        FROM cen JOIN spread USING (vec_id, t) JOIN roll USING (vec_id, t) GROUP BY vec_id""",
    ),
)
def spectral_shape(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two frames of 64 samples at 64 samples per second, so that a bin is one hertz."""

    def shape(y: np.ndarray) -> list[float]:
        tracks = signal.spectral_shape(np.abs(signal.spectrum(y, 64, 64)), 64, 64)
        return [stat for track in tracks.values() for stat in (track.mean(), track.std())]

    names = [f"{n}_{s}" for n in ("centroid", "bandwidth", "rolloff") for s in ("mean", "std")]
    return rounded(clip_jobs.map_signal(V.signal(spark, sf_dir), "y", ["vec_id"], shape, names), *names)


@register(
    "c11_zero_crossings",
    query(
        Q.SIGNAL, _NUMBERS,
        f"""turns AS (SELECT vec_id, i, (x < 0) <> (lag(x) OVER (PARTITION BY vec_id ORDER BY i) < 0) AS turn
                    FROM x),
        per AS (SELECT vec_id, count(*) FILTER (WHERE turn AND i BETWEEN 1 AND 31) / 64.0 AS a,
                       count(*) FILTER (WHERE turn AND i BETWEEN 33 AND 63) / 64.0 AS b
                FROM turns GROUP BY vec_id)""",
        f"SELECT vec_id, {Q.r6('(a + b) / 2')} AS zcr_mean, {Q.r6('abs(a - b) / 2')} AS zcr_std FROM per",
    ),
)
def zero_crossings(spark: SparkSession, sf_dir: str) -> DataFrame:
    rates = series.zero_crossing_rates(F.col("y"), 64, 64)
    rows = V.signal(spark, sf_dir).select("vec_id", rates.alias("track"))
    means = rows.withColumn("zcr_mean", series.mean(F.col("track")))
    deviation = series.deviation(F.col("track"), F.col("zcr_mean"))
    return rounded(
        means.select("vec_id", "zcr_mean", deviation.alias("zcr_std")), "zcr_mean", "zcr_std"
    )


@register(
    "c12_row_summary",
    query(
        Q.SIGNAL, _NUMBERS,
        f"""SELECT vec_id, CAST(i // 16 AS INTEGER) AS row_no, {Q.r6("avg(x)")} AS mean,
             {Q.r6("stddev_pop(x)")} AS std FROM x GROUP BY ALL""",
    ),
)
def row_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean and population deviation of each of four matrix rows, as array expressions."""
    rows = V.signal(spark, sf_dir).select(
        "vec_id", F.posexplode(C.matrix_rows(F.col("y"), F.lit(4), F.lit(16))).alias("row_no", "r")
    )
    total = F.aggregate("r", F.lit(0.0), lambda acc, v: acc + v.cast("double"))
    centred = rows.withColumn("mean", total / F.size("r"))
    squares = F.aggregate(
        "r", F.lit(0.0), lambda acc, v: acc + F.pow(v.cast("double") - F.col("mean"), F.lit(2.0))
    )
    return rounded(
        centred.select("vec_id", "row_no", "mean", F.sqrt(squares / F.size("r")).alias("std")),
        "mean",
        "std",
    )


@register(
    "c13_log_mel",
    query(
        Q.FEAT_META, CLIPS_SQL,
        """SELECT 'audio/fold' || fold || '/' || vec_id || '.wav' AS path, CAST(128 AS INTEGER) AS mel_height,
             CAST(126 AS INTEGER) AS mel_width, CAST(16128 AS INTEGER) AS n_cells, 0.0::DOUBLE AS loudest,
             TRUE AS in_range FROM good""",
    ),
)
def log_mel(spark: SparkSession, sf_dir: str) -> DataFrame:
    low = F.array_min("mel").cast("double")
    return quality.good_rows(originals(spark, sf_dir, tabular=())).select(
        "path",
        "mel_height",
        "mel_width",
        F.size("mel").alias("n_cells"),
        r6(F.array_max("mel").cast("double")).alias("loudest"),
        low.between(-80.0, 0.0).alias("in_range"),
    )


@register(
    "c14_feature_job",
    query(
        Q.FEAT_META, CLIPS_SQL,
        """SELECT 'audio/fold' || fold || '/' || vec_id || CASE WHEN copy THEN '_aug0' ELSE '' END || '.wav' AS path,
             fold, class, copy AS is_augmented, CAST(84 AS INTEGER) AS n_finite, TRUE AS has_mel
        FROM good, (VALUES (FALSE), (TRUE)) AS c(copy) WHERE NOT copy OR fold <> 10""",
    ),
)
def feature_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clean, augment and extract in one chain; every kept row has both feature kinds."""
    rows = quality.good_rows(interim(spark, sf_dir)).withColumn(
        "aug_index", F.col("aug_index").cast("long")
    )
    features = quality.good_rows(clip_jobs.extract_features(rows))
    values = F.array(*S.feature_names())
    return features.select(
        "path",
        "fold",
        "class",
        "is_augmented",
        F.size(F.filter(values, C.is_finite)).alias("n_finite"),
        (F.size("mel") == K.N_MELS * K.MEL_FRAMES).alias("has_mel"),
    )


_CHANNELS = """
m AS (SELECT vec_id, i // 16 AS r, i % 16 AS t, x FROM (
        SELECT vec_id, unnest(range(64)) AS i, unnest(CAST(embedding AS DOUBLE[])) AS x FROM embeddings)),
fit AS (
  SELECT a.vec_id, a.r, a.t, sum((b.t - a.t) * b.x) / 60.0 AS d1,
         2 * sum((pow(b.t - a.t, 2) - 20.0 / 3) * b.x) / 308.0 AS d2
  FROM m a JOIN m b ON b.vec_id = a.vec_id AND b.r = a.r AND b.t BETWEEN a.t - 4 AND a.t + 4
  WHERE a.t BETWEEN 4 AND 11 GROUP BY a.vec_id, a.r, a.t),
ch AS (SELECT m.vec_id, m.r * 16 + m.t AS cell, m.x, d1, d2 FROM m JOIN fit f
       ON f.vec_id = m.vec_id AND f.r = m.r AND f.t = least(greatest(m.t, 4), 11))"""


@register(
    "c15_three_channels",
    query(
        _CHANNELS,
        """SELECT vec_id, CAST(cell AS INTEGER) AS cell, round(CAST(CAST(x AS FLOAT) AS DOUBLE), 4) + 0.0 AS x,
             round(CAST(CAST(d1 AS FLOAT) AS DOUBLE), 4) + 0.0 AS d1,
             round(CAST(CAST(d2 AS FLOAT) AS DOUBLE), 4) + 0.0 AS d2 FROM ch""",
    ),
)
def three_channels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Matrices of 4 x 16 with their first and second differences along time."""
    mels = V.feat_mel(spark, sf_dir, 4, 16).select("vec_id", "mel", "mel_height", "mel_width")
    stacked = clip_jobs.three_channel_table(mels)
    cells = F.arrays_zip(
        F.slice("channels", 1, 64).alias("x"),
        F.slice("channels", 65, 64).alias("d1"),
        F.slice("channels", 129, 64).alias("d2"),
    )
    number = lambda name: F.round(F.col(f"c.{name}").cast("double"), 4).alias(name)
    return stacked.select("vec_id", F.posexplode(cells).alias("cell", "c")).select(
        "vec_id", "cell", number("x"), number("d1"), number("d2")
    )
