"""Clip jobs: clean, augment and extract features, one pass over a partitioned clip table.

Decisions that are not about samples (which rows get copies, their names and seeds) are
column expressions. Only the samples go through Python, a few megabytes at a time.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clipward import constants as K
from clipward import schemas as S
from clipward.functions import columns as C
from clipward.functions import series, signal
from clipward.functions.frames import object_frame
from clipward.session import bounded_batches

# Rows handed back at once: 16 matrices of 128 x 126 floats are 1 MiB.
_CHUNK = 16

INTERIM_RESULT = T.StructType(
    [*S.INTERIM_CLIP.fields, T.StructField("reject_reason", T.StringType())]
)


def feature_result(
    kept: Sequence[T.StructField],
    n_mfcc: int = K.N_MFCC,
    tabular: Sequence[str] | None = None,
    matrix: bool = True,
) -> T.StructType:
    """The kept columns, the features and a reject reason; rejected rows have no features."""
    names = S.feature_names(n_mfcc) if tabular is None else tabular
    doubles = [T.StructField(n, T.DoubleType()) for n in names]
    mel = [T.StructField(f.name, f.dataType) for f in S.MEL_FIELDS] if matrix else []
    return T.StructType([*kept, *doubles, *mel, T.StructField("reject_reason", T.StringType())])


def _chunks(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        for start in range(0, len(batch), _CHUNK):
            yield batch.iloc[start : start + _CHUNK]


def copy_seeds(
    fold: Column,
    key: Column,
    copies: int = K.AUGMENT_COPIES,
    eval_fold: int = K.EVAL_FOLD,
    base_seed: int = K.BASE_SEED,
) -> Column:
    """Seeds of the augmented copies of a clip; the evaluation fold gets none."""
    none = F.array().cast("array<bigint>")
    if copies <= 0:
        return none
    seeds = F.transform(
        F.sequence(F.lit(0), F.lit(copies - 1)), lambda i: C.clip_seed(base_seed, key, i)
    )
    return F.when(fold == eval_fold, none).otherwise(seeds)


def clip_path(fold: Column, slice_file_name: Column, copy: Column | None = None) -> Column:
    stem = C.file_stem(slice_file_name)
    suffix = (
        F.lit("")
        if copy is None
        else F.when(copy >= 0, F.concat(F.lit("_aug"), copy.cast("string"))).otherwise("")
    )
    return F.concat(
        F.lit("audio/fold"), fold.cast("string"), F.lit("/"), stem, suffix, F.lit(".wav")
    )


def expand_copies(df: DataFrame, **options: int) -> DataFrame:
    """One row per clip and planned copy: adds aug_index, is_augmented, seed and path."""
    seeds = copy_seeds(F.col("fold"), F.col("slice_file_name"), **options)
    planned = F.concat(F.array(F.lit(None).cast("bigint")), seeds)
    return (
        df.select("*", F.posexplode(planned).alias("aug_index", "seed"))
        .withColumn("aug_index", F.col("aug_index") - 1)
        .withColumn("is_augmented", F.col("aug_index") >= 0)
        .withColumn("path", clip_path(F.col("fold"), F.col("slice_file_name"), F.col("aug_index")))
    )


def clean_and_augment(
    raw: DataFrame, *, target_rate: int = K.SAMPLE_RATE, chance: float = 0.5, **options: int
) -> DataFrame:
    """Raw clips to interim clips: every clip decoded once, written with its copies.

    Clips that cannot be used come back as one row with a ``reject_reason``. Which copies
    exist is decided by the ``seeds`` column.
    """
    prepared = raw.select(
        F.col("audio.bytes").alias("__bytes"),
        *S.RAW_META_COLUMNS,
        clip_path(F.col("fold"), F.col("slice_file_name")).alias("path"),
        copy_seeds(F.col("fold"), F.col("slice_file_name"), **options).alias("__seeds"),
    )
    names = INTERIM_RESULT.fieldNames()

    def rows(record: dict) -> Iterator[dict]:
        meta = {c: record[c] for c in [*S.RAW_META_COLUMNS, "path"]}
        try:
            y, rate = signal.decode_wav(record["__bytes"])
            y = signal.clean(y, rate, target_rate)
        except signal.RejectedClip as problem:
            yield {**meta, "is_augmented": False, "aug_index": -1, "reject_reason": str(problem)}
            return
        yield {
            **meta,
            "sample_rate": target_rate,
            "is_augmented": False,
            "aug_index": -1,
            "wav": signal.encode_wav(y, target_rate),
        }
        stem = record["path"].removesuffix(".wav")
        for i, seed in enumerate(record["__seeds"]):
            yield {
                **meta,
                "path": f"{stem}_aug{i}.wav",
                "sample_rate": target_rate,
                "is_augmented": True,
                "aug_index": i,
                "wav": signal.encode_wav(signal.augment(y, int(seed), chance), target_rate),
            }

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for chunk in _chunks(batches):
            out = [row for record in chunk.to_dict("records") for row in rows(record)]
            yield object_frame(out, names)

    bounded_batches(raw.sparkSession)
    return prepared.mapInPandas(run, INTERIM_RESULT)


def extract_features(
    clips: DataFrame,
    *,
    rate: int = K.SAMPLE_RATE,
    seconds: float = K.CLIP_SECONDS,
    n_mfcc: int = K.N_MFCC,
    peak_normalize: bool = False,
    keep: Sequence[str] = S.META_COLUMNS,
    tabular: Sequence[str] | None = None,
    matrix: bool = True,
) -> DataFrame:
    """Tabular features and log-mel matrix of every clip, from one decode.

    Rows that fail carry a ``reject_reason`` and no features, so both feature tables made
    from the result have the same paths. ``clips`` needs ``wav`` and the columns to keep.
    ``peak_normalize`` cleans raw uploads in the same way as training clips. ``tabular`` names the
    features to compute (all by default) and ``matrix`` says whether the log-mel matrix is one of them;
    what is not asked for is neither computed nor sent.
    """
    schema = feature_result([clips.schema[c] for c in keep], n_mfcc, tabular, matrix)
    names = schema.fieldNames()
    tabular = list(S.feature_names(n_mfcc) if tabular is None else tabular)
    size = int(rate * seconds)

    def row(record: dict) -> dict:
        meta = {c: record[c] for c in keep}
        try:
            y, native = signal.decode_wav(record["wav"])
            y = signal.resample(signal.to_mono(y), native, rate)
            if peak_normalize:
                y = signal.normalize_peak(y)
            y = signal.fit_length(y, size)
            found = dict(meta)
            if matrix:
                mel = signal.log_mel(y, rate)
                found |= {"mel": mel.ravel(), "mel_height": mel.shape[0], "mel_width": mel.shape[1]}
            if tabular:
                values = signal.tabular_features(y, rate, n_mfcc, tabular)
                found |= dict(zip(tabular, values, strict=True))
        except signal.RejectedClip as problem:
            return {**meta, "reject_reason": str(problem)}
        return found

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for chunk in _chunks(batches):
            yield object_frame([row(r) for r in chunk.to_dict("records")], names)

    bounded_batches(clips.sparkSession)
    return clips.select(*keep, "wav").mapInPandas(run, schema)


def map_signal(
    df: DataFrame,
    array: str,
    keys: Sequence[str],
    function: Callable[[np.ndarray], Sequence[float]],
    names: Sequence[str],
) -> DataFrame:
    """Named numbers computed from one array column, beside the key columns."""
    kept = df.select(*keys, array)
    fields = [kept.schema[k] for k in keys] + [T.StructField(n, T.DoubleType()) for n in names]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            values = [function(np.asarray(y, dtype=np.float64)) for y in batch[array]]
            numbers = pd.DataFrame(values, columns=list(names), dtype=float)
            yield pd.concat([batch[list(keys)].reset_index(drop=True), numbers], axis=1)

    return kept.mapInPandas(run, T.StructType(fields))


def three_channel_table(mels: DataFrame) -> DataFrame:
    """Adds ``channels``: the matrix and its two time derivatives, flattened."""
    channels = series.three_channels(F.col("mel"), F.col("mel_height"), F.col("mel_width"))
    return mels.withColumn("channels", channels)


def decode_report(clips: DataFrame, keep: Sequence[str] = ()) -> DataFrame:
    """(slice_file_name, kept columns, n_samples, channels, rate, peak, reject_reason)."""
    numbers = ("n_samples", "channels", "rate")
    schema = T.StructType(
        [
            T.StructField("slice_file_name", T.StringType()),
            *[clips.schema[c] for c in keep],
            *[T.StructField(n, T.LongType()) for n in numbers],
            T.StructField("peak", T.DoubleType()),
            T.StructField("reject_reason", T.StringType()),
        ]
    )

    def row(record: dict) -> dict:
        meta = {c: record[c] for c in ["slice_file_name", *keep]}
        try:
            y, rate = signal.decode_wav(record["__bytes"])
        except signal.RejectedClip as problem:
            return {**meta, "reject_reason": str(problem)}
        return {
            **meta,
            "n_samples": y.shape[0],
            "channels": 1 if y.ndim == 1 else y.shape[1],
            "rate": rate,
            "peak": float(np.max(np.abs(y))) if y.size else 0.0,
        }

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for chunk in _chunks(batches):
            yield object_frame([row(r) for r in chunk.to_dict("records")], schema.fieldNames())

    source = clips.select("slice_file_name", *keep, F.col("audio.bytes").alias("__bytes"))
    bounded_batches(clips.sparkSession)
    return source.mapInPandas(run, schema)
