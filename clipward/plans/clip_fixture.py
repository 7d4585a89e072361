"""A raw clip table rendered by a Spark job from the keys and labels of the vector table.

Every clip is a tone whose pitch depends on the class, with seeded noise. Length, sample
rate and channel count vary with the key, and some clips are broken on purpose.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clipward.functions import columns as C
from clipward.functions import signal
from clipward.plans import views as V
from clipward.session import bounded_batches


def _wav(key: int, label: int, seed: int) -> bytes:
    kind = key % 50
    if kind == 0:
        return b""
    if kind == 2:
        return b"RIFF----not a clip"
    rate = 22050 if key % 5 == 2 else 16000
    size = 0 if kind == 3 else int((1 + key % 4) * rate / 2)
    if kind == 1:
        return signal.encode_wav(np.zeros(size), rate)
    rng = np.random.default_rng(seed)
    t = np.arange(size) / rate
    tone = 0.4 * np.sin(2 * np.pi * 200 * 2 ** (label / 3) * t)
    y = tone + 0.02 * rng.standard_normal(size)
    if key % 7 == 3:
        y = np.stack([y, 0.5 * y], axis=1)
    return signal.encode_wav(y, rate)


def raw_clips(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = V.clip_rows(spark, sf_dir).withColumn(
        "seed", C.clip_seed(7, F.col("vec_id").cast("string"), F.lit(0))
    )
    # Rendering is heavy and the key table is small on disk, so spread the keys by hash; several
    # tasks a core even out, and what a task holds is bounded by the batches, not by its rows.
    spread = keys.repartition(4 * spark.sparkContext.defaultParallelism, "vec_id")
    bounded_batches(spark)

    def render(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for start in range(0, len(batch), 16):
                part = batch.iloc[start : start + 16]
                rows = zip(part["vec_id"], part["classID"], part["seed"], strict=True)
                yield part.assign(bytes=[_wav(int(k), int(c), int(s)) for k, c, s in rows])

    rendered = spread.mapInPandas(
        render, T.StructType([*spread.schema.fields, T.StructField("bytes", T.BinaryType())])
    )
    key = F.col("vec_id")
    return rendered.select(
        F.struct("bytes", F.concat(key.cast("string"), F.lit(".wav")).alias("path")).alias("audio"),
        "slice_file_name",
        (key + 1000).alias("fsID"),
        F.lit(0.0).alias("start"),
        ((key % 4 + 1) / 2).alias("end"),
        (key % 2 + 1).alias("salience"),
        "fold",
        "classID",
        "class",
    )


# The same facts for the cross-check.
CLIPS_SQL = """
clips AS (
  SELECT vec_id, class, fold, vec_id % 50 AS kind,
         CASE WHEN vec_id % 5 = 2 THEN 22050 ELSE 16000 END AS rate,
         CASE WHEN vec_id % 7 = 3 AND vec_id % 50 <> 1 THEN 2 ELSE 1 END AS channels,
         CASE vec_id % 50 WHEN 0 THEN 'missing audio bytes' WHEN 1 THEN 'silent audio'
           WHEN 2 THEN 'undecodable audio' WHEN 3 THEN 'empty audio' END AS reason
  FROM vec),
sized AS (SELECT *, CASE WHEN kind = 3 THEN 0
                    ELSE CAST(floor((1 + vec_id % 4) * rate / 2) AS BIGINT) END AS n FROM clips),
good AS (SELECT *, CAST(ceil(n * 16000.0 / rate) AS BIGINT) AS n16 FROM sized WHERE reason IS NULL)"""
