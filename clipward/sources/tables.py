"""Clip, metadata and feature tables: readers and sinks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clipward import constants as K
from clipward import schemas as S


def project_raw_clips(df: DataFrame, max_rows: int | None = None) -> DataFrame:
    """The contract columns of a raw clip table, in order; optionally only the first rows by name."""
    narrowed = df.select(*[f.name for f in S.RAW_CLIP])
    if max_rows is None:
        return narrowed
    return narrowed.orderBy("slice_file_name", "fold").limit(max_rows)


def read_raw_clips(spark: SparkSession, path: str, max_rows: int | None = None) -> DataFrame:
    """Raw clip shards. The schema is given, so other columns are never read."""
    return project_raw_clips(spark.read.schema(S.RAW_CLIP).parquet(path), max_rows)


def read_interim(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(S.INTERIM_CLIP).parquet(path)


def read_features(
    spark: SparkSession,
    path: str,
    columns: Sequence[str] | None = None,
    schema: T.StructType | None = None,
) -> DataFrame:
    """Feature table; a missing path is an error from the reader itself."""
    reader = spark.read if schema is None else spark.read.schema(schema)
    df = reader.parquet(path)
    return df if columns is None else df.select(*columns)


def read_if_present(
    spark: SparkSession, path: str, schema: T.StructType | None = None
) -> DataFrame | None:
    """The stored table, or nothing where no such folder exists."""
    try:
        return (spark.read if schema is None else spark.read.schema(schema)).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def class_folder_clips(
    files: DataFrame, classes: Sequence[str] = K.CLASS_NAMES, path: str = "path"
) -> DataFrame:
    """Files laid out as ``<class>/<name>.wav``: known classes only, in class order.

    ``files`` needs a ``path`` column, for instance from the binaryFile reader. Files that
    do not sit in a folder named after a class are ignored.
    """
    parts = F.regexp_extract(path, r"([^/]+)/[^/]+\.wav$", 1)
    names = F.array(*[F.lit(c) for c in classes])
    return (
        files.withColumn("expected", parts)
        .where(F.col("expected").isin(*classes))
        .withColumn("class_position", F.array_position(names, F.col("expected")).cast("int") - 1)
        .withColumn("file_name", F.regexp_extract(path, r"([^/]+)$", 1))
        .orderBy("class_position", "file_name")
    )


def read_class_folders(spark: SparkSession, root: str) -> DataFrame:
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", "*.wav")
        .option("recursiveFileLookup", "true")
        .load(root)
    )
    return class_folder_clips(files)


def attach_audio(metadata: DataFrame, audio: DataFrame, path: str = "path") -> DataFrame:
    """Metadata rows with the bytes stored under the same relative path."""
    return metadata.join(audio.select(path, "wav"), path)


def write_interim(df: DataFrame, path: str, max_records_per_file: int = 20_000) -> None:
    """Interim clips, one folder per fold, so fold filters prune whole folders.

    Rows are gathered by fold so that a task writes few folders, and the rebalance hint
    lets adaptive execution split a large fold over as many tasks as its size asks for.
    """
    (
        df.hint("rebalance", "fold")
        .write.mode("overwrite")
        .option("maxRecordsPerFile", max_records_per_file)
        .partitionBy("fold")
        .parquet(path)
    )


def write_features(
    features: DataFrame, tabular_path: str, mel_path: str, names: Sequence[str]
) -> None:
    """Tabular and mel tables from one feature pass.

    ``features`` is read twice, so pass a persisted or stored table.
    """
    features.select(*S.META_COLUMNS, *names).write.mode("overwrite").parquet(tabular_path)
    features.select(*S.META_COLUMNS, "mel", "mel_height", "mel_width").write.mode(
        "overwrite"
    ).parquet(mel_path)


def compact(df: DataFrame, path: str, max_records_per_file: int = 1_000_000) -> None:
    """Rewrite many small parts as evenly filled files of at most ``max_records_per_file`` rows.

    Rows are counted first (for Parquet from the footers), so the number of files follows from them alone:
    a partition filled to 99 % stays one file, where partitions cut by bytes leave a second, small one.
    Wide rows take a lower limit. An empty table gives one file without rows.
    """
    files = max(1, -(-df.count() * 100 // (max_records_per_file * 99)))
    (
        df.repartition(files)
        .write.mode("overwrite")
        .option("maxRecordsPerFile", max_records_per_file)
        .option("compression", "snappy")
        .parquet(path)
    )
