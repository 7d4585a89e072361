"""Small helpers shared by the operators: column clashes, Arrow mapping, stored tables."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clipward.session import scratch_path

BATCH_BYTES = 8 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write to the shared folder and read back, so that later jobs start from files."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small_batches(spark: SparkSession) -> None:
    """Lower the session's Arrow batches to ``BATCH_BYTES``; a smaller setting stays.

    A batch of texts is held several times over, by the JVM and by the worker of each core.
    """
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if int(spark.conf.get(key).rstrip("b")) > BATCH_BYTES:
        spark.conf.set(key, str(BATCH_BYTES))


def add_arrow_columns(
    df: DataFrame,
    fields: Iterable[T.StructField],
    make: Callable[[Iterator[pa.RecordBatch]], Iterator[list[pa.Array]]],
) -> DataFrame:
    """``df`` with new columns computed batch by batch; columns of the same name are replaced.

    ``make`` maps the batches to one list of arrays each, in the order of ``fields``.
    """
    small_batches(df.sparkSession)
    fields = list(fields)
    names = [f.name for f in fields]
    kept = df.drop(*names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current: list[pa.RecordBatch] = []

        def tapped() -> Iterator[pa.RecordBatch]:
            for batch in batches:
                current[:] = [batch]
                yield batch

        for arrays in make(tapped()):
            batch = current[0]
            yield pa.RecordBatch.from_arrays([*batch.columns, *arrays], [*batch.schema.names, *names])
        current.clear()
        release()

    return kept.mapInArrow(run, T.StructType([*kept.schema.fields, *fields]))


def release() -> None:
    """Give freed memory back to the system; Spark keeps its Python workers between stages."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def sha256_hex(column) -> F.Column:
    return F.sha2(column, 256)
