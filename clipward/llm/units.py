"""Units of whole documents, and the exchange that finds keys shared between units.

Several operators ask which content keys (hashes of windows or shingles) occur elsewhere. Sending
every key with its document costs more than the text itself. So documents are packed into stored
units of about one megabyte of text. Each unit sends every distinct key once, as sorted arrays cut
by hash bucket; a bucket decides over its keys and answers the units that hold them. A key that
sits in a third of all documents is one entry per unit, so no bucket grows with it. The answers are
joined back to the unit table, which is bucketed by unit: only the answers are shuffled. All numpy
work is inside tasks; grouping, shuffles and joins are Spark's.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clipward.llm.frames import release, small_batches
from clipward.session import scratch_path

UNIT_BYTES = 1 << 20
UNIT_ROWS = 1 << 20
BUCKET_TEXT = 8 << 20  # text bytes whose keys fall into one bucket, about

ENTRY = T.StructType(
    [
        T.StructField("bucket", T.IntegerType()),
        T.StructField("unit", T.LongType()),
        T.StructField("keys", T.BinaryType()),
        T.StructField("values", T.ArrayType(T.BinaryType())),
    ]
)
ANSWER = "array<struct<keys: binary, values: array<binary>>>"


def pack_ints(values: np.ndarray, ascending: bool = False) -> bytes:
    """Integers as byte planes of their differences (ascending) or distances from the least."""
    values = np.ascontiguousarray(values).view(np.uint64)
    if not len(values):
        return b""
    base = values[0] if ascending else values.view(np.int64).min().view(np.uint64)
    steps = np.diff(values, prepend=base) if ascending else values - base
    width = max(1, (int(steps.max()).bit_length() + 7) // 8)
    planes = steps.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T
    head = np.array([base], "<u8").tobytes() + bytes([width, ascending])
    return head + planes.tobytes()


def unpack_ints(data: bytes) -> np.ndarray:
    """The uint64 bit patterns given to ``pack_ints``."""
    if not data:
        return np.empty(0, np.uint64)
    base, width, ascending = np.frombuffer(data, "<u8", 1)[0], data[8], data[9]
    planes = np.frombuffer(data, np.uint8, offset=10).reshape(width, -1)
    steps = np.zeros((planes.shape[1], 8), np.uint8)
    steps[:, :width] = planes.T
    steps = steps.view("<u8").ravel()
    return np.cumsum(steps, dtype=np.uint64) + base if ascending else steps + base


def pack_rows(batch: pa.RecordBatch) -> bytes:
    sink = pa.BufferOutputStream()
    options = pa.ipc.IpcWriteOptions(compression="zstd")
    with pa.ipc.new_stream(sink, batch.schema, options=options) as writer:
        writer.write_batch(batch)
    return sink.getvalue().to_pybytes()


def unpack_rows(payload: bytes) -> pa.RecordBatch:
    return pa.ipc.open_stream(payload).read_next_batch()


@dataclass(frozen=True)
class Units:
    """``frame`` has (unit, payload); a payload holds rows of ``schema``."""

    frame: DataFrame
    schema: T.StructType
    n_bytes: int

    @property
    def n_buckets(self) -> int:
        """A power of two that follows the size of the text."""
        return 1 << max(6, (self.n_bytes // BUCKET_TEXT).bit_length())


def pack(df: DataFrame, text: str, unit_bytes: int = UNIT_BYTES) -> Units:
    """Store the rows of ``df`` in units of whole rows of about ``unit_bytes`` of text each."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, made = TaskContext.get().partitionId(), 0
        held: list[pa.RecordBatch] = []
        held_bytes = held_rows = 0

        def unit() -> pa.RecordBatch:
            nonlocal made, held_bytes, held_rows
            table = pa.Table.from_batches(held).combine_chunks()
            payload = pack_rows(table.to_batches()[0])
            out = pa.RecordBatch.from_arrays(
                [
                    pa.array([(task << 20) + made], pa.int64()),
                    pa.array([held_bytes], pa.int64()),
                    pa.array([payload], pa.binary()),
                ],
                ["unit", "n_bytes", "payload"],
            )
            held.clear()
            made, held_bytes, held_rows = made + 1, 0, 0
            return out

        for batch in batches:
            column = batch.column(batch.schema.get_field_index(text))
            sizes = pa.compute.fill_null(pa.compute.binary_length(column), 0).to_numpy(False)
            at = 0
            for i, size in enumerate(sizes.tolist()):
                held_bytes, held_rows = held_bytes + size, held_rows + 1
                if held_bytes >= unit_bytes or held_rows >= UNIT_ROWS:
                    held.append(batch.slice(at, i + 1 - at))
                    at = i + 1
                    yield unit()
            if at < len(sizes):
                held.append(batch.slice(at))
        if held:
            yield unit()

    small_batches(df.sparkSession)
    made = df.mapInArrow(run, "unit long, n_bytes long, payload binary")
    frame = by_unit(made, "units")
    n_bytes = frame.agg(F.coalesce(F.sum("n_bytes"), F.lit(0))).first()[0]
    return Units(frame.select("unit", "payload"), df.schema, n_bytes)


def by_unit(df: DataFrame, label: str) -> DataFrame:
    """Store ``df`` bucketed by unit: joins on unit then shuffle only the other side."""
    spark = df.sparkSession
    path, name = scratch_path(spark, label), f"{label}_{uuid.uuid4().hex}"
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    (
        df.write.option("path", path)
        .option("compression", "none")
        .bucketBy(partitions, "unit")
        .saveAsTable(name)
    )
    frame = spark.table(name)
    spark.sql(f"DROP TABLE {name}")  # the files stay, and so does the plan that reads them
    return frame


def each_unit(
    units: Units,
    make: Callable[..., Iterator[pa.RecordBatch]],
    schema: T.StructType | str,
    answers: tuple[DataFrame, ...] = (),
) -> DataFrame:
    """Rows that ``make(unit, rows, *answers)`` yields; an answer is a list, or empty."""
    frame = units.frame
    names = [f"answer{i}" for i in range(len(answers))]
    for name, answer in zip(names, answers):
        frame = frame.join(answer.select("unit", F.col("answer").alias(name)), "unit", "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = {n: batch.column(i) for i, n in enumerate(batch.schema.names)}
            for i in range(batch.num_rows):
                given = [columns[n][i].as_py() or [] for n in names]
                rows = unpack_rows(columns["payload"][i].as_buffer())
                yield from make(columns["unit"][i].as_py(), rows, *given)
                del rows, given
                release()

    return frame.mapInArrow(run, schema)


def entry_batch(unit: int, keys: np.ndarray, values: list[np.ndarray], n_buckets: int) -> pa.RecordBatch:
    """Ascending distinct ``keys`` with their values, cut by the keys' leading bits."""
    shift = np.uint64(64 - (n_buckets.bit_length() - 1))
    bucket = (keys >> shift).astype(np.int32)
    names, first = np.unique(bucket, return_index=True)
    bounds = [*first, len(keys)]
    cuts = list(zip(bounds[:-1], bounds[1:]))
    return pa.RecordBatch.from_arrays(
        [
            pa.array(names, pa.int32()),
            pa.array([unit] * len(cuts), pa.int64()),
            pa.array([pack_ints(keys[a:b], True) for a, b in cuts], pa.binary()),
            pa.array([[pack_ints(v[a:b]) for v in values] for a, b in cuts], pa.list_(pa.binary())),
        ],
        ENTRY.names,
    )


def shared(
    entries: DataFrame,
    decide: Callable[[np.ndarray, list[np.ndarray]], tuple[np.ndarray, list[np.ndarray]]],
) -> DataFrame:
    """(unit, answer) from entries. ``decide(keys, values)`` sees one bucket, ascending by key.

    It returns which entries are answered and the int64 arrays to send with them.
    """

    def run(table: pa.Table) -> pa.Table:
        keys = [unpack_ints(k) for k in table.column("keys").to_pylist()]
        values = table.column("values").to_pylist()
        owner = np.repeat(np.arange(len(keys)), [len(k) for k in keys])
        flat = np.concatenate(keys)
        columns = [
            np.concatenate([unpack_ints(v[i]).view(np.int64) for v in values])
            for i in range(len(values[0]))
        ]
        order = np.argsort(flat, kind="stable")
        owner, flat = owner[order], flat[order]
        kept, sent = decide(flat, [c[order] for c in columns])
        owner, flat, sent = owner[kept], flat[kept], [s[kept] for s in sent]
        order = np.argsort(owner, kind="stable")  # keys stay ascending within a unit
        owner, flat, sent = owner[order], flat[order], [s[order] for s in sent]
        names, first = np.unique(owner, return_index=True)
        bounds = [*first, len(owner)]
        cuts = list(zip(bounds[:-1], bounds[1:]))
        return pa.table(
            {
                "unit": table.column("unit").combine_chunks().take(pa.array(names)),
                "keys": pa.array([pack_ints(flat[a:b], True) for a, b in cuts], pa.binary()),
                "values": pa.array(
                    [[pack_ints(s[a:b]) for s in sent] for a, b in cuts], pa.list_(pa.binary())
                ),
            }
        )

    answers = entries.groupBy("bucket").applyInArrow(
        run, "unit long, keys binary, values array<binary>"
    )
    return answers.groupBy("unit").agg(F.collect_list(F.struct("keys", "values")).alias("answer"))


def answered(answer: list[dict]) -> tuple[np.ndarray, list[np.ndarray]]:
    """One unit's answer as ascending keys and their values."""
    if not answer:
        return np.empty(0, np.uint64), []
    keys = np.concatenate([unpack_ints(a["keys"]) for a in answer])
    values = [
        np.concatenate([unpack_ints(a["values"][i]).view(np.int64) for a in answer])
        for i in range(len(answer[0]["values"]))
    ]
    order = np.argsort(keys, kind="stable")
    return keys[order], [v[order] for v in values]


def find(keys: np.ndarray, among: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each key: whether ``among`` (ascending) holds it, and where."""
    if not len(among):
        return np.zeros(len(keys), bool), np.zeros(len(keys), np.int64)
    at = np.minimum(np.searchsorted(among, keys), len(among) - 1)
    return among[at] == keys, at
