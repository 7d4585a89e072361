"""Fingerprints of files and of table content."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clipward.functions.frames import object_frame

MIB = 1024 * 1024
FINGERPRINT_SCHEMA = (
    "path string, exists boolean, size_bytes long, mtime double, sha256 string, digest_mode string"
)


def _digest(path: str) -> dict[str, object]:
    """Head and tail digest: the first MiB, and the last one beyond 2 MiB (else the rest)."""
    from pyarrow import fs

    system, name = fs.FileSystem.from_uri(path) if ":" in path else (fs.LocalFileSystem(), path)
    info = system.get_file_info(name)
    if info.type != fs.FileType.File:
        return {"path": path, "exists": False}
    state = hashlib.sha256()
    with system.open_input_file(name) as handle:
        state.update(handle.read_at(MIB, 0))
        if info.size > 2 * MIB:
            state.update(handle.read_at(MIB, info.size - MIB))
        elif info.size > MIB:
            state.update(handle.read_at(info.size - MIB, MIB))
    return {
        "path": path,
        "exists": True,
        "size_bytes": info.size,
        "mtime": info.mtime_ns / 1e9 if info.mtime_ns is not None else None,
        "sha256": state.hexdigest(),
        "digest_mode": "head_tail_1mb",
    }


def fingerprint_files(files: DataFrame, path: str = "path") -> DataFrame:
    """One fingerprint row per listed path; the tasks read at most 2 MiB of each file."""
    columns = [part.split()[0] for part in FINGERPRINT_SCHEMA.split(", ")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield object_frame([_digest(p) for p in batch["path"]], columns)

    return files.select(F.col(path).alias("path")).mapInPandas(run, FINGERPRINT_SCHEMA)


def list_files(spark: SparkSession, root: str, glob: str = "*") -> DataFrame:
    """Paths below ``root``; only the listing is read, not the content."""
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", glob)
        .option("recursiveFileLookup", "true")
        .load(root)
        .select("path")
    )


def content_fingerprint(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """(rows, xor_hash, sum_hash) of the rows as a multiset, whatever their order or files."""
    names = sorted(columns or df.columns)
    hashed = df.select(F.xxhash64(*names).alias("h"))
    # Two halves keep the wrapping sum inside a long under ANSI arithmetic.
    low = F.sum(F.col("h").bitwiseAND(F.lit(0xFFFFFFFF)).cast("decimal(38,0)"))
    high = F.sum(F.shiftright("h", 32).cast("decimal(38,0)"))
    return hashed.agg(
        F.count(F.lit(1)).alias("rows"),
        F.bit_xor("h").alias("xor_hash"),
        F.concat_ws(":", high.cast("string"), low.cast("string")).alias("sum_hash"),
    )
