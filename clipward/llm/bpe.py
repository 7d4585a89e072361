"""Byte-level BPE encoding and decoding with a local rank file.

``encode`` adds the token ids of every whole text, ``decode`` the bytes of every id list. Each
match of the split pattern is encoded on its own, without special tokens. A long text is handed to
the encoder in pieces that end where the pattern always ends a match, so the ids do not depend on
the piece size. Decoding joins raw bytes: a token may hold part of a character.

Cases: a null text counts as empty and gives an empty id list; a null id list gives empty bytes; a
text without any safe boundary is encoded in one piece; equal and repeated rows give equal ids;
empty tables give empty tables; an existing column with an output name is replaced, all others are
kept.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from clipward.llm.frames import add_arrow_columns

PIECE_CHARS = 1 << 16

# After a non-space and before a space, or between an ASCII letter and a digit, every split
# pattern of this family ends a match. \S here is narrower than the pattern's own.
SAFE = re.compile(r"\S(?=[ \t\n\r])|[A-Za-z](?=[0-9])|[0-9](?=[A-Za-z])")


def pieces(text: str, limit: int = PIECE_CHARS) -> Iterator[str]:
    """``text`` in order, cut at the first safe boundary after every ``limit`` characters."""
    start = 0
    while len(text) - start > limit:
        cut = SAFE.search(text, start + limit - 1)
        if cut is None:
            break
        yield text[start : cut.end()]
        start = cut.end()
    yield text[start:]


def encoding(ranks_path: str, pattern: str) -> tiktoken.Encoding:
    """Made once per task, so that idle workers do not hold it."""
    with open(ranks_path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("local", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def encode_text(encoder: tiktoken.Encoding, text: str, limit: int = PIECE_CHARS) -> np.ndarray:
    parts = [encoder.encode_to_numpy(p, disallowed_special=()) for p in pieces(text, limit)]
    return (parts[0] if len(parts) == 1 else np.concatenate(parts)).astype(np.int32)


def _encoded(encoder: tiktoken.Encoding, batch: pa.RecordBatch, text: str, limit: int) -> list[np.ndarray]:
    column = batch.column(batch.schema.get_field_index(text))
    return [encode_text(encoder, value.as_py() or "", limit) for value in column]


def _listed(rows: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *map(len, rows)], dtype=np.int32)
    flat = np.concatenate([np.empty(0, np.int32), *rows])
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))


def encode(
    df: DataFrame,
    ranks_path: str,
    pattern: str,
    text: str = "text",
    ids: str = "ids",
    piece_chars: int = PIECE_CHARS,
) -> DataFrame:
    """``df`` with ``ids`` array<int>. ``ranks_path`` must exist on every worker."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[list[pa.Array]]:
        encoder = encoding(ranks_path, pattern)
        for batch in batches:
            yield [_listed(_encoded(encoder, batch, text, piece_chars))]

    return add_arrow_columns(df, [T.StructField(ids, T.ArrayType(T.IntegerType()))], make)


def decode(
    df: DataFrame, ranks_path: str, pattern: str, ids: str = "ids", decoded: str = "decoded"
) -> DataFrame:
    """``df`` with ``decoded`` binary, the bytes of each id list."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[list[pa.Array]]:
        encoder = encoding(ranks_path, pattern)
        for batch in batches:
            rows = [
                encoder.decode_bytes(value.values.to_pylist() if value.is_valid else [])
                for value in batch.column(batch.schema.get_field_index(ids))
            ]
            yield [pa.array(rows, pa.binary())]

    return add_arrow_columns(df, [T.StructField(decoded, T.BinaryType())], make)


def encode_and_decode(
    df: DataFrame,
    ranks_path: str,
    pattern: str,
    text: str = "text",
    ids: str = "ids",
    decoded: str = "decoded",
    piece_chars: int = PIECE_CHARS,
) -> DataFrame:
    """``df`` with the columns of ``encode`` and ``decode``, both made by one worker of a task.

    Half the workers and encoders of the two after each other, and the ids go to the JVM once.
    """

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[list[pa.Array]]:
        encoder = encoding(ranks_path, pattern)
        for batch in batches:
            rows = _encoded(encoder, batch, text, piece_chars)
            back = pa.array([encoder.decode_bytes(row.tolist()) for row in rows], pa.binary())
            yield [_listed(rows), back]

    fields = [T.StructField(ids, T.ArrayType(T.IntegerType())), T.StructField(decoded, T.BinaryType())]
    return add_arrow_columns(df, fields, make)
