"""Token counts of whole texts with a local tokenizer file; only lengths leave the workers.

A text is cut where a white-space-led word begins. A byte-level split never joins characters
across such a place, so the counts of the parts add up to the count of the text. Equal parts are
encoded once per worker task and remembered up to a bound; unseen parts go to the library in
batches of about equal bytes. Texts with unusual white space are cut only at plain spaces between
ordinary characters, and parts of any length are encoded whole.

Cases: null text counts as empty (0 tokens, 0 bytes); special strings inside a text are handled as
the library does by default; empty tables, repeated rows and very long texts need nothing special;
existing columns with an output name are replaced, all others kept.
"""

from __future__ import annotations

import functools
import os
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clipward.llm.frames import add_arrow_columns

BATCH_BYTES = 1 << 18
REMEMBERED = 300_000

WORDS = re.compile(r"\s*\S+|\s+")
UNUSUAL = re.compile(r"[^\S \t\n\r]")
PLAIN_CUT = re.compile(r"(?<=\S)(?=[ \t\n\r])")


def parts(text: str) -> list[str]:
    """``text`` cut before white space that follows an ordinary character."""
    return PLAIN_CUT.split(text) if UNUSUAL.search(text) else WORDS.findall(text)


@functools.lru_cache(maxsize=2)
def load(path: str):
    """A function from texts to token counts, by the library that the file is for."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    if path.endswith(".json"):
        import tokenizers

        tokenizer = tokenizers.Tokenizer.from_file(path)
        tokenizer.no_truncation()
        tokenizer.no_padding()
        return lambda texts: [
            len(e) for e in tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        ]
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return lambda texts: [len(ids) for ids in model.encode(texts, num_threads=1)]


def balanced(texts: list[str], limit: int = BATCH_BYTES) -> Iterator[list[str]]:
    """Consecutive runs of ``texts`` of at most ``limit`` bytes, or one longer text."""
    run: list[str] = []
    held = 0
    for text in texts:
        size = len(text.encode())
        if run and held + size > limit:
            yield run
            run, held = [], 0
        run.append(text)
        held += size
    if run:
        yield run


def count_tokens(
    df: DataFrame,
    tokenizer_path: str,
    text: str = "text",
    n_tokens: str = "n_tokens",
    n_bytes: str = "n_bytes",
    split: bool = True,
    batch_bytes: int = BATCH_BYTES,
) -> DataFrame:
    """``df`` with ``n_bytes`` and ``n_tokens``.

    ``split`` must be off for tokenizers whose pieces can span a space (sentencepiece models and
    files that are not byte-level); texts then go to the library whole.
    """

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[list[pa.Array]]:
        count = load(tokenizer_path)
        known: dict[str, int] = {}
        for batch in batches:
            texts = [v or "" for v in batch.column(batch.schema.get_field_index(text)).to_pylist()]
            if not split:
                counts = [n for run in balanced(texts, batch_bytes) for n in count(run)]
                yield [pa.array(counts, pa.int64())]
                continue
            counts = []
            for held in balanced(texts, 8 * batch_bytes):
                if len(known) > REMEMBERED:
                    known.clear()
                cut = [parts(t) for t in held]
                new = list({p for ps in cut for p in ps if p not in known})
                for run in balanced(new, batch_bytes):
                    known.update(zip(run, count(run)))
                counts += [sum(map(known.__getitem__, ps)) for ps in cut]
            yield [pa.array(counts, pa.int64())]

    counted = add_arrow_columns(df, [T.StructField(n_tokens, T.LongType())], make)
    return counted.withColumn(n_bytes, F.coalesce(F.octet_length(text), F.lit(0)).cast("long"))
