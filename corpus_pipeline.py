"""The corpus pipeline: five stages, each one operator, from documents to encoded documents.

Language identification rejects documents without a language; one document of each near-duplicate
class stays; words of windows that repeat from an earlier document are cut; documents that copy a
test item go; what is left is encoded and decoded. A stage works on all rows that its predecessor
kept; all stages but the last return the columns of documents.

Cases: each stage takes what its operator takes (null texts, null and repeated ids, empty tables);
columns beyond those of documents are carried through by all stages but the last.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from clipward.llm import bpe, decontaminate, language, weighted_minhash, window_dedup
from clipward.session import bounded_batches, scratch_path


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a language; ``und`` ones are rejected."""
    found = language.identify(docs)
    return found.where(F.col("language") != language.UNKNOWN).select(*docs.columns)


def keep_one_of_each_class(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each near-duplicate class."""
    return weighted_minhash.keep_one(docs)


def cut_repeated_windows(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the words of windows that an earlier document holds."""
    cut = window_dedup.remove_repeats(docs)
    if "n_chars" in docs.columns:
        new = F.when(F.col("n_removed") > 0, F.char_length("text").cast("long"))
        cut = cut.withColumn("n_chars", new.otherwise(F.col("n_chars")))
    return cut.select(*docs.columns)


def drop_test_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no copy of a test item."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    marked = docs.withColumn("__text_key", F.sha2(F.coalesce("text", F.lit("")), 256))
    copies = decontaminate.find_copies(marked, items, ids=("doc_id", "__text_key"))
    copies = copies.select(F.col("doc_id").alias("__id"), "__text_key").distinct()
    same = F.col("doc_id").eqNullSafe(F.col("__id")) & (
        marked["__text_key"] == copies["__text_key"]
    )
    return marked.join(copies, same, "left_anti").select(*docs.columns)


def encode_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids, and the text decoded from them."""
    ranks, pattern = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    bounded_batches(spark)
    encoded = bpe.encode_and_decode(docs.select("doc_id", "text"), ranks, pattern)
    return encoded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        "ids",
        F.col("decoded").cast("string").alias("decoded"),
    )


STAGES = [
    ("language", keep_known_languages),
    ("near_duplicates", keep_one_of_each_class),
    ("repeated_windows", cut_repeated_windows),
    ("decontamination", drop_test_copies),
    ("encoding", encode_documents),
]

# Learned, sampled and aligned stages have no SQL form; tests/llm holds the brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            path = scratch_path(spark, f"stage-{name}")
            docs.write.parquet(path)
            docs = spark.read.schema(docs.schema).parquet(path)
    return docs
