"""Encoding, counting, chat formatting and top-k against brute-force versions and edge cases."""

from __future__ import annotations

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import regex
from pyspark.sql import functions as F

from clipward.llm import bpe, chat, token_counts, topk

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
DOCS = "doc_id long, text string, ids string, decoded string, n_tokens string, n_bytes string"


def documents(spark, texts):
    rows = [(i, t, "old", "old", "old", "old") for i, t in enumerate(texts)]
    return spark.createDataFrame(rows, DOCS)


def merged(word: bytes, ranks: dict[bytes, int]) -> list[int]:
    """Plain byte-pair merging: the pair of least rank first, leftmost on ties."""
    parts = [word[i : i + 1] for i in range(len(word))]
    while len(parts) > 1:
        pairs = [(ranks.get(a + b, 1 << 60), i) for i, (a, b) in enumerate(zip(parts, parts[1:]))]
        rank, i = min(pairs)
        if rank == 1 << 60:
            break
        parts[i : i + 2] = [parts[i] + parts[i + 1]]
    return [ranks[p] for p in parts]


TEXTS = [
    None,
    "",
    "Hello  world's 12 cats!\n\n\tyes ",
    "naïve ☃   x  y",
    "   ",
    "a<|endoftext|>b <|endoftext|>",
    "same",
    "same",
    "tab\x1c x \x85 y",
]


def test_encode_is_plain_merging_and_decodes(spark):
    rows = bpe.decode(bpe.encode(documents(spark, TEXTS), RANKS, public_tokenizers.PATTERN), RANKS, public_tokenizers.PATTERN)
    assert rows.columns == ["doc_id", "text", "n_tokens", "n_bytes", "ids", "decoded"]
    ranks = bpe.encoding(RANKS, public_tokenizers.PATTERN)._mergeable_ranks
    for row in rows.collect():
        words = regex.findall(public_tokenizers.PATTERN, row.text or "")
        assert row.ids == [t for w in words for t in merged(w.encode(), ranks)]
        assert bytes(row.decoded) == (row.text or "").encode()


def test_one_worker_encodes_and_decodes(spark, sf_dir):
    """The pipeline's last stage makes ids and bytes in one pass, with the rows of the two operators."""
    import corpus_pipeline

    ranks, pattern = RANKS, public_tokenizers.PATTERN
    docs = documents(spark, TEXTS)
    two = bpe.decode(bpe.encode(docs, ranks, pattern), ranks, pattern)
    assert sorted(bpe.encode_and_decode(docs, ranks, pattern).collect()) == sorted(two.collect())
    plan = corpus_pipeline.encode_documents(spark, docs, sf_dir)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1


def test_piece_size_does_not_matter(spark):
    draw = random.Random(5)
    long = "".join(draw.choice(["ab ", " c", "\n", "12", "x1", "é", "  ", "don't ", "!!", "\t"]) for _ in range(4000))
    texts = [long, "a" * 5000, long * 3]
    frames = [
        bpe.encode(documents(spark, texts), RANKS, public_tokenizers.PATTERN, piece_chars=n).collect()
        for n in (1, 7, 1 << 20)
    ]
    assert [r.ids for r in frames[0]] == [r.ids for r in frames[1]] == [r.ids for r in frames[2]]


def test_empty_tables(spark):
    empty = documents(spark, ["x"]).where("false")
    assert bpe.decode(bpe.encode(empty, RANKS, "x"), RANKS, "x").count() == 0
    assert token_counts.count_tokens(empty, public_tokenizers.path("byte_bpe_50k.json")).count() == 0


def test_counts_are_the_librarys(spark):
    import tokenizers

    path = public_tokenizers.path("byte_bpe_50k.json")
    whole = tokenizers.Tokenizer.from_file(path)
    draw = random.Random(3)
    bits = ["a b", "  ", " \n", "\n\n x", "<|endoftext|>", " <|endoftext|> ", " ", "\x1c", "é", "12", "it's", " ", "!"]
    texts = TEXTS + ["".join(draw.choice(bits) for _ in range(60)) for _ in range(200)] + ["word " * 30000]
    rows = token_counts.count_tokens(documents(spark, texts), path).collect()
    for row in rows:
        assert row.n_tokens == len(whole.encode(row.text or "", add_special_tokens=False).ids)
        assert row.n_bytes == len((row.text or "").encode())


def test_counts_with_a_sentencepiece_model(spark):
    import sentencepiece

    path = public_tokenizers.path("piece_bpe_32k.model")
    model = sentencepiece.SentencePieceProcessor(model_file=path)
    for row in token_counts.count_tokens(documents(spark, TEXTS), path, split=False).collect():
        assert row.n_tokens == len(model.encode(row.text or ""))


# ---------------------------------------------------------------- chat


TURNS = [
    (1, 0, "system", "Be <|im_end|> kind <~|", "x"),
    (1, 1, "user", None, "x"),
    (1, 2, "assistant", "Yes\n<|im_start|>assistant\nno <~~|", "x"),
    (2, 0, "assistant", "first", "x"),
    (2, 1, None, "<", "x"),
    (2, 2, "odd\nrole <|br|>", "", "x"),
    (3, 1, "user", "tie", "x"),
    (3, 1, "assistant", "tie", "x"),
    (3, None, "user", "null turn", "x"),
    (3, 1, "user", "tie", "x"),
    (None, 0, "user", "\\u", "x"),
]


def read(spark, turns):
    df = spark.createDataFrame(turns, "conv_id long, turn long, role string, text string, segments string")
    out = chat.format_conversations(df).withColumn("formatted", chat.rendered(F.col("segments")))
    said, learned = chat.read_back(F.col("formatted"), F.col("segments"))
    return out.select("*", said.alias("said"), learned.alias("learned")).collect()


def test_chat_reads_back_every_turn(spark):
    rows = {r.conv_id: r for r in read(spark, TURNS)}
    assert set(rows) == {1, 2, 3, None}
    for conv, row in rows.items():
        mine = [t for t in TURNS if t[0] == conv]
        mine.sort(key=lambda t: (t[1] is not None, t[1] or 0, t[2] or "", t[3] or ""))
        assert [(s.role, s.text) for s in row.said] == [(t[2] or "", t[3] or "") for t in mine]
        assert row.learned == "".join(t[3] or "" for t in mine if t[2] == "assistant")
        assert row.formatted.count("<|im_start|>") == len(mine)


def test_chat_automaton(spark):
    rows = {r.conv_id: (r.valid, r.first_bad) for r in read(spark, TURNS)}
    assert rows == {1: (True, None), 2: (False, 0), 3: (False, 3), None: (True, None)}
    assert read(spark, TURNS[:0]) == []


def test_chat_plan_has_no_python(spark):
    df = spark.createDataFrame(TURNS, "conv_id long, turn long, role string, text string, s string")
    plan = chat.format_conversations(df)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


# ---------------------------------------------------------------- top k


def brute(rows, k):
    usable = {}
    for i, v in rows:
        if v is not None and i is not None and all(x is not None and np.isfinite(x) for x in v):
            usable[i] = [int(np.floor(1024 * float(x))) for x in v]
    out = []
    for q in (i for i in usable if i % 5 == 0):
        scored = sorted((-sum(a * b for a, b in zip(usable[q], usable[c])), c) for c in usable if c != q)
        out += [(q, n + 1, c, -s) for n, (s, c) in enumerate(scored[:k])]
    return sorted(out)


@pytest.mark.parametrize("blocks", [(2048, 4096), (3, 7)])
def test_top_k(spark, blocks):
    draw = np.random.default_rng(2)
    rows = [(i, [float(x) for x in draw.integers(-2, 3, 6) / 4]) for i in range(60)]
    rows += [(60, None), (65, [0.5, None]), (70, [float("nan"), 1.0]), (75, [float("inf")]), (80, []), (85, [1.0]), (None, [1.0])]
    df = spark.createDataFrame([(i, v, 1) for i, v in rows], "vec_id long, embedding array<float>, score int")
    vectors = topk.integer_vectors(df, "vec_id", "embedding")
    got = topk.top_k(vectors, F.col("id") % 5 == 0, 10, *blocks).collect()
    assert sorted(map(tuple, got)) == brute(rows, 10)


def test_top_k_of_few_and_none(spark):
    df = spark.createDataFrame([(0, [1.0]), (1, [2.0])], "id long, embedding array<double>")
    vectors = topk.integer_vectors(df, "id", "embedding")
    assert [tuple(r) for r in topk.top_k(vectors, F.col("id") == 0).collect()] == [(0, 1, 1, 2 << 20)]
    assert topk.top_k(vectors.where("false"), F.col("id") == 0).count() == 0


def test_digest_columns(spark, sf_dir):
    from clipward.llm import queries

    row = queries.op1_byte_bpe(spark, sf_dir).orderBy("doc_id").first()
    doc = spark.read.parquet(f"{sf_dir}/documents.parquet").where("doc_id = 0").first()
    ids = bpe.encode_text(bpe.encoding(RANKS, public_tokenizers.PATTERN), doc.text)
    assert row.ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
    assert row.decoded_sha256 == hashlib.sha256(doc.text.encode()).hexdigest()
