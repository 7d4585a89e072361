"""Exact top-k by inner product of sparse integer rows, exhaustive and term at a time.

Queries and candidates are dealt into blocks of bounded size and every (query block, candidate
block) cell is one group. Inside a cell, candidates are held as postings by term. A block of sparse
query rows scatters its weights times each posting into dense score arrays; a partition selection
keeps each query's k best. A last window merges the cells' winners. All sizes are bounded by the
block sizes, whatever the tables' sizes; the work is queries times candidates, which an exhaustive
search is.

Cases: vectors that are null, or hold a null or a non-finite component, take no part, neither as
query nor as candidate; an empty vector scores 0 with everyone; shorter vectors count as padded with
zeros; ties go to the smaller id; a row never finds its own id; equal rows under several ids are all
found; with fewer than k candidates all are returned; scores are 64-bit integers. Rows with a null id
take no part. Extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

QUERY_BLOCK = 2048
CANDIDATE_BLOCK = 4096
_QUERIES_AT_ONCE = 32


def integer_vectors(df: DataFrame, id_col: str, vector: str, scale: int = 1024) -> DataFrame:
    """(id, v array<long>) with v = floor(scale * component), usable rows only."""
    values = F.col(vector).cast("array<double>")
    usable = F.forall(
        values, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    )
    return df.where(F.col(id_col).isNotNull() & F.coalesce(usable, F.lit(False))).select(
        F.col(id_col).cast("long").alias("id"),
        F.transform(values, lambda x: F.floor(x * F.lit(float(scale)))).alias("v"),
    )


def _postings(vectors: list[np.ndarray]) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """term -> (rows, weights), zeros left out."""
    lengths = np.fromiter(map(len, vectors), np.int64, len(vectors))
    rows = np.repeat(np.arange(len(vectors)), lengths)
    starts = np.repeat(np.cumsum(lengths) - lengths, lengths)
    terms = np.arange(len(rows)) - starts
    weights = np.concatenate([np.empty(0, np.int64), *vectors]).astype(np.int64)
    kept = weights != 0
    rows, terms, weights = rows[kept], terms[kept], weights[kept]
    order = np.argsort(terms, kind="stable")
    names, first = np.unique(terms[order], return_index=True)
    bounds = [*first, len(order)]
    return {
        int(t): (rows[order[a:b]], weights[order[a:b]])
        for t, a, b in zip(names, bounds[:-1], bounds[1:])
    }


def _select(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Positions of the k best by (score descending, id ascending)."""
    if len(scores) > k:
        least = np.partition(scores, len(scores) - k)[len(scores) - k]
        held = np.flatnonzero(scores >= least)
    else:
        held = np.arange(len(scores))
    return held[np.lexsort((ids[held], -scores[held]))[:k]]


def _cell(queries: pd.DataFrame, candidates: pd.DataFrame, k: int) -> Iterator[pd.DataFrame]:
    ids = candidates["id"].to_numpy(np.int64)
    postings = _postings([np.asarray(v, np.int64) for v in candidates["v"]])
    query_ids = queries["id"].to_numpy(np.int64)
    vectors = [np.asarray(v, np.int64) for v in queries["v"]]
    for at in range(0, len(vectors), _QUERIES_AT_ONCE):
        block = vectors[at : at + _QUERIES_AT_ONCE]
        scores = np.zeros((len(block), len(ids)), np.int64)
        for term, (rows, weights) in _postings(block).items():
            if term not in postings:
                continue
            found, held = postings[term]
            if len(found) == len(ids) and len(rows) == len(block):
                scores += np.multiply.outer(weights, held)
            else:
                scores[np.ix_(rows, found)] += np.multiply.outer(weights, held)
        for i, own in enumerate(query_ids[at : at + _QUERIES_AT_ONCE]):
            others = np.flatnonzero(ids != own)
            best = others[_select(scores[i, others], ids[others], k)]
            yield pd.DataFrame({"query_id": own, "vec_id": ids[best], "score": scores[i, best]})


def top_k(
    vectors: DataFrame,
    is_query: Column,
    k: int = 10,
    query_block: int = QUERY_BLOCK,
    candidate_block: int = CANDIDATE_BLOCK,
) -> DataFrame:
    """(query_id, rank, vec_id, score) of the ``k`` best candidates of each query row.

    ``vectors`` has ``id`` and ``v array<long>``; ``is_query`` marks the query set. Every row is a
    candidate. Repeated ids among the queries count once.
    """
    rows = vectors.select("id", "v")
    queries = rows.where(is_query).dropDuplicates(["id"])
    totals = rows.agg(
        F.count(F.lit(1)).alias("n"), F.count(F.when(is_query, 1)).alias("q")
    ).first()
    n_query = max(1, -(-totals["q"] // query_block))
    n_candidate = max(1, -(-totals["n"] // candidate_block))

    def dealt(df: DataFrame, n: int, n_other: int, own: str, other: str) -> DataFrame:
        every = F.explode(F.sequence(F.lit(0), F.lit(n_other - 1)))
        return df.withColumn(own, F.pmod(F.xxhash64("id"), F.lit(n)).cast("int")).withColumn(
            other, every
        )

    left = dealt(queries, n_query, n_candidate, "qb", "cb").repartition(
        n_query * n_candidate, "qb", "cb"
    )
    right = dealt(rows, n_candidate, n_query, "cb", "qb").repartition(
        n_query * n_candidate, "qb", "cb"
    )

    def search(queries: pd.DataFrame, candidates: pd.DataFrame) -> pd.DataFrame:
        found = list(_cell(queries, candidates, k)) if len(queries) and len(candidates) else []
        if not found:
            return pd.DataFrame({n: pd.Series(dtype="int64") for n in ("query_id", "vec_id", "score")})
        return pd.concat(found, ignore_index=True)

    cells = (
        left.groupBy("qb", "cb")
        .cogroup(right.groupBy("qb", "cb"))
        .applyInPandas(search, "query_id long, vec_id long, score long")
    )
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        cells.withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= k)
        .select("query_id", "rank", "vec_id", "score")
    )
