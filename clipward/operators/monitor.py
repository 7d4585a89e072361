"""The rolling drift monitor: a snapshot of the last N predictions at every prediction."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

from clipward import constants as K
from clipward.functions import distribution as D
from clipward.operators.drift import Reference, knows_confidence
from clipward.operators.ordering import number_rows, overlapping_blocks

_BLOCK_ROWS = 8192


def trailing_frame(
    df: DataFrame,
    *,
    key: str,
    order: Sequence[str],
    rows: int,
    aggregates: Mapping[str, Callable[[WindowSpec], Column]],
) -> DataFrame:
    """Window aggregates over the last ``rows`` rows of each key.

    The sequence of a key is numbered with a distributed sort and cut into blocks that
    carry the ``rows - 1`` rows before them, so a key that owns a third of the table is
    worked on by as many tasks as it has blocks.
    """
    numbered = number_rows(df, order, [key], "row_no")
    blocks = overlapping_blocks(numbered, "row_no", rows - 1, _BLOCK_ROWS)
    frame = Window.partitionBy(key, "block").orderBy("row_no").rowsBetween(-(rows - 1), 0)
    return (
        blocks.withColumns({name: make(frame) for name, make in aggregates.items()})
        .where(~F.col("is_context"))
        .drop("block", "is_context", "row_no")
    )


def _window_counts(hits: np.ndarray, rows: int) -> np.ndarray:
    """Column sums over each full trailing window of ``rows`` rows (row i ends window i)."""
    running = np.cumsum(hits, axis=0, dtype=np.int64)
    out = running[rows - 1 :].copy()
    out[1:] -= running[:-rows]
    return out


def window_scores(
    labels: np.ndarray, confidences: np.ndarray, reference: Reference, rows: int
) -> tuple[np.ndarray, np.ndarray]:
    """(psi, ks) of every full trailing window of one ordered block; ks is NaN when unset."""
    names = np.asarray(reference.class_names, dtype=object)
    extra = [v for c, v in reference.class_prior.items() if c not in set(names)]
    prior = np.array([reference.class_prior.get(c, 0.0) for c in names] + extra)
    counts = _window_counts(labels[:, None] == names[None, :], rows).astype(float)
    known = counts.sum(axis=1, keepdims=True)
    if (known == 0).any():
        raise ValueError("a window holds no known label")
    live = np.hstack([counts / known, np.zeros((len(counts), len(extra)))])
    e, a = np.maximum(prior, K.PSI_FLOOR), np.maximum(live, K.PSI_FLOOR)
    psi = ((a - e) * np.log(a / e)).sum(axis=1)
    if not knows_confidence(reference):
        return psi, np.full(len(psi), np.nan)
    points, cdf = D.reference_points(reference.confidence_quantiles)
    edges = np.asarray(points)
    at = _window_counts(confidences[:, None] <= edges[None, :], rows) / rows
    before = _window_counts(confidences[:, None] < edges[None, :], rows) / rows
    steps = np.asarray(cdf)
    ks = np.maximum(
        np.abs(at - steps[2::2][None, :]).max(axis=1),
        np.abs(before - steps[:-1:2][None, :]).max(axis=1),
    )
    return psi, ks


def rolling_monitor(
    predictions: DataFrame,
    reference: Reference,
    *,
    key: str = "model_name",
    order: Sequence[str] = ("ts", "event_id"),
    rows: int = K.MONITOR_WINDOW,
    label: str = "label",
    confidence: str = "confidence",
) -> DataFrame:
    """(key, order columns, psi_class, ks_confidence, n_observations) per prediction.

    Nothing is emitted for the first ``rows - 1`` predictions of a key. Blocks have a fixed
    number of rows, so a task's memory does not depend on how much one key holds.
    """
    if rows < 1:
        raise ValueError("the window needs at least one row")
    narrow = predictions.select(key, *order, label, confidence)
    numbered = number_rows(narrow, order, [key], "row_no")
    blocks = overlapping_blocks(numbered, "row_no", rows - 1, _BLOCK_ROWS)
    schema = narrow.select(key, *order).schema
    types = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    out = f"{types}, psi_class double, ks_confidence double, n_observations long"

    def run(block: pd.DataFrame) -> pd.DataFrame:
        block = block.sort_values("row_no", kind="stable")
        names = [key, *order]
        if len(block) < rows:
            return block[names].iloc[:0].assign(psi_class=0.0, ks_confidence=0.0, n_observations=0)
        psi, ks = window_scores(
            block[label].to_numpy(dtype=object),
            block[confidence].fillna(0.0).to_numpy(dtype=float),
            reference,
            rows,
        )
        ends = block.iloc[rows - 1 :]
        result = ends[names].assign(
            psi_class=psi, ks_confidence=pd.array(ks, dtype="Float64"), n_observations=rows
        )
        if not knows_confidence(reference):
            result["ks_confidence"] = None
        return result[~ends["is_context"].to_numpy()]

    return blocks.groupBy(key, "block").applyInPandas(run, out)

