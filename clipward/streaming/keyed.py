"""The rolling monitor with state per key: snapshots in event-time order, whatever the order of arrival."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from clipward import constants as K
from clipward.operators.drift import Reference, knows_confidence
from clipward.operators.monitor import window_scores
from clipward.streaming.jobs import DEFAULT_DELAY

_BLOCK_ROWS = 8192
_ROW = ["us", "tie", "label", "confidence"]
# Rows that wait for the watermark, and the last rows already shown, each as one compressed Arrow stream: as arrays
# of values every row would be boxed and pickled four times over whenever a state is read or written.
_STATE = "wait binary, ring binary"
_ARROW = pa.schema([("us", pa.int64()), ("tie", pa.int64()), ("label", pa.string()), ("confidence", pa.float64())])


def event_time_monitor(
    predictions: DataFrame,
    reference: Reference,
    *,
    delay: str = DEFAULT_DELAY,
    key: str = "model_name",
    ts: str = "ts",
    tie: str = "event_id",
    rows: int = K.MONITOR_WINDOW,
) -> DataFrame:
    """(key, ts, tie, psi_class, ks_confidence, n_observations) per prediction, once its time has passed.

    A row waits in the state of its key until the watermark reaches it; then the rows are taken in the order
    of (ts, tie), so arrivals in any order inside ``delay`` give the snapshots of ``rolling_monitor``. The last
    ``rows - 1`` stay in a ring. A key without new rows is woken by an event-time timeout. Later rows are
    dropped by the engine and counted in its progress metrics.

    The state of a key holds what arrives within ``delay`` and one micro-batch, and one task works on it; bound it by
    the source's rate (``maxFilesPerTrigger``). For a key too busy for that use ``jobs.monitor_stream``, which
    spreads it, in order of arrival.

    Cases: a row without a label only moves the time on (a heartbeat); null confidence counts as 0; null keys
    are one key; rows without ``ts`` never become due and are left out; an empty stream gives no rows; other columns are not read.
    """
    if rows < 1:
        raise ValueError("the window needs at least one row")
    narrow = (
        predictions.where(F.col(ts).isNotNull())
        .withWatermark(ts, delay)
        .select(
            F.col(key).alias("key"),
            F.col(ts).alias("at"),
            F.unix_micros(F.col(ts)).alias("us"),
            F.col(tie).cast("long").alias("tie"),
            F.col("label").cast("string").alias("label"),
            F.coalesce(F.col("confidence").cast("double"), F.lit(0.0)).alias("confidence"),
        )
    )
    kind = narrow.schema["key"].dataType.simpleString()

    def step(
        group: tuple, frames: Iterator[pd.DataFrame], state: GroupState
    ) -> Iterator[pd.DataFrame]:
        passed = state.getCurrentWatermarkMs()
        waiting, ring = _loaded(state.getOption)
        fresh = [f.loc[f["label"].notna(), _ROW] for f in frames] if not state.hasTimedOut else []
        waiting = _joined([waiting, *fresh])
        due = waiting["us"] <= passed * 1000
        ready = waiting[due].sort_values(["us", "tie"], kind="stable")
        waiting = waiting[~due]
        for start in range(0, len(ready), _BLOCK_ROWS):
            block = _joined([ring, ready.iloc[start : start + _BLOCK_ROWS]])
            if len(block) >= rows:
                yield _snapshots(group[0], block, reference, rows)
            ring = block.iloc[max(0, len(block) - rows + 1) :]
        state.update((_packed(waiting), _packed(ring)))
        if len(waiting):
            state.setTimeoutTimestamp(max(int(waiting["us"].min()) // 1000, passed) + 1)

    shown = narrow.groupBy("key").applyInPandasWithState(
        step,
        f"key {kind}, us bigint, tie bigint, psi_class double, ks_confidence double, n_observations bigint",
        _STATE,
        "append",
        GroupStateTimeout.EventTimeTimeout,
    )
    return shown.select(
        F.col("key").alias(key),
        F.timestamp_micros("us").alias(ts),
        F.col("tie").alias(tie),
        "psi_class",
        "ks_confidence",
        "n_observations",
    )


def _packed(part: pd.DataFrame) -> bytes:
    sink = pa.BufferOutputStream()
    options = pa.ipc.IpcWriteOptions(compression="zstd")
    with pa.ipc.new_stream(sink, _ARROW, options=options) as writer:
        writer.write_table(pa.Table.from_pandas(part[_ROW], _ARROW, preserve_index=False))
    return sink.getvalue().to_pybytes()


def _loaded(stored: tuple | None) -> tuple[pd.DataFrame, pd.DataFrame]:
    if stored is None:
        return tuple(_ARROW.empty_table().to_pandas() for _ in range(2))
    return tuple(pa.ipc.open_stream(bytes(data)).read_all().to_pandas() for data in stored)


def _joined(parts: list[pd.DataFrame]) -> pd.DataFrame:
    filled = [p for p in parts if len(p)]
    return pd.concat(filled, ignore_index=True) if filled else parts[0]


def _snapshots(group: object, block: pd.DataFrame, reference: Reference, rows: int) -> pd.DataFrame:
    psi, ks = window_scores(
        block["label"].to_numpy(dtype=object), block["confidence"].to_numpy(dtype=float), reference, rows
    )
    ends = block.iloc[rows - 1 :]
    return pd.DataFrame(
        {
            "key": [group] * len(ends),
            "us": ends["us"].to_numpy(),
            "tie": ends["tie"].to_numpy(),
            "psi_class": psi,
            "ks_confidence": pd.array(np.where(np.isnan(ks), None, ks) if knows_confidence(reference) else [None] * len(ks), dtype="Float64"),
            "n_observations": np.full(len(ends), rows),
        }
    )
