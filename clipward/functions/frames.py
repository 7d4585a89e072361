"""Pandas frames handed back to Spark."""

from __future__ import annotations

from collections.abc import Sequence

import pandas as pd


def object_frame(rows: Sequence[dict], names: Sequence[str]) -> pd.DataFrame:
    """Rows as object columns, so that a missing value stays a null of its own type."""
    return pd.DataFrame({n: pd.Series([r.get(n) for r in rows], dtype=object) for n in names})
