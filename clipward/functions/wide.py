"""Wide tables: the same aggregate over many columns.

One aggregate expression per column makes generated code too large to compile, and one
row per value makes every value pay for a hash lookup. Columns are therefore taken in
groups of eight: a row is expanded into one row per group, and the aggregate runs over
eight columns at a time. With up to eight columns nothing is expanded. Counts per cell are
taken in Arrow batches, a whole partition into one small table.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clipward.functions.columns import is_finite

WIDTH = 8


def aggregate_columns(
    df: DataFrame,
    columns: Sequence[str],
    statistics: Mapping[str, Callable[[Column], Column]],
    prepare: Callable[[Column], Column] = lambda c: c,
) -> DataFrame:
    """(position, feature, one column per statistic), computed in one scan.

    ``prepare`` is applied after the expansion, on the eight columns of a group.
    """
    columns = list(columns)
    width = min(WIDTH, len(columns))
    groups = range(-(-len(columns) // width))

    def slot(group: int, j: int) -> Column:
        i = group * width + j
        return F.col(columns[i]).cast("double") if i < len(columns) else F.lit(None).cast("double")

    if len(groups) == 1:
        expanded = df.select(F.lit(0).alias("g"), *[slot(0, j).alias(f"x{j}") for j in range(width)])
    else:
        expanded = df.select(
            F.inline(
                F.array(
                    *[
                        F.struct(F.lit(g).alias("g"), *[slot(g, j).alias(f"x{j}") for j in range(width)])
                        for g in groups
                    ]
                )
            )
        )
    per_group = expanded.groupBy("g").agg(
        *[
            make(prepare(F.col(f"x{j}"))).alias(f"{name}_{j}")
            for j in range(width)
            for name, make in statistics.items()
        ]
    )
    rows = F.array(
        *[
            F.struct(
                (F.col("g") * width + j).alias("position"),
                *[F.col(f"{name}_{j}").alias(name) for name in statistics],
            )
            for j in range(width)
        ]
    )
    names = F.lit(columns)
    return (
        per_group.select(F.inline(rows))
        .where(F.col("position") < len(columns))
        .withColumn("feature", F.element_at(names, F.col("position") + 1))
        .select("position", "feature", *statistics)
    )


def cell_counts(df: DataFrame, points: Mapping[str, Sequence[float]]) -> DataFrame:
    """(position, cell, n): finite values of each column counted per cell of its points.

    Cells are numbered as by ``columns.cell_index``. A task counts its whole partition into one
    array per column and sends at most columns x cells rows, so no value pays for a hash lookup.
    """
    grids = [np.asarray(list(p), dtype=float) for p in points.values()]
    values = [F.when(is_finite(F.col(c)), F.col(c).cast("double")).alias(f"x{i}") for i, c in enumerate(points)]

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = [np.zeros(2 * len(grid) + 1, dtype=np.int64) for grid in grids]
        for batch in batches:
            for i, grid in enumerate(grids):
                x = batch.column(i).drop_null().to_numpy(zero_copy_only=False)
                below = np.searchsorted(grid, x)
                at = np.append(grid, np.nan)[below] == x
                totals[i] += np.bincount(2 * below + at, minlength=len(totals[i]))
        held = [np.flatnonzero(t) for t in totals]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.repeat(np.arange(len(held)), [len(h) for h in held]), pa.int32()),
                pa.array(np.concatenate(held), pa.int32()),
                pa.array(np.concatenate([t[h] for t, h in zip(totals, held)]), pa.int64()),
            ],
            ["position", "cell", "n"],
        )

    found = df.select(*values).mapInArrow(count, "position int, cell int, n long")
    return found.groupBy("position", "cell").agg(F.sum("n").alias("n"))
