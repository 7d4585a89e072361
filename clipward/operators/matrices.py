"""Convolution and pooling of small matrices as array expressions.

A matrix is a flat array of height x width values, row by row. Filters are fixed; what is learned is the weighted
softmax head on the pooled responses (``modeling.fit("filters", ...)``), so scoring needs no Python worker.

Cases: a null matrix gives null features; a null element makes the cells it touches null; a matrix of another
length than stated is an error naming both; a matrix smaller than the filter or the pool gives no cells.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Filters over a 3 x 3 neighbourhood, row by row: level, edges in four directions, spot.
FILTERS: Mapping[str, tuple[float, ...]] = {
    "level": (1 / 9,) * 9,
    "across": (-1.0, 0.0, 1.0, -2.0, 0.0, 2.0, -1.0, 0.0, 1.0),
    "down": (-1.0, -2.0, -1.0, 0.0, 0.0, 0.0, 1.0, 2.0, 1.0),
    "falling": (2.0, 1.0, 0.0, 1.0, 0.0, -1.0, 0.0, -1.0, -2.0),
    "rising": (0.0, 1.0, 2.0, -1.0, 0.0, 1.0, -2.0, -1.0, 0.0),
    "spot": (-1.0, -1.0, -1.0, -1.0, 8.0, -1.0, -1.0, -1.0, -1.0),
}
SIDE = 3
POOL = 2


def _cells(height: int, width: int) -> Column:
    n = max(0, height) * max(0, width)
    return F.sequence(F.lit(0), F.lit(n - 1)) if n else F.array().cast("array<int>")


def convolve(matrix: Column, height: int, width: int, weights: Sequence[float], side: int = SIDE) -> Column:
    """Responses of one filter at every place where it fits, cut off below zero."""
    out_width = width - side + 1
    offsets = F.lit([r * width + c for r in range(side) for c in range(side)])
    kernel = F.lit([float(w) for w in weights])

    def response(i: Column) -> Column:
        corner = F.floor(i / out_width).cast("int") * width + i % out_width + 1
        terms = F.zip_with(kernel, offsets, lambda w, o: w * F.element_at(matrix, corner + o).cast("double"))
        return F.greatest(F.aggregate(terms, F.lit(0.0), lambda acc, t: acc + t), F.lit(0.0))

    return F.transform(_cells(height - side + 1, out_width), response)


def max_pool(matrix: Column, height: int, width: int, size: int = POOL) -> Column:
    """The largest value of each full size x size block; what is left over at the edges is not covered."""
    out_width = width // size
    offsets = F.lit([r * width + c for r in range(size) for c in range(size)])

    def largest(i: Column) -> Column:
        corner = F.floor(i / out_width).cast("int") * (width * size) + (i % out_width) * size + 1
        return F.array_max(F.transform(offsets, lambda o: F.element_at(matrix, corner + o)))

    return F.transform(_cells(height // size, out_width), largest)


def feature_count(height: int, width: int) -> int:
    return len(FILTERS) * ((height - SIDE + 1) // POOL) * ((width - SIDE + 1) // POOL)


def filter_features(df: DataFrame, column: str, height: int, width: int, name: str = "features") -> DataFrame:
    """Adds ``name``: pooled responses of all filters, one after the other. Narrow, no shuffle."""
    wrong = F.raise_error(
        F.concat(F.lit(f"a matrix of {height * width} values was expected, not "), F.size(column).cast("string"))
    )
    right = (F.size(column) == height * width) | F.col(column).isNull()
    checked = F.when(right, F.col(column)).otherwise(wrong.cast("array<double>"))
    # A transform binds what it runs over, so the matrix is checked once and each filter's responses are worked
    # out once, not again for every cell that reads them.
    responses = lambda m: F.array(*[convolve(m, height, width, w) for w in FILTERS.values()])
    pool = lambda r: max_pool(r, height - SIDE + 1, width - SIDE + 1)
    pooled = F.transform(F.array(checked), lambda m: F.flatten(F.transform(responses(m), pool)))
    return df.withColumn(name, F.when(F.col(column).isNotNull(), pooled[0]))
