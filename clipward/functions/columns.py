"""Scalar column expressions. Everything here stays inside the JVM."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from clipward import constants as K


def is_finite(value: Column) -> Column:
    """False for null, NaN and both infinities."""
    value = value.cast("double")
    return value.isNotNull() & ~F.isnan(value) & (F.abs(value) < F.lit(float("inf")))


def clip_to(value: Column, low: Column | float, high: Column | float) -> Column:
    return F.least(F.greatest(value, F.lit(low)), F.lit(high))


def points_below(value: Column, points: Sequence[float], *, inclusive: bool) -> Column:
    """How many of the ascending ``points`` lie below ``value`` (or at it, if inclusive).

    Written as a balanced tree of comparisons, so the cost per row is log2(len(points))
    and the values are compared with the points themselves, never divided.
    """
    points = list(points)

    def search(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        middle = (low + high) // 2
        probe = F.lit(float(points[middle]))
        passed = value >= probe if inclusive else value > probe
        return F.when(passed, search(middle + 1, high)).otherwise(search(low, middle))

    return search(0, len(points))


# A comparison tree beyond this size compiles to a method the JVM no longer optimises.
_TREE_POINTS = 24


def cell_index(value: Column, points: Sequence[float]) -> Column:
    """Position of ``value`` among ascending distinct points; null stays null.

    Even cell 2i is the open gap after i points; odd cell 2i+1 is the point i itself. Few
    points are compared in a compiled tree, many by a binary search over a literal array;
    both are column expressions and agree.
    """
    points = [float(p) for p in points]
    if len(points) > _TREE_POINTS:
        return F.when(value.isNotNull(), _binary_search(value.cast("double"), points))

    def search(low: int, high: int) -> Column:
        if low == high:
            return F.lit(2 * low)
        middle = (low + high) // 2
        probe = F.lit(points[middle])
        return (
            F.when(value < probe, search(low, middle))
            .when(value == probe, F.lit(2 * middle + 1))
            .otherwise(search(middle + 1, high))
        )

    return F.when(value.isNotNull(), search(0, len(points)))


def _binary_search(value: Column, points: Sequence[float]) -> Column:
    """The cell by halving steps: the accumulator is the number of points below the value."""
    grid, n = F.lit(list(points)), len(points)
    steps = F.lit([1 << i for i in reversed(range(n.bit_length()))])

    def forward(below: Column, step: Column) -> Column:
        passed = F.try_element_at(grid, below + step) < value
        return F.when((below + step <= n) & passed, below + step).otherwise(below)

    below = F.aggregate(steps, F.lit(0), forward)
    return F.transform(
        F.array(below),
        lambda b: 2 * b + F.when(F.try_element_at(grid, b + 1) == value, 1).otherwise(0),
    )[0]


def bin_index(value: Column, edges: Sequence[float]) -> Column:
    """Histogram bin with half-open bins, the last one closed; values are clipped in."""
    return points_below(value, list(edges)[1:-1], inclusive=True)


def bucket_index(value: Column, bounds: Sequence[float]) -> Column:
    """First ``le`` bucket that holds the value; len(bounds) means the +Inf bucket."""
    return points_below(value, bounds, inclusive=False)


def equal_width_edges(low: float, high: float, bins: int) -> list[float]:
    """Edges of equal-width bins; a constant column gets the range value -/+ 0.5."""
    if bins < 2:
        raise ValueError("a histogram needs at least two bins")
    if low == high:
        low, high = low - 0.5, high + 0.5
    step = (high - low) / bins
    return [low + i * step for i in range(bins)] + [high]


def clip_seed(base_seed: int | Column, key: Column, copy: Column) -> Column:
    """Seed of one augmented copy: leading 32 bits of SHA-256 over base:key:copy."""
    base = base_seed if isinstance(base_seed, Column) else F.lit(str(base_seed))
    text = F.concat_ws(":", base.cast("string"), key, copy.cast("string"))
    return F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("long")


def file_name(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/]*)$", 1)


def file_stem(path: Column) -> Column:
    """File name without its last suffix; a leading dot does not start a suffix."""
    return F.regexp_replace(file_name(path), r"(?<=.)\.[^.]+$", "")


def file_suffix(path: Column) -> Column:
    """Lower-cased last suffix with its dot, or the empty string."""
    return F.lower(F.regexp_extract(file_name(path), r"^.+?(\.[^.]+)$", 1))


def mime_type(header: Column) -> Column:
    return F.lower(F.trim(F.element_at(F.split(F.coalesce(header, F.lit("")), ";"), 1)))


def upload_status(
    filename: Column,
    content_type: Column,
    size: Column,
    *,
    model_ready: Column | None = None,
    decodes: Column | None = None,
    max_bytes: int = K.MAX_UPLOAD_BYTES,
) -> Column:
    """Status of one upload; the first rule that fails decides."""
    bad_type = (file_suffix(F.coalesce(filename, F.lit(""))) != K.WAV_SUFFIX) & ~mime_type(
        content_type
    ).isin(*K.WAV_MIME_TYPES)
    size = F.coalesce(size, F.lit(0))
    status = (
        F.when(size == 0, "http_400").when(size > max_bytes, "http_413").when(bad_type, "http_400")
    )
    if model_ready is not None:
        status = status.when(~F.coalesce(model_ready, F.lit(False)), "http_503")
    if decodes is not None:
        status = status.when(~F.coalesce(decodes, F.lit(False)), "error")
    return status.otherwise("ok")


def pad_or_truncate(signal: Column, length: int | Column) -> Column:
    """Array of exactly ``length`` values: cut at the end or padded with zeros."""
    length = length if isinstance(length, Column) else F.lit(length)
    missing = F.greatest(length - F.size(signal), F.lit(0))
    return F.slice(F.concat(signal, F.array_repeat(F.lit(0.0).cast("float"), missing)), 1, length)


def matrix_rows(flat: Column, height: Column, width: Column) -> Column:
    """Row-major flat array to an array of rows."""
    return F.transform(
        F.sequence(F.lit(0), height - 1), lambda i: F.slice(flat, i * width + 1, width)
    )


def first_argmax(values: Column) -> Column:
    """Zero-based position of the largest value; the first one on ties."""
    return (F.array_position(values, F.array_max(values)) - 1).cast("int")


def severity(value: Column, warn: float = K.PSI_WARN, alert: float = K.PSI_ALERT) -> Column:
    return (
        F.when(value.isNull(), F.lit(None).cast("string"))
        .when(value >= alert, "alert")
        .when(value >= warn, "warn")
        .otherwise("ok")
    )

