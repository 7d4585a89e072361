"""Distribution distances over small per-group arrays, as column expressions."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from clipward import constants as K


def psi_term(expected: Column, actual: Column, floor: float = K.PSI_FLOOR) -> Column:
    """One category's share of the population stability index; both sides are floored."""
    e = F.greatest(F.coalesce(expected, F.lit(0.0)), F.lit(floor))
    a = F.greatest(F.coalesce(actual, F.lit(0.0)), F.lit(floor))
    return (a - e) * F.ln(a / e)


def dense_counts(sparse: Column, size: int | Column) -> Column:
    """Array of ``size`` counts from a map of index to count; absent means zero."""
    size = size if isinstance(size, Column) else F.lit(size)
    return F.transform(
        F.sequence(F.lit(0), size - 1),
        lambda i: F.coalesce(F.element_at(sparse, i), F.lit(0)).cast("long"),
    )


def array_total(values: Column, kind: str = "double") -> Column:
    return F.aggregate(values, F.lit(0).cast(kind), lambda acc, v: acc + v.cast(kind))


def psi_of_arrays(expected: Column, actual_counts: Column) -> Column:
    total = array_total(actual_counts)
    return array_total(
        F.zip_with(expected, actual_counts, lambda e, c: psi_term(e, c.cast("double") / total))
    )


def ks_of_cells(reference_cdf: Column, live_counts: Column) -> Column:
    """Largest gap between a step CDF and live counts given on the same cells.

    The reference has steps only at its points, so the supremum is reached at a point
    or just before it; those are exactly the cell ends of ``cell_index``.
    """
    total = array_total(live_counts)
    start = F.struct(F.lit(0.0).alias("seen"), F.lit(0.0).alias("gap"))
    pairs = F.arrays_zip(reference_cdf.alias("cdf"), live_counts.alias("n"))

    def step(acc: Column, pair: Column) -> Column:
        seen = acc["seen"] + pair["n"].cast("double")
        gap = F.greatest(acc["gap"], F.abs(pair["cdf"] - seen / total))
        return F.struct(seen.alias("seen"), gap.alias("gap"))

    return F.aggregate(pairs, start, step, lambda acc: acc["gap"])


def reference_points(samples: Sequence[float]) -> tuple[list[float], list[float]]:
    """Distinct points of a small sample, and its CDF at the end of every cell."""
    weights: dict[float, int] = {}
    for value in samples:
        weights[float(value)] = weights.get(float(value), 0) + 1
    return weighted_points(weights)


def weighted_points(weights: Mapping[float, float]) -> tuple[list[float], list[float]]:
    points = sorted(weights)
    total = float(sum(weights.values()))
    cdf, seen = [0.0], 0.0
    for point in points:
        seen += weights[point]
        cdf += [seen / total, seen / total]
    return points, cdf
