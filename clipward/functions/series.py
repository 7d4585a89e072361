"""Features of short series kept as arrays, as column expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

_REACH = 4  # derivatives are fitted over nine samples


def mean(values: Column) -> Column:
    total = F.aggregate(values, F.lit(0.0), lambda acc, v: acc + v.cast("double"))
    return total / F.size(values)


def deviation(values: Column, centre: Column) -> Column:
    """Population standard deviation around a given mean."""
    squares = F.aggregate(
        values, F.lit(0.0), lambda acc, v: acc + (v.cast("double") - centre) * (v.cast("double") - centre)
    )
    return F.sqrt(squares / F.size(values))


def _fitted(y: Column, weights: Sequence[float], start: Column, size: Column) -> Column:
    """Weighted sums over nine samples for every position of a row of the series.

    The row begins at ``start`` and has ``size`` samples; positions near its ends take the
    window of the nearest full one.
    """

    def at(i: Column) -> Column:
        centre = start + F.greatest(F.lit(_REACH), F.least(i, size - _REACH - 1))
        terms = [F.get(y, centre + (k - _REACH)).cast("double") * w for k, w in enumerate(weights)]
        return sum(terms[1:], terms[0])

    return F.transform(F.sequence(F.lit(0), size - 1), at)


def _slope_weights() -> list[float]:
    places = range(-_REACH, _REACH + 1)
    return [k / sum(j * j for j in places) for k in places]


def _bend_weights() -> list[float]:
    """Second derivative of the least-squares parabola."""
    places = range(-_REACH, _REACH + 1)
    centre = sum(k * k for k in places) / len(places)
    norm = sum((k * k - centre) ** 2 for k in places)
    return [2 * (k * k - centre) / norm for k in places]


def slopes(y: Column) -> Column:
    """First derivative at every sample; the series needs nine samples."""
    return _fitted(y, _slope_weights(), F.lit(0), F.size(y))


def three_channels(matrix: Column, height: Column, width: Column) -> Column:
    """A row-major matrix followed by its first and second derivatives along its rows."""
    rows = F.sequence(F.lit(0), height - 1)

    def of(weights: Sequence[float]) -> Column:
        return F.flatten(F.transform(rows, lambda r: _fitted(matrix, weights, r * width, width)))

    plain = F.transform(matrix, lambda x: x.cast("double"))
    return F.transform(
        F.concat(plain, of(_slope_weights()), of(_bend_weights())), lambda x: x.cast("float")
    )


def zero_crossing_rates(y: Column, frame: int, hop: int) -> Column:
    """Share of sign changes per frame; frames are centred, and held constant beyond the ends."""
    n = F.size(y)

    def rate(t: Column) -> Column:
        first = t * hop - frame // 2
        places = F.sequence(
            F.greatest(first + 1, F.lit(1)), F.least(first + frame - 1, n - 1)
        )
        turns = F.filter(places, lambda i: (F.get(y, i) < 0) != (F.get(y, i - 1) < 0))
        some = F.greatest(first + 1, F.lit(1)) <= F.least(first + frame - 1, n - 1)
        return F.when(some, F.size(turns) / F.lit(float(frame))).otherwise(F.lit(0.0))

    return F.transform(F.sequence(F.lit(0), F.floor(n / hop).cast("int")), rate)
