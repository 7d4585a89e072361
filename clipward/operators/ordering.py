"""Global order without a global window: row numbers, running totals, exact quantiles.

Rows are dealt by ranges of the sort key, so a group of any weight is spread over many
tasks. Each range works on its own rows, and one small table of (group, range) totals
turns local results into global ones. No task ever holds a whole group. A null group is
a group of its own.

Running totals take their ranges from a few bounds of the value itself, so a row's range
is a function of the row and nothing has to be stored; the bounds steer balance only, never
the result. Row numbers, whose order can be any columns, store a range-partitioned table.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clipward.functions.columns import points_below
from clipward.session import stable

_SLOT = "__slot"
_PART = "__part"
# monotonically_increasing_id keeps the partition in the upper bits, the row below.
_ROW_BITS = 33
# Ranges of one running total; the comparison tree over their bounds stays compiled.
_RANGES = 24


def _ranged(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    ordered = df.repartitionByRange(*[F.col(k) for k in keys]).sortWithinPartitions(*keys)
    return stable(ordered.withColumn(_SLOT, F.monotonically_increasing_id())).withColumn(
        _PART, F.shiftright(_SLOT, _ROW_BITS)
    )


def join_on(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Join on equal keys, null being equal to null."""
    renamed = right.withColumnsRenamed({name: f"__of_{name}" for name in keys})
    same = F.lit(True)
    for name in keys:
        same = same & F.col(name).eqNullSafe(F.col(f"__of_{name}"))
    return left.join(renamed, same, how).drop(*[f"__of_{name}" for name in keys])


def number_rows(
    df: DataFrame, order: Sequence[str], group: Sequence[str] = (), name: str = "row_no"
) -> DataFrame:
    """1-based position of every row in its group, under the given order."""
    # With no group, one constant group keeps a single code path.
    keyed = df if group else df.withColumn("__all", F.lit(0))
    group = list(group) or ["__all"]
    ranged = _ranged(keyed, [*group, *order])
    totals = ranged.groupBy(*group, _PART).agg(
        F.count(F.lit(1)).alias("__rows"), F.min(_SLOT).alias("__first")
    )
    # One row per (group, partition).
    earlier = Window.partitionBy(*group).orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        *group,
        _PART,
        (F.coalesce(F.sum("__rows").over(earlier), F.lit(0)) - F.col("__first") + 1).alias("__shift"),
    )
    out = join_on(ranged, offsets, [*group, _PART]).withColumn(
        name, F.col("__shift") + F.col(_SLOT)
    )
    return out.select(*df.columns, name)


def _range_of(df: DataFrame, column: str) -> Column:
    """Number of the value range a row falls into; nulls come first, as they sort."""
    n = min(_RANGES, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    shares = [i / n for i in range(1, n)]
    value = F.col(column).cast("double")
    bounds = df.agg(F.percentile_approx(value, shares, 1000)).first()[0] if shares else []
    return points_below(value, sorted(set(bounds or [])), inclusive=True)


def running_totals(
    df: DataFrame, order: Sequence[str], sums: Sequence[str], group: Sequence[str] = ()
) -> DataFrame:
    """Adds ``cum_<c>``, the sum over all rows up to and including this one, and ``total_<c>``.

    ``order`` begins with a numeric column and must be unique within a group; pre-aggregate
    first, which also folds any heavily repeated value into one row.
    """
    keyed = df if group else df.withColumn("__all", F.lit(0))
    group = list(group) or ["__all"]
    dealt = keyed.withColumn(_PART, _range_of(df, order[0]))
    totals = dealt.groupBy(*group, _PART).agg(*[F.sum(c).alias(c) for c in sums])
    whole = Window.partitionBy(*group)
    earlier = whole.orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    # At most one row per (group, range).
    offsets = totals.select(
        *group,
        _PART,
        *[F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"__before_{c}") for c in sums],
        *[F.sum(c).over(whole).alias(f"total_{c}") for c in sums],
    )
    local = Window.partitionBy(*group, _PART).orderBy(*order).rowsBetween(
        Window.unboundedPreceding, 0
    )
    within = dealt.withColumns({f"__within_{c}": F.sum(c).over(local) for c in sums})
    return join_on(within, offsets, [*group, _PART]).select(
        *df.columns,
        *[(F.col(f"__before_{c}") + F.col(f"__within_{c}")).alias(f"cum_{c}") for c in sums],
        *[f"total_{c}" for c in sums],
    )


def exact_quantiles(
    df: DataFrame, value: str, n_quantiles: int, group: Sequence[str] = ()
) -> DataFrame:
    """Evenly spaced, linearly interpolated quantiles: (group, q_index, value).

    Values are counted first, so a value that fills a third of the table is one row.
    Each counted value knows the interval of ranks it covers and picks the target
    ranks that fall into it by integer arithmetic.
    """
    if n_quantiles < 2:
        raise ValueError("at least two quantiles are needed")
    group = list(group)
    counted = (
        df.where(F.col(value).isNotNull())
        .groupBy(*group, F.col(value).cast("double").alias("v"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    ranked = running_totals(counted, ["v"], ["n"], group).withColumnRenamed("total_n", "size")
    steps = n_quantiles - 1

    def covered(first: Column, last: Column) -> Column:
        """Indexes i whose rank floor(i * (size - 1) / steps) lies in first..last."""
        span = F.greatest(F.col("size") - 1, F.lit(1))
        # A guess that is one too wide on both sides, then the exact test.
        low = F.greatest(F.floor(first * steps / span).cast("long") - 1, F.lit(0))
        high = F.least(F.floor((last + 1) * steps / span).cast("long") + 1, F.lit(steps))
        rank = lambda i: _div(i * (F.col("size") - 1), steps)
        return F.when(
            high >= low,
            F.filter(F.sequence(low, high), lambda i: (rank(i) >= first) & (rank(i) <= last)),
        ).otherwise(F.array().cast("array<bigint>"))

    def tagged(indexes: Column, upper: int) -> Column:
        return F.transform(indexes, lambda i: F.struct(i.alias("q"), F.lit(upper).alias("up")))

    first, last = F.col("cum_n") - F.col("n"), F.col("cum_n") - 1
    hits = ranked.select(
        *group,
        "v",
        "size",
        F.explode(
            F.concat(
                tagged(covered(first, last), 0), tagged(covered(first - 1, last - 1), 1)
            )
        ).alias("hit"),
    )
    fraction = F.pmod(F.col("q_index") * (F.col("size") - 1), F.lit(steps)) / F.lit(float(steps))
    return (
        hits.groupBy(*group, F.col("hit.q").alias("q_index"))
        .agg(
            F.max("size").alias("size"),
            F.max(F.when(F.col("hit.up") == 0, F.col("v"))).alias("low"),
            F.max(F.when(F.col("hit.up") == 1, F.col("v"))).alias("high"),
        )
        .where(F.col("low").isNotNull())
        .select(
            *group,
            F.col("q_index").cast("int").alias("q_index"),
            (
                F.col("low") + F.coalesce(F.col("high") - F.col("low"), F.lit(0.0)) * fraction
            ).alias("value"),
        )
    )


def _div(numerator: Column, divisor: int) -> Column:
    """Integer division of non-negative longs."""
    return ((numerator - F.pmod(numerator, F.lit(divisor))) / divisor).cast("long")


def overlapping_blocks(
    numbered: DataFrame, row_no: str, reach: int, block_rows: int = 8192
) -> DataFrame:
    """Cut a numbered sequence into equal blocks that also carry the rows before them.

    Adds ``block`` and ``is_context``. Each block holds ``block_rows`` rows of its own and
    the ``reach`` rows before them, so a trailing frame of reach + 1 rows can be computed
    inside the block, whatever the weight of the group it comes from.
    """
    block_rows = max(block_rows, reach)
    position = F.col(row_no) - 1
    own = F.floor(position / block_rows).cast("long")
    # The last `reach` rows of a block are context for the next one.
    feeds_next = F.pmod(position, F.lit(block_rows)) >= block_rows - reach
    blocks = F.when(feeds_next & F.lit(reach > 0), F.array(own, own + 1)).otherwise(F.array(own))
    return (
        numbered.withColumn("__own", own)
        .withColumn("block", F.explode(blocks))
        .withColumn("is_context", F.col("block") != F.col("__own"))
        .drop("__own")
    )
