"""Merged sketches against exact answers."""

from __future__ import annotations

import numpy as np
import pytest

from clipward.operators import sketches


def test_merged_day_sketches_stay_within_the_rank_error(spark):
    # One day holds half of all rows; many ties; nulls and NaN do not count.
    rows = spark.range(60000).selectExpr(
        "IF(id % 2 = 0, 0, id % 30) AS day",
        "CASE WHEN id % 1000 = 0 THEN NULL WHEN id % 1000 = 1 THEN double('NaN') ELSE floor(pow(rand(3), 2) * 500) END AS x",
    ).cache()
    stored = sketches.quantile_sketches(rows, "x", "day")
    assert stored.count() == 16  # day 0 and the fifteen odd days
    merged = sketches.merged_quantiles(stored, 100)
    row = merged.first()
    exact = np.sort([r.x for r in rows.where("x IS NOT NULL AND NOT isnan(x)").select("x").collect()])
    assert row["n"] == len(exact) and len(row["values"]) == 101
    low = np.searchsorted(exact, row["values"]) / len(exact)
    high = np.searchsorted(exact, row["values"], side="right") / len(exact)
    rank = np.arange(101) / 100
    assert (low <= rank + sketches.KLL_RANK_ERROR).all() and (high >= rank - sketches.KLL_RANK_ERROR).all()


def test_rank_errors_are_exact(spark):
    rows = spark.createDataFrame([(x,) for x in [1.0, 1.0, 2.0, 3.0, 5.0, None]], "x double")
    points = spark.createDataFrame([([1.0, 2.5, 5.0],)], "values array<double>")
    got = {r.q_index: (r.low, r.high) for r in sketches.rank_errors(rows, "x", points).collect()}
    assert got == {0: (0.0, 0.4), 1: (pytest.approx(0.6), pytest.approx(0.6)), 2: (0.8, 1.0)}


def test_distinct_counts_merge_and_intersect(spark):
    rows = spark.range(40000).selectExpr("id % 4 AS fold", "id DIV 8 + 2000 * (id % 4) AS v", "id % 3 + id % 4 AS c")
    stored = sketches.distinct_sketches(rows, "v", "fold")
    exact = rows.select("v").distinct().count()
    assert sketches.merged_distinct(stored).first()[0] == pytest.approx(exact, rel=sketches.HLL_ERROR)
    few = sketches.distinct_sketches(rows, "c", "fold")
    assert sketches.overlap(few.where("fold < 2")).first()[0] == 2
    assert sketches.overlap(few).first()[0] == 0
    assert sketches.overlap(stored.where("false")).count() <= 1
