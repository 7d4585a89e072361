"""Distributed order against a plain pandas sort, with heavy ties and one hot group."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from clipward import constants as K
from clipward.operators import monitor
from clipward.operators.ordering import (
    exact_quantiles,
    number_rows,
    overlapping_blocks,
    running_totals,
)


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of the rows in one group, half of all values equal."""
    rng = np.random.default_rng(5)
    n = 6000
    frame = pd.DataFrame(
        {
            "g": np.where(rng.random(n) < 0.34, "hot", rng.integers(0, 40, n).astype(str)),
            "v": np.where(rng.random(n) < 0.5, 7.0, rng.normal(size=n).round(2)),
            "id": np.arange(n),
        }
    )
    return frame, spark.createDataFrame(frame).repartition(13).persist()


def test_number_rows_is_a_total_order(skewed):
    frame, df = skewed
    got = number_rows(df, ["v", "id"], ["g"]).toPandas().sort_values(["g", "v", "id"])
    assert (got.groupby("g").cumcount() + 1 == got["row_no"]).all()
    whole = number_rows(df, ["v", "id"]).toPandas().sort_values(["v", "id"])
    assert list(whole["row_no"]) == list(range(1, len(frame) + 1))


def test_running_totals(skewed):
    frame, df = skewed
    counted = df.groupBy("g", "v").agg(F.count(F.lit(1)).alias("n"))
    got = running_totals(counted, ["v"], ["n"], ["g"]).toPandas().sort_values(["g", "v"])
    assert (got.groupby("g")["n"].cumsum() == got["cum_n"]).all()
    assert got.groupby("g")["cum_n"].max().sum() == len(frame)


@pytest.mark.parametrize("n_quantiles", [2, 5, 101])
def test_exact_quantiles(skewed, n_quantiles):
    frame, df = skewed
    got = exact_quantiles(df, "v", n_quantiles, ["g"]).toPandas()
    probs = np.linspace(0, 1, n_quantiles)
    for name, part in got.groupby("g"):
        want = np.quantile(frame.loc[frame.g == name, "v"], probs)
        assert np.allclose(part.sort_values("q_index")["value"], want, atol=1e-12)
    assert len(got) == n_quantiles * frame.g.nunique()


def test_exact_quantiles_edge_cases(spark):
    one = spark.createDataFrame([(3.5,)], "v double")
    assert {r["value"] for r in exact_quantiles(one, "v", 3).collect()} == {3.5}
    assert exact_quantiles(one.where("v < 0"), "v", 3).collect() == []
    with pytest.raises(ValueError):
        exact_quantiles(one, "v", 1)


def test_blocks_give_the_plain_window_result(spark, skewed, monkeypatch):
    _, df = skewed
    monkeypatch.setattr(monitor, "_BLOCK_ROWS", 50)
    got = monitor.trailing_frame(
        df, key="g", order=["v", "id"], rows=20, aggregates={"s": lambda w: F.sum("id").over(w)}
    )
    plain = Window.partitionBy("g").orderBy("v", "id").rowsBetween(-19, 0)
    want = df.withColumn("s", F.sum("id").over(plain))
    assert sorted(map(tuple, got.select("id", "s").collect())) == sorted(
        map(tuple, want.select("id", "s").collect())
    )


def test_blocks_are_bounded(spark):
    rows = spark.range(1, 1001).withColumnRenamed("id", "row_no")
    sizes = overlapping_blocks(rows, "row_no", 9, 100).groupBy("block").count().toPandas()
    assert sizes["count"].max() <= 109
    assert K.MONITOR_WINDOW <= monitor._BLOCK_ROWS
