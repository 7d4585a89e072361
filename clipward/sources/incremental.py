"""Skip finished work: keys and revisions against a table of what is done."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def pending(
    inputs: DataFrame,
    done: DataFrame,
    keys: Sequence[str],
    revision: str | None = None,
    *,
    force: bool = False,
) -> DataFrame:
    """Input rows whose key (and revision) is not recorded as done."""
    if force:
        return inputs
    on = list(keys) + ([revision] if revision else [])
    return inputs.join(done.select(*on), on, "left_anti")


def complete_stages(outputs: DataFrame, required: Mapping[str, Sequence[str]]) -> DataFrame:
    """(stage, complete): a stage counts only with all its outputs present.

    ``outputs`` has (stage, output); the requirement list is a parameter of the job.
    """
    wanted = F.array(
        *[
            F.struct(F.lit(stage).alias("stage"), F.lit(name).alias("output"))
            for stage, names in required.items()
            for name in names
        ]
    )
    need = outputs.sparkSession.range(1).select(F.inline(wanted))
    found = outputs.select("stage", "output").distinct().withColumn("__found", F.lit(1))
    return (
        need.join(found, ["stage", "output"], "left")
        .groupBy("stage")
        .agg(F.every(F.col("__found").isNotNull()).alias("complete"))
    )


def write_new_partitions(df: DataFrame, path: str, by: str = "fold") -> None:
    """Replace only the partitions that occur in ``df``."""
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(by)
        .parquet(path)
    )
