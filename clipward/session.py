"""Session helpers: where shared intermediate data goes, and how lineage is cut."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, named by ``spark.checkpoint.dir``.

    On a local master without that setting, a folder of this application beside the warehouse.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by the cluster")
    warehouse = spark.conf.get("spark.sql.warehouse.dir").rstrip("/")
    return f"{warehouse}/clipward-scratch/{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared folder for one intermediate table."""
    return f"{shared_dir(spark)}/clipward/{label}-{uuid.uuid4().hex}"


def bounded_batches(spark: SparkSession, size: int = 4 << 20) -> None:
    """Lower the session's Arrow batches to ``size`` bytes; a smaller setting stays.

    Rows with payloads are held several times over, by the JVM and by every Python worker of a chain.
    """
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    number, unit = re.fullmatch(r"(-?\d+)\s*([kmgtp]?)b?", spark.conf.get(key).strip().lower()).groups()
    current = int(number) << 10 * " kmgtp".index(unit or " ")
    if current <= 0 or current > size:
        spark.conf.set(key, str(size))


def spread(df: DataFrame, key: str = "path") -> DataFrame:
    """Rows dealt by the hash of their key over two tasks a core, in key order.

    Tables that are small on disk come in few splits, too few for work that is heavy per row. The order makes
    learners that draw by partition and position independent of how the files were cut.
    """
    tasks = 2 * df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(tasks, key).sortWithinPartitions(key)


def stable(df: DataFrame, label: str = "stable") -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Range partitioning samples its bounds, so a plan that is evaluated twice may place rows
    differently; offsets computed on one placement must be applied to the very same one. A
    written table fixes it, survives the loss of executors, and is read column by column.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
