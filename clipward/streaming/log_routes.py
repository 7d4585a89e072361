"""The JSON-lines log as a stream of text: every line is routed, what cannot be read is kept aside."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from clipward import schemas as S

#: What becomes of a line, in the order in which the rules are tried.
ROUTES = ("blank", "malformed", "not_object", "other_event", "not_ok", "no_label", "kept")
_FIELDS = [f.name for f in S.PREDICTION]


def read_lines(spark: SparkSession, path: str, *, files_per_batch: int = 100) -> DataFrame:
    """(value, file): the log folder as a stream of lines with the file each came from."""
    lines = spark.readStream.option("maxFilesPerTrigger", files_per_batch).text(path)
    return lines.select("value", F.col("_metadata.file_path").alias("file"))


def routed(lines: DataFrame, column: str = "value") -> DataFrame:
    """Adds ``route`` and the log's fields; a batch or a stream, one parse a line, no shuffle.

    The rules are those of ``prediction_log.parse_log``: its rows are the lines routed "kept". Lines that are
    not JSON are "malformed", instead of an error or a silent skip. Fields are filled for kept lines only; a
    null confidence is 0 there. A null line counts as blank.
    """
    text = F.trim(F.coalesce(F.col(column), F.lit("")))
    keys = F.json_object_keys(text)
    parsed = F.struct(
        F.from_json(text, S.PREDICTION).alias("r"),
        F.array_contains(keys, "status").alias("has_status"),
        keys.isNotNull().alias("is_object"),
        (text == "").alias("is_blank"),
        # Only text without object keys is looked at again, to tell other JSON from no JSON.
        F.when(keys.isNull(), F.try_parse_json(text).isNotNull()).alias("is_json"),
    )

    def route(x: Column) -> Column:
        ok = ~x["has_status"] | F.coalesce(x["r"]["status"] == "ok", F.lit(False))
        named = F.coalesce(x["r"]["event"] == "prediction", F.lit(True))
        return (
            F.when(x["is_blank"], "blank")
            .when(~x["is_object"] & ~x["is_json"], "malformed")
            .when(~x["is_object"], "not_object")
            .when(~named, "other_event")
            .when(~ok, "not_ok")
            .when(x["r"]["label"].isNull(), "no_label")
            .otherwise("kept")
        )

    # A transform over a one-element array parses each line once, however many columns read it.
    found = F.transform(F.array(parsed), lambda x: F.struct(route(x).alias("route"), x["r"].alias("r")))
    rest = [F.col(c) for c in lines.columns if c not in ("route", *_FIELDS)]
    opened = lines.select(*rest, F.inline(found).alias("route", "__r"))
    value = lambda n: F.when(F.col("route") == "kept", F.col("__r")[n])
    zero = F.when(F.col("route") == "kept", F.lit(0.0))
    fields = {n: F.coalesce(value(n), zero) if n == "confidence" else value(n) for n in _FIELDS}
    return opened.withColumns(fields).drop("__r")


def write_routed(rows: DataFrame, path: str, routes: Sequence[str] = ROUTES) -> dict[str, int]:
    """Write the rows in one folder per route; the counts come from the very job that writes, not from a second scan."""
    seen = Observation()
    counts = [F.count_if(F.col("route") == r).alias(r) for r in routes]
    rows.observe(seen, *counts).write.mode("overwrite").partitionBy("route").parquet(path)
    return {r: int(seen.get[r]) for r in routes}


def route_stream(lines: DataFrame, output: str, counts: str, checkpoint: str) -> StreamingQuery:
    """Route a stream of lines: ``output``/turn=N/route=... and one row of counts a micro-batch in ``counts``.

    Both are written per batch id and replaced when a batch is run again, so a restart gives every line once.
    The route "malformed" is the quarantine: the text and the file of every line that is not JSON.
    """

    def step(batch: DataFrame, batch_id: int) -> None:
        found = write_routed(routed(batch), f"{output}/turn={batch_id}")
        row = batch.sparkSession.createDataFrame([tuple(found.values())], ", ".join(f"{r} long" for r in found))
        row.coalesce(1).write.mode("overwrite").parquet(f"{counts}/turn={batch_id}")

    return (
        lines.writeStream.foreachBatch(step)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
