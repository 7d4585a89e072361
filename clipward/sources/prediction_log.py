"""The prediction log: JSON lines in, JSON lines out."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clipward import schemas as S


def iso_time(moment: Column | None = None) -> Column:
    """A timestamp, by default the current one, as ISO text in UTC with milliseconds."""
    moment = F.current_timestamp() if moment is None else moment
    utc = F.to_utc_timestamp(moment.cast("timestamp"), F.current_timezone())
    return F.date_format(utc, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")


def with_time(log: DataFrame, ts: str = "ts", name: str = "at") -> DataFrame:
    """Adds the moment of the ISO text in ``ts``; null where the text is no time."""
    return log.withColumn(name, F.col(ts).try_cast("timestamp"))


def log_line(
    *,
    ts: Column | None = None,
    status: Column,
    label: Column,
    confidence: Column,
    model_name: Column,
    latency_s: Column,
    filename: Column,
    event: Column | None = None,
) -> Column:
    """One JSON object per prediction; latency in milliseconds with three decimals.

    Absent values are written as explicit nulls.
    """
    fields = F.struct(
        (F.lit("prediction") if event is None else event).alias("event"),
        (iso_time() if ts is None else ts).alias("ts"),
        status.alias("status"),
        label.alias("label"),
        confidence.alias("confidence"),
        model_name.alias("model_name"),
        F.round(latency_s * 1000.0, 3).alias("latency_ms"),
        filename.alias("filename"),
    )
    return F.to_json(fields, {"ignoreNullFields": "false"})


def write_log(lines: DataFrame, path: str, column: str = "value") -> None:
    lines.select(F.col(column).alias("value")).write.mode("append").text(path)


def parse_log(
    lines: DataFrame, column: str = "value", *, strict: bool = True, null_confidence: float = 0.0
) -> DataFrame:
    """(label, confidence, other log fields) of the successful predictions in JSON lines.

    Blank lines and JSON that is not an object are skipped. A line that is not JSON is an
    error naming the line (or is skipped when not strict). ``event`` must be null or
    "prediction". ``status`` must be "ok"; a missing key counts as ok, an explicit null
    does not. Rows without a label are dropped, a null confidence becomes 0.
    """
    rest = [c for c in lines.columns if c != column]
    text = F.trim(F.col(column))
    bad = F.raise_error(F.concat(F.lit("not JSON: "), text)).cast("boolean")
    keys = F.json_object_keys(text)
    # Only text without object keys is looked at again, to tell other JSON from no JSON.
    other = F.when(F.try_parse_json(text).isNotNull(), False).otherwise(bad if strict else False)
    parsed = F.struct(
        F.from_json(text, S.PREDICTION).alias("r"),
        F.array_contains(keys, "status").alias("has_status"),
        F.when(keys.isNotNull(), True).otherwise(other).alias("is_object"),
    )

    def wanted(x: Column) -> Column:
        return (
            x["is_object"]
            & (x["r"]["event"].isNull() | (x["r"]["event"] == "prediction"))
            & (~x["has_status"] | F.coalesce(x["r"]["status"] == "ok", F.lit(False)))
            & x["r"]["label"].isNotNull()
        )

    # Filtering inside a one-element array parses each line once; a filter on the parsed
    # columns would be pushed down and parse the line again for every field it names.
    kept = lines.where(text != "").select(
        *rest, F.inline(F.filter(F.array(parsed), wanted)).alias("r", "has_status", "is_object")
    )
    others = [f.name for f in S.PREDICTION if f.name not in ("label", "confidence", "event")]
    return kept.select(
        *rest,
        F.col("r.label").alias("label"),
        F.coalesce(F.col("r.confidence"), F.lit(null_confidence)).alias("confidence"),
        *[F.col(f"r.{name}").alias(name) for name in others if name not in rest],
    )


def read_log(spark: SparkSession, path: str, **options) -> DataFrame:
    return parse_log(spark.read.text(path), **options)


def parse_confidences(lines: DataFrame, column: str = "value") -> DataFrame:
    """One number per line; blank lines skipped, anything else is an error."""
    text = F.trim(F.col(column))
    number = text.try_cast("double")
    bad = F.raise_error(F.concat(F.lit("not a number: "), text)).cast("double")
    rest = [c for c in lines.columns if c != column]
    return lines.where(text != "").select(*rest, F.coalesce(number, bad).alias("confidence"))


def label_log(counts: DataFrame, label: str = "class", n: str = "n") -> DataFrame:
    """A log with every class repeated ``n`` times and no confidence, as JSON lines.

    The repetition is split into runs first, so that one large class is written by many
    tasks.
    """
    run = F.lit(100_000)
    starts = F.sequence(F.lit(0).cast("long"), F.col(n) - 1, run.cast("long"))
    spread = (
        counts.where(F.col(n) > 0)
        .withColumn("__start", F.explode(starts))
        .repartition(label, "__start")
    )
    last = F.least(F.col("__start") + run, F.col(n)) - 1
    none = F.lit(None)
    line = F.to_json(
        F.struct(
            F.lit("prediction").alias("event"),
            F.lit("ok").alias("status"),
            F.col(label).alias("label"),
            none.cast("double").alias("confidence"),
        ),
        {"ignoreNullFields": "false"},
    )
    return spread.withColumn("copy", F.explode(F.sequence(F.col("__start"), last))).select(
        F.col(label), "copy", line.alias("value")
    )
