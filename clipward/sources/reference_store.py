"""Drift references on storage, and the chain of places a reference is built from."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clipward import constants as K
from clipward import schemas as S
from clipward.operators import drift
from clipward.operators.quality import available_columns
from clipward.operators.splits import first_filled_column, fold_originals
from clipward.sources.tables import read_if_present

Source = tuple[str, Callable[[], DataFrame | None]]


def dump_reference(row: DataFrame, path: str) -> None:
    row.write.mode("overwrite").json(path)


def complete_reference(row: DataFrame) -> DataFrame:
    """Fill what a stored reference may leave out: names, prior from counts, empty lists."""
    names = F.lit(list(K.CLASS_NAMES))
    filled = row.withColumn(
        "class_names", F.when(F.size("class_names") > 0, F.col("class_names")).otherwise(names)
    )
    shares = _shares(F.col("class_counts"), F.col("class_names"))
    empty = {
        "class_counts": "map<string,bigint>",
        "confidence_quantiles": "array<double>",
        "feature_histograms": S.DRIFT_REFERENCE["feature_histograms"].dataType.simpleString(),
        "meta": "map<string,string>",
    }
    blank = {
        name: F.coalesce(
            F.col(name), (F.array() if kind.startswith("array") else F.create_map()).cast(kind)
        )
        for name, kind in empty.items()
    }
    prior = F.when(F.size("class_prior") > 0, F.col("class_prior")).otherwise(shares)
    return filled.withColumns({**blank, "class_prior": prior})


def _shares(counts: Column, names: Column) -> Column:
    listed = F.transform(
        names, lambda k: F.coalesce(F.try_element_at(counts, k), F.lit(0)).cast("double")
    )
    total = F.aggregate(listed, F.lit(0.0), lambda acc, v: acc + v)
    empty = F.raise_error(F.lit("no row belongs to a class of the reference"))
    values = F.transform(listed, lambda v: F.when(total > 0, v / total).otherwise(empty.cast("double")))
    return F.map_from_arrays(names, values)


def read_reference(spark: SparkSession, path: str) -> DataFrame:
    return complete_reference(spark.read.schema(S.DRIFT_REFERENCE).json(path))


def load_reference(row: DataFrame) -> drift.Reference:
    """The one-row reference table as a driver object."""
    r = row.first()
    if r is None:
        raise ValueError("the reference table is empty")
    return drift.Reference(
        class_counts=dict(r["class_counts"]),
        class_prior=dict(r["class_prior"]),
        class_names=tuple(r["class_names"]),
        confidence_quantiles=tuple(r["confidence_quantiles"]),
        feature_histograms={
            name: drift.Histogram(tuple(h["edges"]), tuple(h["density"]))
            for name, h in r["feature_histograms"].items()
        },
        meta=dict(r["meta"]),
    )


def first_source(
    sources: Sequence[Source], fold: int = K.EVAL_FOLD
) -> tuple[DataFrame | None, str | None]:
    """The first source with original rows in the fold; each probe reads one row at most."""
    for name, load in sources:
        frame = load()
        if frame is None:
            continue
        rows = fold_originals(frame, fold)
        if not rows.isEmpty():
            return rows, name
    return None, None


def existing_table(spark: SparkSession, path: str) -> Callable[[], DataFrame | None]:
    """A source that is skipped when nothing is stored under the path."""

    return lambda: read_if_present(spark, path)


def winner_meta(leaderboard: DataFrame) -> dict[str, str]:
    """Model, run and data set of a leaderboard's winner, as far as it has these columns."""
    names = [c for c in ("model_name", "run_id", "dataset") if c in leaderboard.columns]
    row = leaderboard.where("winner").select(*names).first()
    return {f"winner_{c}": str(row[c]) for c in names} if row else {}


def build_reference(
    sources: Sequence[Source],
    *,
    class_names: Sequence[str] = K.CLASS_NAMES,
    features: Sequence[str] | None = None,
    confidences: DataFrame | None = None,
    bins: int = K.HISTOGRAM_BINS,
    fold: int = K.EVAL_FOLD,
    meta: dict[str, str] | None = None,
) -> drift.Reference:
    """Labels, then confidences, then feature histograms, from the first usable source.

    Without any source the published class counts are used, which carry neither
    confidences nor features; asking for features is then an error. ``confidences``, when
    given, replaces the stored confidence columns. ``meta`` may name the winning model, its
    run and the data set (``winner_meta``); the time of building is added.
    """
    now = datetime.now(timezone.utc).isoformat(timespec="seconds")
    meta = {"built_at": now, **(meta or {})}
    frame, source = first_source(sources, fold)
    if frame is None:
        reference = drift.published_reference(meta=meta)
    else:
        reference = drift.reference_from_labels(
            frame, class_names, source=str(source), meta={"eval_fold": str(fold), **meta}
        )
    column = "confidence"
    if confidences is None and frame is not None:
        column = first_filled_column(frame, ["confidence", "max_proba"])
        confidences = frame if column else None
    if confidences is not None:
        kept = confidences.where(F.col(column).isNotNull())
        quantiles = drift.confidence_quantiles(kept, column)
        if quantiles:
            reference = drift.extended(reference, quantiles=quantiles, n_confidences=kept.count())
    if features is not None:
        if frame is None:
            raise FileNotFoundError("feature histograms need a stored feature table")
        usable = available_columns(frame, features)
        if not usable:
            raise ValueError("the feature table has none of the requested columns")
        table = drift.feature_histograms(frame, usable, bins)
        reference = drift.extended(reference, histograms=drift.collect_histograms(table))
    return reference
