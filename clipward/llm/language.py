"""Language identification by fusing evidence with Bayes' rule.

Four kinds of evidence about a text's language, each as log probabilities over the languages:

* Text: a multinomial model over hashed character trigrams of the lowered letters, fitted on a bounded
  sample of labelled rows (``SAMPLE_ROWS`` a language, in expectation). One more class, ``und``, is
  uniform over all trigrams. Trigrams of one text are not independent, so the mean log likelihood counts as that
  of at most ``EVIDENCE`` trigrams, whatever the length; the whole text is read.
* Declared markup language and address suffix: P(value | language) from counts over all documents,
  smoothed toward the value's overall share.
* Host prior: counts of the text model's choice by host over all documents, smoothed toward those of
  the host's domain, and these toward the corpus.

Counts are grouped sums, so a host with a third of all rows is one small row. Hosts are joined back
by broadcast while their measured number is at most ``BROADCAST_HOSTS``, else by an ordinary join.

Cases: a null or empty text, or one without letters, has no text evidence and is ``und``; null
declared language, address or host is no evidence; unknown declared values neither; ties go to the
language first in alphabetical order; equal rows get equal results; empty tables give empty tables, and
so does a table without any labelled row, with every document ``und``; other columns are kept (output columns
replace columns of the same name).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clipward.llm import hashing
from clipward.llm.frames import add_arrow_columns, small_batches, stored

SAMPLE_ROWS = 400
BITS = 16
EVIDENCE = 64
SMOOTH = 0.5
HOST_WEIGHT = 20.0
DECLARED_WEIGHT = 20.0
BROADCAST_HOSTS = 50_000
PART_CHARS = 1 << 20
UNKNOWN = "und"

_PLAIN = np.array([ord(chr(i)) if chr(i).isalpha() else 0x20 for i in range(128)], np.uint32)
_SPACES = np.uint64(0x20 << 42 | 0x20 << 21 | 0x20)


@dataclass(frozen=True)
class Model:
    """Languages (``und`` last) and log P(trigram | language), one row per trigram bucket."""

    languages: list[str]
    table: np.ndarray


def _grams(text: str) -> np.ndarray:
    """Buckets of the character trigrams of a text, with a space at both ends.

    Digits and ASCII signs count as spaces, so numbers and addresses say nothing; trigrams of
    spaces are left out.
    """
    points = np.frombuffer(f" {text} ".encode("utf-32-le"), np.uint32)
    points = np.where(points < 128, _PLAIN[np.minimum(points, 127)], points).astype(np.uint64)
    if len(points) < 3:
        return np.empty(0, np.int64)
    packed = points[:-2] << np.uint64(42) | points[1:-1] << np.uint64(21) | points[2:]
    packed = packed[packed != _SPACES]
    return (hashing.mix(packed) >> np.uint64(64 - BITS)).astype(np.int64)


def _parts(text: str) -> Iterator[str]:
    """The lowered text in pieces that bound memory; pieces overlap by two characters."""
    low = text.lower()
    for a in range(0, max(len(low), 1), PART_CHARS):
        yield low[max(a - 2, 0) : a + PART_CHARS]


def fit_text(docs: DataFrame, text: str, label: str, sample_rows: int = SAMPLE_ROWS) -> Model:
    """The trigram model from about ``sample_rows`` labelled rows of each language."""
    small_batches(docs.sparkSession)
    named = docs.where(F.col(label).isNotNull() & (F.length(text) > 0)).select(
        F.lower(F.trim(label)).alias("label"), F.col(text).alias("text")
    )
    counts = {r["label"]: r["count"] for r in named.groupBy("label").count().collect()}
    languages = sorted(counts)
    if not languages:
        return Model([UNKNOWN], np.zeros((1 << BITS, 1)))
    share = F.create_map(
        *(F.lit(x) for name in languages for x in (name, min(1.0, sample_rows / counts[name])))
    )
    draw = F.pmod(F.xxhash64("text"), F.lit(1 << 20)) / float(1 << 20)
    sample = named.where(draw < F.element_at(share, F.col("label")))
    place = {name: i for i, name in enumerate(languages)}

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(languages), 1 << BITS), np.int64)
        for batch in batches:
            for name, body in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for part in _parts(body):
                    total[place[name]] += np.bincount(_grams(part), minlength=1 << BITS)
        row, bucket = np.nonzero(total)
        yield pa.RecordBatch.from_arrays(
            [pa.array(row), pa.array(bucket), pa.array(total[row, bucket])],
            ["language", "bucket", "n"],
        )

    seen = (
        sample.mapInArrow(count, "language long, bucket long, n long")
        .groupBy("language", "bucket")
        .agg(F.sum("n").alias("n"))
        .collect()  # at most languages x 2**BITS rows
    )
    table = np.full((len(languages) + 1, 1 << BITS), SMOOTH)
    for r in seen:
        table[r["language"], r["bucket"]] += r["n"]
    table[-1] = 1.0
    table = np.log(table / table.sum(axis=1, keepdims=True))
    return Model([*languages, UNKNOWN], np.ascontiguousarray(table.T))


def score_text(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """``docs`` with ``text_scores``: tempered log likelihoods by language, null without letters."""
    shared = docs.sparkSession.sparkContext.broadcast(model.table.astype(np.float32))

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[list[pa.Array]]:
        table = shared.value
        for batch in batches:
            scores = []
            for value in batch.column(batch.schema.get_field_index(text)):
                body, total, n = value.as_py() or "", np.zeros(table.shape[1]), 0
                if any(map(str.isalpha, body)):
                    for part in _parts(body):
                        grams = _grams(part)
                        total += np.take(table, grams, axis=0).sum(axis=0, dtype=np.float64)
                        n += len(grams)
                scores.append((total * (min(n, EVIDENCE) / n)).round(6).tolist() if n else None)
            yield [pa.array(scores, pa.list_(pa.float64()))]

    return add_arrow_columns(docs, [T.StructField("text_scores", T.ArrayType(T.DoubleType()))], make)


def host_of(url: Column) -> Column:
    """Host of an address, lower case, without user, port and a leading www."""
    host = F.lower(F.regexp_extract(url, r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]+)", 1))
    return F.nullif(F.regexp_replace(host, r"^www\.", ""), F.lit(""))


def suffix_of(host: Column) -> Column:
    """The last label of a host name; null without a dot."""
    return F.nullif(F.regexp_extract(host, r"\.([^.]+)$", 1), F.lit(""))


def domain_of(host: Column) -> Column:
    """The last two labels of a host name; the host itself if it has no more."""
    return F.coalesce(F.nullif(F.regexp_extract(host, r"([^.]+\.[^.]+)$", 1), F.lit("")), host)


@dataclass(frozen=True)
class Evidence:
    """Log evidence by declared language (small), and by host with its suffix."""

    languages: list[str]
    prior: list[float]
    declared: dict[str, list[float]]
    hosts: DataFrame
    n_hosts: int


def _value_evidence(rows: list, n: int) -> dict[str, list[float]]:
    """log P(value | language) less log P(value), from (value, n0, n1, ...)."""
    if not rows:
        return {}
    counts = np.array([[r[f"n{i}"] for i in range(n)] for r in rows], float)
    share = counts.sum(axis=1, keepdims=True) / counts.sum()
    smooth = (counts + DECLARED_WEIGHT * share) / (counts.sum(axis=0) + DECLARED_WEIGHT)
    return dict(zip((r["value"] for r in rows), (np.log(smooth) - np.log(share)).tolist()))


def fit_evidence(
    scored: DataFrame, languages: list[str], declared: str | None, host: str | None
) -> Evidence:
    """Counts over all rows of ``scored``, which has ``text_scores`` and the two columns."""
    n = len(languages)
    names = [f"n{i}" for i in range(n)]
    none = F.lit(None).cast("string")
    best = F.array_position("text_scores", F.array_max("text_scores")) - 1
    rows = scored.where(F.col("text_scores").isNotNull()).select(
        best.cast("int").alias("best"),
        (_language(declared) if declared else none).alias("declared"),
        (F.col(host) if host else none).alias("host"),
    )
    ones = [F.count(F.when(F.col("best") == i, 1)).cast("double").alias(c) for i, c in enumerate(names)]
    sums = [F.sum(c).alias(c) for c in names]
    counted = stored(rows.groupBy("declared", "host").agg(*ones), "language-counts")
    overall = counted.agg(*(F.coalesce(F.sum(c), F.lit(0.0)).alias(c) for c in names)).first()
    prior = (np.array(overall) + 1) / (sum(overall) + n)
    by_declared = (
        counted.where(F.col("declared").isin(*languages))
        .groupBy(F.col("declared").alias("value"))
        .agg(*sums)
        .collect()  # one row per known language
    )
    by_host = counted.where(F.col("host").isNotNull()).groupBy("host").agg(*sums)
    by_host = by_host.withColumns({"domain": domain_of(F.col("host")), "suffix": suffix_of(F.col("host"))})

    def level(key: str, tag: str) -> DataFrame:
        sums = [F.sum(c).alias(f"{tag}{c}") for c in names]
        return by_host.where(F.col(key).isNotNull()).groupBy(key).agg(*sums)

    joined = by_host.join(level("domain", "d"), "domain").join(level("suffix", "s"), "suffix", "left")
    whole = sum(F.col(c) for c in names)
    domain = sum(F.col(f"d{c}") for c in names)
    share = sum(F.col(f"s{c}") for c in names) / F.lit(float(sum(overall)) or 1.0)
    smoothed, suffix = [], []
    for i, c in enumerate(names):
        parent = (F.col(f"d{c}") + HOST_WEIGHT * float(prior[i])) / (domain + HOST_WEIGHT)
        smoothed.append(F.log((F.col(c) + HOST_WEIGHT * parent) / (whole + HOST_WEIGHT)))
        rate = (F.col(f"s{c}") + DECLARED_WEIGHT * share) / (overall[i] + DECLARED_WEIGHT)
        suffix.append(F.coalesce(F.log(rate / share), F.lit(0.0)))
    hosts = joined.select(
        F.col("host").alias("host_key"), _add(F.array(*smoothed), F.array(*suffix)).alias("host_prior")
    )
    hosts = stored(hosts, "language-hosts")
    return Evidence(
        languages, np.log(prior).tolist(), _value_evidence(by_declared, n), hosts, hosts.count()
    )


def _language(value: str) -> Column:
    """The primary language of a tag such as en-GB."""
    return F.regexp_extract(F.lower(F.trim(value)), r"^([a-z]+)", 1)


def _add(a: Column, b: Column) -> Column:
    return F.zip_with(a, b, lambda x, y: x + y)


def _of_value(found: dict[str, list[float]], value: Column, none: Column) -> Column:
    if not found:
        return none
    known = F.create_map(*(F.lit(x) for k, v in sorted(found.items()) for x in (k, v)))
    return F.coalesce(F.element_at(known, value), none)


def decide(scored: DataFrame, evidence: Evidence, declared: str | None, host: str | None) -> DataFrame:
    """``scored`` with ``language`` and ``confidence`` (posterior); ``text_scores`` goes."""
    languages, n = evidence.languages, len(evidence.languages)
    none = F.array(*[F.lit(0.0)] * n)
    rows = scored.drop("language", "confidence")
    prior = F.lit(evidence.prior)
    if host:
        hosts = evidence.hosts
        if evidence.n_hosts <= BROADCAST_HOSTS:
            hosts = F.broadcast(hosts)
        rows = rows.join(hosts, rows[host] == hosts["host_key"], "left").drop("host_key")
        prior = F.coalesce("host_prior", prior)
    total = _add(F.col("text_scores"), prior)
    if declared:
        total = _add(total, _of_value(evidence.declared, _language(declared), none))
    rows = rows.withColumn("__total", total)
    top = F.array_max("__total")
    mass = F.aggregate("__total", F.lit(0.0), lambda a, x: a + F.exp(x - top))
    names = F.array(*map(F.lit, languages))
    place = F.array_position("__total", top).cast("int")
    done = rows.withColumns(
        {
            "language": F.coalesce(F.element_at(names, place), F.lit(UNKNOWN)),
            "confidence": F.when(F.col("__total").isNull(), 0.0).otherwise(1 / mass),
        }
    )
    return done.drop("__total", "text_scores", "host_prior")


def identify(
    docs: DataFrame,
    text: str = "text",
    label: str = "lang",
    declared: str | None = "lang",
    host: str | None = "source",
    sample_rows: int = SAMPLE_ROWS,
) -> DataFrame:
    """``docs`` with ``language`` and ``confidence``.

    ``label`` names the language of training rows, ``declared`` the markup language, ``host`` the host
    name (``host_of`` takes it from an address); the address suffix is the host's.
    """
    model = fit_text(docs, text, label, sample_rows)
    columns = list(dict.fromkeys(c for c in (text, declared, host) if c))
    scored = score_text(docs.select(*columns), model, text).drop(text)
    evidence = fit_evidence(scored, model.languages, declared, host)
    return decide(score_text(docs, model, text), evidence, declared, host)
