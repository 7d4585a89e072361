"""Every query with SQL against DuckDB; the others must run and return rows."""

from __future__ import annotations

import re

import pytest
from crosscheck import compare, connect

import __spark_entry__ as entry

QUERIES, ORACLES = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("key", list(QUERIES))
def test_query(spark, con, sf_dir, key):
    ok, note = compare(spark, con, key, QUERIES[key], ORACLES.get(key), sf_dir)
    assert ok, note


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry_runs(spark):
    assert entry.entry(spark).count() == 1


def test_survey_ids_are_covered():
    sizes = {"s": 14, "v": 10, "c": 15, "p": 12, "j": 8, "a": 14, "e": 11, "m": 11, "f": 12, "w": 5, "t": 10}
    seen = {m.group() for k in QUERIES if (m := re.match(r"[a-z]\d+", k))}
    assert {f"{f}{i}" for f, n in sizes.items() for i in range(1, n + 1)} == seen
