"""Every query against its SQL on all rows of the small test tables."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as contract

BASE = "/root/testdata/sf0.01"
pytestmark = pytest.mark.skipif(not Path(BASE).exists(), reason="test tables not available")
TYPES = {"boolean": "BOOLEAN", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE"}
QUERIES, ORACLES = contract.queries(), contract.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for path in Path(BASE).glob("*.parquet"):
        con.sql(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    yield con
    con.close()


def _rows(rows, order):
    return sorted((tuple(row[i] for i in order) for row in rows), key=lambda r: tuple((v is not None, v) for v in r))


def _same(a, b) -> bool:
    if isinstance(a, float) and isinstance(b, float):
        return math.isclose(a, b, rel_tol=1e-12, abs_tol=1e-12)
    return a == b


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, duck, name):
    got = QUERIES[name](spark, BASE)
    want = duck.sql(ORACLES[name])
    assert sorted(got.columns) == sorted(want.columns)
    want_types = dict(zip(want.columns, map(str, want.types)))
    assert {c: TYPES[t] for c, t in got.dtypes} == want_types
    left = _rows(got.collect(), sorted(range(len(got.columns)), key=lambda i: got.columns[i]))
    right = _rows(want.fetchall(), sorted(range(len(want.columns)), key=lambda i: want.columns[i]))
    assert len(left) == len(right) > 0
    bad = [(a, b) for a, b in zip(left, right) if not all(map(_same, a, b))]
    assert not bad, bad[:3]


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_runs(spark, name):
    assert QUERIES[name](spark, "/root/testdata/sf0.001").count() > 0


def test_oracles_belong_to_queries():
    assert set(ORACLES) <= set(QUERIES)
