"""Every registered query against its SQL on the smallest tables."""

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as contract
from check import KINDS, differs, rows_of

QUERIES, ORACLES = contract.queries(), contract.oracle_sql()


@pytest.fixture(scope="module")
def db(sf):
    connection = duckdb.connect()
    for f in Path(sf).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {f.stem} AS SELECT * FROM '{f}'")
    return connection


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf, db, name):
    df = QUERIES[name](spark, sf)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    assert df.columns
    if name not in ORACLES:
        assert got
        return
    result = db.execute(ORACLES[name])
    columns = [d[0] for d in result.description]
    kinds = {d[0]: str(d[1]) for d in result.description}
    expected = rows_of(columns, result.fetchall())
    assert sorted(df.columns) == sorted(columns)
    assert {f.name: KINDS.get(f.dataType.simpleString()) for f in df.schema} == kinds
    assert len(got) == len(expected)
    assert not [(g, e) for g, e in zip(got, expected) if any(differs(x, y) for x, y in zip(g, e))]


def test_entry(spark):
    assert contract.entry(spark).columns == ["section", "key", "count", "value"]
    assert set(ORACLES) <= set(QUERIES)
