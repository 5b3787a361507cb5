"""Every query against DuckDB at sf0.01: same columns, same types, same rows."""

from __future__ import annotations

import math
import re
import sys
from collections import Counter
from pathlib import Path

import duckdb
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

import __spark_entry__ as contract  # noqa: E402

DATA = Path("/root/testdata/sf0.01")
QUERIES = contract.queries()
ORACLES = contract.oracle_sql()
# What DuckDB calls a Spark type.
TYPES = {
    "string": "VARCHAR",
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
    "timestamp": "TIMESTAMP",
}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for file in DATA.glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    yield connection
    connection.close()


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 9) + 0.0
    return value


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)
    without = set(QUERIES) - set(ORACLES)
    assert not [n for n in without if not re.match(r"op\d+_|pipeline$", n)]


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_duckdb(spark, duck, name):
    result = QUERIES[name](spark, str(DATA))
    expected = duck.sql(ORACLES[name])
    kinds = {f.name: TYPES[f.dataType.simpleString().split("(")[0]] for f in result.schema}
    assert kinds == dict(zip(expected.columns, map(str, expected.types)))
    got = _rows(result.columns, [tuple(r) for r in result.collect()])
    want = _rows(expected.columns, expected.fetchall())
    assert want, f"{name} compares nothing"
    assert got == want


def test_entry(spark):
    assert contract.entry(spark).count() == 1
