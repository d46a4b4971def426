"""Every query against its SQL counterpart in another engine, value by value."""

import math
from pathlib import Path

import duckdb
import pytest

from churnlens.registry.oracles import ORACLES
from churnlens.registry.queries import QUERIES


@pytest.fixture(scope="module")
def duck(sf_dir):
    connection = duckdb.connect()
    connection.execute("SET TimeZone = 'UTC'")
    for file in Path(sf_dir).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    yield connection
    connection.close()


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def cell(value):
        if isinstance(value, float):
            return None if math.isnan(value) else value + 0.0
        return value

    names = [columns[i] for i in order]
    return names, sorted((tuple(cell(row[i]) for i in order) for row in rows), key=repr)


# Types of the two engines that hold the same values.
TYPES = {
    "string": "VARCHAR",
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "date": "DATE",
    "timestamp": "TIMESTAMP",
}


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, sf_dir, duck, name):
    frame = QUERIES[name](spark, sf_dir)
    expected = duck.sql(ORACLES[name])
    types = dict(frame.dtypes)
    assert {c: TYPES[t] for c, t in types.items()} == {
        c: str(t) for c, t in zip(expected.columns, expected.types)
    }
    rows = expected.fetchall()
    assert rows
    got = canonical(frame.columns, [tuple(r) for r in frame.collect()])
    assert got == canonical(list(expected.columns), rows)


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)
