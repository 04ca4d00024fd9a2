"""Every registered query against its SQL on the generated tables."""

from __future__ import annotations

import math

import duckdb
import pytest

from lakeweir.oracle import ORACLE, TABLES
from lakeweir.standins import QUERIES

SF_DIR = "/root/testdata/sf0.001"


def plain(value):
    if isinstance(value, float) and math.isnan(value):
        return "nan"
    return value


def ordered(rows):
    return sorted(rows, key=lambda row: tuple((v is not None, str(v)) for v in row))


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(
            f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'"
        )
    return connection


def test_every_query_has_an_oracle():
    assert QUERIES.keys() == ORACLE.keys()


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, duck, name):
    frame = QUERIES[name](spark, SF_DIR)
    columns = sorted(frame.columns)
    got = [tuple(map(plain, row)) for row in frame.select(*columns).collect()]
    relation = duck.sql(ORACLE[name])
    assert sorted(relation.columns) == columns
    picked = ", ".join(f'"{c}"' for c in columns)
    want = duck.sql(f"SELECT {picked} FROM ({ORACLE[name]})").fetchall()
    assert got or name == "gated_mart_refused"
    assert ordered(got) == ordered([tuple(map(plain, row)) for row in want])
