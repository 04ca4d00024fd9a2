"""Corpus queries against their SQL."""

from __future__ import annotations

import duckdb
import pytest

from lakeweir.llm.queries import ORACLE, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLE))
@pytest.mark.parametrize("sf_dir", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_query_matches_sql(spark, name, sf_dir):
    duck = duckdb.connect()
    for table in ("documents", "conversations"):
        duck.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    frame = QUERIES[name](spark, sf_dir)
    relation = duck.sql(ORACLE[name])
    assert sorted(frame.columns) == sorted(relation.columns)
    columns = sorted(frame.columns)
    got = sorted(map(tuple, frame.select(*columns).collect()), key=repr)
    picked = ", ".join(columns)
    want = duck.sql(f"SELECT {picked} FROM ({ORACLE[name]})").fetchall()
    assert got == sorted(want, key=repr)
