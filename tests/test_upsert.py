from __future__ import annotations

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from lakeweir.operators.upsert import DUPLICATE_MARK, ambiguous_keys, duplicate_keys, merge_by_key

SCHEMA = "id string, v int"


def merged(spark, target, source, keys=("id",), schema=SCHEMA):
    left, right = (spark.createDataFrame(rows, schema) for rows in (target, source))
    return sorted(map(tuple, merge_by_key(left, right, list(keys)).collect()), key=repr)


@pytest.mark.parametrize(
    ("target", "source", "want"),
    [
        ([("a", 1)], [("a", 2)], [("a", 2)]),
        ([("a", 1)], [("a", None)], [("a", None)]),
        ([("a", 1)], [("b", 2)], [("a", 1), ("b", 2)]),
        ([("a", 1)], [], [("a", 1)]),
        ([], [("a", 1)], [("a", 1)]),
        ([(None, 1)], [(None, 2)], [(None, 1), (None, 2)]),
        ([("a", 1)], [("b", 1), ("b", 2)], [("a", 1), ("b", 1), ("b", 2)]),
        ([("", 1)], [("", 2)], [("", 2)]),
    ],
)
def test_cases(spark, target, source, want):
    assert merged(spark, target, source) == sorted(want, key=repr)


def test_two_source_rows_for_one_target_row_fail(spark):
    with pytest.raises(Exception, match=DUPLICATE_MARK):
        merged(spark, [("a", 1)], [("a", 2), ("a", 3)])


def test_duplicate_reports(spark):
    rows = [("a", 1), ("a", 2), ("b", 1), ("b", 1), (None, 1), (None, 2)]
    source = spark.createDataFrame(rows, SCHEMA)
    target = spark.createDataFrame([("b", 0), (None, 0)], SCHEMA)
    assert {r["id"] for r in duplicate_keys(source, ["id"]).collect()} == {"a", "b"}
    assert [r["id"] for r in ambiguous_keys(target, source, ["id"]).collect()] == ["b"]


def test_composite_key_with_a_null_part_never_matches(spark):
    schema = "a string, b string, v int"
    got = merged(
        spark,
        [("x", None, 1), ("x", "y", 1)],
        [("x", None, 2), ("x", "y", 2)],
        ("a", "b"),
        schema,
    )
    assert got == sorted([("x", None, 1), ("x", None, 2), ("x", "y", 2)], key=repr)


def test_extra_source_columns_are_ignored(spark):
    target = spark.createDataFrame([("a", 1)], SCHEMA)
    source = spark.createDataFrame([("a", 2, "extra")], "id string, v int, more string")
    out = merge_by_key(target, source, ["id"])
    assert out.columns == ["id", "v"]
    assert [tuple(r) for r in out.collect()] == [("a", 2)]


rows = st.dictionaries(st.sampled_from("abcdefgh"), st.integers(0, 9), max_size=8)


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(target=rows, source=rows)
def test_merge_is_a_dictionary_update_and_idempotent(spark, target, source):
    once = merged(spark, list(target.items()), list(source.items()))
    assert dict(once) == {**target, **source}
    assert len(once) == len(target.keys() | source.keys())
    assert merged(spark, once, list(source.items())) == once


def test_sort_merge_path_agrees(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = merged(spark, [("a", 1), (None, 5), (None, 6)], [("a", 2), ("c", 3), (None, 7)])
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    want = [("a", 2), ("c", 3), (None, 5), (None, 6), (None, 7)]
    assert got == sorted(want, key=repr)
