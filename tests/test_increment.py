from __future__ import annotations

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from lakeweir.operators.counts import count_by, rollup_count
from lakeweir.operators.increment import (
    assign_pages,
    before_stop,
    new_watermark,
    newer_than,
    pages_until_known,
    stop_page,
)

relaxed = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))


@relaxed
@given(
    ids=st.sets(st.text("abcxyz019", max_size=4), max_size=60),
    per_page=st.integers(1, 9),
    descending=st.booleans(),
    partitions=st.integers(1, 6),
)
def test_pages_equal_the_global_order(spark, ids, per_page, descending, partitions):
    df = spark.createDataFrame([(i,) for i in ids], "id string").repartition(3)
    order = F.desc("id") if descending else F.asc("id")
    paged = assign_pages(df, [order], per_page, partitions=partitions)
    want = {i: n // per_page + 1 for n, i in enumerate(sorted(ids, reverse=descending))}
    assert {r["id"]: r["page"] for r in paged.collect()} == want


def test_a_value_with_most_rows_is_spread_over_partitions(spark):
    df = spark.range(9000).select(F.when(F.col("id") % 3 > 0, 7).otherwise(F.col("id")).alias("k"))
    paged = assign_pages(df, ["k"], 100, partitions=6, unique=False)
    sizes = paged.groupBy("page").count().collect()
    assert len(sizes) == 90 and {r["count"] for r in sizes} == {100}
    by_partition = paged.where("k = 7").groupBy(F.spark_partition_id()).count().count()
    assert by_partition > 1
    ordered = paged.groupBy("page").agg(F.min("k").alias("lo"), F.max("k").alias("hi"))
    rows = ordered.orderBy("page").collect()
    assert all(a["hi"] <= b["lo"] for a, b in zip(rows, rows[1:]))


def test_stop_rule(spark):
    pages = spark.createDataFrame([(1, 2), (2, 1), (3, 0), (4, 5)], "page long, n long")
    assert [r["page"] for r in before_stop(pages, stop_page(pages, F.col("n"))).collect()] == [1, 2]
    full = pages.where("n > 0")
    assert before_stop(full, stop_page(full, F.col("n"))).count() == 3
    assert before_stop(full, stop_page(full, F.col("n")), max_pages=2).count() == 2


def test_incremental_stops_at_the_first_page_without_news(spark):
    rows = [("d", 1), ("c", 1), ("b", 2), ("a", 2), ("z", 3)]
    pages = spark.createDataFrame(rows, "id string, page long")
    assert {r["id"] for r in pages_until_known(pages, "id", "b").collect()} == {"c", "d"}
    assert {r["id"] for r in pages_until_known(pages, "id", "a").collect()} == {"b", "c", "d", "z"}
    assert pages_until_known(pages, "id", "zz").count() == 0


def test_keys_compare_as_text(spark):
    df = spark.createDataFrame([("9",), ("10",), (None,)], "id string")
    assert [r["id"] for r in newer_than(df, "id", "2").collect()] == ["9"]


@pytest.mark.parametrize(
    ("ids", "previous", "want"),
    [(["a", "c", "b"], "a", "c"), ([], "a", "a"), ([], None, None), (["b"], None, "b")],
)
def test_new_watermark(spark, ids, previous, want):
    df = spark.createDataFrame([(i,) for i in ids], "id string")
    assert new_watermark(df, "id", previous).first()["max_id"] == want


groups = st.lists(
    st.tuples(st.sampled_from([None, "a", "b"]), st.sampled_from([None, "x", "y"])), max_size=30
)


@relaxed
@given(rows=groups)
def test_counts_add_up(spark, rows):
    df = spark.createDataFrame(rows, "a string, b string")
    assert (count_by(df, ["a", "b"]).agg(F.sum("n")).first()[0] or 0) == len(rows)
    rolled = rollup_count(df, ["a", "b"]).collect()
    totals = [r["n"] for r in rolled if r["level"] == 3]
    assert totals == ([len(rows)] if rows else [])
    for row in rolled:
        if row["level"] == 1:
            assert row["n"] == sum(1 for a, _ in rows if a == row["a"])
        if row["level"] == 0:
            assert row["n"] == rows.count((row["a"], row["b"]))
