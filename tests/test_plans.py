"""Plan shapes that decide how the operators behave on large data."""

from __future__ import annotations

import re
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from lakeweir import standins
from lakeweir.operators import quality
from lakeweir.operators.counts import count_by, rollup_count
from lakeweir.operators.curate import dedupe_latest
from lakeweir.operators.increment import newer_than
from lakeweir.operators.upsert import match_keys, merge_by_key
from lakeweir.plans import flow
from lakeweir.plans.tables import Table
from lakeweir.schemas import record
from lakeweir.sources.scratch import written

SF_DIR = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def table(spark, name):
    return standins.table(spark, SF_DIR, name)


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_grouped_count_reads_its_columns_and_counts_before_the_shuffle(spark):
    text = plan(count_by(table(spark, "lineitem"), ["l_returnflag", "l_linestatus"]))
    assert "ReadSchema: struct<l_returnflag:string,l_linestatus:string>" in text
    assert text.index("partial_count") > text.index("Exchange hashpartitioning")
    assert text.count("Exchange") == 1


def test_rollup_expands_groups_not_rows(spark):
    text = plan(rollup_count(table(spark, "lineitem"), ["l_returnflag", "l_linestatus"]))
    assert text.index("partial_sum") < text.index("Expand") < text.index("partial_count")


def test_dedupe_cuts_groups_before_the_shuffle(spark):
    text = plan(dedupe_latest(table(spark, "events"), ["user_id"], [F.desc("ts")]))
    shuffle = text.index("Exchange hashpartitioning")
    assert re.search(r"WindowGroupLimit .*row_number\(\), 1, Partial", text[shuffle:])


def test_watermark_filter_reaches_the_scan(spark):
    text = plan(newer_than(table(spark, "events").select("event_id"), "event_id", 5))
    assert "GreaterThan(event_id,5)" in text and "ReadSchema: struct<event_id:bigint>" in text


def test_merge_shuffles_the_target_once(spark, no_broadcast):
    source = written(standins.changes(spark, SF_DIR), "changes")
    text = plan(merge_by_key(standins.accounts(spark, SF_DIR), source, ["id"]))
    assert text.count("Exchange hashpartitioning") == 3  # target, and source keys twice
    assert re.search(r"SortMergeJoin \[id#\d+, __spread#\d+\], \[id#\d+, __spread#\d+\]", text)
    assert "NestedLoop" not in text and "Cartesian" not in text


def test_merge_broadcasts_the_keys_of_a_small_source(spark):
    source = written(standins.changes(spark, SF_DIR), "changes")
    text = plan(merge_by_key(standins.accounts(spark, SF_DIR), source, ["id"]))
    assert "BroadcastHashJoin" in text
    assert text.count("Exchange hashpartitioning") == 1  # the grouping of the source keys


def test_rows_without_a_key_spread_over_the_tasks(spark, no_broadcast):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        left = spark.range(0, 6000, 1, 64).select(
            F.when(F.col("id") < 0, F.col("id")).alias("k"), F.lit("same").alias("v")
        )
        right = spark.createDataFrame([(1, 1)], "k long, v long")
        joined = match_keys(left, right, ["k"], F.count("v").alias("n"))
        placed = joined.select("k", "v", "n", F.spark_partition_id().alias("task"))
        assert "SortMergeJoin" in plan(placed)
        tasks = [row["task"] for row in placed.collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    sizes = [tasks.count(task) for task in set(tasks)]
    assert len(sizes) == 4 and max(sizes) < 3000
    assert sum(sizes) == 6000


def test_maps_can_be_merged(spark):
    schema = "id string, tags map<string, int>"
    target = spark.createDataFrame([("a", {"x": 1}), ("b", {"x": 2}), (None, {"x": 3})], schema)
    source = spark.createDataFrame([("b", {"y": 9})], schema)
    rows = merge_by_key(target, source, ["id"]).collect()
    assert sorted((r["id"] or "", r["tags"]) for r in rows) == [
        ("", {"x": 3}), ("a", {"x": 1}), ("b", {"y": 9}),
    ]


def test_dedupe_of_set_keys_scans_once(spark):
    text = plan(
        dedupe_latest(table(spark, "events"), ["user_id"], [F.desc("ts")], keys_set=True)
    )
    assert text.count("FileScan") == 1


def test_check_and_mart_read_the_table_once(spark, root):
    lake = replace(standins._site_lake(spark), root=f"{root}/lake")
    standins._land_two_runs(spark, SF_DIR, lake)
    scans = []
    kept = flow.staged

    def watched(df, name):
        if name == "checked":
            scans.append(plan(df).count("Join"))
        return kept(df, name)

    flow.staged = watched
    try:
        flow.run(spark, lake)
    finally:
        flow.staged = kept
    assert scans == [1]


def test_a_hot_target_key_is_split(spark, no_broadcast):
    small = {
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.shuffle.partitions": "16",
    }
    for name, value in small.items():
        spark.conf.set(name, value)
    try:
        target = spark.range(60000).repartition(8).select(
            F.when(F.col("id") % 3 > 0, F.col("id").cast("string")).otherwise("hot").alias("id"),
            F.sha2(F.col("id").cast("string"), 256).alias("v"),
        )
        source = spark.range(1000).select(F.col("id").cast("string"), F.lit("new").alias("v"))
        merged = merge_by_key(target, source, ["id"])
        rows = merged.collect()
        text = plan(merged)
    finally:
        for name in small:
            spark.conf.unset(name)
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert "SortMergeJoin(skew=true)" in text
    assert sum(r["id"] == "hot" for r in rows) == 20000
    assert len(rows) == 60000 - 666 + 1000


def test_scalar_constraints_share_one_scan(spark):
    relation = table(spark, "orders")
    check = (
        quality.Check("c")
        .is_complete(*relation.columns)
        .has_data_type("String", "o_orderstatus")
        .is_unique("o_orderkey")
    )
    text = plan(quality.verify(relation, [check]))
    assert text.count("FileScan") == 2
    assert "ReadSchema: struct<o_orderkey:bigint>" in text


def test_gated_mart_has_no_cross_join(spark):
    text = plan(standins.gated_mart(spark, SF_DIR))
    assert "NestedLoop" not in text and "Cartesian" not in text


def test_reading_over_small_increments_does_not_shuffle_the_base(spark, root):
    schema = record(id="string", place="string", v="long", wide="string")
    lines = Table(spark, root, schema, ("id",), ("place",))
    base = table(spark, "lineitem").select(
        F.monotonically_increasing_id().cast("string").alias("id"),
        F.col("l_returnflag").alias("place"),
        F.col("l_orderkey").alias("v"),
        F.lit("text").alias("wide"),
    )
    lines.upsert(written(base, "base"))
    lines.upsert(spark.createDataFrame([("3", "A", 1, "x")], schema))
    text = plan(lines.read_snapshot())
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text
    pruned = plan(count_by(lines.read_snapshot().where("place = 'A' AND v > 3"), ["place"]))
    assert "wide" not in pruned
    scan = next(line for line in pruned.splitlines() if "FileScan" in line)
    assert "GreaterThan(v,3)" in scan and re.search(r"PartitionFilters: \[.*place#\d+ = A", scan)
