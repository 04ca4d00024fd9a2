from __future__ import annotations

import os

import pytest

from lakeweir.sources import scratch, storage


class Conf:
    def get(self, name, default=None):
        return default


class Context:
    applicationId = "app-1"

    def __init__(self, master):
        self.master = master


class Session:
    conf = Conf()

    def __init__(self, master):
        self.sparkContext = Context(master)


def test_the_named_folder_is_used(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    assert scratch.new_area(spark, "x").startswith(f"{root}/lakeweir/")
    assert scratch.new_area(spark, "x") != scratch.new_area(spark, "x")


def test_a_local_session_gets_a_temporary_folder_and_a_cluster_does_not():
    local = scratch.checkpoint_root(Session("local[2]"))
    assert os.path.isdir(local) and local == scratch.checkpoint_root(Session("local[2]"))
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        scratch.checkpoint_root(Session("yarn"))


def test_written_keeps_schema_and_rows(spark):
    df = spark.createDataFrame([("01", None), ("", 2)], "a string, b int")
    back = scratch.written(df, "t")
    assert back.schema == df.schema
    assert sorted(map(tuple, back.collect())) == [("", 2), ("01", None)]
    assert scratch.planned_bytes(back) < 10_000


def test_staged_removes_its_copy(spark):
    with scratch.staged(spark.range(3), "t") as copy:
        path = copy.inputFiles()[0].rsplit("/", 1)[0]
        assert storage.exists(spark, path)
        assert copy.count() == 3
    assert not storage.exists(spark, path)


def test_scope_frees_what_was_written_inside(spark):
    outside = scratch.written(spark.range(3), "outside")
    with scratch.scope(spark):
        inside = scratch.new_area(spark, "inside")
        spark.range(5).write.parquet(inside)
        kept = scratch.written(spark.range(4), "kept")
        assert kept.count() == 4
        assert storage.exists(spark, inside)
    assert not storage.exists(spark, inside)
    assert outside.count() == 3
