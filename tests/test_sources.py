from __future__ import annotations

import json
import os

import pytest
from pyspark.sql import functions as F

from lakeweir.errors import SourceUnreadable
from lakeweir.functions.runs import ISO_RUN_FORMAT, basename, new_run_name, run_name, run_time
from lakeweir.operators.curate import conform
from lakeweir.schemas import raw_of, record
from lakeweir.sources.raw_json import read_raw_json, split_corrupt
from lakeweir.sources.runs import latest_run
from lakeweir.sources.scratch import written

SCHEMA = record(id="string", name="string", lon="double")
RAW = raw_of(SCHEMA, audit=None)


def put(folder, name, text):
    os.makedirs(folder, exist_ok=True)
    with open(f"{folder}/{name}", "w", encoding="utf-8") as file:
        file.write(text)


def page(*records):
    return json.dumps(list(records), indent=2)


def test_page_arrays(spark, root):
    put(root, "1.json", page({"id": "a", "name": "x", "lon": "7.25"}, {"id": "b", "lon": 7.5}))
    put(root, "2.json", page())
    put(root, "3.json", page({"id": "c", "more": {"deep": 1}, "name": 5, "lon": "n/a"}))
    put(root, "4.json", page({"id": "d", "name": True, "lon": None}))
    scan = written(read_raw_json(spark, root, RAW, layout="pages"), "t")
    good, damaged = split_corrupt(scan)
    assert damaged.count() == 0
    assert sorted(map(tuple, conform(good, SCHEMA).collect())) == [
        ("a", "x", 7.25),
        ("b", None, 7.5),
        ("c", "5", None),
        ("d", "true", None),
    ]


def test_a_truncated_page_is_one_damaged_row(spark, root):
    put(root, "1.json", page({"id": "a"}))
    put(root, "2.json", page({"id": "b"}, {"id": "c"})[:-20])
    good, damaged = split_corrupt(written(read_raw_json(spark, root, RAW, "pages"), "t"))
    assert [r["id"] for r in good.collect()] == ["a"]
    assert damaged.count() == 1


def test_lines(spark, root):
    put(root, "1.json", '{"id": "a"}\n{"id": "b", "na\n{"id": "c"}\n')
    good, damaged = split_corrupt(written(read_raw_json(spark, root, RAW), "t"))
    assert sorted(r["id"] for r in good.collect()) == ["a", "c"]
    assert [r[0] for r in damaged.collect()] == ['{"id": "b", "na']


def test_only_empty_pages(spark, root):
    put(root, "1.json", "[]")
    assert read_raw_json(spark, root, RAW, "pages").count() == 0


def test_unreadable_source(spark, root):
    with pytest.raises(SourceUnreadable):
        read_raw_json(spark, f"{root}/nothing", RAW)
    with pytest.raises(ValueError, match="layout"):
        read_raw_json(spark, root, RAW, layout="xml")


def test_latest_run(spark, root):
    data = f"{root}/data"
    assert latest_run(spark, data) is None
    put(f"{data}/zzz", "1.json", "[]")
    assert latest_run(spark, data) is None
    early, late = "2024_01_02_03_04_05_000001", "2024_01_02_03_04_05_000002"
    for name in (late, early, "2025-01-01T00-00-00", "_metadata"):
        put(f"{data}/{name}", "1.json", "[]")
    assert latest_run(spark, data) == f"{data}/{late}"
    assert latest_run(spark, data, as_of=early) == f"{data}/{early}"
    assert latest_run(spark, data, as_of="2020_01_01_00_00_00_000000") is None
    assert latest_run(spark, data, fmt=ISO_RUN_FORMAT) == f"{data}/2025-01-01T00-00-00"


def test_run_names(spark):
    df = spark.createDataFrame([("x/2026_02_15_23_29_27_000001//",)], "p string")
    name = basename(F.col("p"))
    row = df.select(name.alias("n"), run_name(run_time(name)).alias("again")).first()
    assert row["n"] == row["again"] == "2026_02_15_23_29_27_000001"
    made = spark.createDataFrame([(new_run_name(),)], "p string")
    assert made.select(run_time(F.col("p"))).first()[0] is not None
