"""Drift of raw runs, and what is saved of damaged pages."""

from __future__ import annotations

import json
import os
import random

from pyspark.sql import functions as F

from lakeweir.plans import flow
from lakeweir.schemas import CORRUPT, raw_of, record
from lakeweir.sources.drift import drift, raw_texts
from lakeweir.sources.raw_json import (
    complete_records,
    read_raw_json,
    salvaged,
    split_corrupt,
)
from lakeweir.sources.scratch import written

DECLARED = record(id="string", name="string", lon="double")
RUNS = [f"2024_01_0{day}_00_00_00_000000" for day in range(1, 5)]


def land(root, run, records, pages=False):
    os.makedirs(f"{root}/{run}")
    texts = [r if isinstance(r, str) else json.dumps(r) for r in records]
    with open(f"{root}/{run}/1.json", "w") as file:
        file.write("[" + ",".join(texts) + "]" if pages else "\n".join(texts))


def found(frame):
    return sorted(map(tuple, frame.collect()), key=repr)


def test_drift(spark, root):
    land(root, RUNS[0], [{"id": "a", "name": "x", "lon": 1}, {"id": "b", "lon": 1.5, "name": None}])
    land(root, RUNS[1], [{"id": "a", "lon": "1", "tags": ["t"]}, {"id": "b", "lon": 2}, '{"id": '])
    land(root, RUNS[2], [{"id": "c", "name": "y", "lon": None, "deep": {"lon": 1}}])
    land(root, RUNS[3], [{"id": 5, "name": "y", "lon": 2.5}])
    land(root, "not_a_run", [{"other": 1}])
    assert found(drift(raw_texts(spark, root), DECLARED)) == sorted(
        [
            (RUNS[1], "lon", "changed", "number,string", "number", 2),
            (RUNS[1], "tags", "undeclared", "array", None, 1),
            (RUNS[1], "name", "absent", None, "string", 0),
            (RUNS[2], "deep", "undeclared", "object", None, 1),
            (RUNS[3], "id", "changed", "number", "string", 1),
            (RUNS[3], "lon", "changed", "number", "number,string", 1),
        ],
        key=repr,
    )


def test_drift_of_pages_and_of_nothing(spark, root):
    land(root, RUNS[0], [{"id": "a", "more": True}], pages=True)
    land(root, RUNS[1], ["{"], pages=True)
    got = found(drift(raw_texts(spark, root, "pages"), DECLARED))
    assert got == [
        (RUNS[0], "more", "undeclared", "boolean", None, 1),
        (RUNS[1], "id", "absent", None, "string", 0),
    ]
    none = raw_texts(spark, root).where("false")
    assert drift(none, DECLARED).collect() == []


def complete(spark, texts):
    frame = spark.createDataFrame([(t,) for t in texts], "body string")
    return [r[0] for r in frame.select(complete_records(F.col("body"))).collect()]


def test_complete_records(spark):
    rng = random.Random(4)
    pieces = ['x"y', "a\\b", "{", "}", "[", "]", ",", "é😀", "\n", "plain"]
    records = [
        json.dumps(
            {"id": i, "t": "".join(rng.choices(pieces, k=4)), "deep": {"a": [1, {"b": "}"}]}},
            ensure_ascii=False,
        )
        for i in range(12)
    ]
    page = "[" + ",\n ".join(records) + "]"
    ends = []
    for r in records:
        ends.append(page.index(r) + len(r))
    cuts = sorted({*rng.sample(range(len(page)), 60), *ends, *(e - 1 for e in ends), len(page), 0})
    got = complete(spark, [page[:cut] for cut in cuts])
    for cut, texts in zip(cuts, got, strict=True):
        assert texts == records[: sum(end <= cut for end in ends)]


def test_no_array_has_no_records(spark):
    texts = ["", "  ", '{"id": 1}', 'x [{"id": 1}]', " \n[{}, {}]", "[1, [2], {}]", None, "]{}["]
    assert complete(spark, texts) == [[], [], [], [], ["{}", "{}"], ["{}"], None, []]


def test_records_after_an_unreadable_one_are_left(spark):
    raw = raw_of(DECLARED, audit=None)
    body = '[{"id": "a", "lon": 5}, {"id": "b", x}, {"id": "c"}, {"id'
    rows = [(body, "r"), (None, "s"), ("junk", "t")]
    frame = spark.createDataFrame(rows, f"{CORRUPT} string, run string")
    got = salvaged(frame, raw)
    assert got.columns == ["run", "id", "name", "lon"]
    assert found(got) == [("r", "a", None, "5")]


def test_damaged_pages_of_a_run(spark, root):
    raw = raw_of(DECLARED, audit=None)
    land(root, RUNS[0], [{"id": "a"}], pages=True)
    with open(f"{root}/{RUNS[0]}/2.json", "w") as file:
        file.write(json.dumps([{"id": "b"}, {"id": "c"}, {"id": "d"}], indent=2)[:-12])
    scan = read_raw_json(spark, f"{root}/{RUNS[0]}", raw, "pages")
    good, damaged = split_corrupt(written(scan, "t"))
    saved = salvaged(damaged, raw)
    assert sorted(r["id"] for r in good.unionByName(saved).collect()) == ["a", "b", "c"]


def test_the_flow_saves_records_and_keeps_the_page(spark, root):
    lake = flow.Lake(
        f"{root}/lake", curated_schema=DECLARED, audit=None, partition_by=(), raw_layout="pages",
        salvage=True,
    )
    os.makedirs(f"{lake.raw_data}/{RUNS[0]}")
    for name, text in {
        "1": json.dumps([{"id": "a", "name": "x", "lon": 1}]),
        "2": '[{"id": "b", "name": "y", "lon": "2.5"}, {"id": "c", "na',
    }.items():
        with open(f"{lake.raw_data}/{RUNS[0]}/{name}.json", "w") as file:
            file.write(text)
    curated = flow.curate(spark, lake)
    assert found(curated) == [("a", "x", 1.0), ("b", "y", 2.5)]
    kept = spark.read.text(lake.path("quarantine", RUNS[0])).collect()
    assert len(kept) == 1
