"""Open-ended paging: the pushed mark, stripes, streams, and the single pass that lands."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql.datasource import EqualTo, GreaterThan
from test_ingest import RAW, Api, do, keys, reader
from test_plans import plan

from lakeweir.errors import MissingKey
from lakeweir.operators.increment import newer_than
from lakeweir.plans import ingest
from lakeweir.sources import paged_json, storage
from lakeweir.sources.paged_json import OpenEndedReader, PageStream, read_all_pages
from lakeweir.sources.raw_json import read_raw_json
from lakeweir.streaming.pages import land_new_pages


@pytest.fixture
def api(root):
    return Api(root)


def open_ended(monkeypatch, answers, **options):
    _, calls, _ = reader(monkeypatch, answers)
    return OpenEndedReader({"url": "u?p={page}", "key": "id", **options}), calls


def test_the_mark_ends_the_paging(monkeypatch):
    bodies = ['[{"id": "d"}, {"id": "c"}]', '[{"id": "c"}, {"id": "b"}]', '[{"id": "b"}]']
    made, calls = open_ended(monkeypatch, bodies, readers="1")
    other = EqualTo(("page",), 3)
    assert list(made.pushFilters([GreaterThan(("max_key",), "b"), other])) == [other]
    rows = list(made.read(made.partitions()[0]))
    assert [(row[0], row[3], row[4]) for row in rows] == [(1, "d", 0), (2, "c", 0)]
    assert len(calls) == 3


def test_stripes_share_the_pages(monkeypatch):
    made, _ = open_ended(monkeypatch, ['[{"id": 7}]'], readers="3", max_page="8")
    taken = [[row[0] for row in made.read(part)] for part in made.partitions()]
    assert taken == [[1, 4, 7], [2, 5, 8], [3, 6]]


def test_keys_are_text(monkeypatch):
    body = '[{"id": 7}, {"id": null}, {"other": 1}, {"id": true}, {"id": "x"}, 3]'
    made, _ = open_ended(monkeypatch, [body, "[]"], readers="1")
    assert next(made.read(made.partitions()[0]))[3:] == ("x", 3)


def test_the_mark_is_pushed_into_the_source(spark, api):
    api.serve(keys(40), incremental=5)
    url = f"file://{api.root}/id:desc/{{page}}.json"
    options = {"key": "id", "missing": "empty", "backoff": 0, "readers": 2}
    pages = newer_than(read_all_pages(spark, url, **options), "max_key", "k00031")
    # the source has taken the comparison over: Spark no longer makes it
    assert "BatchScan paged_json" in plan(pages) and "k00031" not in plan(pages)
    assert "k00031" in pages._jdf.queryExecution().analyzed().toString()
    assert sorted(r["page"] for r in pages.collect()) == [1, 2]


def test_landing_reads_the_pages_once(spark, root):
    bodies = [(1, 2, '[{"id": "a"}, {"id": "b"}]'), (2, 0, "[]")]
    frame = spark.createDataFrame(bodies, "page long, n_items long, body string")
    area = f"{root}/parsed"
    ingest.parsed_pages(frame, "id").write.parquet(area)
    parsed = spark.read.parquet(area)
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("landing", "landing")
    try:
        ingest._land(parsed, ingest.plan_load(None), f"{root}/data", f"{root}/state", "r")
        jobs = tracker.getJobIdsForGroup("landing")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    # one job lands the records, one saves the mark
    assert len(jobs) == 2
    assert read_raw_json(spark, f"{root}/data/r", RAW).count() == 2


def test_a_failed_landing_moves_no_mark(spark, root, api, monkeypatch):
    api.serve(keys(30))
    do(spark, root, api.source(), "r1")
    api.serve(keys(60))

    def refuse(*_):
        raise OSError("disk")

    monkeypatch.setattr(storage, "rename", refuse)
    with pytest.raises(OSError, match="disk"):
        do(spark, root, api.source(), "r2")
    assert ingest.load_watermark(spark, f"{root}/state") == "k00029"
    assert not storage.exists(spark, f"{root}/data/r2")
    assert storage.child_folders(spark, f"{root}/data_landing") == []
    monkeypatch.undo()
    assert do(spark, root, api.source(), "r2").rows == 30


# -- stream ----------------------------------------------------------------------------


def landed_in_all(spark, root):
    found = []
    for run in storage.child_folders(spark, f"{root}/data"):
        found += [r["id"] for r in read_raw_json(spark, f"{root}/data/{run}", RAW).collect()]
    return sorted(found)


def stream(spark, root, api):
    query = land_new_pages(spark, api.source(), f"{root}/data", f"{root}/checkpoint")
    query.awaitTermination()


def test_offsets_find_the_end(monkeypatch):
    for size in (0, 1, 2, 7, 8, 30):
        pages = {n: [{"id": str(n)}] * (2 if n < size else 1) for n in range(1, size + 1)}
        made = PageStream({"url": "{page}"})
        monkeypatch.setattr(made, "load", lambda page, pages=pages: ("", pages.get(page, [])))
        assert made.latestOffset() == {"page": max(size, 1), "items": min(size, 1)}


def test_a_stream_lands_each_record_once(spark, root, api):
    """The last page grows between the starts, and so does the number of pages."""
    for n in (7, 7, 9, 31):
        api.serve(keys(n), full=3)
        stream(spark, root, api)
        assert landed_in_all(spark, root) == keys(n)


def test_a_replayed_batch_replaces_its_run(spark, root, api, monkeypatch):
    api.serve(keys(8), full=3)
    land = ingest.land_texts

    def fail_after(texts, data_root, run):
        land(texts, data_root, run)
        raise OSError("lost")

    monkeypatch.setattr("lakeweir.streaming.pages.land_texts", fail_after)
    with pytest.raises(Exception, match="lost"):
        stream(spark, root, api)
    assert landed_in_all(spark, root) == keys(8)
    monkeypatch.undo()
    api.serve(keys(11), full=3)
    stream(spark, root, api)
    stream(spark, root, api)
    assert landed_in_all(spark, root) == keys(11)


def test_a_stream_refuses_records_without_a_key(spark, root, api):
    api.serve(keys(2))
    path = f"{api.root}/id:asc/1.json"
    with open(path, "w") as file:
        json.dump([{"id": "a"}, {"n": 1}], file)
    with pytest.raises(Exception, match=MissingKey.__name__):
        stream(spark, root, api)
    assert storage.child_folders(spark, f"{root}/data") == []


def test_pages_know_their_keys(spark, api):
    api.serve(keys(5), full=2)
    url = f"file://{api.root}/id:asc/{{page}}.json"
    pages = paged_json.read_pages(spark, url, 1, 3, key="id")
    got = pages.orderBy("page").select("max_key", F.col("n_keyless")).collect()
    assert [tuple(r) for r in got] == [("k00001", 0), ("k00003", 0), ("k00004", 0)]
