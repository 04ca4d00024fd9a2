from __future__ import annotations

import json
import os
import tempfile
from urllib.error import HTTPError, URLError

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from lakeweir.errors import MissingKey, PageBoundReached, PageFetchError
from lakeweir.plans.ingest import (
    PagedSource,
    ingest,
    ingest_pages,
    load_watermark,
    plan_load,
    save_watermark,
)
from lakeweir.schemas import raw_of, record
from lakeweir.sources import paged_json
from lakeweir.sources.paged_json import PagedJsonReader, read_pages, records
from lakeweir.sources.raw_json import read_raw_json

SCHEMA = record(id="string", n="double")
RAW = raw_of(SCHEMA, audit=None)


class Api:
    """Page files as a server would answer them, for both sort orders."""

    def __init__(self, root):
        self.root = f"{root}/api"
        self.more = {"other": [1]}

    def serve(self, ids, full=200, incremental=50):
        for sort, size in (("id:asc", full), ("id:desc", incremental)):
            folder = f"{self.root}/{sort}"
            os.makedirs(folder, exist_ok=True)
            for old in os.listdir(folder):
                os.remove(f"{folder}/{old}")
            ordered = sorted(ids, reverse=sort.endswith("desc"))
            chunks = [ordered[i : i + size] for i in range(0, len(ordered), size)]
            for number, chunk in enumerate(chunks, 1):
                with open(f"{folder}/{number}.json", "w") as file:
                    json.dump([{"id": i, "n": 1, **self.more} for i in chunk], file, indent=2)

    def source(self, **more):
        options = {"missing": "empty", "backoff": 0, "pages_per_task": 2} | more.pop("options", {})
        url = f"file://{self.root}/{{sort}}/{{page}}.json"
        return PagedSource(url, options=options, **more)


@pytest.fixture
def api(root):
    return Api(root)


def keys(n, start=0):
    return [f"k{i:05d}" for i in range(start, start + n)]


def landed(spark, root, run):
    return sorted(r["id"] for r in read_raw_json(spark, f"{root}/data/{run}", RAW).collect())


def do(spark, root, source, run):
    return ingest(spark, source, f"{root}/data", f"{root}/state", run)


def test_full_then_incremental(spark, root, api):
    api.serve(keys(650))
    first = do(spark, root, api.source(), "r1")
    assert (first.mode, first.rows, first.watermark) == ("full", 650, "k00649")
    assert landed(spark, root, "r1") == keys(650)

    api.serve(keys(650 + 170))
    second = do(spark, root, api.source(), "r2")
    assert (second.mode, second.rows, second.watermark) == ("incremental", 170, "k00819")
    assert landed(spark, root, "r2") == keys(170, 650)
    assert load_watermark(spark, f"{root}/state") == "k00819"

    third = do(spark, root, api.source(), "r3")
    assert (third.mode, third.rows, third.watermark) == ("incremental", 0, "k00819")
    assert not os.path.exists(f"{root}/data/r3")


def test_landed_records_keep_every_field(spark, root, api):
    api.more = {
        "text": 'a "quoted"\nSão Paulo\t\u2028 line',
        "deep": {"list": [1, {"x": None}], "flag": True},
        "number": 12345678901234567890,
        "fraction": 0.1000,
        "none": None,
    }
    api.serve(keys(3))
    do(spark, root, api.source(), "r")
    rows = [json.loads(r[0]) for r in spark.read.text(f"{root}/data/r").collect()]
    assert sorted(rows, key=lambda r: r["id"]) == [{"id": i, "n": 1, **api.more} for i in keys(3)]


def test_mark_above_every_key_lands_nothing(spark, root, api):
    api.serve(keys(10))
    save_watermark(spark, f"{root}/state", "z")
    assert do(spark, root, api.source(), "r").rows == 0
    assert load_watermark(spark, f"{root}/state") == "z"


def test_empty_source_stays_in_full_mode(spark, root, api):
    api.serve([])
    assert do(spark, root, api.source(), "r1").watermark is None
    assert not os.path.exists(f"{root}/data/r1")
    api.serve(keys(3))
    again = do(spark, root, api.source(), "r2")
    assert (again.mode, again.rows) == ("full", 3)


@pytest.mark.parametrize("mark", [None, "k00009"])
def test_a_bound_that_cuts_lands_nothing(spark, root, api, mark):
    api.serve(keys(30), full=5, incremental=5)
    if mark:
        save_watermark(spark, f"{root}/state", mark)
    with pytest.raises(PageBoundReached):
        do(spark, root, api.source(max_pages=2), "r1")
    assert not os.path.exists(f"{root}/data/r1")
    assert load_watermark(spark, f"{root}/state") == mark
    wanted = keys(20, 10) if mark else keys(30)
    assert do(spark, root, api.source(max_pages=7), "r2").rows == len(wanted)
    assert landed(spark, root, "r2") == wanted


def test_loads_have_no_bound_of_their_own(spark, root, api):
    api.serve(keys(1203), full=1)
    assert do(spark, root, api.source(options={"pages_per_task": 300}), "r").rows == 1203


@pytest.mark.parametrize("mark", [None, "k00001"])
def test_records_without_a_key_stop_the_load(spark, root, mark):
    if mark:
        save_watermark(spark, f"{root}/state", mark)
    body = '[{"id": "k00002"}, {"n": 1}, {"id": null}]'
    pages = spark.createDataFrame(
        [(1, 3, body), (2, 0, "[]")], "page long, n_items long, body string"
    )
    with pytest.raises(MissingKey, match="2 records"):
        ingest_pages(pages, "id", f"{root}/data", f"{root}/state", "r")
    assert not os.path.exists(f"{root}/data/r")
    assert load_watermark(spark, f"{root}/state") == mark


def test_pages_of_a_relation(spark, root):
    rows = [(2, 1, '[{"id": "b", "n": 1}]'), (1, 1, '[{"id": "a"}]'), (3, 0, "[]"),
            (4, 1, '[{"id": "z"}]')]
    pages = spark.createDataFrame(rows, "page long, n_items long, body string")
    got = ingest_pages(pages, "id", f"{root}/data", f"{root}/state", "r")
    assert (got.mode, got.rows, got.watermark) == ("full", 2, "b")
    assert landed(spark, root, "r") == ["a", "b"]
    again = ingest_pages(pages, "id", f"{root}/data", f"{root}/state", "s")
    assert (again.mode, again.rows) == ("incremental", 0)


def test_pages_after_a_gap_are_dropped(spark, root, api):
    api.serve(keys(100), full=5)
    with open(f"{api.root}/id:asc/7.json", "w") as file:
        file.write("[]")
    assert do(spark, root, api.source(), "r").rows == 30


def test_landing_a_run_again_replaces_it(spark, root, api):
    api.serve(keys(5))
    do(spark, root, api.source(), "r")
    os.rename(f"{root}/state", f"{root}/state-lost")
    do(spark, root, api.source(), "r")
    assert landed(spark, root, "r") == keys(5)


def test_unreachable_pages_fail_the_load(spark, root, api):
    api.serve(keys(3))
    source = api.source(options={"missing": "error", "retries": 1})
    with pytest.raises(PageFetchError):
        do(spark, root, source, "r")
    assert not os.path.exists(f"{root}/data/r")
    assert load_watermark(spark, f"{root}/state") is None


def test_pages_as_a_relation(spark, api):
    api.serve(keys(7), full=3)
    pages = read_pages(
        spark, f"file://{api.root}/id:asc/{{page}}.json", 1, 3, per_page=3, pages_per_task=1
    )
    assert sorted((r["page"], r["n_items"]) for r in pages.collect()) == [(1, 3), (2, 3), (3, 1)]
    rows = records(pages, SCHEMA).orderBy("id").collect()
    assert [(r["page"], r["id"], r["n"]) for r in rows][-1] == (3, "k00006", 1.0)


@settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))
@given(first=st.integers(1, 90), more=st.integers(0, 70))
def test_two_loads_land_what_one_load_would(spark, first, more):
    root = tempfile.mkdtemp(prefix="lakeweir-two-")
    api = Api(root)
    api.serve(keys(first), full=20, incremental=15)
    one = do(spark, root, api.source(), "r1")
    api.serve(keys(first + more), full=20, incremental=15)
    two = do(spark, root, api.source(), "r2")
    assert (one.rows, two.rows) == (first, more)
    assert load_watermark(spark, f"{root}/state") == keys(first + more)[-1]
    new = landed(spark, root, "r2") if more else []
    assert landed(spark, root, "r1") + new == keys(first + more)


# -- reader ----------------------------------------------------------------------------


class Answer:
    def __init__(self, text):
        self.text = text

    def __enter__(self):
        return self

    def __exit__(self, *_):
        return False

    def read(self):
        return self.text.encode()


def reader(monkeypatch, answers, **options):
    calls, pauses = [], []

    def open_url(url, timeout):
        calls.append((url, timeout))
        answer = answers[min(len(calls), len(answers)) - 1]
        if isinstance(answer, Exception):
            raise answer
        return Answer(answer)

    monkeypatch.setattr(paged_json, "urlopen", open_url)
    monkeypatch.setattr(paged_json.time, "sleep", pauses.append)
    made = PagedJsonReader({"url": "u?p={page}&n={per_page}", "last_page": "9", **options})
    return made, calls, pauses


def test_page_ranges():
    made = PagedJsonReader({"url": "u", "first_page": "3", "last_page": "9", "pages_per_task": "3"})
    assert [(p.first, p.last) for p in made.partitions()] == [(3, 5), (6, 8), (9, 9)]


def test_retry_pauses_double(monkeypatch):
    made, calls, pauses = reader(monkeypatch, [URLError("down")] * 3 + ["[1]"])
    assert made.fetch(5) == ("[1]", 1)
    assert pauses == [1.0, 2.0, 4.0]
    assert calls[0] == ("u?p=5&n=200", 30.0)


def test_gives_up_after_three_retries(monkeypatch):
    made, calls, _ = reader(monkeypatch, [URLError("down")])
    with pytest.raises(RuntimeError, match="page 5 after 4 attempts"):
        made.fetch(5)
    assert len(calls) == 4


def test_broken_body_is_retried(monkeypatch):
    made, calls, _ = reader(monkeypatch, ['[{"id": ', '{"message": "busy"}', "[]"])
    assert made.fetch(1) == ("[]", 0)
    assert len(calls) == 3


def test_missing_page_counts_as_empty_when_asked(monkeypatch):
    gone = HTTPError("u", 404, "gone", None, None)
    made, calls, _ = reader(monkeypatch, [gone], missing="empty")
    assert made.fetch(1) == ("[]", 0) and len(calls) == 1
    made, _, _ = reader(monkeypatch, [gone])
    with pytest.raises(RuntimeError):
        made.fetch(1)


def test_a_task_stops_at_its_first_empty_page(monkeypatch):
    made, calls, _ = reader(monkeypatch, ["[1]", "[]", "[2]"])
    assert [row[:2] for row in made.read(paged_json.PageRange(1, 4))] == [(1, 1), (2, 0)]
    assert len(calls) == 2


# -- state -----------------------------------------------------------------------------


@pytest.mark.parametrize("mark", [None, ""])
def test_no_mark_means_full(mark):
    got = plan_load(mark)
    assert (got.mode, got.per_page, got.direction, got.watermark) == ("full", 200, "asc", None)


def test_a_mark_means_incremental():
    got = plan_load("k")
    assert (got.mode, got.per_page, got.direction) == ("incremental", 50, "desc")


@pytest.mark.parametrize(
    ("text", "want"),
    [
        ("{}", None),
        ('{"max_id": null}', None),
        ('{"max_id": ""}', ""),
        ('{\n  "max_id": "k"\n}', "k"),
    ],
)
def test_state_documents(spark, root, text, want):
    os.makedirs(f"{root}/state")
    with open(f"{root}/state/metadata.json", "w") as file:
        file.write(text)
    assert load_watermark(spark, f"{root}/state") == want


def test_latest_mark_wins(spark, root):
    for mark in ("b", "c", "a"):
        save_watermark(spark, f"{root}/state", mark)
    assert load_watermark(spark, f"{root}/state") == "a"


def test_damaged_state_raises(spark, root):
    os.makedirs(f"{root}/state")
    with open(f"{root}/state/metadata.json", "w") as file:
        file.write('{"max_id": ')
    with pytest.raises(Exception, match="(?i)malformed|parse"):
        load_watermark(spark, f"{root}/state")
