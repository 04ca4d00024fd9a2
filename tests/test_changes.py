"""Work in proportion to a change: upserts, marts and checks that leave the table alone."""

from __future__ import annotations

import random
import re
from dataclasses import replace

import pytest
from pyspark.sql import functions as F
from test_plans import plan

from lakeweir import standins
from lakeweir.operators import partial_checks as partial
from lakeweir.operators import quality
from lakeweir.operators.counts import apply_counts, count_by, rollup_shares, signed_counts
from lakeweir.plans import flow
from lakeweir.plans.checked import CheckedTable
from lakeweir.plans.flow import Lake
from lakeweir.plans.tables import ORDER, Table
from lakeweir.schemas import record
from lakeweir.sources import storage

SCHEMA = record(id="string", place="string", v="integer")
CHECKS = (
    quality.Check("keys").is_unique("id").is_complete("id", "place", "nowhere"),
    quality.Check("values", quality.WARNING)
    .is_unique("v")
    .has_data_type("Integral", "v", "place")
    .has_data_type("String", "place"),
)


def keyed(spark, root, **more):
    return Table(spark, f"{root}/t", SCHEMA, ("id",), **more)


def frame(spark, rows, place=None):
    made = spark.createDataFrame(rows, SCHEMA)
    return made if place is None else made.withColumn(ORDER, F.lit(place))


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=repr)


# -- upserts decided by spans ----------------------------------------------------------


@pytest.fixture
def written_plans(monkeypatch):
    """What each commit is written from: its plan, and the files it reads."""
    seen = []
    write = Table._write

    def watched(self, df, kind, token):
        seen.append((kind, plan(df), df.inputFiles()))
        return write(self, df, kind, token)

    monkeypatch.setattr(Table, "_write", watched)
    return seen


def test_spans_are_kept(spark, root):
    table = keyed(spark, root)
    table.upsert(frame(spark, [("a", "x", 1), (None, "x", 1)], "run-1"))
    table.upsert(frame(spark, [("b", "x", 1)], "run-3"))
    table.upsert(frame(spark, [("c", "x", 1)]))
    table.upsert(frame(spark, [], "run-4"))
    got = [table.span(commit) for commit in table.live()]
    assert [(s.rows, s.unplaced, s.first, s.last) for s in got] == [
        (2, 0, "run-1", "run-1"), (1, 0, "run-3", "run-3"), (1, 1, None, None), (0, 0, None, None)
    ]
    for commit in table.live():
        storage.remove(spark, table._span_path(commit.path))
    assert [table.span(commit) for commit in table.live()] == got
    assert storage.read_text(spark, table._span_path(table.live()[0].path)) is not None


def test_an_upsert_in_order_does_not_look_at_the_table(spark, root, written_plans):
    table = keyed(spark, root, fold_after=2)
    for step in range(5):
        table.upsert(frame(spark, [("a", "x", step), (f"own-{step}", "x", step)], f"run-{step}"))
    for kind, text, files in written_plans:
        if kind == "upsert":
            assert "Join" not in text and "FileScan" not in text and not files
    assert "upsert" in [kind for kind, *_ in written_plans]
    got = {r["id"]: r["v"] for r in table.read_snapshot().collect()}
    assert got["a"] == 4 and len(got) == 6


def test_a_late_upsert_reads_the_commits_ahead_of_it(spark, root, written_plans):
    table = keyed(spark, root)
    for place in (1, 5, 9):
        rows = [("a", "x", place), (f"k{place}", "x", place), (None, "x", place)]
        table.upsert(frame(spark, rows, f"run-{place}"))
    table.upsert(frame(spark, [("a", "late", 3), ("k1", "late", 3), ("k9", "late", 3)], "run-3"))
    kind, text, files = written_plans[-1]
    assert kind == "upsert" and "Join" in text
    read = {re.search(r"version=(\d+)", f)[1] for f in files if "/t/" in f}
    assert read == {"00000001", "00000002"}
    got = {r["id"]: (r["place"], r["v"]) for r in table.read_snapshot().where("id <> ''").collect()}
    assert got == {"a": ("x", 9), "k1": ("late", 3), "k5": ("x", 5), "k9": ("x", 9)}


def test_a_row_without_a_place_takes_it_away(spark, root):
    table = keyed(spark, root)
    table.upsert(frame(spark, [("a", "x", 1), ("b", "x", 1)], "run-5"))
    table.upsert(frame(spark, [("a", "y", 2)]))
    table.upsert(frame(spark, [("a", "z", 3), ("b", "z", 3)], "run-4"))
    assert rows_of(table.read_snapshot()) == [("a", "z", 3), ("b", "x", 1)]


def test_orders_of_runs_do_not_matter(spark, root):
    rng = random.Random(5)
    runs = {f"run-{n}": [(k, f"run-{n}", n) for k in rng.sample("abcdef", 3)] for n in range(6)}
    want = {}
    for name in sorted(runs):
        want |= {k: (place, v) for k, place, v in runs[name]}
    for seed in range(3):
        names = random.Random(seed).sample(sorted(runs), len(runs))
        table = Table(spark, f"{root}/{seed}", SCHEMA, ("id",), fold_after=2)
        for name in names:
            table.upsert(frame(spark, runs[name], name))
        got = table.read_snapshot().collect()
        assert {r["id"]: (r["place"], r["v"]) for r in got} == want


# -- changed rows and marts ------------------------------------------------------------


def test_changed_since(spark, root):
    table = keyed(spark, root, fold_after=2)
    table.upsert(frame(spark, [("a", "x", 1), ("b", "x", 1), (None, "x", 1), ("c", "x", 1)]))
    start = table.newest().version
    came, left = table.changed_since(start)
    assert rows_of(came) == rows_of(left) == []
    table.upsert(frame(spark, [("a", "y", 2), ("n", "y", 2), (None, "y", 2)]))
    middle = table.newest().version
    table.upsert(frame(spark, [("a", "z", 3), ("b", "z", 3)]))
    table.upsert(frame(spark, [("n", "z", 4)]))
    assert table.newest().kind == "fold"
    came, left = table.changed_since(start)
    assert rows_of(came) == [("a", "z", 3), ("b", "z", 3), ("n", "z", 4), (None, "y", 2)]
    assert rows_of(left) == [("a", "x", 1), ("b", "x", 1)]
    came, left = table.changed_since(middle)
    assert rows_of(came) == [("a", "z", 3), ("b", "z", 3), ("n", "z", 4)]
    assert rows_of(left) == [("a", "y", 2), ("b", "x", 1), ("n", "y", 2)]
    table.compact()
    assert rows_of(table.changed_since(middle)[0]) == rows_of(came)
    newest = table.newest().version
    table.write_snapshot(frame(spark, [("a", "x", 1)]))
    assert table.changed_since(newest) is None
    assert table.changed_since(99) is None


def test_changes_behind_a_gap_are_not_told(spark, root):
    table = keyed(spark, root)
    for step in range(4):
        table.upsert(frame(spark, [("a", "x", step)]))
    first, _, third, _ = table.live()
    storage.remove(spark, third.path)
    assert table.changed_since(first.version) is None


def test_a_delta_groups_changed_rows_only(spark, root):
    table = keyed(spark, root)
    table.upsert(frame(spark, [(str(i), "x", i) for i in range(50)]))
    start = table.newest().version
    table.upsert(frame(spark, [("1", "y", 0), ("new", "y", 0)]))
    delta = signed_counts(*table.changed_since(start), ["place"], "n")
    assert rows_of(delta) == [("x", -1), ("y", 2)]
    text = plan(delta)
    # the scan of the base meets the changed keys before any row of it is grouped
    assert "LeftSemi" in text
    mart = count_by(frame(spark, [("1", "x", 0)] * 1 + [("2", "z", 0)] * 2), ["place"], "n")
    kept = apply_counts(mart, delta, ["place"], "n")
    assert rows_of(kept) == [("y", 2), ("z", 2)]


def site_lake(spark, root):
    return replace(
        standins._site_lake(spark), root=f"{root}/lake", partition_by=(), checks=CHECKS,
        curated_schema=SCHEMA, mart_dimensions=("place",), mart_count="n",
    )


def land(spark, lake, run, rows):
    frame(spark, rows).write.json(f"{lake.raw_data}/2024_01_0{run}_00_00_00_000000")


def test_marts_and_reports_follow_any_history(spark, root):
    rng = random.Random(9)
    lake: Lake = site_lake(spark, root)
    for run in range(1, 6):
        rows = [
            (k, rng.choice(["x", "y", "12", None]), rng.choice([None, 1, 2, 3, rng.randrange(99)]))
            for k in rng.sample("abcdefghij", rng.randint(0, 6))
        ]
        land(spark, lake, run, rows)
        if run == 4:
            lake.curated(spark).compact()
        curated = flow.curate(spark, lake)
        if run == 3:
            continue  # two runs at once
        want = count_by(curated, ["place"], "n")
        assert rows_of(flow.publish_changes(spark, lake).select("place", "n")) == rows_of(want)
        report = lake.checked(spark).report()
        assert rows_of(report) == rows_of(quality.verify(curated, CHECKS))
    commits = len(lake.mart(spark)._folders())
    flow.publish_changes(spark, lake)
    assert len(lake.mart(spark)._folders()) == commits


def test_a_run_by_changes_only(spark, root):
    lake = replace(site_lake(spark, root), checks=(quality.Check("c").is_unique("id"),))
    land(spark, lake, 1, [("a", "x", 1), ("b", "x", 1)])
    assert rows_of(flow.run(spark, lake, changes_only=True)) == [("x", 2)]
    land(spark, lake, 2, [("b", "y", 2), ("c", "y", 2)])
    assert rows_of(flow.run(spark, lake, changes_only=True)) == [("x", 1), ("y", 2)]
    land(spark, lake, 3, [("d", "z", 2), ("d", "z", 3)])
    with pytest.raises(quality.QualityGateError, match="unique"):
        flow.run(spark, lake, changes_only=True)
    assert rows_of(lake.mart(spark).read_snapshot()) == [("x", 1), ("y", 2)]


# -- partial checks --------------------------------------------------------------------


def test_parts_add_up(spark):
    rows = [("a", "x", 1), ("b", "12", 1), ("b", None, None), (None, "x", 7), ("c", "1.5", 2)]
    first, second = frame(spark, rows[:2]), frame(spark, rows[2:])
    gone = frame(spark, [("b", "12", 1)])
    multiplicities = partial.merged_multiplicities(
        *(partial.multiplicities_of(part, CHECKS) for part in (first, second)),
        partial.multiplicities_of(gone, CHECKS, -1),
    )
    counts = partial.merged_counts(
        *(partial.counts_of(part, CHECKS) for part in (second, first)),
        partial.counts_of(gone, CHECKS, -1),
        partial.single_values(multiplicities),
    )
    left = frame(spark, [row for row in rows if row[1] != "12"])
    got = partial.report_of(counts, CHECKS, SCHEMA)
    assert rows_of(got) == rows_of(quality.verify(left, CHECKS))
    assert got.schema.names == quality.REPORT.names


def test_counts_of_nothing_and_of_zeros(spark):
    none = frame(spark, [])
    counts = partial.merged_counts(partial.counts_of(none, CHECKS))
    assert rows_of(partial.report_of(counts, CHECKS, SCHEMA)) == rows_of(
        quality.verify(none, CHECKS)
    )
    assert partial.report_of(counts, [], SCHEMA).collect() == []
    zeros = spark.createDataFrame([(0.0,), (-0.0,), (1.5,)], "v double")
    check = [quality.Check("c").is_unique("v")]
    assert rows_of(partial.multiplicities_of(zeros, check)) == [("v", "0.0", 2), ("v", "1.5", 1)]


def test_a_check_that_broke_off_starts_anew(spark, root, monkeypatch):
    table = keyed(spark, root)
    table.upsert(frame(spark, [("a", "x", 1), ("b", "x", 1)]))
    checked = CheckedTable(table, f"{root}/checks", CHECKS)
    checked.report()
    table.upsert(frame(spark, [("b", "y", 2), ("c", "y", 2)]))
    overwrite = Table.overwrite

    def refuse(*_, **__):
        raise OSError("lost")

    monkeypatch.setattr(Table, "overwrite", refuse)
    with pytest.raises(OSError):
        checked.report()
    monkeypatch.setattr(Table, "overwrite", overwrite)
    want = rows_of(quality.verify(table.read_snapshot(), CHECKS))
    assert rows_of(checked.report()) == want
    other = CheckedTable(table, f"{root}/checks", CHECKS[:1])
    assert rows_of(other.report()) == rows_of(quality.verify(table.read_snapshot(), CHECKS[:1]))


# -- shares ----------------------------------------------------------------------------


def test_shares_of_each_level_add_up(spark):
    rows = [("n", "a", "x"), ("n", "a", "y"), ("n", None, "x"), (None, "b", "x"), (None, "b", "x")]
    shares = rollup_shares(spark.createDataFrame(rows, "a string, b string, c string"), ["a", "b"])
    got = rows_of(shares.select("a", "b", "level", "n", "share"))
    assert got == sorted(
        [
            (None, None, 3, 5, 1.0), ("n", None, 1, 3, 0.6), (None, None, 1, 2, 0.4),
            ("n", "a", 0, 2, 2 / 3), ("n", None, 0, 1, 1 / 3), (None, "b", 0, 2, 1.0),
        ],
        key=repr,
    )
    assert "Window" in plan(shares)
