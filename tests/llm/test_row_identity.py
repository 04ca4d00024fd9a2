"""Rows that repeat or lack a doc_id: each is judged by its own text."""

from __future__ import annotations

import random

import pytest

import corpus_pipeline
from lakeweir.llm import decontamination, line_dedup

STAGES = dict(corpus_pipeline.STAGES)
SCHEMA = "doc_id long, text string"


def words(seed, n=60):
    rng = random.Random(seed)
    return " ".join(f"w{rng.randrange(10**6)}" for _ in range(n))


def test_lines_of_rows_that_share_a_key(spark):
    copied, own = words(1), words(2)
    rows = [(1, copied), (5, own), (5, copied), (5, copied)]
    out = line_dedup.dedup_lines(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted((r.doc_id, r.text) for r in out) == sorted(
        [(1, copied), (5, own), (5, ""), (5, "")]
    )


def test_first_holder_among_rows_that_share_a_key(spark):
    """The passage's holder with the least key aligns, whichever of its rows holds it."""
    copied = words(3)
    rows = [(1, words(4)), (1, copied), (1, words(5)), (2, f"{copied}\n{words(6)}")]
    out = line_dedup.dedup_lines(spark.createDataFrame(rows, SCHEMA)).collect()
    assert {r.doc_id: r.removed_lines for r in out} == {1: [], 2: [0]}
    assert sum(r.doc_id == 1 for r in out) == 3


@pytest.mark.parametrize("keys", [(9, 9, 9), (None, None, None), (None, 7, 7), (3, 2, 1)])
def test_one_of_equal_rows_stays(spark, sf_dir, keys):
    rows = [(key, words(7)) for key in keys] + [(4, words(8)), (None, words(9))]
    out = STAGES["simhash_near_dedup"](spark, spark.createDataFrame(rows, SCHEMA), sf_dir)
    kept = [(r.doc_id, r.text) for r in out.collect()]
    first = min((key for key in keys if key is not None), default=None)
    assert sorted(kept, key=repr) == sorted(
        [(first, words(7)), (4, words(8)), (None, words(9))], key=repr
    )


def test_planted_near_copies(spark, sf_dir):
    """Texts with equal words go whatever parts them; unlike texts stay."""
    rng = random.Random(11)
    rows = []
    for group in range(30):
        text = words(100 + group, 200)
        rows += [text, text.upper(), text.replace(" ", "\n", 9), f"  {text}\t"]
    order = list(range(len(rows)))
    rng.shuffle(order)
    frame = spark.createDataFrame([(at, rows[at]) for at in order], SCHEMA)
    out = STAGES["simhash_near_dedup"](spark, frame, sf_dir)
    assert sorted(r.doc_id for r in out.collect()) == list(range(0, 120, 4))


def test_leaks_without_a_key_go_and_clean_namesakes_stay(spark, sf_dir):
    item = max(
        (r.text for r in spark.read.parquet(f"{sf_dir}/benchmark.parquet").collect() if r.text),
        key=len,
    )
    rows = [(None, f"{words(1)} {item} {words(2)}"), (8, words(3)), (8, f"{item} {words(4)}")]
    rows += [(None, words(5)), (None, None)]
    out = STAGES["benchmark_decontamination"](spark, spark.createDataFrame(rows, SCHEMA), sf_dir)
    assert sorted(((r.doc_id, r.text) for r in out.collect()), key=repr) == sorted(
        [(8, words(3)), (None, words(5)), (None, None)], key=repr
    )


def test_windows_of_rows_that_share_a_key(spark):
    """The item lies at different places of two rows, and a third has none; a row that is a
    prefix of another finds its own windows only."""
    item = words(20, 50)
    items = spark.createDataFrame([(1, item)], "item_id long, text string")
    early, late = f"{item} {words(21, 90)}", f"{words(22, 70)} {item} {words(23, 5)}"
    rows = [(5, early), (5, late), (5, words(24, 300)), (5, early), (6, late), (7, words(25))]
    found = decontamination.find_leaks(spark.createDataFrame(rows, SCHEMA), items).collect()
    got = {r.doc_id: (r.start, r.n_words, r.similarity, r.n_windows) for r in found}
    assert got.keys() == {5, 6}
    assert got[5][:3] == (0, 50, 1.0) and got[6][:3] == (70, 50, 1.0)
