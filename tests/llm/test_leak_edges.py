"""Leaks at the edges of documents and in documents shorter than the item."""

from __future__ import annotations

import pytest
from test_search import brute_leaks

from lakeweir.llm import decontamination

WORDS = [f"w{i}" for i in range(50)]
AROUND = [f"other{i}" for i in range(30)]
SHORT = {
    "minus the first": WORDS[1:],
    "minus the last": WORDS[:-1],
    "minus one": WORDS[:20] + WORDS[21:],
}
TEXTS = {
    "starts without the first word": WORDS[1:] + AROUND,
    "ends without the last word": AROUND + WORDS[:-1],
    "starts without three words": WORDS[3:] + AROUND,
    "whole with text around": AROUND + WORDS + AROUND,
}


def found(spark, texts):
    frame = spark.createDataFrame(
        [(i, " ".join(text)) for i, text in enumerate(texts)], "doc_id long, text string"
    )
    items = spark.createDataFrame([(7, " ".join(WORDS))], "item_id long, text string")
    rows = decontamination.find_leaks(frame, items).collect()
    return {r.doc_id: (r.start, r.n_words, r.similarity) for r in rows}


def test_leaks_at_the_edge(spark):
    texts = list(TEXTS.values())
    want = brute_leaks(
        [(i, " ".join(text)) for i, text in enumerate(texts)], [(7, " ".join(WORDS))]
    )
    assert len(want) == len(texts)
    got = found(spark, texts)
    assert {(i, 7): row[2] for i, row in got.items()} == want
    assert got[0][0] == 0 and got[1][0] == len(texts[1]) - 50


def test_documents_shorter_than_the_item(spark):
    got = found(spark, [*SHORT.values(), WORDS[:42], WORDS[:41], WORDS[:30]])
    assert got.keys() == {0, 1, 2, 3, 4}
    assert got[0] == (0, 49, pytest.approx(45 / 46))
    assert got[4][1:] == (41, pytest.approx(37 / 46))
