from __future__ import annotations

import pytest

SF_DIR = "/root/testdata/sf0.001"

# Edge rows of a documents table: nulls, empty texts, ties, repeats, one very long text.
EDGES = [
    (1, None),
    (2, ""),
    (3, " \t\n"),
    (4, "one"),
    (5, "two words"),
    (6, "The same line here.\nThe same line here.\n\nA B C D A B C D"),
    (7, "The same line here.\nThe same line here.\n\nA B C D A B C D"),
    (7, "The same line here.\nThe same line here.\n\nA B C D A B C D"),
    (8, "naïve Straße ñandú \x0b ends. # * | <x>"),
    (9, "lorem ipsum dolor sit amet " * 4000),
    (None, "no key at all"),
]


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


@pytest.fixture(scope="session")
def docs(spark):
    return [
        (row.doc_id, row.text)
        for row in spark.read.parquet(f"{SF_DIR}/documents.parquet")
        .select("doc_id", "text")
        .collect()
    ]


@pytest.fixture(scope="session")
def edge_frame(spark):
    """Edge rows with extra columns whose names operators use themselves."""
    rows = [(*row, i, "x") for i, row in enumerate(EDGES)]
    return spark.createDataFrame(rows, "doc_id long, text string, shard int, quality string")


@pytest.fixture(scope="session")
def empty_frame(edge_frame):
    return edge_frame.limit(0)
