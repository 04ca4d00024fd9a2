"""Line dedup with doubled and split passages, against a brute force of its own."""

from __future__ import annotations

import random

from lakeweir.llm import line_dedup


def removed(spark, rows):
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    return {r.doc_id: r.removed_lines for r in line_dedup.dedup_lines(frame).collect()}


def brute(rows):
    """With lines of at least eight words, every line that an earlier document holds goes."""
    out, seen = {}, set()
    for key, text in sorted(rows):
        lines = text.split("\n")
        out[key] = [at for at, line in enumerate(lines) if line in seen]
        seen |= set(lines)
    return out


def test_doubled_passages(spark):
    rng = random.Random(4)
    lines = [f"line {i} of the many lines that documents here share" for i in range(40)]
    passages = [rng.sample(lines, 3) for _ in range(12)]
    rows = []
    for key in range(120):
        parts = [line for p in rng.choices(passages, k=rng.randint(1, 5)) for line in p]
        own = f"line that only the document of number {key} holds in here"
        parts.insert(rng.randrange(len(parts) + 1), own)
        rows.append((key, "\n".join(parts)))
    assert removed(spark, rows) == brute(rows)


def test_nearer_document_holds_the_block(spark):
    """Each short line has a first holder of its own; one later document holds them all."""
    short = ["one two three", "four five six", "seven eight nine"]
    rows = [(i, f"{line}\nown {i}") for i, line in enumerate(short)]
    rows += [(k, "\n".join([f"own {k}", *short, f"end {k}"])) for k in (10, 11, 12)]
    assert removed(spark, rows) == {
        0: [], 1: [], 2: [], 10: [], 11: [1, 2, 3], 12: [1, 2, 3]
    }


def test_ranges_without_a_unique_line():
    matched = line_dedup.patience_match([1, 2, 1, 2, 9], [7, 1, 2, 8])
    assert matched in ([(0, 1), (1, 2)], [(2, 1), (3, 2)])
    words = [9] * 8
    assert line_dedup.common_blocks([5, 1, 2, 6], [1, 2, 7, 1, 2], words[:5], 8) == [0, 1, 3, 4]
    assert line_dedup.patience_match([0, 3, 0], [4, 0, 5]) == []
