"""Whitening against numpy on whole tables."""

from __future__ import annotations

import math

import numpy as np
import pytest

from lakeweir.llm import whitening
from lakeweir.llm.queries import QUERIES

NAN, INF = float("nan"), float("inf")


def brute(rows, components=4):
    """key -> (n, deviation, whitened per component, explained), signs as they come."""
    good = [
        (key, tuple(math.floor(256 * float(c)) for c in vector))
        for key, vector in rows
        if vector is not None and all(c is not None and math.isfinite(c) for c in vector)
    ]
    distinct = np.array(sorted({x for _, x in good}), dtype=np.int64)
    n, sums = len(distinct), distinct.sum(axis=0)
    centred = distinct - sums / n
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1][:components], vectors[:, ::-1][:, :components]
    share = values / np.trace(centred.T @ centred / n)
    out = []
    for key, x in good:
        deviation = sum((n * a - int(s)) ** 2 for a, s in zip(x, sums, strict=True))
        out.append((key, n, deviation, (np.array(x) - sums / n) @ vectors / np.sqrt(values), share))
    return out


def table(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()
    return [(r.vec_id, r.embedding) for r in rows]


def agree(got, want):
    """``got``: key, n, deviation, whitened, explained per row, in the order of ``want``."""
    assert [(k, n, d) for k, n, d, _, _ in got] == [(k, n, d) for k, n, d, _, _ in want]
    ours = np.array([w for *_, w, _ in got])
    theirs = np.array([w for *_, w, _ in want])
    signs = np.sign((ours * theirs).sum(axis=0))
    assert np.allclose(ours * signs, theirs, atol=1e-7)
    assert np.allclose([e for *_, e in got], [e for *_, e in want], rtol=1e-6)


def test_query(spark, sf_dir):
    rows = QUERIES["op13_embedding_whitening"](spark, sf_dir).collect()
    by_key = {}
    for r in sorted(rows, key=lambda r: (r.vec_id, r.component)):
        entry = by_key.setdefault(r.vec_id, (r.vec_id, r.n, r.deviation, [], []))
        entry[3].append(r.whitened)
        entry[4].append(r.explained)
        assert r.identity_error < 1e-9
    want = sorted(brute(table(spark, sf_dir)), key=lambda row: row[0])
    assert {len(entry[3]) for entry in by_key.values()} == {4}
    agree(sorted(by_key.values(), key=lambda row: row[0]), want)


def whitened(spark, rows, **options):
    frame = spark.createDataFrame(
        [(k, v, 1, "x") for k, v in rows], "vec_id long, embedding array<float>, index int, x string"
    )
    found = whitening.whiten(frame, **options).collect()
    return [(r.vec_id, r.n, r.deviation, r.whitened, r.explained) for r in found]


def test_broken_and_repeated_vectors(spark, sf_dir):
    rows = table(spark, sf_dir)[:60]
    rows += [(1000 + i, rows[0][1]) for i in range(200)] + [(1, rows[1][1]), (None, rows[2][1])]
    broken = [None, [None] * 64, [NAN] * 64, [*rows[0][1][:63], INF], [0.5] * 3, []]
    got = whitened(spark, rows + [(5000 + i, v) for i, v in enumerate(broken)])
    def order(row):
        return (row[0] is not None, row[0] or 0)

    agree(sorted(got, key=order), sorted(brute(rows), key=order))


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, [])]])
def test_nothing_to_fit(spark, rows):
    assert whitened(spark, rows) == []


def test_without_variance(spark):
    """One vector, and vectors on a line: only components with variance have values."""
    assert sorted(whitened(spark, [(1, [0.5, 1.0]), (2, [0.5, 1.0])])) == [
        (1, 1, 0, [None, None], [0.0, 0.0]), (2, 1, 0, [None, None], [0.0, 0.0])
    ]
    line = whitened(spark, [(i, [float(i), 2.0 * i, 1.0]) for i in range(5)], components=2)
    assert {row[3][1] for row in line} == {None}
    assert sorted(abs(row[3][0]) for row in line)[-1] == pytest.approx(math.sqrt(2))


def test_all_components(spark, sf_dir):
    rows = table(spark, sf_dir)
    got = whitened(spark, rows, components=None)
    values = np.array([row[3] for row in got])
    assert values.shape == (len(rows), 64)
    assert np.allclose(values.T @ values / len(rows), np.eye(64), atol=1e-8)
    assert sum(got[0][4]) == pytest.approx(1.0)
