"""The pipeline stage by stage against brute force, and its guarantees end to end."""

from __future__ import annotations

from collections import Counter

import pytest
from test_basics import brute_components, brute_fingerprint, check_packing
from test_search import brute_leaks, brute_removed

import corpus_pipeline
from lakeweir.llm import line_dedup

STAGES = dict(corpus_pipeline.STAGES)


def pairs(frame):
    return [(row.doc_id, row.text) for row in frame.select("doc_id", "text").collect()]


@pytest.fixture(scope="module")
def stages(spark, sf_dir, tmp_path_factory):
    """What went into and came out of each stage, as written."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = {}
    for name, stage in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp("stage") / name)
        stage(spark, docs, sf_dir).write.parquet(path)
        result = spark.read.parquet(path)
        out[name] = (docs, result)
        docs = result
    return out


def test_order_and_columns(stages, spark, sf_dir):
    names = list(stages)
    assert names == [
        "toxicity", "line_dedup", "simhash_near_dedup", "benchmark_decontamination",
        "best_fit_packing",
    ]
    columns = spark.read.parquet(f"{sf_dir}/documents.parquet").dtypes
    for name in names[:-1]:
        assert stages[name][1].dtypes == columns
        assert stages[name][1].count() > 0


def test_toxic_documents_go_and_most_others_stay(stages, spark, sf_dir):
    before, after = (dict(pairs(f)) for f in stages["toxicity"])
    assert all(before[key] == text for key, text in after.items())
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").collect()
    calm = [r.doc_id for r in labels if not r.toxic]
    assert sum(key in after for key in calm) > 0.9 * len(calm)
    insults = {"idiot", "moron", "worthless", "disgusting", "pathetic"}
    assert not any(insults & set(text.lower().split()) for text in after.values())


def test_lines_are_cut(stages):
    before, after = (pairs(f) for f in stages["line_dedup"])
    removed = brute_removed(before, line_dedup.LEAST_WORDS)
    want = {}
    for key, text in before:
        gone = set(removed.get(key, ()))
        kept = "\n".join(x for i, x in enumerate(text.split("\n")) if i not in gone)
        if not gone or kept.strip(" \t\n\x0b\f\r"):
            want[key] = kept
    assert dict(after) == want


def test_one_document_of_each_group_stays(stages):
    before, after = (pairs(f) for f in stages["simhash_near_dedup"])
    prints = [(key, brute_fingerprint(text)) for key, text in before]
    components = brute_components(prints)
    want = {key for (key, _), c in zip(prints, components, strict=True) if key == c}
    assert sorted(key for key, _ in after) == sorted(want)


def test_leaks_go(stages, spark, sf_dir):
    before, after = (pairs(f) for f in stages["benchmark_decontamination"])
    items = pairs(
        spark.read.parquet(f"{sf_dir}/benchmark.parquet").withColumnRenamed("item_id", "doc_id")
    )
    leaked = {key for key, _ in brute_leaks(before, items)}
    assert leaked
    assert Counter(after) == Counter(p for p in before if p[0] not in leaked)


def test_everything_kept_is_packed(stages):
    before, packed = stages["best_fit_packing"]
    rows = [row.asDict() for row in packed.collect()]
    n, total = check_packing(rows, pairs(before))
    assert n <= -(-total // 2048) + 1


def test_run_gives_the_rows_of_its_stages(stages, spark, sf_dir):
    def places(frame):
        return Counter(
            (r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in frame.collect()
        )

    assert places(corpus_pipeline.run(spark, sf_dir)) == places(stages["best_fit_packing"][1])


def test_stages_on_edges_and_nothing(spark, sf_dir, edge_frame, empty_frame):
    for name, stage in list(STAGES.items())[:-1]:
        out = stage(spark, edge_frame, sf_dir)
        assert out.columns == edge_frame.columns
        keys = [row.doc_id for row in out.collect()]
        assert None in keys and 9 in keys, name
        assert stage(spark, empty_frame, sf_dir).count() == 0
    assert STAGES["best_fit_packing"](spark, empty_frame, sf_dir).count() == 0
    packed = STAGES["best_fit_packing"](spark, edge_frame, sf_dir).collect()
    assert Counter(r.doc_id for r in packed if r.piece == 0) == Counter(
        r.doc_id for r in edge_frame.collect()
    )
