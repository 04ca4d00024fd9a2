"""Very long texts, and the cases that only show on many rows."""

from __future__ import annotations

import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from test_suffix import check
from tokenizers import Tokenizer

from lakeweir.llm import packing, quality_rules, toxicity
from lakeweir.llm.text import slices

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
MILLION = 1_000_000


@pytest.mark.parametrize(
    "text",
    [
        " " * MILLION, "a" + " " * MILLION + "b", "\n" * 300_000, "\t \n" * 100_000,
        "a" * 200_000, "7" * 200_000, "!" * 200_000, "é" * 100_000, " x" * 200_000,
        "<|endoftext|>" + " " * 5000 + "z",
    ],
    ids=lambda text: f"{text[:3]!r}x{len(text)}",
)
def test_ids_of_long_runs(text):
    got = packing.ids_of(text, RANKS, public_tokenizers.PATTERN, TOKENIZER)
    want = Tokenizer.from_file(TOKENIZER).encode(text, add_special_tokens=False).ids
    assert got == want


def test_a_panic_of_the_encoder_is_no_end(monkeypatch):
    class PanicException(BaseException):
        pass

    class Broken:
        def encode_ordinary(self, text):
            raise PanicException("stack overflow")

    monkeypatch.setattr(packing, "_encoding", lambda *_: Broken())
    got = packing.ids_of("some words", RANKS, public_tokenizers.PATTERN, TOKENIZER)
    assert got == Tokenizer.from_file(TOKENIZER).encode("some words").ids


def test_loose_sequences_are_packed_until_one_group(spark, monkeypatch):
    """With groups of 64 pieces each level would leave a part-filled sequence per group."""
    monkeypatch.setattr(packing, "GROUP_PIECES", 64)
    rng = np.random.default_rng(6)
    lengths = rng.integers(1, 900, 20_000)
    frame = spark.createDataFrame(
        [(i, 0, int(n)) for i, n in enumerate(lengths)], "doc_id long, piece int, length long"
    )
    packed = packing.pack(frame).collect()
    assert sorted(r.doc_id for r in packed) == list(range(20_000))
    fill = {}
    for r in packed:
        fill.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for places in fill.values():
        ends = np.cumsum([0, *(length for _, length in sorted(places))])
        assert [at for at, _ in sorted(places)] == ends[:-1].tolist() and ends[-1] <= 2048
    # one level of loose sequences only
    monkeypatch.setattr(packing, "LAST_LEVEL", 1)
    shallow = {r.sequence_id for r in packing.pack(frame).collect()}
    least = -(-int(lengths.sum()) // 2048)
    assert least <= len(fill) < len(shallow) and len(fill) <= least * 1.005


def test_unlike_windows_that_agree_in_few_bits(spark, monkeypatch, docs):
    """The first comparison may mix up windows, as it does among millions; the count may not."""
    texts = [text for _, text in docs[:60]] + [" ".join(f"w{i}" for i in range(3000))]
    frame = spark.createDataFrame([(t,) for t in texts], "text string")
    counts = quality_rules.judge(frame.withColumn("doc_id", F.lit(1))).select(
        "text", "quality.n_repeat_words"
    )
    want = {tuple(r) for r in counts.collect()}
    monkeypatch.setattr(quality_rules, "SPARE_BITS", 48)
    coarse = quality_rules.judge(frame.withColumn("doc_id", F.lit(1))).select(
        "text", "quality.n_repeat_words"
    )
    assert {tuple(r) for r in coarse.collect()} == want
    assert (texts[-1], 0) in want


def test_batches_are_bounded_by_bytes():
    texts = ["a" * n for n in (0, 5, 0, 300, 4, 4, 4, 90, 0, 11)] + [None, "b"]
    batch = pa.RecordBatch.from_arrays([pa.array(texts, pa.binary())], names=["text"])
    got = [[len(t or "") for t in part.column(0).to_pylist()] for part in slices(batch, 0, 3, 100)]
    assert got == [[0, 5, 0], [300], [4, 4, 4], [90, 0], [11, 0, 1]]
    assert list(slices(batch.slice(0, 0), 0, 3, 100)) == []


def test_insults_of_few_texts(spark):
    """Four toxic texts with a word: a landmark only when asked for."""
    rows = [(f"you are a blockhead number {i}", 1) for i in range(4)]
    rows += [(f"the tree by the river is number {i}", 0) for i in range(30)]
    sample = spark.createDataFrame(rows, "text string, label int")
    assert toxicity.pick_landmarks(sample) == []
    assert b"^blockhead" in toxicity.pick_landmarks(sample, least_texts=2)


def test_repeated_keys_keep_their_own_bytes(spark):
    copied = "this passage of more than fifty bytes is held by several rows, 0123456789"
    own = "nothing of this row's text is found anywhere else in the whole table, truly not"
    rows = [(1, copied), (5, own), (5, copied), (5, own + copied), (5, copied), (7, own)]
    assert zlib.crc32(own.encode()) != zlib.crc32(copied.encode())
    check(spark.createDataFrame(rows, "doc_id long, text string"), rows)
