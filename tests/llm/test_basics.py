"""Sharding, quality rules, packing and SimHash against brute force."""

from __future__ import annotations

import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import xxhash
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from lakeweir.llm import packing, quality_rules, sharding, simhash
from lakeweir.llm.queries import QUERIES
from lakeweir.llm.text import documents

WORD = re.compile(r"[^\x20\x09-\x0D]+")
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def collect(frame):
    return [row.asDict(recursive=True) for row in frame.collect()]


# -- sharding --------------------------------------------------------------------------


def test_shards_hold_every_document(spark, sf_dir, docs):
    rows = collect(QUERIES["op1_sharding"](spark, sf_dir))
    assert Counter(r["doc_id"] for r in rows) == Counter(d for d, _ in docs)
    texts = dict(docs)
    slots = defaultdict(list)
    for r in rows:
        data = (texts[r["doc_id"]] or "").encode()
        assert (r["size"], r["text_crc32"]) == (len(data) + 16, zlib.crc32(data))
        assert 0 <= r["shard"] < 40
        assert r["grown_shard"] in (r["shard"], 40)
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert any(r["grown_shard"] == 40 for r in rows)


def test_small_buckets_shuffle_repeatably(spark, sf_dir):
    rows = documents(spark, sf_dir, "doc_id", "text")

    def places():
        out = sharding.with_slots(sharding.shuffle_into_shards(rows, 3, bucket_bytes=20_000))
        return {(r["shard"], r["slot"]): r["record"]["doc_id"] for r in collect(out)}

    first = places()
    assert first == places()
    order = [first[key] for key in sorted(first)]
    assert order != sorted(order)
    grown = sharding.shuffle_into_shards(rows, 4, bucket_bytes=20_000)
    shard = {doc: key[0] for key, doc in first.items()}
    assert all(r["shard"] in (shard[r["record"]["doc_id"]], 3) for r in collect(grown))


@pytest.mark.parametrize("key", [None, 7])
def test_equal_rows_spread_over_buckets(spark, key):
    """A hundred thousand rows alike, and others of their key, in buckets of bounded size."""
    own = F.lit(key).cast("long").alias("doc_id")
    alike = spark.range(100_000).select(own, F.lit("x").alias("text"))
    other = spark.range(20_000).select(own, F.concat(F.lit("own "), "id").alias("text"))
    few = spark.range(50).select("id", F.lit("few").alias("text")).toDF("doc_id", "text")
    rows = alike.unionByName(other).unionByName(few)
    out = sharding.with_slots(sharding.shuffle_into_shards(rows, 3, bucket_bytes=200_000))
    sizes = out.groupBy("shard", "bucket").count().collect()
    assert sum(r["count"] for r in sizes) == 120_050
    assert len(sizes) > 9 and max(r["count"] for r in sizes) < 15_000
    texts = Counter(r["text"][:3] for r in out.select("record.text").collect())
    assert texts == {"x": 100_000, "own": 20_000, "few": 50}
    slots = out.groupBy("shard").agg(F.count_distinct("slot").alias("n"), F.max("slot").alias("m"))
    assert all(r["n"] == r["m"] + 1 for r in slots.collect())


def test_sharding_edges(edge_frame, empty_frame):
    rows = collect(sharding.shuffle_into_shards(edge_frame, 2))
    assert Counter((r["record"]["doc_id"], r["record"]["text"]) for r in rows) == Counter(
        (r["doc_id"], r["text"]) for r in collect(edge_frame)
    )
    assert {r["record"]["shard"] for r in rows} == set(range(11))
    assert collect(sharding.shuffle_into_shards(empty_frame, 2)) == []


# -- quality rules ---------------------------------------------------------------------


def base_counts(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    often = Counter(windows)
    covered = {j for i, w in enumerate(windows) if often[w] > 1 for j in (i, i + 1, i + 2)}
    lines = [line for line in text.split("\n") if WORD.search(line)]
    return {
        "n_words": len(words),
        "word_chars": sum(map(len, words)),
        "n_symbols": len(re.findall(r"[#*$%&|<>]", text)),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": len(covered),
    }


def check_quality(judged):
    for r in judged:
        want = base_counts(r["text"])
        got = {name: r["q"][name] for name in want}
        assert got == want, r["doc_id"]
        failed = want["n_words"] < 50 or 100 * want["n_repeat_words"] > 50 * want["n_words"]
        assert r["q"]["base_failed"] is failed
        assert not (failed and r["q"]["kept"])


def test_quality_counts(spark, sf_dir):
    check_quality(collect(quality_rules.judge(documents(spark, sf_dir), name="q")))


def test_quality_edges(edge_frame, empty_frame):
    judged = collect(quality_rules.judge(edge_frame, name="q"))
    assert len(judged) == 11
    check_quality(judged)
    assert {r["quality"] for r in judged} == {"x"}
    assert collect(quality_rules.judge(empty_frame, name="q")) == []


def test_quality_follows_the_labels(spark):
    base = "/root/testdata/sf0.01"
    judged = quality_rules.judge(documents(spark, base, "doc_id", "text"))
    rows = collect(
        judged.join(spark.read.parquet(f"{base}/labels.parquet").withColumnRenamed(
            "quality", "label"), "doc_id")
    )
    rows = [r for r in rows if not r["quality"]["base_failed"]]
    good = [r["quality"]["kept"] for r in rows if r["label"] == 1]
    bad = [r["quality"]["kept"] for r in rows if r["label"] == 0]
    assert np.mean(good) > 0.95
    assert np.mean(bad) < 0.5


# -- packing ---------------------------------------------------------------------------


def check_packing(rows, texts, capacity=2048):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    pieces = defaultdict(list)
    sequences = defaultdict(list)
    for r in rows:
        pieces[r["doc_id"]].append(r)
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    for doc_id, text in texts:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
        data = np.array(ids, dtype="<u4").tobytes()
        own = sorted(pieces.pop(doc_id), key=lambda r: r["piece"])
        assert [r["piece"] for r in own] == list(range(len(own)))
        assert len(own) == -(-len(ids) // capacity)
        at = 0
        for r in own:
            assert r["start"] == at
            assert r["ids_crc32"] == zlib.crc32(data[4 * at : 4 * (at + r["length"])])
            at += r["length"]
        assert at == len(ids)
    assert not pieces
    return len(sequences), sum(r["length"] for r in rows)


def test_packing_is_exact_and_dense(spark, sf_dir, docs):
    rows = collect(QUERIES["op3_best_fit_packing"](spark, sf_dir))
    n, total = check_packing(rows, docs)
    assert n <= -(-total // 2048) + 1


def test_packing_edges(edge_frame, empty_frame):
    from pyspark.sql import functions as F

    def packed(frame):
        pieces = packing.tokenized_pieces(frame, RANKS, public_tokenizers.PATTERN, TOKENIZER)
        digests = pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")
        return collect(packing.pack(digests))

    rows = packed(edge_frame.where("doc_id IS NULL OR doc_id <> 7"))
    check_packing(rows, [(r.doc_id, r.text) for r in edge_frame.collect() if r.doc_id != 7])
    assert sum(r["doc_id"] == 7 for r in packed(edge_frame)) == 2
    assert packed(empty_frame) == []


def test_special_token_string(spark):
    from pyspark.sql import functions as F

    text = "a <|endoftext|> b"
    frame = spark.createDataFrame([(1, text)], "doc_id long, text string")
    pieces = packing.tokenized_pieces(frame, RANKS, public_tokenizers.PATTERN, TOKENIZER)
    rows = collect(packing.pack(pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")))
    check_packing(rows, [(1, text)])


@pytest.mark.parametrize("seed", range(5))
def test_local_search_keeps_items_and_empties_bins(seed):
    rng = np.random.default_rng(seed)
    lengths = rng.integers(1, 100, 300).tolist()
    start = [[i] for i in range(len(lengths))]
    search = packing.LocalSearch(lengths, start, 100)
    squares = int((search.fill**2).sum())
    bins = search.run()
    assert sorted(i for items in bins for i in items) == list(range(300))
    assert all(sum(lengths[i] for i in items) <= 100 for items in bins)
    assert int((search.fill**2).sum()) > squares
    small = rng.integers(1, 60, 300).tolist()
    packed = packing.pack_lengths(small, 100)
    assert len(packed) <= -(-sum(small) // 100) + 2


def test_swaps_empty_what_moves_cannot():
    # no item of the last bin fits elsewhere, but swapping shorter ones out makes room
    lengths = [60, 30, 60, 30, 35, 35, 12, 8]
    bins = [[0, 1], [2, 3], [4, 5, 6], [7]]
    assert len(packing.LocalSearch(lengths, bins, 100).run()) == 3


# -- simhash ---------------------------------------------------------------------------


def brute_fingerprint(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = WORD.findall(lowered)
    if not words:
        return 0
    shingles = [words[i : i + 3] for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(" ".join(s).encode(), 42) for s in shingles]
    return sum(
        1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes)
    )


def brute_components(prints, reach=2):
    """prints: (doc_id, fingerprint); every row's smallest reachable doc_id."""
    values = np.array([p for _, p in prints], dtype=np.uint64)
    parent = list(range(len(prints)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(prints)):
        for j in np.nonzero(np.bitwise_count(values ^ values[i]) <= reach)[0].tolist():
            a, b = find(i), find(j)
            parent[max(a, b)] = min(a, b)
    smallest = {}
    for i, (doc_id, _) in enumerate(prints):
        if doc_id is not None:
            smallest[find(i)] = min(smallest.get(find(i), doc_id), doc_id)
    return [smallest.get(find(i)) for i in range(len(prints))]


def test_near_duplicates(spark, sf_dir, docs):
    prints = [(d, brute_fingerprint(t)) for d, t in docs]
    want = {
        d: (f"{p:016x}", c) for (d, p), c in zip(prints, brute_components(prints), strict=True)
    }
    rows = collect(QUERIES["op9_simhash_near_dedup"](spark, sf_dir))
    assert {r["doc_id"]: (r["fingerprint"], r["component_id"]) for r in rows} == want
    assert len(rows) == len(docs)


def test_near_duplicate_edges(edge_frame, empty_frame):
    rows = collect(simhash.near_duplicates(edge_frame))
    prints = [(r.doc_id, brute_fingerprint(r.text)) for r in edge_frame.collect()]
    want = Counter(
        (d, p, c) for (d, p), c in zip(prints, brute_components(prints), strict=True)
    )
    assert want == Counter(
        (r["doc_id"], r["fingerprint"] % 2**64, r["component_id"]) for r in rows
    )
    assert collect(simhash.near_duplicates(empty_frame)) == []


def flipped(rng, base, bits):
    for bit in rng.choice(64, bits, replace=False).tolist():
        base ^= 1 << bit
    return base


def test_links_over_many_leaves(spark):
    """Chains and dense clusters across a deep tree, compared with all pairs."""
    rng = np.random.default_rng(3)
    values = {int(v) for v in rng.integers(0, 2**63, 600)}
    for base in sorted(values)[:60]:
        chain = base
        for _ in range(4):
            chain = flipped(rng, chain, int(rng.integers(1, 4)))
            values.add(chain)
    center = int(rng.integers(0, 2**63))
    values |= {flipped(rng, center, 1) for _ in range(200)}
    nodes = sorted(np.array(sorted(values), dtype=np.uint64).view(np.int64).tolist())
    frame = spark.createDataFrame([(v,) for v in nodes], "value long").repartition(5)
    roots = simhash.components(simhash.links(frame, leaf=32))
    got = {v: v for v in nodes} | {r["node"]: r["root"] for r in collect(roots)}
    unsigned = [(v, v % 2**64) for v in nodes]
    want = dict(zip(nodes, brute_components(unsigned), strict=True))
    assert got == want


def test_long_chain_settles(spark):
    chain = spark.range(200).selectExpr("id AS a", "id + 1 AS b")
    roots = collect(simhash.components(chain))
    assert {(r["node"], r["root"]) for r in roots} == {(n, 0) for n in range(1, 201)}
