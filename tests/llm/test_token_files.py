"""Simple-8b blocks and the files of token ids."""

from __future__ import annotations

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from lakeweir.llm import simple8b, token_files
from lakeweir.llm.queries import QUERIES

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(
    st.integers(0, 1), st.integers(0, 50_000), st.integers(0, 2**64 - 1), st.just(0)
), max_size=700), st.data())
def test_round_trip(values, data):
    block = simple8b.encode(np.array(values, dtype=np.uint64))
    assert simple8b.decode(block).tolist() == values
    start = data.draw(st.integers(0, len(values)))
    stop = data.draw(st.integers(start, len(values)))
    assert simple8b.decode(block, start, stop).tolist() == values[start:stop]


def test_sizes_and_foreign_bytes():
    narrow = simple8b.encode(np.ones(60_000, dtype=np.uint32))
    assert len(narrow) < 60_000 // 60 * 8 * 1.1 + 64
    assert len(simple8b.encode(np.zeros(60_000, dtype=np.uint32))) < 2300
    assert len(simple8b.encode(np.full(6000, 30_000))) < 6000 * 2.2
    with pytest.raises(ValueError):
        simple8b.decode(b"other" * 10)


def test_joined_crc():
    rng = random.Random(1)
    for _ in range(50):
        a, b = rng.randbytes(rng.randrange(400)), rng.randbytes(rng.randrange(400))
        assert token_files.joined_crc(zlib.crc32(a), zlib.crc32(b), len(b)) == zlib.crc32(a + b)


def brute(rows):
    """Rows must have keys in ascending order."""
    tokenizer = Tokenizer.from_file(VOCABULARY)
    out, start = [], 0
    for key, text in rows:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]
        out.append((key, start, len(ids), zlib.crc32(np.array(ids, dtype="<u4").tobytes())))
        start += len(ids)
    return out


def found(frame):
    rows = frame.select("doc_id", "start", "n_tokens", "ids_crc32").collect()
    return sorted(map(tuple, rows), key=lambda row: row[1])


def test_query(spark, sf_dir, docs):
    assert found(QUERIES["op12_token_ids"](spark, sf_dir)) == brute(sorted(docs))


@pytest.mark.parametrize("block_ids", [1, 7, 64, 1 << 16])
def test_documents_over_blocks(spark, tmp_path, docs, block_ids):
    rows = [(key, text[:300]) for key, text in sorted(docs)[:40]]
    rows += [(10**6, ""), (10**6 + 1, None), (10**6 + 2, "word " * 500)]
    path = str(tmp_path / "ids")
    shuffled = random.Random(2).sample(rows, len(rows))
    frame = spark.createDataFrame(shuffled, "doc_id long, text string")
    token_files.write_ids(frame, VOCABULARY, path, block_ids=block_ids)
    assert found(token_files.read_documents(spark, path)) == brute(rows)
    stream = token_files.read_ids(spark, path).orderBy("start").collect()
    tokenizer = Tokenizer.from_file(VOCABULARY)
    want = [i for _, text in rows for i in [*tokenizer.encode(text or "").ids, 2]]
    assert [i for block in stream for i in block.ids] == want
    assert all(len(block.ids) <= block_ids for block in stream)


def test_edges(spark, tmp_path, edge_frame, empty_frame):
    path = str(tmp_path / "edges")
    token_files.write_ids(edge_frame, VOCABULARY, path)
    got = found(token_files.read_documents(spark, path))
    rows = [(r.doc_id, r.text) for r in edge_frame.collect()]
    rows.sort(key=lambda row: (row[0] is not None, row[0] or 0))
    assert got == brute(rows)
    token_files.write_ids(empty_frame, VOCABULARY, str(tmp_path / "none"))
    assert token_files.read_documents(spark, str(tmp_path / "none")).collect() == []
    assert token_files.read_ids(spark, str(tmp_path / "none")).collect() == []


PARTS = [
    "naïve", "don't", "éte", "\u0301mark", "ΣΑΣ", "<|endoftext|>", "12", "?!", "x" * 30, "STRASSE",
    "Straße", "it's", "we'LL", "'sß", "½", "µ", "\x1c", "\x85", "İ", "😀", "$5.00", "ÀÖØÞ", "i'd've",
]


def mixed(seed, parts, n=4000):
    rng = random.Random(seed)
    return "".join(rng.choice(parts) + rng.choice([" ", "\n", "  ", "\t", ""]) for _ in range(n))


def test_pieces_are_those_of_the_tokenizer():
    encoder, tokenizer = token_files.Encoder(VOCABULARY, 50), Tokenizer.from_file(VOCABULARY)
    assert encoder.known
    plain = [p for p in PARTS if token_files.PLAIN.fullmatch(p) and "<|" not in p]
    assert len(plain) > 10
    texts = [chr(i) + "a" + chr(i) * 2 + "'s b" + chr(i) for i in range(0x250)]
    texts += ["", " ", *PARTS, *(mixed(i, plain, 50) for i in range(60)), mixed(1, PARTS)]
    for at in range(0, len(texts), 37):
        part = texts[at : at + 37]
        want = [tokenizer.encode(t, add_special_tokens=False).ids for t in part]
        assert [ids.tolist() for ids in encoder.encode(part)] == want
    cut = [t for t in texts if token_files.PLAIN.fullmatch(t) and "<|" not in t]
    assert len(cut) > 200


def test_a_word_is_cut_once_a_batch():
    encoder, tokenizer = token_files.Encoder(VOCABULARY), Tokenizer.from_file(VOCABULARY)
    looked_up = []

    class Counted(type(encoder.codes)):
        def __getitem__(self, piece):
            looked_up.append(piece)
            return super().__getitem__(piece)

    encoder.codes = Counted()
    rng = random.Random(4)
    words = [f"{a}'{b}é!" for a in ("some", "Words") for b in ("s", "t", "x", "çq")]
    texts = ["", " ", *(" ".join(rng.choices(words, k=300)) for _ in range(9)), "\n"]
    want = [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    assert [ids.tolist() for ids in encoder.encode(texts)] == want
    assert len(looked_up) < 10 * len(words)


def test_pieces_met_again_stay():
    encoder, tokenizer = token_files.Encoder(VOCABULARY, 100), Tokenizer.from_file(VOCABULARY)
    learned, learn = [], encoder._learn

    def listed(new):
        learned.extend(new)
        learn(new)

    encoder._learn = listed
    rng = random.Random(5)
    common = ["often", "again", "é", "?!", "\x1c\x7f"]
    for _ in range(12):
        rare = ["".join(rng.choices("abcdefgh", k=9)) for _ in range(40)]
        texts = ["", " ".join(rng.sample(common + rare, k=45))]
        want = [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
        assert [ids.tolist() for ids in encoder.encode(texts)] == want
        assert len(encoder.codes) <= 100 + 46
    assert [learned.count(piece) for piece in common] == [1] * 5
    # where those met again would fill the table, none stays
    many = [" ".join("".join(rng.choices("abcdefgh", k=9)) for _ in range(200))] * 2
    for text in [*many, "", "one two", *many]:
        want = tokenizer.encode(text, add_special_tokens=False).ids
        assert encoder.encode([text])[0].tolist() == want


@settings(max_examples=60, deadline=None)
@given(st.lists(st.one_of(st.just(0), st.integers(0, 3), st.integers(0, 2**60 - 1)), max_size=300))
def test_a_selector_packs_the_most_that_fit(values):
    want = [
        next(
            selector
            for selector, (n, width) in enumerate(
                zip(simple8b.COUNTS, simple8b.WIDTHS, strict=True)
            )
            if max(values[at : at + n]) < 1 << width
        )
        for at in range(len(values))
    ]
    assert simple8b._selectors(np.array(values, dtype=np.uint64)).tolist() == want


def test_a_tokenizer_with_other_rules_is_asked():
    path = public_tokenizers.path("byte_bpe_50k.json")
    encoder, tokenizer = token_files.Encoder(path), Tokenizer.from_file(path)
    assert not encoder.known
    texts = ["Some words, it's 12 o'clock.", "", "ünï"]
    want = [tokenizer.encode(t, add_special_tokens=False).ids for t in texts]
    assert [ids.tolist() for ids in encoder.encode(texts)] == want


def test_long_texts_are_cut_at_spaces():
    text = mixed(3, PARTS)
    cut = list(token_files.parts_of(text, 50))
    assert "".join(cut) == text and len(cut) > 100
    tokenizer = Tokenizer.from_file(VOCABULARY)
    assert [i for part in cut for i in tokenizer.encode(part).ids] == tokenizer.encode(text).ids
    long = text * 12
    assert len(long) > token_files.PART_CHARS
    encoder = token_files.Encoder(VOCABULARY)
    got = list(token_files.encoded(["a", long, "b", "", "w" * 300_000, long], encoder, 2))
    ids = [*tokenizer.encode(long).ids, 2]
    assert [len(x) for x in got[:4]] == [2, len(ids), 2, 1]
    assert got[1].tolist() == ids == got[5].tolist()
    assert got[4].tolist() == [*tokenizer.encode("w" * 300_000).ids, 2]
