"""Token ids of all documents, in the order of their keys, in files of Simple-8b blocks.

Documents are range-partitioned and sorted by key, and each task encodes its range and writes it:
a part. A part is one stream of ids, each document followed by the end id, cut into blocks of
``BLOCK_IDS`` ids wherever the cut falls, so neither a long document nor a large part is held
whole. A block carries its payload (see ``simple8b``), its place in the part, the keys and places
of the documents that start in it, and the start of the one that runs into it. The files are
Parquet; the index columns are read without the payload.

Reading is one task per file split: documents inside a block are done there, the CRC-32 sums of
the others are put together from their parts. Global places come from the lengths of the parts,
one number for each partition of the sort.

Null and empty texts are the end id alone. Rows with a null key come first; rows with equal keys
follow in the order in which they are read, and being sorted by that too, a key that many rows
share is spread over parts. An empty table writes no block and reads as an empty one. Columns but
key and text are not carried. Very long texts that the tokenizer itself must cut are given to it in
parts cut at a space, which no token of a tokenizer that drops white space spans; a stretch without
any space is one part.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterable, Iterator
from functools import lru_cache
from itertools import count

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lakeweir.llm import simple8b
from lakeweir.llm.text import slices, text_of
from lakeweir.sources.scratch import written

END_ID = 2
BLOCK_IDS = 1 << 16
PART_CHARS = 1 << 17
BATCH_CHARS = 1 << 21
BATCH_ROWS = 1024
MOST_PIECES = 300_000  # that a worker remembers
BLOCKS = (
    "part int, block int, first long, n_ids int, payload binary, doc_ids array<long>, "
    "doc_starts array<int>, carried long, continues boolean"
)
SEGMENTS = "part int, doc_start long, doc_id long, place long, n long, crc long, whole boolean"
# Fixed value: the polynomial of CRC-32, lowest power in the highest bit.
CRC_POLYNOMIAL = 0xEDB88320
# The cutting rules of tokenizers that lower-case, drop white space and mark the
# end of a word, and what they say of ASCII and of the letters of Latin-1.
END_OF_WORD = "</w>"
RULES = {
    "normalizer": {
        "type": "Sequence",
        "normalizers": [
            {"type": "NFC"},
            {"type": "Replace", "pattern": {"Regex": "\\s+"}, "content": " "},
            {"type": "Lowercase"},
        ],
    },
    "pre_tokenizer": {
        "type": "Sequence",
        "pretokenizers": [
            {
                "type": "Split",
                "pattern": {
                    "Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"
                },
                "behavior": "Removed",
                "invert": True,
            },
            {
                "type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True,
                "use_regex": False,
            },
        ],
    },
    "suffix": END_OF_WORD,
    "prefix": None,
}
PLAIN = re.compile(r"[\x00-\x7fÀ-ÖØ-öø-ÿ]*")
LETTER = "a-zß-öø-ÿ"
# Words are lists of pieces, each word closed by a line end.
CLOSE = "\n"
PIECES = re.compile(
    rf"'(?:s|t|re|ve|m|ll|d)|[{LETTER}]+|[0-9]|[^ \t\n\x0b\x0c\r{LETTER}0-9]+|{CLOSE}"
)
# Byte-level vocabularies write these bytes as themselves, the others as what
# follows them, and so the characters of plain texts.
VISIBLE = [*range(33, 127), *range(161, 173), *range(174, 256)]
_OTHERS = [byte for byte in range(256) if byte not in VISIBLE]
_BYTES = {byte: byte for byte in VISIBLE} | {byte: 256 + n for n, byte in enumerate(_OTHERS)}
WRITTEN = {chr(c): "".join(chr(_BYTES[b]) for b in chr(c).encode()) for c in range(256)}
CHANGED = re.compile("[^ !-~]")  # a space stands between pieces
_AT = "__at"


# -- encoding --------------------------------------------------------------------------


class Encoder:
    """Ids of texts, by a table of the pieces seen so far.

    The tokenizer cuts a text into pieces and merges inside each alone, so a piece has the same
    ids wherever it stands. Where its rules are those of ``PIECES``, and a text holds only
    characters of which these are known to say the same, pieces are cut here, and the tokenizer's
    model is asked once for each new one. No piece spans white space, so each different word of a
    batch is cut once. Any other text goes to the tokenizer as it is.
    """

    def __init__(self, path: str, most_pieces: int = MOST_PIECES):
        import json
        import os

        import numpy as np

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import WhitespaceSplit

        self.tokenizer = Tokenizer.from_file(path)
        self.most_pieces = most_pieces
        with open(path, encoding="utf-8") as file:
            rules = json.load(file)
        self.known = _rules_of(rules) == RULES
        special = [token["content"] for token in rules.get("added_tokens") or ()]
        self.special = re.compile("|".join(map(re.escape, special)) or r"(?!)")
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=False)
        self.closes = np.zeros(max(vocabulary.values(), default=0) + 1, dtype=bool)
        for token, number in vocabulary.items():
            self.closes[number] = token.endswith(END_OF_WORD)
        # for pieces, which are cut and lower-cased already, as the vocabulary writes their bytes
        self.merger = Tokenizer.from_file(path)
        self.merger.normalizer = None
        self.merger.pre_tokenizer = WhitespaceSplit()
        self.codes = _Codes()
        self.ids, self.begin, self.size = array("I"), array("q", [0]), array("q", [0])
        self.met = bytearray(1)  # whether a batch after the one that brought it had the piece

    def _forget(self) -> None:
        """Drop the pieces not met again, or all where the others would fill half the table."""
        import numpy as np

        kept = np.flatnonzero(np.frombuffer(self.met, dtype=np.uint8)[1:]) + 1
        if 2 * len(kept) > self.most_pieces:
            kept = kept[:0]
        kept = np.concatenate([[0], kept])  # what closes a word stays
        size = np.frombuffer(self.size, dtype=np.int64)[kept]
        begin = np.frombuffer(self.begin, dtype=np.int64)[kept]
        ids, ends = _runs(np.frombuffer(self.ids, dtype=np.uint32), begin, size)
        pieces = list(self.codes)
        self.codes = _Codes(pieces[code] for code in kept.tolist())
        self.ids, self.begin = array("I", ids.tobytes()), array("q", (ends - size).tobytes())
        self.size, self.met = array("q", size.tobytes()), bytearray(len(kept))

    def _merged(self, texts: list[str]) -> list:
        import numpy as np

        rows = self.merger.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(row.ids, dtype=np.uint32) for row in rows]

    def _learn(self, new: list[str]) -> None:
        """Put the ids of new pieces into the table, in the order of their codes."""
        import numpy as np

        for at in range(0, len(new), 256):
            part = new[at : at + 256]
            joined = CHANGED.sub(lambda found: WRITTEN[found[0]], " ".join(part))
            ids = self._merged([joined])[0]
            ends = np.flatnonzero(self.closes[ids]) + 1
            if len(ends) != len(part):
                rows = self._merged(joined.split(" "))
                ids = np.concatenate(rows)
                ends = np.cumsum([len(row) for row in rows])
            begins = np.concatenate([[0], ends[:-1]])
            self.begin.frombytes((begins + len(self.ids)).astype(np.int64).tobytes())
            self.size.frombytes((ends - begins).astype(np.int64).tobytes())
            self.ids.frombytes(ids.tobytes())
        self.met.extend(bytes(len(new)))
        new.clear()

    def _cut(self, texts: list[str]) -> list:
        import numpy as np
        import pyarrow as pa
        import pyarrow.compute as pc

        lists = pc.ascii_split_whitespace(pa.array(map(str.lower, texts), pa.large_string()))
        words = lists.flatten().dictionary_encode()
        different = words.dictionary.to_numpy(zero_copy_only=False).tolist()
        found = PIECES.findall(CLOSE.join([*different, ""]))
        coded = map(self.codes.__getitem__, found)
        codes = np.fromiter(coded, dtype=np.int64, count=len(found))
        np.frombuffer(self.met, dtype=np.uint8)[codes[codes < len(self.met)]] = 1
        self._learn(self.codes.new)
        ids, ends = _runs(
            np.frombuffer(self.ids, dtype=np.uint32),
            np.frombuffer(self.begin, dtype=np.int64)[codes],
            np.frombuffer(self.size, dtype=np.int64)[codes],
        )
        closed = np.concatenate([[0], ends[codes == 0]])
        at = words.indices.to_numpy()
        ids, ends = _runs(ids, closed[at], np.diff(closed)[at])
        cuts = np.concatenate([[0], ends])[lists.offsets.to_numpy()].tolist()
        return [ids[b:e] for b, e in zip(cuts[:-1], cuts[1:], strict=True)]

    def encode(self, texts: list[str]) -> list:
        """The ids of each text as an array."""
        if len(self.codes) > self.most_pieces:
            self._forget()
        simple = [
            self.known and PLAIN.fullmatch(text) is not None and not self.special.search(text)
            for text in texts
        ]
        cut = iter(self._cut([t for t, own in zip(texts, simple, strict=True) if own]))
        return [
            next(cut) if own else self._whole(text)
            for text, own in zip(texts, simple, strict=True)
        ]

    def _whole(self, text: str):
        """Part by part, so that memory does not follow the text."""
        import numpy as np

        rows = (
            self.tokenizer.encode_batch_fast([part], add_special_tokens=False)[0].ids
            for part in parts_of(text)
        )
        return np.concatenate([np.array(ids, dtype=np.uint32) for ids in rows])


def _runs(values, begins, sizes):
    """Runs of ``values`` one after the other, and where each of them ends."""
    import numpy as np

    ends = np.cumsum(sizes)
    total = int(ends[-1]) if len(ends) else 0
    return values[np.repeat(begins - (ends - sizes), sizes) + np.arange(total)], ends


class _Codes(dict):
    """Numbers pieces as they come, after the one that closes a word, and lists the new ones."""

    def __init__(self, pieces: Iterable[str] = (CLOSE,)):
        super().__init__(zip(pieces, count()))
        self.new: list[str] = []

    def __missing__(self, piece: str) -> int:
        self.new.append(piece)
        self[piece] = code = len(self)
        return code


def _rules_of(tokenizer: dict) -> dict:
    """What decides how a tokenizer cuts a text into pieces."""
    model = tokenizer.get("model") or {}
    return {
        "normalizer": tokenizer.get("normalizer"),
        "pre_tokenizer": tokenizer.get("pre_tokenizer"),
        "suffix": model.get("end_of_word_suffix"),
        "prefix": model.get("continuing_subword_prefix"),
    }


@lru_cache(maxsize=2)
def _encoder(path: str) -> Encoder:
    return Encoder(path)


def parts_of(text: str, size: int = PART_CHARS) -> Iterator[str]:
    """``text`` cut at spaces or line ends into parts of at least ``size`` characters."""
    gap = re.compile(r"[ \n]")
    start = 0
    while len(text) - start > size and (found := gap.search(text, start + size)):
        yield text[start : found.start()]
        start = found.start()
    yield text[start:]


def encoded(texts: list[str], encoder: Encoder, end_id: int) -> Iterator:
    """The ids of each text with the end id, as an array."""
    import numpy as np

    end = np.array([end_id], dtype=np.uint32)
    at = 0
    while at < len(texts):
        first, chars = at, 0
        while at < len(texts) and chars < BATCH_CHARS:
            chars += len(texts[at])
            at += 1
        for ids in encoder.encode(texts[first:at]):
            yield np.concatenate([ids, end])


def _blocks_of(tokenizer_path: str, end_id: int, block_ids: int):
    def write(batches):
        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext

        encoder = _encoder(tokenizer_path)
        part = TaskContext.get().partitionId()
        held: list = []  # ids of the open block
        n_held = number = first = 0
        keys: list = []
        starts: list[int] = []
        carried = None
        types = (
            pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.binary(), pa.list_(pa.int64()),
            pa.list_(pa.int32()), pa.int64(), pa.bool_(),
        )
        names = [field.split(" ")[0] for field in BLOCKS.split(", ")]

        def block(continues: bool):
            ids = np.concatenate(held)
            row = (
                part, number, first, len(ids), simple8b.encode(ids), keys, starts, carried,
                continues,
            )
            columns = [pa.array([v], t) for v, t in zip(row, types, strict=True)]
            return pa.RecordBatch.from_arrays(columns, names=names)

        for batch in batches:
            for rows in slices(batch, 1, BATCH_ROWS, BATCH_CHARS):
                texts = rows.column(1).to_pylist()
                for key, ids in zip(
                    rows.column(0).to_pylist(), encoded(texts, encoder, end_id), strict=True
                ):
                    keys.append(key)
                    starts.append(n_held)
                    own = first + n_held
                    while n_held + len(ids) >= block_ids:
                        taken = block_ids - n_held
                        held.append(ids[:taken])
                        ids = ids[taken:]
                        yield block(len(ids) > 0)
                        number, first = number + 1, first + block_ids
                        held, n_held, keys, starts = [], 0, [], []
                        carried = own if len(ids) else None
                    if len(ids):
                        held.append(ids)
                        n_held += len(ids)
        if n_held:
            yield block(False)

    return write


def write_ids(
    documents: DataFrame,
    tokenizer_path: str,
    path: str,
    key: str = "doc_id",
    text: str = "text",
    end_id: int = END_ID,
    block_ids: int = BLOCK_IDS,
) -> None:
    """Encode ``documents`` in ascending order of ``key`` and write the blocks below ``path``."""
    rows = documents.select(
        F.col(key).cast("long").alias("doc_id"),
        text_of(text).alias("text"),
        F.monotonically_increasing_id().alias(_AT),
    )
    placed = rows.repartitionByRange("doc_id", _AT).sortWithinPartitions("doc_id", _AT)
    blocks = placed.select("doc_id", "text").mapInArrow(
        _blocks_of(tokenizer_path, end_id, block_ids), BLOCKS
    )
    blocks.write.parquet(path)


# -- reading ---------------------------------------------------------------------------


def _times(a: int, b: int) -> int:
    """Product of two polynomials modulo that of CRC-32, lowest power in the highest bit."""
    product = 0
    for power in range(31, -1, -1):
        if a >> power & 1:
            product ^= b
        b = b >> 1 ^ (CRC_POLYNOMIAL if b & 1 else 0)
    return product


def joined_crc(head: int, tail: int, tail_bytes: int) -> int:
    """CRC-32 of two byte strings in a row, from the sums of both."""
    factor, square = 1 << 31, 1 << 23  # one, and the shift by one byte: x to the power 8
    while tail_bytes:
        if tail_bytes & 1:
            factor = _times(factor, square)
        square = _times(square, square)
        tail_bytes >>= 1
    return _times(factor, head) ^ tail


def _segments(batches):
    """What each block holds of each document."""
    import zlib

    import numpy as np
    import pyarrow as pa

    for batch in batches:
        out: list[list] = [[] for _ in range(7)]
        for row in batch.to_pylist():
            ids = simple8b.decode(row["payload"]).astype("<u4")
            first, end = row["first"], len(ids)
            found = [(row["carried"], None, 0)] if row["carried"] is not None else []
            found += [
                (first + at, key, at)
                for key, at in zip(row["doc_ids"], row["doc_starts"], strict=True)
            ]
            stops = [at for _, _, at in found[1:]] + [end]
            for number, ((start, key, at), stop) in enumerate(zip(found, stops, strict=True)):
                crc = zlib.crc32(np.ascontiguousarray(ids[at:stop]))
                last = number == len(found) - 1
                whole = start == first + at and not (last and row["continues"])
                values = (row["part"], start, key, first + at, stop - at, crc, whole)
                for column, value in zip(out, values, strict=True):
                    column.append(value)
        types = (
            pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.bool_()
        )
        yield pa.RecordBatch.from_arrays(
            [pa.array(*column) for column in zip(out, types, strict=True)],
            names=[field.split(" ")[0] for field in SEGMENTS.split(", ")],
        )


def _joined(segments):
    """CRC-32 over segments (place, n, crc) in order."""

    @F.arrow_udf("long")
    def join(rows):
        import pyarrow as pa

        sums = []
        for row in rows.to_pylist():
            crc = 0
            for segment in row:
                crc = joined_crc(crc, segment["crc"], 4 * segment["n"])
            sums.append(crc)
        return pa.array(sums, pa.int64())

    return join(segments)


def part_starts(blocks: DataFrame) -> DataFrame:
    """``part`` and ``before``, the ids of all earlier parts: a row per partition of the sort."""
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = blocks.groupBy("part").agg(F.sum("n_ids").alias("n"))
    return sizes.select("part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """Per document: ``doc_id``, ``start`` (ids of all documents before it), ``n_tokens`` and
    ``ids_crc32`` over its ids as little-endian unsigned 32-bit numbers."""
    blocks = spark.read.schema(BLOCKS).parquet(path)
    # written, so that both branches below decode the files once
    segments = written(blocks.mapInArrow(_segments, SEGMENTS), "segments")
    whole = segments.where("whole").select("part", "doc_start", "doc_id", "n", "crc")
    # a document has a segment for each block that it touches
    cut = (
        segments.where("NOT whole")
        .groupBy("part", "doc_start")
        .agg(
            F.max("doc_id").alias("doc_id"),
            F.sum("n").alias("n"),
            F.sort_array(F.collect_list(F.struct("place", "n", "crc"))).alias("segments"),
        )
        .select("part", "doc_start", "doc_id", "n", _joined(F.col("segments")).alias("crc"))
    )
    # as many rows as the sort had partitions
    starts = F.broadcast(part_starts(blocks))
    return whole.unionByName(cut).join(starts, "part").select(
        "doc_id",
        (F.col("before") + F.col("doc_start")).alias("start"),
        F.col("n").alias("n_tokens"),
        F.col("crc").alias("ids_crc32"),
    )


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """The stream of ids: ``start``, the global place of a block, and its ``ids``."""

    def ids_of(batches):
        import pyarrow as pa

        for batch in batches:
            for row in batch.to_pylist():
                ids = simple8b.decode(row["payload"]).astype("int64")
                yield pa.RecordBatch.from_arrays(
                    [pa.array([row["start"]], pa.int64()), pa.array([ids], pa.list_(pa.int64()))],
                    names=["start", "ids"],
                )

    blocks = spark.read.schema(BLOCKS).parquet(path)
    placed = blocks.join(F.broadcast(part_starts(blocks)), "part").select(
        (F.col("before") + F.col("first")).alias("start"), "payload"
    )
    return placed.mapInArrow(ids_of, "start long, ids array<long>")
