"""Best-fit packing of token pieces into sequences, improved by swap-based local search.

A document becomes its token ids and one end id. Longer documents than a sequence are cut
into whole sequences, the first piece taking the remainder; whole pieces fill a sequence
alone. The rest is dealt into groups of bounded size by a hash, and each group is packed in
one task: best fit in descending length, then moves, one-for-one and two-for-one swaps out of
the emptiest sequences, each of which raises the sum of squared fills, until no more
sequences empty. Sequences left loose are opened again and packed once more across groups.

A null or empty text is one end id. Repeated rows are pieces of their own. An empty table
gives an empty one. Columns beyond the key are not carried.

Ids come from the fast encoder of the same vocabulary; it gives up on very long runs of white
space, so a text with one, and any other that it gives up on, goes to the tokenizer itself.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import lru_cache

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeweir.llm.text import text_of
from lakeweir.sources.scratch import written

CAPACITY = 2048
END_ID = 0
GROUP_PIECES = 4096
LOOSE_SHARE = 64  # a sequence is loose if over 1/64 of it is free
LAST_LEVEL = 31  # of packing loose sequences again; its number takes five bits of an id
LONG_GAP = 4096  # characters of white space in a row
PIECES = "doc_id long, piece int, start long, length long, ids binary"
SPECIAL = {"<|endoftext|>": 50256}


@lru_cache(maxsize=2)
def _encoding(ranks_path: str, pattern: str):
    import base64

    import tiktoken

    with open(ranks_path, "rb") as file:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, file)}
    return tiktoken.Encoding(
        "corpus", pat_str=pattern, mergeable_ranks=ranks, special_tokens=SPECIAL
    )


@lru_cache(maxsize=2)
def _tokenizer(path: str):
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def ids_of(text: str, ranks_path: str, pattern: str, tokenizer_path: str) -> list[int]:
    """The ids of ``text`` as the tokenizer gives them."""
    import re

    encoding = _encoding(ranks_path, pattern)
    if not re.search(rf"\s{{{LONG_GAP}}}", text):
        try:
            if any(special in text for special in SPECIAL):
                return encoding.encode(text, allowed_special="all")
            return encoding.encode_ordinary(text)
        except BaseException as error:  # a panic of the encoder is no Exception
            if type(error).__name__ != "PanicException":
                raise
    return _tokenizer(tokenizer_path).encode(text, add_special_tokens=False).ids


def pieces_of(length: int, capacity: int) -> Iterator[tuple[int, int]]:
    """Start and length of each piece of a document of ``length`` tokens."""
    first = length % capacity or min(length, capacity)
    yield 0, first
    for start in range(first, length, capacity):
        yield start, capacity


def tokenized_pieces(
    documents: DataFrame,
    ranks_path: str,
    pattern: str,
    tokenizer_path: str,
    capacity: int = CAPACITY,
    text: str = "text",
    key: str = "doc_id",
) -> DataFrame:
    """The pieces of all documents; ``ids`` are little-endian unsigned 32-bit ids. The ranks and
    the tokenizer hold one vocabulary."""

    def cut(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                rows = batch.slice(at, 256)
                out: list[list] = [[], [], [], [], []]
                texts = rows.column(1).to_pylist()
                for doc_id, string in zip(rows.column(0).to_pylist(), texts, strict=True):
                    ids = ids_of(string, ranks_path, pattern, tokenizer_path)
                    packed = np.array([*ids, END_ID], dtype="<u4").tobytes()
                    for piece, (start, size) in enumerate(pieces_of(len(packed) // 4, capacity)):
                        span = packed[4 * start : 4 * (start + size)]
                        for column, value in zip(
                            out, (doc_id, piece, start, size, span), strict=True
                        ):
                            column.append(value)
                types = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(*column) for column in zip(out, types, strict=True)],
                    names=["doc_id", "piece", "start", "length", "ids"],
                )

    source = documents.select(F.col(key).cast("long").alias("doc_id"), text_of(text).alias("text"))
    return source.mapInArrow(cut, PIECES)


def best_fit(lengths: Sequence[int], capacity: int) -> list[list[int]]:
    """Bins of item indexes: longest first, each into the fullest bin that still takes it."""
    bins: list[list[int]] = []
    by_gap: list[list[int]] = [[] for _ in range(capacity + 1)]
    present = 0  # bit g is set while a bin with a gap of g exists
    for item in sorted(range(len(lengths)), key=lambda i: (-lengths[i], i)):
        size = lengths[item]
        fitting = present >> size
        if fitting:
            gap = size + (fitting & -fitting).bit_length() - 1
            chosen = by_gap[gap].pop()
            if not by_gap[gap]:
                present &= ~(1 << gap)
            bins[chosen].append(item)
        else:
            gap, chosen = capacity, len(bins)
            bins.append([item])
        gap -= size
        if gap:
            by_gap[gap].append(chosen)
            present |= 1 << gap
    return bins


class LocalSearch:
    """Improve bins by moves and swaps out of the emptiest one.

    Each step shifts tokens from the donor to a bin at least as full, so the sum of squared
    fills grows and the search ends.
    """

    def __init__(self, lengths: Sequence[int], bins: list[list[int]], capacity: int):
        import numpy as np

        self.np = np
        self.length = np.asarray(lengths, dtype=np.int64)
        self.place = np.zeros(len(lengths), dtype=np.int64)
        self.bins = [set(items) for items in bins]
        self.fill = np.zeros(len(bins), dtype=np.int64)
        for number, items in enumerate(bins):
            for item in items:
                self.place[item] = number
                self.fill[number] += self.length[item]
        self.capacity = capacity

    def _put(self, item: int, target: int) -> None:
        source = self.place[item]
        self.bins[source].discard(item)
        self.bins[target].add(item)
        self.place[item] = target
        self.fill[source] -= self.length[item]
        self.fill[target] += self.length[item]

    def _move(self, donor: int) -> bool:
        np = self.np
        for item in sorted(self.bins[donor], key=lambda i: -self.length[i]):
            left = self.capacity - self.fill - self.length[item]
            fits = (left >= 0) & (self.fill >= self.fill[donor])
            fits[donor] = False
            if fits.any():
                self._put(item, int(np.argmin(np.where(fits, left, self.capacity + 1))))
                return True
        return False

    def _swap(self, donor: int, given: tuple[int, ...]) -> bool:
        """Give items of the donor for one shorter item of a bin with room for the rest."""
        np = self.np
        gain = int(sum(self.length[i] for i in given)) - self.length
        fill = self.fill[self.place]
        fits = (gain > 0) & (gain <= self.capacity - fill) & (fill >= self.fill[donor])
        fits &= self.place != donor
        if not fits.any():
            return False
        taken = int(np.argmax(np.where(fits, gain, 0)))
        target = int(self.place[taken])
        self._put(taken, donor)
        for item in given:
            self._put(item, target)
        return True

    def _improve(self, donor: int) -> bool:
        if self._move(donor):
            return True
        items = sorted(self.bins[donor], key=lambda i: -self.length[i])
        if any(self._swap(donor, (item,)) for item in items):
            return True
        # pairs of one sum fit alike
        pairs = {
            int(self.length[first] + self.length[second]): (first, second)
            for at, first in enumerate(items)
            for second in items[at + 1 :]
        }
        return any(self._swap(donor, pairs[total]) for total in sorted(pairs, reverse=True))

    def run(self) -> list[list[int]]:
        np = self.np
        stuck: set[int] = set()
        while True:
            open_ = [n for n in np.argsort(self.fill, kind="stable") if self.bins[n]]
            donor = next((int(n) for n in open_ if int(n) not in stuck), None)
            if donor is None:
                break
            room = int((self.capacity - self.fill[open_]).sum()) - (
                self.capacity - int(self.fill[donor])
            )
            if room < self.fill[donor]:
                break  # what is free elsewhere cannot take the emptiest bin
            while self.bins[donor] and self._improve(donor):
                pass
            if self.bins[donor]:
                stuck.add(donor)
        return [sorted(items) for items in self.bins if items]


def pack_lengths(lengths: Sequence[int], capacity: int) -> list[list[int]]:
    return LocalSearch(lengths, best_fit(lengths, capacity), capacity).run()


def _pack_group(capacity: int, level: int):
    def pack(key, table):
        import numpy as np
        import pyarrow as pa

        group = key[0].as_py()
        order = np.argsort(table.column("__row").to_numpy(), kind="stable")
        table = table.take(pa.array(order))
        lengths = table.column("length").to_pylist()
        sequence = np.zeros(len(lengths), dtype=np.int64)
        offset = np.zeros(len(lengths), dtype=np.int64)
        loose = np.zeros(len(lengths), dtype=bool)
        for number, items in enumerate(pack_lengths(lengths, capacity)):
            at = 0
            for item in items:
                sequence[item] = (level << 58) + (group << 20) + number
                offset[item] = at
                at += lengths[item]
            loose[items] = capacity - at > capacity // LOOSE_SHARE
        out = table.drop_columns(["__group"])
        for name, values in (("sequence_id", sequence), ("offset", offset), ("__loose", loose)):
            out = out.append_column(name, pa.array(values))
        return out

    return pack


def _pack_level(pieces: DataFrame, count: int, capacity: int, level: int) -> DataFrame:
    groups = max(1, -(-count // GROUP_PIECES))
    grouped = pieces.withColumn(
        "__group", F.pmod(F.xxhash64(F.lit(level), F.col("__row")), F.lit(groups))
    )
    schema = T.StructType(list(pieces.schema)).add("sequence_id", "long").add("offset", "long")
    packed = grouped.groupBy("__group").applyInArrow(
        _pack_group(capacity, level), schema.add("__loose", "boolean")
    )
    return written(packed, f"packed-{level}")


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` (any columns, ``length`` among them) with ``sequence_id`` and ``offset``."""
    # row numbers of a written table stay the same however often it is read
    stored = written(pieces, "pieces").withColumn("__row", F.monotonically_increasing_id())
    done = stored.where(F.col("length") >= capacity).select(
        "*", (-1 - F.col("__row")).alias("sequence_id"), F.lit(0).cast("long").alias("offset")
    )
    rest = stored.where(F.col("length") < capacity)
    count, level = rest.count(), 0
    while True:
        packed = _pack_level(rest, count, capacity, level)
        loose = packed.where("__loose")
        left = loose.count()
        if count <= GROUP_PIECES or left >= count or level == LAST_LEVEL:
            return done.unionByName(packed.drop("__loose")).drop("__row")
        done = done.unionByName(packed.where("NOT __loose").drop("__loose"))
        rest = loose.drop("sequence_id", "offset", "__loose")
        count, level = left, level + 1
