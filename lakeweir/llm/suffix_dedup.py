"""Long repeated byte strings, found with run-length compressed Burrows-Wheeler indexes.

Every byte inside a string of ``MATCH`` bytes that also starts in a document with a smaller
key is marked. All windows of that length are dealt to shards by their content: a window
belongs to the smallest hash among its ``ANCHOR``-byte substrings, so equal windows meet in
one shard wherever they come from. Consecutive windows with one anchor travel as one phrase.

1. Anchors seen in one document only cannot repeat. Each task lists its distinct anchors once,
   with one owner; shards find those listed twice and tell the owners.
2. Documents with shared anchors are read again, and the phrases around those go to shards.
   A task keeps the first document of equal phrases and settles the others at once, so a
   passage in a third of all documents costs a shard one phrase per task.
3. A shard stores equal phrases once, with their first document. Phrases that share an anchor
   but differ are indexed: sorted suffixes, their Burrows-Wheeler transform in runs, and
   samples at the run ends and at the first suffix of every repeated window. The phrases are
   streamed backwards through the runs; a window's match ends where only the window itself is
   left, and windows that stay repeated to their full length get their first document.
4. Marked windows return to their documents.

Text is compared as UTF-8 bytes, which hold no byte 255, so that one separates phrases. Null
and empty texts, and those shorter than a match, are left whole, as are rows without a key,
which have no order. Rows that share a key are no earlier than each other; what is found in one
carries a checksum of its bytes, so that it is cut out of the rows that hold them there. An empty
table gives an empty one.
"""

from __future__ import annotations

import zlib

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeweir.llm.text import slices, text_of

MATCH = 50
ANCHOR = 24
SHARD_BYTES = 4 << 20  # text a shard answers for
LIST_BYTES = 32 << 20  # the same for the lists of anchors, which are shorter
TEXTS_AT_ONCE, BYTES_AT_ONCE = 4000, 16 << 20
SEPARATOR = 255
HASH_BYTES = 4  # of an anchor hash that travel; the shard number holds further bits
# Odd multipliers of the anchor hash.
MIX = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)

ANCHOR_ROW = (
    "shard int, docs binary, counts binary, hashes binary,"
    " told_docs binary, told_counts binary, told_hashes binary"
)
PHRASE_ROW = (
    "shard int, docs binary, starts binary, hashes binary, sizes binary, bytes binary,"
    " done_docs binary, done_starts binary, done_windows binary, done_sums binary"
)
# ``run``: the first window above 32 bits, their number below; ``sum``: CRC-32 of the bytes
FOUND_ROW = "doc_id long, run long, sum int"


# -- windows and their anchors ---------------------------------------------------------


def phrases_of(data: bytes, match: int = MATCH, anchor: int = ANCHOR):
    """Maximal runs of windows with one anchor: arrays (hash, first window, windows)."""
    import numpy as np

    windows = len(data) - match + 1
    if windows <= 0:
        none = np.zeros(0, dtype=np.int64)
        return none.astype(np.uint64), none, none
    words = np.ndarray((len(data) - 7,), dtype="<u8", buffer=data, strides=(1,))
    n = len(data) - anchor + 1
    mix = [np.uint64(m) for m in MIX]
    hashes = words[:n] * mix[0]
    for at, factor in zip(range(8, anchor, 8), mix[1:], strict=False):
        at = min(at, anchor - 8)
        hashes += words[at : at + n] * factor
    hashes ^= hashes >> np.uint64(32)
    hashes *= mix[3]
    hashes ^= hashes >> np.uint64(29)
    # the least hash over all anchors of a window, by doubling
    span, width = 1, match - anchor + 1
    least = hashes
    while span * 2 <= width:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    if span < width:
        least = np.minimum(least[: span - width], least[width - span :])
    first = np.concatenate([[0], np.nonzero(least[1:] != least[:-1])[0] + 1])
    return least[first], first, np.diff(np.append(first, windows))


def _shards_of(hashes, shards: int):
    import numpy as np

    return ((hashes >> np.uint64(8 * HASH_BYTES)) % np.uint64(shards)).astype(np.int32)


def _dealt(shard):
    """(number, rows) of each shard that occurs."""
    import numpy as np

    order = np.argsort(shard, kind="stable")
    numbers, begins = np.unique(shard[order], return_index=True)
    return zip(numbers.tolist(), np.split(order, begins[1:]), strict=False)


def _packed(hashes) -> bytes:
    import numpy as np

    data = np.ascontiguousarray(hashes, dtype="<u8").view(np.uint8).reshape(-1, 8)
    return data[:, :HASH_BYTES].tobytes()


def _unpacked(data: bytes):
    import numpy as np

    short = np.frombuffer(data, dtype=np.uint8).reshape(-1, HASH_BYTES)
    whole = np.zeros((len(short), 8), dtype=np.uint8)
    whole[:, :HASH_BYTES] = short
    return whole.view("<u8").ravel()


def _by_document(docs, hashes):
    """(documents, counts, hashes) with the hashes of a document side by side."""
    import numpy as np

    order = np.argsort(docs, kind="stable")
    own, counts = np.unique(docs[order], return_counts=True)
    return own.tobytes(), counts.astype(np.int32).tobytes(), _packed(hashes[order])


def _spread(docs: bytes, counts: bytes):
    import numpy as np

    return np.repeat(np.frombuffer(docs, np.int64), np.frombuffer(counts, np.int32))


# -- step 1: anchors of more than one document -----------------------------------------


def _list_anchors(shards: int):
    def run(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            for rows in slices(batch, 1, TEXTS_AT_ONCE, BYTES_AT_ONCE):
                docs, hashes = [], []
                for doc, data in zip(
                    rows.column(0).to_pylist(), rows.column(1).to_pylist(), strict=True
                ):
                    own = np.unique(phrases_of(data)[0])
                    hashes.append(own)
                    docs.append(np.full(len(own), doc, dtype=np.int64))
                docs, hashes = np.concatenate(docs), np.concatenate(hashes)
                order = np.lexsort((docs, hashes))
                docs, hashes = docs[order], hashes[order]
                head = np.append(True, hashes[1:] != hashes[:-1])[: len(hashes)]
                first = docs[np.maximum.accumulate(np.where(head, np.arange(len(docs)), 0))]
                group = np.cumsum(head) - 1
                several = np.bincount(group[docs != first], minlength=head.sum()) > 0
                told = several[group] if len(group) else np.zeros(0, dtype=bool)
                columns: list[list] = [[] for _ in range(7)]
                shard = _shards_of(hashes, shards)
                for number, part in _dealt(shard):
                    listed, known = part[head[part]], part[told[part]]
                    values = (
                        number,
                        *_by_document(docs[listed], hashes[listed]),
                        *_by_document(docs[known], hashes[known]),
                    )
                    for column, value in zip(columns, values, strict=True):
                        column.append(value)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(columns[0], pa.int32())]
                    + [pa.array(column, pa.binary()) for column in columns[1:]],
                    names=[field.split()[0] for field in ANCHOR_ROW.split(", ")],
                )

    return run


def _find_shared(table):
    import numpy as np
    import pyarrow as pa

    rows = table.to_pylist()
    docs = np.concatenate([_spread(r["docs"], r["counts"]) for r in rows])
    hashes = np.concatenate([_unpacked(r["hashes"]) for r in rows])
    order = np.argsort(hashes, kind="stable")
    same = hashes[order][1:] == hashes[order][:-1]
    shared = order[np.append(same, False)[: len(order)] | np.append(False, same)[: len(order)]]
    told = [_spread(r["told_docs"], r["told_counts"]) for r in rows]
    docs = np.concatenate([docs[shared], *told])
    hashes = np.concatenate([hashes[shared], *(_unpacked(r["told_hashes"]) for r in rows)])
    return pa.table({"doc_id": docs, "hash": hashes.astype(np.uint32).view(np.int32)})


# -- step 2: phrases around shared anchors ---------------------------------------------


def _cut_phrases(shards: int):
    def run(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            for rows in slices(batch, 1, TEXTS_AT_ONCE, BYTES_AT_ONCE):
                rows = rows.sort_by("doc_id")
                columns_in = (rows.column(0).to_pylist(), rows.column(1).to_pylist())
                first: dict[bytes, int] = {}
                phrases: list[bytes] = []
                parts = []
                for doc, packed, known in zip(*columns_in, rows.column(2), strict=True):
                    data = zlib.decompress(packed)
                    hashes, starts, windows = phrases_of(data)
                    known = np.sort(known.values.to_numpy().view(np.uint32))
                    short = hashes.astype(np.uint32)
                    at_most = np.minimum(np.searchsorted(known, short), len(known) - 1)
                    shared = known[at_most] == short
                    hashes, starts, windows = hashes[shared], starts[shared], windows[shared]
                    ends = starts + windows + (MATCH - 1)
                    own = [data[b:e] for b, e in zip(starts.tolist(), ends.tolist(), strict=True)]
                    # only the first document of equal phrases sends them
                    new = np.array([first.setdefault(p, doc) == doc for p in own], dtype=bool)
                    phrases += own
                    docs = np.full(len(own), doc, dtype=np.int64)
                    parts.append((docs, starts, windows, hashes, new))
                docs, starts, windows, hashes, new = (
                    np.concatenate(column) for column in zip(*parts, strict=True)
                )
                shard = _shards_of(hashes, shards)
                columns: list[list] = [[] for _ in range(10)]
                for number, part in _dealt(shard):
                    sent, done = part[new[part]], part[~new[part]]
                    values = (
                        number,
                        docs[sent].tobytes(),
                        starts[sent].astype(np.int32).tobytes(),
                        hashes[sent].astype(np.uint32).tobytes(),
                        (windows[sent] + (MATCH - 1)).astype(np.int32).tobytes(),
                        zlib.compress(b"".join(phrases[i] for i in sent.tolist()), 1),
                        docs[done].tobytes(),
                        starts[done].astype(np.int32).tobytes(),
                        windows[done].astype(np.int32).tobytes(),
                        np.array(
                            [zlib.crc32(phrases[i]) for i in done.tolist()], dtype=np.uint32
                        ).tobytes(),
                    )
                    for column, value in zip(columns, values, strict=True):
                        column.append(value)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(columns[0], pa.int32())]
                    + [pa.array(column, pa.binary()) for column in columns[1:]],
                    names=[field.split()[0] for field in PHRASE_ROW.split(", ")],
                )

    return run


# -- step 3: the index of a shard ------------------------------------------------------


def suffix_order(text, depth: int = MATCH):
    """Rows of ``text`` (bytes as an array) by their first ``depth`` bytes, ties by place,
    and the rank of each place; equal ranks mean equal first ``depth`` bytes."""
    import numpy as np

    n = len(text)
    padded = np.concatenate([text, np.zeros(depth + 8, dtype=np.uint8)])

    def ranked(keys):
        order = np.argsort(keys)
        ordered = keys[order]
        rank = np.empty(n, dtype=np.int64)
        rank[order] = np.cumsum(np.append(False, ordered[1:] != ordered[:-1])[:n])
        return rank

    def at(rank, shift):
        """Ranks ``shift`` places on, -1 past the end."""
        return np.concatenate([rank[shift:], np.full(min(shift, n), -1, dtype=np.int64)])[:n]

    size = min(7, depth)
    keys = np.zeros(n, dtype=np.int64)
    for place in range(size):
        keys = keys * 256 + padded[place : place + n]
    rank = ranked(keys)
    while size < depth:
        step = min(size, depth - size)
        # two overlapping parts of ``size`` bytes make ``size + step``
        rank = ranked(rank * (n + 1) + at(rank, step) + 1)
        size += step
    return np.argsort(rank * n + np.arange(n)), rank


class RunIndex:
    """Burrows-Wheeler transform in runs, over suffixes sorted to ``depth`` bytes.

    Intervals of strings up to ``depth`` bytes are exact. ``samples`` holds the suffix at the
    first and last row of each run; ``heads`` the first row of each string of ``depth`` bytes
    that repeats, with its place, the earliest one in the text.
    """

    def __init__(self, text, depth: int = MATCH):
        import numpy as np

        order, rank = suffix_order(text, depth)
        self.n, self.depth = len(text), depth
        last = text[order - 1]  # the text is taken as a circle; it ends with a separator
        start = np.concatenate([[0], np.nonzero(last[1:] != last[:-1])[0] + 1])
        length = np.diff(np.append(start, self.n))
        char = last[start].astype(np.int64)
        self.runs = len(start)
        self.samples = np.stack([order[start], order[start + length - 1]])
        by_char = np.argsort(char, kind="stable")
        self.keys = char[by_char] * (self.n + 1) + start[by_char]
        self.start, self.length = start[by_char], length[by_char]
        before = np.cumsum(self.length) - self.length
        totals = np.bincount(text, minlength=256)
        self.below = np.cumsum(totals) - totals
        # runs of a character, counted from that character's first run
        self.before = before - self.below[char[by_char]]
        self.char = char[by_char]
        ordered = rank[order]
        head = np.append(True, ordered[1:] != ordered[:-1])
        repeats = head & np.append(ordered[1:] == ordered[:-1], False)
        self.heads = np.nonzero(repeats)[0]
        self.head_places = order[self.heads]

    def count_before(self, char, row):
        """How often ``char`` stands in the transform before ``row``."""
        import numpy as np

        run = np.searchsorted(self.keys, char * (self.n + 1) + row, side="left") - 1
        found = (run >= 0) & (self.char[run] == char)
        inside = self.before[run] + np.minimum(row - self.start[run], self.length[run])
        return np.where(found, inside, 0)

    def matches(self, text, ends):
        """Stream the strings of ``text`` that end at ``ends`` backwards through the runs.

        Returns, for each, how many bytes match before one occurrence is left (at most
        ``depth``), and the earliest place of the whole string, or -1 if it does not repeat.
        """
        import numpy as np

        length = np.zeros(len(ends), dtype=np.int64)
        place = np.full(len(ends), -1, dtype=np.int64)
        live = np.arange(len(ends))
        low = np.zeros(len(ends), dtype=np.int64)
        high = np.full(len(ends), self.n, dtype=np.int64)
        for step in range(1, self.depth + 1):
            char = text[ends[live] - step]
            # rows of one character keep their order in the step, so a stable sort by
            # character keeps the queries in row order, and neighbours look up near runs
            order = np.argsort(char, kind="stable")
            live, low, high = live[order], low[order], high[order]
            char = char[order].astype(np.int64)
            low = self.below[char] + self.count_before(char, low)
            high = self.below[char] + self.count_before(char, high)
            again = high - low > 1
            live, low, high = live[again], low[again], high[again]
            length[live] = step
        place[live] = self.head_places[np.searchsorted(self.heads, low)]
        return length, place


def _places(index: RunIndex, text, starts):
    """The earliest place of each string of ``MATCH`` bytes, -1 where it does not repeat.

    Strings are grouped by a hash first. A hash that occurs once cannot repeat; of equal ones
    the first is streamed through the index, and the others compared with what it found.
    """
    import numpy as np

    words = np.ndarray((len(text) - 7,), dtype="<u8", buffer=text.tobytes(), strides=(1,))
    steps = [*range(0, MATCH - 7, 8), MATCH - 8]
    hashes = np.zeros(len(starts), dtype=np.uint64)
    for number, step in enumerate(steps):
        hashes = (hashes ^ words[starts + step]) * np.uint64(MIX[number % len(MIX)])
        hashes ^= hashes >> np.uint64(29)
    _, first, group, times = np.unique(
        hashes, return_index=True, return_inverse=True, return_counts=True
    )
    found = np.full(len(first), -1, dtype=np.int64)
    several = np.nonzero(times > 1)[0]

    def stream(which):
        parts = [which[at : at + 200_000] for at in range(0, len(which), 200_000)]
        out = [index.matches(text, starts[part] + MATCH)[1] for part in parts]
        return np.concatenate(out) if out else np.zeros(0, dtype=np.int64)

    found[several] = stream(first[several])
    place = found[group]
    same = place >= 0
    for step in steps:
        same &= words[starts + step] == words[np.maximum(place, 0) + step]
    other = np.nonzero(~same & (times[group] > 1))[0]
    place[other] = stream(other)
    return place


def shard_windows(docs, starts, hashes, phrases):
    """Settle the phrases of a shard: lists (doc, start, windows, checksum) of repeated windows.

    The arguments are parallel lists; ``hashes`` are low bits of the phrases' anchors, so
    equal anchors have equal ones.
    """
    import numpy as np

    found = []
    first: dict[bytes, int] = {}
    anchor: dict[bytes, int] = {}
    open_: list[tuple[int, int, bytes]] = []
    for at in np.lexsort((starts, docs)).tolist():
        phrase = phrases[at]
        if first.setdefault(phrase, docs[at]) < docs[at]:
            found.append((docs[at], starts[at], len(phrase) - MATCH + 1, zlib.crc32(phrase)))
        else:
            anchor[phrase] = hashes[at]
            open_.append((docs[at], starts[at], phrase))
    different: dict[int, int] = {}
    for value in anchor.values():
        different[value] = different.get(value, 0) + 1
    # in order of their first documents, so an earlier place is an earlier document
    listed = [p for p in anchor if different[anchor[p]] > 1]
    if not listed:
        return found
    text = np.frombuffer(b"".join(p + b"\xff" for p in listed), dtype=np.uint8)
    sizes = np.array([len(p) for p in listed])
    begins = np.concatenate([[0], np.cumsum(sizes + 1)[:-1]])
    owners = np.array([first[p] for p in listed])
    index = RunIndex(text)
    counts = sizes - MATCH + 1
    owner = np.repeat(np.arange(len(listed)), counts)
    window = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    place = _places(index, text, begins[owner] + window)
    earliest = owners[np.searchsorted(begins, np.maximum(place, 0), side="right") - 1]
    hit = (place >= 0) & (earliest < owners[owner])
    edge = np.append(True, (hit[1:] != hit[:-1]) | (owner[1:] != owner[:-1]))
    runs = np.nonzero(edge)[0]
    spans: dict[bytes, list[tuple[int, int, int]]] = {}
    for run, size in zip(runs.tolist(), np.diff(np.append(runs, len(hit))).tolist(), strict=True):
        if hit[run]:
            phrase, shift = listed[owner[run]], int(window[run])
            checksum = zlib.crc32(phrase[shift : shift + size + MATCH - 1])
            spans.setdefault(phrase, []).append((shift, size, checksum))
    for doc, start, phrase in open_:
        found += [(doc, start + shift, *rest) for shift, *rest in spans.get(phrase, ())]
    return found


def _search_shard(table):
    import numpy as np
    import pyarrow as pa

    docs, starts, hashes, phrases, found = [], [], [], [], []
    for row in table.to_pylist():
        docs += np.frombuffer(row["docs"], np.int64).tolist()
        starts += np.frombuffer(row["starts"], np.int32).tolist()
        hashes += np.frombuffer(row["hashes"], np.uint32).tolist()
        at, data = 0, zlib.decompress(row["bytes"])
        for size in np.frombuffer(row["sizes"], np.int32).tolist():
            phrases.append(data[at : at + size])
            at += size
        found += zip(
            np.frombuffer(row["done_docs"], np.int64).tolist(),
            np.frombuffer(row["done_starts"], np.int32).tolist(),
            np.frombuffer(row["done_windows"], np.int32).tolist(),
            np.frombuffer(row["done_sums"], np.uint32).tolist(),
            strict=True,
        )
    found += shard_windows(docs, starts, hashes, phrases)
    columns = np.array(found, dtype=np.int64).reshape(-1, 4)
    return pa.table(
        {
            "doc_id": columns[:, 0],
            "run": (columns[:, 1] << 32) + columns[:, 2],
            "sum": columns[:, 3].astype(np.uint32).view(np.int32),
        }
    )


# -- over a table ----------------------------------------------------------------------


def packed_texts(rows: DataFrame) -> DataFrame:
    """(doc_id, text) with compressed texts: they are shuffled twice, to meet what was found."""

    def run(batches):
        import pyarrow as pa

        for batch in batches:
            texts = [zlib.compress(text, 1) for text in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(texts, pa.binary())], names=["doc_id", "text"]
            )

    return rows.mapInArrow(run, "doc_id long, text binary")


def repeated_windows(documents: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows (doc_id, run, sum) of runs of repeated windows: the first one, shifted by 32 bits, and
    their number, with the checksum of their bytes."""
    rows = documents.where(F.col(key).isNotNull()).select(
        F.col(key).cast("long").alias("doc_id"), text_of(text).cast("binary").alias("text")
    )
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    lists, shards = (max(1, -(-size // each)) for each in (LIST_BYTES, SHARD_BYTES))
    listed = rows.mapInArrow(_list_anchors(lists), ANCHOR_ROW)
    shared = (
        listed.groupBy("shard")
        .applyInArrow(_find_shared, "doc_id long, hash int")
        .groupBy("doc_id")
        .agg(F.collect_list("hash").alias("shared"))
    )
    # merge joins at every size: what is shared grows with the documents
    phrases = packed_texts(rows).join(shared.hint("merge"), "doc_id")
    phrases = phrases.select("doc_id", "text", "shared")
    return (
        phrases.mapInArrow(_cut_phrases(shards), PHRASE_ROW)
        .groupBy("shard")
        .applyInArrow(_search_shard, FOUND_ROW)
    )


def covered_spans(starts, windows, size: int) -> list[tuple[int, int]]:
    """Maximal byte spans (begin, end) under the given runs of windows, within ``size``."""
    import numpy as np

    edges = np.zeros(size + 1, dtype=np.int64)
    np.add.at(edges, np.minimum(starts, size), 1)
    np.add.at(edges, np.minimum(starts + windows + MATCH - 1, size), -1)
    inside = np.concatenate([[False], np.cumsum(edges[:size]) > 0, [False]])
    turns = np.nonzero(inside[1:] != inside[:-1])[0].tolist()
    return list(zip(turns[::2], turns[1::2], strict=True))


def _held(data: bytes, starts, windows, sums):
    """Which runs have their bytes in ``data``: rows of one key may differ."""
    import numpy as np

    ends = starts + windows + MATCH - 1
    spans = zip(starts.tolist(), ends.tolist(), sums.tolist(), strict=True)
    return np.array([zlib.crc32(data[b:e]) == c for b, e, c in spans], dtype=bool)


def cut_repeats(documents: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per document: ``doc_id``, ``n_bytes``, ``spans`` (the marked byte ranges) and ``kept``,
    the bytes outside of them."""
    found = (
        repeated_windows(documents, key, text)
        .groupBy("doc_id")
        # two lists in one order: as structs they would take three times the room
        .agg(F.collect_list("run").alias("runs"), F.collect_list("sum").alias("sums"))
        .withColumnRenamed("doc_id", "__key")
    )
    rows = documents.select(
        F.col(key).cast("long").alias("doc_id"), text_of(text).cast("binary").alias("text")
    )
    matched = F.col("doc_id") == F.col("__key")
    joined = packed_texts(rows).join(found.hint("merge"), matched, "left")
    joined = joined.select("doc_id", "text", "runs", "sums")

    def cut(batches):
        import numpy as np
        import pyarrow as pa

        span = pa.struct([("begin", pa.int64()), ("end", pa.int64())])
        for batch in batches:
            for part in slices(batch, 1, TEXTS_AT_ONCE, BYTES_AT_ONCE):
                sizes, spans, kept = [], [], []
                for packed, runs, marks in zip(
                    part.column(1).to_pylist(), part.column(2), part.column(3), strict=True
                ):
                    data = zlib.decompress(packed)
                    found = []
                    if runs.is_valid:
                        run = runs.values.to_numpy()
                        sums = marks.values.to_numpy().view(np.uint32)
                        own = _held(data, run >> 32, run & 0xFFFFFFFF, sums)
                        found = covered_spans(run[own] >> 32, run[own] & 0xFFFFFFFF, len(data))
                    ends = [0, *(end for _, end in found)]
                    begins = [*(begin for begin, _ in found), len(data)]
                    sizes.append(len(data))
                    spans.append([{"begin": b, "end": e} for b, e in found])
                    kept.append(b"".join(data[e:b] for e, b in zip(ends, begins, strict=True)))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        pa.array(sizes, pa.int64()),
                        pa.array(spans, pa.list_(span)),
                        pa.array(kept, pa.binary()),
                    ],
                    names=["doc_id", "n_bytes", "spans", "kept"],
                )

    return joined.mapInArrow(
        cut,
        "doc_id long, n_bytes long, spans array<struct<begin: long, end: long>>, kept binary",
    )
