"""Simple-8b: ids packed into 64-bit words, decoded with array operations.

A word holds a selector in its top four bits and as many ids of one width as fit into the other
sixty. Ids of more than sixty bits are escapes: a zero stands for them in the words, and their
places and values follow the words. Offsets, one per ``STRIDE`` words, tell how many ids lie
before a word, so a range of ids is decoded without the words before it.

A block of ids as bytes, all little-endian: magic, number of ids, of words and of escapes (32 bits
each), offsets (32 bits), words (64 bits), places (32 bits) and values (64 bits) of the escapes.
"""

from __future__ import annotations

import struct

# How many ids each selector packs, and their width in bits.
COUNTS = (240, 120, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1)
WIDTHS = (0, 0, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60)

MAGIC = b"S8b1"
HEADER = "<4sIII"
STRIDE = 64


def _selectors(values):
    """For each place, the selector that packs most of the ids from there on."""
    import numpy as np

    n = len(values)
    widths = sorted(set(WIDTHS))
    # which width each id needs, as its number among the widths; padding fits into any
    need = np.zeros(n + max(COUNTS), dtype=np.uint8)
    greatest = int(values.max(initial=0))
    for width in widths:
        if greatest >> width:
            need[:n] += values >= np.uint64(1 << width)
    chosen = np.full(n, len(COUNTS) - 1, dtype=np.uint8)
    # the greatest need of ``reach`` ids from each place; no count is over twice the one before
    widest, reach = need, 1
    for selector in range(len(COUNTS) - 2, -1, -1):
        further = COUNTS[selector] - reach
        widest, reach = np.maximum(widest[:-further], widest[further:]), COUNTS[selector]
        fits = widest[:n] <= widths.index(WIDTHS[selector])
        np.copyto(chosen, np.uint8(selector), where=fits)
    return chosen


def encode(ids) -> bytes:
    """``ids``: an array of unsigned numbers of up to 64 bits."""
    import numpy as np

    values = np.asarray(ids).astype(np.uint64)
    escaped = np.flatnonzero(values >> np.uint64(60))
    escapes = values[escaped]
    if len(escaped):
        values = values.copy()
        values[escaped] = 0
    selectors = _selectors(values)
    steps = np.array(COUNTS)[selectors].tolist()
    starts = []
    at, stop = 0, len(steps)
    while at < stop:
        starts.append(at)
        at += steps[at]
    starts = np.array(starts, dtype=np.int64)
    used = selectors[starts] if len(starts) else np.zeros(0, dtype=np.uint8)
    words = used.astype(np.uint64) << np.uint64(60)
    padded = np.concatenate([values, np.zeros(max(COUNTS), dtype=np.uint64)])
    for selector in np.unique(used).tolist():
        if not WIDTHS[selector]:
            continue
        own = np.flatnonzero(used == selector)
        lane = np.arange(COUNTS[selector])
        shift = (lane * WIDTHS[selector]).astype(np.uint64)
        words[own] |= np.bitwise_or.reduce(padded[starts[own][:, None] + lane] << shift, axis=1)
    return b"".join(
        (
            struct.pack(HEADER, MAGIC, len(values), len(words), len(escaped)),
            starts[::STRIDE].astype("<u4").tobytes(),
            words.astype("<u8").tobytes(),
            escaped.astype("<u4").tobytes(),
            escapes.astype("<u8").tobytes(),
        )
    )


def decode(block: bytes, start: int = 0, stop: int | None = None):
    """The ids from ``start`` to before ``stop`` (all of them by default) as 64-bit numbers."""
    import numpy as np

    magic, n, n_words, n_escapes = struct.unpack_from(HEADER, block)
    if magic != MAGIC:
        raise ValueError("no Simple-8b block")
    stop = n if stop is None else min(stop, n)
    if start >= stop:
        return np.zeros(0, dtype=np.uint64)
    at = struct.calcsize(HEADER)
    sections = []
    for kind, size in (
        ("<u4", -(-n_words // STRIDE)), ("<u8", n_words), ("<u4", n_escapes), ("<u8", n_escapes)
    ):
        sections.append(np.frombuffer(block, kind, size, at))
        at += sections[-1].nbytes
    offsets, words, escaped, escapes = sections

    first = int(np.searchsorted(offsets, start, side="right")) - 1
    last = int(np.searchsorted(offsets, stop, side="left"))
    base = int(offsets[first])
    words = words[first * STRIDE : last * STRIDE].astype(np.uint64)
    selectors = (words >> np.uint64(60)).astype(np.int64)
    counts = np.array(COUNTS)[selectors]
    ends = np.cumsum(counts)
    out = np.zeros(int(ends[-1]), dtype=np.uint64)
    for selector in np.unique(selectors).tolist():
        width = WIDTHS[selector]
        if not width:
            continue
        own = np.flatnonzero(selectors == selector)
        lane = np.arange(COUNTS[selector])
        shift = (lane * width).astype(np.uint64)
        mask = np.uint64((1 << width) - 1)
        out[(ends[own] - COUNTS[selector])[:, None] + lane] = (words[own][:, None] >> shift) & mask
    inside = (escaped >= base) & (escaped < base + len(out))
    out[escaped[inside].astype(np.int64) - base] = escapes[inside]
    return out[start - base : stop - base]
