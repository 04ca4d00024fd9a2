"""Line dedup by pairwise alignment.

Documents that share a passage are candidates for alignment: a passage is a shortest run of
lines with ``least_words`` words, from each line on and up to each line, so every line of a
common block that is long enough to go lies in a common passage. Each later holder of a passage
is paired with its first holder, which holds all of it, so a passage that a third of all
documents hold still gives only as many pairs as holders; no list is formed.
A pair is aligned by patience diff, anchored at lines that occur once in each of the two
documents, or at the longest common block where there is no such line. What is left of the later
document is aligned again, so further copies of a passage are found too. The lines of aligned
common blocks go from the later document. Blocks under ``least_words`` words stay: a short line
alone is no copy.

The work runs on arrays of 64-bit line hashes; texts are read again only to cut the lines out.
Lines are compared without outer white space; blank lines carry no hash, and go when a whole
document goes. Earlier means a smaller key; of rows with equal keys, none is earlier, and rows
without a key are left alone. All deletions are judged on the input, so a chain of copies
shrinks to its first document. Null and empty texts have no lines and come back as they are.
Input columns come back, whatever their names; an empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeweir.llm.text import SPACES, text_of, words_of
from lakeweir.sources.scratch import written

LEAST_WORDS = 8


def _line_hashes(text: Column) -> Column:
    """Hash and number of words per line; blank lines have hash zero and no words."""

    def describe(line: Column) -> Column:
        bare = F.trim(line, F.lit(SPACES))
        blank = bare == ""
        return F.struct(
            F.when(blank, F.lit(0).cast("long")).otherwise(F.xxhash64(bare)).alias("hash"),
            F.size(words_of(bare)).alias("words"),
        )

    return F.transform(F.split(text, "\n", -1), describe)


# -- alignment of one pair -------------------------------------------------------------


def _longest_increasing(values: Sequence[int]) -> list[int]:
    """Indexes of a longest increasing subsequence (patience sorting)."""
    from bisect import bisect_left

    tops: list[int] = []
    top_at: list[int] = []
    back: list[int] = []
    for at, value in enumerate(values):
        pile = bisect_left(tops, value)
        back.append(top_at[pile - 1] if pile else -1)
        if pile == len(tops):
            tops.append(value)
            top_at.append(at)
        else:
            tops[pile], top_at[pile] = value, at
    out = []
    at = top_at[-1] if top_at else -1
    while at >= 0:
        out.append(at)
        at = back[at]
    return out[::-1]


def patience_match(a: Sequence[int], b: Sequence[int]) -> list[tuple[int, int]]:
    """Aligned pairs of equal lines, in order. Zero (a blank line) never aligns by itself."""
    matched: list[tuple[int, int]] = []
    stack = [(0, len(a), 0, len(b))]
    while stack:
        a0, a1, b0, b1 = stack.pop()
        while a0 < a1 and b0 < b1 and a[a0] == b[b0]:
            matched.append((a0, b0))
            a0, b0 = a0 + 1, b0 + 1
        while a0 < a1 and b0 < b1 and a[a1 - 1] == b[b1 - 1]:
            a1, b1 = a1 - 1, b1 - 1
            matched.append((a1, b1))
        if a0 == a1 or b0 == b1:
            continue
        in_a, in_b = _once(a, a0, a1), _once(b, b0, b1)
        common = [(i, in_b[v]) for v, i in in_a.items() if v in in_b]
        common.sort()
        chain = [common[k] for k in _longest_increasing([j for _, j in common])]
        chain = chain or _longest_block(a, b, a0, a1, b0, b1)
        for i, j in chain:
            matched.append((i, j))
        edges = [(a0 - 1, b0 - 1), *chain, (a1, b1)] if chain else []
        for (i, j), (p, q) in zip(edges, edges[1:], strict=False):
            if i + 1 < p and j + 1 < q:
                stack.append((i + 1, p, j + 1, q))
    return sorted(matched)


def _once(lines: Sequence[int], start: int, end: int) -> dict[int, int]:
    seen: dict[int, int] = {}
    for at in range(start, end):
        seen[lines[at]] = -1 if lines[at] in seen else at
    return {value: at for value, at in seen.items() if at >= 0 and value}


def _longest_block(a, b, a0: int, a1: int, b0: int, b1: int) -> list[tuple[int, int]]:
    """A longest run of equal lines of both ranges, without blank ones (suffix automaton)."""
    both = set(a[a0:a1]) & set(b[b0:b1]) - {0}
    if not both:
        return []
    step: list[dict[int, int]] = [{}]
    link, length, end = [-1], [0], [-1]
    last = 0
    for at in range(a0, a1):
        # lines only one side has are separators, each unlike any other
        line = a[at] if a[at] in both else ("", at)
        new = len(step)
        step.append({})
        length.append(length[last] + 1)
        link.append(0)
        end.append(at)
        node = last
        while node >= 0 and line not in step[node]:
            step[node][line] = new
            node = link[node]
        if node >= 0:
            other = step[node][line]
            if length[other] == length[node] + 1:
                link[new] = other
            else:
                copy = len(step)
                step.append(dict(step[other]))
                length.append(length[node] + 1)
                link.append(link[other])
                end.append(end[other])
                while node >= 0 and step[node].get(line) == other:
                    step[node][line] = copy
                    node = link[node]
                link[other] = link[new] = copy
        last = new
    node = size = most = i = j = 0
    for at in range(b0, b1):
        while node and b[at] not in step[node]:
            node = link[node]
            size = length[node]
        if b[at] in step[node]:
            node, size = step[node][b[at]], size + 1
        if size > most:
            most, i, j = size, end[node], at
    return [(i - k, j - k) for k in range(most - 1, -1, -1)]


def common_blocks(
    earlier: Sequence[int], later: Sequence[int], words: Sequence[int], least_words: int
) -> list[int]:
    """Lines of ``later`` inside aligned blocks of at least ``least_words`` words.

    The parts between them are aligned with all of ``earlier`` again while that finds blocks.
    """
    out: list[int] = []
    parts = [(0, len(later))]
    while parts:
        start, stop = parts.pop()
        if sum(words[start:stop]) < least_words:
            continue
        found = _aligned_blocks(earlier, later[start:stop], words[start:stop], least_words)
        out += [start + at for at in found]
        if found:
            edges = [start - 1, *(start + at for at in found), stop]
            parts += [(p + 1, q) for p, q in zip(edges, edges[1:], strict=False) if p + 1 < q]
    return sorted(out)


def _aligned_blocks(earlier, later, words, least_words: int) -> list[int]:
    out: list[int] = []
    block: list[int] = []
    last = (-2, -2)
    for i, j in [*patience_match(earlier, later), (-9, -9)]:
        if (i, j) != (last[0] + 1, last[1] + 1):
            if sum(words[at] for at in block) >= least_words:
                out += block
            block = []
        if j >= 0:
            block.append(j)
        last = (i, j)
    return out


def _align(least_words: int):
    def align(batches):
        import pyarrow as pa

        for batch in batches:
            keys, digests, removed = [], [], []
            for row in batch.to_pylist():
                lines = common_blocks(row["earlier"], row["later"], row["words"], least_words)
                if lines:
                    keys.append(row["doc_id"])
                    digests.append(row["digest"])
                    removed.append(lines)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(keys, pa.int64()),
                    pa.array(digests, pa.int64()),
                    pa.array(removed, pa.list_(pa.int32())),
                ],
                names=["doc_id", "digest", "removed"],
            )

    return align


# -- over a table ----------------------------------------------------------------------


def passages(lines: Sequence[int], words: Sequence[int], least_words: int) -> set[int]:
    """Hashes of the shortest runs of lines with ``least_words`` words, from each line that is
    not blank on and up to each such line."""
    import struct

    import xxhash

    runs = set()
    stop = total = 0
    for start in range(len(lines)):
        while stop < len(lines) and total < least_words:
            total += words[stop]
            stop += 1
        if total < least_words:
            break
        if lines[start]:
            runs.add((start, stop))
        total -= words[start]
    start = total = 0
    for stop in range(1, len(lines) + 1):
        total += words[stop - 1]
        while total - words[start] >= least_words and start < stop - 1:
            total -= words[start]
            start += 1
        if total >= least_words and lines[stop - 1]:
            runs.add((start, stop))
    return {
        xxhash.xxh64_intdigest(struct.pack(f"<{q - p}q", *lines[p:q])) - 2**63 for p, q in runs
    }


def _list_passages(least_words: int):
    def run(batches):
        import pyarrow as pa

        for batch in batches:
            rows, found = [], []
            for at, (lines, words) in enumerate(zip(batch.column(2), batch.column(3), strict=True)):
                own = passages(lines.as_py(), words.as_py(), max(1, least_words))
                rows += [at] * len(own)
                found += own
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(rows, pa.int64())),
                    batch.column(1).take(pa.array(rows, pa.int64())),
                    pa.array(found, pa.int64()),
                ],
                names=["doc_id", "digest", "hash"],
            )

    return run


def removed_lines(
    documents: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    least_words: int = LEAST_WORDS,
) -> DataFrame:
    """``doc_id``, ``digest`` (the hash of the text) and ``removed``, the numbers of the deleted
    lines, where there are any."""
    described = documents.where(F.col(key).isNotNull()).select(
        F.col(key).cast("long").alias("doc_id"),
        _digest(text).alias("digest"),
        _line_hashes(text_of(text)).alias("lines"),
    )
    # rows equal in key and text are one here
    listed = written(described.dropDuplicates(["doc_id", "digest"]), "lines")
    lines = written(
        listed.select("doc_id", "digest", "lines.hash", "lines.words").mapInArrow(
            _list_passages(least_words), "doc_id long, digest long, hash long"
        ),
        "passages",
    )
    holders = lines.groupBy("hash").agg(
        F.min(F.struct("doc_id", "digest")).alias("first"), F.max("doc_id").alias("last")
    )
    # written, so that both sides of the join are plain shuffles and a hot line can be split
    shared = written(
        holders.where(F.col("first.doc_id") < F.col("last")).select(
            "hash",
            F.col("first.doc_id").alias("first"),
            F.col("first.digest").alias("first_digest"),
        ),
        "shared",
    )
    pairs = written(
        lines.join(shared, "hash")
        .where(F.col("doc_id") > F.col("first"))
        .select("doc_id", "digest", "first", "first_digest")
        .distinct(),
        "pairs",
    )
    later = listed.select(
        "doc_id", "digest", F.col("lines.hash").alias("later"), F.col("lines.words").alias("words")
    )
    earlier = listed.select(
        F.col("doc_id").alias("first"),
        F.col("digest").alias("first_digest"),
        F.col("lines.hash").alias("earlier"),
    )
    both = pairs.join(later, ["doc_id", "digest"]).join(earlier, ["first", "first_digest"])
    aligned = both.select("doc_id", "digest", "earlier", "later", "words").mapInArrow(
        _align(least_words), "doc_id long, digest long, removed array<int>"
    )
    # a document has at most twice as many partners as lines
    return aligned.groupBy("doc_id", "digest").agg(
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("removed")))).alias("removed")
    )


def _digest(text: str) -> Column:
    return F.xxhash64(text_of(text))


def dedup_lines(
    documents: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    least_words: int = LEAST_WORDS,
    name: str = "removed_lines",
) -> DataFrame:
    """``documents`` with the removed lines cut from ``text`` and their numbers in ``name``.

    A document that loses all but blank lines keeps an empty text.
    """
    removed = written(removed_lines(documents, key, text, least_words), "removed").select(
        F.col("doc_id").alias("__key"),
        F.col("digest").alias("__digest"),
        F.col("removed").alias("__removed"),
    )
    # a merge join at every size: what is removed grows with the documents
    joined = documents.join(
        removed.hint("merge"),
        (F.col(key).cast("long") == F.col("__key")) & (_digest(text) == F.col("__digest")),
        "left",
    )
    whole = F.col(f"`{text}`")
    left = F.filter(
        F.split(whole, "\n", -1), lambda line, at: ~F.array_contains("__removed", at)
    )
    rest = F.array_join(left, "\n")
    rest = F.when(F.trim(rest, F.lit(SPACES)) == "", "").otherwise(rest)
    cut = F.when(F.col("__removed").isNull(), whole).otherwise(rest)
    lines = F.coalesce("__removed", F.array().cast("array<int>")).alias(name)
    return joined.select(
        *(
            cut.alias(text) if column == text else F.col(f"`{column}`")
            for column in documents.columns
            if column != name
        ),
        lines,
    )
