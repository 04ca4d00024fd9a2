"""Benchmark decontamination by SimHash over item-sized windows.

A benchmark item of n words is compared with windows of n words in the documents. A window
that shares no five-word shingle with the item cannot be similar to it, so only windows that
start where a shared shingle places the item's start are formed; a place outside the document
moves to its edge. A document shorter than the item, but with at least ``least_similarity`` of
its number of shingles, is one window. Their fingerprints meet those
of the items of the same length in a multi-index: the 64 bits are cut into one block more than
the radius, so any pair within the radius agrees in a whole block. Candidates within the radius
are verified by the exact weighted similarity of their shingles, the sum of the lesser over the
sum of the greater multiplicities.

All steps are column expressions. The index of the benchmark is written, so the planner knows
its size: it is broadcast while under the session's limit and shuffled beyond it.

Words are runs other than ASCII white space, without case and without any character but
letters and digits, so neither marks around words nor signs between them hide a passage.
Items of fewer than five words, and null or empty ones, have no shingle and match nothing; so
do such documents, and documents without a key. Repeated documents and items give one row. Rows
that share a key are told apart by the hash of their text; what any of them holds counts for the
key. An empty table on either side gives none. Extra columns are not carried.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeweir.llm.text import text_of, words_of
from lakeweir.sources.scratch import written

SHINGLE = 5
RADIUS = 15
LEAST_SIMILARITY = 0.8
BITS = 64
NO_WORD = r"[^\p{L}\p{N}\x20\x09-\x0D]+"


def _words(text: str) -> Column:
    return words_of(F.regexp_replace(F.lower(text_of(text)), NO_WORD, ""))


def _shingles(words: Column, size: int) -> Column:
    """Each run of ``size`` words as one text."""
    n = F.size(words)
    return F.when(
        n >= size,
        F.transform(
            F.sequence(F.lit(0), n - size),
            lambda i: F.array_join(F.slice(words, i + 1, F.lit(size)), " "),
        ),
    ).otherwise(F.array().cast("array<string>"))


def _shingle_hashes(words: Column, size: int) -> Column:
    n = F.size(words)
    return F.when(
        n >= size,
        F.transform(
            F.sequence(F.lit(0), n - size),
            lambda i: F.xxhash64(*(F.get(words, i + k) for k in range(size))),
        ),
    ).otherwise(F.array().cast("array<bigint>"))


def simhash(hashes: Column) -> Column:
    """A bit is set if it is set in over half of the hashes, each as often as it occurs."""

    def bit(value: Column, place: Column) -> Column:
        ones = F.aggregate(
            hashes,
            F.lit(0).cast("long"),
            lambda n, h: n + F.call_function("getbit", h, place),
        )
        mask = F.call_function("shiftleft", F.lit(1).cast("long"), place)
        return F.when(ones * 2 > F.size(hashes), value.bitwiseOR(mask)).otherwise(value)

    return F.aggregate(F.sequence(F.lit(0), F.lit(BITS - 1)), F.lit(0).cast("long"), bit)


def _blocks(fingerprint: Column, radius: int) -> Column:
    """The value of each of ``radius`` + 1 runs of bits, with its number."""
    blocks = radius + 1
    cuts = [BITS * i // blocks for i in range(blocks + 1)]
    return F.array(
        *(
            F.struct(
                F.lit(i).alias("block"),
                F.shiftrightunsigned(fingerprint, low)
                .bitwiseAND(F.lit((1 << (high - low)) - 1))
                .alias("bits"),
            )
            for i, (low, high) in enumerate(zip(cuts, cuts[1:], strict=False))
        )
    )


def weighted_similarity(left: Column, right: Column) -> Column:
    """Sum of the lesser over the sum of the greater multiplicities of two shingle arrays."""

    def times(items: Column, item: Column) -> Column:
        return F.size(F.filter(items, lambda x: x == item))

    common = F.aggregate(
        F.array_distinct(left),
        F.lit(0),
        lambda n, x: n + F.least(times(left, x), times(right, x)),
    )
    return common / (F.size(left) + F.size(right) - common)


def find_leaks(
    documents: DataFrame,
    benchmark: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    shingle: int = SHINGLE,
    radius: int = RADIUS,
    least_similarity: float = LEAST_SIMILARITY,
) -> DataFrame:
    """One row per document and item found in it: ``doc_id``, ``item_id``, ``start`` and
    ``n_words`` of the most similar window, its ``hamming`` distance and ``similarity``, and
    ``n_windows`` that pass."""
    items = written(
        benchmark.select(F.col(item).alias("item_id"), _words(item_text).alias("words"))
        .where(F.size("words") >= shingle)
        .select(
            "item_id",
            F.size("words").alias("n_words"),
            _shingles(F.col("words"), shingle).alias("item_shingles"),
            _shingle_hashes(F.col("words"), shingle).alias("hashes"),
        )
        .withColumn("item_print", simhash(F.col("hashes"))),
        "items",
    )
    places = written(
        items.select("n_words", F.posexplode("hashes").alias("in_item", "hash")).distinct(),
        "item-shingles",
    )
    words = documents.select(
        F.col(key).alias("doc_id"),
        F.xxhash64(text_of(text)).alias("digest"),
        _words(text).alias("words"),
    )
    row = ["doc_id", "digest"]
    hits = words.select(
        *row,
        F.size("words").alias("size"),
        F.posexplode(_shingle_hashes(F.col("words"), shingle)).alias("place", "hash"),
    ).join(places, "hash")
    enough = F.col("size") - shingle + 1 >= (F.col("n_words") - shingle + 1) * least_similarity
    placed = F.least(F.col("place") - F.col("in_item"), F.col("size") - F.col("n_words"))
    starts = (
        hits.where(enough)
        .select(*row, "n_words", F.greatest(placed, F.lit(0)).alias("start"))
        .select(*row, F.struct("start", "n_words").alias("window"))
        .distinct()
    )
    # a document has at most as many windows as shingles times lengths; equal rows share them
    gathered = starts.groupBy(*row).agg(F.collect_list("window").alias("wanted"))
    wanted = written(gathered, "starts")
    # a merge join at every size: the windows grow with the documents
    windows = (
        words.join(wanted.hint("merge"), row)
        .select(*row, "words", F.explode("wanted").alias("window"))
        .select(
            *row,
            F.size("words").alias("size"),
            "window.start",
            "window.n_words",
            F.slice("words", F.col("window.start") + 1, F.col("window.n_words")).alias("own"),
        )
        .where(enough & (F.size("own") == F.least("size", "n_words")))
        .select(
            *row,
            "start",
            "n_words",
            F.size("own").alias("own_words"),
            _shingles(F.col("own"), shingle).alias("shingles"),
            simhash(_shingle_hashes(F.col("own"), shingle)).alias("print"),
        )
    )
    windows = written(windows, "windows")
    index = items.select("item_id", "n_words", "item_print").withColumn(
        "block", F.explode(_blocks(F.col("item_print"), radius))
    )
    probes = windows.select(*row, "start", "n_words", "print").withColumn(
        "block", F.explode(_blocks(F.col("print"), radius))
    )
    hamming = F.bit_count(F.col("print").bitwiseXOR(F.col("item_print")))
    candidates = (
        probes.join(index, ["n_words", "block"])
        .where(hamming <= radius)
        .select(*row, "start", "n_words", "item_id", hamming.alias("hamming"))
        .distinct()
    )
    similarity = weighted_similarity(F.col("shingles"), F.col("item_shingles"))
    texts = items.select("item_id", "n_words", "item_shingles").distinct()
    verified = (
        candidates.join(windows.drop("print").distinct(), [*row, "start", "n_words"])
        .join(texts, ["item_id", "n_words"])
        .select(
            "doc_id",
            "item_id",
            "start",
            F.col("own_words").alias("n_words"),
            "hamming",
            similarity.alias("similarity"),
        )
        .where(F.col("similarity") >= least_similarity)
    )
    best = F.max_by(
        F.struct("start", "n_words", "hamming", "similarity"),
        F.struct("similarity", (-F.col("hamming")).alias("near"), (-F.col("start")).alias("at")),
    )
    return (
        verified.groupBy("doc_id", "item_id")
        .agg(best.alias("best"), F.count(F.lit(1)).alias("n_windows"))
        .select("doc_id", "item_id", "best.*", "n_windows")
    )
