"""A corpus pipeline: five stages, each written and read again before the next.

Every stage takes (spark, docs, sf_dir). All but the last return the columns of documents.
Rows may lack a doc_id or share one: near-duplicates go by the number of a row, leaks by the text.
Line dedup compares documents by doc_id, so it leaves rows without one as they are.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeweir.llm import decontamination, line_dedup, packing, simhash, toxicity
from lakeweir.llm.text import text_of
from lakeweir.sources.scratch import new_area, written


def _columns(docs: DataFrame) -> list:
    return [F.col(f"`{name}`") for name in docs.columns]


def _without(docs: DataFrame, own: Column, keys: DataFrame) -> DataFrame:
    """``docs`` but for the rows whose ``own`` is among the single column of ``keys``."""
    # a merge join at every size: what goes grows with the documents
    gone = keys.toDF("__gone").distinct().hint("merge")
    return docs.join(gone, own == F.col("__gone"), "left_anti").select(*_columns(docs))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents under the toxicity threshold; the machine learns from the labels."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    machine = toxicity.train(toxicity.labelled_sample(docs, labels))
    return docs.where(toxicity.score(text_of(), machine) < toxicity.PREDICT_AT)


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines copied from an earlier document are cut; a document cut to nothing goes."""
    cut = line_dedup.dedup_lines(docs, name="__cut")
    emptied = (F.size("__cut") > 0) & (F.col("text") == "")
    return cut.where(~F.coalesce(emptied, F.lit(False))).select(*_columns(docs))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component stays: the smallest doc_id, and of rows that share
    it, or all lack one, the first."""
    numbered = docs.withColumn("__row", F.monotonically_increasing_id())
    rows = written(numbered, "numbered")  # numbers of a written table stay as they are
    place = F.struct(F.col("doc_id").isNull().alias("keyless"), "doc_id", "__row")
    found = simhash.near_duplicates(rows.select(place.alias("place"), "text"), key="place")
    copies = found.where("doc_id <> component_id").select("doc_id.__row")
    return _without(rows, F.col("__row"), copies).drop("__row")


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go; whether one does is a matter of its text."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    digest = F.md5(text_of().cast("binary"))
    texts = docs.select(digest.alias("digest"), "text")
    leaks = decontamination.find_leaks(texts, benchmark, key="digest")
    return _without(docs, digest, leaks.select("doc_id"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their places in sequences."""
    pieces = packing.tokenized_pieces(
        docs,
        public_tokenizers.path("byte_bpe_50k.tiktoken"),
        public_tokenizers.PATTERN,
        public_tokenizers.path("byte_bpe_50k.json"),
    )
    digests = pieces.select(
        "doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32")
    )
    return packing.pack(digests)


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", dedup_lines),
    ("simhash_near_dedup", drop_near_duplicates),
    ("benchmark_decontamination", drop_leaks),
    ("best_fit_packing", pack),
]

# Learning, alignment, fingerprints and packing have no SQL form; tests hold them to brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table; each result is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = new_area(spark, f"stage-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
