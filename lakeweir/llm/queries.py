"""One query per corpus operator, over its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from lakeweir.llm import (
    conversation_trie,
    decontamination,
    line_dedup,
    packing,
    quality_classifier,
    quality_rules,
    secrets,
    sharding,
    simhash,
    suffix_dedup,
    token_files,
    toxicity,
    whitening,
)
from lakeweir.llm.oracle import ORACLE  # noqa: F401  (registered beside QUERIES)
from lakeweir.llm.text import documents, text_of
from lakeweir.sources.scratch import new_area

SHARDS = 40


def op1_sharding(spark, sf_dir):
    rows = documents(spark, sf_dir, "doc_id", "text")
    text = F.coalesce(F.col("record.text"), F.lit(""))
    digests = sharding.shuffle_into_shards(rows, SHARDS).select(
        "shard",
        "bucket",
        "position",
        F.col("record.doc_id").alias("doc_id"),
        sharding.record_bytes("record.text").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
    )
    return sharding.with_slots(digests).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("key").alias("law"),
        "shard",
        "slot",
        sharding.grown_shard_of(F.col("doc_id"), F.col("shard"), SHARDS).alias("grown_shard"),
    )


def op2_quality_rules(spark, sf_dir):
    judged = quality_rules.judge(documents(spark, sf_dir, "doc_id", "text"))
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
    return judged.select(
        "doc_id",
        *(F.col(f"quality.{name}").alias(name) for name in names),
        F.col("quality.base_failed").alias("base_failed"),
        F.col("quality.kept").alias("kept"),
        F.array_join("quality.failed_rules", ",").alias("failed_rules"),
    )


def op3_best_fit_packing(spark, sf_dir):
    pieces = packing.tokenized_pieces(
        documents(spark, sf_dir, "doc_id", "text"),
        public_tokenizers.path("byte_bpe_50k.tiktoken"),
        public_tokenizers.PATTERN,
        public_tokenizers.path("byte_bpe_50k.json"),
    )
    digests = pieces.select(
        "doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32")
    )
    return packing.pack(digests).select(
        "doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"
    )


def op4_line_dedup(spark, sf_dir):
    kept = line_dedup.dedup_lines(documents(spark, sf_dir, "doc_id", "text"))
    return kept.select(
        "doc_id",
        F.size("removed_lines").alias("n_removed"),
        F.array_join(F.col("removed_lines").cast("array<string>"), ",").alias("removed_lines"),
        F.sha2(text_of().cast("binary"), 256).alias("kept_sha256"),
    )


def op5_quality_classifier(spark, sf_dir):
    """Sources are hosts, languages their paths."""
    rows = documents(spark, sf_dir, "doc_id", "text", "source", "lang")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = quality_classifier.train(rows, labels)
    return quality_classifier.classify(rows, model, F.col("source"), F.col("lang"))


def op6_decontamination(spark, sf_dir):
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return decontamination.find_leaks(documents(spark, sf_dir, "doc_id", "text"), benchmark)


def op7_suffix_dedup(spark, sf_dir):
    cut = suffix_dedup.cut_repeats(documents(spark, sf_dir, "doc_id", "text"))
    return cut.select(
        "doc_id",
        "n_bytes",
        (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op8_secret_scans(spark, sf_dir):
    rows = documents(spark, sf_dir, "doc_id", "text")
    model = secrets.train(secrets.labelled_samples(rows))
    found = secrets.scan(rows, model)
    counts = {kind: F.size(f"secrets.{kind}").cast("long") for kind in secrets.KINDS}
    return found.select(
        "doc_id",
        *(count.alias(f"n_{kind}") for kind, count in counts.items()),
        F.sha2(secrets.joined(F.col("secrets.base")).cast("binary"), 256).alias("base_sha256"),
        secrets.joined(F.col("secrets.all")).alias("spans"),
    )


def op9_simhash_near_dedup(spark, sf_dir):
    found = simhash.near_duplicates(documents(spark, sf_dir, "doc_id", "text"))
    return found.select(
        "doc_id",
        F.lower(F.lpad(F.hex("fingerprint"), 16, "0")).alias("fingerprint"),
        "component_id",
    )


def op10_toxicity(spark, sf_dir):
    rows = documents(spark, sf_dir, "doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")

    def held_out(key):
        return F.crc32(F.col(key).cast("string").cast("binary")) % 4 == 2

    sample = toxicity.labelled_sample(rows, labels.where(~held_out("doc_id")))
    machine = toxicity.train(sample)
    scored = rows.select(
        "doc_id",
        held_out("doc_id").alias("held_out"),
        toxicity.score(text_of(), machine).alias("score"),
    )
    predicted = (F.col("score") >= toxicity.PREDICT_AT).cast("int")
    return scored.withColumn("predicted", predicted)


def op11_conversation_trie(spark, sf_dir):
    table = spark.read.parquet(f"{sf_dir}/conversations.parquet")
    turns = conversation_trie.numbered_turns(table)
    return conversation_trie.trie(conversation_trie.rebuilt(turns))


def op12_token_ids(spark, sf_dir):
    path = new_area(spark, "token-files")
    rows = documents(spark, sf_dir, "doc_id", "text")
    token_files.write_ids(rows, public_tokenizers.path("word_bpe_49k.json"), path)
    return token_files.read_documents(spark, path)


def op13_embedding_whitening(spark, sf_dir):
    white = whitening.whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))
    entry = F.arrays_zip("whitened", "explained")
    return white.select(
        "vec_id", "n", "deviation", "identity_error", F.posexplode(entry).alias("place", "entry")
    ).select(
        "vec_id",
        (F.col("place") + 1).alias("component"),
        "n",
        "deviation",
        F.col("entry.whitened").alias("whitened"),
        F.col("entry.explained").alias("explained"),
        "identity_error",
    )


QUERIES = {
    "op1_sharding": op1_sharding,
    "op2_quality_rules": op2_quality_rules,
    "op3_best_fit_packing": op3_best_fit_packing,
    "op4_line_dedup": op4_line_dedup,
    "op5_quality_classifier": op5_quality_classifier,
    "op6_decontamination": op6_decontamination,
    "op7_suffix_dedup": op7_suffix_dedup,
    "op8_secret_scans": op8_secret_scans,
    "op9_simhash_near_dedup": op9_simhash_near_dedup,
    "op10_toxicity": op10_toxicity,
    "op11_conversation_trie": op11_conversation_trie,
    "op12_token_ids": op12_token_ids,
    "op13_embedding_whitening": op13_embedding_whitening,
}
