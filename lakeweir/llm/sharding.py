"""Two-pass external shuffle of records into shards.

Pass one scatters records by seeded hashes into buckets that fit in memory: the shard comes
from the key alone, the bucket within it from key and content. A shard has as many buckets as its
bytes ask for, so a key that many rows share makes more of them, not larger ones. Pass two loads
each bucket, shuffles it by Fisher-Yates and writes it. A shard is the concatenation of its buckets.

The shard is the one whose seeded hash of (key, shard) is highest, so adding a shard moves
rows only into the new one. All steps are functions of the rows, never of task order, so a
repeated task writes the same rows again.

Null texts count as empty. A null key is a key like any other. Rows equal in key and content
share a bucket, in any order, up to ``EQUAL_ROWS`` of them; more are spread over the buckets of
their shard by where they are read, which tells nothing but equal rows apart. An empty table gives
an empty table. Input columns
travel inside the struct column ``record``, so their names cannot clash with the output's.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from lakeweir.sources.scratch import new_area, written

SEED = 42
BUCKET_BYTES = 32 << 20
ROW_BYTES = 16
EQUAL_ROWS = 1000  # rows alike that one bucket takes


def _rank(key: Column, shard: Column, seed: int) -> Column:
    return F.xxhash64(F.lit(seed), key, shard)


def shard_of(key: Column, shards: int, seed: int = SEED) -> Column:
    """The shard, 0 to ``shards`` - 1, with the highest seeded hash for ``key``."""
    ranked = F.transform(
        F.sequence(F.lit(0), F.lit(shards - 1)),
        lambda shard: F.struct(_rank(key, shard, seed).alias("rank"), shard.alias("shard")),
    )
    return F.array_max(ranked)["shard"]


def grown_shard_of(key: Column, shard: Column, shards: int, seed: int = SEED) -> Column:
    """The shard among ``shards`` + 1, given the one among ``shards``."""
    new = F.lit(shards)
    return F.when(_rank(key, new, seed) >= _rank(key, shard, seed), new).otherwise(shard)


def record_bytes(text: str) -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + ROW_BYTES


def _fisher_yates(seed: int):
    def shuffle(key, bucket):
        import numpy as np
        import pyarrow as pa

        shard, number = (part.as_py() for part in key)
        rank = bucket.column("__rank").to_numpy()
        # the fetch order of a shuffle varies, so the draw starts from an order of the rows
        order = np.argsort(rank, kind="stable")
        drawn = np.random.default_rng([seed, shard, number]).permutation(len(order))
        rows = bucket.select(["shard", "bucket", "record"]).take(pa.array(order[drawn]))
        return rows.append_column("position", pa.array(np.arange(len(order), dtype=np.int64)))

    return shuffle


def shuffle_into_shards(
    rows: DataFrame,
    shards: int,
    key: str = "doc_id",
    text: str = "text",
    seed: int = SEED,
    bucket_bytes: int = BUCKET_BYTES,
    path: str | None = None,
) -> DataFrame:
    """Write ``rows`` as shuffled shards below ``path`` and return them.

    Columns: ``shard``, ``bucket``, ``position`` (place in the bucket), ``record``. Files lie
    in one folder per shard, sorted by bucket and position; a shard is its buckets in order.
    """
    path = path or new_area(rows.sparkSession, "shards")
    # a row per shard
    sizes = (
        rows.select(
            shard_of(F.col(key), shards, seed).alias("shard"), record_bytes(text).alias("n")
        )
        .groupBy("shard")
        .agg(F.sum("n").alias("n"))
        .collect()
    )
    asked = {row["shard"]: max(1, -(-row["n"] // bucket_bytes)) for row in sizes}
    buckets = F.get(F.array(*(F.lit(asked.get(n, 1)) for n in range(shards))), F.col("shard"))
    record = F.struct(*(F.col(f"`{name}`") for name in rows.columns))
    scattered = _told_apart(rows, key, text, seed).select(
        shard_of(F.col(key), shards, seed).alias("shard"),
        F.xxhash64(F.lit(seed + 1), F.col(key), F.col(text), F.col("__own")).alias("__content"),
        F.xxhash64(F.lit(seed + 2), F.col(key), F.col(text), F.col("__own")).alias("__rank"),
        record.alias("record"),
    )
    scattered = scattered.select(
        "shard", F.pmod("__content", buckets).cast("int").alias("bucket"), "__rank", "record"
    )
    schema = T.StructType(
        [
            T.StructField("shard", T.IntegerType()),
            T.StructField("bucket", T.IntegerType()),
            T.StructField("record", scattered.schema["record"].dataType),
            T.StructField("position", T.LongType()),
        ]
    )
    shuffled = scattered.groupBy("shard", "bucket").applyInArrow(_fisher_yates(seed), schema)
    shuffled.sortWithinPartitions("shard", "bucket", "position").write.partitionBy(
        "shard"
    ).parquet(path)
    return rows.sparkSession.read.schema(schema).parquet(path)


def _told_apart(rows: DataFrame, key: str, text: str, seed: int) -> DataFrame:
    """``rows`` with ``__own``, a number that differs among rows alike where there are very many of
    them, and is null else."""
    alike = F.xxhash64(F.lit(seed + 3), F.col(key), F.col(text))
    many = (
        rows.select(alike.alias("__alike"))
        .groupBy("__alike")
        .agg(F.count(F.lit(1)).alias("n"))
        .where(F.col("n") > EQUAL_ROWS)
        .select("__alike")
    )
    many = written(many, "rows-alike")
    if many.isEmpty():
        return rows.withColumn("__own", F.lit(None).cast("long"))
    numbered = rows.withColumn("__alike", alike).withColumn(
        "__at", F.monotonically_increasing_id()
    )
    marked = numbered.join(many.withColumn("__many", F.lit(True)), "__alike", "left")
    return marked.withColumn("__own", F.when(F.col("__many"), F.col("__at"))).drop(
        "__alike", "__at", "__many"
    )


def with_slots(shuffled: DataFrame) -> DataFrame:
    """Add ``slot``, the place in the shard, gapless from 0.

    Counts and positions are joined by bucket, so select what is needed of ``record`` before:
    the join then moves only that.
    """
    before = Window.partitionBy("shard").orderBy("bucket").rowsBetween(
        Window.unboundedPreceding, -1
    )
    starts = (
        shuffled.groupBy("shard", "bucket")
        .agg(F.count(F.lit(1)).alias("n"))
        .select(
            "shard", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("start")
        )
    )
    return shuffled.join(starts, ["shard", "bucket"]).withColumn(
        "slot", F.col("start") + F.col("position")
    ).drop("start")
