"""Upsert by equi-key as a composition of joins."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DUPLICATE_MARK = "DUPLICATE_SOURCE_KEY"
_HITS = "__hits"
_NEWEST = "__newest"
_SPREAD = "__spread"
_SPREAD_WAYS = 4096


def _all_set(keys: Sequence[str]):
    condition = F.lit(True)
    for key in keys:
        condition = condition & F.col(key).isNotNull()
    return condition


def _spread(columns: Sequence[str | Column], ways: int) -> Column:
    return F.pmod(F.xxhash64(*columns), F.lit(ways)).cast("int")


def match_keys(
    left: DataFrame,
    right: DataFrame,
    keys: Sequence[str],
    measure: Column,
    spread_by: Sequence[str] | None = None,
) -> DataFrame:
    """``left`` with ``measure`` aggregated over the ``right`` rows of the same key.

    Left rows with a NULL key cannot match, but a shuffle on the key alone would send them
    all to one task. The join therefore also compares a spread number: 0 for a complete
    key, otherwise a number drawn from where the row is read: the columns ``spread_by`` if
    they tell it, else the input partition. Equal rows spread as well as different ones. The
    0 is computed from the key, since a constant would be optimised out of the join keys.

    The 0 is added after the grouping. The join then shuffles the grouped keys again, which
    is little, and in return AQE sees a plain shuffle on both sides and can split a key
    that many left rows share.
    """
    spread = F.when(_all_set(keys), _spread(keys, 1)).otherwise(
        _spread(spread_by or [F.spark_partition_id()], _SPREAD_WAYS)
    )
    grouped = right.where(_all_set(keys)).groupBy(*keys).agg(measure)
    return (
        left.withColumn(_SPREAD, spread)
        .join(grouped.withColumn(_SPREAD, _spread(keys, 1)), [*keys, _SPREAD], "left")
        .drop(_SPREAD)
    )


def keep_newest(
    rows: DataFrame,
    keys: Sequence[str],
    version: str,
    replacing: DataFrame | None = None,
    spread_by: Sequence[str] | None = None,
) -> DataFrame:
    """Rows that no row of the same key with a higher ``version`` replaces.

    Rows of one key and version stay together; rows with a NULL key are all kept.
    ``replacing`` narrows the rows that can replace others, where that is known.
    """
    newest = F.col(_NEWEST)
    replacing = rows if replacing is None else replacing
    return (
        match_keys(rows, replacing, keys, F.max(version).alias(_NEWEST), spread_by)
        .where(newest.isNull() | (F.col(version) >= newest))
        .drop(_NEWEST)
    )


def duplicate_keys(source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Source keys carried by more than one row."""
    hits = source.where(_all_set(keys)).groupBy(*keys).agg(F.count(F.lit(1)).alias(_HITS))
    return hits.where(F.col(_HITS) > 1).select(*keys)


def key_summary(source: DataFrame, keys: Sequence[str], order: str) -> tuple[int, str | None]:
    """How many rows the most frequent key has, and the least ``order`` of all rows, in one
    pass over both columns. Rows with a NULL key are one group, combined before the shuffle."""
    groups = source.groupBy(*keys).agg(F.count(F.lit(1)).alias(_HITS), F.min(order).alias("first"))
    most = F.max(F.when(_all_set(keys), F.col(_HITS)))
    found = groups.agg(F.coalesce(most, F.lit(0)).alias(_HITS), F.min("first").alias("first"))
    return tuple(found.first())


def ambiguous_keys(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Duplicate source keys that the target holds: the upsert cannot choose between them."""
    doubtful = duplicate_keys(source, keys)
    return target.select(*keys).join(doubtful, list(keys), "left_semi").distinct()


def merge_by_key(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Source rows replace target rows of the same key, others are added, the rest is kept.

    NULL keys never match. Extra source columns are ignored. Evaluating the result fails
    with ``DUPLICATE_SOURCE_KEY`` when two source rows carry a key the target holds; the
    check rides on the join, which sees every matched key with its number of source rows.
    """
    incoming = source.select(*target.columns)
    hits = F.col(_HITS)
    untouched = F.when(
        hits > 1,
        F.raise_error(
            F.concat(F.lit(f"{DUPLICATE_MARK} "), F.to_json(F.struct(*keys)))
        ).cast("boolean"),
    ).otherwise(hits.isNull())
    kept = (
        match_keys(target, incoming, keys, F.count(F.lit(1)).alias(_HITS))
        .where(untouched)
        .select(*target.columns)
    )
    return kept.unionByName(incoming)
