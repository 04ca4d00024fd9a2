"""Projection and cleaning of a raw relation."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeweir.functions.values import tolerant_cast

_RANK = "__rank"


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Exactly the declared columns: cast where possible, NULL where absent or unreadable."""
    present = set(df.columns)
    return df.select(
        *[
            (
                tolerant_cast(F.col(f"`{field.name}`"), field.dataType)
                if field.name in present
                else F.lit(None).cast(field.dataType)
            ).alias(field.name)
            for field in schema
        ]
    )


def stamp(df: DataFrame, name: str, as_of=None) -> DataFrame:
    """Add an audit timestamp: ``as_of`` when given, else the start of the query."""
    moment = F.current_timestamp() if as_of is None else F.lit(as_of).cast("timestamp")
    return df.withColumn(name, moment)


def is_empty(df: DataFrame) -> bool:
    return df.isEmpty()


def dedupe_latest(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[Column | str],
    keys_set: bool = False,
) -> DataFrame:
    """The first row of every key under ``order_by``; rows with a NULL key are all kept.

    ``keys_set`` says that no key is NULL, which saves a second scan for those rows; where
    one is after all, the rows without it count as one key.

    ``row_number() = 1`` lets Spark cut every group to one row before the shuffle, so a
    key that holds a large share of the rows sends one row per task.
    """
    keyed = F.lit(True)
    for key in keys:
        keyed = keyed & F.col(key).isNotNull()
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order_by))
    rows = df if keys_set else df.where(keyed)
    first = rows.withColumn(_RANK, rank).where(F.col(_RANK) == 1).drop(_RANK)
    return first if keys_set else first.unionByName(df.where(~keyed))
