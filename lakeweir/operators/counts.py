"""Aggregate marts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def count_by(df: DataFrame, columns: Sequence[str], name: str = "n") -> DataFrame:
    """Rows per group; NULL is a group of its own."""
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias(name))


def rollup_count(
    df: DataFrame, columns: Sequence[str], name: str = "n", level: str = "level"
) -> DataFrame:
    """Counts at every prefix of ``columns``; ``level`` is the grouping id (0 = finest).

    Rows are counted at the finest grain first, so the rollup expands groups, not rows.
    """
    finest = count_by(df, columns, name)
    return finest.rollup(*columns).agg(
        F.grouping_id().alias(level), F.sum(name).alias(name)
    )


def signed_counts(
    added: DataFrame, removed: DataFrame, columns: Sequence[str], name: str = "n"
) -> DataFrame:
    """Rows added less rows removed per group; groups that stay as large do not appear."""
    plus = added.select(*columns, F.lit(1).cast("long").alias(name))
    minus = removed.select(*columns, F.lit(-1).cast("long").alias(name))
    return apply_counts(plus, minus, columns, name, F.col(name) != 0)


def apply_counts(
    counts: DataFrame,
    delta: DataFrame,
    columns: Sequence[str],
    name: str = "n",
    keep: Column | None = None,
) -> DataFrame:
    """``counts`` with the signed counts of ``delta`` added; groups without rows go."""
    both = counts.select(*columns, name).unionByName(delta.select(*columns, name))
    total = both.groupBy(*columns).agg(F.sum(name).alias(name))
    return total.where(F.col(name) > 0 if keep is None else keep)


def rollup_shares(
    df: DataFrame,
    columns: Sequence[str],
    name: str = "n",
    share: str = "share",
    level: str = "level",
) -> DataFrame:
    """:func:`rollup_count` with the share of each group in its parent, the group without its
    last column; the whole relation has the share one.

    Groups of one parent are the groups of their level that agree in all columns but the last
    one in use, so the shares take a window over groups, not over rows.
    """
    counted = rollup_count(df, columns, name, level)
    # grouping ids set a bit per column rolled up: at most these ids leave a later column in use
    parent = [
        F.when(F.col(level) < 2 ** (len(columns) - 1 - at), F.col(column))
        for at, column in enumerate(columns[:-1], 1)
    ]
    siblings = Window.partitionBy(level, *parent)
    return counted.withColumn(share, F.col(name) / F.sum(name).over(siblings))
