"""High-water-mark filters and page bookkeeping."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeweir.sources.scratch import written

_AT, _PART, _POS, _BEFORE, _ROWS = "__at", "__part", "__pos", "__before", "__rows"
_NO_STOP = 2**63 - 1
_POSITION_BITS = 33  # monotonically_increasing_id keeps the row position in its low 33 bits


def newer_than(df: DataFrame, key: str, mark) -> DataFrame:
    """Rows whose key is above ``mark`` (a value, a column or a scalar subquery).

    Text keys compare as text, so an id that sorts below the mark is never picked up.
    """
    return df.where(F.col(key) > (mark if isinstance(mark, Column) else F.lit(mark)))


def new_watermark(df: DataFrame, key: str, previous=None, name: str = "max_id") -> DataFrame:
    """One row: the highest key of ``df``, or ``previous`` when there is none."""
    previous = previous if isinstance(previous, Column) else F.lit(previous)
    return df.agg(F.coalesce(F.max(key), previous).alias(name))


def assign_pages(
    df: DataFrame,
    order_by: Sequence[Column | str],
    per_page: int,
    *,
    page: str = "page",
    partitions: int | None = None,
    unique: bool = False,
) -> DataFrame:
    """Number the pages that a server sorting by ``order_by`` would cut.

    Rows are range-partitioned and sorted in parallel. The position inside a partition
    plus the rows before the partition give the global position, without a one-task
    window. The sorted relation is written once, because bounds drawn by a second
    evaluation could differ. Rows carry their input position as a last sort column, so a
    value shared by many rows does not end up in one partition. ``unique=True`` saves the
    copy this takes, for orders that are known to have no ties.
    """
    order = list(order_by)
    rows = df
    if not unique:
        rows = written(df, "paging-input").withColumn(_AT, F.monotonically_increasing_id())
        order = [*order, F.col(_AT)]
    ranged = (
        rows.repartitionByRange(partitions, *order)
        if partitions
        else rows.repartitionByRange(*order)
    )
    placed = (
        ranged.sortWithinPartitions(*order)
        .withColumn(_AT, F.monotonically_increasing_id())
        .withColumn(_PART, F.shiftright(_AT, _POSITION_BITS))
        .withColumn(_POS, F.col(_AT).bitwiseAND(F.lit((1 << _POSITION_BITS) - 1)))
        .drop(_AT)
    )
    placed = written(placed, "paging")
    sizes = placed.groupBy(_PART).agg(F.count(F.lit(1)).alias(_ROWS))
    earlier = Window.orderBy(_PART).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        _PART, F.coalesce(F.sum(_ROWS).over(earlier), F.lit(0)).alias(_BEFORE)
    )
    # offsets has one row per range partition, so its size is known to be small
    return (
        placed.join(F.broadcast(offsets), _PART)
        .withColumn(page, F.expr(f"({_BEFORE} + {_POS}) div {int(per_page)} + 1"))
        .drop(_PART, _POS, _BEFORE)
    )


def stop_page(pages: DataFrame, counts: Column, page: str = "page") -> DataFrame:
    """One row with the first page for which ``counts`` is zero; NULL when there is none."""
    return pages.agg(F.min(F.when(counts == 0, F.col(page))).alias("stop"))


def before_stop(
    df: DataFrame, stop: DataFrame, page: str = "page", max_pages: int | None = None
) -> DataFrame:
    """Rows of the pages before the stop page, within the page bound if there is one."""
    kept = df.where(F.col(page) < F.coalesce(stop.scalar(), F.lit(_NO_STOP)))
    return kept if max_pages is None else kept.where(F.col(page) <= max_pages)


def pages_until_known(
    pages: DataFrame,
    key: str,
    mark,
    page: str = "page",
    max_pages: int | None = None,
) -> DataFrame:
    """New rows of the pages before the first page that holds no new row."""
    mark = mark if isinstance(mark, Column) else F.lit(mark)
    fresh = F.count(F.when(F.col(key) > mark, 1)).alias("fresh")
    per_page = pages.groupBy(page).agg(fresh)
    return newer_than(
        before_stop(pages, stop_page(per_page, F.col("fresh"), page), page, max_pages), key, mark
    )
