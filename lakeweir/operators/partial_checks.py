"""Check metrics that add up: partial results of parts of a relation, merged into a report.

The counts of a relation are rows ``column``, ``kind``, ``value``, ``n``, as many as its checks
have constraints: rows, values that are not NULL, values of a class, and for a unique column the
values that occur once. Counts of parts add up to those of the whole, and rows that leave a
relation are taken off with the sign -1. Only the values that occur once do not follow from counts:
they need how often each value occurs, its multiplicity, before and after a change, for the values
that changed alone.

Values of a unique column are told apart by their text.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeweir.functions.values import declared_class, in_class
from lakeweir.operators.quality import (
    COMPLETE,
    REPORT,
    UNIQUE,
    Check,
    Constraint,
    judged,
    report_entry,
)
from lakeweir.schemas import record

ROWS, SET, CLASS, SINGLE = "rows", "set", "class", "single"
COUNTS = record(column="string", kind="string", value="string", n="long")
MULTIPLICITIES = record(column="string", value="string", n="long")
KEYS = ("column", "value")
_OLD = "__old"


def _constraints(checks: Iterable[Check], schema: T.StructType) -> list[Constraint]:
    found = {c for check in checks for c in check.constraints if c.column in schema.names}
    return sorted(found, key=lambda c: (c.column, c.kind, c.value_class or ""))


def unique_columns(checks: Iterable[Check], schema: T.StructType) -> list[str]:
    return [c.column for c in _constraints(checks, schema) if c.kind == UNIQUE]


def _classes(checks: Iterable[Check], schema: T.StructType) -> list[tuple[str, str]]:
    """(column, class) pairs that each value must be looked at for."""
    return [
        (c.column, c.value_class)
        for c in _constraints(checks, schema)
        if c.value_class and declared_class(schema[c.column].dataType) is None
    ]


def counts_of(df: DataFrame, checks: Sequence[Check], sign: int = 1) -> DataFrame:
    """All counts of ``df`` but those of values that occur once, from one pass."""
    columns = sorted({c.column for c in _constraints(checks, df.schema)})
    measures: list[tuple[str, str, str | None, Column]] = [("", ROWS, None, F.count(F.lit(1)))]
    measures += [(c, SET, None, F.count(c)) for c in columns]
    measures += [
        (c, CLASS, wanted, F.count_if(in_class(F.col(c), wanted)))
        for c, wanted in _classes(checks, df.schema)
    ]
    wide = df.agg(*[m.alias(f"m{i}") for i, (*_, m) in enumerate(measures)])
    entries = [
        F.struct(
            F.lit(column).alias("column"),
            F.lit(kind).alias("kind"),
            F.lit(value).cast("string").alias("value"),
            (F.col(f"m{i}") * sign).alias("n"),
        )
        for i, (column, kind, value, _) in enumerate(measures)
    ]
    return wide.select(F.inline(F.array(*entries)))


def multiplicities_of(df: DataFrame, checks: Sequence[Check], sign: int = 1) -> DataFrame:
    """How often each value of the unique columns occurs, times ``sign``."""
    parts = []
    for name in unique_columns(checks, df.schema):
        value = F.col(name)
        if isinstance(df.schema[name].dataType, T.FractionalType):
            value = value + F.lit(0).cast(df.schema[name].dataType)  # one zero, without a sign
        parts.append(
            df.where(F.col(name).isNotNull())
            .groupBy(value.cast("string").alias("value"))
            .agg((F.count(F.lit(1)) * sign).alias("n"))
            .select(F.lit(name).alias("column"), "value", "n")
        )
    empty = df.sparkSession.createDataFrame([], MULTIPLICITIES)
    return reduce(DataFrame.unionByName, parts) if parts else empty


def merged(parts: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """The sum of counts or multiplicities; what comes to nothing is left out."""
    both = reduce(DataFrame.unionByName, parts)
    total = both.groupBy(*keys).agg(F.sum("n").alias("n"))
    return total.where(F.col("n") != 0).select(*keys, "n")


def merged_counts(*parts: DataFrame) -> DataFrame:
    return merged(parts, COUNTS.names[:-1])


def merged_multiplicities(*parts: DataFrame) -> DataFrame:
    return merged(parts, KEYS)


def single_values(multiplicities: DataFrame) -> DataFrame:
    """Counts of the values that occur once."""
    return _single(multiplicities, F.count_if(F.col("n") == 1))


def changed_multiplicities(held: DataFrame, delta: DataFrame) -> DataFrame:
    """``delta`` applied: the new ``n`` of each changed value, and the one before, ``__old``.

    ``held`` is read for the values of ``delta`` only; nothing else of it moves.
    """
    before = held.select(*KEYS, F.col("n").alias(_OLD))
    both = delta.join(before, list(KEYS), "left")
    old = F.coalesce(_OLD, F.lit(0))
    return both.select(*KEYS, (F.col("n") + old).alias("n"), old.alias(_OLD))


def single_changes(changed: DataFrame) -> DataFrame:
    """What :func:`changed_multiplicities` does to the counts of values that occur once."""
    now, before = F.count_if(F.col("n") == 1), F.count_if(F.col(_OLD) == 1)
    return _single(changed, now - before)


def _single(rows: DataFrame, measure: Column) -> DataFrame:
    return rows.groupBy("column").agg(measure.alias("n")).select(
        "column", F.lit(SINGLE).alias("kind"), F.lit(None).cast("string").alias("value"), "n"
    )


def report_of(counts: DataFrame, checks: Sequence[Check], schema: T.StructType) -> DataFrame:
    """The report that :func:`quality.verify` gives for the whole relation, from its counts."""
    pairs = [(check, constraint) for check in checks for constraint in check.constraints]
    if not pairs:
        return counts.sparkSession.createDataFrame([], REPORT)

    def total(column: str, kind: str, value: str | None = None) -> Column:
        own = (F.col("column") == column) & (F.col("kind") == kind)
        if value is not None:
            own = own & (F.col("value") == value)
        return F.coalesce(F.sum(F.when(own, F.col("n"))), F.lit(0)).cast("double")

    def metric(c: Constraint) -> Column:
        if c.column not in schema.names:
            return F.lit(None)
        if c.kind == COMPLETE:
            return F.try_divide(total(c.column, SET), total("", ROWS))
        if c.kind == UNIQUE:
            return F.try_divide(total(c.column, SINGLE), total(c.column, SET))
        known = declared_class(schema[c.column].dataType)
        if known is None:
            hits = total(c.column, CLASS, c.value_class)
        else:
            hits = total(c.column, SET) if known == c.value_class else F.lit(0.0)
        return F.try_divide(hits, total(c.column, SET))

    wide = counts.agg(*[metric(c).cast("double").alias(f"m{i}") for i, (_, c) in enumerate(pairs)])
    entries = [report_entry(check, c, F.col(f"m{i}")) for i, (check, c) in enumerate(pairs)]
    missing = sorted({c.column for _, c in pairs} - set(schema.names))
    return judged(wide.select(F.inline(F.array(*entries))), missing)
