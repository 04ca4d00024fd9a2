"""Declarative data-quality checks that report as a DataFrame."""

from __future__ import annotations

import logging
from collections.abc import Iterable, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeweir.errors import QualityGateError, SchemaCheckFailed
from lakeweir.functions.values import VALUE_CLASSES, declared_class, in_class, value_class
from lakeweir.schemas import record

log = logging.getLogger(__name__)

ERROR, WARNING = "error", "warning"
SUCCESS, FAILURE = "success", "failure"
UNIQUE, COMPLETE, DATA_TYPE = "unique", "complete", "data_type"
UNKNOWN = "Unknown"

REPORT = record(
    check="string",
    level="string",
    column="string",
    constraint="string",
    metric="double",
    status="string",
    message="string",
)
SCHEMA_REPORT = record(
    field="string", problem="string", expected="string", actual="string"
)


# -- schema ----------------------------------------------------------------------------


def schema_problems(
    actual: T.StructType, expected: T.StructType
) -> list[tuple[str, str, str | None, str | None]]:
    """Missing fields, fields of another type class, and fields not expected."""
    found = {field.name: field.dataType for field in actual}
    wanted = {field.name: field.dataType for field in expected}
    problems = []
    for name, data_type in wanted.items():
        if name not in found:
            problems.append((name, "missing", data_type.simpleString(), None))
        elif type(found[name]) is not type(data_type):
            problems.append(
                (name, "type", data_type.simpleString(), found[name].simpleString())
            )
    extra = sorted(found.keys() - wanted.keys())
    return problems + [(name, "extra", None, found[name].simpleString()) for name in extra]


def schema_report(df: DataFrame, expected: T.StructType) -> DataFrame:
    return df.sparkSession.createDataFrame(schema_problems(df.schema, expected), SCHEMA_REPORT)


def require_schema(actual: T.StructType, expected: T.StructType) -> None:
    problems = schema_problems(actual, expected)
    if problems:
        raise SchemaCheckFailed(dict(zip(SCHEMA_REPORT.names, row)) for row in problems)


# -- checks ----------------------------------------------------------------------------


@dataclass(frozen=True)
class Constraint:
    kind: str
    column: str
    value_class: str | None = None

    @property
    def label(self) -> str:
        return f"{self.kind}[{self.value_class}]" if self.value_class else self.kind


@dataclass(frozen=True)
class Check:
    """A named list of constraints; every method returns a longer check."""

    name: str
    level: str = ERROR
    constraints: tuple[Constraint, ...] = ()

    def _and(self, *more: Constraint) -> Check:
        return replace(self, constraints=self.constraints + more)

    def is_unique(self, column: str) -> Check:
        return self._and(Constraint(UNIQUE, column))

    def is_complete(self, *columns: str) -> Check:
        return self._and(*[Constraint(COMPLETE, column) for column in columns])

    def has_data_type(self, value_class: str, *columns: str) -> Check:
        if value_class not in VALUE_CLASSES:
            raise ValueError(f"unknown value class {value_class!r}")
        return self._and(*[Constraint(DATA_TYPE, column, value_class) for column in columns])


# -- metrics ---------------------------------------------------------------------------


def row_count(df: DataFrame, name: str = "n_rows") -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(name))


def complete_share(column: str) -> Column:
    """Share of rows that are not NULL; NULL for an empty relation."""
    return F.try_divide(F.count(column).cast("double"), F.count(F.lit(1)).cast("double"))


def class_share(df: DataFrame, column: str, wanted: str) -> Column:
    """Share of the non-NULL values that belong to a class; NULL when there are none."""
    known = declared_class(df.schema[column].dataType)
    if known:  # the type decides, no value is inspected
        hits = F.count(column) if known == wanted else F.lit(0)
    else:
        hits = F.count_if(in_class(F.col(column), wanted))
    return F.try_divide(hits.cast("double"), F.count(column).cast("double"))


def completeness(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per column: share of non-NULL values, from one pass."""
    wide = df.agg(*[complete_share(c).alias(f"m{i}") for i, c in enumerate(columns)])
    return wide.select(
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(c).alias("column"), F.col(f"m{i}").alias("metric"))
                    for i, c in enumerate(columns)
                ]
            )
        )
    )


def uniqueness(df: DataFrame, column: str, by_digest: bool = False) -> DataFrame:
    """One row: share of the non-NULL rows whose value occurs exactly once.

    ``by_digest`` shuffles SHA-256 digests in place of the values, for long texts.
    """
    value = F.unhex(F.sha2(column, 256)) if by_digest else F.col(column)
    occurrences = (
        df.where(F.col(column).isNotNull())
        .groupBy(value.alias("value"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return occurrences.agg(
        F.try_divide(
            F.count_if(F.col("n") == 1).cast("double"), F.sum("n").cast("double")
        ).alias("metric")
    ).select(F.lit(column).alias("column"), "metric")


def data_type_profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Rows per column and value class (``Unknown`` for NULL), from one pass.

    Every class of every column is a counter of one aggregate; no row is multiplied.
    """
    classes = {
        f"k{i}": F.coalesce(value_class(F.col(c), df.schema[c].dataType), F.lit(UNKNOWN))
        for i, c in enumerate(columns)
    }
    counters = [(i, cls) for i in range(len(columns)) for cls in (*VALUE_CLASSES, UNKNOWN)]
    wide = df.select(*[expr.alias(name) for name, expr in classes.items()]).agg(
        *[F.count_if(F.col(f"k{i}") == cls).alias(f"n{i}{cls}") for i, cls in counters]
    )
    return wide.select(
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(columns[i]).alias("column"),
                        F.lit(cls).alias("value_class"),
                        F.col(f"n{i}{cls}").alias("n_values"),
                    )
                    for i, cls in counters
                ]
            )
        )
    ).where(F.col("n_values") > 0)


# -- suite -----------------------------------------------------------------------------


def report_entry(check: Check, constraint: Constraint, metric: Column) -> Column:
    return F.struct(
        F.lit(check.name).alias("check"),
        F.lit(check.level).alias("level"),
        F.lit(constraint.column).alias("column"),
        F.lit(constraint.label).alias("constraint"),
        metric.cast("double").alias("metric"),
    )


def verify(df: DataFrame, checks: Iterable[Check]) -> DataFrame:
    """One report row per constraint.

    All scalar constraints share one aggregate over one scan. Every column with a
    uniqueness constraint adds one scan of that column and one shuffle of its values.
    """
    pairs = [(check, constraint) for check in checks for constraint in check.constraints]
    if not pairs:
        return df.sparkSession.createDataFrame([], REPORT)
    absent = F.lit(None)
    scalar, entries, unique = {}, [], {}
    for check, constraint in pairs:
        column = constraint.column
        if column not in df.columns:
            entries.append(report_entry(check, constraint, absent))
        elif constraint.kind == UNIQUE:
            unique.setdefault(column, []).append((check, constraint))
        else:
            key = (constraint.kind, column, constraint.value_class)
            if key not in scalar:
                expr = (
                    complete_share(column)
                    if constraint.kind == COMPLETE
                    else class_share(df, column, constraint.value_class)
                )
                scalar[key] = (f"m{len(scalar)}", expr)
            entries.append(report_entry(check, constraint, F.col(scalar[key][0])))

    parts = []
    if entries:
        measures = [expr.alias(name) for name, expr in scalar.values()]
        wide = df.agg(*measures or [F.count(F.lit(1)).alias("n_rows")])
        parts.append(wide.select(F.inline(F.array(*entries))))
    for column, users in unique.items():
        metric = F.col("metric")
        parts.append(
            uniqueness(df, column).select(
                F.inline(F.array(*[report_entry(check, c, metric) for check, c in users]))
            )
        )
    report = parts[0]
    for part in parts[1:]:
        report = report.unionByName(part)

    return judged(report, sorted({c.column for _, c in pairs} - set(df.columns)))


def judged(report: DataFrame, missing: Sequence[str]) -> DataFrame:
    """A report of measured constraints with their status; columns in ``missing`` do not exist."""
    passed = F.coalesce(F.col("metric") == 1.0, F.lit(False))
    return report.withColumn("status", F.when(passed, SUCCESS).otherwise(FAILURE)).withColumn(
        "message",
        F.when(passed, "")
        .when(F.col("column").isin(missing), "no such column")
        .when(F.col("metric").isNull(), "nothing to measure")
        .otherwise("metric is not 1.0"),
    )


def failures(report: DataFrame) -> DataFrame:
    return report.where((F.col("level") == ERROR) & (F.col("status") == FAILURE))


def publish_if_passed(df: DataFrame, report: DataFrame) -> DataFrame:
    """``df`` when no error-level constraint failed, else no rows. Stays lazy."""
    return df.where(~failures(report).exists())


def gate(report: DataFrame) -> DataFrame:
    """Raise when an error-level constraint failed; warnings pass.

    Evaluates the report once (one row per constraint, whatever the data size), logs it
    and returns it as a relation that does not touch the data again.
    """
    rows = report.collect()
    for row in rows:
        log.info("%s: %s(%s) %s %s", row.check, row.constraint, row.column, row.status, row.message)
    failed = [r.asDict() for r in rows if r.level == ERROR and r.status == FAILURE]
    if failed:
        raise QualityGateError(failed)
    return report.sparkSession.createDataFrame(rows, REPORT)
