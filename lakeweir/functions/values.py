"""Value-level expressions: tolerant casts and value classes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# How a text value is classified, tried in this order; other text is "String".
VALUE_PATTERNS = (
    ("Fractional", r"^(-|\+)? ?\d*\.\d*\z"),
    ("Integral", r"^(-|\+)? ?\d*\z"),
    ("Boolean", r"^(true|false)\z"),
)
VALUE_CLASSES = ("Fractional", "Integral", "Boolean", "String")


def tolerant_cast(column: Column, data_type: T.DataType) -> Column:
    """Cast that yields NULL for unreadable input, in ANSI mode too."""
    return column.try_cast(data_type)


def declared_class(data_type: T.DataType) -> str | None:
    """Class that the column type alone decides; None when each value must be looked at."""
    if isinstance(data_type, T.FractionalType):
        return "Fractional"
    if isinstance(data_type, T.IntegralType):
        return "Integral"
    if isinstance(data_type, T.BooleanType):
        return "Boolean"
    return None


def value_class(column: Column, data_type: T.DataType) -> Column:
    """Class of a value, NULL for a NULL value."""
    known = declared_class(data_type)
    if known:
        return F.when(column.isNotNull(), F.lit(known))
    text = column.cast("string")
    expr = F.when(text.isNull(), F.lit(None).cast("string"))
    for name, pattern in VALUE_PATTERNS:
        expr = expr.when(text.rlike(pattern), F.lit(name))
    return expr.otherwise(F.lit("String"))


def in_class(column: Column, wanted: str) -> Column:
    """Whether a value read as text is of a class. No text is of two, so that the pattern of
    the class alone decides; "String" is what no pattern takes."""
    text = column.cast("string")
    patterns = dict(VALUE_PATTERNS)
    if wanted in patterns:
        return text.rlike(patterns[wanted])
    return ~text.rlike("|".join(patterns.values()))


def blank_to_null(column: Column) -> Column:
    return F.when(column != "", column)
