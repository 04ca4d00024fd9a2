"""Column expressions on texts that several corpus operators share."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The six ASCII white-space characters (tab to carriage return, and space).
SPACES = " \t\n\x0b\f\r"
SPACE_RUN = r"[\x20\x09-\x0D]+"


def documents(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet").select(*(columns or ("*",)))


def text_of(column: str = "text") -> Column:
    """The text, empty where it is null."""
    return F.coalesce(F.col(column), F.lit(""))


def words_of(text: Column) -> Column:
    """The maximal runs of characters other than ASCII white space, in order."""
    trimmed = F.trim(text, F.lit(SPACES))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(
        F.split(trimmed, SPACE_RUN)
    )


def ascii_lower(text: Column) -> Column:
    """A to Z in lower case, all else as it is."""
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def count_of(text: Column, characters: str) -> Column:
    """How many characters of ``text`` are among these ASCII ``characters``."""
    rest = text
    for character in characters:
        rest = F.replace(rest, F.lit(character), F.lit(""))
    return F.octet_length(text) - F.octet_length(rest)


def slices(batch, column: int, rows: int, size: int) -> Iterator:
    """An Arrow batch cut into runs of at most ``rows`` rows and, but for a single longer one,
    ``size`` bytes of the given binary column."""
    import numpy as np
    import pyarrow.compute as pc

    lengths = pc.binary_length(batch.column(column)).fill_null(0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(lengths)
    start = 0
    while start < batch.num_rows:
        before = ends[start - 1] if start else 0
        stop = int(np.searchsorted(ends, before + size, side="right"))
        stop = min(max(stop, start + 1), start + rows)
        yield batch.slice(start, stop - start)
        start = stop
