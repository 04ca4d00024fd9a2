"""Scan of the raw JSON files of one run."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeweir.errors import SourceUnreadable
from lakeweir.schemas import CORRUPT, RAW


def read_raw_json(
    spark: SparkSession,
    path: str | list[str],
    schema: T.StructType = RAW,
    layout: str = "lines",
) -> DataFrame:
    """Raw records with every field as text and damaged input kept in ``_corrupt_record``.

    ``lines`` is one object per line, which Spark can split. ``pages`` is one JSON array
    per file; such a file is read by one task, and if it is damaged it is one corrupt row.
    """
    if layout not in ("lines", "pages"):
        raise ValueError(f"unknown layout {layout!r}")
    try:
        return (
            spark.read.schema(schema)
            .option("mode", "PERMISSIVE")
            .option("columnNameOfCorruptRecord", CORRUPT)
            .option("multiLine", layout == "pages")
            .json(path)
        )
    except AnalysisException as error:
        raise SourceUnreadable(f"cannot read raw records at {path}: {error}") from error


def split_corrupt(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good rows without the corrupt slot, damaged rows). Give it a written relation."""
    good = df.where(F.col(CORRUPT).isNull()).drop(CORRUPT)
    return good, df.where(F.col(CORRUPT).isNotNull()).select(CORRUPT)


def complete_records(body: Column) -> Column:
    """The texts of the whole objects of a JSON array, up to where it is damaged.

    Brackets outside of strings are counted along the text; an object counts once its own
    bracket closes inside the array. A text that is no array has none. Meant for pages of some
    hundred records: the list of cuts is copied for each.
    """
    # an escaped character is masked by two others, so that quotes come in pairs and places stay
    masked = F.regexp_replace(body, r"(?s)\\.", "__")
    tokens = F.regexp_extract_all(masked, F.lit(r'"[^"]*"?|[\[\]{}]|[^"\[\]{}]+'), F.lit(0))
    number = F.lit(0).cast("int")
    nothing = F.array().cast("array<struct<start:int,length:int>>")
    begin = F.struct(
        F.lit(1).alias("at"), number.alias("depth"), number.alias("start"), nothing.alias("found")
    )

    def step(seen: Column, token: Column) -> Column:
        opens = token.isin("[", "{")
        closes = token.isin("]", "}")
        depth = seen["depth"] + F.when(opens, 1).when(closes, -1).otherwise(0)
        starts = (token == "{") & (seen["depth"] == 1)
        ends = (token == "}") & (depth == 1) & (seen["start"] > 0)
        own = F.struct(
            seen["start"].alias("start"), (seen["at"] + 1 - seen["start"]).alias("length")
        )
        # a text that does not begin with the bracket of an array never gets to a start
        first = (seen["depth"] == 0) & (token != "[") & token.rlike(r"\S")
        return F.struct(
            (seen["at"] + F.char_length(token)).alias("at"),
            F.when(first, -(2**30)).otherwise(depth).alias("depth"),
            F.when(starts, seen["at"]).when(ends, 0).otherwise(seen["start"]).alias("start"),
            F.when(ends, F.concat(seen["found"], F.array(own)))
            .otherwise(seen["found"])
            .alias("found"),
        )

    cuts = F.aggregate(tokens, begin, step, lambda seen: seen["found"])
    return F.transform(cuts, lambda cut: F.substring(body, cut["start"], cut["length"]))


def salvaged(damaged: DataFrame, schema: T.StructType, slot: str = CORRUPT) -> DataFrame:
    """The records that :func:`complete_records` finds in damaged array pages, read by ``schema``.

    What follows a record that cannot be read is left: brackets there may not mean what they
    seem to. Damaged texts that are no arrays give nothing.
    """
    fields = [f.name for f in schema if f.name != CORRUPT]
    others = [c for c in damaged.columns if c not in (slot, *fields)]
    shape = T.StructType([schema[name] for name in fields]).add(CORRUPT, "string")
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    read = F.transform(
        complete_records(F.col(slot)), lambda text: F.from_json(text, shape, options)
    )
    pages = damaged.where(F.col(slot).isNotNull()).select(*others, read.alias("__read"))
    broken = F.array_position(F.transform("__read", lambda r: r[CORRUPT].isNotNull()), True)
    rows = pages.select(
        *others, broken.alias("__broken"), F.posexplode("__read").alias("__place", "__record")
    )
    whole = (F.col("__broken") == 0) | (F.col("__place") < F.col("__broken") - 1)
    return rows.where(whole).select(
        *others, *[F.col(f"__record.`{name}`").alias(name) for name in fields]
    )
