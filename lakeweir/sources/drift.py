"""What raw runs hold beyond, or unlike, the declared record schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeweir.functions.runs import RUN_FORMAT, run_time

UNDECLARED, CHANGED, ABSENT = "undeclared", "changed", "absent"
_NUMBERS = ("BIGINT", "DECIMAL", "DOUBLE", "FLOAT", "INT", "SMALLINT", "TINYINT")


def raw_texts(spark: SparkSession, data_root: str, layout: str = "lines") -> DataFrame:
    """``run`` and ``record``, the JSON texts of all runs below ``data_root``; a damaged page is
    one text."""
    path = F.split(F.col("_metadata.file_path"), "/")
    run = F.element_at(path, -2).alias("run")
    texts = spark.read.option("wholetext", layout == "pages").text(f"{data_root.rstrip('/')}/*")
    if layout == "lines":
        return texts.select(run, F.col("value").alias("record"))
    records = F.from_json("value", T.ArrayType(T.StringType()))
    whole = F.coalesce(records, F.array("value"))
    return texts.select(run, F.explode(whole).alias("record"))


def json_kind(schema: Column) -> Column:
    """The kind of JSON value that a variant's schema stands for."""
    name = F.regexp_extract(schema, "^[A-Z]+", 0)
    return (
        F.when(name.isin(*_NUMBERS), "number")
        .when(name == "VOID", "null")
        .otherwise(F.lower(name))
    )


def field_kinds(texts: DataFrame) -> DataFrame:
    """``run``, ``field``, ``kind`` and ``n``, the records of the run with such a value.

    Records are parsed as VARIANT, whatever their fields; kinds are counted before the shuffle,
    so what moves is a row per run, field and kind of a task. Unreadable records are one field
    without a name.
    """
    parsed = texts.select("run", F.try_parse_json("record").alias("value"))
    inside = texts.sparkSession.tvf.variant_explode(F.col("value").outer())
    fields = parsed.where("value IS NOT NULL").lateralJoin(inside.toDF("pos", "key", "inside"))
    kind = json_kind(F.schema_of_variant("inside"))
    kinds = fields.where("key IS NOT NULL").select(
        "run", F.col("key").alias("field"), kind.alias("kind")
    )
    broken = parsed.where("value IS NULL").select(
        "run", F.lit(None).cast("string").alias("field"), F.lit("damaged").alias("kind")
    )
    return kinds.unionByName(broken).groupBy("run", "field", "kind").agg(
        F.count(F.lit(1)).alias("n")
    )


def drift(
    texts: DataFrame, declared: T.StructType, run_format: str = RUN_FORMAT
) -> DataFrame:
    """One row per run, field and problem: ``undeclared`` (not in ``declared``), ``changed`` (of
    other kinds than in the run before that had it) and ``absent`` (declared, in an earlier run,
    and in no record of this one), with the ``kinds`` found, those ``before``, and ``n_records``.

    Nulls have no kind of their own. Folders that are no runs are ignored.
    """
    is_run = run_time(F.col("run"), run_format).isNotNull()
    # from here on there is a row per run and field
    counted = field_kinds(texts.where(is_run)).where("field IS NOT NULL")
    kinds = F.collect_set(F.when(F.col("kind") != "null", F.col("kind")))
    named = F.array_join(F.array_sort(kinds), ",")
    found = counted.groupBy("run", "field").agg(
        F.nullif(named, F.lit("")).alias("kinds"), F.sum("n").alias("n_records")
    )
    order = Window.orderBy("run")
    runs = texts.where(is_run).select("run").distinct().withColumn("at", F.row_number().over(order))
    seen = found.join(runs, "run")
    in_turn = Window.partitionBy("field").orderBy("at")
    earlier = in_turn.rowsBetween(Window.unboundedPreceding, -1)
    last = runs.agg(F.max("at")).scalar()
    seen = seen.withColumn("before", F.last("kinds", ignorenulls=True).over(earlier)).withColumn(
        "until", F.coalesce(F.lead("at").over(in_turn) - 1, last)
    )
    gaps = seen.where("until > at").select(
        "field",
        F.explode(F.sequence(F.col("at") + 1, F.col("until"))).alias("at"),
        F.lit(None).cast("string").alias("kinds"),
        F.lit(None).cast("long").alias("n_records"),
        F.coalesce("kinds", "before").alias("before"),
    )
    grid = seen.select("run", "field", "kinds", "n_records", "before").unionByName(
        gaps.join(runs, "at").drop("at")
    )
    is_declared = F.col("field").isin(*declared.names)
    problems = F.array_compact(
        F.array(
            F.when(F.col("n_records").isNotNull() & ~is_declared, UNDECLARED),
            F.when(F.col("kinds") != F.col("before"), CHANGED),
            F.when(F.col("n_records").isNull() & is_declared, ABSENT),
        )
    )
    return grid.select(
        "run",
        "field",
        F.explode(problems).alias("problem"),
        "kinds",
        "before",
        F.coalesce("n_records", F.lit(0)).alias("n_records"),
    )
