"""Discovery of run folders."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeweir.functions.runs import RUN_FORMAT, basename, run_time
from lakeweir.sources import storage


def latest_of(
    runs: DataFrame, column: str, fmt: str = RUN_FORMAT, as_of: str | None = None
) -> DataFrame:
    """One row ``run``: the entry whose name stands for the latest time.

    ``column`` holds names or paths. Names that do not follow ``fmt`` are skipped;
    ``as_of`` (a run name) ignores later runs.
    """
    moment = run_time(basename(F.col(column)), fmt)
    named = runs.select(F.col(column).alias("run"), moment.alias("at"))
    named = named.where(F.col("at").isNotNull())
    if as_of is not None:
        named = named.where(F.col("at") <= run_time(F.lit(as_of), fmt))
    return named.agg(F.max_by("run", "at").alias("run"))


def latest_run(
    spark: SparkSession, root: str, fmt: str = RUN_FORMAT, as_of: str | None = None
) -> str | None:
    """Path of the latest run folder under ``root``, None if no name can be read."""
    names = storage.child_folders(spark, root)
    if not names:
        return None
    runs = spark.createDataFrame([(name,) for name in names], "name string")
    name = latest_of(runs, "name", fmt, as_of).first()["run"]
    return None if name is None else f"{root.rstrip('/')}/{name}"


def runs_until(
    spark: SparkSession, root: str, fmt: str = RUN_FORMAT, as_of: str | None = None
) -> list[str]:
    """Names of the run folders under ``root`` up to ``as_of``, oldest first."""
    names = storage.child_folders(spark, root)
    if not names:
        return []
    runs = spark.createDataFrame([(name,) for name in names], "name string")
    moment = run_time(F.col("name"), fmt)
    until = F.lit(True) if as_of is None else moment <= run_time(F.lit(as_of), fmt)
    ordered = runs.where(moment.isNotNull() & until).orderBy(moment, "name")
    return [row["name"] for row in ordered.collect()]
