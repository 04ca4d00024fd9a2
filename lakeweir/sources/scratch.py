"""Written intermediate tables in the shared checkpoint folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar
from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession

from lakeweir.sources import storage

CHECKPOINT_DIR = "spark.checkpoint.dir"
_areas: ContextVar[list[str] | None] = ContextVar("areas", default=None)


def checkpoint_root(spark: SparkSession) -> str:
    """The folder the cluster names; a temporary one only for a local session without it."""
    root = spark.conf.get(CHECKPOINT_DIR, None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {CHECKPOINT_DIR} to a folder all executors share")
    return _local_root(spark.sparkContext.applicationId)


@lru_cache
def _local_root(application_id: str) -> str:
    return tempfile.mkdtemp(prefix=f"lakeweir-{application_id}-")


def _application_root(spark: SparkSession) -> str:
    return f"{checkpoint_root(spark)}/lakeweir/{spark.sparkContext.applicationId}"


def new_area(spark: SparkSession, name: str) -> str:
    """A fresh folder path for this application below the checkpoint folder."""
    path = f"{_application_root(spark)}/{name}-{uuid.uuid4().hex}"
    areas = _areas.get()
    if areas is not None:
        areas.append(path)
    return path


@contextmanager
def scope(spark: SparkSession) -> Iterator[None]:
    """Remove at the end whatever was written here inside: relations made in it are to be
    used in it. A long session puts each piece of work into one."""
    token = _areas.set([])
    try:
        yield
    finally:
        areas = _areas.get()
        _areas.reset(token)
        for path in areas:
            storage.remove(spark, path)


def clear(spark: SparkSession) -> None:
    """Remove what this application wrote here, once no relation over it is needed."""
    storage.remove(spark, _application_root(spark))


def _write_and_read(df: DataFrame, path: str) -> DataFrame:
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet and read back.

    Cuts the lineage in storage that survives executor loss, keeps column pruning for
    later readers, and gives the planner a real size to choose joins by.
    """
    return _write_and_read(df, new_area(df.sparkSession, name))


def planned_bytes(df: DataFrame) -> int:
    """Size of a relation as the planner sees it, the figure it picks broadcasts by."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


@contextmanager
def staged(df: DataFrame, name: str) -> Iterator[DataFrame]:
    """Like :func:`written`, for use inside one eager step; the copy is removed after it."""
    path = new_area(df.sparkSession, name)
    try:
        yield _write_and_read(df, path)
    finally:
        storage.remove(df.sparkSession, path)
