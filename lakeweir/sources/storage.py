"""Folder metadata through the Hadoop file system that Spark itself uses."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _open(spark: SparkSession, path: str):
    hadoop_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop_path


def exists(spark: SparkSession, path: str) -> bool:
    fs, hadoop_path = _open(spark, path)
    return fs.exists(hadoop_path)


def child_folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders one level below ``path``; no file below them is listed."""
    fs, hadoop_path = _open(spark, path)
    if not fs.exists(hadoop_path):
        return []
    return sorted(
        status.getPath().getName() for status in fs.listStatus(hadoop_path) if status.isDirectory()
    )


def remove(spark: SparkSession, path: str) -> None:
    fs, hadoop_path = _open(spark, path)
    fs.delete(hadoop_path, True)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Write one small file; what is there is replaced once the new one is whole."""
    fs, hadoop_path = _open(spark, path)
    part = hadoop_path.getParent().suffix(f"/.{hadoop_path.getName()}.part")
    stream = fs.create(part, True)
    try:
        stream.write(bytearray(text.encode("utf-8")))
    finally:
        stream.close()
    if fs.exists(hadoop_path):
        fs.delete(hadoop_path, False)
    fs.rename(part, hadoop_path)


def read_text(spark: SparkSession, path: str) -> str | None:
    """The text of a small file; None where there is none."""
    fs, hadoop_path = _open(spark, path)
    if not fs.exists(hadoop_path):
        return None
    stream = fs.open(hadoop_path)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def rename(spark: SparkSession, path: str, target: str) -> None:
    """Move a folder to a name that is free."""
    fs, hadoop_path = _open(spark, path)
    if not fs.rename(hadoop_path, _open(spark, target)[1]):
        raise OSError(f"cannot move {path} to {target}")
