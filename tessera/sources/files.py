"""File listings through Hadoop's file system API, for any store Spark reads."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _open(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    p, fs = _open(spark, path)
    return fs.exists(p)


def children(spark: SparkSession, path: str, prefix: str = "") -> list[str]:
    """Names in a folder that start with ``prefix``, in order; none if it is missing."""
    p, fs = _open(spark, path)
    if not fs.exists(p):
        return []
    return sorted(n for n in (s.getPath().getName() for s in fs.listStatus(p)) if n.startswith(prefix))


def delete(spark: SparkSession, path: str) -> None:
    p, fs = _open(spark, path)
    fs.delete(p, True)


def committed(spark: SparkSession, path: str, prefix: str = "v=") -> list[str]:
    """Names of the sub-folders that a Spark job has finished writing, in order."""
    return [n for n in children(spark, path, prefix) if exists(spark, f"{path}/{n}/_SUCCESS")]


def read_text(spark: SparkSession, path: str) -> str:
    """A small UTF-8 file as one string."""
    p, fs = _open(spark, path)
    stream = fs.open(p)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small UTF-8 file under its final name only when it is complete."""
    p, fs = _open(spark, f"{path}.tmp")
    stream = fs.create(p, True)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    if not fs.rename(p, _open(spark, path)[0]):
        raise OSError(f"cannot write {path}")
