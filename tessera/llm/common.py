"""Helpers shared by the operators: shared folder, staged tables, file access."""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.session import checkpoint_dir

# ASCII white space as every contract here names it: space and \t \n \v \f \r.
WHITESPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]+"


def shared_path(spark: SparkSession, name: str) -> str:
    """A new, unused path under the shared checkpoint folder."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write a frame as a Parquet table in the shared folder and read it back:
    the lineage is cut, and a lost executor costs a re-read, not a re-run."""
    spark = df.sparkSession
    path = shared_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def fresh(df: DataFrame, name: str) -> str:
    """A column name the frame does not use yet."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def text_of(docs: DataFrame, text_col: str = "text"):
    """The text column with nulls read as empty texts."""
    return F.coalesce(F.col(quoted(text_col)).cast("string"), F.lit(""))


def filesystem(uri: str):
    """(pyarrow file system, path) of a URI; runs in the task that uses it."""
    from pyarrow import fs
    if "://" not in uri:
        uri = uri[len("file:"):] if uri.startswith("file:") else uri
        return fs.LocalFileSystem(), uri
    return fs.FileSystem.from_uri(uri)


class AtomicFile:
    """Writes to a private name and moves to the final one on success, so a
    retried or speculative task attempt leaves exactly one complete file."""

    def __init__(self, uri: str):
        self.fs, self.final = filesystem(uri)
        self.temp = f"{self.final}.{uuid.uuid4().hex}.tmp"

    def __enter__(self):
        self.fs.create_dir(os.path.dirname(self.final), recursive=True)
        self.out = self.fs.open_output_stream(self.temp, compression=None)
        return self.out

    def __exit__(self, kind, *_):
        self.out.close()
        if kind is None:
            self.fs.move(self.temp, self.final)
        else:
            self.fs.delete_file(self.temp)


# A key held by more than 1/HOT_SHARE of all rows is hot. At most HOT_SHARE keys
# can be, whatever the input, which bounds the broadcast below.
HOT_SHARE = 1000


def join_classes(members: DataFrame, classes: DataFrame, key: str, rows_col: str, scatter: list[str]) -> DataFrame:
    """Left join of rows with their class (one row per key, ``rows_col`` members
    each), with hot keys matched by a broadcast of at most HOT_SHARE rows. Hot
    rows then carry a scattered salt through the join of the rest, so no task
    receives a hot group. ``members`` should be a written table."""
    total = members.count()
    other = [F.col(c) for c in classes.columns if c != key]
    hot = F.col(rows_col) * HOT_SHARE > total
    few = classes.filter(hot).select(key, F.struct(*other).alias("_hot"))
    rest = classes.filter(~hot).select(key, F.lit(0).cast("long").alias("_salt"), F.struct(*other).alias("_cold"))
    salt = F.when(F.col("_hot").isNotNull(), F.xxhash64(*scatter)).otherwise(F.lit(0).cast("long"))
    out = members.join(F.broadcast(few), key, "left").withColumn("_salt", salt).join(rest, [key, "_salt"], "left")
    own = F.coalesce(F.col("_hot"), F.col("_cold"))
    return out.select(*members.columns, *[own[c].alias(c) for c in classes.columns if c != key])


def one_of_each(rows: DataFrame, key: str, n_col: str, names: list) -> DataFrame:
    """Rows whose key occurs once as they are; of rows that repeat a key (``n_col``
    of them), the first by its columns."""
    from pyspark.sql import Window as W
    once = rows.filter(F.col(n_col) == 1).select(names)
    first = W.partitionBy(key).orderBy(*names)
    again = (rows.filter(F.col(n_col) > 1).withColumn(n_col, F.row_number().over(first))
             .filter(F.col(n_col) == 1).select(names))
    return once.unionByName(again)
