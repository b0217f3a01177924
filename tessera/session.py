"""Spark session construction and cluster-safe scratch locations."""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import SparkSession

# Defaults that matter at scale: AQE re-plans joins from measured sizes,
# coalesces small shuffle partitions and splits skewed ones.
_DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # One hash partitioning on the entity key serves every finer window key.
    "spark.sql.requireAllClusterKeysForDistribution": "false",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "tessera", extra: dict | None = None) -> SparkSession:
    """Return a session with the library defaults (existing settings win)."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(_DEFAULTS)
    if master and master.startswith("local"):
        conf["spark.driver.memory"] = "8g"  # local mode: the driver JVM is the executor
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for lineage cuts and staged tables.

    The cluster names it in ``spark.checkpoint.dir``. Only in local mode, where
    one machine runs everything, is a private temporary folder made when that is
    unset; anywhere else a folder of the driver would be lost on the executors,
    so an unset folder is an error.
    """
    sc = spark.sparkContext
    if not sc.getCheckpointDir():
        folder = sc.getConf().get("spark.checkpoint.dir", None)
        if not folder:
            if not re.fullmatch(r"local(\[[^\]]*\])?", sc.master):
                raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
            folder = tempfile.mkdtemp(prefix="tessera-ckpt-")
        sc.setCheckpointDir(folder)
    return sc.getCheckpointDir()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path under the shared checkpoint folder (never a node-local temp dir)."""
    base = checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}"


def cut_lineage(df):
    """Reliable checkpoint into the shared folder (survives executor loss).

    The rows are persisted while the checkpoint is written, so the plan is
    computed once (a reliable checkpoint otherwise recomputes its input for
    the write), and released once the files are in place."""
    from pyspark import StorageLevel
    checkpoint_dir(df.sparkSession)
    held = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return held.checkpoint(eager=True)
    finally:
        held.unpersist()


FIRST_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
JOINED_SIZE = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
BYTES_PER_PARTITION = 2 << 20  # of an input's files, for each partition that a shuffle starts with


def make_room(df) -> None:
    """Let shuffles start with as many partitions as the files of ``df`` ask for, so
    that a task's share, and what it holds or spills, stays the same as inputs grow.
    Adaptive execution puts small ones together again, up to 16 MB as they are sent, which
    is some hundred MB in the sorts of a task. A larger number or a set size stays."""
    conf = df.sparkSession.conf
    size = int(df._jdf.queryExecution().analyzed().stats().sizeInBytes())
    wanted = -(-size // BYTES_PER_PARTITION)
    if wanted > int(conf.get(FIRST_PARTITIONS, None) or conf.get("spark.sql.shuffle.partitions")):
        conf.set(FIRST_PARTITIONS, str(wanted))
        if conf.get(JOINED_SIZE, None) is None:
            conf.set(JOINED_SIZE, "16m")


def stored(df, name: str):
    """The rows as a Parquet table in the shared folder: computed once, and smaller
    than a checkpoint where rows are wide."""
    from uuid import uuid4
    path = scratch_path(df.sparkSession, f"{name}-{uuid4().hex}")
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def side_by_side(fn, items) -> list:
    """``fn`` of each item, from one thread each, so that small jobs which do not
    depend on each other share the cluster; the first error is raised when all have ended."""
    from concurrent.futures import ThreadPoolExecutor
    items = list(items)
    with ThreadPoolExecutor(max(1, len(items))) as pool:
        return list(pool.map(fn, items))


def table_path(sf_dir: str, name: str) -> str:
    return os.path.join(sf_dir, f"{name}.parquet")
