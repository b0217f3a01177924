"""Raw record sources and the content-hash archive."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators.latest import latest_per_key


def read_records(spark: SparkSession, path: str, data_spec: str, types: Sequence[str] = (),
                 limit: int | None = None) -> DataFrame:
    """One record per line of text files; a leading byte-order mark is
    dropped, the record type is the first two characters; optional type filter
    and read limit (the limit is the feature: a bounded sample read)."""
    df = spark.read.text(path).select(F.regexp_replace("value", "^\\x{feff}", "").alias("raw_payload"))
    df = df.select(F.lit(data_spec).alias("data_spec"), F.substring("raw_payload", 1, 2).alias("record_type"),
                   "raw_payload", F.current_timestamp().cast("timestamp_ntz").alias("received_at"))
    if types:
        df = df.where(F.upper(F.col("record_type")).isin(*[t.upper() for t in types]))
    return df.limit(limit) if limit else df


def record_hash(spec: str = "data_spec", payload: str = "raw_payload"):
    """SHA-256 hex of ``spec + "\\n" + payload``."""
    return F.sha2(F.concat(F.col(spec), F.lit("\n"), F.col(payload)), 256)


def archive(records: DataFrame, existing: DataFrame | None = None, received: str = "received_at") -> DataFrame:
    """S9 + T3: new archive rows: hash every record, keep the first received
    copy of each hash, drop hashes already archived (first write wins)."""
    hashed = records.withColumn("record_hash", record_hash())
    first = latest_per_key(hashed, ["record_hash"], [received, "raw_payload"], desc=False)
    if existing is not None:
        first = first.join(existing.select("record_hash"), "record_hash", "left_anti")
    return first


def type_counts(records: DataFrame, col: str = "record_type") -> DataFrame:
    """Records per type, most frequent first."""
    return records.groupBy(col).agg(F.count(F.lit(1)).alias("n")).orderBy(F.col("n").desc(), col)


def dump_records(records: DataFrame, types: Sequence[str], limit: int, order: Sequence[str],
                 payload: str = "raw_payload") -> DataFrame:
    """Matching records with CR and LF escaped, at most ``limit`` of them
    in ``order`` (a bounded dump: top-k, no full sort)."""
    sel = records.where(F.col("record_type").isin(*types))
    esc = F.regexp_replace(F.regexp_replace(F.col(payload), "\r", "\\\\r"), "\n", "\\\\n")
    return sel.withColumn(payload, esc).orderBy(*order).limit(limit)
