"""Exact deduplication through a persistent digest index (operator 8).

The index is a Parquet table bucketed and sorted by digest, one row per
distinct text. A batch is reduced to one row per digest before any join, the
new digests are found by a sort-merge anti-join (the index side needs no
shuffle, it is bucketed). They are appended, bucket by bucket, only when the
caller commits the batch, after its own rows are safe; what an earlier attempt of
the same batch has appended counts as the batch's own. So a batch that is run
again after a crash, at any point, keeps every text once. The number of buckets
is stored with the index. DataFrame functions only.

Texts are equal when identical after deleting every white-space character of
``[\\x20\\x09-\\x0D]``. Of equal texts in one batch the row with the most code
points in the original text stays, then the smallest doc_id; a text that an
earlier batch brought in keeps that batch's row.

Defined cases: a null text is the empty text; a null doc_id loses every tie
against a real one; rows that repeat both doc_id and text are one document, so
all of them carry the same decision and ``deduplicate`` returns one of them;
an empty table gives an empty result; extra columns pass through untouched.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tessera.llm.common import WHITESPACE, fresh, join_classes, quoted, shared_path, stage, text_of
from tessera.sources import files


def normalised(text):
    return F.regexp_replace(text, WHITESPACE, "")


def digests(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, digest, n_points) per row; digest is the 32-byte SHA-256."""
    text = text_of(docs, text_col)
    return docs.select(F.col(quoted(id_col)).alias("doc_id"),
                       F.unhex(F.sha2(normalised(text), 256)).alias("digest"),
                       F.length(text).cast("long").alias("n_points"))


class DigestIndex:
    """A bucketed, sorted digest table at ``path`` that outlives the session. A new
    one has ``buckets`` buckets (16 by default; take one per few hundred MB of
    digests); a known one has those it was made with, and another number is an error."""

    def __init__(self, spark: SparkSession, path: str | None = None, buckets: int | None = None):
        self.spark = spark
        self.path = path or shared_path(spark, "digest-index")
        about = f"{self.path}/_index.json"
        if files.exists(spark, about):
            held = json.loads(files.read_text(spark, about))["buckets"]
            if buckets not in (None, held):
                raise ValueError(f"the index at {self.path} has {held} buckets, not {buckets}")
            buckets = held
        else:
            buckets = buckets or 16
            files.write_text(spark, about, json.dumps({"buckets": buckets}))
        self.buckets = buckets
        self.name = f"digest_index_{uuid.uuid4().hex}"
        spark.sql(f"CREATE TABLE {self.name} (digest BINARY, keep_id BIGINT, n_points BIGINT, batch STRING) "
                  f"USING parquet CLUSTERED BY (digest) SORTED BY (digest) INTO {buckets} BUCKETS "
                  f"LOCATION '{self.path}'")

    def rows(self) -> DataFrame:
        return self.spark.table(self.name)

    def commit(self, reps: DataFrame, batch: str) -> None:
        """Append a batch's new digests, one file per bucket. Call it when the rows
        that the batch keeps are written; again after a crash it adds what is missing."""
        own = self.rows().filter(F.col("batch") == batch).select("digest").hint("merge")
        (reps.filter("is_new").select("digest", "keep_id", F.col("keep_points").alias("n_points"), F.lit(batch).alias("batch"))
             .join(own, "digest", "left_anti")
             .repartition(self.buckets, "digest")
             .write.mode("append").format("parquet").option("path", self.path)
             .bucketBy(self.buckets, "digest").sortBy("digest").saveAsTable(self.name))

    def look_up(self, reps: DataFrame, batch: str) -> DataFrame:
        """``reps`` of a committed batch with the rows that the index keeps: digest,
        keep_id, keep_points, group_size and is_new (this batch brought the text in)."""
        held = self.rows().select("digest", "keep_id", F.col("n_points").alias("keep_points"),
                                  (F.col("batch") == batch).alias("is_new")).hint("merge")
        return reps.select("digest", "group_size").join(held, "digest")


def classes(docs: DataFrame, index: DigestIndex, id_col: str = "doc_id", text_col: str = "text",
            batch: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Compare one batch with the index, which stays as it is (see ``commit``).

    Returns (members, reps): members has a row per input row (doc_id, digest,
    n_points); reps has a row per digest of the batch: digest, keep_id,
    keep_points, group_size (rows of the batch), n_same (rows that repeat the
    kept one), is_new (no other batch has the text). Both are written tables.
    """
    members = stage(digests(docs, id_col, text_col), "digests")
    groups = (members.groupBy("digest", "doc_id", "n_points").agg(F.count(F.lit(1)).alias("n"))
              .groupBy("digest")
              .agg(F.sum("n").alias("group_size"),
                   F.min(F.struct((-F.col("n_points")).alias("p"), F.col("doc_id").isNull().alias("u"),
                                  F.col("doc_id").alias("id"), (-F.col("n")).alias("n"))).alias("best")))
    rows = index.rows() if batch is None else index.rows().filter(F.col("batch") != batch)
    held = rows.select("digest", F.struct("keep_id", "n_points").alias("held")).hint("merge")
    known = groups.join(held, "digest").select(
        "digest", F.col("held.keep_id").alias("keep_id"), F.col("held.n_points").alias("keep_points"), "group_size",
        (-F.col("best.n")).alias("n_same"), F.lit(False).alias("is_new"))
    new = groups.join(held, "digest", "left_anti").select(
        "digest", F.col("best.id").alias("keep_id"), (-F.col("best.p")).alias("keep_points"), "group_size",
        (-F.col("best.n")).alias("n_same"), F.lit(True).alias("is_new"))
    return members, stage(new.unionByName(known), "digest-reps")


def decide(members: DataFrame, reps: DataFrame) -> DataFrame:
    """Give every row its class. Hot digests are matched by a broadcast of a bounded
    number of rows, so that no task receives a hot group (``join_classes``)."""
    rows = join_classes(members, reps, "digest", "group_size", ["doc_id", "n_points"])
    return rows.select(
        "doc_id", "keep_id", "group_size",
        (F.col("is_new") & F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("n_points") == F.col("keep_points"))).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"))


def deduplicate(docs: DataFrame, index: DigestIndex, id_col: str = "doc_id", text_col: str = "text",
                batch: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(kept, reps): the rows of ``docs`` that stay, all columns, one row per distinct
    text; and what ``index.commit`` wants once they are written."""
    _, reps = classes(docs, index, id_col, text_col, batch)
    d, p, i, n = (fresh(docs, f"_dedup_{x}") for x in ("digest", "points", "id", "same"))
    dr, pr = (fresh(docs, f"_dedup_kept_{x}") for x in ("digest", "points"))
    text = text_of(docs, text_col)
    rows = docs.withColumns({d: F.unhex(F.sha2(normalised(text), 256)), p: F.length(text).cast("long")})
    stays = reps.filter("is_new").select(F.col("digest").alias(dr), F.col("keep_points").alias(pr),
                                         F.col("keep_id").alias(i), F.col("n_same").alias(n))
    kept = rows.join(stays, (F.col(d) == F.col(dr)) & (F.col(p) == F.col(pr))
                     & F.col(quoted(id_col)).eqNullSafe(F.col(i)))
    names = [F.col(quoted(c)) for c in docs.columns]
    if not reps.filter("is_new AND n_same > 1").limit(1).count():
        return kept.select(names), reps
    # Rows that repeat doc_id and text: any one of each set, the first by its columns.
    first = W.partitionBy(d).orderBy(*names)
    again = kept.filter(F.col(n) > 1).withColumn(n, F.row_number().over(first)).filter(F.col(n) == 1)
    return kept.filter(F.col(n) == 1).select(names).unionByName(again.select(names)), reps
