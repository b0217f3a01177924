"""Shuffles start with partitions by the size of the input."""

from pyspark.sql import functions as F

from tessera import session
from tessera.plans import testbed


def test_shuffles_start_with_partitions_by_size(spark, tmp_path, monkeypatch):
    spark.range(4000).select(F.col("id").alias("l_orderkey")).write.parquet(str(tmp_path / "lineitem.parquet"))
    keys = (session.FIRST_PARTITIONS, session.JOINED_SIZE)
    before = {k: spark.conf.get(k, None) for k in keys}
    try:
        testbed.read(spark, str(tmp_path), "lineitem")
        assert {k: spark.conf.get(k, None) for k in keys} == before  # a small input needs no more
        monkeypatch.setattr(session, "BYTES_PER_PARTITION", 100)
        rows = testbed.read(spark, str(tmp_path), "lineitem")
        first = int(spark.conf.get(session.FIRST_PARTITIONS))
        assert first > 100 and rows.repartition("l_orderkey").count() == 4000
        monkeypatch.setattr(session, "BYTES_PER_PARTITION", 1000)
        testbed.read(spark, str(tmp_path), "lineitem")
        assert int(spark.conf.get(session.FIRST_PARTITIONS)) == first  # a larger number stays
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
