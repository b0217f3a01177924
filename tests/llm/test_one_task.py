"""Hot keys in written shards, and raking that can't meet its targets."""

import pytest
from pyspark.sql import functions as F

from tessera.llm import mixing, sharding


def test_rows_of_a_hot_key_fill_several_files(spark, tmp_path):
    docs = spark.range(400).selectExpr("'hot' AS k", "id AS doc_id")
    slots = spark.createDataFrame([(0, "s")], "slot long, shard string")
    name = "spark.sql.adaptive.coalescePartitions.enabled"  # else so few rows end in one task
    was = spark.conf.get(name)
    spark.conf.set(name, "false")
    sharding.write_shards(docs, str(tmp_path / "out"), slots, "k", 1, files_per_shard=4)
    spark.conf.set(name, was)
    back = spark.read.parquet(str(tmp_path / "out"))
    per_file = [r["count"] for r in back.groupBy(F.input_file_name()).count().collect()]
    assert sum(per_file) == 400 and len(per_file) > 1 and max(per_file) < 400


def test_raking_says_when_targets_are_not_met(spark, monkeypatch):
    monkeypatch.setattr(mixing, "MOST_ROUNDS", 2)
    cells = spark.createDataFrame([("a", "x", 1, 0.9, 0.1), ("b", "y", 1, 0.1, 0.9)], "s string, l string, tokens long, t_s double, t_l double")
    with pytest.warns(UserWarning, match="not met"):
        mixing.rake(cells, ["s", "l"])
