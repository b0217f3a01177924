"""Connected components of an edge table, by alternating star operations.

Each round rewrites the edges so that every node points to a smaller one of its
component, until all point to the smallest; the number of rounds grows with the
logarithm of the longest path. Every step is an aggregate with map-side
combining and a join on the node, and each round is a written table. No edge,
label or component passes through the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import stage


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """edges: (u, v), u > v. Connect neighbours of each node to the least one."""
    if large:
        near = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        near = edges
    least = near.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u"))
    joined = near.join(least, "u")
    if large:
        out = joined.filter(F.col("v") > F.col("u")).select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = joined.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            least.select("u", F.col("m").alias("v")))
    return out.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()


def _mark(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()
    return row["n"], row["s"]


def components(edges: DataFrame) -> DataFrame:
    """(node, root): every node of an edge and the least node it can reach.
    ``edges`` has columns u and v of an orderable type; direction, repeats and
    loops don't matter."""
    now = stage(edges.filter("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(),
                "edges")
    mark = _mark(now)
    while mark[0]:
        now = stage(_star(_star(now, True), False), "edges")
        last, mark = mark, _mark(now)
        if mark == last:
            break
    roots = now.select(F.col("v").alias("node")).distinct().withColumn("root", F.col("node"))
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)
