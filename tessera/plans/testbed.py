"""Race-shaped views over the driver's TPC-H-like tables.

race  <- orders   (race_id o_orderkey, race_date o_orderdate, course o_orderpriority,
                   surface o_orderstatus, owner o_custkey, distance from the total price)
entry <- lineitem (race l_orderkey, horse l_partkey, number l_linenumber, jockey l_suppkey;
                   finish = rank by l_extendedprice desc with a total tie-break;
                   field size = lines of the order)

The same definitions exist as SQL text (``RACES_SQL``/``ENTRIES_SQL``) so
that DuckDB oracles read the very same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tessera.session import make_room, table_path


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    rows = spark.read.parquet(table_path(sf_dir, name))
    make_room(rows)
    return rows


def races(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read(spark, sf_dir, "orders")
    return o.select(
        F.col("o_orderkey").alias("race_id"),
        F.to_date("o_orderdate").alias("race_date"),
        F.col("o_orderpriority").alias("course"),
        F.col("o_orderstatus").alias("surface"),
        F.col("o_custkey").alias("owner_id"),
        (F.lit(1000) + F.lit(100) * (F.floor("o_totalprice").cast("long") % 21)).cast("int").alias("distance"),
        F.col("o_totalprice"),
    )


def finish_order():
    """Total order of the lines of one order (the five columns are unique together)."""
    return [F.col("l_extendedprice").desc(), "l_linenumber", "l_partkey", "l_suppkey"]


def entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    # dealt by race before anything else: the sums of races then need no table of a file's races
    li = read(spark, sf_dir, "lineitem").repartition("l_orderkey")
    w = Window.partitionBy("l_orderkey").orderBy(*finish_order())
    return li.select(
        F.col("l_orderkey").alias("race_id"),
        F.col("l_partkey").alias("horse_id"),
        F.col("l_linenumber").alias("horse_no"),
        F.col("l_suppkey").alias("jockey_id"),
        "l_extendedprice", "l_quantity", "l_discount", "l_tax", "l_linestatus", "l_returnflag", "l_shipdate",
        F.row_number().over(w).cast("int").alias("finish_position"),
        F.count(F.lit(1)).over(Window.partitionBy("l_orderkey")).cast("int").alias("field_size"),
    )


def race_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return races(spark, sf_dir).join(entries(spark, sf_dir), "race_id")


RACES_SQL = """races AS (
  SELECT o_orderkey AS race_id, CAST(o_orderdate AS DATE) AS race_date, o_orderpriority AS course,
         o_orderstatus AS surface, o_custkey AS owner_id,
         CAST(1000 + 100 * (CAST(floor(o_totalprice) AS BIGINT) % 21) AS INTEGER) AS distance, o_totalprice
  FROM orders)"""

ENTRIES_SQL = """entries AS (
  SELECT l_orderkey AS race_id, l_partkey AS horse_id, l_linenumber AS horse_no, l_suppkey AS jockey_id,
         l_extendedprice, l_quantity, l_discount, l_tax, l_linestatus, l_returnflag, l_shipdate,
         CAST(row_number() OVER (PARTITION BY l_orderkey
              ORDER BY l_extendedprice DESC, l_linenumber, l_partkey, l_suppkey) AS INTEGER) AS finish_position,
         CAST(count(*) OVER (PARTITION BY l_orderkey) AS INTEGER) AS field_size
  FROM lineitem)"""

RACE_ENTRIES_SQL = """race_entries AS (SELECT * FROM races JOIN entries USING (race_id))"""

TESTBED_SQL = "WITH " + ",\n".join([RACES_SQL, ENTRIES_SQL, RACE_ENTRIES_SQL])


# Derived entry columns: odds (null for some horses), three model scores,
# popularity, a result-time text in two notations (plus junk) and a corner list.
_SCORED_EXPRS = {
    "odds_place_min": "CASE WHEN horse_id % 7 = 0 THEN NULL ELSE 1 + l_quantity / 10 END",
    "odds_win": "1 + l_quantity / 4",
    "prob_a": "l_discount * 9 + 0.05",
    "prob_b": "l_tax * 8 + 0.1",
    "prob_c": "CASE WHEN horse_no = 7 THEN NULL ELSE l_quantity / 50 * 0.9 END",
    "tenths": "CAST(600 + CAST(floor(l_extendedprice) AS BIGINT) % 900 AS BIGINT)",
    "first_corner": "CAST(CAST(l_quantity AS BIGINT) % field_size + 1 AS BIGINT)",
}
_TEXT_EXPRS = {
    "compact": "CAST((tenths {D} 600) AS {S}) || lpad(CAST(((tenths % 600) {D} 10) AS {S}), 2, '0') || CAST(tenths % 10 AS {S})",
    "legacy": "CAST((tenths {D} 600) AS {S}) || ':' || lpad(CAST(((tenths % 600) {D} 10) AS {S}), 2, '0') || '.' || CAST(tenths % 10 AS {S})",
}
_FINAL_EXPRS = {
    "finish_time": "CASE WHEN l_tax = 0 THEN 'DNF' WHEN horse_no % 2 = 1 THEN "
                   "(CASE WHEN l_returnflag = 'A' THEN ' ' || compact || ' ' ELSE compact END) ELSE legacy END",
    "corner_order": "CASE WHEN l_linestatus = 'O' AND l_returnflag = 'N' THEN '' ELSE "
                    "lpad(CAST(first_corner AS {S}), 2, '0') || '-' || "
                    "lpad(CAST(((first_corner + finish_position) {D} 2) AS {S}), 2, '0') || '-' || "
                    "lpad(CAST(finish_position AS {S}), 2, '0') END",
}
POPULARITY_ORDER = "l_quantity, horse_no, horse_id, jockey_id, l_extendedprice"


def _spark(e: str) -> str:
    return e.replace("{D}", "div").replace("{S}", "STRING")


def _duck(e: str) -> str:
    return e.replace("{D}", "//").replace("{S}", "VARCHAR")


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Race entries plus the derived columns above (same text as ``SCORED_SQL``)."""
    df = race_entries(spark, sf_dir)
    for name, e in _SCORED_EXPRS.items():
        df = df.withColumn(name, F.expr(e))
    for name, e in _TEXT_EXPRS.items():
        df = df.withColumn(name, F.expr(_spark(e)))
    for name, e in _FINAL_EXPRS.items():
        df = df.withColumn(name, F.expr(_spark(e)))
    w = Window.partitionBy("race_id").orderBy(*[c.strip() for c in POPULARITY_ORDER.split(",")])
    return df.withColumn("popularity", F.row_number().over(w).cast("int")).drop("compact", "legacy")


SCORED_SQL = ("scored0 AS (SELECT *, " + ", ".join(f"{e} AS {n}" for n, e in _SCORED_EXPRS.items())
              + " FROM race_entries),\n"
              + "scored1 AS (SELECT *, " + ", ".join(f"{_duck(e)} AS {n}" for n, e in _TEXT_EXPRS.items())
              + " FROM scored0),\n"
              + "scored AS (SELECT * EXCLUDE (compact, legacy), "
              + ", ".join(f"{_duck(e)} AS {n}" for n, e in _FINAL_EXPRS.items())
              + f", CAST(row_number() OVER (PARTITION BY race_id ORDER BY {POPULARITY_ORDER}) AS INTEGER) AS popularity"
              + " FROM scored1)")

SCORED_WITH = TESTBED_SQL + ",\n" + SCORED_SQL
