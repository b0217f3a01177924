"""Core-table queries: completeness gate, keyed merges, long odds, entry view,
best match, history rows, data quality, latest per key (J1-J6, J12-J15, U1-U6,
P1, P2, P4, G9, A5, A6)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions.targets import place_target
from tessera.operators.gate import complete_groups
from tessera.operators.latest import latest_per_key
from tessera.operators.upsert import upsert
from tessera.plans import testbed
from tessera.plans.catalog import r6, r6sql, register
from tessera.plans.jobs import (entry_view, odds_to_snapshots, place_payout_match, quality_report,
                                results_history)
from tessera.session import table_path

ENTRY_ID = ["race_id", "horse_no", "horse_id", "jockey_id", "l_extendedprice"]


def _raw(spark, sf_dir):
    """Raw layer over the test tables: results are the finished lines, payouts
    the returned lines."""
    races = testbed.races(spark, sf_dir)
    entries = testbed.entries(spark, sf_dir)
    results = entries.where(F.col("l_linestatus") == "F")
    payouts = entries.where(F.col("l_returnflag") == "R")
    return races, entries, results, payouts


RAW_SQL = testbed.TESTBED_SQL + """,
results AS (SELECT * FROM entries WHERE l_linestatus = 'F'),
payouts AS (SELECT * FROM entries WHERE l_returnflag = 'R')"""

# The gate as counts per race: every known member has a result, and there is a payout.
GATE_SQL = RAW_SQL + """,
members AS (SELECT DISTINCT race_id, horse_id FROM entries WHERE horse_id IS NOT NULL),
finished AS (SELECT DISTINCT race_id, horse_id FROM results),
tally AS (SELECT m.race_id, count(*) AS known, count(f.horse_id) AS done
          FROM members m LEFT JOIN finished f USING (race_id, horse_id) GROUP BY m.race_id),
sizes AS (SELECT race_id, count(horse_id) AS n_members FROM entries GROUP BY race_id),
paid AS (SELECT DISTINCT race_id FROM payouts)
SELECT r.race_id, strftime(r.race_date, '%Y-%m-%d') AS race_date, r.course, s.n_members
FROM races r JOIN tally t USING (race_id) JOIN sizes s USING (race_id) JOIN paid USING (race_id)
WHERE t.known = t.done AND r.race_date IS NOT NULL AND r.course IS NOT NULL"""


@register("complete_groups", GATE_SQL)
def complete_groups_q(spark, sf_dir):
    """Races whose every entry has a result and that have a payout."""
    races, entries, results, payouts = _raw(spark, sf_dir)
    done = complete_groups(races, entries, results, payouts, "race_id", ["horse_id"], ["race_date", "course"])
    return done.select("race_id", F.date_format("race_date", "yyyy-MM-dd").alias("race_date"), "course",
                       F.col("n_members").cast("long").alias("n_members"))


def _merge_inputs(spark, sf_dir):
    o = spark.read.parquet(table_path(sf_dir, "orders"))
    target = o.where(F.col("o_orderdate") < F.lit("1999-01-01").cast("timestamp_ntz")).select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority",
        F.col("o_orderdate").alias("imported_at"))
    source = o.where(F.col("o_orderdate") >= F.lit("1998-01-01").cast("timestamp_ntz")).select(
        "o_orderkey", "o_custkey",
        F.when(F.col("o_orderpriority") != "1-URGENT", F.concat(F.lit("X"), "o_orderstatus")).alias("o_orderstatus"),
        (F.col("o_totalprice") + 1).alias("o_totalprice"),
        F.expr("o_orderdate + INTERVAL 1 DAY").alias("imported_at"))
    return target, source


def _merged_out(df):
    return df.select("o_orderkey", "o_custkey", "o_orderstatus", r6("o_totalprice"), "o_orderpriority",
                     F.date_format("imported_at", "yyyy-MM-dd HH:mm:ss").alias("imported_at"))


MERGE_CTE = """WITH t AS (SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority, o_orderdate AS imported_at
           FROM orders WHERE o_orderdate < TIMESTAMP '1999-01-01'),
s AS (SELECT o_orderkey, o_custkey,
             CASE WHEN o_orderpriority <> '1-URGENT' THEN 'X' || o_orderstatus END AS o_orderstatus,
             o_totalprice + 1 AS o_totalprice, o_orderdate + INTERVAL 1 DAY AS imported_at
      FROM orders WHERE o_orderdate >= TIMESTAMP '1998-01-01')
"""


def _merge_sql(status_expr):
    return MERGE_CTE + f"""SELECT coalesce(t.o_orderkey, s.o_orderkey) AS o_orderkey,
  CASE WHEN s.o_orderkey IS NOT NULL THEN s.o_custkey ELSE t.o_custkey END AS o_custkey,
  CASE WHEN s.o_orderkey IS NOT NULL THEN {status_expr} ELSE t.o_orderstatus END AS o_orderstatus,
  round(CASE WHEN s.o_orderkey IS NOT NULL THEN s.o_totalprice ELSE t.o_totalprice END, 6) AS o_totalprice,
  t.o_orderpriority,
  strftime(CASE WHEN t.o_orderkey IS NOT NULL THEN t.imported_at ELSE s.imported_at END, '%Y-%m-%d %H:%M:%S') AS imported_at
FROM t FULL OUTER JOIN s ON t.o_orderkey = s.o_orderkey"""


@register("sync_upsert", r6sql(_merge_sql("s.o_orderstatus")))
def sync_upsert(spark, sf_dir):
    """Keyed upsert; source columns replace (nulls too), protected column kept."""
    target, source = _merge_inputs(spark, sf_dir)
    return _merged_out(upsert(target, source, ["o_orderkey"], protect=("imported_at",)))


@register("upsert_keep_null", r6sql(_merge_sql("coalesce(s.o_orderstatus, t.o_orderstatus)")))
def upsert_keep_null(spark, sf_dir):
    """A null in the batch keeps the stored value for the listed columns."""
    target, source = _merge_inputs(spark, sf_dir)
    return _merged_out(upsert(target, source, ["o_orderkey"], keep_if_null=("o_orderstatus",),
                              protect=("imported_at",)))


INSERT_ONLY_SQL = MERGE_CTE + """SELECT o_orderkey, o_custkey, o_orderstatus, round(o_totalprice, 6) AS o_totalprice, o_orderpriority,
  strftime(imported_at, '%Y-%m-%d %H:%M:%S') AS imported_at FROM t
UNION ALL
SELECT o_orderkey, o_custkey, o_orderstatus, round(o_totalprice, 6), NULL, strftime(imported_at, '%Y-%m-%d %H:%M:%S')
FROM s WHERE NOT EXISTS (SELECT 1 FROM t WHERE t.o_orderkey = s.o_orderkey)"""


@register("insert_only", r6sql(INSERT_ONLY_SQL))
def insert_only(spark, sf_dir):
    """Insert new keys only (DO NOTHING on conflict)."""
    target, source = _merge_inputs(spark, sf_dir)
    return _merged_out(upsert(target, source, ["o_orderkey"], insert_only=True))


ODDS_LONG_SQL = testbed.SCORED_WITH + """
SELECT race_id, CAST(horse_no AS VARCHAR) AS combination, jockey_id,
  strftime(l_shipdate, '%Y-%m-%d %H:%M:%S') AS snapshot_time, ticket_type, round(odds, 6) AS odds
FROM (SELECT race_id, horse_no, jockey_id, l_shipdate, 'win' AS ticket_type, odds_win AS odds FROM scored
      UNION ALL
      SELECT race_id, horse_no, jockey_id, l_shipdate, 'place', odds_place_min FROM scored)
WHERE odds IS NOT NULL"""


@register("odds_long_snapshots", r6sql(ODDS_LONG_SQL))
def odds_long_snapshots(spark, sf_dir):
    """Win and place odds of each entry as snapshot rows (nulls skipped)."""
    df = testbed.scored(spark, sf_dir)
    snaps = odds_to_snapshots(df, "l_shipdate", {"win": "odds_win", "place": "odds_place_min"},
                              keep=["race_id", "horse_no", "jockey_id"], capture=True)
    return snaps.select("race_id", F.col("horse_no").cast("string").alias("combination"), "jockey_id",
                        F.date_format("snapshot_time", "yyyy-MM-dd HH:mm:ss").alias("snapshot_time"),
                        "ticket_type", r6("odds"))


CK_SQL = """ck AS (
  SELECT race_id, horse_id, snapshot_date, central_runs, central_wins, central_seconds, central_thirds FROM (
    SELECT race_id, horse_id, CAST(l_shipdate AS DATE) AS snapshot_date,
      CAST(CAST(l_quantity AS INTEGER) % 7 AS INTEGER) AS central_runs, CAST(horse_no % 3 AS INTEGER) AS central_wins,
      CAST(jockey_id % 2 AS INTEGER) AS central_seconds, CASE WHEN l_returnflag = 'A' THEN 1 ELSE 0 END AS central_thirds,
      row_number() OVER (PARTITION BY race_id, horse_id
        ORDER BY CAST(l_shipdate AS DATE) DESC, horse_no DESC, jockey_id DESC, l_extendedprice DESC) AS rn
    FROM entries) WHERE rn = 1)"""


def _ck(entries):
    snaps = entries.select(
        "race_id", "horse_id", F.to_date("l_shipdate").alias("snapshot_date"),
        (F.col("l_quantity").cast("int") % 7).cast("int").alias("central_runs"),
        (F.col("horse_no") % 3).cast("int").alias("central_wins"),
        (F.col("jockey_id") % 2).cast("int").alias("central_seconds"),
        F.when(F.col("l_returnflag") == "A", 1).otherwise(0).alias("central_thirds"),
        "horse_no", "jockey_id", "l_extendedprice")
    latest = latest_per_key(snaps, ["race_id", "horse_id"], ["snapshot_date", "horse_no", "jockey_id", "l_extendedprice"])
    return latest.drop("horse_no", "jockey_id", "l_extendedprice")


# One row per entry; a snapshot counts only if it was known on the day of the race.
ENTRY_VIEW_SQL = RAW_SQL + ",\n" + CK_SQL + """,
finish AS (SELECT race_id, horse_id, min(finish_position) AS place FROM results GROUP BY ALL),
known AS (SELECT ck.race_id, ck.horse_id, ck.central_runs AS runs, ck.central_wins AS wins,
            ck.central_wins + ck.central_seconds + ck.central_thirds AS placed
          FROM ck SEMI JOIN races ON races.race_id = ck.race_id AND races.race_date >= ck.snapshot_date)
SELECT race_id, horse_id, horse_no, jockey_id, strftime(race_date, '%Y-%m-%d') AS race_date, course, field_size,
  place AS finish_position, runs AS ck_central_runs, wins AS ck_central_wins,
  CASE WHEN place IS NULL OR field_size < 5 THEN NULL
       WHEN place BETWEEN 1 AND (CASE WHEN field_size < 8 THEN 2 ELSE 3 END) THEN 1 ELSE 0 END AS target_place,
  round(wins / nullif(runs, 0), 6) AS ck_central_win_rate, round(placed / nullif(runs, 0), 6) AS ck_central_place_rate
FROM race_entries LEFT JOIN finish USING (race_id, horse_id) LEFT JOIN known USING (race_id, horse_id)"""


@register("entry_view", r6sql(ENTRY_VIEW_SQL))
def entry_view_q(spark, sf_dir):
    """Races x entries, left results, guarded left snapshot join."""
    races, entries, results, _ = _raw(spark, sf_dir)
    res = results.groupBy("race_id", "horse_id").agg(F.min("finish_position").alias("finish_position"))
    view = entry_view(races, entries.drop("finish_position"), res, _ck(entries))
    return view.select("race_id", "horse_id", "horse_no", "jockey_id",
                       F.date_format("race_date", "yyyy-MM-dd").alias("race_date"), "course", "field_size",
                       "finish_position", "target_place", "ck_central_runs", "ck_central_wins",
                       r6("ck_central_win_rate"), r6("ck_central_place_rate"))


PAYOUTS_SQL = """pay AS (
  SELECT race_id, CASE WHEN l_returnflag = 'N' AND l_linestatus = 'O' THEN 'win'
                       WHEN l_returnflag = 'A' THEN '複勝' ELSE 'place' END AS ticket_type,
    CASE WHEN l_returnflag = 'A' THEN lpad(CAST(horse_no AS VARCHAR), 2, '0')
         WHEN l_returnflag = 'N' AND l_linestatus = 'F' THEN CAST(horse_id AS VARCHAR)
         ELSE CAST(horse_no AS VARCHAR) END AS combination,
    CAST(100 + CAST(l_quantity AS INTEGER) * 10 AS INTEGER) AS payout
  FROM entries WHERE l_tax > 0.02)"""


def _payouts(entries):
    rf, ls = F.col("l_returnflag"), F.col("l_linestatus")
    return entries.where(F.col("l_tax") > 0.02).select(
        "race_id",
        F.when((rf == "N") & (ls == "O"), "win").when(rf == "A", "複勝").otherwise("place").alias("ticket_type"),
        F.when(rf == "A", F.lpad(F.col("horse_no").cast("string"), 2, "0"))
         .when((rf == "N") & (ls == "F"), F.col("horse_id").cast("string"))
         .otherwise(F.col("horse_no").cast("string")).alias("combination"),
        (F.lit(100) + F.col("l_quantity").cast("int") * 10).cast("int").alias("payout"))


# Each payout of a race gets a rank for an entry: how well the combination fits, then
# the combination, then the amount; the least rank is the match.
BEST_MATCH_SQL = testbed.TESTBED_SQL + ",\n" + PAYOUTS_SQL + """,
numbered AS (SELECT *, row_number() OVER () AS entry, CAST(horse_no AS VARCHAR) AS no_text, CAST(horse_id AS VARCHAR) AS id_text
             FROM entries),
fits AS (
  SELECT n.entry, p.payout, p.combination,
         list_position([p.combination = n.no_text, p.combination = n.id_text, contains(p.combination, n.no_text)], true) AS fit
  FROM numbered n JOIN pay p USING (race_id) WHERE p.ticket_type IN ('place', '複勝')),
best AS (
  SELECT entry, arg_min({'p': payout, 'c': combination}, {'f': fit, 'c': combination, 'p': payout}) AS m
  FROM fits WHERE fit > 0 GROUP BY entry)
SELECT n.race_id, n.horse_no, n.horse_id, n.jockey_id, best.m.p AS payout_place, best.m.c AS matched_combination
FROM numbered n LEFT JOIN best USING (entry)"""


@register("best_match", BEST_MATCH_SQL)
def best_match_q(spark, sf_dir):
    """Place payout per entry by priority exact number > horse id > substring."""
    entries = testbed.entries(spark, sf_dir)
    out = place_payout_match(entries, _payouts(entries), ENTRY_ID)
    return out.select("race_id", "horse_no", "horse_id", "jockey_id", "payout_place", "matched_combination")


HISTORY_ROWS_SQL = RAW_SQL + """
SELECT r.race_id, strftime(r.race_date, '%Y-%m-%d') AS race_date, e.horse_id, e.horse_no, r.course, r.surface, r.distance,
  e.field_size, res.finish_position, e.jockey_id
FROM races r JOIN entries e ON r.race_id = e.race_id
JOIN (SELECT race_id, horse_id, min(finish_position) AS finish_position FROM results GROUP BY race_id, horse_id) res
  ON e.race_id = res.race_id AND e.horse_id = res.horse_id"""


@register("history_rows", HISTORY_ROWS_SQL)
def history_rows(spark, sf_dir):
    """History table = races x entries x results (inner)."""
    races, entries, results, _ = _raw(spark, sf_dir)
    res = results.groupBy("race_id", "horse_id").agg(F.min("finish_position").alias("finish_position"))
    h = results_history(races, entries.drop("finish_position"), res)
    return h.select("race_id", F.date_format("race_date", "yyyy-MM-dd").alias("race_date"), "horse_id", "horse_no",
                    "course", "surface", "distance", "field_size", "finish_position", "jockey_id")


QUALITY_SQL = RAW_SQL + ",\n" + PAYOUTS_SQL + """,
declared AS (SELECT race_id, CAST(floor(o_totalprice / 40000) AS INTEGER) AS field_size FROM races),
ent AS (SELECT *, (l_quantity - 5) / 4 AS odds_win, CASE WHEN horse_id % 7 = 0 THEN NULL ELSE l_discount * 10 - 0.2 END AS odds_place_min
        FROM entries),
res AS (SELECT race_id, horse_id, min(finish_position) AS finish_position FROM results GROUP BY race_id, horse_id),
matched AS (
  SELECT DISTINCT e.race_id, e.horse_no, e.horse_id, e.jockey_id, e.l_extendedprice FROM entries e JOIN pay p ON p.race_id = e.race_id
  WHERE p.ticket_type IN ('place', '複勝')
    AND (p.combination = CAST(e.horse_no AS VARCHAR) OR p.combination = CAST(e.horse_id AS VARCHAR)
         OR p.combination LIKE '%' || CAST(e.horse_no AS VARCHAR) || '%'))
SELECT 'races_count' AS "check", (SELECT count(*) FROM races) AS value
UNION ALL SELECT 'entries_count', (SELECT count(*) FROM ent)
UNION ALL SELECT 'results_count', (SELECT count(*) FROM res)
UNION ALL SELECT 'race_id_duplicates', (SELECT CAST(coalesce(sum(n - 1), 0) AS BIGINT) FROM (SELECT race_id, count(*) AS n FROM races GROUP BY race_id HAVING count(*) > 1))
UNION ALL SELECT 'entries_missing_races', (SELECT count(*) FROM ent e LEFT JOIN races r ON e.race_id = r.race_id WHERE r.race_id IS NULL)
UNION ALL SELECT 'results_missing_entries', (SELECT count(*) FROM res LEFT JOIN (SELECT DISTINCT race_id, horse_id FROM ent) e
              ON res.race_id = e.race_id AND res.horse_id = e.horse_id WHERE e.race_id IS NULL)
UNION ALL SELECT 'field_size_mismatches', (SELECT count(*) FROM declared d LEFT JOIN (SELECT race_id, count(*) AS c FROM ent GROUP BY race_id) k
              ON d.race_id = k.race_id WHERE d.field_size IS NOT NULL AND d.field_size <> coalesce(k.c, 0))
UNION ALL SELECT 'odds_win_non_positive', (SELECT count(*) FROM ent WHERE odds_win <= 0)
UNION ALL SELECT 'odds_place_min_non_positive', (SELECT count(*) FROM ent WHERE odds_place_min <= 0)
UNION ALL SELECT 'payout_place_missing', (SELECT count(*) FROM ent e WHERE NOT EXISTS (SELECT 1 FROM matched m
              WHERE m.race_id = e.race_id AND m.horse_no = e.horse_no AND m.horse_id = e.horse_id AND m.jockey_id = e.jockey_id
                AND m.l_extendedprice = e.l_extendedprice))
UNION ALL SELECT 'horse_id_missing', (SELECT count(*) FROM ent WHERE horse_id IS NULL OR CAST(horse_id AS VARCHAR) = '')"""


@register("quality_report", QUALITY_SQL)
def quality_report_q(spark, sf_dir):
    """The eleven named data-quality checks as (check, value) rows."""
    races, entries, results, _ = _raw(spark, sf_dir)
    declared = races.select("race_id", F.floor(F.col("o_totalprice") / 40000).cast("int").alias("field_size"))
    ent = (entries.withColumn("odds_win", (F.col("l_quantity") - 5) / 4)
                  .withColumn("odds_place_min", F.when(F.col("horse_id") % 7 != 0, F.col("l_discount") * 10 - 0.2)))
    res = results.groupBy("race_id", "horse_id").agg(F.min("finish_position").alias("finish_position"))
    paid = place_payout_match(entries, _payouts(entries), ENTRY_ID)
    return quality_report(declared, ent, res, paid)


LATEST_SQL = """SELECT user_id, event_type, event_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts, value FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS rn FROM events)
WHERE rn = 1"""


@register("latest_per_key", LATEST_SQL)
def latest_per_key_q(spark, sf_dir):
    """Latest row per key (DISTINCT ON ... ORDER BY time DESC)."""
    ev = spark.read.parquet(table_path(sf_dir, "events")).select("user_id", "event_type", "event_id", "ts", "value")
    out = latest_per_key(ev, ["user_id", "event_type"], ["ts", "event_id"])
    return out.select("user_id", "event_type", "event_id",
                      F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("ts"), "value")


LOOKUP_SQL = testbed.SCORED_WITH + """,
upd AS (SELECT race_id, horse_no, CASE WHEN l_tax = 0 THEN NULL ELSE 1 + l_quantity / 3 END AS odds_win, l_shipdate,
               jockey_id, l_extendedprice FROM scored),
lat AS (SELECT race_id, horse_no, odds_win AS new_odds, row_number() OVER (PARTITION BY race_id, horse_no
          ORDER BY l_shipdate DESC, jockey_id DESC, l_extendedprice DESC) AS rn FROM upd)
SELECT s.race_id, s.horse_id, s.horse_no, s.jockey_id, round(coalesce(lat.new_odds, s.odds_win), 6) AS odds_win
FROM scored s LEFT JOIN lat ON lat.rn = 1 AND lat.race_id = s.race_id AND lat.horse_no = s.horse_no"""


@register("odds_onto_entries", r6sql(LOOKUP_SQL))
def odds_onto_entries(spark, sf_dir):
    """U4: the latest odds per (race, number) - a non-unique key of entries -
    applied to every entry with that key; a null update keeps the old odds."""
    from tessera.operators.upsert import update_by_lookup
    df = testbed.scored(spark, sf_dir)
    updates = df.select("race_id", "horse_no",
                        F.when(F.col("l_tax") != 0, 1 + F.col("l_quantity") / 3).alias("odds_win"),
                        "l_shipdate", "jockey_id", "l_extendedprice")
    out = update_by_lookup(df.select("race_id", "horse_id", "horse_no", "jockey_id", "odds_win"), updates,
                           ["race_id", "horse_no"], ["odds_win"], ["l_shipdate", "jockey_id", "l_extendedprice"])
    return out.select("race_id", "horse_id", "horse_no", "jockey_id", r6("odds_win"))
