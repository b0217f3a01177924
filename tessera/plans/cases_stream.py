"""Streaming queries (R1-R3): the driver tables are written as a folder of
arriving files, a Structured Streaming job runs over them to completion
(``availableNow``), and the final sink table is compared with SQL."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.plans import testbed
from tessera.plans.cases_decode import RECORDS_SQL, records
from tessera.plans.cases_time import COVERAGE_CTE, _coverage_inputs
from tessera.plans.catalog import r6, r6sql, register
from tessera.plans.jobs import _place_snapshots, odds_to_snapshots
from tessera.session import cut_lineage
from tessera.streaming.jobs import (archive_table, new_run_dir, read_coverage, read_latest, stream_archive, stream_coverage,
                                    stream_latest)

def _land(spark, df, run_dir, order, as_landed=lambda rows: rows):
    """Write the input as time-ordered files (the arrival folder), their number
    after the session's shuffle partitions; (folder, schema, files per micro-batch),
    so that a stream takes them in four batches. ``as_landed``: the rows of a file from
    the rows that are dealt to it, where those are fewer."""
    path = f"{run_dir}/source"
    n_files = max(4, int(spark.conf.get("spark.sql.shuffle.partitions")) // 4)
    df = as_landed(df.repartitionByRange(n_files, *order))
    df.write.parquet(path)
    return path, df.schema, -(-n_files // 4)


@register("stream_archive", RECORDS_SQL + "\nSELECT DISTINCT sha256(data_spec || chr(10) || raw_payload) AS record_hash, "
          "data_spec, record_type FROM rec")
def stream_archive_q(spark, sf_dir):
    """Records arrive as files; each content hash is archived once."""
    run = new_run_dir(spark, "archive")
    src, schema, n = _land(spark, records(spark, sf_dir), run, ["received_at", "event_id"])
    stream_archive(spark, src, schema, f"{run}/table", files_per_trigger=n)
    return archive_table(spark, f"{run}/table").read().select("record_hash", "data_spec", "record_type")


ODDS_SQL = testbed.SCORED_WITH + """,
o AS (SELECT race_id, CAST(horse_no AS VARCHAR) AS combination, jockey_id, l_shipdate AS snapshot_time, ticket_type, odds
      FROM (SELECT race_id, horse_no, jockey_id, l_shipdate, 'win' AS ticket_type, odds_win AS odds FROM scored
            UNION ALL SELECT race_id, horse_no, jockey_id, l_shipdate, 'place', odds_place_min FROM scored) WHERE odds IS NOT NULL),
r AS (SELECT *, row_number() OVER (PARTITION BY race_id, combination, ticket_type
                                   ORDER BY snapshot_time DESC, odds DESC, jockey_id DESC) AS rn FROM o)
SELECT race_id, combination, ticket_type, jockey_id, strftime(snapshot_time, '%Y-%m-%d %H:%M:%S') AS snapshot_time,
  round(odds, 6) AS odds FROM r WHERE rn = 1"""


@register("stream_odds", r6sql(ODDS_SQL))
def stream_odds_q(spark, sf_dir):
    """Snapshots arrive as files; the latest per (race, combination,
    ticket) is kept in a bucketed state table (replay-safe)."""
    df = testbed.scored(spark, sf_dir).select("race_id", "horse_no", "jockey_id", "l_shipdate", "odds_win", "odds_place_min")

    def snapshots(entries):
        return odds_to_snapshots(entries, "l_shipdate", {"win": "odds_win", "place": "odds_place_min"},
                                 keep=["race_id", "horse_no", "jockey_id"]).select(
            "race_id", F.col("horse_no").cast("string").alias("combination"), "jockey_id", "snapshot_time",
            "ticket_type", "odds")
    run = new_run_dir(spark, "odds")
    src, schema, n = _land(spark, df, run, ["l_shipdate", "race_id", "horse_no", "jockey_id"], snapshots)
    by = (["race_id", "combination", "ticket_type"], ["snapshot_time", "odds", "jockey_id"])
    stream_latest(spark, src, schema, f"{run}/table", *by, files_per_trigger=n)
    out = read_latest(spark, f"{run}/table", *by)
    return out.select("race_id", "combination", "ticket_type", "jockey_id",
                      F.date_format("snapshot_time", "yyyy-MM-dd HH:mm:ss").alias("snapshot_time"), r6("odds"))


STREAM_COVERAGE_SQL = COVERAGE_CTE + """,
ps AS (SELECT race_id, TRY_CAST(combination AS INTEGER) AS horse_no, snapshot_time FROM snaps
       WHERE ticket_type IN ('place', '複勝') AND TRY_CAST(combination AS INTEGER) IS NOT NULL
         AND (combination = CAST(TRY_CAST(combination AS INTEGER) AS VARCHAR)
              OR combination = lpad(CAST(TRY_CAST(combination AS INTEGER) AS VARCHAR), 2, '0')))
SELECT strftime(date_trunc('day', ps.snapshot_time), '%Y-%m-%d') AS day, te.race_id, count(DISTINCT te.horse_no) AS covered_entries
FROM ps JOIN te ON ps.race_id = te.race_id AND ps.horse_no = te.horse_no AND ps.snapshot_time <= te.cutoff_time
GROUP BY 1, 2"""


@register("stream_coverage", STREAM_COVERAGE_SQL)
def stream_coverage_q(spark, sf_dir):
    """Per race, entries covered by a snapshot at or before the
    cutoff, maintained as snapshots arrive (stream-static join into a set of
    covered entries per day)."""
    entries, snaps = _coverage_inputs(spark, sf_dir)
    place = _place_snapshots(snaps)
    run = new_run_dir(spark, "coverage")
    src, schema, n = _land(spark, place, run, ["snapshot_time", "race_id", "horse_no"])
    # the static side of a stream-static join is read every micro-batch: keep it stored
    stream_coverage(spark, src, schema, cut_lineage(entries), f"{run}/table", files_per_trigger=n)
    out = read_coverage(spark, f"{run}/table")
    return out.select(F.date_format("day", "yyyy-MM-dd").alias("day"), "race_id", "covered_entries")
