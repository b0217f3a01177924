"""Sources, decoding helpers and merges on small frames."""

import datetime as dt

from pyspark.sql import functions as F

from tessera.functions.parse import finish_seconds, first_int, join_parts, last_int, start_minutes, strip_chars
from tessera.operators.upsert import DuplicateKeyError, upsert
from tessera.plans.jobs import entries_from_raw, odds_to_snapshots


def test_finish_time_and_corner_parsing(spark):
    df = spark.createDataFrame([(" 1272 ", "02-03-01-01"), ("1:27.2", ""), ("bad", None)], "t string, c string")
    got = df.select(finish_seconds("t").alias("s"), first_int("c").alias("f"), last_int("c").alias("l")).collect()
    assert [r.s for r in got] == [87.2, 87.2, None]
    assert [(r.f, r.l) for r in got] == [(2, 1), (None, None), (None, None)]


def test_start_time_and_parts(spark):
    df = spark.createDataFrame([("1530", "01", "00", " 03"), ("9:05", "", "", ""), ("TBA", None, "02", "")],
                               "t string, a string, b string, c string")
    got = df.select(start_minutes("t").alias("m"), join_parts(["a", "b", "c"]).alias("j"),
                    strip_chars(F.concat(F.lit("　 x "), F.lit("\u0000"))).alias("s")).collect()
    assert [r.m for r in got] == [930, 545, None]
    assert [r.j for r in got] == ["01-03", None, "02"]
    assert got[0].s == "x"


def test_upsert_rules(spark):
    tgt = spark.createDataFrame([(1, "a", 10.0, dt.datetime(2024, 1, 1)), (2, "b", 20.0, dt.datetime(2024, 1, 1))],
                                "k int, s string, v double, imported_at timestamp_ntz")
    src = spark.createDataFrame([(2, None, 21.0, dt.datetime(2024, 2, 1)), (3, "c", 30.0, dt.datetime(2024, 2, 1))],
                                "k int, s string, v double, imported_at timestamp_ntz")
    plain = {r.k: r for r in upsert(tgt, src, ["k"]).collect()}
    assert plain[2].s is None and plain[2].v == 21.0 and plain[2].imported_at == dt.datetime(2024, 1, 1)
    assert plain[3].imported_at == dt.datetime(2024, 2, 1) and plain[1].v == 10.0
    keep = {r.k: r for r in upsert(tgt, src, ["k"], keep_if_null=["s"]).collect()}
    assert keep[2].s == "b"
    ins = {r.k: r for r in upsert(tgt, src, ["k"], insert_only=True).collect()}
    assert ins[2].v == 20.0 and ins[3].v == 30.0
    dup = src.unionByName(src)
    try:
        upsert(tgt, dup, ["k"])
        raise AssertionError("duplicate keys must fail")
    except DuplicateKeyError:
        pass
    latest = {r.k: r for r in upsert(tgt, dup.withColumn("v", F.col("v") + F.col("k")), ["k"], on_duplicate="latest",
                                     order=["v"]).collect()}
    assert latest[3].v == 33.0


def test_odds_snapshots_capture_flag(spark):
    df = spark.createDataFrame([("r", 1, 2.0, None, dt.datetime(2024, 1, 1))], "race_id string, horse_no int, w double, p double, t timestamp_ntz")
    live = odds_to_snapshots(df, "t", {"win": "w", "place": "p"}, ["race_id", "horse_no"], capture=True).collect()
    assert [(r.ticket_type, r.odds) for r in live] == [("win", 2.0)]
    assert odds_to_snapshots(df, "t", {"win": "w", "place": "p"}, ["race_id", "horse_no"], capture=False).count() == 0


def test_csv_fallback_view(spark):
    races = spark.createDataFrame([("r1", 8)], "race_id string, field_size int")
    entries = spark.createDataFrame([("r1", "h1", 1), ("r1", "h2", 2)], "race_id string, horse_id string, horse_no int")
    results = spark.createDataFrame([("r1", "h1", 3)], "race_id string, horse_id string, finish_position int")
    payouts = spark.createDataFrame([("r1", "place", "01", 150), ("r1", "win", "1", 300)],
                                    "race_id string, ticket_type string, combination string, payout int")
    got = {r.horse_id: r for r in entries_from_raw(races, entries, results, payouts).collect()}
    assert (got["h1"].target_place, got["h1"].payout_place) == (1, 150)
    assert (got["h2"].target_place, got["h2"].payout_place) == (None, None)
