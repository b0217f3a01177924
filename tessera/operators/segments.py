"""Segment report (A12, P9, F18, O4): many groupings in one pass.

Each settled bet is expanded into one (segment, value) pair per segment
column (a constant factor), then a single ``groupBy`` with partial
aggregation produces every segment's metrics.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.bins import (EV_EDGES, EV_LABELS, ODDS_EDGES, ODDS_LABELS, POPULARITY_EDGES,
                                    POPULARITY_LABELS, bins_right)

# Segment columns of the report, and the label of a null group.
SEGMENT_COLUMNS = ("course", "distance", "ground_condition", "popularity_band", "odds_band",
                   "expected_value_band", "year", "month")
NULL_LABEL = "<NA>"


def add_segment_bins(df: DataFrame, date: str = "race_date", open_last_popularity: bool = False) -> DataFrame:
    """Year, year-month and the three right-closed bands."""
    def num(c):
        return F.col(c).try_cast("double") if c in df.columns else F.lit(None).cast("double")
    return (df.withColumn("year", F.year(date).cast("string"))
              .withColumn("month", F.date_format(date, "yyyy-MM"))
              .withColumn("popularity_band", bins_right(num("popularity"), POPULARITY_EDGES, POPULARITY_LABELS,
                                                        open_last=open_last_popularity))
              .withColumn("odds_band", bins_right(num("odds_place_min"), ODDS_EDGES, ODDS_LABELS))
              .withColumn("expected_value_band", bins_right(num("expected_value_place"), EV_EDGES, EV_LABELS)))


def segment_report(bets: DataFrame, segments: Sequence[str] = SEGMENT_COLUMNS) -> DataFrame:
    """(segment, value, stake, return, profit, roi, bet_count, hit_rate)
    for every present segment column; a null value is its own group."""
    present = [s for s in segments if s in bets.columns]
    pairs = F.array(*[F.struct(F.lit(s).alias("segment"),
                               F.coalesce(F.col(s).cast("string"), F.lit(NULL_LABEL)).alias("value"))
                      for s in present])
    long = bets.select(F.explode(pairs).alias("__p"), "stake", "return_amount", "profit", "hit")
    g = long.groupBy("__p.segment", "__p.value").agg(
        F.sum(F.col("stake").cast("double")).alias("stake"), F.sum("return_amount").alias("return"),
        F.sum("profit").alias("profit"), F.count(F.lit(1)).alias("bet_count"),
        F.avg(F.col("hit").cast("double")).alias("hit_rate"))
    return g.withColumn("roi", F.when(F.col("stake") != 0, F.col("return") / F.col("stake")).otherwise(0.0))


def worst_segments(report: DataFrame, n: int = 30) -> DataFrame:
    """The ``n`` lowest-ROI segments, most bets first among equals (a
    top-k: ``TakeOrderedAndProject``, no full sort)."""
    return report.orderBy(F.col("roi").asc(), F.col("bet_count").desc(), "segment", "value").limit(n)
