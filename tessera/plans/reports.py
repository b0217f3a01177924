"""Report jobs: best/worst per metric, deltas to a baseline, threshold
optimisation (A16-A19, M19, M21)."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.betting import settle_columns
from tessera.operators.betting import PARAM_GRID, best_params, evaluate_grid
from tessera.operators.metrics import bet_metrics
from tessera.operators.rows import with_row
from tessera.operators.splits import split_by_date
from tessera.session import cut_lineage


def best_by(df: DataFrame, label: str, metrics: Sequence[str], count_col: str, higher: bool = True) -> DataFrame:
    """Per metric the label with the highest (and lowest) value, nulls
    skipped, ties to the smaller label; the mean of the metric and the total of
    ``count_col``.  One aggregate pass, exploded to one row per metric."""
    aggs = [F.sum(count_col).alias("__tot")]
    for m in metrics:
        ok = F.col(m).isNotNull()
        top = F.struct((-F.col(m)) if higher else F.col(m), F.col(label))
        low = F.struct(F.col(m) if higher else (-F.col(m)), F.col(label))
        aggs += [F.min_by(F.col(label), F.when(ok, top)).alias(f"{m}__b"),
                 (F.max(m) if higher else F.min(m)).alias(f"{m}__v"),
                 F.min_by(F.col(label), F.when(ok, low)).alias(f"{m}__w"), F.avg(m).alias(f"{m}__m")]
    one = df.agg(*aggs)
    rows = F.array(*[F.struct(F.lit(m).alias("metric"), F.col(f"{m}__b").alias("best_label"),
                              F.col(f"{m}__v").cast("double").alias("best_value"),
                              F.col(f"{m}__w").alias("worst_label"), F.col(f"{m}__m").alias("mean_value"),
                              F.col("__tot").alias("total_bets")) for m in metrics])
    return one.select(F.explode(rows).alias("__r")).select("__r.*")


def delta_to_baseline(df: DataFrame, label: str, baseline: str, metrics: Sequence[str]) -> DataFrame:
    """Every row's metrics minus those of the (single) baseline row."""
    base = df.where(F.col(label) == baseline).select(*[F.col(m).alias(f"__b_{m}") for m in metrics])
    out = with_row(df, base)
    return out.select(label, *[(F.col(m) - F.col(f"__b_{m}")).alias(f"{m}_delta") for m in metrics])


def optimise_thresholds(df: DataFrame, date: str, order: Sequence, grid: dict = PARAM_GRID,
                        min_bets: int = 50, race: str = "race_id", valid: float = 0.2, test: float = 0.2) -> DataFrame:
    """Split labelled rows by date, search the grid on the valid dates only,
    pick the best set (O3) and evaluate it once on the test dates.  One row:
    chosen thresholds, valid and test metrics, races per split (A16)."""
    # the split frame is read by several passes (grid, ordered scans, test, counts)
    s = cut_lineage(split_by_date(df, date, valid, test))
    gv = evaluate_grid(s.where(F.col("split") == "valid"), order, grid)
    best = best_params(gv, min_bets)
    params = list(grid.keys())
    chosen = best.select(*[F.col(p).alias(f"__t_{p}") for p in params])
    t = with_row(s.where(F.col("split") == "test"), chosen)
    rule = ((F.col("expected_value_place") >= F.col("__t_min_expected_value_place"))
            & (F.col("value_gap") >= F.col("__t_min_value_gap"))
            & (F.col("bet_score") >= F.col("__t_min_bet_score"))
            & (F.col("model_uncertainty") <= F.col("__t_max_model_uncertainty")))
    bets = t.where(rule).withColumn("stake", F.lit(100.0)).withColumn(
        "hit", F.coalesce(F.col("target_place").cast("int") == 1, F.lit(False)))
    # The return of a hit is the payout itself (stake 100)
    bets = bets.withColumn("return_amount", F.when(F.col("hit"), F.coalesce(F.col("payout_place").cast("double"),
                                                                             F.lit(0.0))).otherwise(0.0))
    bets = bets.withColumn("profit", F.col("return_amount") - F.col("stake"))
    tm = bet_metrics(bets, order).select(
        F.coalesce("roi", F.lit(0.0)).alias("test_roi"), F.coalesce("hit_rate", F.lit(0.0)).alias("test_hit_rate"),
        F.col("bet_count").cast("long").alias("test_bet_count"), F.coalesce("profit", F.lit(0.0)).alias("test_profit"),
        F.coalesce("max_drawdown", F.lit(0.0)).alias("test_max_drawdown"))
    races = s.agg(*[F.count_distinct(F.when(F.col("split") == k, F.col(race))).alias(f"{k}_races")
                    for k in ("train", "valid", "test")])
    out = best.select("set_id", *params, F.col("roi").alias("valid_roi"), F.col("bet_count").alias("valid_bet_count"),
                      F.col("max_drawdown").alias("valid_max_drawdown"))
    return with_row(with_row(out, tm), races)
