"""Rows that several steps read are stored once, and ranks of small groups send nothing."""

import random

import pytest

from tessera.operators.groupnorm import group_rank
from tessera.plans import cases_betting, cases_ml

SF = "/root/testdata/sf0.001"


def test_bet_metrics_reads_stored_rows(spark, monkeypatch):
    kept, real = [], cases_betting.stored
    monkeypatch.setattr(cases_betting, "stored", lambda df, name: kept.append(real(df, name)) or kept[-1])
    out = cases_betting.bet_metrics_q(spark, SF)
    assert len(kept) == 1 and "lineitem" not in "".join(out.inputFiles())


def test_the_models_frame_is_a_table(spark):
    df = spark.createDataFrame([(1, 2.0, None), (2, None, "x")], "race_id int, hist_x double, course string")
    held = cases_ml.cut_lineage(df)
    assert all(f.endswith(".parquet") for f in held.inputFiles()) and len(held.inputFiles()) > 0
    assert sorted(map(tuple, held.collect()), key=repr) == sorted(map(tuple, df.collect()), key=repr)


@pytest.mark.parametrize("ascending", [True, False])
def test_ranks_of_small_groups_send_nothing_and_are_the_same(spark, ascending):
    rnd = random.Random(1)
    rows = [(rnd.choice([1, 2, 3, None]), rnd.choice([None, 0.0, -0.0, 1.5, 2.0, float("nan"), float("inf")]), i) for i in range(80)]
    df = spark.createDataFrame(rows, "g int, v double, i int")
    dealt = df.repartition("g")
    ranked = group_rank(dealt, "g", "v", "r", ascending)
    by_counts = group_rank(df, "g", "v", "r", ascending, piece=1)
    get = lambda d: {x.i: x.r for x in d.collect()}
    assert get(ranked) == get(by_counts)
    plan = ranked._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and "Aggregate" not in plan
