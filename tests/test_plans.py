"""Physical-plan checks: the shapes that decide behaviour at scale."""

from tessera.plans import cases_core, cases_history, cases_time
from tessera.plans.cases_betting import _selected

SF = "/root/testdata/sf0.001"


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_asof_has_no_nested_loop_join(spark):
    for fn in (cases_time.asof_strict, cases_time.asof_inclusive, cases_time.coverage, cases_time.training_features,
               cases_time.range_agg_days):
        plan = _plan(fn(spark, SF))
        assert "NestedLoopJoin" not in plan and "CartesianProduct" not in plan


def test_grid_shuffles_the_rows_once(spark):
    """All threshold sets are evaluated over one range exchange of the rows."""
    from tessera.operators.betting import evaluate_grid
    rows = spark.createDataFrame([(1, 1.2, 0.1, 0.1, 0.05, 1, 150.0)],
                                 "i int, expected_value_place double, value_gap double, bet_score double, "
                                 "model_uncertainty double, target_place int, payout_place double")
    plan = _plan(evaluate_grid(rows, ["i"]))
    assert plan.count("Exchange rangepartitioning") == 1, plan


def test_parquet_scans_are_pruned_and_filtered(spark):
    df = cases_core.sync_upsert(spark, SF)
    plan = _plan(df)
    assert "PushedFilters: [IsNotNull(o_orderdate), LessThan(o_orderdate" in plan
    assert "ReadSchema: struct<o_orderkey:bigint,o_custkey:bigint,o_orderstatus:string,o_totalprice:double,o_orderdate" in plan


def test_no_cross_join_in_bet_selection(spark):
    plan = _plan(_selected(spark, SF))
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan


def test_odds_merge_inside_the_record(spark):
    """The two odds blocks of a record are merged without an exchange."""
    from tessera.plans import decode
    rec = spark.createDataFrame([("h", "O1" + "0" * 700)], "record_hash string, raw_payload string")
    assert "Exchange" not in _plan(decode.decode_odds(rec))


def test_payout_match_joins_on_race_and_text(spark):
    plan = _plan(cases_core.best_match_q(spark, SF))
    joins = [line for line in plan.split("\n") if "Join [race_id" in line]
    assert joins and all("__text" in line or "<=>" in line or line.count("race_id") + line.count("coalesce") > 2 for line in joins), joins
    assert "NestedLoopJoin" not in plan and "CartesianProduct" not in plan
