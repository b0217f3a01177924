"""History columns of one key group come from one window operator, and entities are
counted on the frame that costs less."""

import datetime
import re

from pyspark.sql import functions as F

from tessera.operators import history
from tessera.operators.history import Prior, with_priors

DAY = datetime.date(2024, 1, 1)
PRIORS = [Prior("runs", "count"), Prior("mean_a", "mean", "a"), Prior("mean_b", "mean", "b"), Prior("last2_a", "rolling", "a", 2),
          Prior("last3_b", "rolling", "b", 3), Prior("gap", "gap_days", "d"), Prior("c_runs", "count", keys=("c",)),
          Prior("c_mean", "mean", "a", keys=("c",))]


def _rows(spark):
    rows = [(i % 3, DAY + datetime.timedelta(days=i // 3), i, "xy"[i % 2], None if i % 5 == 0 else i, i / 4) for i in range(30)]
    return spark.createDataFrame(rows, "e int, d date, k int, c string, a int, b double")


def test_one_window_operator_per_key_group(spark):
    out = with_priors(_rows(spark), ["e"], ["d", "k"], PRIORS)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert len(re.findall(r"\+- Window \[|^Window \[", plan)) == 2
    assert out.columns == ["e", "d", "k", "c", "a", "b", *[p.name for p in PRIORS]]


def test_columns_are_as_one_at_a_time(spark):
    rows = _rows(spark)
    out = {r["k"]: r.asDict() for r in with_priors(rows, ["e"], ["d", "k"], PRIORS).collect()}
    for p in PRIORS:
        for r in with_priors(rows, ["e"], ["d", "k"], [p]).collect():
            assert out[r["k"]][p.name] == r[p.name]
    assert (out[9]["mean_a"], out[9]["last2_a"], out[9]["gap"], out[9]["runs"]) == (4.5, 4.5, 1, 3)


def test_entities_are_counted_on_the_given_frame(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(history, "heavy_entities", lambda df, *rest: seen.append(df.columns))
    rows = _rows(spark)
    with_priors(rows.withColumn("more", F.lit(1)), ["e"], ["d", "k"], [Prior("runs", "count")], sizes=rows)
    assert seen == [rows.columns]
