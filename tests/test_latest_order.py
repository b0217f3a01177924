"""Latest rows whose order names every column are sent once; odds are dealt before they are spread over tickets."""

from pyspark.sql import functions as F

from tessera.operators.latest import latest_per_key
from tessera.plans import cases_stream

SF = "/root/testdata/sf0.001"


def _plan(df):
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_an_order_of_all_columns_is_the_row(spark):
    rows = spark.createDataFrame([("a", 1, 5.0, 1), ("a", 2, None, 2), ("a", 2, 1.0, 3), ("a", None, 9.0, 4), (None, None, None, None),
                                  ("b", 3, float("nan"), 5), ("b", 3, 7.0, 6)], "k string, t int, odds double, j int")
    for desc in (True, False):
        got = latest_per_key(rows, ["k"], ["t", "odds", "j"], desc)
        assert got.columns == ["k", "t", "odds", "j"] and "max_by" not in _plan(got) and "min_by" not in _plan(got)
        want = latest_per_key(rows, ["k"], [F.col("t"), F.col("odds"), F.col("j")], desc)  # as columns: by the order beside the row
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    got = latest_per_key(rows, ["k"], ["t", "t", "odds", "j"])
    assert sorted(map(str, got.collect())) == sorted(map(str, latest_per_key(rows, ["k"], ["t", "odds", "j"]).collect()))
    assert "max_by" in _plan(latest_per_key(rows, ["k"], ["t", "odds"]))  # j is not in the order


def test_odds_are_dealt_once_per_entry(spark, monkeypatch):
    dealt = []
    real = cases_stream._land
    monkeypatch.setattr(cases_stream, "_land", lambda s, df, *a: dealt.append(df) or real(s, df, *a))
    cases_stream.stream_odds_q(spark, SF)
    assert "Generate explode" not in _plan(dealt[0]) and "odds_win" in dealt[0].columns
