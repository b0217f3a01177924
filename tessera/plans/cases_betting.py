"""Betting, evaluation and split queries (P11-P15, P20, A8-A19, J16, M1, M2, M5,
M14, M19-M21, O3, O4, T1, G11, F15, F18)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions.targets import place_target
from tessera.operators.betting import PARAM_GRID, best_params, evaluate_grid, grid_rows, select_bets
from tessera.operators.metrics import bet_metrics, binary_metrics, settle
from tessera.operators.scan import max_drawdown
from tessera.operators.segments import add_segment_bins, segment_report, worst_segments
from tessera.operators.splits import split_by_date, split_by_years
from tessera.plans import testbed
from tessera.plans.catalog import r6, r6sql, register
from tessera.plans.cases_features import ID_COLS, VALUE_CTE, valued
from tessera.plans.reports import best_by, delta_to_baseline
from tessera.session import stored, table_path

ROW_ORDER = ["race_date", "race_id", "horse_no", "horse_id", "jockey_id", "l_extendedprice"]
ROW_ORDER_SQL = ", ".join(ROW_ORDER)

# what bets are chosen, settled and grouped by, beside the order
BET_INPUTS = ["course", "expected_value_place", "value_gap", "bet_score", "model_uncertainty", "target_place", "payout_place"]


def base_frame(spark, sf_dir):
    """Scored entries with value columns, the place target and a place payout."""
    df = valued(testbed.scored(spark, sf_dir))
    return (df.withColumn("target_place", place_target("finish_position", "field_size"))
              .withColumn("payout_place", (F.lit(100) + F.col("l_quantity").cast("int") * 10).cast("int"))
              .withColumn("ground_condition", F.col("surface")))


BASE_SQL = testbed.SCORED_WITH + VALUE_CTE + """,
bb AS (SELECT *,
    CASE WHEN finish_position IS NOT NULL AND field_size >= 5 THEN CAST(finish_position >= 1 AND finish_position <= if(field_size >= 8, 3, 2) AS INTEGER) END AS target_place,
    CAST(100 + CAST(l_quantity AS INTEGER) * 10 AS INTEGER) AS payout_place,
    surface AS ground_condition FROM v2),
q AS (SELECT quantile_cont(score, 0.75) AS q75, quantile_cont(score, 0.9) AS q90 FROM bb),
sb AS (SELECT bb.*, coalesce(ev >= 1.05 AND gap >= 0.03 AND score >= 0.02 AND unc <= 0.10, false) AS buy,
         CASE WHEN score >= q90 THEN 1000 WHEN score >= q75 THEN 500 ELSE 300 END AS base_stake FROM bb, q),
sel AS (SELECT *, CASE WHEN buy THEN 'BUY' ELSE 'SKIP' END AS action,
          CAST(CASE WHEN NOT buy THEN 0
               WHEN unc > 0.06 AND unc <= 0.10 THEN CASE base_stake WHEN 1000 THEN 500 WHEN 500 THEN 300 WHEN 300 THEN 100 ELSE 100 END
               ELSE base_stake END AS INTEGER) AS stake FROM sb),
st AS (SELECT *, coalesce(target_place = 1, false) AS hit,
         CASE WHEN coalesce(target_place = 1, false) THEN CAST(stake AS DOUBLE) * coalesce(CAST(payout_place AS DOUBLE), 0.0) / 100.0 ELSE 0.0 END AS return_amount
       FROM sel WHERE action = 'BUY'),
st2 AS (SELECT *, return_amount - CAST(stake AS DOUBLE) AS profit FROM st)"""


def _selected(spark, sf_dir):
    return select_bets(base_frame(spark, sf_dir))


def _settled(spark, sf_dir):
    return settle(_selected(spark, sf_dir))


@register("select_bets", BASE_SQL + "\nSELECT race_id, horse_id, horse_no, jockey_id, action, stake FROM sel")
def select_bets_q(spark, sf_dir):
    """Thresholds, quantile stakes over all rows, step-down."""
    return _selected(spark, sf_dir).select(*ID_COLS, "action", "stake")


@register("settle", r6sql(BASE_SQL + """
SELECT race_id, horse_id, horse_no, jockey_id, CAST(stake AS DOUBLE) AS stake, hit,
  round(return_amount, 6) AS return_amount, round(profit, 6) AS profit FROM st2"""))
def settle_q(spark, sf_dir):
    """Settled BUY rows: hit, return = stake x payout / 100, profit."""
    return _settled(spark, sf_dir).select(*ID_COLS, "stake", "hit", r6("return_amount"), r6("profit"))


DD_CTE = f""",
eq AS (SELECT *, sum(profit) OVER (PARTITION BY {{part}} ORDER BY {ROW_ORDER_SQL} ROWS UNBOUNDED PRECEDING) AS equity FROM st2),
dd AS (SELECT *, max(equity) OVER (PARTITION BY {{part}} ORDER BY {ROW_ORDER_SQL} ROWS UNBOUNDED PRECEDING) - equity AS d FROM eq)"""


@register("bet_metrics", r6sql(BASE_SQL + DD_CTE.format(part="course") + """
SELECT course, count(*) AS bet_count, round(avg(CAST(hit AS DOUBLE)), 6) AS hit_rate,
  round(CASE WHEN sum(stake) > 0 THEN sum(return_amount) / sum(stake) ELSE 0.0 END, 6) AS roi,
  round(sum(profit), 6) AS profit, round(max(d), 6) AS max_drawdown FROM dd GROUP BY course"""))
def bet_metrics_q(spark, sf_dir):
    """Count, hit rate, ROI, profit and max drawdown per course."""
    # read by the stakes' quantiles (counts, bounds, ranks) and by the fold and its range bounds: computed once
    rows = stored(base_frame(spark, sf_dir).select(*ROW_ORDER, *BET_INPUTS), "valued")
    m = bet_metrics(settle(select_bets(rows)), ROW_ORDER, by=["course"])
    return m.select("course", "bet_count", r6("hit_rate"), r6("roi"), r6("profit"), r6("max_drawdown"))


@register("max_drawdown", r6sql(BASE_SQL + DD_CTE.format(part="1") + """
SELECT round(max(d), 6) AS max_drawdown, round(sum(profit), 6) AS profit FROM dd"""))
def max_drawdown_q(spark, sf_dir):
    """Global running equity and drawdown without a single-task window."""
    # read by the drawdown's range bounds, its fold and the total: computed once
    bets = stored(_settled(spark, sf_dir).select(*ROW_ORDER, "profit"), "settled")
    dd = max_drawdown(bets, ROW_ORDER, "profit")
    total = bets.agg(F.sum("profit").alias("profit"))
    from tessera.operators.rows import with_row
    return with_row(dd, total).select(r6("max_drawdown"), r6("profit"))


def _grid_values_sql():
    vals = ", ".join(f"({i}, {r['min_expected_value_place']}, {r['min_value_gap']}, {r['min_bet_score']}, "
                     f"{r['max_model_uncertainty']})" for i, r in enumerate(grid_rows()))
    return (f"grid AS (SELECT * FROM (VALUES {vals}) g(set_id, min_expected_value_place, min_value_gap, "
            f"min_bet_score, max_model_uncertainty))")


def _grid_metrics_sql(rows_cte, name):
    return f""",
{name}_b AS (SELECT g.set_id, r.*, coalesce(r.target_place = 1, false) AS hit,
      CASE WHEN coalesce(r.target_place = 1, false) THEN coalesce(CAST(r.payout_place AS DOUBLE), 0.0) ELSE 0.0 END AS ret
    FROM grid g JOIN {rows_cte} r ON r.ev >= g.min_expected_value_place AND r.gap >= g.min_value_gap
      AND r.score >= g.min_bet_score AND r.unc <= g.max_model_uncertainty),
{name}_e AS (SELECT *, sum(ret - 100.0) OVER (PARTITION BY set_id ORDER BY {ROW_ORDER_SQL} ROWS UNBOUNDED PRECEDING) AS equity FROM {name}_b),
{name}_d AS (SELECT *, max(equity) OVER (PARTITION BY set_id ORDER BY {ROW_ORDER_SQL} ROWS UNBOUNDED PRECEDING) - equity AS d FROM {name}_e),
{name}_a AS (SELECT set_id, count(*) AS n, avg(CAST(hit AS DOUBLE)) AS hr, sum(ret) AS ret, sum(ret - 100.0) AS profit, max(d) AS dd
    FROM {name}_d GROUP BY set_id),
{name} AS (SELECT g.*, CASE WHEN coalesce(a.n, 0) > 0 THEN a.ret / (a.n * 100.0) ELSE 0.0 END AS roi,
      coalesce(a.hr, 0.0) AS hit_rate, CAST(coalesce(a.n, 0) AS BIGINT) AS bet_count, coalesce(a.profit, 0.0) AS profit,
      coalesce(a.dd, 0.0) AS max_drawdown FROM grid g LEFT JOIN {name}_a a USING (set_id))"""


GRID_SQL = BASE_SQL + ",\n" + _grid_values_sql() + """,
lab AS (SELECT * FROM bb WHERE target_place IS NOT NULL AND race_date IS NOT NULL)""" + _grid_metrics_sql("lab", "gm") + """
SELECT set_id, min_expected_value_place, min_value_gap, min_bet_score, max_model_uncertainty, round(roi, 6) AS roi,
  round(hit_rate, 6) AS hit_rate, bet_count, round(profit, 6) AS profit, round(max_drawdown, 6) AS max_drawdown FROM gm"""

GRID_OUT = ["set_id", *PARAM_GRID.keys()]


def _grid_out(df):
    return df.select(*GRID_OUT, r6("roi"), r6("hit_rate"), "bet_count", r6("profit"), r6("max_drawdown"))


def _labelled(spark, sf_dir):
    return base_frame(spark, sf_dir).dropna(subset=["race_date", "target_place"])


@register("threshold_grid", r6sql(GRID_SQL))
def threshold_grid(spark, sf_dir):
    """Metrics of all 90 threshold sets on labelled rows."""
    return _grid_out(evaluate_grid(_labelled(spark, sf_dir), ROW_ORDER))


SPLIT_CTE = """,
dts AS (SELECT DISTINCT race_date AS d FROM lab),
dn AS (SELECT d, row_number() OVER (ORDER BY d) AS r, count(*) OVER () AS n FROM dts),
dk AS (SELECT *, greatest(1, CAST(round_even(n * 0.2, 0) AS BIGINT)) AS tn0, greatest(1, CAST(round_even(n * 0.2, 0) AS BIGINT)) AS vn0 FROM dn),
dk2 AS (SELECT *, CASE WHEN n - tn0 - vn0 < 1 THEN 1 ELSE tn0 END AS tn, CASE WHEN n - tn0 - vn0 < 1 THEN 1 ELSE vn0 END AS vn FROM dk),
spl AS (SELECT d, CASE WHEN r > n - tn THEN 'test' WHEN r > n - tn - vn THEN 'valid' ELSE 'train' END AS split FROM dk2),
labs AS (SELECT lab.*, spl.split FROM lab JOIN spl ON lab.race_date = spl.d),
valid_rows AS (SELECT * FROM labs WHERE split = 'valid'),
test_rows AS (SELECT * FROM labs WHERE split = 'test')"""

BEST_SQL = BASE_SQL + ",\n" + _grid_values_sql() + """,
lab AS (SELECT * FROM bb WHERE target_place IS NOT NULL AND race_date IS NOT NULL)""" + SPLIT_CTE \
    + _grid_metrics_sql("valid_rows", "gv") + _grid_metrics_sql("test_rows", "gt") + """,
pick AS (SELECT * FROM gv WHERE bet_count >= 50 OR NOT EXISTS (SELECT 1 FROM gv WHERE bet_count >= 50)
         ORDER BY roi DESC, bet_count DESC, max_drawdown ASC, set_id LIMIT 1),
split_races AS (SELECT count(DISTINCT race_id) FILTER (WHERE split = 'train') AS train_races,
                 count(DISTINCT race_id) FILTER (WHERE split = 'valid') AS valid_races,
                 count(DISTINCT race_id) FILTER (WHERE split = 'test') AS test_races FROM labs)
SELECT pick.set_id, pick.min_expected_value_place, pick.min_value_gap, pick.min_bet_score, pick.max_model_uncertainty,
  round(pick.roi, 6) AS valid_roi, pick.bet_count AS valid_bet_count, round(pick.max_drawdown, 6) AS valid_max_drawdown,
  round(gt.roi, 6) AS test_roi, round(gt.hit_rate, 6) AS test_hit_rate, gt.bet_count AS test_bet_count,
  round(gt.profit, 6) AS test_profit, round(gt.max_drawdown, 6) AS test_max_drawdown,
  split_races.train_races, split_races.valid_races, split_races.test_races
FROM pick JOIN gt USING (set_id), split_races"""


@register("threshold_best", r6sql(BEST_SQL))
def threshold_best(spark, sf_dir):
    """Thresholds chosen on the valid dates, evaluated once on test."""
    from tessera.plans.reports import optimise_thresholds
    rep = optimise_thresholds(_labelled(spark, sf_dir), "race_date", ROW_ORDER)
    return rep.select(*GRID_OUT, r6("valid_roi"), "valid_bet_count", r6("valid_max_drawdown"), r6("test_roi"),
                      r6("test_hit_rate"), "test_bet_count", r6("test_profit"), r6("test_max_drawdown"),
                      "train_races", "valid_races", "test_races")


def _band(col, edges, labels):
    parts = []
    for i, lab in enumerate(labels):
        lo, hi = edges[i], edges[i + 1]
        cond = f"{col} >= {lo}" if i == 0 else f"{col} > {lo}"
        if hi != float("inf"):
            cond += f" AND {col} <= {hi}"
        parts.append(f"WHEN {cond} THEN '{lab}'")
    return "CASE " + " ".join(parts) + " END"


SEG_SQL = BASE_SQL + f""",
sg AS (SELECT *, CAST(year(race_date) AS VARCHAR) AS year, strftime(race_date, '%Y-%m') AS month,
  {_band('CAST(popularity AS DOUBLE)', (0, 3, 6, 10, 18), ('1-3', '4-6', '7-10', '11+'))} AS popularity_band,
  {_band('odds_place_min', (0, 1.5, 2.0, 3.0, float('inf')), ('0-1.5', '1.5-2.0', '2.0-3.0', '3.0+'))} AS odds_band,
  {_band('ev', (0, 1.10, 1.25, 1.50, float('inf')), ('0-1.10', '1.10-1.25', '1.25-1.50', '1.50+'))} AS expected_value_band
  FROM st2),
lng AS (""" + "\n  UNION ALL ".join(
    f"SELECT '{s}' AS segment, coalesce(CAST({s} AS VARCHAR), '<NA>') AS value, stake, return_amount, profit, hit FROM sg"
    for s in ("course", "distance", "ground_condition", "popularity_band", "odds_band", "expected_value_band",
              "year", "month")) + """),
rep AS (SELECT segment, value, sum(CAST(stake AS DOUBLE)) AS stake, sum(return_amount) AS "return", sum(profit) AS profit,
  count(*) AS bet_count, avg(CAST(hit AS DOUBLE)) AS hit_rate FROM lng GROUP BY segment, value),
rep2 AS (SELECT *, CASE WHEN stake <> 0 THEN "return" / stake ELSE 0.0 END AS roi FROM rep)"""

SEG_COLS = ("segment, value, round(stake, 6) AS stake, round(\"return\", 6) AS \"return\", round(profit, 6) AS profit, "
            "round(roi, 6) AS roi, bet_count, round(hit_rate, 6) AS hit_rate")


def _segments(spark, sf_dir):
    return segment_report(add_segment_bins(_settled(spark, sf_dir)))


def _seg_out(df):
    return df.select("segment", "value", r6("stake"), r6("return"), r6("profit"), r6("roi"), "bet_count", r6("hit_rate"))


@register("segment_report", r6sql(SEG_SQL + f"\nSELECT {SEG_COLS} FROM rep2"))
def segment_report_q(spark, sf_dir):
    """Stake, return, profit, ROI, count and hit rate per segment value."""
    return _seg_out(_segments(spark, sf_dir))


@register("worst_segments", r6sql(SEG_SQL + f"\nSELECT {SEG_COLS} FROM rep2 ORDER BY roi ASC, bet_count DESC, segment, value LIMIT 30"))
def worst_segments_q(spark, sf_dir):
    """The 30 lowest-ROI segments."""
    return _seg_out(worst_segments(_segments(spark, sf_dir), 30))


BIN_SQL = BASE_SQL + """,
lb AS (SELECT surface, CAST(target_place AS DOUBLE) AS y, least(greatest(ens, 1e-6), 1 - 1e-6) AS p FROM bb
       WHERE target_place IS NOT NULL AND ens IS NOT NULL),
cnt AS (SELECT surface, p, sum(y) AS pos, sum(1 - y) AS neg FROM lb GROUP BY surface, p),
cum AS (SELECT *, coalesce(sum(neg) OVER (PARTITION BY surface ORDER BY p ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM cnt),
auc AS (SELECT surface, sum(pos * (below + 0.5 * neg)) AS wins, sum(pos) AS P, sum(neg) AS N FROM cum GROUP BY surface),
ll AS (SELECT surface, avg(-(y * ln(p) + (1 - y) * ln(1 - p))) AS logloss, avg((p - y) * (p - y)) AS brier FROM lb GROUP BY surface)
SELECT surface, round(CASE WHEN P > 0 AND N > 0 THEN wins / (P * N) END, 6) AS auc, round(logloss, 6) AS logloss,
  round(brier, 6) AS brier FROM auc JOIN ll USING (surface)"""


@register("binary_metrics", r6sql(BIN_SQL))
def binary_metrics_q(spark, sf_dir):
    """Exact AUC with tied scores, log loss and Brier per surface."""
    m = binary_metrics(base_frame(spark, sf_dir), "target_place", "place_prob_ensemble_raw", by=["surface"])
    return m.select("surface", r6("auc"), r6("logloss"), r6("brier"))


SPLIT_SUMMARY_SQL = BASE_SQL + """,
lab AS (SELECT * FROM bb WHERE target_place IS NOT NULL AND race_date IS NOT NULL)""" + SPLIT_CTE + """
SELECT split, count(*) AS n_rows, count(DISTINCT race_id) AS n_races, strftime(min(race_date), '%Y-%m-%d') AS first_date,
  strftime(max(race_date), '%Y-%m-%d') AS last_date FROM labs GROUP BY split"""


def _split_summary(df):
    return df.groupBy("split").agg(F.count(F.lit(1)).alias("n_rows"), F.count_distinct("race_id").alias("n_races"),
                                   F.date_format(F.min("race_date"), "yyyy-MM-dd").alias("first_date"),
                                   F.date_format(F.max("race_date"), "yyyy-MM-dd").alias("last_date"))


@register("split_by_date", SPLIT_SUMMARY_SQL)
def split_by_date_q(spark, sf_dir):
    """Date split of labelled rows (last 20% of dates test, 20% valid)."""
    return _split_summary(split_by_date(_labelled(spark, sf_dir), "race_date"))


YEARS_SQL = testbed.TESTBED_SQL + """,
ys AS (SELECT *, CASE WHEN year(race_date) BETWEEN 1995 AND 1998 THEN 'train' WHEN year(race_date) BETWEEN 1999 AND 1999 THEN 'valid'
                      WHEN year(race_date) BETWEEN 2000 AND 2001 THEN 'test' END AS split FROM race_entries)
SELECT split, count(*) AS n_rows, count(DISTINCT race_id) AS n_races, strftime(min(race_date), '%Y-%m-%d') AS first_date,
  strftime(max(race_date), '%Y-%m-%d') AS last_date FROM ys GROUP BY split"""


@register("split_by_years", YEARS_SQL)
def split_by_years_q(spark, sf_dir):
    """M2: inclusive year ranges (train 1995-1998, valid 1999, test 2000-2001)."""
    df = split_by_years(testbed.race_entries(spark, sf_dir), "race_date", (1995, 1998), (1999, 1999), (2000, 2001))
    return _split_summary(df)


CURRENT_SQL = testbed.TESTBED_SQL + """,
hist AS (SELECT race_id, race_date, horse_id, horse_no, jockey_id, l_extendedprice, finish_position, field_size, false AS cur
         FROM race_entries WHERE race_date < DATE '2000-01-01'),
cur AS (SELECT race_id, race_date, horse_id, horse_no, jockey_id, l_extendedprice, NULL AS finish_position,
          CAST(count(horse_id) OVER (PARTITION BY race_id) AS INTEGER) AS field_size, true AS cur
        FROM race_entries WHERE race_date >= DATE '2000-01-01'),
u AS (SELECT * FROM hist UNION ALL SELECT * FROM cur),
f AS (SELECT *, CASE WHEN field_size >= 5 AND finish_position IS NOT NULL
                THEN CAST(finish_position <= CASE WHEN field_size >= 8 THEN 3 ELSE 2 END AS DOUBLE) END AS hit FROM u),
g AS (SELECT *,
  CAST(row_number() OVER (PARTITION BY horse_id ORDER BY race_date, race_id, horse_no, jockey_id, l_extendedprice) - 1 AS BIGINT) AS hist_runs,
  round(sum(CAST(finish_position AS DOUBLE)) OVER w / nullif(count(finish_position) OVER w, 0), 6) AS hist_avg_finish,
  round(sum(hit) OVER w / nullif(count(hit) OVER w, 0), 6) AS hist_place_rate
  FROM f WINDOW w AS (PARTITION BY horse_id ORDER BY race_date, race_id, horse_no, jockey_id, l_extendedprice
                      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))
SELECT race_id, horse_id, horse_no, jockey_id, field_size, hist_runs, hist_avg_finish, hist_place_rate FROM g WHERE cur"""


@register("current_with_history", r6sql(CURRENT_SQL))
def current_with_history(spark, sf_dir):
    """Unconfirmed rows (from 2000) appended to the confirmed
    history, features built over both, only the current rows kept; a missing
    field size defaults to the entries per race."""
    from tessera.plans.features import features_for_current
    re = testbed.race_entries(spark, sf_dir)
    cut = F.lit("2000-01-01").cast("date")
    cols = ["race_id", "race_date", "horse_id", "horse_no", "jockey_id", "l_extendedprice"]
    history = re.where(F.col("race_date") < cut).select(*cols, "finish_position", "field_size")
    current = re.where(F.col("race_date") >= cut).select(*cols)
    out = features_for_current(current, history, order=["race_date", "race_id", "horse_no", "jockey_id", "l_extendedprice"])
    return out.select("race_id", "horse_id", "horse_no", "jockey_id", "field_size", "hist_runs",
                      r6("hist_avg_finish"), r6("hist_place_rate"))


METRICS_TABLE_SQL = """WITH m AS (SELECT l_returnflag || l_linestatus AS label, avg(l_discount) AS roi, avg(l_tax) AS auc,
                 count(*) AS bet_count FROM lineitem GROUP BY 1)"""


def _metrics_table(spark, sf_dir):
    li = spark.read.parquet(table_path(sf_dir, "lineitem"))
    return li.groupBy(F.concat("l_returnflag", "l_linestatus").alias("label")).agg(
        F.avg("l_discount").alias("roi"), F.avg("l_tax").alias("auc"), F.count(F.lit(1)).alias("bet_count"))


BEST_BY_SQL = METRICS_TABLE_SQL + """
SELECT 'roi' AS metric, (SELECT label FROM m WHERE roi IS NOT NULL ORDER BY roi DESC, label LIMIT 1) AS best_label,
  round((SELECT max(roi) FROM m), 6) AS best_value, (SELECT label FROM m WHERE roi IS NOT NULL ORDER BY roi ASC, label LIMIT 1) AS worst_label,
  round(avg(roi), 6) AS mean_value, CAST(sum(bet_count) AS BIGINT) AS total_bets FROM m
UNION ALL
SELECT 'auc', (SELECT label FROM m WHERE auc IS NOT NULL ORDER BY auc DESC, label LIMIT 1), round((SELECT max(auc) FROM m), 6),
  (SELECT label FROM m WHERE auc IS NOT NULL ORDER BY auc ASC, label LIMIT 1), round(avg(auc), 6), CAST(sum(bet_count) AS BIGINT) FROM m"""


@register("best_by", r6sql(BEST_BY_SQL))
def best_by_q(spark, sf_dir):
    """Best and worst label per metric, fold mean, total bets."""
    out = best_by(_metrics_table(spark, sf_dir), "label", ["roi", "auc"], "bet_count")
    return out.select("metric", "best_label", r6("best_value"), "worst_label", r6("mean_value"),
                      F.col("total_bets").cast("long").alias("total_bets"))


DELTA_SQL = METRICS_TABLE_SQL + """
SELECT m.label, round(m.roi - b.roi, 6) AS roi_delta, round(m.auc - b.auc, 6) AS auc_delta
FROM m, (SELECT roi, auc FROM m WHERE label = 'NO') b"""


@register("delta_to_baseline", r6sql(DELTA_SQL))
def delta_to_baseline_q(spark, sf_dir):
    """Each row's metrics minus the baseline row's."""
    out = delta_to_baseline(_metrics_table(spark, sf_dir), "label", "NO", ["roi", "auc"])
    return out.select("label", r6("roi_delta"), r6("auc_delta"))
