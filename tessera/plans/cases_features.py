"""Feature queries: condition history, speed and running style, market set,
slot scaling, ensemble rows, value columns (G5-G7, G10, A20, P5, P6, P8, P10,
P16, F8, F9, F14)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions.betting import row_mean, row_std, row_weighted, value_columns
from tessera.functions.bins import distance_bucket
from tessera.functions.parse import finish_seconds, first_int, last_int
from tessera.functions.targets import place_hit
from tessera.operators.groupnorm import market_features, scale_to_slots
from tessera.operators.history import Prior, with_priors
from tessera.plans import testbed
from tessera.plans.catalog import r6, r6sql, register
from tessera.plans.cases_history import HORSE_ORDER, HORSE_ORDER_SQL
from tessera.plans.features import month_bucket

ID_COLS = ["race_id", "horse_id", "horse_no", "jockey_id"]


def _r(c):
    return r6(c)


def _w(part, frame="ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"):
    return f"(PARTITION BY {part} ORDER BY {HORSE_ORDER_SQL} {frame})"


EXACT = "decimal(28,9)"


def _prior_sql(value, part, frame="ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING"):
    """Prior mean with an exact decimal sum, divided once as double."""
    v = f"CAST({value} AS DECIMAL(28,9))"
    return (f"round(CAST(sum({v}) OVER {_w(part, frame)} AS DOUBLE)"
            f" / nullif(count({v}) OVER {_w(part, frame)}, 0), 6)")


HIT_SQL = ("CASE WHEN field_size >= 5 AND finish_position IS NOT NULL "
           "THEN CAST(finish_position <= CASE WHEN field_size >= 8 THEN 3 ELSE 2 END AS DOUBLE) END")
BUCKET_SQL = ("CASE WHEN distance >= 0 AND distance <= 1200 THEN 'sprint' WHEN distance > 1200 AND distance <= 1600 "
              "THEN 'mile' WHEN distance > 1600 AND distance <= 2000 THEN 'middle' WHEN distance > 2000 THEN 'long' END")
CONDITIONS = ["surface", "course", "distance_bucket"]

CONDITION_SQL = testbed.TESTBED_SQL + f""",
b AS (SELECT *, {HIT_SQL} AS hit, {BUCKET_SQL} AS distance_bucket FROM race_entries)
SELECT race_id, horse_id, horse_no, jockey_id, distance_bucket,
""" + ",\n".join(
    f"  CAST(row_number() OVER (PARTITION BY horse_id, {c} ORDER BY {HORSE_ORDER_SQL}) - 1 AS BIGINT) AS hist_{c}_runs,\n"
    f"  {_prior_sql('hit', 'horse_id, ' + c)} AS hist_{c}_place_rate" for c in CONDITIONS) + "\nFROM b"


@register("condition_history", r6sql(CONDITION_SQL))
def condition_history(spark, sf_dir):
    """G5 + P8: runs and place rate per horse x {surface, course, distance bucket}."""
    df = testbed.race_entries(spark, sf_dir).withColumn("distance_bucket", distance_bucket("distance"))
    df = df.withColumn("__hit", place_hit(F.col("finish_position"), "field_size"))
    priors = []
    for c in CONDITIONS:
        priors += [Prior(f"hist_{c}_runs", "count", keys=(c,)), Prior(f"hist_{c}_place_rate", "mean", "__hit", keys=(c,))]
    out = with_priors(df, ["horse_id"], HORSE_ORDER, priors, bucket=month_bucket("race_date"))
    return out.select(*ID_COLS, "distance_bucket",
                      *[x for c in CONDITIONS for x in (F.col(f"hist_{c}_runs"), _r(f"hist_{c}_place_rate"))])


SECONDS_SQL = """CASE WHEN regexp_full_match(ft, '\\d{4}') THEN (CAST(ft AS INTEGER) // 1000) * 60 + (CAST(ft AS INTEGER) % 1000) / 10.0
     WHEN regexp_full_match(ft, '(\\d+):(\\d{2})\\.(\\d)')
     THEN CAST(regexp_extract(ft, '^(\\d+):(\\d{2})\\.(\\d)$', 1) AS DOUBLE) * 60
        + CAST(regexp_extract(ft, '^(\\d+):(\\d{2})\\.(\\d)$', 2) AS DOUBLE)
        + CAST(regexp_extract(ft, '^(\\d+):(\\d{2})\\.(\\d)$', 3) AS DOUBLE) / 10.0 END"""

SPEED_SQL = testbed.SCORED_WITH + f""",
s0 AS (SELECT *, trim(finish_time) AS ft,
         CASE WHEN regexp_extract(corner_order, '^(\\d+)', 1) <> '' THEN CAST(regexp_extract(corner_order, '^(\\d+)', 1) AS INTEGER) END AS c_first,
         CASE WHEN regexp_extract(corner_order, '(\\d+)$', 1) <> '' THEN CAST(regexp_extract(corner_order, '(\\d+)$', 1) AS INTEGER) END AS c_last
       FROM scored),
s1 AS (SELECT *, {SECONDS_SQL} AS secs FROM s0),
s2 AS (SELECT *, distance / nullif(secs, 0) AS speed, c_first / nullif(field_size, 0) AS early,
         c_last / nullif(field_size, 0) AS final FROM s1),
s3 AS (SELECT *, CASE WHEN early IS NOT NULL THEN CAST(early <= 0.25 AS DOUBLE) END AS front FROM s2)
SELECT race_id, horse_id, horse_no, jockey_id, round(secs, 6) AS finish_seconds,
  {_prior_sql('speed', 'horse_id')} AS hist_avg_speed_mps,
  {_prior_sql('speed', 'horse_id', 'ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING')} AS hist_recent3_speed_mps,
  {_prior_sql('speed', 'horse_id', 'ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING')} AS hist_recent5_speed_mps,
  {_prior_sql('speed', 'horse_id, course, surface, distance')} AS hist_course_distance_speed_mps,
  {_prior_sql('early', 'horse_id')} AS hist_avg_early_position_ratio,
  {_prior_sql('final', 'horse_id')} AS hist_avg_final_corner_ratio,
  {_prior_sql('early', 'horse_id', 'ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING')} AS hist_recent3_early_position_ratio,
  {_prior_sql('front', 'horse_id')} AS hist_front_runner_rate
FROM s3"""


@register("speed_style_history", r6sql(SPEED_SQL))
def speed_style_history(spark, sf_dir):
    """Finish-time parsing, speed and running-style history."""
    df = testbed.scored(spark, sf_dir)
    secs = finish_seconds("finish_time")
    size = F.nullif(F.col("field_size"), F.lit(0))
    df = (df.withColumn("finish_seconds", secs)
            .withColumn("__speed", F.col("distance") / F.nullif(F.col("finish_seconds"), F.lit(0.0)))
            .withColumn("__early", first_int("corner_order") / size)
            .withColumn("__final", last_int("corner_order") / size)
            .withColumn("__front", F.when(F.col("__early").isNotNull(), (F.col("__early") <= 0.25).cast("double"))))
    for c in ["__speed", "__early", "__final", "__front"]:
        df = df.withColumn(c, F.col(c).cast(EXACT))
    priors = [
        Prior("hist_avg_speed_mps", "mean", "__speed"),
        Prior("hist_recent3_speed_mps", "rolling", "__speed", 3),
        Prior("hist_recent5_speed_mps", "rolling", "__speed", 5),
        Prior("hist_course_distance_speed_mps", "mean", "__speed", keys=("course", "surface", "distance")),
        Prior("hist_avg_early_position_ratio", "mean", "__early"),
        Prior("hist_avg_final_corner_ratio", "mean", "__final"),
        Prior("hist_recent3_early_position_ratio", "rolling", "__early", 3),
        Prior("hist_front_runner_rate", "mean", "__front"),
    ]
    out = with_priors(df, ["horse_id"], HORSE_ORDER, priors, bucket=month_bucket("race_date"))
    return out.select(*ID_COLS, _r("finish_seconds"), *[_r(p.name) for p in priors])


MARKET_SQL = testbed.SCORED_WITH + """,
m AS (SELECT *, CASE WHEN odds_place_min IS NOT NULL THEN 1.0 / greatest(odds_place_min, 1.01) END AS mp FROM scored),
t AS (SELECT race_id, CAST(coalesce(sum(CAST(mp AS DECIMAL(28,9))), 0) AS DOUBLE) AS tot FROM m GROUP BY race_id)
SELECT race_id, horse_id, horse_no, jockey_id, odds_place_min,
  round(mp, 6) AS market_place_prob,
  round(CAST(CAST(mp AS DECIMAL(28,9)) AS DOUBLE) / nullif(tot, 0), 6) AS market_place_prob_normalized,
  round(tot, 6) AS market_place_overround,
  CASE WHEN odds_place_min IS NULL THEN NULL
       ELSE rank() OVER (PARTITION BY race_id ORDER BY odds_place_min ASC NULLS LAST) END AS market_place_rank,
  round(horse_no / nullif(field_size, 0), 6) AS relative_gate_position
FROM m JOIN t USING (race_id)"""


@register("market_per_group", r6sql(MARKET_SQL))
def market_per_group(spark, sf_dir):
    """Market probability, share, overround and odds rank per race."""
    df = testbed.scored(spark, sf_dir)
    df = market_features(df, "race_id", "odds_place_min", exact=EXACT)
    df = df.withColumn("relative_gate_position", F.col("horse_no") / F.nullif(F.col("field_size"), F.lit(0)))
    return df.select(*ID_COLS, "odds_place_min", _r("market_place_prob"), _r("market_place_prob_normalized"),
                     _r("market_place_overround"), "market_place_rank", _r("relative_gate_position"))


SLOTS_SQL = testbed.SCORED_WITH + """,
g AS (SELECT race_id, CAST(sum(CAST(prob_a AS DECIMAL(28,9))) AS DOUBLE) AS tot,
        arg_min(field_size, (horse_no, horse_id, jockey_id, l_extendedprice)) AS sz FROM scored GROUP BY race_id),
k AS (SELECT race_id, CASE WHEN tot > 0 THEN (CASE WHEN sz >= 8 THEN 3 WHEN sz >= 5 THEN 2
        ELSE greatest(1, least(3, sz)) END) / tot ELSE 1.0 END AS scale FROM g)
SELECT race_id, horse_id, horse_no, jockey_id,
  round(CASE WHEN prob_a IS NOT NULL THEN least(greatest(CAST(CAST(prob_a AS DECIMAL(28,9)) AS DOUBLE) * scale, 0.01), 0.95) END, 6) AS place_prob_final
FROM scored JOIN k USING (race_id)"""


@register("scale_to_slots", r6sql(SLOTS_SQL))
def scale_to_slots_q(spark, sf_dir):
    """Race probability correction to the number of paid slots, clipped."""
    df = testbed.scored(spark, sf_dir)
    df = scale_to_slots(df, "race_id", "prob_a", "field_size", ["horse_no", "horse_id", "jockey_id", "l_extendedprice"],
                        exact=EXACT)
    return df.select(*ID_COLS, _r("place_prob_final"))


ENSEMBLE_CTE = """,
e0 AS (SELECT *, (CASE WHEN prob_a IS NOT NULL THEN 1 ELSE 0 END + CASE WHEN prob_b IS NOT NULL THEN 1 ELSE 0 END
                  + CASE WHEN prob_c IS NOT NULL THEN 1 ELSE 0 END) AS n_ok,
              coalesce(prob_a, 0.0) + coalesce(prob_b, 0.0) + coalesce(prob_c, 0.0) AS s_ok FROM scored),
e1 AS (SELECT *, CASE WHEN n_ok > 0 THEN s_ok / n_ok END AS ens FROM e0),
e2 AS (SELECT *, CASE WHEN n_ok > 0 THEN sqrt((coalesce((prob_a - ens) * (prob_a - ens), 0.0)
                  + coalesce((prob_b - ens) * (prob_b - ens), 0.0) + coalesce((prob_c - ens) * (prob_c - ens), 0.0)) / n_ok) END AS unc,
              prob_a * (0.34 / 1.0) + prob_b * (0.33 / 1.0) + prob_c * (0.33 / 1.0) AS ens_w FROM e1)"""

ENSEMBLE_SQL = testbed.SCORED_WITH + ENSEMBLE_CTE + """
SELECT race_id, horse_id, horse_no, jockey_id, round(ens, 6) AS place_prob_ensemble_raw,
  round(ens_w, 6) AS place_prob_weighted, round(unc, 6) AS model_uncertainty FROM e2"""

MODEL_COLS = ["prob_a", "prob_b", "prob_c"]
WEIGHTS = [0.34, 0.33, 0.33]


def ensemble_rows(df):
    return (df.withColumn("place_prob_ensemble_raw", row_mean(MODEL_COLS))
              .withColumn("place_prob_weighted", row_weighted(MODEL_COLS, WEIGHTS))
              .withColumn("model_uncertainty", row_std(MODEL_COLS)))


@register("row_ensemble", r6sql(ENSEMBLE_SQL))
def row_ensemble(spark, sf_dir):
    """Simple mean (skips missing), normalised weighted mean, population std."""
    df = ensemble_rows(testbed.scored(spark, sf_dir))
    return df.select(*ID_COLS, _r("place_prob_ensemble_raw"), _r("place_prob_weighted"), _r("model_uncertainty"))


VALUE_CTE = ENSEMBLE_CTE + """,
v0 AS (SELECT *, CASE WHEN odds_place_min IS NOT NULL THEN least(greatest(1.0 / greatest(odds_place_min, 1.01), 0.0), 1.0) END AS mkt,
              ens * odds_place_min AS ev FROM e2),
v1 AS (SELECT *, ens - mkt AS gap FROM v0),
v2 AS (SELECT *, gap * ev * (1 - CASE WHEN unc IS NOT NULL THEN least(greatest(unc, 0.0), 1.0) END) AS score FROM v1)"""

VALUE_SQL = testbed.SCORED_WITH + VALUE_CTE + """
SELECT race_id, horse_id, horse_no, jockey_id, round(mkt, 6) AS market_place_prob, round(ev, 6) AS expected_value_place,
  round(gap, 6) AS value_gap, round(score, 6) AS bet_score FROM v2"""


def valued(df):
    df = ensemble_rows(df)
    for name, col in value_columns("place_prob_ensemble_raw", "odds_place_min", "model_uncertainty").items():
        df = df.withColumn(name, col)
    return df


@register("value_columns", r6sql(VALUE_SQL))
def value_columns_q(spark, sf_dir):
    """P10: market probability, expected value, value gap and bet score."""
    df = valued(testbed.scored(spark, sf_dir))
    return df.select(*ID_COLS, _r("market_place_prob"), _r("expected_value_place"), _r("value_gap"), _r("bet_score"))


FEATURE_HISTORY = {  # column -> value, previous rows (None: all), keys beside the horse
    "hist_avg_finish": ("finish_position", None, ""), "hist_place_rate": ("hit", None, ""),
    "hist_recent3_place_rate": ("hit", 3, ""), "hist_recent5_place_rate": ("hit", 5, ""),
    "hist_recent3_avg_finish": ("finish_position", 3, ""), "hist_avg_last_3f": ("last_3f", None, ""),
    "hist_recent3_last_3f": ("last_3f", 3, ""), "hist_avg_speed_mps": ("speed", None, ""),
    "hist_recent3_speed_mps": ("speed", 3, ""), "hist_recent5_speed_mps": ("speed", 5, ""),
    "hist_course_distance_speed_mps": ("speed", None, ", course, surface, distance"),
    "hist_avg_early_position_ratio": ("early", None, ""), "hist_avg_final_corner_ratio": ("final", None, ""),
    "hist_recent3_early_position_ratio": ("early", 3, ""), "hist_front_runner_rate": ("front", None, ""),
    **{f"hist_{c}_place_rate": ("hit", None, f", {c}") for c in ("surface", "course", "ground_condition", "distance_bucket")}}
GROUND_SQL = "CASE WHEN jockey_id % 5 = 0 THEN NULL WHEN jockey_id % 5 < 3 THEN 'firm' ELSE 'soft' END"
LAST3F_SQL = "CASE WHEN horse_no % 6 = 0 THEN NULL ELSE 30 + l_quantity / 4 END"

FEATURE_SQL = testbed.SCORED_WITH + f""",
f0 AS (
  SELECT *, {HIT_SQL} AS hit, {BUCKET_SQL} AS distance_bucket, {GROUND_SQL} AS ground_condition, {LAST3F_SQL} AS last_3f,
    CASE WHEN finish_position IS NOT NULL AND field_size >= 5
         THEN CAST(finish_position >= 1 AND finish_position <= if(field_size >= 8, 3, 2) AS INTEGER) END AS target_place,
    trim(finish_time) AS ft, TRY_CAST(nullif(regexp_extract(corner_order, '^(\\d+)', 1), '') AS INTEGER) AS c1,
    TRY_CAST(nullif(regexp_extract(corner_order, '(\\d+)$', 1), '') AS INTEGER) AS c2,
    CASE WHEN odds_place_min IS NOT NULL THEN 1.0 / greatest(odds_place_min, 1.01) END AS mp FROM scored),
f1 AS (
  SELECT *, distance / nullif({SECONDS_SQL}, 0) AS speed, c1 / nullif(field_size, 0) AS early, c2 / nullif(field_size, 0) AS final
  FROM f0 WHERE target_place IS NOT NULL),
f2 AS (SELECT *, CASE WHEN early IS NOT NULL THEN CAST(early <= 0.25 AS DOUBLE) END AS front,
         CAST(coalesce(sum(CAST(mp AS DECIMAL(28,9))) OVER (PARTITION BY race_id), 0) AS DOUBLE) AS tot FROM f1)
SELECT race_id, horse_id, horse_no, jockey_id, target_place, distance_bucket, ground_condition,
  round(horse_no / nullif(field_size, 0), 6) AS relative_gate_position,
  CAST(row_number() OVER (PARTITION BY horse_id ORDER BY {HORSE_ORDER_SQL}) - 1 AS BIGINT) AS hist_runs,
  CAST(race_date - lag(race_date) OVER (PARTITION BY horse_id ORDER BY {HORSE_ORDER_SQL}) AS INTEGER) AS hist_days_since_last_race,
""" + ",\n".join(
    f"  CAST(row_number() OVER (PARTITION BY horse_id, {c} ORDER BY {HORSE_ORDER_SQL}) - 1 AS BIGINT) AS hist_{c}_runs"
    for c in ("surface", "course", "ground_condition", "distance_bucket")) + ",\n" + ",\n".join(
    "  " + (_prior_sql(v, "horse_id" + k, f"ROWS BETWEEN {n} PRECEDING AND 1 PRECEDING") if n else _prior_sql(v, "horse_id" + k)) + f" AS {name}"
    for name, (v, n, k) in FEATURE_HISTORY.items()) + """,
  round(mp, 6) AS market_place_prob, round(CAST(CAST(mp AS DECIMAL(28,9)) AS DOUBLE) / nullif(tot, 0), 6) AS market_place_prob_normalized,
  round(tot, 6) AS market_place_overround,
  CASE WHEN odds_place_min IS NOT NULL THEN rank() OVER (PARTITION BY race_id ORDER BY odds_place_min ASC NULLS LAST) END AS market_place_rank
FROM f2"""


def feature_entries(spark, sf_dir):
    """Entries of the test tables with every input of the feature table."""
    from tessera.functions.targets import place_target
    df = testbed.scored(spark, sf_dir)
    return (df.withColumn("target_place", place_target("finish_position", "field_size"))
            .withColumn("ground_condition", F.expr(GROUND_SQL)).withColumn("last_3f", F.expr(LAST3F_SQL)))


@register("feature_table", r6sql(FEATURE_SQL))
def feature_table(spark, sf_dir):
    """The stored feature table, every column."""
    from tessera.plans.features import prepare_features, write_features
    from tessera.session import scratch_path
    from tessera.sources.raw import new_run_id
    rows = feature_entries(spark, sf_dir).withColumn("finish_position", F.col("finish_position").cast(EXACT))
    out = write_features(prepare_features(rows, HORSE_ORDER, exact=EXACT), scratch_path(spark, f"features-{new_run_id()}"))
    rounded = ["relative_gate_position", *FEATURE_HISTORY, "market_place_prob", "market_place_prob_normalized", "market_place_overround"]
    return out.select(*ID_COLS, "target_place", "distance_bucket", "ground_condition", "hist_runs", "hist_days_since_last_race",
                      *[f"hist_{c}_runs" for c in ("surface", "course", "ground_condition", "distance_bucket")],
                      *[_r(c) for c in rounded], "market_place_rank")
