"""Record decoding and archive queries (D1-D8, S9-S11, A15, T3, F1-F5, F10,
F13, F16, P17-P19) over fixed-width payloads that Spark derives from
``events`` (one record per event, so the work grows with the table).

No raw record file ships with the driver data; the payloads are laid out
with ``lpad``/``rpad``/``repeat`` segment expressions that read the same in
Spark SQL and DuckDB, so the oracle cuts the very same strings.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from tessera.functions.parse import java_charsets
from tessera.plans import decode as dec
from tessera.plans.catalog import r6, r6sql, register
from tessera.session import cut_lineage, table_path
from tessera.sources.records import archive, dump_records, type_counts

D2 = "lpad(CAST({} AS STRING), 2, '0')"
KEY = [(0, 2, "{rt}"), (11, 4, "CASE WHEN value > 190 THEN '20X4' ELSE CAST(year(ts) AS STRING) END"),
       (15, 4, D2.format("month(ts)") + " || " + D2.format("day(ts)")), (19, 2, D2.format("user_id % 12 + 1")),
       (21, 2, "'01'"), (23, 2, D2.format("day(ts) % 8 + 1")), (25, 2, D2.format("event_id % 12 + 1"))]
SEGMENTS = {
    "RA": KEY + [
        (32, 60, "'RACE ' || CAST(event_id AS STRING)"), (614, 1, "substr('ABCDE', CAST(event_id % 5 AS INTEGER) + 1, 1)"),
        (618, 3, "'A' || " + D2.format("user_id % 100")), (622, 3, "'0' || " + D2.format("event_id % 30")),
        (634, 3, "lpad(CAST(event_id % 999 AS STRING), 3, '0')"),
        (697, 4, "lpad(CAST(1000 + (event_id % 25) * 100 AS STRING), 4, '0')"),
        (705, 2, "CASE event_id % 7 WHEN 0 THEN '11' WHEN 1 THEN '17' WHEN 2 THEN '24' WHEN 3 THEN '23' "
                 "WHEN 4 THEN '52' WHEN 5 THEN '00' ELSE '  ' END"),
        (873, 4, D2.format("9 + event_id % 8") + " || '30'"), (881, 2, D2.format("event_id % 18 + 1")),
        (883, 2, "CASE WHEN event_id % 4 = 0 THEN '  ' ELSE " + D2.format("event_id % 16 + 1") + " END"),
        (887, 1, "CAST(event_id % 8 AS STRING)"), (888, 1, "CAST(user_id % 5 AS STRING)"),
        (889, 1, "CAST(event_id % 6 AS STRING)")],
    "SE": KEY + [
        (27, 1, "CAST(event_id % 8 + 1 AS STRING)"), (28, 2, D2.format("event_id % 16 + 1")),
        (30, 10, "lpad(CAST(user_id AS STRING), 10, '0')"), (40, 36, "'HORSE' || CAST(user_id AS STRING)"),
        (78, 1, "CAST(event_id % 4 AS STRING)"), (82, 2, D2.format("event_id % 8 + 2")),
        (85, 5, "lpad(CAST(event_id % 300 AS STRING), 5, '0')"), (90, 8, "'T' || CAST(event_id % 300 AS STRING)"),
        (288, 3, "CAST(500 + event_id % 80 AS STRING)"), (296, 5, "lpad(CAST(user_id % 90 AS STRING), 5, '0')"),
        (306, 8, "'J' || CAST(user_id % 90 AS STRING)"), (324, 3, "CAST(400 + event_id % 100 AS STRING)"),
        (327, 1, "CASE WHEN event_id % 3 = 0 THEN '-' ELSE '+' END"), (328, 3, "lpad(CAST(event_id % 20 AS STRING), 3, '0')"),
        (334, 2, D2.format("event_id % 18")), (338, 4, "CAST(1000 + event_id % 900 AS STRING)"),
        (342, 3, "CASE WHEN event_id % 5 = 0 THEN 'H' ELSE CAST(event_id % 7 AS STRING) END"),
        (351, 2, D2.format("event_id % 14")), (353, 2, "CASE WHEN event_id % 6 = 0 THEN '  ' ELSE " + D2.format("event_id % 9") + " END"),
        (355, 2, D2.format("(event_id + 3) % 12")), (357, 2, D2.format("(event_id + 1) % 15")),
        (359, 4, "CASE event_id % 10 WHEN 0 THEN '0000' WHEN 1 THEN '9999' ELSE lpad(CAST(10 + event_id % 500 AS STRING), 4, '0') END"),
        (363, 2, D2.format("event_id % 18 + 1")),
        (390, 3, "CASE event_id % 9 WHEN 0 THEN '999' WHEN 1 THEN '000' ELSE CAST(330 + event_id % 60 AS STRING) END")],
    "HR": KEY + [seg for i in range(3) for seg in (
        (102 + 13 * i, 2, D2.format(f"(event_id + {i}) % 17")),
        (104 + 13 * i, 9, f"lpad(CAST((event_id * {i + 1}) % 2000 AS STRING), 9, '0')"))] + [seg for i in range(5) for seg in (
        (141 + 13 * i, 2, f"CASE WHEN event_id % 6 < {i} THEN '  ' ELSE " + D2.format(f"(event_id + 2 * {i}) % 19") + " END"),
        (143 + 13 * i, 9, f"lpad(CAST((event_id + 7 * {i}) % 900 AS STRING), 9, '0')"))],
    "O1": KEY + [seg for i in range(18) for seg in (
        (43 + 8 * i, 2, f"CASE WHEN {i} < event_id % 18 THEN " + D2.format(f"({i} % 15) + 1") + " ELSE '00' END"),
        (45 + 8 * i, 4, f"lpad(CAST((event_id + {i} * 7) % 1200 AS STRING), 4, '0')"),
        (49 + 8 * i, 2, D2.format(f"{i} % 18 + 1")))] + [(43 + 8 * 18, 8 * 10, "'" + "00000000" * 10 + "'")] + [
        seg for i in range(15) for seg in (
        (267 + 12 * i, 2, f"CASE WHEN {i} < event_id % 15 THEN " + D2.format(f"{i} + 3") + " ELSE '  ' END"),
        (269 + 12 * i, 8, f"lpad(CAST((event_id + {i} * 3) % 400 AS STRING), 4, '0') || "
                          f"lpad(CAST((event_id + {i} * 5) % 9999 AS STRING), 4, '0')"))],
    "CK": KEY + [(27, 10, "lpad(CAST(user_id AS STRING), 10, '0')"), (73, 9, "CAST(event_id * 37 AS STRING)")] + [
        (145 + 3 * i, 3, f"CASE WHEN event_id % 7 = {i} THEN '   ' ELSE lpad(CAST((event_id + {i}) % 11 AS STRING), 3, '0') END")
        for i in range(6)],
    "HC": [(0, 2, "{rt}"), (2, 1, "CAST(event_id % 4 AS STRING)"),
           (3, 8, "CAST(year(ts) AS STRING) || " + D2.format("month(ts)") + " || " + D2.format("day(ts)")),
           (11, 1, "CAST(user_id % 2 AS STRING)"),
           (12, 8, "CAST(year(ts) AS STRING) || " + D2.format("month(ts)") + " || " + D2.format("(day(ts) % 27) + 1")),
           (24, 10, "lpad(CAST(user_id AS STRING), 10, '0')"),
           (34, 4, "CASE WHEN event_id % 5 = 0 THEN '0000' ELSE lpad(CAST(500 + event_id % 300 AS STRING), 4, '0') END"),
           (38, 3, "lpad(CAST(event_id % 200 AS STRING), 3, '0')"), (41, 4, "lpad(CAST(380 + event_id % 90 AS STRING), 4, '0')"),
           (45, 3, "lpad(CAST(120 + event_id % 50 AS STRING), 3, '0')"), (48, 4, "lpad(CAST(250 + event_id % 60 AS STRING), 4, '0')"),
           (52, 3, "lpad(CAST(110 + event_id % 40 AS STRING), 3, '0')"), (55, 3, "CASE WHEN event_id % 3 = 0 THEN '000' ELSE lpad(CAST(115 + event_id % 30 AS STRING), 3, '0') END")],
}
SEGMENTS["WC"] = [s for s in SEGMENTS["HC"] if s[0] < 34] + [
    (34, 1, "CAST(event_id % 3 AS STRING)"), (35, 1, "CAST(event_id % 2 AS STRING)"),
    (79, 4, "lpad(CAST(520 + event_id % 280 AS STRING), 4, '0')"), (83, 3, "lpad(CAST(event_id % 170 AS STRING), 3, '0')"),
    (86, 4, "CASE WHEN event_id % 4 = 0 THEN '0000' ELSE lpad(CAST(390 + event_id % 80 AS STRING), 4, '0') END"),
    (90, 3, "lpad(CAST(125 + event_id % 45 AS STRING), 3, '0')"), (93, 4, "lpad(CAST(260 + event_id % 50 AS STRING), 4, '0')"),
    (97, 3, "lpad(CAST(112 + event_id % 35 AS STRING), 3, '0')"), (100, 3, "lpad(CAST(118 + event_id % 25 AS STRING), 3, '0')")]
# which events become which record, under which data spec
TYPE_OF = ("CASE WHEN event_type = 'view' THEN 'RA' WHEN event_type = 'click' THEN 'SE' WHEN event_type = 'purchase' "
           "THEN 'HR' WHEN event_type = 'signup' THEN 'O1' WHEN event_id % 3 = 0 THEN 'CK' WHEN event_id % 3 = 1 "
           "THEN 'HC' ELSE 'WC' END")
SPEC_OF = ("CASE rt WHEN 'CK' THEN 'SNPN' WHEN 'HC' THEN 'SLOP' WHEN 'WC' THEN 'WOOD' ELSE 'RACE' END")


def payload_sql(rt: str) -> str:
    parts, pos = [], 0
    for start, width, expr in sorted(SEGMENTS[rt], key=lambda s: s[0]):
        if start > pos:
            parts.append(f"repeat(' ', {start - pos})")
        parts.append(f"rpad({expr.format(rt=repr(rt))}, {width}, ' ')")
        pos = start + width
    return " || ".join(parts)


PAYLOAD_CASE = "CASE rt " + " ".join(f"WHEN '{rt}' THEN {payload_sql(rt)}" for rt in SEGMENTS) + " END"


def records(spark, sf_dir):
    """Archive-shaped records (data_spec, record_type, raw_payload, received_at) of
    all types: one narrow projection per record type,
    unioned (keeps generated code small)."""
    ev = spark.read.parquet(table_path(sf_dir, "events")).withColumn("rt", F.expr(TYPE_OF))
    out = None
    for rt in SEGMENTS:
        part = ev.where(F.col("rt") == rt).select(
            "event_id", F.expr(SPEC_OF).alias("data_spec"), F.col("rt").alias("record_type"),
            F.expr(payload_sql(rt)).alias("raw_payload"), F.col("ts").alias("received_at"))
        out = part if out is None else out.unionByName(part)
    # an archive is a stored table: materialise the derived payloads once, so
    # the slot cuts read a column instead of re-deriving the text per cut
    return cut_lineage(out)


RECORDS_SQL = f"""WITH ev AS (SELECT *, {TYPE_OF} AS rt FROM events),
rec AS MATERIALIZED (SELECT event_id, {SPEC_OF} AS data_spec, rt AS record_type, {PAYLOAD_CASE} AS raw_payload, ts AS received_at FROM ev)"""


def cut_sql(start, width, p="raw_payload"):
    return f"trim(substr({p}, {start + 1}, {width}), chr(0) || ' ' || chr(12288))"


def int_sql(start, width, p="raw_payload"):
    return f"TRY_CAST({cut_sql(start, width, p)} AS INTEGER)"


KEY_SQL = " || ".join(cut_sql(f.start, f.width) for f in dec.RACE_KEY)
DATE_SQL = f"CAST(try_strptime({cut_sql(11, 4)} || {cut_sql(15, 4)}, '%Y%m%d') AS DATE)"


def _map(expr, table):
    return "CASE " + " ".join(f"WHEN {expr} = '{k}' THEN '{v}'" for k, v in table.items()) + " END"


RACES_SQL = RECORDS_SQL + f""",
ra AS (SELECT event_id, {KEY_SQL} AS race_id, {DATE_SQL} AS race_date, {cut_sql(19, 2)} AS cc, {int_sql(25, 2)} AS race_no,
         {cut_sql(32, 60)} AS race_name, {cut_sql(705, 2)} AS track, {int_sql(697, 4)} AS distance, {cut_sql(887, 1)} AS wc,
         {cut_sql(888, 1)} AS tg, {cut_sql(889, 1)} AS dg, {cut_sql(634, 3)} AS race_class, {cut_sql(614, 1)} AS race_grade,
         {cut_sql(622, 3)} AS age_condition, {cut_sql(618, 3)} AS sex_condition,
         coalesce({int_sql(883, 2)}, {int_sql(881, 2)}) AS field_size, {cut_sql(873, 4)} AS start_time
       FROM rec WHERE substr(raw_payload, 1, 2) = 'RA'),
ra2 AS (SELECT *, CASE WHEN track = '' OR track = '00' THEN NULL WHEN substr(track, 1, 1) IN ('1', '2') THEN '芝'
          WHEN substr(track, 1, 1) = '3' THEN 'ダート' WHEN substr(track, 1, 1) IN ('5', '6') THEN '障害' END AS surface FROM ra)
SELECT event_id, race_id, strftime(race_date, '%Y-%m-%d') AS race_date, coalesce({_map('cc', dec.codes.COURSES)}, cc) AS course,
  coalesce(race_no, 0) AS race_no, race_name, surface, distance,
  CASE WHEN regexp_full_match(track, '1[1-9]') THEN '右' WHEN regexp_full_match(track, '2[1-9]') THEN '左' END AS direction,
  {_map('wc', dec.codes.WEATHER)} AS weather,
  {_map("CASE WHEN surface = 'ダート' THEN dg ELSE tg END", dec.codes.GROUND)} AS ground_condition,
  race_class, race_grade, age_condition, sex_condition, field_size, start_time
FROM ra2 WHERE race_date IS NOT NULL"""


@register("decode_races", RACES_SQL)
def decode_races_q(spark, sf_dir):
    """RA records decoded by layout; code tables as maps."""
    good, _ = dec.decode_races(records(spark, sf_dir), keep=("event_id",))
    return good.withColumn("race_date", F.date_format("race_date", "yyyy-MM-dd"))


ENTRIES_SQL = RECORDS_SQL + f""",
se AS (SELECT event_id, {KEY_SQL} AS race_id, {DATE_SQL} AS race_date, {cut_sql(30, 10)} AS horse_id, {cut_sql(40, 36)} AS horse_name,
         {int_sql(28, 2)} AS horse_no, {int_sql(27, 1)} AS frame_no, {cut_sql(296, 5)} AS jockey_id, {cut_sql(306, 8)} AS jockey_name,
         {cut_sql(85, 5)} AS trainer_id, {cut_sql(90, 8)} AS trainer_name, {int_sql(82, 2)} AS horse_age, {cut_sql(78, 1)} AS sc,
         {int_sql(288, 3)} AS wr, {int_sql(324, 3)} AS body_weight, {cut_sql(327, 1)} AS sign, {int_sql(328, 3)} AS dr,
         {int_sql(359, 4)} AS odds_raw, {int_sql(363, 2)} AS popularity, {int_sql(334, 2)} AS fr, {cut_sql(338, 4)} AS finish_time,
         {cut_sql(342, 3)} AS margin, {cut_sql(351, 2)} AS c1, {cut_sql(353, 2)} AS c2, {cut_sql(355, 2)} AS c3, {cut_sql(357, 2)} AS c4,
         {int_sql(390, 3)} AS l3
       FROM rec WHERE substr(raw_payload, 1, 2) = 'SE')
SELECT event_id, race_id, horse_id, horse_name, horse_no, frame_no, jockey_id, jockey_name, trainer_id, trainer_name, horse_age,
  {_map('sc', dec.codes.SEX)} AS horse_sex, round(coalesce(wr, 0) / 10.0, 6) AS weight_carried, body_weight,
  CASE WHEN sign = '-' THEN -dr ELSE dr END AS body_weight_diff,
  round(CASE WHEN odds_raw IS NULL OR odds_raw IN (0, 9999) THEN NULL ELSE odds_raw / 10.0 END, 6) AS odds_win, popularity,
  CASE WHEN fr <> 0 THEN fr END AS finish_position, finish_time, margin,
  array_to_string(list_filter([c1, c2, c3, c4], lambda x: x IS NOT NULL AND x NOT IN ('', '00')), '-') AS corner_order,
  round(CASE WHEN l3 IS NULL OR l3 IN (0, 999) THEN NULL ELSE l3 / 10.0 END, 6) AS last_3f
FROM se WHERE race_date IS NOT NULL"""


@register("decode_entries", r6sql(ENTRIES_SQL))
def decode_entries_q(spark, sf_dir):
    """SE records to entry and result columns (odds sentinels,
    signed weight change, corner list)."""
    good, _ = dec.decode_entries(records(spark, sf_dir), keep=("event_id",))
    return good.select(*[r6(c) if c in ("weight_carried", "odds_win", "last_3f") else F.col(c) for c in good.columns])


# Names in two-byte characters: the digits of a number written with these.
KANA, KANJI = "アイウエオカキクケコ", "零一二三四五六七八九"
SE_NAMES = {"horse_name": ("event_id", KANA, 40, 36), "trainer_name": ("event_id % 7919", KANJI, 90, 8),
            "jockey_name": ("event_id % 9973", KANA, 306, 8)}
RA_NAMES = {"race_name": ("event_id", KANJI, 32, 60)}


def _with_names(rec, names):
    """Records with a binary payload whose names are Shift_JIS, padded by bytes."""
    raw = lambda c: F.encode(c, "ISO-8859-1")
    with java_charsets(rec.sparkSession):
        parts, at = [], 0
        for number, digits, start, width in sorted(names.values(), key=lambda n: n[2]):
            name = F.translate(F.expr(f"CAST({number} AS STRING)"), "0123456789", digits)
            parts += [raw(F.substring("raw_payload", at + 1, start - at)),
                      F.rpad(F.encode(name, "Shift_JIS"), width, raw(F.lit(" ")))]
            at = start + width
        return rec.withColumn("raw_payload", F.concat(*parts, raw(F.expr(f"substring(raw_payload, {at + 1})"))))


def _names_sql(sql, names):
    for column, (number, digits, start, width) in names.items():
        sql = sql.replace(f"{cut_sql(start, width)} AS {column}",
                          f"translate(CAST({number} AS VARCHAR), '0123456789', '{digits}') AS {column}")
    return sql


@register("decode_race_names", _names_sql(RACES_SQL, RA_NAMES))
def decode_race_names(spark, sf_dir):
    """RA records as bytes, race names decoded from Shift_JIS."""
    rec = _with_names(records(spark, sf_dir), RA_NAMES)
    good, _ = dec.decode_races(rec, keep=("event_id",))
    return good.withColumn("race_date", F.date_format("race_date", "yyyy-MM-dd"))


@register("decode_entry_names", r6sql(_names_sql(ENTRIES_SQL, SE_NAMES)))
def decode_entry_names(spark, sf_dir):
    """SE records as bytes, names decoded from Shift_JIS, the fields behind them in place."""
    rec = _with_names(records(spark, sf_dir), SE_NAMES)
    good, _ = dec.decode_entries(rec, keep=("event_id",))
    return good.select(*[r6(c) if c in ("weight_carried", "odds_win", "last_3f") else F.col(c) for c in good.columns])


REJECTS_SQL = RECORDS_SQL + f"""
SELECT event_id, substr(raw_payload, 1, 2) AS record_type, 'race_date' AS reject_reason FROM rec
WHERE substr(raw_payload, 1, 2) IN ('RA', 'SE') AND {DATE_SQL} IS NULL"""


@register("decode_rejects", REJECTS_SQL)
def decode_rejects_q(spark, sf_dir):
    """D1/D2 reject routing: records whose race date does not parse."""
    rec = records(spark, sf_dir)
    _, bad_ra = dec.decode_races(rec, keep=("event_id",))
    _, bad_se = dec.decode_entries(rec, keep=("event_id",))
    return (bad_ra.withColumn("record_type", F.lit("RA")).unionByName(bad_se.withColumn("record_type", F.lit("SE")))
            .select("event_id", "record_type", "reject_reason"))


def _slots_sql(blocks):
    parts = []
    for ticket, start, n, stride, cw, pw in blocks:
        off = f"({start + 1} + {stride} * i)"
        cut = "trim(substr(raw_payload, {o}, {w}), chr(0) || ' ' || chr(12288))"
        parts.append(f"SELECT event_id, {KEY_SQL} AS race_id, '{ticket}' AS ticket_type, {cut.format(o=off, w=cw)} AS combination, "
                     f"TRY_CAST({cut.format(o=f'{off} + {cw}', w=pw)} AS INTEGER) AS payout "
                     f"FROM (SELECT *, unnest(range({n})) AS i FROM rec WHERE substr(raw_payload, 1, 2) = 'HR')")
    return "\n  UNION ALL ".join(parts)


PAYOUTS_SQL = RECORDS_SQL + f""",
s AS ({_slots_sql(dec.HR_BLOCKS)})
SELECT event_id, race_id, ticket_type, combination, payout FROM s
WHERE combination <> '' AND NOT regexp_full_match(combination, '0+') AND payout IS NOT NULL AND payout <> 0"""


@register("decode_payouts", PAYOUTS_SQL)
def decode_payouts_q(spark, sf_dir):
    """D3: repeated payout slots exploded, empty and zero slots skipped."""
    return dec.decode_payouts(records(spark, sf_dir), keep=("event_id",))


def _o1_sql():
    ws, wn, wst = dec.O1_WIN
    ps, pn, pst = dec.O1_PLACE
    cut = "trim(substr(raw_payload, {o}, {w}), chr(0) || ' ' || chr(12288))"
    num = "TRY_CAST(" + cut + " AS INTEGER)"
    odds = "CASE WHEN {x} IS NULL OR {x} IN (0, 9999) THEN NULL ELSE {x} / 10.0 END"
    wo, po = f"({ws + 1} + {wst} * i)", f"({ps + 1} + {pst} * i)"
    return RECORDS_SQL + f""",
o1 AS MATERIALIZED (SELECT event_id, {KEY_SQL} AS race_id, raw_payload FROM rec WHERE substr(raw_payload, 1, 2) = 'O1'),
w0 AS (SELECT event_id, race_id, i AS slot, {num.format(o=wo, w=2)} AS horse_no,
          {odds.format(x=num.format(o=wo + ' + 2', w=4))} AS odds_win, {num.format(o=wo + ' + 6', w=2)} AS popularity
       FROM (SELECT *, unnest(range({wn})) AS i FROM o1)),
p0 AS (SELECT event_id, race_id, i AS slot, {num.format(o=po, w=2)} AS horse_no,
          {odds.format(x=num.format(o=po + ' + 2', w=4))} AS mn, {odds.format(x=num.format(o=po + ' + 6', w=4))} AS mx
       FROM (SELECT *, unnest(range({pn})) AS i FROM o1)),
w AS (SELECT event_id, race_id, horse_no, arg_max_null(odds_win, slot) AS odds_win, arg_max_null(popularity, slot) AS popularity
      FROM w0 WHERE horse_no IS NOT NULL AND horse_no <> 0 GROUP BY ALL),
p AS (SELECT event_id, race_id, horse_no, arg_max_null(mn, slot) AS odds_place_min, arg_max_null(mx, slot) AS odds_place_max
      FROM p0 WHERE horse_no IS NOT NULL AND horse_no <> 0 GROUP BY ALL)
SELECT coalesce(w.event_id, p.event_id) AS event_id, coalesce(w.race_id, p.race_id) AS race_id,
  coalesce(w.horse_no, p.horse_no) AS horse_no, round(w.odds_win, 6) AS odds_win, round(p.odds_place_min, 6) AS odds_place_min,
  round(p.odds_place_max, 6) AS odds_place_max, w.popularity
FROM w FULL OUTER JOIN p ON w.event_id = p.event_id AND w.race_id = p.race_id AND w.horse_no = p.horse_no"""


@register("decode_odds", r6sql(_o1_sql()))
def decode_odds_q(spark, sf_dir):
    """Win and place odds blocks exploded and merged by horse number."""
    out = dec.decode_odds(records(spark, sf_dir), keep=("event_id",))
    return out.select("event_id", "race_id", "horse_no", r6("odds_win"), r6("odds_place_min"), r6("odds_place_max"),
                      "popularity")


def _place(i):
    return f"TRY_CAST(NULLIF({cut_sql(145 + 3 * i, 3)}, '') AS INTEGER)"


SNAP_SQL = RECORDS_SQL + f""",
ck AS (SELECT {KEY_SQL} AS race_id, {cut_sql(27, 10)} AS horse_id,
         CAST(try_strptime({cut_sql(11, 8)}, '%Y%m%d') AS DATE) AS snapshot_date,
         TRY_CAST(NULLIF({cut_sql(73, 9)}, '') AS BIGINT) * 100 AS flat_prize_yen,
         {' + '.join(f'coalesce({_place(i)}, 0)' for i in range(6))} AS central_runs,
         {', '.join(f'{_place(i)} AS {n}' for i, n in enumerate(['central_wins', 'central_seconds', 'central_thirds', 'central_fourths', 'central_fifths', 'central_other']))},
         sha256(data_spec || chr(10) || raw_payload) AS source_hash, received_at
       FROM rec WHERE data_spec = 'SNPN' AND record_type = 'CK'),
r AS (SELECT *, row_number() OVER (PARTITION BY race_id, horse_id ORDER BY received_at DESC, source_hash DESC) AS rn FROM ck)
SELECT race_id, horse_id, strftime(snapshot_date, '%Y-%m-%d') AS snapshot_date, flat_prize_yen, central_runs, central_wins,
  central_seconds, central_thirds, central_fourths, central_fifths, central_other, source_hash FROM r WHERE rn = 1"""


@register("decode_snapshots", SNAP_SQL)
def decode_snapshots_q(spark, sf_dir):
    """Latest CK snapshot per (race, horse); runs = sum of placings."""
    rec = records(spark, sf_dir).withColumn("record_hash", F.sha2(F.concat("data_spec", F.lit("\n"), "raw_payload"), 256))
    out = dec.decode_snapshots(rec)
    return out.withColumn("snapshot_date", F.date_format("snapshot_date", "yyyy-MM-dd")).select(
        "race_id", "horse_id", "snapshot_date", "flat_prize_yen", F.col("central_runs").cast("int").alias("central_runs"),
        "central_wins", "central_seconds", "central_thirds", "central_fourths", "central_fifths", "central_other",
        "source_hash")


def _tenths_sql(name):
    hc, wc, width, sentinel = dec.TRAINING_TIMES[name]
    raw = f"CASE WHEN record_type = 'HC' THEN substr(raw_payload, {hc + 1}, {width}) ELSE substr(raw_payload, {wc + 1}, {width}) END"
    return f"round(CAST(CAST(TRY_CAST(NULLIF({raw}, '{sentinel}') AS DECIMAL(9,1)) / 10 AS DECIMAL({width + 2},1)) AS DOUBLE), 6)"


SESSIONS_SQL = RECORDS_SQL + f""",
t AS (SELECT * FROM rec WHERE record_type IN ('HC', 'WC') AND substr(raw_payload, 3, 1) <> '0'),
h AS (SELECT DISTINCT sha256(data_spec || chr(10) || raw_payload) AS source_hash, record_type,
        strftime(CAST(try_strptime({cut_sql(3, 8)}, '%Y%m%d') AS DATE), '%Y-%m-%d') AS created_date,
        strftime(CAST(try_strptime({cut_sql(12, 8)}, '%Y%m%d') AS DATE), '%Y-%m-%d') AS training_date,
        CASE substr(raw_payload, 12, 1) WHEN '0' THEN 'miho' WHEN '1' THEN 'ritto' END AS training_center,
        substr(raw_payload, 25, 10) AS horse_id,
        CASE WHEN record_type = 'WC' THEN substr(raw_payload, 35, 1) END AS course_code,
        CASE WHEN record_type = 'WC' THEN substr(raw_payload, 36, 1) END AS direction_code,
        {', '.join(f'{_tenths_sql(n)} AS {n}' for n in dec.TRAINING_TIMES)}
      FROM t)
SELECT * FROM h"""


@register("decode_sessions", r6sql(SESSIONS_SQL))
def decode_sessions_q(spark, sf_dir):
    """HC/WC training sessions, layout by type, all-zero sentinels
    as null, one row per record hash."""
    rec = records(spark, sf_dir).withColumn("record_hash", F.sha2(F.concat("data_spec", F.lit("\n"), "raw_payload"), 256))
    out = dec.decode_sessions(rec)
    return out.select("source_hash", "record_type", F.date_format("created_date", "yyyy-MM-dd").alias("created_date"),
                      F.date_format("training_date", "yyyy-MM-dd").alias("training_date"), "training_center", "horse_id",
                      "course_code", "direction_code",
                      *[r6(n) for n in dec.TRAINING_TIMES])


ARCHIVE_SQL = RECORDS_SQL + """,
h AS (SELECT *, sha256(data_spec || chr(10) || raw_payload) AS record_hash FROM rec),
first AS (SELECT *, row_number() OVER (PARTITION BY record_hash ORDER BY received_at, raw_payload) AS rn FROM h),
old AS (SELECT DISTINCT record_hash FROM h WHERE received_at < TIMESTAMP '2024-01-10')
SELECT record_hash, data_spec, record_type, event_id, strftime(received_at, '%Y-%m-%d %H:%M:%S.%f') AS received_at
FROM first WHERE rn = 1 AND record_hash NOT IN (SELECT record_hash FROM old)"""


@register("archive_hash", ARCHIVE_SQL)
def archive_hash(spark, sf_dir):
    """SHA-256 content hash, first copy wins, already archived
    hashes (records received before 10 January) are skipped."""
    rec = records(spark, sf_dir)
    existing = archive(rec.where(F.col("received_at") < F.lit("2024-01-10").cast("timestamp_ntz")))
    new = archive(rec, existing)
    return new.select("record_hash", "data_spec", "record_type", "event_id",
                      F.date_format("received_at", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("received_at"))


TYPES_SQL = RECORDS_SQL + """
SELECT record_type, count(*) AS n FROM rec GROUP BY record_type"""


@register("type_counts", TYPES_SQL)
def type_counts_q(spark, sf_dir):
    """Records per record type."""
    return type_counts(records(spark, sf_dir))


DUMP_SQL = """SELECT doc_id, source AS data_spec, upper(substr(text, 1, 2)) AS record_type,
  replace(replace(text, chr(13), '\\r'), chr(10), '\\n') AS raw_payload FROM documents
WHERE upper(substr(text, 1, 2)) IN ('LE', 'LA', 'DE', 'EL', 'UN') ORDER BY doc_id LIMIT 50"""


@register("dump_records", DUMP_SQL)
def dump_records_q(spark, sf_dir):
    """Whole documents as records, CR/LF escaped, the first 50 matching in
    document order (the bound is the dump's written limit)."""
    docs = spark.read.parquet(table_path(sf_dir, "documents")).select(
        "doc_id", F.col("source").alias("data_spec"), F.upper(F.substring("text", 1, 2)).alias("record_type"),
        F.col("text").alias("raw_payload"))
    return dump_records(docs, ["LE", "LA", "DE", "EL", "UN"], 50, ["doc_id"])
