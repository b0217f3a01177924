"""Fixed-width record decoding as Spark projections (D1-D8, F1-F5, F10, F16,
P17-P19).

A layout is data: (name, 0-based start, width, kind).  ``decode`` turns a
layout into one ``select`` of ``substring``/``trim``/``try_cast`` expressions
over the payload column, so a record type is decoded by a single narrow
projection over the whole archive, with no per-record Python.  Rows whose
required fields do not parse go to a reject frame with a reason.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions import codes
from tessera.functions.parse import java_charsets, join_parts, odds_value, shift_jis, strip_chars, tenths_or_null, yyyymmdd


@dataclass(frozen=True)
class Field:
    name: str
    start: int  # 0-based character offset
    width: int
    kind: str = "text"  # text | int | date8


def cut(payload: str | Column, start: int | Column, width: int) -> Column:
    """F1 + F16: the trimmed slice ``[start, start+width)`` ('' beyond the end)."""
    p = F.col(payload) if isinstance(payload, str) else payload
    return strip_chars(F.substring(p, start + 1, width))


def as_int(text: Column) -> Column:
    return text.try_cast("int")


def is_binary(df: DataFrame, payload: str) -> bool:
    return isinstance(df.schema[payload].dataType, T.BinaryType)


def one_char_per_byte(df: DataFrame, payload: str) -> DataFrame:
    """A binary payload as text of one character per byte, so that offsets stay; a
    text payload as it is. For record types whose fields are digits and letters."""
    return df.withColumn(payload, F.decode(payload, "ISO-8859-1")) if is_binary(df, payload) else df


def decode(df: DataFrame, payload: str, layout, keep=()) -> DataFrame:
    """The fields of a layout. Offsets are bytes: a binary payload is cut as bytes and
    each text field decoded from Shift_JIS by itself (F17), so a name of two-byte
    characters moves nothing behind it. A text payload holds a character per byte."""
    if is_binary(df, payload):
        def text(f):
            field = F.substring(payload, f.start + 1, f.width)
            return strip_chars(shift_jis(field) if f.kind == "text" else F.decode(field, "ISO-8859-1"))
    else:
        def text(f):
            return cut(payload, f.start, f.width)
    cols = [F.col(c) for c in keep]
    for f in layout:
        t = text(f)
        cols.append((as_int(t) if f.kind == "int" else yyyymmdd(t) if f.kind == "date8" else t).alias(f.name))
    with java_charsets(df.sparkSession):
        return df.select(*cols)


# Record layouts (0-based offsets and widths) of the format.
RACE_KEY = [Field("k_year", 11, 4), Field("k_mmdd", 15, 4), Field("k_course", 19, 2), Field("k_kai", 21, 2),
            Field("k_day", 23, 2), Field("k_race", 25, 2)]
RA_LAYOUT = RACE_KEY + [
    Field("race_no", 25, 2, "int"), Field("race_name", 32, 60), Field("race_grade", 614, 1),
    Field("sex_condition", 618, 3), Field("age_condition", 622, 3), Field("race_class", 634, 3),
    Field("distance", 697, 4, "int"), Field("track", 705, 2), Field("start_time", 873, 4),
    Field("registered", 881, 2, "int"), Field("starters", 883, 2, "int"), Field("weather_code", 887, 1),
    Field("turf_ground", 888, 1), Field("dirt_ground", 889, 1)]
SE_LAYOUT = RACE_KEY + [
    Field("frame_no", 27, 1, "int"), Field("horse_no", 28, 2, "int"), Field("horse_id", 30, 10),
    Field("horse_name", 40, 36), Field("sex_code", 78, 1), Field("horse_age", 82, 2, "int"),
    Field("trainer_id", 85, 5), Field("trainer_name", 90, 8), Field("weight_raw", 288, 3, "int"),
    Field("jockey_id", 296, 5), Field("jockey_name", 306, 8), Field("body_weight", 324, 3, "int"),
    Field("diff_sign", 327, 1), Field("diff_raw", 328, 3, "int"), Field("finish_raw", 334, 2, "int"),
    Field("finish_time", 338, 4), Field("margin", 342, 3), Field("c1", 351, 2), Field("c2", 353, 2),
    Field("c3", 355, 2), Field("c4", 357, 2), Field("odds_raw", 359, 4, "int"), Field("popularity", 363, 2, "int"),
    Field("last3f_raw", 390, 3, "int")]
# repeated blocks: (ticket, start, slots, stride, combination width, payout width)
HR_BLOCKS = [("win", 102, 3, 13, 2, 9), ("place", 141, 5, 13, 2, 9)]
O1_WIN = (43, 28, 8)     # start, slots, stride: number(2) odds(4) popularity(2)
O1_PLACE = (267, 28, 12)  # number(2) min(4) max(4)
CK_LAYOUT = RACE_KEY + [Field("horse_id", 27, 10), Field("snapshot_date", 11, 8, "date8"),
                        Field("prize_raw", 73, 9)] + [Field(f"place{i + 1}", 145 + 3 * i, 3) for i in range(6)]
CENTRES = {"0": "miho", "1": "ritto"}
# training layouts: column -> (HC start, WC start, width, sentinel)
TRAINING_TIMES = {
    "time_4f_seconds": (34, 79, 4, "0000"), "time_3f_seconds": (41, 86, 4, "0000"),
    "time_2f_seconds": (48, 93, 4, "0000"), "lap_800_600_seconds": (38, 83, 3, "000"),
    "lap_600_400_seconds": (45, 90, 3, "000"), "lap_400_200_seconds": (52, 97, 3, "000"),
    "lap_200_0_seconds": (55, 100, 3, "000")}


def race_id(df_cols=None) -> Column:
    """the race key is the concatenation of its six parts."""
    return F.concat(*[F.col(f.name) for f in RACE_KEY])


def record_type(payload: str = "raw_payload") -> Column:
    """First two characters after a byte-order mark."""
    return F.substring(F.regexp_replace(F.col(payload), "^\\x{feff}", ""), 1, 2)


def of_type(records: DataFrame, rt: str, payload: str = "raw_payload") -> DataFrame:
    """D8 dispatch: rows of one record type (the archive's ``record_type``
    column when present, else the first two payload characters)."""
    col = F.col("record_type") if "record_type" in records.columns else record_type(payload)
    return records.where(col == rt)


def _split_rejects(df: DataFrame, ok: Column, reason: str) -> tuple[DataFrame, DataFrame]:
    good = df.where(ok)
    bad = df.where(~ok | ok.isNull()).withColumn("reject_reason", F.lit(reason))
    return good, bad


def decode_races(records: DataFrame, payload: str = "raw_payload", keep=("record_hash",)):
    """RA records -> races (+ rejects without a valid race date)."""
    d = decode(of_type(records, "RA", payload), payload, RA_LAYOUT, keep)
    d = d.withColumn("race_date", yyyymmdd(F.concat("k_year", "k_mmdd")))
    good, bad = _split_rejects(d, F.col("race_date").isNotNull(), "race_date")
    surf = codes.surface(F.col("track"))
    out = good.select(
        *keep, race_id().alias("race_id"), "race_date", codes.course_name(F.col("k_course")).alias("course"),
        F.coalesce("race_no", F.lit(0)).alias("race_no"), "race_name", surf.alias("surface"), "distance",
        codes.direction(F.col("track")).alias("direction"),
        codes.lookup(F.col("weather_code"), codes.WEATHER).alias("weather"),
        codes.lookup(F.when(surf == codes.DIRT, F.col("dirt_ground")).otherwise(F.col("turf_ground")),
                     codes.GROUND).alias("ground_condition"),
        "race_class", "race_grade", "age_condition", "sex_condition",
        F.coalesce("starters", "registered").alias("field_size"), "start_time")
    return out, bad.select(*keep, "reject_reason")


def decode_entries(records: DataFrame, payload: str = "raw_payload", keep=("record_hash",)):
    """D2 + P17 + F10: SE records -> entry and result columns of one row."""
    d = decode(of_type(records, "SE", payload), payload, SE_LAYOUT, keep)
    d = d.withColumn("race_date", yyyymmdd(F.concat("k_year", "k_mmdd")))
    good, bad = _split_rejects(d, F.col("race_date").isNotNull(), "race_date")
    diff = F.when(F.col("diff_sign") == "-", -F.col("diff_raw")).otherwise(F.col("diff_raw"))
    last3f = F.when(F.col("last3f_raw").isNull() | F.col("last3f_raw").isin(0, 999), F.lit(None).cast("double")
                    ).otherwise(F.col("last3f_raw") / 10.0)
    out = good.select(
        *keep, race_id().alias("race_id"), "horse_id", "horse_name", "horse_no", "frame_no", "jockey_id", "jockey_name",
        "trainer_id", "trainer_name", "horse_age", codes.lookup(F.col("sex_code"), codes.SEX).alias("horse_sex"),
        (F.coalesce("weight_raw", F.lit(0)) / 10.0).alias("weight_carried"), "body_weight",
        diff.alias("body_weight_diff"), odds_value(F.col("odds_raw")).alias("odds_win"), "popularity",
        F.when(F.col("finish_raw") != 0, F.col("finish_raw")).alias("finish_position"), "finish_time", "margin",
        F.coalesce(join_parts(["c1", "c2", "c3", "c4"]), F.lit("")).alias("corner_order"), last3f.alias("last_3f"))
    return out, bad.select(*keep, "reject_reason")


def decode_payouts(records: DataFrame, payload: str = "raw_payload", keep=("record_hash",)) -> DataFrame:
    """D3: HR records -> one row per non-empty payout slot (win x3, place x5);
    blank or all-zero combinations and empty or zero payouts are skipped."""
    hr = one_char_per_byte(of_type(records, "HR", payload), payload)
    p = F.col(payload)
    slots = []
    for ticket, start, n, stride, cw, pw in HR_BLOCKS:
        for i in range(n):
            off = start + i * stride
            slots.append(F.struct(F.lit(ticket).alias("ticket_type"), cut(p, off, cw).alias("combination"),
                                  as_int(cut(p, off + cw, pw)).alias("payout")))
    rows = hr.select(*keep, *[cut(p, f.start, f.width).alias(f.name) for f in RACE_KEY],
                     F.explode(F.array(*slots)).alias("__s"))
    comb = F.col("__s.combination")
    ok = (comb != "") & ~comb.rlike("^0+$") & F.col("__s.payout").isNotNull() & (F.col("__s.payout") != 0)
    return rows.where(ok).select(*keep, race_id().alias("race_id"), "__s.ticket_type", "__s.combination", "__s.payout")


def decode_odds(records: DataFrame, payload: str = "raw_payload", keep=("record_hash",)) -> DataFrame:
    """O1 records -> per (record, horse number) win odds and popularity from
    the win block and place min/max from the place block; the last slot of a
    number wins, number 0 or blank is skipped, and either block may lack a
    number.  The merge never leaves the record: no shuffle."""
    o1 = one_char_per_byte(of_type(records, "O1", payload), payload)

    def numbers(start, n, stride):
        return F.array(*[as_int(cut(payload, start + i * stride, 2)) for i in range(n)])

    def last_slot(slots, start, n, stride):
        """Start of the last slot of the row's number, null if it has none."""
        at = F.array_position(F.reverse(slots), F.col("horse_no"))
        return F.when(at > 0, F.lit(start) + (F.lit(n) - at).cast("int") * stride)
    rows = o1.select(*keep, payload, *[cut(payload, f.start, f.width).alias(f.name) for f in RACE_KEY],
                     numbers(*O1_WIN).alias("__win"), numbers(*O1_PLACE).alias("__place"))
    every = F.array_distinct(F.array_compact(F.array_remove(F.concat("__win", "__place"), 0)))
    # only the slots that count are cut for their values, one row per number
    rows = rows.select(*keep, payload, race_id().alias("race_id"), "__win", "__place", F.explode(every).alias("horse_no"))
    rows = rows.select(*keep, payload, "race_id", "horse_no", last_slot(F.col("__win"), *O1_WIN).alias("__w"),
                       last_slot(F.col("__place"), *O1_PLACE).alias("__p"))
    value = lambda at, skip, width: as_int(cut(payload, F.col(at) + skip, width))
    return rows.select(*keep, "race_id", "horse_no", odds_value(value("__w", 2, 4)).alias("odds_win"),
                       odds_value(value("__p", 2, 4)).alias("odds_place_min"), odds_value(value("__p", 6, 4)).alias("odds_place_max"),
                       value("__w", 6, 2).alias("popularity"))


def decode_snapshots(records: DataFrame, payload: str = "raw_payload", spec: str = "SNPN",
                     received: str = "received_at") -> DataFrame:
    """D5 + G9: CK records of ``spec`` -> the latest snapshot per (race, horse):
    prize x 100 and runs = sum of the six placings (missing counts 0)."""
    from tessera.operators.latest import latest_per_key
    ck = records.where((F.col("data_spec") == spec) & (F.col("record_type") == "CK"))
    d = decode(ck, payload, CK_LAYOUT, keep=("record_hash", received))
    places = [F.nullif(F.col(f"place{i + 1}"), F.lit("")).try_cast("int") for i in range(6)]
    d = d.select(race_id().alias("race_id"), "horse_id", "snapshot_date",
                 (F.nullif(F.col("prize_raw"), F.lit("")).try_cast("long") * 100).alias("flat_prize_yen"),
                 sum(F.coalesce(x, F.lit(0)) for x in places).alias("central_runs"),
                 *[x.alias(n) for x, n in zip(places, ["central_wins", "central_seconds", "central_thirds",
                                                         "central_fourths", "central_fifths", "central_other"])],
                 F.col("record_hash").alias("source_hash"), received)
    return latest_per_key(d, ["race_id", "horse_id"], [received, "source_hash"]).drop(received)


def decode_sessions(records: DataFrame, payload: str = "raw_payload", existing: DataFrame | None = None) -> DataFrame:
    """D6 + P19 + U2: HC/WC records (3rd character not '0') -> training sessions,
    times by record type with all-zero sentinels as null; insert-only by hash."""
    t = one_char_per_byte(records, payload).where(F.col("record_type").isin("HC", "WC") & (F.substring(payload, 3, 1) != "0"))
    p, rt = F.col(payload), F.col("record_type")
    cols = [F.col("record_hash").alias("source_hash"), rt.alias("record_type"),
            yyyymmdd(cut(p, 3, 8)).alias("created_date"), yyyymmdd(cut(p, 12, 8)).alias("training_date"),
            codes.lookup(F.substring(p, 12, 1), CENTRES).alias("training_center"),
            F.substring(p, 25, 10).alias("horse_id"),
            F.when(rt == "WC", F.substring(p, 35, 1)).alias("course_code"),
            F.when(rt == "WC", F.substring(p, 36, 1)).alias("direction_code")]
    for name, (hc, wc, width, sentinel) in TRAINING_TIMES.items():
        raw = F.when(rt == "HC", F.substring(p, hc + 1, width)).otherwise(F.substring(p, wc + 1, width))
        cols.append(tenths_or_null(raw, sentinel).cast(f"decimal({width + 2},1)").alias(name))
    out = t.select(*cols).dropDuplicates(["source_hash"])
    if existing is not None:
        out = out.join(existing.select("source_hash"), "source_hash", "left_anti")
    return out
