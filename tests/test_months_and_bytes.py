"""Month tables, byte payloads and ranks in cells."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tessera.functions.parse import bytes_of, java_charsets, shift_jis
from tessera.operators.asof import heavy_keys
from tessera.operators.groupnorm import group_rank
from tessera.operators.upsert import DuplicateKeyError
from tessera.plans import decode as dec
from tessera.plans.jobs import LATEST_ALL, build_training_features, race_training_features
from tessera.session import scratch_path
from tessera.sources import files
from tessera.sources.month_table import MonthTable, month_steps

D = dt.date


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


def frame(spark, rows):
    return spark.createDataFrame(rows, "k int, day date, v string")


def table(spark, name):
    return MonthTable(spark, scratch_path(spark, f"{name}-{random.random()}"), ["k"], "day")


def test_month_steps():
    assert month_steps(D(2023, 12, 10), D(2024, 3, 5), 1) == [
        (D(2023, 12, 10), D(2024, 1, 1)), (D(2024, 1, 1), D(2024, 2, 1)), (D(2024, 2, 1), D(2024, 3, 1)), (D(2024, 3, 1), D(2024, 3, 5))]
    assert month_steps(D(2024, 1, 1), D(2024, 1, 1)) == []


def test_months_outside_the_range_are_not_rewritten(spark):
    t = table(spark, "months")
    t.write(frame(spark, [(1, D(2024, 1, 5), "a"), (2, D(2024, 1, 20), "a"), (3, D(2024, 2, 1), "a"), (4, D(2024, 3, 1), "a")]),
            D(2024, 1, 1), D(2024, 4, 1), "one")
    before = t._manifest()["months"]
    # a range that cuts January: row 1 lies before it and stays, row 2 is replaced
    assert t.write(frame(spark, [(2, D(2024, 1, 20), "b"), (5, D(2024, 2, 2), None)]), D(2024, 1, 10), D(2024, 3, 1), "two") == ["2024-01", "2024-02"]
    after = t._manifest()["months"]
    assert after["2024-03"] == before["2024-03"] and after["2024-01"] != before["2024-01"]
    assert sorted((r.k, r.v) for r in t.read().collect()) == [(1, "a"), (2, "b"), (3, "a"), (4, "a"), (5, None)]
    assert [r.k for r in t.read(D(2024, 1, 10), D(2024, 2, 1)).collect()] == [2]
    assert len(t.clean()) == 2 and t.read().count() == 5


def test_a_lost_write_changes_nothing_and_a_step_counts_once(spark, monkeypatch):
    t = table(spark, "lost")
    t.write(frame(spark, [(1, D(2024, 1, 5), "a")]), D(2024, 1, 1), D(2024, 2, 1), "one")
    new = frame(spark, [(1, D(2024, 1, 5), "b"), (2, D(2024, 1, 6), "b")])
    with monkeypatch.context() as m:
        m.setattr(files, "write_text", lambda *a: (_ for _ in ()).throw(OSError("lost")))
        with pytest.raises(OSError):
            t.write(new, D(2024, 1, 1), D(2024, 2, 1), "two")
    assert [r.v for r in t.read().collect()] == ["a"]
    t.write(new, D(2024, 1, 1), D(2024, 2, 1), "two")
    assert t.write(frame(spark, [(1, D(2024, 1, 5), "c")]), D(2024, 1, 1), D(2024, 2, 1), "two") == []
    assert [r.v for r in t.read().collect()] == ["b", "b"]


@pytest.mark.parametrize("day", [D(2024, 2, 1), None])
def test_a_day_out_of_range_is_refused(spark, day):
    with pytest.raises(Exception, match="a day outside"):
        table(spark, "range").write(frame(spark, [(1, day, "a")]), D(2024, 1, 1), D(2024, 2, 1))


def test_empty_months(spark):
    t = table(spark, "empty")
    assert t.read() is None and t.write(frame(spark, []), D(2024, 1, 1), D(2024, 2, 1)) == []
    assert t.read().count() == 0


def test_training_runs_resume_and_overlap(spark, monkeypatch):
    rnd = random.Random(3)
    day = lambda: D(2024, 1, 1) + dt.timedelta(days=rnd.randrange(120))
    sessions = spark.createDataFrame([(rnd.randrange(6) or None, day(), i, rnd.random(), rnd.random(), rnd.random(), "HC") for i in range(300)],
                                     "horse_id int, training_date date, created int, t4f double, t3f double, t1f double, record_type string")
    entries = spark.createDataFrame([(f"r{i}", rnd.randrange(8), day()) for i in range(120)], "race_id string, horse_id int, race_date date")
    make = lambda name: MonthTable(spark, scratch_path(spark, f"{name}-{random.random()}"), ["race_id", "horse_id"], "race_date")
    whole, parts = make("whole"), make("parts")
    build_training_features(whole, entries, sessions, D(2024, 1, 1), D(2024, 5, 1))
    build_training_features(parts, entries, sessions, D(2024, 1, 1), D(2024, 3, 10), months=1)
    # the second run overlaps the first, is lost after its first step, and goes on
    write, seen = MonthTable.write, []

    def fails(self, *a):
        if seen:
            raise OSError("lost")
        seen.append(1)
        return write(self, *a)
    with monkeypatch.context() as m:
        m.setattr(MonthTable, "write", fails)
        with pytest.raises(OSError):
            build_training_features(parts, entries, sessions, D(2024, 2, 20), D(2024, 5, 1), months=1, run="again")
    rest = build_training_features(parts, entries, sessions, D(2024, 2, 20), D(2024, 5, 1), months=1, run="again")
    assert rest == ["2024-03", "2024-04"]
    assert rows_of(parts.read()) == rows_of(whole.read()) and whole.read().count() == 120
    assert {"latest_4f", "latest_3f", "latest_1f", "latest_type", "best_3f_14d"} <= set(whole.read().columns)


def test_names_are_recovered_from_bytes_and_from_misread_text(spark):
    names = ["ディープインパクト", "ｱｰﾓﾝﾄﾞ", "plain", "", "表十ソ"]
    raw = [(n, bytearray(n.encode("shift_jis")), n.encode("shift_jis").decode("latin-1")) for n in names]
    misread = "".join(bytes([b]).decode("cp1252", "replace") if b not in (0x81, 0x8D, 0x8F, 0x90, 0x9D) else chr(b)
                      for b in "東京優駿Ａ".encode("shift_jis"))
    raw.append(("東京優駿Ａ", bytearray("東京優駿Ａ".encode("shift_jis")), misread))
    df = spark.createDataFrame(raw, "name string, raw binary, text string")
    with java_charsets(spark):
        out = df.select("name", shift_jis("raw").alias("a"), shift_jis(bytes_of("text")).alias("b"))
    assert all(r.name == r.a == r.b for r in out.collect())
    with java_charsets(spark):
        broken = spark.createDataFrame([(bytearray(b"\x83"), "日")], "raw binary, text string").select(
            shift_jis("raw").alias("a"), bytes_of("text").alias("b"))
    got = broken.first()  # half a character, and a character that no byte stands for
    assert got.a == "�" and bytes(got.b) == b"?"
    assert spark.conf.get("spark.sql.legacy.javaCharsets") == "false"


def test_fields_behind_a_two_byte_name_keep_their_place(spark):
    layout = [dec.Field("name", 2, 10), dec.Field("n", 12, 3, "int"), dec.Field("day", 15, 8, "date8")]
    payload = b"SE" + "ナリタ　".encode("shift_jis").ljust(10) + b"042" + b"20240229"
    rows = [(1, bytearray(payload)), (2, bytearray(b"SE")), (3, None)]
    df = spark.createDataFrame(rows, "id int, raw binary")
    assert [tuple(r) for r in dec.decode(df, "raw", layout, keep=["id"]).orderBy("id").collect()] == [
        (1, "ナリタ", 42, D(2024, 2, 29)), (2, "", None, None), (3, None, None, None)]


def test_odds_last_slot_of_a_number_counts(spark):
    win = "010015010000990302000002" + "01002003" + "00000000" * 24  # 1 twice, 0 skipped, 2 has no odds
    text = "O1" + " " * 9 + "20240101050101" + "01" + " " * 16 + win.ljust(224) + "030010002005".ljust(336)
    df = spark.createDataFrame([("x", "O1", text)], "record_hash string, record_type string, raw_payload string")
    for source in (df, df.withColumn("raw_payload", F.encode("raw_payload", "ISO-8859-1"))):
        got = {r.horse_no: tuple(r)[3:] for r in dec.decode_odds(source).collect()}
        assert got[1] == (2.0, None, None, 3) and got[3] == (None, 1.0, 2.0, None) and 0 not in got


@pytest.mark.parametrize("ascending", [True, False])
def test_rank_in_cells_of_wide_groups(spark, ascending):
    rnd = random.Random(8)
    special = [float("inf"), float("-inf"), float("nan"), 1e308, -1e308, 0.0, None]
    rows = [("hot", rnd.choice(special) if rnd.random() < 0.1 else round(rnd.paretovariate(0.7), 1)) for _ in range(3000)]
    rows += [(f"g{i % 900}", rnd.choice([None, 1.0, 2.5, 9.9])) for i in range(6000)] + [("one", 5.0)] * 40 + [(None, 1.0)]
    df = spark.createDataFrame(rows, "g string, v double")
    whole, cells = group_rank(df, "g", "v", "r", ascending), group_rank(df, "g", "v", "r", ascending, piece=100)
    assert sorted(map(str, whole.collect())) == sorted(map(str, cells.collect()))
    df.createOrReplaceTempView("ranked_rows")
    want = spark.sql(f"SELECT g, v, rank() OVER (PARTITION BY g ORDER BY v {'ASC' if ascending else 'DESC'} NULLS LAST) AS r FROM ranked_rows WHERE g = 'hot' AND v IS NOT NULL")
    assert sorted(map(str, want.collect())) == sorted(map(str, cells.select("g", "v", "r").where("g = 'hot' AND v IS NOT NULL").collect()))


def test_rank_windows_of_a_wide_group_hold_a_cell_each(spark):
    plan = group_rank(spark.range(10).selectExpr("'g' AS g", "CAST(id AS DOUBLE) AS v"), "g", "v", "r", piece=2)._jdf.queryExecution().toString()
    ordered = [line for line in plan.splitlines() if "windowspecdefinition(g" in line]
    assert ordered and all("__cell" in line for line in ordered)


def test_training_steps_deal_their_rows_once(spark, monkeypatch):
    """One exchange by key per step, none for a join back; a write computes its rows once."""
    sessions = spark.createDataFrame([(1, D(2024, 1, 1), 1, 1.0, 2.0, 3.0, "HC")],
                                     "horse_id int, training_date date, created int, t4f double, t3f double, t1f double, record_type string")
    entries = spark.createDataFrame([("a", 1, D(2024, 1, 3))], "race_id string, horse_id int, race_date date")
    plan = race_training_features(entries, sessions)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1 and "Join" not in plan and "Aggregate" not in plan, plan
    # what asks for the keys of a write (repeated ones, older rows that stay) reads the written rows
    t, seen = table(spark, "once"), spark.sparkContext.accumulator(0)
    t.write(frame(spark, [(1, D(2024, 1, 5), "a"), (7, D(2024, 1, 6), "a")]), D(2024, 1, 1), D(2024, 2, 1), "one")

    def counted(rows):
        for r in rows:
            seen.add(len(r))
            yield r
    t.write(frame(spark, [(1, D(2024, 1, 5), "b"), (2, D(2024, 1, 9), "b")]).mapInPandas(counted, "k int, day date, v string"),
            D(2024, 1, 1), D(2024, 2, 1), "two")
    assert seen.value == 2
    assert sorted((r.k, r.v) for r in t.read().collect()) == [(1, "b"), (2, "b"), (7, "a")]
    with pytest.raises(DuplicateKeyError):
        t.write(frame(spark, [(3, D(2024, 1, 5), "c"), (3, D(2024, 1, 6), "c")]), D(2024, 1, 1), D(2024, 2, 1), "three")
    assert "three" not in t.done() and t.read().count() == 3


def test_training_of_large_keys_and_odd_rows_is_the_same(spark):
    rnd = random.Random(5)
    day = lambda: rnd.choice([None, *[D(2024, 1, 1) + dt.timedelta(days=k) for k in range(40)]])
    number = lambda: rnd.choice([None, 1.0, 2.0, 3.0])
    sessions = spark.createDataFrame([(rnd.choice([None, 1, 1, 1, 2, 3]), day(), rnd.choice([None, i]), number(), number(), number(), rnd.choice([None, "HC"]))
                                      for i in range(400)],
                                     "horse_id int, training_date date, created int, t4f double, t3f double, t1f double, record_type string")
    entries = [(f"r{i % 150}", rnd.choice([None, 1, 2, 3, 4]), day()) for i in range(200)]
    races = spark.createDataFrame([*entries, *entries[:20]], "race_id string, horse_id int, race_date date")
    found = [race_training_features(races, sessions, latest=LATEST_ALL, heavy=heavy) for heavy in
             (None, heavy_keys(races, sessions, ["horse_id"], piece=100), heavy_keys(races, sessions, ["horse_id"], piece=0))]
    assert len({tuple(f.columns) for f in found}) == 1
    rows = [sorted(map(str, f.collect())) for f in found]
    assert rows[0] == rows[1] == rows[2] and len(rows[0]) == 220
    # and as the operators of a session count and a latest row say, day by day
    known = [s for s in sessions.collect() if s.horse_id is not None and s.training_date]
    for r in found[0].collect():
        before = [s for s in known if r.race_date and s.horse_id == r.horse_id and s.training_date < r.race_date]
        near = [s for s in before if (r.race_date - s.training_date).days <= 14]
        best = [s.t3f for s in near if s.t3f is not None]
        assert (r.sessions_14d, r.best_3f_14d) == (len(near), min(best, default=None))
        assert r.sessions_7d == sum((r.race_date - s.training_date).days <= 7 for s in near)
        last = max(before, key=lambda s: (s.training_date, s.created is not None, s.created or 0), default=None)
        assert r.days_since_latest == (last and (r.race_date - last.training_date).days)
        if last and last.created is not None:
            assert (r.latest_4f, r.latest_3f, r.latest_1f, r.latest_type) == (last.t4f, last.t3f, last.t1f, last.record_type)
