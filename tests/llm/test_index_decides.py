"""op8 takes its decisions from the digest index that it has written."""

from tessera.llm import exact_dedup, queries


def test_decisions_come_from_the_index(spark, tmp_path, monkeypatch):
    rows = [(1, "a b"), (2, "ab"), (3, "c"), (4, None), (5, " "), (6, "c")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    made = []

    class Kept(exact_dedup.DigestIndex):
        def __init__(self, *args, **more):
            super().__init__(*args, **more)
            made.append(self)
    monkeypatch.setattr(exact_dedup, "DigestIndex", Kept)
    got = {r.doc_id: (r.keep_id, r.group_size, r.kept) for r in queries.op8(spark, str(tmp_path)).collect()}
    assert got == {1: (1, 2, True), 2: (1, 2, False), 3: (3, 2, True), 4: (5, 2, False), 5: (5, 2, True), 6: (3, 2, False)}
    assert sorted(r.keep_id for r in made[0].rows().collect()) == [1, 3, 5]
    # a text that an earlier batch brought in keeps that batch's row
    later = spark.createDataFrame([(9, "c c c"), (10, "c  "), (11, "new")], "doc_id long, text string")
    members, reps = exact_dedup.classes(later, made[0], batch="later")
    made[0].commit(reps, "later")
    got = {r.doc_id: (r.keep_id, r.kept) for r in exact_dedup.decide(members, made[0].look_up(reps, "later")).collect()}
    assert got == {9: (9, True), 10: (3, False), 11: (11, True)}
