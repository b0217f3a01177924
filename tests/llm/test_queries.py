"""The registered queries on the smallest tables, against SQL or plain Python."""

import os

import pytest

from scripts.check_oracle import compare, duck
from tests.llm import reference as ref
from tessera.llm import queries  # noqa: F401
from tessera.llm.registry import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    if not os.path.isdir(SF):
        pytest.skip("test data not present")
    return duck(SF)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, con, name):
    res = compare(spark, con, name, QUERIES[name], ORACLES[name], SF)
    assert res["ok"], res


def test_thirteen_operators_are_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


def test_pipeline_keeps_what_its_stages_decide(spark, con):
    """Each stage against the decisions of plain Python on its own input."""
    import corpus_pipeline as p
    from tessera.llm.common import stage, table
    assert [n for n, _ in p.STAGES] == ["toxicity", "exact_dedup", "simhash", "mixing", "packing"]
    docs = table(spark, SF, "documents")
    columns = docs.columns
    seen = {}
    for name, step in p.STAGES:
        before = [tuple(r) for r in docs.select("doc_id", "text").collect()] if name != "packing" else docs.count()
        docs = stage(step(spark, docs, SF), f"test-{name}")
        seen[name] = (before, docs)
        if name != "packing":
            assert docs.columns == columns
    ids = lambda name: sorted(r.doc_id for r in seen[name][1].select("doc_id").collect())
    before = seen["exact_dedup"][0]
    assert ids("exact_dedup") == sorted(r[0] for r in ref.exact_rows(before) if r[3])
    before = seen["simhash"][0]
    assert ids("simhash") == sorted(set(ref.components_of([d for d, _ in before], [ref.simhash(t) for _, t in before])))
    assert set(ids("mixing")) <= set(ids("simhash")) and ids("mixing")
    packed = seen["packing"][1]
    assert packed.select("doc_id").distinct().count() == seen["packing"][0]
    assert p.run(spark, SF).count() == packed.count()
