"""The decode queries are fed the whole mixed archive and pick their type out of it."""

import pytest

from tessera.plans import cases_decode, catalog
from tessera.plans import decode as dec

catalog.load_all()
JOBS = ("decode_races", "decode_entries", "decode_payouts", "decode_odds")


class Fed(Exception):
    pass


@pytest.mark.parametrize("name", JOBS)
def test_decode_queries_read_all_record_types(monkeypatch, name):
    asked = []
    monkeypatch.setattr(cases_decode, "records", lambda spark, sf_dir, *types: asked.append(types))

    def stop(*_, **__):
        raise Fed
    monkeypatch.setattr(dec, name, stop)
    with pytest.raises(Fed):
        catalog.QUERIES[name](None, "")
    assert asked == [()]
