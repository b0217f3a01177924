import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from tessera.session import build_session, checkpoint_dir
    s = build_session("local[4]", 8, extra={
        # small Arrow batches so pandas-backed scans cross batch boundaries in tests
        "spark.sql.execution.arrow.maxRecordsPerBatch": "500",
    })
    checkpoint_dir(s)
    yield s
