import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tests"))


@pytest.fixture(scope="session")
def spark():
    from rollcall import build_session, ensure_checkpoint_dir
    session = build_session("local[4]", app="rollcall-tests", shuffle_partitions=8)
    ensure_checkpoint_dir(session)   # the configured spark.checkpoint.dir, or a local folder if unset
    yield session
    session.stop()


@pytest.fixture(scope="session")
def tables(spark):
    from fixture_tables import operational_tables
    return operational_tables(spark)
