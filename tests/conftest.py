import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    import tempfile

    from strata.session import build_session

    # tests create databases; keep their default folder out of the repo
    warehouse = tempfile.mkdtemp(prefix="strata-warehouse-")
    session = build_session(
        "strata-tests", master="local[2]", shuffle_partitions=2,
        conf={"spark.sql.warehouse.dir": warehouse},
    )
    yield session
    session.stop()


@pytest.fixture()
def scratch(spark):
    from strata.session import scratch_path

    return lambda name="t": scratch_path(spark, name)
