import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from rawmart.session import build_session

    import tempfile

    wh = tempfile.mkdtemp(prefix="rawmart-wh-")
    s = build_session("local[4]", shuffle_partitions=4, app="rawmart-tests", conf={"spark.sql.warehouse.dir": wh})
    yield s
    s.stop()


@pytest.fixture
def scratch(spark, tmp_path):
    return str(tmp_path)
