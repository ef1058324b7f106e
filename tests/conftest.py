import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from statlayer.session import get_spark
    s = get_spark("statlayer-tests", master="local[4]", shuffle_partitions=8,
                  conf={"spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="statlayer-wh-")})
    yield s
    s.stop()


@pytest.fixture
def tmp_dir(tmp_path):
    return str(tmp_path)
