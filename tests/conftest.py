import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from lodestone.session import get_session
    ckpt = tempfile.mkdtemp(prefix="lodestone-test-ckpt-")
    s = get_session("local[4]", app="lodestone-tests", shuffle_partitions=8,
                    conf={"spark.checkpoint.dir": ckpt, "spark.driver.memory": "4g",
                          "spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="lodestone-test-wh-")})
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture()
def tmp(tmp_path):
    return str(tmp_path)
