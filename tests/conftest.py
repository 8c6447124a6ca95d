import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from lumenflow.session import build_session

    s = build_session(
        app_name="lumenflow-tests",
        master="local[4]",
        shuffle_partitions=4,
        extra_conf={"spark.sql.warehouse.dir": tempfile.mkdtemp(prefix="lf-wh-")},
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s


@pytest.fixture()
def tmp_dir(tmp_path):
    return str(tmp_path)
