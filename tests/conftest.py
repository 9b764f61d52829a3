import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from lakestrata.session import build_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    scratch = tempfile.mkdtemp(prefix="lakestrata-tests-")
    session = build_session(
        "local[4]",
        app_name="lakestrata-tests",
        shuffle_partitions=4,
        extra_conf={"spark.checkpoint.dir": os.path.join(scratch, "checkpoints"), "spark.driver.memory": "4g"},
    )
    yield session
    session.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="lakestrata-t-")
