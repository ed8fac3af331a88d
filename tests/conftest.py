import os
import sys
import tempfile
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def scratch() -> str:
    # a fresh folder per test run (never cleared in place)
    return tempfile.mkdtemp(prefix="cxlake-tests-")


@pytest.fixture(scope="session")
def spark(scratch):
    from cxlake.session import get_or_create_session

    s = get_or_create_session(
        master="local[4]",
        shuffle_partitions=4,
        extra_conf={
            "spark.sql.warehouse.dir": os.path.join(scratch, "warehouse"),
            "spark.driver.memory": "4g",
        },
    )
    yield s
    s.stop()
