import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF0001 = "/root/testdata/sf0.001"
SF001 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from strata.session import build_session

    scratch = tempfile.mkdtemp(prefix="strata-test-", dir="/tmp")
    s = build_session(
        master="local[*]", shuffle_partitions=8,
        **{
            "spark.checkpoint.dir": f"{scratch}/ckpt",
            "spark.sql.warehouse.dir": f"{scratch}/warehouse",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    yield s
    s.stop()
