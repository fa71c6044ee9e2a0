import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF0001 = "/root/testdata/sf0.001"
SF001 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from vaultweave.session import build_session, checkpoint_root

    s = build_session("local[*]", shuffle_partitions=8)
    checkpoint_root(s)          # sets a private folder only when spark.checkpoint.dir is unset
    yield s
    s.stop()


@pytest.fixture()
def work(spark):
    from vaultweave.session import new_work_dir

    return new_work_dir(spark, "test")
