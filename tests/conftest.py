import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from pathcredit.session import local_session

    session = local_session(cores="*", shuffle_partitions=8, app="pathcredit-tests")
    yield session
    session.stop()


@pytest.fixture()
def scratch(spark):
    from pathcredit.session import work_dir

    return work_dir(spark, "test")
