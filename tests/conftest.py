import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
if ROOT not in sys.path:
    sys.path.insert(0, ROOT)

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from nearframe.session import local_session

    s = local_session(4, app="nearframe-tests", shuffle_partitions=4)
    yield s
    s.stop()


def points(spark, rows, schema="id long, f0 double, f1 double, label int"):
    return spark.createDataFrame(rows, schema)
