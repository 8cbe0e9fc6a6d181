import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from nestrel.session import get_spark
    wh = tempfile.mkdtemp(prefix="nestrel-warehouse-")
    s = get_spark("local[4]", "nestrel-tests", shuffle_partitions=8,
                  extra_conf={"spark.sql.warehouse.dir": wh})
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture()
def scratch():
    return tempfile.mkdtemp(prefix="nestrel-test-")
