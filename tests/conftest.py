import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from ledgerloom.session import get_spark
    ckpt = tempfile.mkdtemp(prefix="ledgerloom-test-ckpt-")
    s = get_spark("local[4]", app_name="ledgerloom-tests", shuffle_partitions=8,
                  extra_conf={"spark.checkpoint.dir": ckpt,
                              "spark.driver.memory": "4g"})
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="ledgerloom-test-")
