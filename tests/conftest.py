import os
import sys
import tempfile

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
# Python workers import the package too (local runs; a cluster ships it)
os.environ["PYTHONPATH"] = os.pathsep.join([ROOT, os.environ.get("PYTHONPATH", "")])

SF_SMALL = "/root/testdata/sf0.001"
SF_MID = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from adcredit.session import get_session
    s = get_session("local[4]", app="adcredit-tests", shuffle_partitions=4,
                    extra={"spark.driver.memory": "4g",
                           "spark.checkpoint.dir": tempfile.mkdtemp(prefix="adcredit-test-ckpt-")})
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()
