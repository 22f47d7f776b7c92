import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from claimlens.session import get_spark, shared_dir
    s = get_spark("local[*]", 8, app_name="claimlens-tests", extra={"spark.driver.memory": "8g"})
    shared_dir(s)  # tests run without a cluster: a local shared folder is set here
    yield s
