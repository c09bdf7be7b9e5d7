import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from mooclens.session import get_spark
    s = get_spark("local[4]", app="mooclens-tests", shuffle_partitions=4)
    yield s


@pytest.fixture(scope="session")
def tables(spark):
    from mooclens.sources.bridge import Tables
    return Tables(spark, SF)
