import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tests"))


@pytest.fixture(scope="session")
def spark():
    from pitchlake.session import get_spark

    s = get_spark("local[4]", 4, app_name="pitchlake-tests")
    yield s
    s.stop()


@pytest.fixture(scope="module", autouse=True)
def no_cache_left(spark):
    """What a module's fixtures cache goes with the module."""
    yield
    spark.catalog.clearCache()
