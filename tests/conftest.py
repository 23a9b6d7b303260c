import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from strata.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    shared = tempfile.mkdtemp(prefix="strata-test-")
    s = build_session("local[4]", "strata-tests", 8, {"spark.checkpoint.dir": shared,
                                                      "spark.sql.warehouse.dir": f"{shared}/warehouse",
                                                      "spark.driver.memory": "4g"})
    yield s
    s.stop()


@pytest.fixture()
def scratch(spark):
    from strata.session import shared_path
    return shared_path(spark, "tests", unique=True)
