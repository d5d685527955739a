import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
os.environ.setdefault("PYTHONPATH", os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from quillspark.session import make_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = make_session("local[4]", **{"spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.driver.memory": "4g", "spark.default.parallelism": "4"})
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()
