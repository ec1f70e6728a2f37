import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from plotwise.session import get_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = get_session("plotwise-tests", **{
        "spark.master": "local[8]", "spark.sql.shuffle.partitions": "8", "spark.driver.memory": "8g",
        "spark.ui.enabled": "false", "spark.checkpoint.dir": tempfile.mkdtemp(prefix="plotwise-test-"),
    })
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def one(spark):
    """Evaluate expressions on a single row of literals."""
    from pyspark.sql import functions as F

    def run(fn, *values_by_row, schema):
        df = spark.createDataFrame([v if isinstance(v, tuple) else (v,) for v in values_by_row], schema)
        return [r[0] for r in df.select(fn(*[F.col(c) for c in df.columns])).collect()]
    return run
