import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from feedworks.session import get_session  # noqa: E402

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    s = get_session(master="local[4]", app_name="feedworks-tests", shuffle_partitions=8,
                    extra_conf={"spark.driver.memory": "4g", "spark.ui.showConsoleProgress": "false",
                                "spark.checkpoint.dir": tempfile.mkdtemp(prefix="feedworks-test-shared-"),
                                "spark.sql.adaptive.coalescePartitions.enabled": "true"})
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


def one_col(spark, values, dtype="string"):
    return spark.createDataFrame([(v,) for v in values], f"v {dtype}")


def run(spark, values, fn, dtype="string"):
    """Apply a Column function to each value, return the results in input order."""
    df = one_col(spark, values, dtype)
    return [r[0] for r in df.select(fn("v")).collect()]
