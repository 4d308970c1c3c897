import os
import sys

import pytest

HERE = os.path.dirname(os.path.abspath(__file__))
sys.path[:0] = [os.path.dirname(HERE), HERE]
# Clients that the tests define are found by the Python workers through this.
os.environ["PYTHONPATH"] = os.pathsep.join([HERE, os.environ.get("PYTHONPATH", "")])

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from postmill.session import build_session

    session = build_session(
        "postmill-tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def apply(spark):
    """Run a column function over values: ``apply(fn, [a, b])`` gives the results in order."""

    def run(fn, values):
        from pyspark.sql import functions as F

        rows = spark.createDataFrame(list(enumerate(values)), "i int, x string")
        return [r.y for r in rows.select("i", fn(F.col("x")).alias("y")).orderBy("i").collect()]

    return run
