"""Python workers must find the package wherever the driver was started."""

import os
import subprocess
import sys

import __spark_entry__ as entry
from check import connect
from conftest import SMALL

SCRIPT = """
import sys
sys.path.insert(0, {root!r})
import __spark_entry__ as entry
from pyspark.sql import SparkSession
spark = SparkSession.builder.master("local[2]").config("spark.ui.enabled", "false").getOrCreate()
print("rows", entry.queries()["quarantine"](spark, {tables!r}).count())
"""


def test_started_elsewhere(tmp_path):
    expected = len(connect(SMALL).sql(entry.oracle_sql()["quarantine"]).fetchall())
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    environment = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run(
        [sys.executable, "-c", SCRIPT.format(root=root, tables=SMALL)],
        cwd=tmp_path, env=environment, capture_output=True, text=True, timeout=300,
    )
    assert expected > 0
    assert f"rows {expected}" in done.stdout, done.stderr[-2000:]
