import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tracewell.session import local_session  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    return local_session("4", "4g", "tests")


@pytest.fixture
def folder():
    return SF


@pytest.fixture
def apply(spark):
    """Run a Column builder over plain values and give the results in order."""
    from pyspark.sql import functions as F

    def run(build, values, dtype="string"):
        rows = spark.createDataFrame(list(enumerate(values)), f"i int, v {dtype}")
        return [r[0] for r in rows.orderBy("i").select(build(F.col("v")).alias("r")).collect()]

    return run
