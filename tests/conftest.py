import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from deskloom.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session("8", "8g", 4)
    yield session
    session.stop()


@pytest.fixture
def value(spark):
    """Evaluate one column expression on one text."""
    from pyspark.sql import functions as F

    def evaluate(build, text):
        frame = spark.createDataFrame([(text,)], "t string")
        return frame.select(build(F.col("t")).alias("v")).first()["v"]

    return evaluate
