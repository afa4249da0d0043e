import os
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from deskloom import session


def test_a_cluster_needs_a_shared_folder():
    context = SimpleNamespace(getCheckpointDir=lambda: None, master="spark://host:7077")
    cluster = SimpleNamespace(sparkContext=context, conf=SimpleNamespace(get=lambda key, default=None: default))
    with pytest.raises(ValueError):
        session.shared_dir(cluster)


def test_scope_removes_its_tables(spark):
    outer = session.stored(spark.range(3), "outer")
    before = set(os.listdir(session.shared_dir(spark).removeprefix("file:")))
    with session.scratch_tables(spark):
        inner = session.stored(spark.range(5).withColumn("x", F.lit(1)), "inner")
        assert inner.count() == 5
    assert set(os.listdir(session.shared_dir(spark).removeprefix("file:"))) == before
    assert outer.count() == 3
