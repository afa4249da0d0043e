"""Session settings the operators rely on."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
}


def local_session(cores: str = "8", memory: str = "8g", shuffle_partitions: int = 8) -> SparkSession:
    """A single-JVM session for tests and benchmarks."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("deskloom")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    )
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared checkpoint folder; a temporary one only in local mode, where none may be configured."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if not configured and not sc.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    sc.setCheckpointDir(configured or tempfile.mkdtemp(prefix="deskloom-"))
    return sc.getCheckpointDir()


_SCOPES: list[list[str]] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    path = f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    for scope in _SCOPES:
        scope.append(path)
    return path


@contextmanager
def recorded_tables() -> Iterator[list[str]]:
    """A scope that lists the scratch paths given out in it."""
    paths: list[str] = []
    _SCOPES.append(paths)
    try:
        yield paths
    finally:
        _SCOPES[:] = [scope for scope in _SCOPES if scope is not paths]


def remove_tables(spark: SparkSession, paths: list[str]) -> None:
    for path in paths:
        table = spark._jvm.org.apache.hadoop.fs.Path(path)
        table.getFileSystem(spark._jsc.hadoopConfiguration()).delete(table, True)


@contextmanager
def scratch_tables(spark: SparkSession) -> Iterator[None]:
    """A scope that removes the tables stored in it at its end; write or collect results before that."""
    with recorded_tables() as paths:
        try:
            yield
        finally:
            remove_tables(spark, paths)


BATCH_SETTINGS = ("spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.parquet.columnarReaderBatchSize")


@contextmanager
def row_batches(spark: SparkSession, rows: str) -> Iterator[None]:
    """A scope in which Parquet is read, and Arrow batches are made, by at most ``rows`` rows: for tables of very large rows. What is
    made in it is stored in it."""
    before = {name: spark.conf.get(name) for name in BATCH_SETTINGS}
    for name in BATCH_SETTINGS:
        spark.conf.set(name, rows)
    try:
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def without_shuffle_files(spark: SparkSession) -> Iterator[None]:
    """A scope in which a query's shuffle files go when it ends, not some time after: for tables that are stored in it and not made
    again. Frames that are run twice would shuffle twice."""
    before = spark.conf.get(SHUFFLE_CLEANUP, "false")
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, before)


def stored(df: DataFrame, name: str = "step", compression: str | None = None) -> DataFrame:
    """Write ``df`` to a Parquet table in the shared folder and read it back.

    Cuts the lineage, survives the loss of executors, and gives later joins true sizes and pruned columns.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)
