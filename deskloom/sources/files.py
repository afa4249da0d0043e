"""Readers and writers for message tables, corpora and reports."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from deskloom import schemas
from deskloom.functions.text import norm_id
from deskloom.sources import ranges

CSV_OPTIONS = {"header": "true", "multiLine": "true", "quote": '"', "escape": '"'}


def spread(df: DataFrame) -> DataFrame:
    """Repartition an input that has fewer splits than the cluster has cores, before costly row-local work.

    Large inputs have more splits than cores and pass through without a shuffle.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if df.rdd.getNumPartitions() < cores else df


def as_bool(col: Column) -> Column:
    """'True'/'true' to true, anything else (null too) to false."""
    return F.coalesce(F.lower(F.trim(col)) == "true", F.lit(False))


def normalise_messages(raw: DataFrame) -> DataFrame:
    """Normalise the id columns, make ``inbound`` boolean and replace null text by ''. Other columns pass through."""
    columns = {c: norm_id(F.col(c)) for c in ("tweet_id", "response_tweet_id", "in_response_to_tweet_id")}
    columns["inbound"] = F.col("inbound") if dict(raw.dtypes)["inbound"] == "boolean" else as_bool(F.col("inbound"))
    columns["text"] = F.coalesce("text", F.lit(""))
    return raw.withColumns(columns)


def scan_messages_csv(spark: SparkSession, path: str) -> DataFrame:
    """Header CSV of messages. Quoted texts may hold line breaks, so one file is one split: land it with
    ``land_messages`` before heavy use."""
    return normalise_messages(spark.read.schema(schemas.MESSAGES_CSV).options(**CSV_OPTIONS).csv(path))


def scan_csv_by_ranges(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Header CSV whose quoted fields may hold line breaks, each file read by as many tasks as it has splits.

    Columns are taken by position; every file has its own header.
    """
    options = {k: v for k, v in CSV_OPTIONS.items() if k != "header"}
    rows = ranges.csv_records(spark, path).filter("_record > 0")
    return rows.select(F.from_csv("value", F.lit(schema), options).alias("r")).select("r.*")


def scan_messages_csv_by_ranges(spark: SparkSession, path: str) -> DataFrame:
    """``scan_messages_csv`` for large files."""
    return normalise_messages(scan_csv_by_ranges(spark, path, schemas.MESSAGES_CSV))


def land_messages(spark: SparkSession, csv_path: str, parquet_path: str, partitions: int | None = None) -> DataFrame:
    """Convert a message CSV to Parquet once (splittable, column-pruned, filter push-down) and read it back."""
    messages = scan_messages_csv_by_ranges(spark, csv_path)
    if partitions:
        messages = messages.repartition(partitions, "tweet_id")
    messages.write.mode("errorifexists").parquet(parquet_path)
    return spark.read.parquet(parquet_path)


def csv_files(spark: SparkSession, folder: str) -> DataFrame:
    """(path, bytes) of all CSV files below the folder; only file metadata is read, not content."""
    return (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
            .option("pathGlobFilter", "*.csv").load(folder)
            .select("path", F.col("length").alias("bytes")))


def choose_csv(spark: SparkSession, folder: str, preferred: str = "twcs.csv") -> str | None:
    """The file whose path names ``preferred``, else the largest CSV; None without any CSV or without the folder."""
    try:
        files = csv_files(spark, folder)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
    best = files.orderBy(F.contains(F.lower("path"), F.lit(preferred)).cast("int").desc(),
                         F.desc("bytes"), F.desc("path")).limit(1).collect()
    return best[0]["path"] if best else None


def scan_json_array(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON files that hold one array (or object) each."""
    return spark.read.schema(schema).option("multiLine", "true").json(path)


def scan_json_array_by_ranges(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Files that hold one JSON array of objects each, every file read by as many tasks as it has splits.

    An object that cannot be parsed gives a row of nulls.
    """
    rows = ranges.json_elements(spark, path)
    return rows.select(F.from_json("value", schema).alias("r")).select("r.*")


def scan_json_lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).json(path)


def write_json(df: DataFrame, path: str) -> None:
    """JSON lines: splittable, written by all tasks."""
    df.write.option("ignoreNullFields", "false").json(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.options(header="true", quote='"', escape='"').csv(path)


def scan_csv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).options(**CSV_OPTIONS).csv(path)
