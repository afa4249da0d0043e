"""Files whose records can span lines or the whole file, read by many tasks.

Spark's own multi-line readers give a file to one task. Here a file is read as pieces between separators, which byte ranges
share among tasks. Whether a piece begins inside a quoted string, and how deep in brackets, follows from what all pieces
before it do to that state. Each range sums that up for itself, the sums are carried on along the ranges (a few rows a
file), and then every piece knows its state and its record. Records are put together from their pieces and parsed one by
one by Spark's own functions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

RANGE = ["_file", "_range"]


def pieces(spark: SparkSession, path: str, separator: str) -> DataFrame:
    """(_file, _range, _at, value): the pieces of the files; a range is where a split starts, _at rises inside it."""
    lines = spark.read.option("lineSep", separator).text(path)
    return lines.select("value", F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_range"),
                        F.monotonically_increasing_id().alias("_at"))


def _along() -> Window:
    return Window.partitionBy(*RANGE).orderBy("_at").rowsBetween(Window.unboundedPreceding, 0)


def _before() -> Window:
    return Window.partitionBy("_file").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)


def _odd(count: Column) -> Column:
    return F.pmod(count, F.lit(2)).cast("int")


def _so_far(column: str | Column) -> Column:
    """What the ranges before one add up to."""
    return F.coalesce(F.sum(column).over(_before()), F.lit(0))


def csv_records(spark: SparkSession, path: str) -> DataFrame:
    """(_file, _record, value): the records of CSV files in order, from 0 (the header), line breaks in quoted fields kept.

    A line break ends a record where an even number of quotes stands before it, so a quote in an unquoted field has to be
    written as the standard wants it, in a quoted one. Empty lines are no records.
    """
    lines = pieces(spark, path, "\n")
    quotes = F.length("value") - F.length(F.translate("value", '"', ""))
    counted = lines.withColumn("_upto", F.sum(quotes).over(_along())).withColumn("_from", F.col("_upto") - quotes)
    # Lines that start a record if the range starts outside quotes, and if it starts inside.
    outside = F.when(_odd(F.col("_from")) == 0, 1).otherwise(0)
    ranges = counted.groupBy(*RANGE).agg(F.max("_upto").alias("_q"), F.sum(outside).alias("_o"), F.count("*").alias("_n"))
    ranges = ranges.withColumn("_inside", _odd(_so_far("_q")))
    starts = F.when(F.col("_inside") == 0, F.col("_o")).otherwise(F.col("_n") - F.col("_o"))
    ranges = ranges.withColumn("_first", _so_far(starts)).select(*RANGE, "_inside", "_first")
    placed = counted.join(ranges, RANGE).withColumn("_start", F.when(_odd(F.col("_from") + F.col("_inside")) == 0, 1).otherwise(0))
    placed = placed.withColumn("_record", F.col("_first") + F.sum("_start").over(_along()) - 1)
    whole = placed.groupBy("_file", "_record").agg(F.array_sort(F.collect_list(F.struct("_range", "_at", "value"))).alias("_lines"))
    text = F.regexp_replace(F.array_join(F.col("_lines.value"), "\n"), r"\r\z", "")
    return whole.select("_file", "_record", text.alias("value")).filter("value <> ''")


def json_elements(spark: SparkSession, path: str) -> DataFrame:
    """(_file, _element, value): the objects of files that hold one JSON array of objects each, numbered from 0.

    Pieces end at closing braces. A piece that ends outside strings at the depth of the array ends an object.
    """
    cut = pieces(spark, path, "}").withColumn("value", F.concat("value", F.lit("}")))
    strings = F.split(F.regexp_replace("value", r"(?s)\\.", ""), '"')  # by turns outside and inside, or the other way round
    depth = lambda text: F.length(F.regexp_replace(text, r"[^{\[]", "")) - F.length(F.regexp_replace(text, r"[^}\]]", ""))
    every = lambda turn: F.aggregate(F.transform("_s", lambda t, i: F.when(i % 2 == turn, depth(t)).otherwise(0)), F.lit(0),
                                     lambda total, d: total + d)
    counted = (cut.withColumn("_s", strings).withColumn("_quotes", F.size("_s") - 1).withColumn("_d0", every(0)).withColumn("_d1", every(1))
               .drop("_s").withColumn("_upto", F.sum("_quotes").over(_along())).withColumn("_from", F.col("_upto") - F.col("_quotes")))
    even = _odd(F.col("_from")) == 0
    counted = counted.withColumn("_out", F.when(even, F.col("_d0")).otherwise(F.col("_d1"))).withColumn(
        "_in", F.when(even, F.col("_d1")).otherwise(F.col("_d0")))
    ranges = counted.groupBy(*RANGE).agg(F.max("_upto").alias("_q"), F.sum("_out").alias("_o"), F.sum("_in").alias("_i"))
    ranges = ranges.withColumn("_inside", _odd(_so_far("_q")))
    ranges = ranges.withColumn("_deep", _so_far(F.when(F.col("_inside") == 0, F.col("_o")).otherwise(F.col("_i")))).select(*RANGE, "_inside", "_deep")
    change = F.when(F.col("_inside") == 0, F.col("_out")).otherwise(F.col("_in"))
    placed = (counted.join(ranges, RANGE).withColumn("_level", F.col("_deep") + F.sum(change).over(_along()))
              .withColumn("_end", F.when((_odd(F.col("_upto") + F.col("_inside")) == 0) & (F.col("_level") == 1), 1).otherwise(0)))
    ends = placed.groupBy(*RANGE).agg(F.sum("_end").alias("_e")).withColumn("_first", _so_far("_e")).drop("_e")
    numbered = placed.join(ends, RANGE).withColumn("_element", F.col("_first") + F.sum("_end").over(_along()) - F.col("_end"))
    whole = numbered.groupBy("_file", "_element").agg(
        F.array_sort(F.collect_list(F.struct("_range", "_at", "value"))).alias("_pieces"), F.sum("_end").alias("_whole"))
    text = F.regexp_replace(F.array_join(F.col("_pieces.value"), ""), r"^[\s,\[]+", "")
    return whole.filter("_whole = 1").select("_file", "_element", text.alias("value"))
