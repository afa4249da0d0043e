"""Percentiles from mergeable sketches: one pass over the rows now, merges of small sketches later.

Sketches of a day and group can be stored and merged into those of any longer time, without the rows. A sketch has a
bounded size whatever its rows, so merging one very large group costs no more than another.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SIZE = 400  # in 99 of 100 cases the rank of an estimate is off by at most about 2.3 / SIZE ** 0.9 of the rows, 1 % here


def value_sketches(df: DataFrame, keys: Sequence[str], value: str, size: int = SIZE) -> DataFrame:
    """(keys.., n, sketch) of the values in each group; nulls do not count. Groups without values are left out."""
    held = df.select(*keys, F.col(value).cast("double").alias("_v")).filter("_v IS NOT NULL")
    return held.groupBy(*keys).agg(F.count("*").alias("n"), F.kll_sketch_agg_double("_v", size).alias("sketch"))


def merge_sketches(sketches: DataFrame, keys: Sequence[str], size: int = SIZE) -> DataFrame:
    """(keys.., n, sketch): the sketches of finer groups as one per group of ``keys``."""
    return sketches.groupBy(*keys).agg(F.sum("n").alias("n"), F.kll_merge_agg_double("sketch", size).alias("sketch"))


def sketch_percentiles(sketches: DataFrame, keys: Sequence[str], shares: dict[str, float]) -> DataFrame:
    """(keys.., n, one column per named share of the rows, 0 to 1)."""
    found = [F.kll_sketch_get_quantile_double("sketch", F.lit(float(share))).alias(name) for name, share in shares.items()]
    return sketches.select(*keys, "n", *found)
