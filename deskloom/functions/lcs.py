"""Longest common subsequence of token arrays as an Arrow UDF."""

import sys

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType

# Executors need not have this package: its functions travel with the tasks.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


def lcs_length(a, b) -> int:
    """Bit-parallel LCS: one big-integer step per token of ``b``, so whole long texts stay cheap."""
    if len(a) == 0 or len(b) == 0:
        return 0
    where: dict = {}
    for i, token in enumerate(a):
        where[token] = where.get(token, 0) | (1 << i)
    full = (1 << len(a)) - 1
    free = full
    for token in b:
        match = free & where.get(token, 0)
        free = ((free + match) | (free - match)) & full
    return len(a) - free.bit_count()


@F.pandas_udf(IntegerType())
def lcs(a: pd.Series, b: pd.Series) -> pd.Series:
    empty = ()
    return pd.Series([lcs_length(empty if x is None else x, empty if y is None else y) for x, y in zip(a, b)],
                     dtype="int32")
