"""Joins, top-n and numbering that hold when one key owns a large share of the rows.

All results are exact: the heavy-key list only decides how rows are spread, never which rows are kept.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from deskloom.session import stored

# Rows of one key that a single task may take.
HEAVY_ROWS = 1_000_000
# Distinct values that are ranked in one task, and rows per group that one ranking pass hands on.
VALUES_PER_BUCKET = 100_000
RANKED_ROWS = 1_000


def _names(key: str | Sequence[str]) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def heavy_keys(df: DataFrame, key: str | Sequence[str], rows_per_task: int = HEAVY_ROWS,
               rows: Column | None = None) -> DataFrame:
    """(key.., _salts): every key with more than ``rows_per_task`` rows, and the number of tasks its rows are worth.

    ``rows`` gives the row count of a key where ``df`` holds one row per key already.
    """
    names = _names(key)
    counted = df.select(*names, rows.alias("_rows")) if rows is not None else df.groupBy(*names).agg(F.count("*").alias("_rows"))
    return counted.filter(F.col("_rows") > rows_per_task).select(
        *names, F.ceil(F.col("_rows") / F.lit(rows_per_task)).cast("int").alias("_salts"))


def skew_join(left: DataFrame, right: DataFrame, key: str | Sequence[str], spread: str, how: str = "inner",
              heavy: DataFrame | None = None, min_rows: int = HEAVY_ROWS, left_stored: bool = False,
              left_rows: int | None = None) -> DataFrame:
    """Equi-join on ``key`` where ``left`` may have very hot keys.

    A ``left_stored`` table is counted first (Parquet footers only), or the caller knows ``left_rows``: with at most
    ``min_rows`` rows no key can have more, and the join stays plain. Else ``left`` should be cheap to read twice.

    Rows of heavy keys are spread over sub-keys, one per ``min_rows`` rows, by a hash of the ``spread`` column (repeatable,
    so a re-run task makes the same split) and only the matching ``right`` rows are copied to each sub-key. The list of
    heavy keys (see ``heavy_keys``) is stored once, so both sides see the same one.
    """
    if how not in ("inner", "left", "left_outer", "left_semi", "left_anti"):
        raise ValueError(f"rows of the right side are copied, so a {how} join would repeat unmatched ones")
    names = _names(key)
    if left_stored:
        left_rows = left.count()
    if left_rows is not None and left_rows <= min_rows:
        return left.join(right, names, how)
    marks = stored(heavy_keys(left, names, min_rows) if heavy is None else heavy, "heavy")
    if marks.isEmpty():
        return left.join(right, names, how)
    salt = F.when(F.col("_salts").isNotNull(), F.pmod(F.xxhash64(spread), F.col("_salts")).cast("int")).otherwise(0)
    copies = F.sequence(F.lit(0), F.coalesce(F.col("_salts"), F.lit(1)) - 1)
    salted_left = left.join(marks, names, "left").withColumn("_salt", salt).drop("_salts")
    salted_right = right.join(marks, names, "left").withColumn("_salt", F.explode(copies)).drop("_salts")
    return salted_left.join(salted_right, [*names, "_salt"], how).drop("_salt")


def first_per_key(df: DataFrame, key: str, order: str) -> DataFrame:
    """The row with the smallest ``order`` (unique) per key.

    Only (key, order) is aggregated, map-side combined, so copies of a hot key cost little; rows are then picked by a semi
    join on (key, order), which no key can skew. ``df`` is read twice, the first time for two columns.
    """
    best = df.groupBy(key).agg(F.min(order).alias(order))
    return df.join(best, [key, order], "left_semi").select(*df.columns)


def last_per_key(df: DataFrame, key: str, order: str) -> DataFrame:
    """The row with the largest ``order`` (unique) per key: later rows overwrite earlier ones."""
    best = df.groupBy(key).agg(F.max(order).alias(order))
    return df.join(best, [key, order], "left_semi").select(*df.columns)


def top_n_per_group(df: DataFrame, group: Sequence[str], order: Sequence[Column], n: int, spread: str,
                    rank: str = "rn", salts: int | None = None) -> DataFrame:
    """First ``n`` rows per group in a total order, with their rank. ``order`` must end in a unique column.

    Spark cuts to ``n`` rows per group in every task before the shuffle. Where ``n`` itself is large, that still leaves a
    hot group with too many rows for one sort: it is then ranked inside (group, salt) first, one salt per
    ``RANKED_ROWS`` wanted rows.
    """
    salts = -(-n // RANKED_ROWS) if salts is None else salts
    final = Window.partitionBy(*group).orderBy(*order)
    if salts > 1:
        local = Window.partitionBy(*group, "_salt").orderBy(*order)
        df = (df.withColumn("_salt", F.pmod(F.xxhash64(spread), F.lit(salts)))
              .withColumn(rank, F.row_number().over(local)).filter(F.col(rank) <= n).drop(rank, "_salt"))
    return df.withColumn(rank, F.row_number().over(final)).filter(F.col(rank) <= n)


def bucketed_row_number(df: DataFrame, order: str, bucket: Column, name: str = "position",
                        group: Sequence[str] = ()) -> DataFrame:
    """1-based position in ``order`` (unique), overall or per group, without sorting everything in one task.

    ``bucket`` must not decrease with ``order``. Rows are numbered inside their bucket and shifted by the sizes of the
    buckets before it; only the small bucket-size table is summed up in sequence.
    """
    group = list(group)
    tagged = df.withColumn("_bucket", bucket)
    sizes = tagged.groupBy(*group, "_bucket").agg(F.count("*").alias("_size"))
    before = Window.partitionBy(*group).orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(*group, "_bucket", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_offset"))
    inside = Window.partitionBy(*group, "_bucket").orderBy(order)
    numbered = tagged.withColumn("_inside", F.row_number().over(inside))
    return (numbered.join(offsets, [*group, "_bucket"])
            .withColumn(name, (F.col("_inside") + F.col("_offset")).cast("long"))
            .drop("_bucket", "_inside", "_offset"))


def value_positions(df: DataFrame, value: str, group: Sequence[str] = (), buckets: int | None = None,
                    weight: str | None = None) -> DataFrame:
    """(group.., value, n, below, total): how often each value occurs, how many rows of its group are smaller, and the
    size of the group.

    ``weight`` names a column of row counts if the rows are counted already. Equal values are combined before the
    shuffle and the distinct values stored; they are cut into ranges by approximate quantiles, one per
    ``VALUES_PER_BUCKET`` values. The cut points only balance the work, the counts are exact.
    """
    group = list(group)
    size = F.sum(weight) if weight else F.count("*")
    counts = stored(df.filter(F.col(value).isNotNull()).groupBy(*group, value).agg(size.alias("n")), "values")
    if buckets is None:
        buckets = max(1, -(-counts.count() // VALUES_PER_BUCKET))
    values = f"array<{dict(df.dtypes)[value]}>"
    places = F.array(*[F.lit(i / buckets) for i in range(1, buckets)]).cast("array<double>")
    cut = F.percentile_approx(value, places, max(1000, 4 * buckets)) if buckets > 1 else F.lit(None).cast(values)
    quantiles = counts.agg(F.count("*"), F.coalesce(cut, F.array().cast(values)).alias("fine"))
    # Every 16th cut finds the block, the block's own cuts the bucket: two short scans per value.
    cuts = quantiles.select(F.struct(F.col("fine"), F.filter("fine", lambda c, i: i % 16 == 15).alias("coarse"))).scalar()
    tagged = (counts.withColumn("_cuts", cuts)
              .withColumn("_block", F.size(F.filter("_cuts.coarse", lambda c: c < F.col(value))))
              .withColumn("_cut", F.slice("_cuts.fine", F.col("_block") * 16 + 1, F.lit(16)))
              .withColumn("_bucket", F.col("_block") * 16 + F.size(F.filter("_cut", lambda c: c < F.col(value))))
              .drop("_cuts", "_block", "_cut"))
    sizes = tagged.groupBy(*group, "_bucket").agg(F.sum("n").alias("_size"))
    whole = Window.partitionBy(*group)
    earlier = whole.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(*group, "_bucket", F.coalesce(F.sum("_size").over(earlier), F.lit(0)).alias("_offset"),
                           F.sum("_size").over(whole).alias("total"))
    smaller = Window.partitionBy(*group, "_bucket").orderBy(value).rowsBetween(Window.unboundedPreceding, -1)
    return (tagged.withColumn("_inside", F.coalesce(F.sum("n").over(smaller), F.lit(0)))
            .join(offsets, [*group, "_bucket"])
            .select(*group, value, "n", (F.col("_inside") + F.col("_offset")).alias("below"), "total"))
