"""Agreement of two raters: correlation, rank correlation, weighted kappa, exact agreement."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from deskloom.functions.pvalue import correlation_p_value
from deskloom.functions.scores import half_even_bin
from deskloom.operators.skew import HEAVY_ROWS, skew_join, value_positions
from deskloom.session import stored


def pearson(df: DataFrame, a: str, b: str) -> DataFrame:
    """(n, pearson_r, t_statistic, p_value)."""
    base = df.filter(F.col(a).isNotNull() & F.col(b).isNotNull()).agg(
        F.count("*").alias("n"), F.corr(a, b).alias("pearson_r"))
    t = F.col("pearson_r") * F.sqrt(F.try_divide(F.col("n") - 2.0, 1.0 - F.col("pearson_r") * F.col("pearson_r")))
    return base.select("n", "pearson_r", t.alias("t_statistic"),
                       correlation_p_value("pearson_r", F.col("n").cast("double")).alias("p_value"))


def average_ranks(df: DataFrame, value: str, weight: str | None = None) -> DataFrame:
    """(value, n, average_rank) per distinct value: ties share the mean of their ranks."""
    return value_positions(df, value, weight=weight).select(
        value, "n", (F.col("below") + (F.col("n") + 1) / 2.0).alias("average_rank"))


def counted_pairs(df: DataFrame, a: str, b: str) -> DataFrame:
    """Stored (_a, _b, _n): how often each pair of ratings occurs; the only pass over the rated rows."""
    both = df.filter(F.col(a).isNotNull() & F.col(b).isNotNull())
    return stored(both.groupBy(F.col(a).alias("_a"), F.col(b).alias("_b")).agg(F.count("*").alias("_n")), "pairs")


def spearman(df: DataFrame, a: str, b: str, heavy_rows: int = HEAVY_ROWS) -> DataFrame:
    """(spearman_rho): Pearson correlation of average ranks."""
    return spearman_of_pairs(counted_pairs(df, a, b), heavy_rows)


def spearman_of_pairs(pairs: DataFrame, heavy_rows: int = HEAVY_ROWS) -> DataFrame:
    rows = pairs.count()
    ranks_a = average_ranks(pairs, "_a", "_n").select("_a", F.col("average_rank").alias("_ra"))
    ranks_b = average_ranks(pairs, "_b", "_n").select("_b", F.col("average_rank").alias("_rb"))
    ranked = skew_join(pairs, ranks_a, "_a", spread="_b", min_rows=heavy_rows, left_rows=rows)
    ranked = skew_join(ranked, ranks_b, "_b", spread="_a", min_rows=heavy_rows, left_rows=rows)
    # The mean rank is (n + 1) / 2 on both sides; centring first keeps the sums small.
    total = pairs.agg(F.sum("_n")).scalar()
    x, y, n = F.col("_ra") - (total + 1) / 2.0, F.col("_rb") - (total + 1) / 2.0, F.col("_n")
    return ranked.agg((F.sum(n * x * y) / F.sqrt(F.sum(n * x * x) * F.sum(n * y * y))).alias("spearman_rho"))


def quadratic_kappa(df: DataFrame, a: str, b: str) -> DataFrame:
    """(kappa): Cohen's kappa with weights (i - j)^2 on the index of the sorted union of observed labels.

    Quadratic weights let the expected disagreement follow from sums and sums of squares: no label x label table.
    """
    return kappa_of_pairs(counted_pairs(df, a, b))


def kappa_of_pairs(pairs: DataFrame) -> DataFrame:
    labels = pairs.select(F.col("_a").alias("_v")).union(pairs.select("_b")).distinct()
    # One row per distinct score bin.
    index = labels.select("_v", F.dense_rank().over(Window.orderBy("_v")).alias("_i"))
    coded = (pairs.join(index.select(F.col("_v").alias("_a"), F.col("_i").alias("_ia")), "_a")
             .join(index.select(F.col("_v").alias("_b"), F.col("_i").alias("_ib")), "_b"))
    n, i, j = F.col("_n").cast("double"), F.col("_ia"), F.col("_ib")
    total = F.sum(n)
    observed = F.sum(n * (i - j) * (i - j))
    expected = F.sum(n * i * i) + F.sum(n * j * j) - 2.0 * F.sum(n * i) * F.sum(n * j) / total
    return coded.agg((1.0 - F.try_divide(observed, expected)).alias("kappa"))


def exact_agreement(a: str, b: str) -> Column:
    """Percentage of rows whose half-even bins are equal (an aggregate)."""
    return F.avg(F.when(half_even_bin(F.col(a)) == half_even_bin(F.col(b)), 100.0).otherwise(0.0))


def agreement_report(df: DataFrame, human: str, judge: str) -> DataFrame:
    """One row: sample_size, cohen_kappa_quadratic, pearson_correlation_r, p_value, spearman_rho,
    agreement_percentage, mean_human_score, mean_judge_score."""
    # Only rows that both have rated count, for every figure.
    pairs = counted_pairs(df, human, judge)
    binned = (pairs.groupBy(half_even_bin(F.col("_a")).alias("_a"), half_even_bin(F.col("_b")).alias("_b"))
              .agg(F.sum("_n").alias("_n")))
    n, x, y = F.col("_n"), F.col("_a"), F.col("_b")
    means = pairs.agg((F.sum(n * x) / F.sum(n)).alias("_x"), (F.sum(n * y) / F.sum(n)).alias("_y"))
    dx, dy = x - means.select("_x").scalar(), y - means.select("_y").scalar()
    equal = F.when(half_even_bin(x) == half_even_bin(y), 100.0).otherwise(0.0)
    head = pairs.agg(
        F.coalesce(F.sum(n), F.lit(0)).alias("sample_size"),
        F.try_divide(F.sum(n * dx * dy), F.sqrt(F.sum(n * dx * dx) * F.sum(n * dy * dy))).alias("pearson_correlation_r"),
        (F.sum(n * equal) / F.sum(n)).alias("agreement_percentage"),
        (F.sum(n * x) / F.sum(n)).alias("mean_human_score"), (F.sum(n * y) / F.sum(n)).alias("mean_judge_score"))
    return head.select(
        "sample_size", kappa_of_pairs(binned).scalar().alias("cohen_kappa_quadratic"),
        "pearson_correlation_r",
        correlation_p_value("pearson_correlation_r", F.col("sample_size").cast("double")).alias("p_value"),
        spearman_of_pairs(pairs).scalar().alias("spearman_rho"),
        "agreement_percentage", "mean_human_score", "mean_judge_score")
