"""Classification metrics from prediction tables, one row per system.

The predictions are counted once per (system, truth, prediction); everything else is arithmetic on those few rows.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from deskloom.operators.skew import value_positions
from deskloom.session import stored


def ratio(a: Column, b: Column) -> Column:
    """a / b as double; 0 if b is 0."""
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))


def outcome_counts(predictions: DataFrame, truth: str, predicted: str, system: str = "system") -> DataFrame:
    return predictions.groupBy(system, F.col(truth).alias("truth"), F.col(predicted).alias("predicted")).agg(
        F.count("*").alias("n"))


def per_class(counts: DataFrame, system: str = "system") -> DataFrame:
    """(system, class, hits, support, predicted, f1) over the union of true and predicted classes."""
    hit = F.when(F.col("truth") == F.col("predicted"), F.col("n")).otherwise(0)
    as_truth = counts.select(system, F.col("truth").alias("class"), hit.alias("hits"), F.col("n").alias("support"),
                             F.lit(0).alias("predicted"))
    as_guess = counts.select(system, F.col("predicted").alias("class"), F.lit(0).alias("hits"),
                             F.lit(0).alias("support"), F.col("n").alias("predicted"))
    return (as_truth.unionByName(as_guess).groupBy(system, "class")
            .agg(F.sum("hits").alias("hits"), F.sum("support").alias("support"), F.sum("predicted").alias("predicted"))
            .withColumn("f1", ratio(2 * F.col("hits"), F.col("support") + F.col("predicted"))))


def classification_metrics(predictions: DataFrame, truth: str, predicted: str, system: str = "system") -> DataFrame:
    """(system, accuracy, macro_f1, weighted_f1)."""
    classes = per_class(outcome_counts(predictions, truth, predicted, system), system)
    return classes.groupBy(system).agg(
        ratio(F.sum("hits"), F.sum("support")).alias("accuracy"),
        F.avg("f1").alias("macro_f1"),
        ratio(F.sum(F.col("f1") * F.col("support")), F.sum("support")).alias("weighted_f1"))


def binary_metrics(predictions: DataFrame, truth: str, predicted: str, system: str = "system") -> DataFrame:
    """(system, precision, recall, f1_score, high_risk_miss_rate, missed_.., total_..) for boolean columns."""
    t, p = F.col(truth), F.col(predicted)
    counted = predictions.groupBy(system).agg(
        F.count_if(t & p).alias("tp"), F.count_if(~t & p).alias("fp"), F.count_if(t & ~p).alias("fn"))
    tp, fp, fn = F.col("tp"), F.col("fp"), F.col("fn")
    return counted.select(
        system, ratio(tp, tp + fp).alias("precision"), ratio(tp, tp + fn).alias("recall"),
        ratio(2 * tp, 2 * tp + fp + fn).alias("f1_score"), ratio(fn, tp + fn).alias("high_risk_miss_rate"),
        fn.alias("missed_high_risk_count"), (tp + fn).alias("total_high_risk_count"))


def confusion_matrix(predictions: DataFrame, truth: str, predicted: str, labels: Sequence[str],
                     system: str = "system") -> DataFrame:
    """Dense (system, truth, predicted, n) over the ordered labels, zeros kept; other labels are left out."""
    counts = outcome_counts(predictions, truth, predicted, system)
    names = list(labels)
    # One row per system with a count per cell; the cells unfold from it, so the predictions are read once.
    cells = [F.struct(F.lit(t).alias("truth"), F.lit(p).alias("predicted"), F.coalesce(F.sum(F.when(
        (F.col("truth") == t) & (F.col("predicted") == p), F.col("n"))), F.lit(0)).alias("n")) for t in names for p in names]
    wide = counts.filter(F.col("n") > 0).groupBy(system).agg(F.array(*cells).alias("_cells"))
    return wide.select(system, F.explode("_cells").alias("_c")).select(system, "_c.*")


def confusion_table(matrix: DataFrame, labels: Sequence[str], system: str = "system") -> DataFrame:
    """One row per (system, truth) with a column per predicted label."""
    return matrix.groupBy(system, "truth").pivot("predicted", list(labels)).agg(F.sum("n"))


def mean_metrics(scored: DataFrame, columns: Sequence[str], system: str = "system", prefix: str = "mean_") -> DataFrame:
    return scored.groupBy(system).agg(*[F.avg(c).alias(prefix + c) for c in columns])


def exact_percentile(df: DataFrame, value: str, p: float, group: Sequence[str] = (), name: str = "percentile") -> DataFrame:
    """Percentile with linear interpolation per group, exact and without gathering a group in one task.

    Approximate quantiles bracket the two neighbours of position ``p * (n - 1)``: their rank error is a tenth of what the
    bracket spans to either side. Rows below the bracket are only counted, and just the values inside it are placed.
    """
    group, slack, accuracy = list(group), 0.001, 10_000
    known = df.filter(F.col(value).isNotNull()).select(*group, value)
    ends = F.percentile_approx(value, [max(0.0, p - slack), min(1.0, p + slack)], accuracy)
    own = [f"_of_{g}" for g in group]
    bounds = known.groupBy(*group).agg(ends.alias("_ends"), F.count("*").alias("_all")).toDF(*own, "_ends", "_all")
    same = [F.col(g).eqNullSafe(F.col(o)) for g, o in zip(group, own)]
    if group:
        spans = known.join(bounds, same).drop(*own)
    else:
        spans = known.crossJoin(bounds)  # one row of bounds
    wide = F.col("_all") * slack >= 4  # the bracket is some rows wide on either side; a smaller group is placed whole
    low_end = F.when(wide, F.get("_ends", F.lit(0))) if p - slack > 0 else F.lit(None)
    high_end = F.when(wide, F.get("_ends", F.lit(1))) if p + slack < 1 else F.lit(None)
    side = F.when(F.col(value) < low_end, -1).when(F.col(value) > high_end, 1).otherwise(0)
    kept = F.when(side == 0, F.col(value))
    # One row per value inside the bracket, and one for all below it.
    counts = (spans.withColumn("_side", side).filter("_side < 1").withColumn(value, kept)
              .groupBy(*group, "_all", value).agg(F.count("*").alias("_n")))
    counts = stored(counts, "bracket")
    under = counts.filter(F.col(value).isNull()).select(*group, "_n").toDF(*own, "_under")
    inner = value_positions(counts.filter(F.col(value).isNotNull()), value, [*group, "_all"], weight="_n")
    if group:
        placed = inner.join(under, same, "left").drop(*own)
    else:
        placed = inner.withColumn("_under", under.agg(F.sum("_under")).scalar())
    placed = placed.withColumn("below", F.col("below") + F.coalesce("_under", F.lit(0))).withColumn("total", F.col("_all"))
    place = F.lit(p) * (F.col("total") - 1)
    floor, ceil = F.floor(place), F.ceil(place)

    def holds(position: Column) -> Column:
        return (F.col("below") <= position) & (position < F.col("below") + F.col("n"))

    low = F.max(F.when(holds(floor), F.col(value)))
    high = F.max(F.when(holds(ceil), F.col(value)))
    fraction = F.max(place - floor)
    return placed.groupBy(*group).agg((low + (high - low) * fraction).alias(name))


def tidy(df: DataFrame, metric_group: str, columns: Sequence[str], system: str = "system") -> DataFrame:
    """Wide metric columns to rows (system, metric_group, metric, value)."""
    return tidy_groups(df, {metric_group: columns}, system)


def tidy_groups(df: DataFrame, groups: Mapping[str, Sequence[str]], system: str = "system") -> DataFrame:
    """Wide columns of several metric groups to rows (system, metric_group, metric, value), in one pass over ``df``."""
    entries = F.array(*[F.struct(F.lit(group).alias("metric_group"), F.lit(c).alias("metric"),
                                 F.col(c).cast("double").alias("value")) for group, columns in groups.items() for c in columns])
    return df.select(F.col(system).alias("system"), F.explode(entries).alias("_m")).select("system", "_m.*")
