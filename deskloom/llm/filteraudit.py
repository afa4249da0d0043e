"""Audit of filters that are applied one after the other: what each removes in every order.

A document is the mask of the filters it fails. In an order, it goes at the step of the first filter it fails, so the steps
before hold filters it passes. All orders that begin with such a prefix stand side by side in lexicographic rank, from
the prefix's rank on, (filters left)! of them. So a mask is a few intervals of ranks for each step: its counts are added
where an interval begins and taken off where it ends, and sums along the ranks give every order's totals.
"""

from itertools import permutations
from math import factorial

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from deskloom.llm.words import WORD

FILTERS = "ABCDE"
CAPITALS = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
MEASURES = ("n", "good", "toxic")


def rank(prefix: tuple[int, ...], filters: int) -> int:
    """Lexicographic rank (Lehmer code) of the first order that begins with ``prefix``."""
    return sum(sum(p not in prefix[:i] and p < f for p in range(filters)) * factorial(filters - 1 - i) for i, f in enumerate(prefix))


def intervals(filters: int) -> list[tuple[int, int, int, int, int]]:
    """(mask, filter, step, first rank, rank behind the last) of every mask's removal; steps from 1, bit f of a mask is filter f."""
    found = []
    for step in range(1, filters + 1):
        for prefix in permutations(range(filters), step):
            start = rank(prefix, filters)
            for mask in range(1 << filters):
                if mask >> prefix[-1] & 1 and not any(mask >> f & 1 for f in prefix[:-1]):
                    found.append((mask, prefix[-1], step, start, start + factorial(filters - step)))
    return found


def orders(filters: int) -> list[tuple[int, int, int, str]]:
    """(rank, step, filter, order as letters) for every step of every order."""
    every = enumerate(permutations(range(filters)))
    return [(r, s + 1, f, "".join(FILTERS[x] for x in p)) for r, p in every for s, f in enumerate(p)]


def failed_filters(text: Column, repeated: Column) -> Column:
    """The mask of filters A to E that a text fails; E is given, the others read the text."""
    words = F.regexp_extract_all(text, F.lit(WORD), F.lit(0))
    return F.transform(F.array(words), lambda w: (
        (F.size(w) < 100).cast("int")
        + (F.size(F.array_distinct(w)) * F.lit(100).cast("long") < F.size(w) * F.lit(80).cast("long")).cast("int") * 2
        + ((F.length(text) - F.length(F.translate(text, CAPITALS, ""))) * F.lit(100).cast("long")
           > F.length(text) * F.lit(10).cast("long")).cast("int") * 4
        + F.rlike(text, F.lit("[#$%&*|]")).cast("int") * 8
        + repeated.cast("int") * 16))[0]


def masks(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, mask, n, good, toxic): documents per lang and mask of failed filters; good and toxic count the labelled ones.

    Texts meet as digests. A document repeats a text if one with a smaller id has the same; a null id is neither smaller nor
    larger than any. Rows that repeat an id are documents of their own; several labels of an id count as the highest.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(F.col("doc_id"), F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("part"),
                       F.sha2(text.cast("binary"), 256).alias("digest"), failed_filters(text, F.lit(False)).alias("own"))
    # Joined by digest and id together: a text that very many documents share is no hot key.
    firsts = rows.groupBy(F.col("digest").alias("text_of")).agg(F.min("doc_id").alias("first")).filter("first IS NOT NULL")
    known = (labels.filter("quality = 1 OR toxic = 1").groupBy(F.col("doc_id").alias("id"))
             .agg(F.max((F.col("quality") == 1).cast("int")).alias("good"), F.max((F.col("toxic") == 1).cast("int")).alias("toxic")))
    later = F.col("first").isNull() & F.col("doc_id").isNotNull()
    return (rows.join(firsts, (F.col("digest") == F.col("text_of")) & (F.col("doc_id") == F.col("first")), "left").join(known, F.col("doc_id") == F.col("id"), "left")
            .groupBy("part", (F.col("own") + later.cast("int") * 16).alias("mask"))
            .agg(F.count("*").alias("n"), F.sum(F.coalesce("good", F.lit(0))).alias("good"),
                 F.sum(F.coalesce("toxic", F.lit(0))).alias("toxic")))


def step_totals(counts: DataFrame, filters: int = len(FILTERS)) -> DataFrame:
    """Per part, order and step: kept, removed, redundant, unique_fails, good_lost, toxic_lost, shapley.

    ``counts``: (part, mask, n, good, toxic), any number of rows a mask. It may hold any number of parts; an order's totals
    need no more than 2 * 325 interval ends a part.
    """
    spark = counts.sparkSession
    spans = spark.createDataFrame(intervals(filters), "mask int, filter int, step int, start int, stop int")
    steps = spark.createDataFrame(orders(filters), "rank int, step int, filter int, filter_order string")
    per_mask = counts.groupBy("part", "mask").agg(*[F.sum(m).alias(m) for m in MEASURES])
    spread = per_mask.join(F.broadcast(spans), "mask")
    ends = F.explode(F.array(F.struct(F.col("start").alias("rank"), F.lit(1).alias("sign")),
                             F.struct(F.col("stop").alias("rank"), F.lit(-1).alias("sign")))).alias("end")
    changes = (spread.select("part", "filter", "step", ends, *MEASURES)
               .groupBy("part", "filter", "step", F.col("end.rank").alias("rank"))
               .agg(*[F.sum(F.col(m) * F.col("end.sign")).alias(m) for m in MEASURES]))
    # Every part has all ranks, so that the sums reach each of them.
    parts = per_mask.groupBy("part").agg(F.sum("n").alias("total"), *[
        x for f in range(filters) for x in (
            F.sum(F.when(F.col("mask").bitwiseAND(1 << f) != 0, F.col("n")).otherwise(0)).alias(f"fails_{f}"),
            F.sum(F.when(F.col("mask") == 1 << f, F.col("n")).otherwise(0)).alias(f"alone_{f}"))])
    places = parts.select("part", F.explode(F.array(*[F.lit(f) for f in range(filters)])).alias("filter"),
                          ).select("part", "filter", F.explode(F.sequence(F.lit(1), F.lit(filters))).alias("step")).select(
        "part", "filter", "step", F.explode(F.sequence(F.lit(0), F.lit(factorial(filters) - 1))).alias("rank"))
    along = Window.partitionBy("part", "filter", "step").orderBy("rank").rowsBetween(Window.unboundedPreceding, 0)
    sums = (places.join(changes, ["part", "filter", "step", "rank"], "left")
            .select("part", "filter", "step", "rank", *[F.sum(F.coalesce(m, F.lit(0))).over(along).alias(m) for m in MEASURES])
            .join(F.broadcast(steps), ["rank", "step", "filter"]))
    order = Window.partitionBy("part", "rank").orderBy("step").rowsBetween(Window.unboundedPreceding, 0)
    of_filter = Window.partitionBy("part", "filter")
    pick = lambda name: F.element_at(F.array(*[F.col(f"{name}_{f}") for f in range(filters)]), F.col("filter") + 1)
    return (sums.join(parts, "part")
            .select("part", "filter_order", "step", (F.col("total") - F.sum("n").over(order)).alias("kept"), F.col("n").alias("removed"),
                    (pick("fails") - F.col("n")).alias("redundant"), pick("alone").alias("unique_fails"),
                    F.col("good").alias("good_lost"), F.col("toxic").alias("toxic_lost"), F.sum("n").over(of_filter).alias("shapley")))


def filter_audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The totals of filters A to E in all 120 orders, a row per lang (null: the empty text), order and step.

    A null text counts as empty: it fails A, and E if a smaller id has an empty text, too. Without documents there are no
    parts and no rows; without labels good_lost and toxic_lost are 0. Other columns play no part.
    """
    return step_totals(masks(docs, labels))
