"""Text-overlap metrics of (candidate, reference) pairs.

Pairs are spread by their id once; tokens are exploded after that, so n-gram counting and the final fold per pair need
no further shuffle and each step is linear in the text length.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from deskloom.functions.lcs import lcs
from deskloom.functions.stem import stem_tokens
from deskloom.functions.text import bind, latin_words, ngrams, words

EPSILON = 0.1
BLEU_ORDERS = 4
# idf of a term that occurs in one text of a two-text collection (a term in both has idf 1).
LONE_IDF = math.log(3 / 2) + 1


def f_measure(overlap: Column, candidate: Column, reference: Column) -> Column:
    """2PR/(P+R) from counts; 0 without overlap."""
    return F.coalesce(F.try_divide(2.0 * overlap, (candidate + reference).cast("double")), F.lit(0.0))


def _grams(kind: str, tokens: Column, orders, side: str) -> list[Column]:
    mine, other = (1, 0) if side == "candidate" else (0, 1)

    def entry(name: str):
        return lambda g: F.struct(F.lit(name).alias("kind"), g.alias("gram"), F.lit(mine).alias("c"),
                                  F.lit(other).alias("r"))

    return [F.transform(ngrams(tokens, n, n), entry(f"{kind}{n}")) for n in orders]


def _counted(pairs: DataFrame, token_sets, carry=()) -> DataFrame:
    """(pair_id, kind, gram, c, r, carry..): occurrences of each n-gram on both sides."""
    tokens = F.struct(*[t.alias(f"{kind}_{side}") for kind, a, b, _ in token_sets
                        for side, t in (("candidate", a), ("reference", b))])

    def all_grams(t: Column) -> Column:
        return F.concat(*[g for kind, _, _, orders in token_sets for side in ("candidate", "reference")
                          for g in _grams(kind, t[f"{kind}_{side}"], orders, side)])

    # With a number, the partitions stay apart: small texts grow many times when they are cut into n-grams.
    spread = pairs.repartition(int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions")), "pair_id")
    # explode_outer keeps a row for pairs without any token.
    rows = spread.select("pair_id", *carry, F.explode_outer(bind(tokens, all_grams)).alias("_g")).select(
        "pair_id", *carry, "_g.*")
    return rows.groupBy("pair_id", *carry, "kind", "gram").agg(F.sum("c").alias("c"), F.sum("r").alias("r"))


def _totals(kind: str) -> list[Column]:
    mine = F.col("kind") == kind

    def total(value: Column, name: str) -> Column:
        return F.coalesce(F.sum(F.when(mine, value)), F.lit(0)).alias(f"{kind}_{name}")

    return [total(F.least("c", "r"), "hit"), total(F.col("c"), "cand"), total(F.col("r"), "ref")]


def rouge_from(kind: str) -> Column:
    return f_measure(F.col(f"{kind}_hit"), F.col(f"{kind}_cand"), F.col(f"{kind}_ref"))


def bleu_from(kind: str = "w") -> Column:
    """Geometric mean of clipped precisions, zero counts replaced by 0.1, times the brevity penalty."""
    logs = []
    for n in range(1, BLEU_ORDERS + 1):
        hit, total = F.col(f"{kind}{n}_hit"), F.greatest(F.col(f"{kind}{n}_cand"), F.lit(1))
        logs.append(F.log(F.when(hit > 0, hit.cast("double")).otherwise(EPSILON) / total))
    mean_log = sum(logs[1:], logs[0]) / BLEU_ORDERS
    cand, ref = F.col(f"{kind}1_cand"), F.col(f"{kind}1_ref")
    brevity = F.when(cand > ref, 1.0).otherwise(F.exp(1.0 - ref / F.greatest(cand, F.lit(1))))
    return F.when((F.col(f"{kind}1_hit") == 0) | (cand == 0), 0.0).otherwise(brevity * F.exp(mean_log))


def _cosine_sums(kind: str) -> list[Column]:
    mine = F.col("kind") == kind
    both = (F.col("c") > 0) & (F.col("r") > 0)
    idf = F.when(both, 1.0).otherwise(LONE_IDF)

    def total(value: Column, name: str) -> Column:
        return F.coalesce(F.sum(F.when(mine, value)), F.lit(0.0)).alias(name)

    return [total((F.col("c") * F.col("r")).cast("double"), "_dot"),
            total(F.pow(F.col("c") * idf, 2), "_cc"), total(F.pow(F.col("r") * idf, 2), "_rr")]


def cosine_from_sums() -> Column:
    return F.coalesce(F.try_divide(F.col("_dot"), F.sqrt("_cc") * F.sqrt("_rr")), F.lit(0.0))


def _pairs(df: DataFrame, pair_id: str, candidate: str, reference: str) -> DataFrame:
    return df.select(F.col(pair_id).alias("pair_id"), F.coalesce(candidate, F.lit("")).alias("_cand"),
                     F.coalesce(reference, F.lit("")).alias("_ref"))


def rouge_n(df: DataFrame, pair_id: str, candidate: str, reference: str, stem: bool = True) -> DataFrame:
    """(pair_id, rouge1, rouge2): clipped n-gram F measures."""
    pairs = _pairs(df, pair_id, candidate, reference)
    a, b = latin_words(F.col("_cand")), latin_words(F.col("_ref"))
    pairs = pairs.select("pair_id", (stem_tokens(a) if stem else a).alias("_a"), (stem_tokens(b) if stem else b).alias("_b"))
    counted = _counted(pairs, [("g", F.col("_a"), F.col("_b"), (1, 2))])
    return (counted.groupBy("pair_id").agg(*_totals("g1"), *_totals("g2"))
            .select("pair_id", rouge_from("g1").alias("rouge1"), rouge_from("g2").alias("rouge2")))


def rouge_l(df: DataFrame, pair_id: str, candidate: str, reference: str, stem: bool = True) -> DataFrame:
    """(pair_id, lcs, rougeL): longest-common-subsequence F measure; row-local."""
    pairs = _pairs(df, pair_id, candidate, reference)
    a, b = latin_words(F.col("_cand")), latin_words(F.col("_ref"))
    pairs = pairs.select("pair_id", (stem_tokens(a) if stem else a).alias("_a"), (stem_tokens(b) if stem else b).alias("_b"))
    measured = pairs.select("pair_id", lcs("_a", "_b").alias("lcs"), F.size("_a").alias("_na"), F.size("_b").alias("_nb"))
    return measured.select("pair_id", "lcs", f_measure(F.col("lcs"), F.col("_na"), F.col("_nb")).alias("rougeL"))


def bleu(df: DataFrame, pair_id: str, candidate: str, reference: str) -> DataFrame:
    """(pair_id, bleu4)."""
    pairs = _pairs(df, pair_id, candidate, reference)
    counted = _counted(pairs, [("w", words(F.col("_cand")), words(F.col("_ref")), range(1, BLEU_ORDERS + 1))])
    totals = [t for n in range(1, BLEU_ORDERS + 1) for t in _totals(f"w{n}")]
    return counted.groupBy("pair_id").agg(*totals).select("pair_id", bleu_from("w").alias("bleu4"))


def pair_cosine(df: DataFrame, pair_id: str, candidate: str, reference: str) -> DataFrame:
    """(pair_id, semantic_similarity): TF-IDF cosine where the two texts are the whole collection."""
    pairs = _pairs(df, pair_id, candidate, reference)
    counted = _counted(pairs, [("t", words(F.col("_cand"), 2), words(F.col("_ref"), 2), (1,))])
    return (counted.groupBy("pair_id").agg(*_cosine_sums("t1"))
            .select("pair_id", cosine_from_sums().alias("semantic_similarity")))


def text_similarity(df: DataFrame, pair_id: str, candidate: str, reference: str, stem: bool = True) -> DataFrame:
    """All five overlap metrics per pair with one shuffle."""
    pairs = _pairs(df, pair_id, candidate, reference)
    a, b = latin_words(F.col("_cand")), latin_words(F.col("_ref"))
    pairs = pairs.select("pair_id", "_cand", "_ref", (stem_tokens(a) if stem else a).alias("_a"),
                         (stem_tokens(b) if stem else b).alias("_b"))
    pairs = pairs.withColumn("rougeL", f_measure(lcs("_a", "_b"), F.size("_a"), F.size("_b")))
    counted = _counted(pairs, [
        ("g", F.col("_a"), F.col("_b"), (1, 2)),
        ("w", words(F.col("_cand")), words(F.col("_ref")), range(1, BLEU_ORDERS + 1)),
        ("t", words(F.col("_cand"), 2), words(F.col("_ref"), 2), (1,)),
    ], carry=["rougeL"])
    kinds = ["g1", "g2", *[f"w{n}" for n in range(1, BLEU_ORDERS + 1)]]
    folded = counted.groupBy("pair_id", "rougeL").agg(*[t for k in kinds for t in _totals(k)], *_cosine_sums("t1"))
    return folded.select("pair_id", rouge_from("g1").alias("rouge1"), rouge_from("g2").alias("rouge2"), "rougeL",
                         bleu_from("w").alias("bleu4"), cosine_from_sums().alias("semantic_similarity"))
