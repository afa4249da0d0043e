"""Corpus building: pairing, cleaning, deduplication, class cap, labels, ids."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from deskloom.functions.rules import RuleSet, label_class, label_escalation
from deskloom.functions.text import numbered_id
from deskloom.operators.golden import golden_sample, rating_set
from deskloom.operators.leakage import leakage_report, without_leaks
from deskloom.operators.pairing import brand_replies, support_pairs
from deskloom.presets import cases, replies, rules, taxonomy
from deskloom.session import stored
from deskloom.sources.files import write_csv, write_json
from deskloom.sources.literals import adversarial_cases
from deskloom.sources.synthetic import CORPUS_COLUMNS, top_up_pairs


def label_pairs(pairs: DataFrame, label_rules: RuleSet, escalation_rules: RuleSet, default_class: str,
                default_reason: str = "STANDARD_TROUBLESHOOTING") -> DataFrame:
    """Pairs (with ``position``, ``source`` and ``synth_id``) to corpus rows labelled by rules."""
    labelled = (pairs.withColumn("_class", label_class(F.col("customer_text"), label_rules, default_class)["class"])
                .withColumn("_esc", label_escalation(F.col("customer_text"), escalation_rules, default_reason)))
    own_id = F.when(F.col("source") == cases.REAL_SOURCE, numbered_id("real_", F.col("position")))
    return labelled.select(
        F.coalesce(own_id, F.col("synth_id")).alias("id"), "customer_text", F.col("_class").alias("intent"),
        "agent_text", (~F.col("_esc.escalate")).alias("auto_handle"),
        F.col("_esc.reason").alias("escalation_reason"), "source")


def build_corpus(messages: DataFrame, max_pairs: int = 1500, brand_author: str = taxonomy.BRAND_AUTHOR,
                 signal_pattern: str = rules.BRAND_SIGNALS, label_rules: RuleSet = rules.LABEL_RULES,
                 escalation_rules: RuleSet = rules.LABEL_ESCALATION_RULES,
                 default_class: str = taxonomy.DEFAULT_CLASS, top_up: bool = True) -> DataFrame:
    """Messages (with unique ``seq`` = file order) to labelled corpus rows."""
    pairs = support_pairs(messages, brand_replies(messages, brand_author, signal_pattern), label_rules,
                          default_class, max_pairs).withColumn("source", F.lit(cases.REAL_SOURCE))
    pairs = top_up_pairs(pairs, max_pairs) if top_up else pairs.withColumn("synth_id", F.lit(None).cast("string"))
    return label_pairs(pairs, label_rules, escalation_rules, default_class)


def corpus_sequence(corpus: DataFrame) -> DataFrame:
    """Numeric corpus order from the digits of the id; generated rows come after real ones."""
    number = F.regexp_extract("id", r"(\d+)\z", 1).cast("long")
    return corpus.withColumn("seq", number + F.when(F.startswith("id", F.lit("real_")), 0).otherwise(1 << 40))


def initialise_data(spark: SparkSession, messages: DataFrame, folder: str, max_pairs: int = 1700, target: int = 200,
                    **kwargs) -> DataFrame:
    """Build and write corpus, golden set (JSON and CSV), ratings and leakage report below ``folder``.

    The corpus is stored once and feeds every step. Returns the leakage report.
    """
    corpus = stored(corpus_sequence(build_corpus(messages, max_pairs, **kwargs)))
    golden, sampled = golden_sample(corpus, adversarial_cases(spark), taxonomy.CLASSES, rules.LABEL_ESCALATION_RULES,
                                    rules.HARD_CASE_PATTERNS, target)
    golden, sampled = stored(golden), stored(sampled)
    clean = without_leaks(corpus, golden, sampled).select(*CORPUS_COLUMNS)
    write_json(clean, f"{folder}/corpus")
    write_json(golden, f"{folder}/golden")
    write_csv(golden, f"{folder}/golden_csv")
    ratings = rating_set(golden, replies.RATING_TIERS, manual_notes=replies.MANUAL_NOTES, tier_notes=replies.TIER_NOTES)
    write_json(ratings, f"{folder}/ratings")
    report = leakage_report(clean, golden)
    write_json(report, f"{folder}/leakage")
    return report
