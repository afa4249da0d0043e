"""Small literal tables: taxonomy, reasons, rules, seed and adversarial cases."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from deskloom import schemas
from deskloom.presets import cases, rules, taxonomy


def taxonomy_table(spark: SparkSession) -> DataFrame:
    rows = [(i, *row) for i, row in enumerate(taxonomy.TAXONOMY)]
    return spark.createDataFrame(rows, schemas.TAXONOMY)


def reason_table(spark: SparkSession) -> DataFrame:
    rows = [(k, v, True) for k, v in taxonomy.ESCALATION_REASONS.items()]
    rows += [(k, v, False) for k, v in taxonomy.AUTO_HANDLE_REASONS.items()]
    return spark.createDataFrame(rows, schemas.REASONS)


def rule_table(spark: SparkSession, **rulesets) -> DataFrame:
    """Rule sets as rows (ruleset, class, ordinal, pattern); the default domain's sets if none are given."""
    rulesets = rulesets or {"label": rules.LABEL_RULES, "boost": rules.BOOST_RULES,
                            "policy": {step[0]: step[3] for step in rules.POLICY_RULES}}
    rows = [(name, c, i, p) for name, ruleset in rulesets.items()
            for i, (c, patterns) in enumerate(ruleset.items()) for p in patterns]
    return spark.createDataFrame(rows, schemas.RULES)


def seed_cases(spark: SparkSession) -> DataFrame:
    rows = [(f"synth_{i:05d}", text, intent, reply, auto, reason, cases.SYNTHETIC_SOURCE)
            for i, (text, intent, reply, auto, reason) in enumerate(cases.SEED_CASES)]
    return spark.createDataFrame(rows, schemas.CORPUS)


def adversarial_cases(spark: SparkSession) -> DataFrame:
    rows = [(*row, cases.ADVERSARIAL_SOURCE) for row in cases.ADVERSARIAL_CASES]
    return spark.createDataFrame(rows, schemas.GOLDEN)
