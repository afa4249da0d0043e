"""The whole message pipeline: classify, retrieve, decide, reply."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from deskloom.functions.rules import RuleSet
from deskloom.functions.text import not_blank
from deskloom.operators.retrieval import DEPTH, top_k_cases
from deskloom.operators.tfidf import TfidfConfig
from deskloom.plans.classifier import ClassModel, classify_by_rules
from deskloom.plans.policy import escalate
from deskloom.plans.replies import draft_reply
from deskloom.presets import rules as preset_rules
from deskloom.presets import taxonomy
from deskloom.session import stored

# Metadata of a result.
VERSION = "2.0.0"
REPLY_MODE = "template_fallback"


def split_blank(messages: DataFrame, text: str = "text") -> tuple[DataFrame, DataFrame]:
    """(usable messages, rejected blank ones)."""
    good = not_blank(F.col(text))
    return messages.filter(good), messages.filter(~good)


def decide(messages: DataFrame, corpus: DataFrame, config: TfidfConfig, rules: RuleSet = preset_rules.BOOST_RULES,
           model: ClassModel | None = None, default_class: str = taxonomy.DEFAULT_CLASS, k: int = 3,
           depth: int = DEPTH, steps=None, class_replies=None, names=None,
           index=None) -> DataFrame:
    """Messages (query_id, text) with classification, ``top_cases``, ``escalation`` struct and ``draft_reply``."""
    if model is None:
        classified = classify_by_rules(messages, "text", rules, default_class, names)
    else:
        classified = model.classify(messages, "query_id", "text", rules, names=names)
    classified = stored(classified, "classified")
    hits = top_k_cases(classified, corpus, config, k, class_col="predicted_intent", depth=depth, index=index)
    rows = classified.join(hits, "query_id", "left")
    top = F.get("top_cases", 0)
    rows = rows.withColumn("escalation", escalate(F.col("text"), F.col("confidence"), top["auto_handle"],
                                                  top["escalation_reason"], steps))
    return rows.withColumn("draft_reply", draft_reply(
        F.col("text"), F.col("predicted_intent"), F.col("escalation.decision"), F.col("escalation.reason"),
        top["agent_text"], top["similarity_score"], class_replies=class_replies))


def envelope(decided: DataFrame, brand: str = taxonomy.BRAND_HANDLE) -> DataFrame:
    """One nested result per message."""
    e = F.col("escalation")
    return decided.select(
        "query_id", F.col("text").alias("customer_query"),
        F.struct("predicted_intent", "intent_name", "confidence", "probabilities", "ranked_intents").alias("intent"),
        F.struct(F.coalesce(F.size("top_cases"), F.lit(0)).alias("num_retrieved"), "top_cases").alias("retrieval"),
        F.struct(e["decision"].alias("decision"), e["reason"].alias("reason_code"),
                 e["description"].alias("reason_description"), e["action"].alias("suggested_action"),
                 e["risk"].alias("risk_level")).alias("escalation"),
        "draft_reply",
        F.struct(F.lit(brand).alias("brand"), F.lit(VERSION).alias("pipeline_version"),
                 F.lit(REPLY_MODE).alias("reply_mode")).alias("meta"))


def triage(messages: DataFrame, corpus: DataFrame, config: TfidfConfig, **kwargs) -> DataFrame:
    return envelope(decide(split_blank(messages)[0], corpus, config, **kwargs))
