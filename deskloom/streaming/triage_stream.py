"""Row-local operators on message streams.

Cleaning, rule labels and the escalation cascade are column expressions, so the same code serves batch and stream.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from deskloom.functions.rules import RuleSet, label_class
from deskloom.functions.text import clean_text, key_digest, text_key
from deskloom.plans.policy import escalate


def triage_rows(messages: DataFrame, rules: RuleSet, default_class: str, confidence: float = 0.65,
                steps=None) -> DataFrame:
    """Messages with ``text`` cleaned, plus ``class`` and ``decision``; works on batches and streams."""
    cleaned = messages.withColumn("text", clean_text(F.col("text")))
    return (cleaned.withColumn("class", label_class(F.col("text"), rules, default_class)["class"])
            .withColumn("decision", escalate(F.col("text"), F.lit(confidence), steps=steps)["decision"]))


def drop_repeats(messages: DataFrame, ts: str = "ts", delay: str = "1 hour") -> DataFrame:
    """Drop messages whose text key was seen within the watermark delay; state stays bounded by the delay."""
    keyed = messages.withColumn("_key", key_digest(text_key(F.col("text"))))
    return keyed.withWatermark(ts, delay).dropDuplicatesWithinWatermark(["_key"]).drop("_key")


def windowed_counts(triaged: DataFrame, ts: str = "ts", window: str = "1 hour", delay: str = "1 hour") -> DataFrame:
    """Messages per tumbling window, class and decision."""
    source = triaged.withWatermark(ts, delay) if triaged.isStreaming else triaged
    return (source.groupBy(F.window(ts, window).alias("_w"), "class", "decision").agg(F.count("*").alias("n"))
            .select(F.col("_w.start").alias("window_start"), "class", "decision", "n"))
