"""The two baseline systems as column expressions: struct(class, decision, reason, reply)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from deskloom.functions.rules import contains_any, label_keywords
from deskloom.functions.text import bind, class_phrase
from deskloom.presets import replies, rules, taxonomy

AUTO_REASON = "STANDARD_TROUBLESHOOTING"
DM_REASON = "PII_SECURITY_DM"


def _answer(cls: Column, decision: Column, reason: Column, reply: Column) -> Column:
    return F.struct(cls.alias("class"), decision.alias("decision"), reason.alias("reason"), reply.alias("reply"))


def majority_baseline(majority: str | Column = taxonomy.CLASSES[0]) -> Column:
    """One class, never escalates, one canned reply. ``majority`` may be a scalar subquery (see ``majority_class``)."""
    cls = F.lit(majority) if isinstance(majority, str) else majority
    return _answer(cls, F.lit(taxonomy.AUTO_HANDLE), F.lit(AUTO_REASON), F.lit(replies.CANNED_REPLY))


def majority_class(labelled: DataFrame, label: str) -> Column:
    """The most frequent class (first by name on a tie) as a scalar subquery."""
    return labelled.groupBy(label).count().orderBy(F.desc("count"), label).limit(1).select(label).scalar()


def keyword_baseline(text: Column, keywords=None, escalation_words=None, default: str = taxonomy.DEFAULT_CLASS) -> Column:
    """Substring counts per class (first class wins ties), escalation by trigger substrings."""
    def answer(t: Column) -> Column:
        cls, escalated = t["cls"], t["escalated"]
        reply = F.concat(F.lit(replies.KEYWORD_REPLY_HEAD), class_phrase(cls), F.lit(replies.KEYWORD_REPLY_TAIL),
                         F.when(escalated, replies.KEYWORD_REPLY_DM).otherwise(""))
        return _answer(cls, F.when(escalated, taxonomy.ESCALATE).otherwise(taxonomy.AUTO_HANDLE),
                       F.when(escalated, DM_REASON).otherwise(AUTO_REASON), reply)

    cls = label_keywords(text, keywords or rules.BASELINE_KEYWORDS, default)["class"]
    escalated = contains_any(F.lower(text), escalation_words or rules.BASELINE_ESCALATION_WORDS)
    return bind(F.struct(cls.alias("cls"), escalated.alias("escalated")), answer)
