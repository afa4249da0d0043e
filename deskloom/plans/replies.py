"""Reply choice: escalation text, past reply, keyword text or class text."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from deskloom.functions.rules import contains_any, lookup
from deskloom.presets import replies, taxonomy

SIMILARITY_THRESHOLD = 0.45


def draft_reply(text: Column, cls: Column, decision: Column, reason: Column, top_reply: Column | None = None,
                top_similarity: Column | None = None, threshold: float = SIMILARITY_THRESHOLD,
                escalation_replies=None, keyword_replies=None, class_replies=None) -> Column:
    """The reply text; ``top_*`` belong to the rank-1 past case (similarity including the class bonus)."""
    lower = F.lower(text)
    by_reason = lookup(reason, escalation_replies or replies.ESCALATION_REPLIES, replies.OTHER_ESCALATION_REPLY)
    cascade = F.when(decision == taxonomy.ESCALATE, by_reason)
    if top_reply is not None:
        cascade = cascade.when(top_similarity > threshold, top_reply)
    for phrases, reply in keyword_replies or replies.KEYWORD_REPLIES:
        cascade = cascade.when(contains_any(lower, phrases), F.lit(reply))
    return cascade.otherwise(lookup(cls, class_replies or replies.CLASS_REPLIES, replies.OTHER_CLASS_REPLY))
