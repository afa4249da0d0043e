"""Escalation policy: a priority-ordered cascade as one CASE expression."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from deskloom.functions.rules import lookup, matches_any
from deskloom.presets import rules, taxonomy

CONFIDENCE_THRESHOLD = 0.35


def _outcome(decision: str, reason: Column, description: Column, action: str, risk: str) -> Column:
    return F.struct(F.lit(decision).alias("decision"), reason.alias("reason"), description.alias("description"),
                    F.lit(action).alias("action"), F.lit(risk).alias("risk"))


def escalate(text: Column, confidence: Column, top_auto_handle: Column | None = None,
             top_reason: Column | None = None, steps=None, threshold: float = CONFIDENCE_THRESHOLD,
             reasons=None) -> Column:
    """Struct(decision, reason, description, action, risk).

    Text rules in order, then low confidence, then the best past case if it was not handled automatically, else
    automatic handling. ``top_*`` come from the rank-1 case; null means there is none.
    """
    steps = rules.POLICY_RULES if steps is None else steps
    reasons = taxonomy.ESCALATION_REASONS if reasons is None else reasons

    def known(reason: str) -> Column:
        return F.lit(reasons.get(reason, taxonomy.UNKNOWN_REASON_TEXT))

    cascade = None
    for reason, risk, action, patterns in steps:
        hit = matches_any(text, patterns)
        outcome = _outcome(taxonomy.ESCALATE, F.lit(reason), known(reason), action, risk)
        cascade = F.when(hit, outcome) if cascade is None else cascade.when(hit, outcome)

    reason, risk, action = rules.LOW_CONFIDENCE_STEP
    unsure = _outcome(taxonomy.ESCALATE, F.lit(reason), known(reason), action, risk)
    low = confidence < threshold
    cascade = F.when(low, unsure) if cascade is None else cascade.when(low, unsure)

    if top_auto_handle is not None:
        missing, risk, action = rules.PAST_CASE_STEP
        past = F.coalesce(top_reason, F.lit(missing))
        described = lookup(past, reasons, taxonomy.UNKNOWN_REASON_TEXT)
        cascade = cascade.when(F.coalesce(~top_auto_handle, F.lit(False)),
                               _outcome(taxonomy.ESCALATE, past, described, action, risk))

    reason, risk, action = rules.AUTO_HANDLE_STEP
    return cascade.otherwise(_outcome(taxonomy.AUTO_HANDLE, F.lit(reason),
                                      F.lit(taxonomy.AUTO_HANDLE_REASONS[reason]), action, risk))
