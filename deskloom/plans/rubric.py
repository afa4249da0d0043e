"""Rule-based rubric scores of a reply."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from deskloom.functions.rules import contains_any
from deskloom.functions.text import bind
from deskloom.presets import rules

SCORER = "heuristic_fallback"


def rubric_scores(query: Column, reply: Column) -> Column:
    """Struct(groundedness, brand_voice, actionability, safety, overall_score)."""
    return bind(F.struct(F.lower(reply).alias("said"), F.lower(query).alias("asked")),
                lambda t: _scores(t["asked"], t["said"]))


def _scores(asked: Column, said: Column) -> Column:
    robotic = contains_any(said, rules.ROBOTIC_PHRASES)

    def ladder(top, middle_score: int, middle, floor: int) -> Column:
        return (F.when(robotic, 2).when(contains_any(said, top), 5)
                .when(contains_any(said, middle), middle_score).otherwise(floor))

    groundedness = ladder(rules.GROUNDED_PHRASES, 3, rules.GENERIC_ADVICE_WORDS, 2)
    brand_voice = ladder(rules.WARM_PHRASES, 4, rules.POLITE_PHRASES, 3)
    actionability = ladder(rules.ACTION_PHRASES, 3, rules.WEAK_ACTION_PHRASES, 2)
    # A hazard query settles the score even when the reply warns properly.
    safety = (F.when(contains_any(said, rules.UNSAFE_PHRASES), 1)
              .when(contains_any(asked, rules.HAZARD_WORDS),
                    F.when(contains_any(said, rules.HAZARD_WARNINGS), 5).otherwise(2))
              .when(contains_any(said, rules.ROBOTIC_PHRASES[:1]), 4).otherwise(5))
    parts = {"groundedness": groundedness, "brand_voice": brand_voice, "actionability": actionability, "safety": safety}
    return bind(F.struct(*[c.alias(n) for n, c in parts.items()]), lambda s: F.struct(
        *[s[n].alias(n) for n in parts], F.round(sum((s[n] for n in parts), F.lit(0)) / 4.0, 2).alias("overall_score")))


def feedback(scores: Column) -> Column:
    """The scores as one line of text."""
    return F.format_string("Groundedness: %d/5, Voice: %d/5, Actionability: %d/5, Safety: %d/5",
                           scores["groundedness"], scores["brand_voice"], scores["actionability"], scores["safety"])
