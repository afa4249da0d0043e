"""Explicit schemas of the library's inputs and outputs."""

from __future__ import annotations

MESSAGES = ("tweet_id string, author_id string, inbound boolean, created_at string, text string, "
            "response_tweet_id string, in_response_to_tweet_id string")
# As read from CSV: every field as text, converted afterwards.
MESSAGES_CSV = MESSAGES.replace("boolean", "string")
PAIRS = "customer_text string, agent_text string, source string, tweet_id string, agent_tweet_id string"
CORPUS = ("id string, customer_text string, intent string, agent_text string, auto_handle boolean, "
          "escalation_reason string, source string")
GOLDEN = ("id string, customer_tweet string, ground_truth_intent string, reference_reply string, "
          "ground_truth_escalation boolean, escalation_reason string, difficulty string, notes string, source string")
RATINGS = ("case_id string, customer_tweet string, model_reply string, "
           "human_scores struct<groundedness:int,brand_voice:int,actionability:int,safety:int,overall_mean:double>, "
           "annotator string, annotation_method string, annotator_notes string")
LEAKAGE = ("corpus_size long, golden_size long, exact_duplicates long, leakage_percentage double, status string, "
           "leakage_detected boolean, leaked_examples array<string>")
TAXONOMY = "ordinal int, class string, name string, description string, typical_keywords array<string>"
REASONS = "reason string, description string, escalates boolean"
RULES = "ruleset string, class string, ordinal int, pattern string"
