"""Side-by-side evaluation of the two baselines and the full pipeline."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from deskloom.functions.scores import RUBRIC
from deskloom.operators.agreement import agreement_report
from deskloom.operators.metrics import (binary_metrics, classification_metrics, confusion_matrix, mean_metrics, tidy, tidy_groups)
from deskloom.operators.overlap import text_similarity
from deskloom.plans.baselines import keyword_baseline, majority_baseline
from deskloom.plans.rubric import rubric_scores
from deskloom.presets import taxonomy

# System names of the report.
SYSTEMS = ["Baseline 0 (Trivial Canned)", "Baseline 1 (Simple Zero-Shot)", "Proposed Agent (Hybrid RAG)"]
ALL = "all"
AGREEMENT = ["sample_size", "cohen_kappa_quadratic", "pearson_correlation_r", "p_value", "spearman_rho",
             "agreement_percentage", "mean_human_score", "mean_judge_score"]
OVERLAP = ["rouge1", "rouge2", "rougeL", "bleu4", "semantic_similarity"]


def proposed_answer() -> Column:
    """The pipeline's answer from the columns of ``plans.triage.decide``."""
    return F.struct(F.col("predicted_intent").alias("class"), F.col("escalation.decision").alias("decision"),
                    F.col("escalation.reason").alias("reason"), F.col("draft_reply").alias("reply"))


def predictions(decided: DataFrame, majority=None, keyword=None) -> DataFrame:
    """One row per (system, case).

    ``decided`` holds golden columns plus the pipeline's; the three systems unfold from one row, so the pipeline runs
    once and feeds every metric.
    """
    answers = [majority if majority is not None else majority_baseline(),
               keyword if keyword is not None else keyword_baseline(F.col("text")), proposed_answer()]
    named = F.array(*[F.struct(F.lit(name).alias("system"), a["class"].alias("class"), a["decision"].alias("decision"),
                               a["reason"].alias("reason"), a["reply"].alias("reply"))
                      for name, a in zip(SYSTEMS, answers)])
    return decided.select("query_id", "text", "truth", "truth_escalated", "reference_reply",
                          F.explode(named).alias("_a")).select(
        "_a.system", "query_id", "text", "truth", F.col("_a.class").alias("predicted"), "truth_escalated",
        (F.col("_a.decision") == taxonomy.ESCALATE).alias("predicted_escalated"),
        F.col("_a.decision").alias("decision"), F.col("_a.reply").alias("reply"), "reference_reply")


def score_replies(predicted: DataFrame, stem: bool = True) -> DataFrame:
    """Overlap and rubric scores per (system, case)."""
    keyed = predicted.withColumn("pair_id", F.concat_ws("\x1f", "system", F.col("query_id").cast("string")))
    overlap = text_similarity(keyed, "pair_id", "reply", "reference_reply", stem)
    rubric = keyed.select("pair_id", "system", "query_id", rubric_scores(F.col("text"), F.col("reply")).alias("_r")) \
        .select("pair_id", "system", "query_id", "_r.*")
    return rubric.join(overlap, "pair_id").drop("pair_id")


def benchmark_report(predicted: DataFrame, stem: bool = True, labels: Sequence[str] = (), leakage: DataFrame | None = None,
                     ratings: DataFrame | None = None) -> DataFrame:
    """(system, metric_group, metric, value). Pass a materialised prediction table: it is read by every metric.

    ``labels`` adds the full pipeline's confusion matrix (metric: true class -> predicted class), ``leakage`` the leak check
    (see ``operators.leakage.leakage_report``) and ``ratings`` the agreement of the rubric with rated replies; the last two
    stand under the system ``ALL``.
    """
    intents = classification_metrics(predicted, "truth", "predicted")
    escalation = binary_metrics(predicted, "truth_escalated", "predicted_escalated")
    scored = mean_metrics(score_replies(predicted, stem), [*OVERLAP, *RUBRIC, "overall_score"], prefix="")
    report = tidy(intents, "intent_metrics", ["accuracy", "macro_f1", "weighted_f1"])
    report = report.unionByName(tidy(escalation, "escalation_metrics", [
        "precision", "recall", "f1_score", "high_risk_miss_rate", "missed_high_risk_count", "total_high_risk_count"]))
    report = report.unionByName(tidy_groups(scored, {"text_generation_metrics": OVERLAP,
                                                     "judge_metrics": [*RUBRIC, "overall_score"]}))
    if labels:
        cells = pipeline_confusion(predicted, labels)
        report = report.unionByName(cells.select("system", F.lit("confusion_matrix").alias("metric_group"), F.concat_ws(
            " -> ", "truth", "predicted").alias("metric"), F.col("n").cast("double").alias("value")))
    if leakage is not None:
        found = leakage.withColumn("system", F.lit(ALL)).withColumn("leakage_detected", F.col("leakage_detected").cast("int"))
        report = report.unionByName(tidy(found, "leakage_verification", [
            "corpus_size", "golden_size", "exact_duplicates", "leakage_percentage", "leakage_detected"]))
    if ratings is not None:
        report = report.unionByName(tidy(rate_and_compare(ratings).withColumn("system", F.lit(ALL)), "judge_agreement", AGREEMENT))
    return report


def pipeline_confusion(predicted: DataFrame, labels: Sequence[str]) -> DataFrame:
    """Confusion matrix of the full pipeline."""
    own = predicted.filter(F.col("system") == SYSTEMS[2])
    return confusion_matrix(own, "truth", "predicted", labels)


def rate_and_compare(ratings: DataFrame) -> DataFrame:
    """Score the rated replies by the rubric and report the agreement with the human scores."""
    judged = ratings.select(F.col("human_scores.overall_mean").alias("human"),
                            rubric_scores(F.col("customer_tweet"), F.col("model_reply"))["overall_score"].alias("judge"))
    return agreement_report(judged, "human", "judge")


def annotation_counts(ratings: DataFrame) -> DataFrame:
    return ratings.groupBy("annotation_method").agg(F.count("*").alias("n"))


def compare_systems(decided: DataFrame, majority=None, keyword=None) -> DataFrame:
    """One row per query: each system's class, decision, reply and rubric scores side by side."""
    query = F.col("text")

    def side(answer: Column, **more: Column) -> Column:
        return F.struct(answer["class"].alias("intent"), answer["decision"].alias("escalation"),
                        answer["reply"].alias("reply"), rubric_scores(query, answer["reply"]).alias("judge_score"),
                        *[c.alias(n) for n, c in more.items()])

    return decided.select(
        "query_id", query.alias("query"),
        side(majority if majority is not None else majority_baseline()).alias("baseline0"),
        side(keyword if keyword is not None else keyword_baseline(query)).alias("baseline1"),
        side(proposed_answer(), intent_confidence=F.col("confidence"),
             escalation_reason=F.col("escalation.description"),
             retrieved_cases=F.col("top_cases")).alias("proposed_agent"))
