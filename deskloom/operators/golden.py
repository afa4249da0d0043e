"""Held-out evaluation sets and calibration ratings."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from deskloom.functions.rules import RuleSet, difficulty, label_escalation
from deskloom.functions.text import key_digest, numbered_id, shuffle_key, text_key
from deskloom.operators.skew import first_per_key, top_n_per_group
from deskloom.presets.cases import REAL_SAMPLE_NOTE, REAL_SOURCE, SYNTHETIC_SAMPLE_NOTE
from deskloom.session import stored

# Annotator and method of manual and of programmatic ratings.
BY_HAND, BY_RULE = ("author", "manual"), ("calibrated_simulation", "programmatic_rubric")
GOLDEN_COLUMNS = ["id", "customer_tweet", "ground_truth_intent", "reference_reply", "ground_truth_escalation",
                  "escalation_reason", "difficulty", "notes", "source"]


def eligible_rows(corpus: DataFrame, adversarial: DataFrame) -> DataFrame:
    """Corpus rows that repeat no adversarial case (AQE broadcasts the short key list by its measured size)."""
    held = adversarial.select(key_digest(text_key(F.col("customer_tweet"))).alias("_d")).distinct()
    return (corpus.withColumn("_d", key_digest(text_key(F.col("customer_text"))))
            .join(held, "_d", "left_anti").select(*corpus.columns))


def stratum_quota(target: int, n_fixed: int, n_classes: int) -> int:
    """Rows drawn per class: an even share of what is left, plus ten."""
    return max(1, (target - n_fixed) // n_classes) + 10


def balanced_quotas(sizes: dict, classes, wanted: int) -> dict:
    """Rows drawn per class so that no class gets fewer than another unless it is used up: min(size, level) for the level at
    which they sum up to ``wanted``; what the whole level leaves goes to the first classes that have more."""
    counts = {c: sizes.get(c, 0) for c in classes}
    level, extra, left = 0, 0, min(wanted, sum(counts.values()))
    for i, n in enumerate(sorted(counts.values())):
        level, extra = divmod(left, len(counts) - i)
        if level < n or not left:
            break
        left -= n
    quotas = {}
    for c in classes:
        more = counts[c] > level and extra > 0
        quotas[c] = min(counts[c], level) + more
        extra -= more
    return quotas


def stratified_rows(eligible: DataFrame, classes, quota: int, limit: int, seed: int = 42, quotas: dict | None = None) -> DataFrame:
    """Up to ``quota`` rows per class in seeded order, classes filled in taxonomy order until ``limit`` rows.

    ``quotas`` sets a number for each class instead. Adds ``position`` (1-based). At most ``classes * quota`` rows reach the
    final ordering.
    """
    quota = max(quotas.values(), default=0) if quotas else quota
    known = eligible.filter(F.col("intent").isin(list(classes))).withColumn("_order", shuffle_key(F.col("id"), seed))
    drawn = top_n_per_group(known, ["intent"], [F.col("_order"), F.col("id")], quota, spread="id")
    if quotas:
        drawn = drawn.filter(F.col("rn") <= F.create_map(*[F.lit(x) for item in quotas.items() for x in item])[F.col("intent")])
    ordinal = F.create_map(*[F.lit(x) for i, c in enumerate(classes) for x in (c, i)])[F.col("intent")]
    taken = drawn.withColumn("_ordinal", ordinal).orderBy("_ordinal", "rn").limit(limit)
    return (taken.withColumn("position", F.row_number().over(Window.orderBy("_ordinal", "rn")))
            .select(*eligible.columns, "position"))


def leftover_rows(eligible: DataFrame, sampled: DataFrame, n: int) -> DataFrame:
    """The first ``n`` eligible rows in corpus order with a text key not sampled before."""
    digest = key_digest(text_key(F.col("customer_text")))
    fresh = first_per_key(eligible.withColumn("_d", digest), "_d", "seq")
    unused = fresh.join(sampled.select(digest.alias("_d")).distinct(), "_d", "left_anti")
    first = unused.orderBy("seq").limit(n)
    return (first.withColumn("position", F.row_number().over(Window.orderBy("seq")))
            .select(*eligible.columns, "position"))


def golden_sample(corpus: DataFrame, adversarial: DataFrame, classes, escalation_rules: RuleSet,
                  hard_patterns, target: int = 200, seed: int = 42,
                  default_reason: str = "STANDARD_TROUBLESHOOTING",
                  real_source: str = REAL_SOURCE, balanced: bool = False) -> tuple[DataFrame, DataFrame]:
    """(golden rows, sampled corpus rows).

    Adversarial rows come first; the rest is drawn per class, classes in order, so late classes may get little or
    nothing; rows still missing are filled up in corpus order. ``balanced`` shares the rows out evenly instead (see
    ``balanced_quotas``). ``corpus`` needs a unique numeric ``seq``.
    """
    n_fixed = adversarial.count()
    wanted = max(0, target - n_fixed)
    eligible = eligible_rows(corpus, adversarial)
    # One count per class decides at plan time whether the fill-up (a pass over all text keys) is needed.
    sizes = {r["intent"]: r["count"] for r in
             eligible.filter(F.col("intent").isin(list(classes))).groupBy("intent").count().collect()}
    quota = stratum_quota(target, n_fixed, len(classes))
    quotas = balanced_quotas(sizes, classes, wanted) if balanced else None
    sampled = stratified_rows(eligible, classes, quota, wanted, seed, quotas).withColumn("_filled", F.lit(False))
    drawn = sum((quotas or {c: min(n, quota) for c, n in sizes.items()}).values())
    short = wanted - min(wanted, drawn)
    if short > 0:
        filled = leftover_rows(eligible, sampled, short)
        filled = filled.withColumn("position", F.col("position") + (wanted - short)).withColumn("_filled", F.lit(True))
        sampled = sampled.unionByName(filled)
    # At most ``target`` rows, read by the golden set and by the corpus cleaning after it.
    sampled = stored(sampled, "sampled")

    label = label_escalation(F.col("customer_text"), escalation_rules, default_reason)
    cases = sampled.withColumn("_label", label).select(
        numbered_id("gold_", F.col("position") + n_fixed, 3).alias("id"),
        F.col("customer_text").alias("customer_tweet"),
        F.col("intent").alias("ground_truth_intent"),
        F.col("agent_text").alias("reference_reply"),
        F.col("_label.escalate").alias("ground_truth_escalation"),
        F.col("_label.reason").alias("escalation_reason"),
        F.when(F.col("_filled"), "EASY").otherwise(
            difficulty(F.col("customer_text"), F.col("_label.escalate"), hard_patterns)).alias("difficulty"),
        F.when(F.col("_filled") | (F.col("source") == real_source), REAL_SAMPLE_NOTE)
        .otherwise(SYNTHETIC_SAMPLE_NOTE).alias("notes"),
        "source")
    golden = adversarial.select(*GOLDEN_COLUMNS).orderBy("id").limit(target).unionByName(cases.select(*GOLDEN_COLUMNS))
    return golden, sampled.drop("_filled", "position")


def browse(golden: DataFrame, limit: int = 200, intent: str | None = None,
           level: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(one-row total before the limit, first ``limit`` rows by id) after the equality filters."""
    if intent:
        golden = golden.filter(F.col("ground_truth_intent") == intent)
    if level:
        golden = golden.filter(F.col("difficulty") == level)
    return golden.agg(F.count("*").alias("total_count")), golden.orderBy("id").limit(limit)


def tier_ratings(cases: DataFrame, position: str, tiers, manual: int = 20, manual_notes=(), tier_notes=()) -> DataFrame:
    """Calibration ratings: the case at 0-based ``position`` gets quality tier ``i % 3``.

    ``i`` restarts after the ``manual`` first cases, which count as rated by hand; the rest as programmatic.
    ``tiers`` lists (reply text or None for the case's reference reply, four scores).
    """
    by_hand = F.col(position) < manual
    local = F.when(by_hand, F.col(position)).otherwise(F.col(position) - manual)
    tier = F.pmod(local, F.lit(len(tiers))).cast("int")
    replies = [F.col("reference_reply") if text is None else F.lit(text) for text, _ in tiers]
    names = ["groundedness", "brand_voice", "actionability", "safety"]
    scores = [F.get(F.array(*[F.lit(s[k]) for _, s in tiers]), tier) for k in range(4)]
    overall = F.round(sum(scores[1:], scores[0]) / F.lit(4.0), 2)
    filled = [F.replace(F.replace(F.lit(note), F.lit("{cls}"), F.coalesce("ground_truth_intent", F.lit("unknown"))),
                        F.lit("{difficulty}"), F.coalesce("difficulty", F.lit("unknown"))) for note in tier_notes]
    hand_note = F.get(F.array(*map(F.lit, manual_notes)), F.pmod(F.col(position), F.lit(max(1, len(manual_notes)))).cast("int")) \
        if manual_notes else F.lit("")
    tier_note = F.get(F.array(*filled), tier) if filled else F.lit("")
    return cases.select(
        F.col("id").alias("case_id"), "customer_tweet",
        F.get(F.array(*replies), tier).alias("model_reply"),
        F.struct(*[s.alias(n) for n, s in zip(names, scores)], overall.alias("overall_mean")).alias("human_scores"),
        F.when(by_hand, BY_HAND[0]).otherwise(BY_RULE[0]).alias("annotator"),
        F.when(by_hand, BY_HAND[1]).otherwise(BY_RULE[1]).alias("annotation_method"),
        F.when(by_hand, hand_note).otherwise(tier_note).alias("annotator_notes"))


def rating_set(golden: DataFrame, tiers, size: int = 50, **kwargs) -> DataFrame:
    """Ratings of the first ``size`` golden cases by id (a fixed-size calibration set)."""
    first = golden.orderBy("id").limit(size)
    numbered = first.withColumn("_i", F.row_number().over(Window.orderBy("id")) - 1)
    return tier_ratings(numbered, "_i", tiers, **kwargs)
