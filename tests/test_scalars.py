import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from deskloom.functions import rules as R
from deskloom.functions import scores as S
from deskloom.functions import text as T
from deskloom.presets import rules, taxonomy
from deskloom.queries.scalars import ngram_counts


def test_clean_text(value):
    assert value(T.clean_text, "Check this out https://t.co/abc123 for more info") == "Check this out [URL] for more info"
    assert value(T.clean_text, "@115712 my iPhone is broken") == "@user my iPhone is broken"
    assert value(T.clean_text, None) == "" and value(T.clean_text, "") == ""
    assert value(T.clean_text, " so   hot \n🔥🔥🔥 ") == "so hot 🔥🔥🔥"


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(max_size=40), min_size=1, max_size=20))
def test_clean_text_is_idempotent(spark, texts):
    frame = spark.createDataFrame([(t.encode("utf-8", "ignore").decode(),) for t in texts], "t string")
    once = frame.select(T.clean_text(F.col("t")).alias("t"))
    assert once.filter(T.clean_text(F.col("t")) != F.col("t")).count() == 0


@pytest.mark.parametrize("raw, want", [("698.0", "698"), (None, ""), ("nan", ""), ("", ""), (" 12 ", "12"), ("1.05", "1.05")])
def test_norm_id(value, raw, want):
    assert value(T.norm_id, raw) == want


def test_tokens_and_ngrams(value):
    assert value(T.words, "Élan d'été, x_1!") == ["élan", "d", "été", "x_1"]
    assert value(lambda c: T.words(c, 2), "a bc d ef") == ["bc", "ef"]
    assert value(lambda c: T.ngrams(T.words(c), 1, 3), "a b c") == ["a", "b", "c", "a b", "b c", "a b c"]
    assert value(lambda c: T.ngrams(T.words(c), 2, 3), "a") == []
    assert value(lambda c: T.drop_words(T.words(c), ["the"]), "The cat the dog cat") == ["cat", "dog", "cat"]


def test_handles_keys_and_blanks(value):
    assert value(T.strip_handles, "@Brand_1 hi @you") == "hi"
    assert value(T.text_key, "  ABC ") == "abc"
    assert value(T.not_blank, " \n\t") is False and value(T.not_blank, None) is False


def test_reply_post_filter(value):
    assert value(T.reply_or_null, "short") is None
    assert value(T.reply_or_null, "\"'a long enough reply'\"") == "a long enough reply"


@pytest.mark.parametrize("text, want", [
    ("My iPhone crashes after iOS 17.2 update", "OS_UPDATE_BUG"),
    ("Battery health dropped and phone is overheating", "HARDWARE_BATTERY"),
    ("My Apple ID is locked and I need password reset", "ACCOUNT_ICLOUD_SECURITY"),
    ("I was charged twice for my subscription refund needed", "BILLING_SUBSCRIPTIONS")])
def test_label_class(value, text, want):
    label = value(lambda c: R.label_class(c, rules.LABEL_RULES, taxonomy.DEFAULT_CLASS), text)
    assert label["class"] == want and label["score"] > 0


def test_label_class_default_and_ties(value):
    label = value(lambda c: R.label_class(c, rules.LABEL_RULES, taxonomy.DEFAULT_CLASS), "Hello there")
    assert (label["class"], label["score"]) == ("GENERAL_FEEDBACK_CHURN", 0)
    tie = value(lambda c: R.label_class(c, {"b": ["x"], "a": ["x"]}, "none"), "X")
    assert tie["class"] == "b"


@pytest.mark.parametrize("text, want", [
    ("My battery is swelling up!", (True, "HARDWARE_PHYSICAL_DAMAGE")),
    ("I am calling my lawyer to sue you!", (True, "HIGH_SENTIMENT_CHURN_RISK")),
    ("How do I update my iPhone?", (False, "STANDARD_TROUBLESHOOTING"))])
def test_label_escalation(value, text, want):
    label = value(lambda c: R.label_escalation(c, rules.LABEL_ESCALATION_RULES, "STANDARD_TROUBLESHOOTING"), text)
    assert (label["escalate"], label["reason"]) == want


def test_word_boundaries_are_unicode(value):
    assert value(lambda c: R.matches_any(c, [r"\bport\b"]), "éport") is False
    assert value(lambda c: R.matches_any(c, [r"\bport\b"]), "PORT!") is True


def test_rule_table_join_equals_constant_rules(spark):
    from deskloom.sources.literals import rule_table
    frame = spark.createDataFrame([(1, "update crash battery"), (2, "nothing"), (3, "refund money")], "seq int, t string")
    table = rule_table(spark, label=rules.LABEL_RULES)
    got = {r["seq"]: list(map(tuple, r["hits"])) for r in R.rule_hits(frame, "t", table).collect()}
    classes = list(rules.LABEL_RULES)
    counts = frame.select("seq", R.hit_counts(F.col("t"), rules.LABEL_RULES).alias("n")).collect()
    assert got == {r["seq"]: [(c, n) for c, n in zip(classes, r["n"]) if n] for r in counts} and got[2] == []


@pytest.mark.parametrize("text, want", [
    ('```json\n{"groundedness": 7, "brand_voice": 2, "safety": 0}\n```', (5, 2, 3, 1)),
    ('{}', (3, 3, 3, 3)), ('{"groundedness": "a"}', None), ("no json", None), ('{"safety": null}', None),
    ('{"safety": 4} and {x}', None), ('{"safety": 4} {"safety": 5}', None), ('{"safety": 4} // {}', None), ('{"safety": 4}}', None),
    ('{"safety": 4}"}', None), ('{"safety": 4, "reasoning": "a } \\" {"}', (3, 3, 3, 4)), ('{"a": {"b": {}}, "safety": 4}', (3, 3, 3, 4))])
def test_parse_scores(value, text, want):
    parsed = value(S.parse_scores_json, text)
    assert (None if parsed is None else tuple(parsed[n] for n in S.RUBRIC)) == want


def test_half_even_bins_and_normalise(spark):
    frame = spark.createDataFrame([(2.5,), (3.5,), (4.5,)], "x double")
    assert [r[0] for r in frame.select(S.half_even_bin(F.col("x"))).collect()] == [2, 4, 4]
    zero = spark.range(1).select(S.normalise(F.array(F.lit(0.0), F.lit(0.0))).alias("v")).first()["v"]
    assert zero == [0.5, 0.5]


def test_case_context(spark):
    rows = [("a" * 300, "b")] * 4
    frame = spark.createDataFrame([(rows,), ([],)], "c array<struct<customer_text:string,agent_text:string>>")
    full, none = [r[0] for r in frame.select(T.case_context(F.col("c"))).collect()]
    assert full.count("Historical case") == 3 and "a" * 200 in full and "a" * 201 not in full
    assert none == "No historical cases retrieved."


def test_ngram_counts_move_no_ngrams(spark):
    rows = [(1, "b a b a"), (2, None), (3, " . "), (4, "x y"), (4, "x z"), (None, "n"), (None, "n m")]
    found = ngram_counts(spark.createDataFrame(rows, "doc_id int, text string"))
    assert sorted(map(tuple, found.collect()), key=str) == sorted([
        (1, 9, 6, "a", "b a b"), (4, 6, 5, "x", "z"), (None, 4, 3, "m", "n m")], key=str)
