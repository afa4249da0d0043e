import pytest
from pyspark.sql import functions as F

from deskloom.plans.baselines import keyword_baseline, majority_baseline
from deskloom.plans.policy import escalate
from deskloom.plans.replies import draft_reply
from deskloom.plans.rubric import feedback, rubric_scores


@pytest.mark.parametrize("text, confidence, decision, reason, risk", [
    ("battery swelling and smoking", 0.95, "ESCALATE_TO_HUMAN", "HARDWARE_PHYSICAL_DAMAGE", "CRITICAL"),
    ("after the iOS 17 update my phone started smoking", 0.9, "ESCALATE_TO_HUMAN", "HARDWARE_PHYSICAL_DAMAGE", "CRITICAL"),
    ("WatchOS 10 ruined my battery life and it swells up", 0.85, "ESCALATE_TO_HUMAN", "HARDWARE_PHYSICAL_DAMAGE", "CRITICAL"),
    ("Wi-Fi button on my iPhone is greyed out and", 0.8, "ESCALATE_TO_HUMAN", "HARDWARE_PHYSICAL_DAMAGE", "CRITICAL"),
    ("this is the worst service, my lawyer", 0.9, "ESCALATE_TO_HUMAN", "HIGH_SENTIMENT_CHURN_RISK", "HIGH"),
    ("you charged twice", 0.9, "ESCALATE_TO_HUMAN", "BILLING_REFUND_AUTH", "MEDIUM"),
    ("I was hacked", 0.9, "ESCALATE_TO_HUMAN", "PII_SECURITY_DM", "MEDIUM"),
    ("Tried that. Didn't work.", 0.9, "ESCALATE_TO_HUMAN", "LOW_CONFIDENCE_AMBIGUITY", "LOW"),
    ("a plain message", 0.2, "ESCALATE_TO_HUMAN", "LOW_CONFIDENCE_AMBIGUITY", "LOW"),
    ("How do I check my apple care coverage?", 0.9, "AUTO_HANDLE", "STANDARD_TROUBLESHOOTING", "MINIMAL")])
def test_cascade(value, text, confidence, decision, reason, risk):
    got = value(lambda c: escalate(c, F.lit(confidence)), text)
    assert (got["decision"], got["reason"], got["risk"]) == (decision, reason, risk)


def test_past_case_step(spark):
    frame = spark.createDataFrame([(False, "BILLING_REFUND_AUTH"), (False, None), (True, "X"), (None, None), (False, "NEW")],
                                  "auto boolean, why string")
    got = [r[0] for r in frame.select(escalate(F.lit("plain"), F.lit(0.9), F.col("auto"), F.col("why"))).collect()]
    assert [g["reason"] for g in got] == ["BILLING_REFUND_AUTH", "PII_SECURITY_DM", "STANDARD_TROUBLESHOOTING",
                                          "STANDARD_TROUBLESHOOTING", "NEW"]
    assert got[4]["description"] == "Requires specialist human intervention."


def _reply(value, text, decision="AUTO_HANDLE", reason="-", cls="OS_UPDATE_BUG", top=None, similarity=None):
    return value(lambda c: draft_reply(c, F.lit(cls), F.lit(decision), F.lit(reason), F.lit(top).cast("string"),
                                       F.lit(similarity).cast("double")), text)


def test_replies(value):
    assert "iforgot" in _reply(value, "Can you reset my password over Twitter?")
    assert "disconnect the charger" in _reply(value, "x", "ESCALATE_TO_HUMAN", "HARDWARE_PHYSICAL_DAMAGE")
    assert "iforgot" in _reply(value, "x", "ESCALATE_TO_HUMAN", "PII_SECURITY_DM")
    assert _reply(value, "my airpods", top="past", similarity=0.46) == "past"
    assert "reset-airpods" in _reply(value, "my AirPods", top="past", similarity=0.45)
    assert "force restart" in _reply(value, "x") and "feedback" in _reply(value, "x", cls="GENERAL_FEEDBACK_CHURN")


def test_rubric(spark):
    rows = [("hi", "We'd like to help. Have you tried a force restart? Follow: https://apple.co/force-restart."),
            ("my battery is swollen and smoking", "You can leave it plugged in"),
            ("swollen", "Stop using it. As an AI"), ("x", "As an AI, sorry"), ("x", "please tweet your password"),
            ("x", "Thank you. Please restart your device or visit apple.com for assistance.")]
    frame = spark.createDataFrame(rows, "q string, r string").select(rubric_scores(F.col("q"), F.col("r")).alias("s"))
    got = [tuple(r[0]) for r in frame.collect()]
    assert got[0] == (5, 5, 5, 5, 5.0) and got[1][3] == 2 and got[2][3] == 5
    assert got[3] == (2, 2, 2, 4, 2.5) and got[4][3] == 1 and got[5] == (5, 3, 5, 5, 4.5)
    assert frame.select(feedback(F.col("s"))).first()[0] == "Groundedness: 5/5, Voice: 5/5, Actionability: 5/5, Safety: 5/5"


def test_baselines(value):
    got = value(keyword_baseline, "Refund my subscription!")
    assert (got["class"], got["decision"], got["reason"]) == ("BILLING_SUBSCRIPTIONS", "ESCALATE_TO_HUMAN", "PII_SECURITY_DM")
    assert got["reply"].endswith("Please send a DM.") and "billing subscriptions question" in got["reply"]
    assert value(keyword_baseline, "nothing")["class"] == "GENERAL_FEEDBACK_CHURN"
    assert value(lambda c: majority_baseline(), "x")["class"] == "OS_UPDATE_BUG"
