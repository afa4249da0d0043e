"""Scoring on a coefficient table against numpy, and the fitted solution against its own objective."""

import math
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from deskloom.operators.tfidf import CLASSIFIER_TERMS, fit_tfidf, tfidf
from deskloom.plans.classifier import ClassModel, fit_classifier

TEXTS = ["battery drains fast", "battery swollen and hot", "screen cracked", "screen is black", "refund please",
         "refund the charge please", "battery battery battery", "cracked and refund"]
LABELS = ["A", "A", "B", "B", "D", "D", "A", "B"]
CLASSES = ["A", "B", "C", "D"]
RULES = {c: [f"rule{c}"] for c in CLASSES}


@pytest.fixture(scope="module")
def corpus(spark):
    return spark.createDataFrame([(i, t, c) for i, (t, c) in enumerate(zip(TEXTS, LABELS))], "id long, t string, c string")


def grams(text):
    words = re.findall(r"\w+", (text or "").lower())
    return Counter(" ".join(words[i:i + n]) for n in (1, 2, 3) for i in range(len(words) - n + 1))


def brute(text, table, intercepts):
    """Softmax of intercept + unit-length TF-IDF times coefficients."""
    raw = {t: (1 + math.log(n)) * table[t][0] for t, n in grams(text).items() if t in table}
    length = math.sqrt(sum(w * w for w in raw.values()))
    z = np.array(intercepts, float)
    for term, w in raw.items():
        z = z + w / length * np.array(table[term][1])
    e = np.exp(z - z[np.isfinite(z)].max())
    return e / e.sum()


def shares(model, asked):
    rows = model.classify(asked, "id", "t", RULES, boost=0.0).collect()
    return {r["id"]: [r["probabilities"][c] for c in model.classes] for r in rows}


@pytest.mark.parametrize("broadcast_bytes", [0, 64 << 20])
def test_scores_equal_numpy(spark, corpus, broadcast_bytes):
    terms = fit_tfidf(corpus, "id", "t", CLASSIFIER_TERMS).terms
    known = [r["term"] for r in terms.orderBy("term").collect()]
    listed = [(t, c, math.sin(3 * i + j)) for i, t in enumerate(known) for j, c in enumerate(CLASSES) if (i + j) % 3]
    listed += [("battery", "A", 0.25), ("battery", "A", None), ("battery", "unknown class", 9.0), ("no such term", "A", 9.0)]
    priors = {"A": 0.5, "B": -0.5, "C": float("-inf"), "D": 0.0}
    model = ClassModel.from_coefficients(terms, spark.createDataFrame(listed, "term string, class string, weight double"), priors)
    model.broadcast_bytes = broadcast_bytes
    asked = spark.createDataFrame(
        list(enumerate([*TEXTS, None, "", "zzz", "Battery SCREEN refund", "battery drains fast", "screen " * 30_000])),
        "id long, t string")
    table = {r["term"]: (r["idf"], r["coefs"]) for r in model.terms.collect()}
    got = shares(model, asked)
    assert len(got) == asked.count()
    for row in asked.collect():
        assert got[row["id"]] == pytest.approx(brute(row["t"], table, model.intercepts).tolist(), abs=6e-5)
    exact = {r["id"]: r["logits"] for r in model.logits(asked, "id", "t").collect()}
    for i, text in enumerate(TEXTS):
        e = np.exp(np.array(exact[i]))
        assert e / e.sum() == pytest.approx(brute(text, table, model.intercepts), abs=1e-9)


def test_long_table_round_trip(spark, corpus, tmp_path):
    model = fit_classifier(corpus, "t", "c", CLASSES)
    again = ClassModel.from_coefficients(model.terms.drop("coefs"), model.coefficients(), dict(zip(CLASSES, model.intercepts)))
    asked = corpus.select("id", "t")
    assert shares(again, asked) == shares(model, asked)
    model.save(f"{tmp_path}/m")
    loaded = ClassModel.load(spark, f"{tmp_path}/m")
    assert loaded.classes == CLASSES and shares(loaded, asked) == shares(model, asked)
    with pytest.raises(ValueError):
        ClassModel.load(spark, f"{tmp_path}/m", ["A", "B"])


def test_fit_is_stationary(corpus):
    """At the solution the weighted gradient of the objective is zero and unseen classes get nothing."""
    strength = 2.5
    model = fit_classifier(corpus, "t", "c", CLASSES, c=strength)
    table = {r["term"]: (r["idf"], r["coefs"]) for r in model.terms.collect()}
    got = shares(model, corpus.select("id", "t"))
    assert all(p[2] == 0.0 for p in got.values())
    weights = {}
    for r in tfidf(corpus, "id", "t", CLASSIFIER_TERMS).collect():
        weights.setdefault(r["id"], {})[r["term"]] = r["weight"]
    n, sizes = len(TEXTS), Counter(LABELS)
    slope = {t: np.array(c) / (strength * n) for t, (_, c) in table.items()}
    for i, (text, label) in enumerate(zip(TEXTS, LABELS)):
        goal = np.array([float(c == label) for c in CLASSES])
        error = (brute(text, table, model.intercepts) - goal) * (n / (len(sizes) * sizes[label])) / n
        for term, w in weights[i].items():
            slope[term] = slope[term] + w * error
    assert max(abs(v).max() for v in slope.values()) < 1e-4


def test_one_class_and_none(spark, corpus):
    one = fit_classifier(corpus.filter(F.col("c") == "B"), "t", "c", CLASSES)
    assert set(map(tuple, shares(one, corpus.select("id", "t")).values())) == {(0.0, 1.0, 0.0, 0.0)}
    with pytest.raises(ValueError):
        fit_classifier(corpus, "t", "c", ["X"])


def test_clashing_columns_and_empty(spark, corpus):
    model = fit_classifier(corpus, "t", "c", CLASSES)
    asked = corpus.select("id", "t", F.lit("kept").alias("term"), F.lit(7).alias("df"), F.lit("x").alias("weight"))
    rows = model.classify(asked, "id", "t", RULES).collect()
    assert len(rows) == len(TEXTS) and {(r["term"], r["df"], r["weight"]) for r in rows} == {("kept", 7, "x")}
    assert model.classify(asked.filter("id < 0"), "id", "t", RULES).count() == 0
