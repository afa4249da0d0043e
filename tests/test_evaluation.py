import math
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from deskloom.functions.lcs import lcs_length
from deskloom.functions.pvalue import regularised_beta
from deskloom.functions.stem import stem
from deskloom.operators import agreement as A
from deskloom.operators import metrics as M
from deskloom.operators import overlap as O
from deskloom.presets import taxonomy

RATED = [(2.5, 2.0, 2), (2.5, 2.5, 14), (3.75, 3.75, 17), (5.0, 2.5, 1), (5.0, 3.0, 10), (5.0, 3.25, 2), (5.0, 3.5, 1),
         (5.0, 3.75, 2), (5.0, 4.0, 1)]
CONFUSION = [[35, 2, 0, 0, 1, 0, 0], [1, 31, 0, 3, 2, 1, 1], [1, 0, 34, 1, 2, 0, 1], [0, 0, 2, 32, 1, 2, 1],
             [0, 1, 2, 0, 33, 1, 1], [0, 0, 0, 0, 0, 5, 0], [1, 0, 0, 0, 0, 1, 1]]


def test_published_agreement(spark):
    rows = [(a, b) for a, b, n in RATED for _ in range(n)]
    got = A.agreement_report(spark.createDataFrame(rows, "h double, j double"), "h", "j").first()
    assert got["sample_size"] == 50 and got["agreement_percentage"] == 66.0
    assert got["cohen_kappa_quadratic"] == pytest.approx(0.542729, abs=1e-6)
    assert got["pearson_correlation_r"] == pytest.approx(0.502554, abs=1e-6)
    assert got["spearman_rho"] == pytest.approx(0.500369, abs=1e-6)
    assert got["p_value"] == pytest.approx(1.999e-4, abs=1e-7)
    assert (got["mean_human_score"], got["mean_judge_score"]) == (3.775, 3.135)


def test_published_class_metrics(spark):
    rows = [("s", t, p) for t, row in zip(taxonomy.CLASSES, CONFUSION) for p, n in zip(taxonomy.CLASSES, row) for _ in range(n)]
    preds = spark.createDataFrame(rows, "system string, truth string, predicted string")
    got = M.classification_metrics(preds, "truth", "predicted").first()
    assert got["accuracy"] == pytest.approx(0.855) and got["macro_f1"] == pytest.approx(0.756023, abs=1e-6)
    assert got["weighted_f1"] == pytest.approx(0.860422, abs=1e-6)
    cells = {(r["truth"], r["predicted"]): r["n"] for r in M.confusion_matrix(preds, "truth", "predicted", taxonomy.CLASSES).collect()}
    assert [[cells[t, p] for p in taxonomy.CLASSES] for t in taxonomy.CLASSES] == CONFUSION


def test_binary_metrics_without_positives(spark):
    preds = spark.createDataFrame([("s", False, False)], "system string, t boolean, p boolean")
    got = M.binary_metrics(preds, "t", "p").first()
    assert (got["precision"], got["recall"], got["f1_score"], got["high_risk_miss_rate"], got["total_high_risk_count"]) == (0, 0, 0, 0, 0)


def test_percentile(spark):
    rng = random.Random(1)
    data = [rng.choice([1.0, 2.5, rng.random() * 100]) for _ in range(501)]
    frame = spark.createDataFrame([("a" if i % 2 else "b", x) for i, x in enumerate(data)], "g string, x double")
    got = {r["g"]: r["percentile"] for r in M.exact_percentile(frame, "x", 0.95, ["g"]).collect()}
    want = {r["g"]: r["p"] for r in frame.groupBy("g").agg(F.percentile("x", 0.95).alias("p")).collect()}
    assert got == pytest.approx(want)
    overall = M.exact_percentile(frame, "x", 0.5).first()[0]
    assert overall == pytest.approx(sorted(data)[250])


def test_beta_and_p_value():
    assert regularised_beta(0.5, 2.0, 2.0) == pytest.approx(0.5)
    assert regularised_beta(0.3, 1.0, 1.0) == pytest.approx(0.3)
    assert regularised_beta(0.2, 5.0, 0.5) == pytest.approx(1 - regularised_beta(0.8, 0.5, 5.0))


def plain_lcs(a, b):
    table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
    for i, x in enumerate(a):
        for j, y in enumerate(b):
            table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
    return table[-1][-1]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.sampled_from("abcd"), max_size=30), st.lists(st.sampled_from("abcd"), max_size=30))
def test_lcs(a, b):
    assert lcs_length(a, b) == plain_lcs(a, b)


# Known stems of the published algorithm.
@pytest.mark.parametrize("word, want", [
    ("caresses", "caress"), ("ponies", "poni"), ("ties", "tie"), ("cats", "cat"), ("feed", "feed"), ("plastered", "plaster"),
    ("motoring", "motor"), ("sing", "sing"), ("conflated", "conflat"), ("troubled", "troubl"), ("sized", "size"),
    ("hopping", "hop"), ("falling", "fall"), ("filing", "file"), ("happy", "happi"), ("sky", "sky"), ("relational", "relat"),
    ("rational", "ration"), ("digitizer", "digit"), ("operator", "oper"), ("feudalism", "feudal"), ("hopefulness", "hope"),
    ("formality", "formal"), ("triplicate", "triplic"), ("formative", "form"), ("electrical", "electr"), ("goodness", "good"),
    ("revival", "reviv"), ("allowance", "allow"), ("inference", "infer"), ("adjustable", "adjust"), ("replacement", "replac"),
    ("adoption", "adopt"), ("communism", "commun"), ("effective", "effect"), ("probate", "probat"), ("rate", "rate"),
    ("cease", "ceas"), ("controll", "control"), ("roll", "roll"), ("dying", "die"), ("news", "new"[:3] + "s")])
def test_stems(word, want):
    assert stem(word) == want


def reference_bleu(cand, ref):
    if not cand or not set(cand) & set(ref):
        return 0.0
    logs = []
    for n in range(1, 5):
        grams = [tuple(cand[i:i + n]) for i in range(len(cand) - n + 1)]
        others = [tuple(ref[i:i + n]) for i in range(len(ref) - n + 1)]
        hit = sum(min(grams.count(g), others.count(g)) for g in set(grams))
        logs.append(math.log((hit or 0.1) / max(1, len(grams))))
    brevity = 1.0 if len(cand) > len(ref) else math.exp(1 - len(ref) / len(cand))
    return brevity * math.exp(sum(logs) / 4)


def test_overlap_against_brute_force(spark):
    rng = random.Random(7)
    words = "help your phone battery please restart restarting phones the a".split()
    rows = [(i, " ".join(rng.choices(words, k=rng.randint(0, 12))), " ".join(rng.choices(words, k=rng.randint(0, 12)))) for i in range(40)]
    rows += [(100, "same text here again", "same text here again"), (101, None, "x")]
    frame = spark.createDataFrame(rows, "id int, c string, r string")
    got = {r["pair_id"]: r for r in O.text_similarity(frame, "id", "c", "r").collect()}
    for i, c, r in rows:
        a, b = (c or "").split(), r.split()
        assert got[i]["bleu4"] == pytest.approx(reference_bleu(a, b), abs=1e-12)
        sa, sb = [[stem(w) if len(w) > 3 else w for w in s] for s in (a, b)]
        hit = sum(min(sa.count(w), sb.count(w)) for w in set(sa))
        assert got[i]["rouge1"] == pytest.approx(2 * hit / (len(sa) + len(sb)) if sa or sb else 0.0)
        assert got[i]["rougeL"] == pytest.approx(2 * plain_lcs(sa, sb) / (len(sa) + len(sb)) if sa or sb else 0.0)
        assert 0.0 <= got[i]["semantic_similarity"] <= 1.0 + 1e-12
    assert [got[100][m] for m in ("rouge1", "rouge2", "rougeL", "bleu4")] == [1.0] * 4
    single = {r["pair_id"]: r["rouge1"] for r in O.rouge_n(frame, "id", "c", "r").collect()}
    assert single == {i: r["rouge1"] for i, r in got.items()}


def test_spearman_and_kappa_against_brute_force(spark):
    rng = random.Random(3)
    rows = [(float(rng.randint(1, 5)), float(rng.randint(1, 4))) for _ in range(200)]
    frame = spark.createDataFrame(rows, "a double, b double")

    def ranks(xs):
        return [sum(y < x for y in xs) + (sum(y == x for y in xs) + 1) / 2 for x in xs]

    ra, rb = ranks([r[0] for r in rows]), ranks([r[1] for r in rows])
    ma, mb = sum(ra) / 200, sum(rb) / 200
    rho = sum((x - ma) * (y - mb) for x, y in zip(ra, rb)) / math.sqrt(sum((x - ma) ** 2 for x in ra) * sum((y - mb) ** 2 for y in rb))
    assert A.spearman(frame, "a", "b").first()[0] == pytest.approx(rho)
    kappa = A.quadratic_kappa(frame, "a", "b").first()[0]
    assert -1 <= kappa <= 1
    same = frame.withColumn("b", F.col("a"))
    assert A.quadratic_kappa(same, "a", "b").first()[0] == 1.0
