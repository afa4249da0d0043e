import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from deskloom import schemas
from deskloom.operators.retrieval import flat_cases, search, top_k_cases
from deskloom.operators.tfidf import TfidfConfig, TfidfIndex, retrieval_terms
from deskloom.plans.benchmark import annotation_counts, rate_and_compare
from deskloom.plans.classifier import ClassModel, apply_scorer, classify_by_rules, fit_classifier
from deskloom.plans.triage import decide, split_blank, triage
from deskloom.presets import rules, taxonomy
from deskloom.sources.synthetic import expand_templates
from deskloom.streaming.triage_stream import drop_repeats

CASES = retrieval_terms(["the", "my", "is"])


def corpus_of(spark, texts):
    return spark.createDataFrame([(f"d{i}", t, "A" if i % 2 else "B", f"reply {i}", True, "STANDARD_TROUBLESHOOTING", "s")
                                  for i, t in enumerate(texts)], schemas.CORPUS)


def brute_force(queries, docs):
    tfs = [Counter(d.split()) for d in docs]
    df = Counter(t for tf in tfs for t in tf)

    def vector(tf):
        raw = {t: (1 + math.log(c)) * (math.log((1 + len(docs)) / (1 + df[t])) + 1) for t, c in tf.items() if t in df}
        length = math.sqrt(sum(w * w for w in raw.values())) or 1.0
        return {t: w / length for t, w in raw.items()}

    vectors = [vector(tf) for tf in tfs]
    out = {}
    for i, q in enumerate(queries):
        qv = vector(Counter(q.split()))
        scores = [(round(sum(w * v.get(t, 0.0) for t, w in qv.items()), 9), j) for j, v in enumerate(vectors)]
        out[i] = [(j, s) for s, j in sorted(((s, j) for s, j in scores if s > 0), key=lambda x: (-x[0], x[1]))]
    return out


@pytest.mark.parametrize("depth", [10 ** 6, 12, 2])
def test_bounded_lists_are_exact(spark, depth):
    """Zipf-like words: one is in nearly every text, a third of the texts are copies."""
    rng = random.Random(depth)
    words = [f"w{i}" for i in range(40)]
    weights = [1 / (i + 1) for i in range(40)]
    docs = [" ".join(rng.choices(words, weights, k=rng.randint(1, 8))) for _ in range(120)] + ["w0 w1"] * 60
    queries = [" ".join(rng.choices(words, weights, k=rng.randint(1, 5))) for _ in range(25)] + ["w0", "w0 w1", "w39"]
    frame = spark.createDataFrame(list(enumerate(docs)), "id int, t string")
    asked = spark.createDataFrame(list(enumerate(queries)), "id int, t string")
    index = TfidfIndex.build(frame, "id", "t", TfidfConfig(), heavy_rows=30)
    found = search(asked, index, "id", "t", 6, depth, heavy_rows=30).collect()
    want = brute_force(queries, docs)
    for i in range(len(queries)):
        got = [(r["doc"], round(r["score"], 7)) for r in sorted((r for r in found if r["query"] == i), key=lambda r: r["rank"])]
        assert got == [(j, round(s, 7)) for j, s in want[i][:6]]


def test_empty_corpus_and_empty_query(spark):
    asked = spark.createDataFrame([("q1", "hello battery", "A"), ("q2", "", "A"), ("q3", None, "A")], "query_id string, text string, c string")
    assert top_k_cases(asked, corpus_of(spark, ["x"]).limit(0), CASES).count() == 0
    hits = {r["query_id"]: r["top_cases"] for r in top_k_cases(
        asked, corpus_of(spark, ["battery low", "screen", "other words", "more words"]), CASES, k=3, class_col="c").collect()}
    assert {q: len(c) for q, c in hits.items()} == {"q1": 3, "q2": 3, "q3": 3}
    assert hits["q1"][0]["id"] == "d0" and hits["q2"][0]["raw_cosine_score"] == 0.0 and hits["q2"][0]["similarity_score"] == 0.15


def test_bonus_reranks_inside_the_pool_only(spark):
    texts = ["battery drains fast", "battery drains", "battery", "battery drains fast today"] + ["battery other"] * 8
    asked = spark.createDataFrame([("q", "battery drains fast", "A")], "query_id string, text string, c string")
    plain = flat_cases(top_k_cases(asked, corpus_of(spark, texts), CASES, k=3)).collect()
    lifted = flat_cases(top_k_cases(asked, corpus_of(spark, texts), CASES, k=3, class_col="c")).collect()
    assert all(r["similarity_score"] >= r["raw_cosine_score"] for r in lifted)
    assert plain[0]["id"] == "d0" and plain[0]["raw_cosine_score"] == 1.0
    assert all(r["similarity_score"] == pytest.approx(r["raw_cosine_score"] + (0.15 if r["intent"] == "A" else 0), abs=1e-4) for r in lifted)


def test_index_is_reusable(spark, tmp_path):
    corpus = corpus_of(spark, ["battery drains", "screen cracked"])
    index = TfidfIndex.build(corpus, "id", "customer_text", CASES)
    index.save(f"{tmp_path}/index")
    again = TfidfIndex.load(spark, f"{tmp_path}/index", CASES)
    asked = spark.createDataFrame([("q", "cracked screen")], "query_id string, text string")
    assert flat_cases(top_k_cases(asked, corpus, CASES, k=1, index=again)).first()["id"] == "d1"


def test_classifier(spark, tmp_path):
    corpus = expand_templates(spark, 400)
    model = fit_classifier(corpus, "customer_text", "intent", taxonomy.CLASSES)
    asked = spark.createDataFrame([
        ("q1", "My iPhone keeps crashing after the iOS 17 update"), ("q2", "battery maximum capacity dropped on my iPhone"),
        ("q3", "I forgot my Apple ID password"), ("q4", "Why was I billed for the subscription, refund please"),
        ("q5", "zzz qqq"), ("q6", "My iPhone keeps crashing after the iOS 17 update")], "id string, t string")
    got = {r["id"]: r for r in model.classify(asked, "id", "t", rules.BOOST_RULES).collect()}
    assert [got[f"q{i}"]["predicted_intent"] for i in range(1, 5)] == taxonomy.CLASSES[:4]
    assert all(got[f"q{i}"]["confidence"] > 0.40 and got[f"q{i}"]["heuristic_match"] for i in range(1, 5))
    assert got["q1"]["probabilities"] == got["q6"]["probabilities"]
    for row in got.values():
        assert sum(row["probabilities"].values()) == pytest.approx(1.0, abs=1e-3)
        scores = [c["score"] for c in row["ranked_intents"]]
        assert scores == sorted(scores, reverse=True) and row["ranked_intents"][0]["class"] == row["predicted_intent"]
        assert row["is_confident"] == (row["confidence"] >= 0.35)
    model.save(f"{tmp_path}/model")
    again = ClassModel.load(spark, f"{tmp_path}/model", taxonomy.CLASSES)
    assert {r["id"]: r["confidence"] for r in again.classify(asked, "id", "t", rules.BOOST_RULES).collect()} == {
        i: r["confidence"] for i, r in got.items()}


def test_rules_only(spark):
    asked = spark.createDataFrame([("nothing here",), ("airdrop fails",)], "t string")
    got = [r for r in classify_by_rules(asked, "t", rules.BOOST_RULES).collect()]
    assert [r["predicted_intent"] for r in got] == ["GENERAL_FEEDBACK_CHURN", "CONNECTIVITY_SETUP"]
    assert got[1]["confidence"] == 0.65 and got[1]["probabilities"]["CONNECTIVITY_SETUP"] == 1.0


def test_triage_envelope(spark):
    corpus = expand_templates(spark, 60)
    messages = spark.createDataFrame([
        ("m1", "My Wi-Fi button is greyed out"), ("m2", "Tried that. Didn't work. Help?"), ("m3", "  \n"),
        ("m4", "I forgot my Apple ID passcode. Can you reset it over Twitter?")], "query_id string, text string")
    got = {r["query_id"]: r for r in triage(messages, corpus, CASES).collect()}
    assert set(got) == {"m1", "m2", "m4"} and split_blank(messages)[1].count() == 1
    assert got["m1"]["escalation"]["decision"] == "ESCALATE_TO_HUMAN" and "DM" in got["m1"]["draft_reply"]
    assert got["m2"]["escalation"]["reason_code"] == "LOW_CONFIDENCE_AMBIGUITY" and "details" in got["m2"]["draft_reply"]
    assert "iforgot" in got["m4"]["draft_reply"] and got["m4"]["retrieval"]["num_retrieved"] == 3
    assert got["m1"]["meta"]["reply_mode"] == "template_fallback"


def test_scorer_hook_and_ratings(spark):
    def scorer(batches):
        for batch in batches:
            yield batch.assign(score=batch["t"].str.len())[["t", "score"]]

    assert apply_scorer(spark.createDataFrame([("abc",)], "t string"), scorer, "t string, score long").first()["score"] == 3
    rows = [("c1", "x", "We understand. https://apple.co/dm", (5, 5, 5, 5, 5.0), "author", "manual", ""),
            ("c2", "x", "As an AI, sorry", (2, 2, 2, 4, 2.5), "sim", "programmatic_rubric", "")]
    ratings = spark.createDataFrame(rows, schemas.RATINGS)
    assert rate_and_compare(ratings).first()["agreement_percentage"] == 100.0
    assert annotation_counts(ratings).count() == 2


def test_stream_drops_repeats(spark, tmp_path):
    rows = spark.createDataFrame([(1, "Same text"), (2, " same TEXT"), (3, "other")], "i int, text string").withColumn(
        "ts", F.timestamp_seconds(F.col("i")))
    rows.write.parquet(f"{tmp_path}/in")
    stream = drop_repeats(spark.readStream.schema(rows.schema).parquet(f"{tmp_path}/in"))
    (stream.writeStream.format("parquet").option("path", f"{tmp_path}/out").option("checkpointLocation", f"{tmp_path}/cp")
     .trigger(availableNow=True).start().awaitTermination())
    assert spark.read.parquet(f"{tmp_path}/out").count() == 2


class GuessesByWord:
    """Stands in for a fitted model: sure of screens, unsure of all else."""

    def classify(self, messages, id_col, text_col, rules, names=None):
        sure = F.contains(F.col(text_col), F.lit("screen"))
        return messages.withColumns({"predicted_intent": F.lit("HARDWARE_BATTERY"), "confidence": F.when(sure, 0.9).otherwise(0.2)})


def test_pipeline_follows_the_model(spark):
    asked = spark.createDataFrame([("q1", "the color of it"), ("q2", "a screen colour")], "query_id string, text string")
    corpus = corpus_of(spark, ["other words", "more words"])
    found = {r["query_id"]: r for r in decide(asked, corpus, CASES, model=GuessesByWord()).collect()}
    assert found["q1"]["escalation"]["reason"] == "LOW_CONFIDENCE_AMBIGUITY"
    assert found["q2"]["escalation"]["reason"] != "LOW_CONFIDENCE_AMBIGUITY"


def test_a_saved_index_keeps_its_limit(spark, tmp_path):
    corpus = corpus_of(spark, ["same words"] * 12)
    TfidfIndex.build(corpus, "id", "customer_text", CASES, keep=3).save(f"{tmp_path}/index")
    again = TfidfIndex.load(spark, f"{tmp_path}/index", CASES)
    asked = spark.createDataFrame([("q", "same words")], "query_id string, text string")
    with pytest.raises(ValueError):
        search(asked, again, "query_id", "text", 10)


def test_scores_are_added_up_inside_blocks(spark, monkeypatch):
    """Many blocks and parts, few queries a round: the frequencies and lengths are those of the whole corpus, and a block hands on
    its best documents only."""
    from deskloom.operators import retrieval, tfidf

    for name, value in (("BLOCK_DOCS", 7), ("PART_TERMS", 16), ("BATCH_DOCS", "3"), ("BATCH_BLOCKS", "2")):
        monkeypatch.setattr(tfidf, name, value)
    monkeypatch.setattr(retrieval, "QUERIES", 4)
    monkeypatch.setattr(retrieval, "BATCH_BLOCKS", "2")
    rng = random.Random(5)
    words = [f"w{i}" for i in range(40)] + ["straße", "中文"]
    docs = [" ".join(rng.choices(words, [1 / (i + 1) for i in range(42)], k=rng.randint(1, 9))) for _ in range(90)] + ["w0 w1"] * 20
    queries = ["w0 w1", "w0", "straße w3", "中文", "w39 w2 w2", "unknown", "w5 w0", "w7 w8 w9"]
    frame = spark.createDataFrame(list(enumerate(docs)), "id int, t string")
    asked = spark.createDataFrame([*enumerate(queries), (None, "w0 w1")], "id int, t string")
    index = TfidfIndex.build(frame, "id", "t", TfidfConfig())
    assert index.blocks.count() > 5 and index.blocks.selectExpr("max(size(ids))").first()[0] <= 7
    found = search(asked, index, "id", "t", 6, depth=2).collect()
    want = brute_force(queries, docs)
    for i in [*range(len(queries)), None]:
        got = [(r["doc"], round(r["score"], 7)) for r in sorted((r for r in found if r["query"] == i), key=lambda r: r["rank"])]
        assert got == [(j, round(s, 7)) for j, s in want[i or 0][:6]]


def test_texts_of_one_id_are_one_document(spark):
    frame = spark.createDataFrame([(1, "a b"), (1, "b c"), (2, "a c d"), (3, "d")], "id int, t string")
    index = TfidfIndex.build(frame, "id", "t", TfidfConfig())
    assert {r["term"]: r["df"] for r in index.model.terms.collect()} == {"a": 2, "b": 1, "c": 2, "d": 2}
    asked = spark.createDataFrame([(7, "b")], "id int, t string")
    idf = {t: math.log(5 / (1 + n)) + 1 for t, n in (("a", 2), ("b", 1), ("c", 2))}
    raw = [idf["a"], (1 + math.log(2)) * idf["b"], idf["c"]]
    score = round(raw[1] / math.sqrt(sum(x * x for x in raw)), 9)
    assert {(r["doc"], r["score"]) for r in search(asked, index, "id", "t", 3).collect()} == {(1, score)}


def test_an_index_of_the_most_frequent_terms(spark):
    frame = spark.createDataFrame([(1, "a b b"), (2, "a c"), (3, "a b"), (4, "d")], "id int, t string")
    index = TfidfIndex.build(frame, "id", "t", TfidfConfig(max_terms=2))
    assert {r["term"]: r["df"] for r in index.model.terms.collect()} == {"a": 3, "b": 2}
    asked = spark.createDataFrame([(7, "c d a")], "id int, t string")
    assert [r["doc"] for r in search(asked, index, "id", "t", 3).orderBy("rank").collect()] == [2, 3, 1]
