import json

from pyspark.sql import functions as F

from deskloom import schemas
from deskloom.operators import golden as G
from deskloom.operators import leakage as L
from deskloom.operators import pairing as P
from deskloom.operators.skew import (bucketed_row_number, first_per_key, skew_join, top_n_per_group, value_positions)
from deskloom.plans.corpus import build_corpus, initialise_data
from deskloom.presets import replies, rules, taxonomy
from deskloom.sources import files, literals, synthetic


def corpus_rows(spark, n):
    rows = [(f"c{i:04d}", f"customer message number {i} about things", taxonomy.CLASSES[i % 7], f"reply {i}", True,
             "STANDARD_TROUBLESHOOTING", "kaggle_twcs", i) for i in range(n)]
    return spark.createDataFrame(rows, schemas.CORPUS + ", seq int")


def test_golden_sample_exact_size_and_clean(spark):
    corpus = corpus_rows(spark, 100)
    golden, sampled = G.golden_sample(corpus, literals.adversarial_cases(spark), taxonomy.CLASSES,
                                      rules.LABEL_ESCALATION_RULES, rules.HARD_CASE_PATTERNS, 30)
    assert golden.count() == 30 and sampled.count() == 20
    clean = L.without_leaks(corpus, golden, sampled)
    report = L.leakage_report(clean, golden).first()
    assert clean.count() == 80 and report["status"] == "CLEAN" and report["leaked_examples"] == []
    ids = [r["id"] for r in golden.collect()]
    assert len(set(ids)) == 30 and "gold_011" in ids and "gold_030" in ids
    # Greedy fill: the first two classes take everything.
    assert {r["ground_truth_intent"] for r in golden.filter("source = 'kaggle_twcs'").collect()} == set(taxonomy.CLASSES[:2])


def test_golden_sample_fill_up_skips_repeated_texts(spark):
    corpus = corpus_rows(spark, 40).withColumn("intent", F.lit("OS_UPDATE_BUG"))
    repeated = corpus.unionByName(corpus.withColumn("id", F.concat("id", F.lit("b"))).withColumn("seq", F.col("seq") + 100))
    golden, _ = G.golden_sample(repeated, literals.adversarial_cases(spark), taxonomy.CLASSES,
                                rules.LABEL_ESCALATION_RULES, rules.HARD_CASE_PATTERNS, 200)
    texts = [r["customer_tweet"] for r in golden.filter("source = 'kaggle_twcs'").collect()]
    filled = golden.filter("source = 'kaggle_twcs'").count()
    assert len(set(texts)) == 40 and filled >= 40


def test_leakage_examples(spark):
    corpus = spark.createDataFrame([("Same text ",), ("other",)], "customer_text string")
    golden = spark.createDataFrame([("same TEXT",), ("new",)], "customer_tweet string")
    report = L.leakage_report(corpus, golden).first()
    assert (report["status"], report["leakage_percentage"], report["exact_duplicates"]) == ("LEAKAGE_DETECTED", 50.0, 1)
    assert report["leaked_examples"] == ["same text"]
    empty = L.leakage_report(corpus.limit(0), golden.limit(0)).first()
    assert (empty["corpus_size"], empty["status"], empty["leakage_percentage"]) == (0, "CLEAN", 0.0)


def messages(spark):
    rows = [("1", "u1", True, "My iPhone battery drains quickly", "", 0),
            ("2", "AppleSupport", False, "We can help with the battery drain", "1", 1),
            ("3", "AppleSupport", False, "A second reply to the same message", "1", 2),
            ("4", "u2", True, "MY IPHONE battery drains quickly ", "", 3),
            ("5", "AppleSupport", False, "Reply to the duplicate message", "4", 4),
            ("6", "u3", True, "too short", "", 5), ("7", "AppleSupport", False, "Reply to a short message", "6", 6),
            ("8", "AppleSupport", False, "Reply to nothing known here", "99", 7),
            ("9", "Other", False, "Another brand answers this one", "1", 8),
            ("10", "u4", True, "I was charged twice, refund please", "", 9),
            ("11", "AppleSupport", False, "short", "10", 10), ("12", "AppleSupport", False, "Please check your receipts", "10", 11)]
    return spark.createDataFrame(rows, "tweet_id string, author_id string, inbound boolean, text string, "
                                       "in_response_to_tweet_id string, seq long")


def test_build_corpus(spark):
    rows = {r["id"]: r for r in build_corpus(messages(spark), 70, top_up=False).collect()}
    assert set(rows) == {"real_00000", "real_00001"}
    assert rows["real_00000"]["agent_text"] == "We can help with the battery drain"
    assert rows["real_00000"]["intent"] == "HARDWARE_BATTERY" and rows["real_00000"]["auto_handle"]
    assert rows["real_00001"]["escalation_reason"] == "BILLING_REFUND_AUTH" and not rows["real_00001"]["auto_handle"]
    assert rows["real_00001"]["agent_text"] == "Please check your receipts"


def test_top_up_relabels_generated_rows(spark):
    corpus = build_corpus(messages(spark), 70)
    assert corpus.count() == 70 and corpus.select("id").distinct().count() == 70
    assert corpus.filter("source = 'kaggle_twcs'").count() == 2


def test_generated_corpus_keeps_seed_labels(spark):
    made = synthetic.messages_or_synthetic(spark, None, 30, build=None)
    assert made.count() == 30 and synthetic.expand_templates(spark, 5).count() == 14
    first = made.filter("id = 'synth_00000'").first()
    assert first["intent"] == "OS_UPDATE_BUG" and made.filter("customer_text like '%{%'").count() == 0


def test_initialise_data(spark, tmp_path):
    report = initialise_data(spark, messages(spark), str(tmp_path), max_pairs=300, target=60).first()
    assert report["status"] == "CLEAN" and report["golden_size"] > 0
    ratings = files.scan_json_lines(spark, f"{tmp_path}/ratings", schemas.RATINGS)
    counts = {r["annotation_method"]: r["count"] for r in ratings.groupBy("annotation_method").count().collect()}
    assert counts == {"manual": 20, "programmatic_rubric": 30}
    assert files.scan_csv(spark, f"{tmp_path}/golden_csv", schemas.GOLDEN).count() == 60


def test_rating_tiers(spark):
    golden = corpus_rows(spark, 60).select("id", F.col("customer_text").alias("customer_tweet"),
                                           F.col("agent_text").alias("reference_reply"),
                                           F.col("intent").alias("ground_truth_intent"), F.lit("EASY").alias("difficulty"))
    rated = {r["case_id"]: r for r in G.rating_set(golden, replies.RATING_TIERS, manual_notes=replies.MANUAL_NOTES,
                                                   tier_notes=replies.TIER_NOTES).collect()}
    assert len(rated) == 50 and rated["c0000"]["model_reply"] == "reply 0"
    assert rated["c0019"]["human_scores"]["overall_mean"] == 3.75 and rated["c0020"]["human_scores"]["overall_mean"] == 5.0
    assert rated["c0001"]["annotator_notes"] == replies.MANUAL_NOTES[1]
    assert rated["c0022"]["annotator_notes"] == "Ungrounded 'As an AI' response inappropriate for HARDWARE_BATTERY queries."


def test_csv_choice_and_json_array(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    (tmp_path / "big.csv").write_text("a,b\n" + "x,y\n" * 100)
    assert files.choose_csv(spark, str(tmp_path)).endswith("big.csv")
    (tmp_path / "sub" / "TWCS.csv").write_text(
        'tweet_id,author_id,inbound,created_at,text,response_tweet_id,in_response_to_tweet_id\n'
        '1.0,u,True,,"line one\nline ""two""",2,\n2,A,False,,,,1.0\n')
    chosen = files.choose_csv(spark, str(tmp_path))
    assert chosen.endswith("TWCS.csv")
    rows = files.scan_messages_csv(spark, chosen).orderBy("tweet_id").collect()
    assert [(r["tweet_id"], r["inbound"], r["text"], r["in_response_to_tweet_id"]) for r in rows] == [
        ("1", True, 'line one\nline "two"', ""), ("2", False, "", "1")]
    (tmp_path / "none").mkdir()
    assert files.choose_csv(spark, str(tmp_path / "none")) is None
    (tmp_path / "golden.json").write_text(json.dumps([{"id": "g1", "customer_tweet": "x"}, {"id": "g2"}], indent=2))
    assert files.scan_json_array(spark, str(tmp_path / "golden.json"), schemas.GOLDEN).count() == 2


def test_browse_counts_before_limit(spark):
    golden = corpus_rows(spark, 70).withColumnRenamed("intent", "ground_truth_intent").withColumn("difficulty", F.lit("EASY"))
    total, first = G.browse(golden, 3, intent="OS_UPDATE_BUG", level="EASY")
    assert total.first()[0] == 10 and [r["id"] for r in first.collect()] == ["c0000", "c0007", "c0014"]


def test_literal_tables(spark):
    assert literals.taxonomy_table(spark).count() == 7 and literals.reason_table(spark).count() == 9
    assert literals.adversarial_cases(spark).count() == 10 and literals.seed_cases(spark).count() == 14
    assert {r[0] for r in literals.rule_table(spark).select("ruleset").distinct().collect()} == {"label", "boost", "policy"}


# ---- spreading helpers ----

def test_skew_join_equals_plain_join(spark):
    left = spark.range(3000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 50).alias("k"), F.col("id").alias("v"))
    right = spark.range(40).select(F.col("id").alias("k"), (F.col("id") * 10).alias("w"))
    for how in ("inner", "left", "left_anti"):
        got = sorted(map(tuple, skew_join(left, right, "k", spread="v", how=how, min_rows=100).collect()), key=str)
        assert got == sorted(map(tuple, left.join(right, "k", how).collect()), key=str)


def test_top_n_and_first(spark):
    rows = spark.range(1000).select((F.col("id") % 3).alias("g"), F.pmod(F.hash("id"), F.lit(97)).alias("x"), F.col("id").alias("i"))
    got = {(r["g"], r["rn"]): r["i"] for r in top_n_per_group(rows, ["g"], [F.desc("x"), F.col("i")], 5, spread="i", salts=7).collect()}
    local = sorted((r["g"], -r["x"], r["i"]) for r in rows.collect())
    want = {(g, n + 1): [t for t in local if t[0] == g][n][2] for g in range(3) for n in range(5)}
    assert got == want
    firsts = {r["g"]: r["i"] for r in first_per_key(rows, "g", "i").collect()}
    assert firsts == {0: 0, 1: 1, 2: 2}


def test_numbering(spark):
    rows = spark.range(500).select((F.col("id") * 7).alias("o"))
    got = {r["o"]: r["position"] for r in bucketed_row_number(rows, "o", F.floor(F.col("o") / 100)).collect()}
    assert got == {i * 7: i + 1 for i in range(500)}


def test_value_positions(spark):
    data = [3.0] * 50 + [1.0, 2.0, 2.0, 9.5]
    got = {r["x"]: (r["n"], r["below"]) for r in value_positions(spark.createDataFrame([(x,) for x in data], "x double"), "x", buckets=3).collect()}
    assert got == {1.0: (1, 0), 2.0: (2, 1), 3.0: (50, 3), 9.5: (1, 53)}


def test_hot_parent_pairs(spark):
    sent = spark.range(200).select(F.col("id").cast("string").alias("tweet_id"), F.lit("A").alias("author_id"),
                                   F.lit(False).alias("inbound"), F.concat(F.lit("reply "), "id").alias("text"),
                                   F.lit("p").alias("in_response_to_tweet_id"), F.col("id").alias("seq"))
    asked = spark.createDataFrame([("p", "u", True, "question", "", 1000), ("p", "u", True, "edited question", "", 1001)], sent.schema)
    pairs = P.pair_replies(sent, asked, heavy_rows=10)
    assert pairs.count() == 200 and {r[0] for r in pairs.select("customer_raw").distinct().collect()} == {"edited question"}
