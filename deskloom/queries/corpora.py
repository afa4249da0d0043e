"""Pairing, deduplication, class caps, golden sets, leak checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from deskloom import schemas
from deskloom.functions import rules as R
from deskloom.functions.scores import normalise, ranked_classes
from deskloom.functions.text import text_key
from deskloom.operators import golden as G
from deskloom.operators import leakage as L
from deskloom.operators import pairing as P
from deskloom.operators.skew import bucketed_row_number
from deskloom.plans.corpus import build_corpus, label_pairs
from deskloom.presets import cases, replies, rules, taxonomy
from deskloom.queries import inputs, sql
from deskloom.queries.inputs import DEFAULT_LANG, LANG_RULES, LANGS
from deskloom.queries.registry import query, table
from deskloom.session import scratch_path
from deskloom.sources import files, literals, synthetic

_LANG_CLASS = sql.best_class(sql.hit_list("customer_text", LANG_RULES), LANGS, DEFAULT_LANG)
_CAP = 30

# Pairs as the corpus build collects them: long enough, first per text key, labelled, ranked per class.
COLLECTED = f"""{sql.MESSAGES},
paired AS (
  SELECT m.tweet_id, r.tweet_id AS agent_tweet_id, r.seq, {sql.clean('m.text')} AS customer_text,
         {sql.clean('r.text')} AS agent_text
  FROM messages r JOIN messages m ON m.tweet_id = r.in_response_to_tweet_id WHERE NOT r.inbound),
firsts AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY {sql.key('customer_text')} ORDER BY seq) AS k FROM paired
                 WHERE length(customer_text) >= 15 AND length(agent_text) >= 15) WHERE k = 1),
labelled AS (SELECT *, {_LANG_CLASS} AS class FROM firsts),
ranked AS (SELECT *, row_number() OVER (PARTITION BY class ORDER BY seq) AS rn FROM labelled),
collected AS (
  SELECT *, row_number() OVER (ORDER BY list_position({LANGS!r}, class), rn) - 1 AS position
  FROM ranked WHERE rn <= {_CAP})"""


def _pairs(spark, folder):
    return P.support_pairs(inputs.messages(spark, folder), inputs.replies(spark, folder), LANG_RULES, DEFAULT_LANG,
                           max_pairs=_CAP * len(LANGS))


@query(f"WITH {COLLECTED} SELECT class, count(*) AS n, sum(length(customer_text)) AS chars FROM labelled GROUP BY class")
def corpus_class_counts(spark, folder):
    """Flagship: pair, clean, filter, deduplicate, label, count per class."""
    pairs = P.dedupe_by_text(P.first_reply_pairs(inputs.replies(spark, folder), inputs.messages(spark, folder)))
    labelled = pairs.withColumn("class", R.label_class(F.col("customer_text"), LANG_RULES, DEFAULT_LANG)["class"])
    return labelled.groupBy("class").agg(F.count("*").alias("n"), F.sum(F.length("customer_text")).alias("chars"))


@query(f"""WITH {sql.MESSAGES} SELECT m.tweet_id, r.tweet_id AS agent_tweet_id, m.text AS customer_raw, r.text AS agent_raw
FROM messages r JOIN messages m ON m.tweet_id = r.in_response_to_tweet_id WHERE NOT r.inbound""")
def reply_pairs(spark, folder):
    return P.pair_replies(inputs.replies(spark, folder), inputs.messages(spark, folder)).drop("seq")


@query(f"""WITH {sql.MESSAGES}, hot AS (SELECT tweet_id, CASE WHEN seq // 1000 % 3 = 0 THEN '0'
    ELSE (seq // 1000 * 1000)::VARCHAR END AS parent FROM messages WHERE NOT inbound)
SELECT m.tweet_id, h.tweet_id AS agent_tweet_id, m.text AS customer_raw FROM hot h JOIN messages m ON m.tweet_id = h.parent""")
def reply_pairs_hot_message(spark, folder):
    """A third of all replies answer one message: its rows are salted over many tasks."""
    conv = F.expr("seq div 1000")
    hot = inputs.replies(spark, folder).withColumn(
        "in_response_to_tweet_id", F.when(conv % 3 == 0, "0").otherwise((conv * 1000).cast("string")))
    pairs = P.pair_replies(hot, inputs.messages(spark, folder), heavy_rows=5)
    return pairs.select("tweet_id", "agent_tweet_id", "customer_raw")


@query("""WITH m AS (SELECT (conv_id * 1000 + turn // 2)::VARCHAR AS tweet_id, conv_id * 1000 + turn AS seq, text FROM conversations)
SELECT tweet_id, text AS customer_raw FROM (SELECT *, row_number() OVER (PARTITION BY tweet_id ORDER BY seq DESC) AS k FROM m)
WHERE k = 1""")
def duplicate_ids_last_wins(spark, folder):
    rows = inputs.messages(spark, folder).withColumn(
        "tweet_id", F.expr("cast((seq div 1000) * 1000 + (seq % 1000) div 2 as string)"))
    return P.parents(rows, rows.withColumn("in_response_to_tweet_id", F.col("tweet_id")))


@query(f"""WITH {sql.MESSAGES} SELECT tweet_id, author_id FROM messages WHERE tweet_id IN
  (SELECT in_response_to_tweet_id FROM messages WHERE NOT inbound AND in_response_to_tweet_id <> '')""")
def reply_targets(spark, folder):
    return P.reply_targets(inputs.messages(spark, folder), inputs.replies(spark, folder)).select("tweet_id", "author_id")


@query(f"""WITH {sql.MESSAGES} SELECT DISTINCT in_response_to_tweet_id AS tweet_id FROM messages
WHERE in_response_to_tweet_id <> '' EXCEPT SELECT tweet_id FROM messages WHERE NOT inbound""")
def unanswered_target_ids(spark, folder):
    """Set difference: answered ids that are no outbound messages themselves."""
    rows = inputs.messages(spark, folder)
    targets = P.linked(rows).select(F.col("in_response_to_tweet_id").alias("tweet_id"))
    return targets.subtract(P.outbound(rows).select("tweet_id"))


_FIRST_DOCS = f"""firsts AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY {sql.key('text')} ORDER BY doc_id) AS k
  FROM documents) WHERE k = 1)"""


@query(f"WITH {_FIRST_DOCS} SELECT doc_id, text, lang FROM firsts")
def first_wins_dedupe(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang")
    return P.dedupe_by_text(docs, text="text", order="doc_id")


@query(f"""WITH {_FIRST_DOCS}, r AS (SELECT doc_id, lang, row_number() OVER (PARTITION BY lang ORDER BY doc_id) AS rn FROM firsts)
SELECT doc_id, lang, rn FROM r WHERE rn <= 143""")
def class_cap(spark, folder):
    docs = P.dedupe_by_text(table(spark, folder, "documents").select("doc_id", "text", "lang"), "text", "doc_id")
    capped = P.cap_per_class(docs, P.class_cap(1001, 7), label="lang", order="doc_id")
    return capped.select("doc_id", "lang", "rn")


@query(f"""WITH {COLLECTED} SELECT tweet_id, agent_tweet_id, customer_text, agent_text, class, position FROM collected""")
def support_pairs(spark, folder):
    return _pairs(spark, folder).select("tweet_id", "agent_tweet_id", "customer_text", "agent_text", "class", "position")


_ESC_DOCS = {"HARDWARE_PHYSICAL_DAMAGE": [LANG_RULES["de"][0]], "HIGH_SENTIMENT_CHURN_RISK": [LANG_RULES["fr"][1]],
             "PII_SECURITY_DM": [LANG_RULES["en"][1]]}
_REASON = sql.escalation_label("customer_text", _ESC_DOCS)


@query(f"""WITH {COLLECTED} SELECT printf('real_%05d', position) AS id, customer_text, class AS intent, agent_text,
  ({_REASON}) IS NULL AS auto_handle, coalesce({_REASON}, 'STANDARD_TROUBLESHOOTING') AS escalation_reason,
  'kaggle_twcs' AS source FROM collected""")
def build_corpus_rows(spark, folder):
    """The corpus build on conversation turns, with the rule sets as parameters."""
    return build_corpus(inputs.messages(spark, folder), _CAP * len(LANGS), "assistant", rules.BRAND_SIGNALS, LANG_RULES,
                        _ESC_DOCS, DEFAULT_LANG, top_up=False)


_TPL_TOTAL = len(cases.SEED_CASES)


@query(f"""WITH {COLLECTED}, {sql.TEMPLATE_TABLES},
{sql.values("seeds", "n, customer_text, intent, agent_text, auto_handle, escalation_reason", [(i, *row) for i, row in enumerate(cases.SEED_CASES)])},
ids AS (SELECT unnest(range({_TPL_TOTAL}, greatest({_TPL_TOTAL}, (SELECT count(*) FROM documents) - (SELECT count(*) FROM collected)))) AS gid),
generated AS ({sql.generated("ids", "gid")}),
allrows AS (
  SELECT printf('real_%05d', position) AS id, customer_text, agent_text, 'kaggle_twcs' AS source FROM collected
  UNION ALL SELECT printf('synth_%05d', n), customer_text, agent_text, 'synthetic_fallback' FROM seeds
  UNION ALL SELECT printf('synth_%05d', gid), customer_text, agent_text, 'synthetic_fallback' FROM generated)
SELECT id, customer_text, agent_text, source, {_LANG_CLASS} AS intent FROM allrows""")
def pairs_topped_up(spark, folder):
    """Too few pairs: generated rows fill up to the wanted total and are labelled by the same rules."""
    wanted = table(spark, folder, "documents").count()
    pairs = _pairs(spark, folder).withColumn("source", F.lit(cases.REAL_SOURCE))
    filled = synthetic.top_up_pairs(pairs, wanted, minimum=10_000_000)
    return label_pairs(filled, LANG_RULES, _ESC_DOCS, DEFAULT_LANG).select(
        "id", "customer_text", "agent_text", "source", "intent")


@query("SELECT o_orderkey, row_number() OVER (ORDER BY o_orderkey DESC) AS position FROM orders")
def sequence_numbers(spark, folder):
    """Global numbering without one global sort task."""
    rows = table(spark, folder, "orders").select("o_orderkey", (-F.col("o_orderkey")).alias("_o"))
    return bucketed_row_number(rows, "_o", F.floor(F.col("_o") / 1024)).select("o_orderkey", "position")


@query("SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS position FROM events")
def sequence_numbers_per_group(spark, folder):
    rows = table(spark, folder, "events").select("user_id", "event_id")
    return bucketed_row_number(rows, "event_id", F.floor(F.col("event_id") / 1000), group=["user_id"])


# ---- leak checks ----

_SPLIT = """halves AS (SELECT *, substr(md5(doc_id::VARCHAR), 1, 1) IN ('0', '1') AS held FROM documents)"""
_K = sql.key("text")


def _split(spark, folder):
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang")
    corpus, golden = inputs.halves(docs, "doc_id")
    return (corpus.withColumnsRenamed({"doc_id": "id", "text": "customer_text"}),
            golden.withColumnsRenamed({"doc_id": "id", "text": "customer_tweet"}))


_OVERLAP = f"""{_SPLIT},
c AS (SELECT DISTINCT {_K} AS k FROM halves WHERE NOT held), g AS (SELECT DISTINCT {_K} AS k FROM halves WHERE held),
o AS (SELECT k FROM c INTERSECT SELECT k FROM g)"""


@query(f"""WITH {_OVERLAP}
SELECT (SELECT count(*) FROM c) AS corpus_size, (SELECT count(*) FROM g) AS golden_size,
  (SELECT count(*) FROM o) AS exact_duplicates,
  round((SELECT count(*) FROM o) * 100.0 / (SELECT count(*) FROM g), 2)::DOUBLE AS leakage_percentage,
  CASE WHEN (SELECT count(*) FROM o) = 0 THEN 'CLEAN' ELSE 'LEAKAGE_DETECTED' END AS status,
  (SELECT count(*) FROM o) > 0 AS leakage_detected""")
def leakage_report(spark, folder):
    return L.leakage_report(*_split(spark, folder)).drop("leaked_examples")


@query(f"""WITH {_OVERLAP} SELECT 'LEAKAGE_DETECTED' AS status, (SELECT count(*) FROM o) AS exact_duplicates, k AS example
FROM o ORDER BY k LIMIT 5""")
def leakage_report_written(spark, folder):
    """The report written as JSON, read back, its examples unfolded."""
    path = scratch_path(spark, "leakage")
    files.write_json(L.leakage_report(*_split(spark, folder)), path)
    back = files.scan_json_lines(spark, path, schemas.LEAKAGE)
    return back.select("status", "exact_duplicates", F.explode("leaked_examples").alias("example"))


_CONTAINED = f"""g AS (SELECT item_id, {_K} AS k FROM benchmark WHERE {_K} <> '' UNION ALL SELECT 1000000 + doc_id, {_K} FROM documents
  WHERE doc_id % 7 = 0 AND {_K} <> '' UNION ALL SELECT 2000000 + n_nationkey, lower(substr(n_name, 2, 4)) FROM nation),
pairs AS (SELECT item_id, doc_id FROM g JOIN documents ON contains({_K}, g.k))"""


def _held_texts(spark, folder):
    docs = table(spark, folder, "documents")
    return (table(spark, folder, "benchmark").select("item_id", "text")
            .union(docs.filter("doc_id % 7 = 0").select(F.col("doc_id") + 1000000, "text"))
            .union(table(spark, folder, "nation").select(F.col("n_nationkey") + 2000000, F.expr("substr(n_name, 2, 4)"))))


@query(f"WITH {_CONTAINED} SELECT item_id, doc_id FROM pairs")
def contained_texts(spark, folder):
    """Held-out texts (items, whole documents, parts of words) that stand inside documents."""
    return L.contained_texts(table(spark, folder, "documents"), _held_texts(spark, folder), "text", "text", "doc_id", "item_id")


@query(f"""WITH {_CONTAINED} SELECT (SELECT count(DISTINCT k) FROM g) AS golden_size,
  count(DISTINCT k) AS contained, round(count(DISTINCT k) * 100.0 / (SELECT count(DISTINCT k) FROM g), 2)::DOUBLE AS leakage_percentage,
  'LEAKAGE_DETECTED' AS status FROM g WHERE item_id IN (SELECT item_id FROM pairs)""")
def containment_report(spark, folder):
    return L.containment_report(table(spark, folder, "documents"), _held_texts(spark, folder), "text", "text", "doc_id", "item_id")


@query(f"""WITH {_SPLIT} SELECT DISTINCT {_K} AS key FROM halves WHERE NOT held
INTERSECT SELECT DISTINCT {_K} FROM halves WHERE held""")
def leakage_overlap_keys(spark, folder):
    return L.shared_keys(*_split(spark, folder))


@query(f"""WITH {_SPLIT} SELECT doc_id AS id, lang FROM halves WHERE NOT held
AND {_K} NOT IN (SELECT {_K} FROM halves WHERE held) AND doc_id NOT IN (SELECT item_id FROM benchmark)""")
def corpus_minus_golden(spark, folder):
    """Drop sampled ids and texts held out for evaluation."""
    corpus, golden = _split(spark, folder)
    ids = table(spark, folder, "benchmark").select(F.col("item_id").alias("id"))
    return L.without_leaks(corpus, golden, ids).select("id", "lang")


@query(f"""SELECT doc_id, lang FROM documents WHERE {_K} NOT IN (SELECT {_K} FROM documents WHERE lang = 'es')""")
def eligible_rows(spark, folder):
    docs = table(spark, folder, "documents")
    corpus = docs.select("doc_id", F.col("text").alias("customer_text"), "lang")
    adversarial = docs.filter(F.col("lang") == "es").select(F.col("text").alias("customer_tweet"))
    return G.eligible_rows(corpus, adversarial).select("doc_id", "lang")


@query(f"SELECT count(DISTINCT {_K}) AS distinct_keys, count(*) AS rows FROM documents")
def distinct_text_keys(spark, folder):
    docs = table(spark, folder, "documents")
    keyed = docs.groupBy(text_key(F.col("text")).alias("k")).agg(F.count("*").alias("n"))
    return keyed.agg(F.count("*").alias("distinct_keys"), F.sum("n").alias("rows"))


# ---- golden sets ----

_ADV = sql.values("adversarial", "id, customer_tweet, intent, reply, escalated, reason, difficulty, notes",
                  [row[:8] for row in cases.ADVERSARIAL_CASES])


def _golden_sql(target: int, balanced: bool = False) -> str:
    quota = G.stratum_quota(target, len(cases.ADVERSARIAL_CASES), len(taxonomy.CLASSES))
    wanted = target - len(cases.ADVERSARIAL_CASES)
    base = len(cases.ADVERSARIAL_CASES)
    text = sql.ascii_words("customer_text")
    classes = f"list_position({taxonomy.CLASSES!r}, intent)"
    # Even shares are what taking the classes' rows by turns gives.
    evenly = f"SELECT * FROM drawn QUALIFY row_number() OVER (ORDER BY rn, {classes}) <= {wanted}"
    taken = evenly if balanced else f"SELECT * FROM drawn WHERE rn <= {quota}"
    return f"""{sql.SUPPORT}, {_ADV},
drawn AS (SELECT *, row_number() OVER (PARTITION BY intent ORDER BY md5('42' || id), id) AS rn FROM support),
sampled AS (SELECT *, row_number() OVER (ORDER BY list_position({taxonomy.CLASSES!r}, intent), rn) AS position
  FROM ({taken}) QUALIFY position <= {wanted}),
fresh AS (SELECT * FROM support WHERE {sql.key('customer_text')} NOT IN (SELECT {sql.key('customer_text')} FROM sampled)
  QUALIFY row_number() OVER (PARTITION BY {sql.key('customer_text')} ORDER BY seq) = 1),
filled AS (SELECT *, row_number() OVER (ORDER BY seq) + (SELECT count(*) FROM sampled) AS position FROM fresh
  QUALIFY position <= {wanted}),
picked AS (SELECT *, ({sql.escalation_label(text)}) AS why, {text} AS plain, false AS late FROM (SELECT * EXCLUDE rn FROM sampled)
  UNION ALL SELECT *, ({sql.escalation_label(text)}), {text}, true FROM filled),
golden AS (
  SELECT id, customer_tweet, intent AS ground_truth_intent, reply AS reference_reply, escalated AS ground_truth_escalation,
    reason AS escalation_reason, difficulty FROM adversarial
  UNION ALL SELECT printf('gold_%03d', position + {base}), customer_text, intent, agent_text, why IS NOT NULL,
    coalesce(why, 'STANDARD_TROUBLESHOOTING'),
    CASE WHEN late THEN 'EASY' ELSE {sql.difficulty('plain', 'why IS NOT NULL')} END FROM picked)"""


def _golden(spark, folder, target, **options):
    golden, _ = G.golden_sample(inputs.support(spark, folder), literals.adversarial_cases(spark), taxonomy.CLASSES,
                                rules.LABEL_ESCALATION_RULES, rules.HARD_CASE_PATTERNS, target, **options)
    return golden


_GOLDEN = "id, customer_tweet, ground_truth_intent, reference_reply, ground_truth_escalation, escalation_reason, difficulty"


@query(f"WITH {_golden_sql(200)} SELECT {_GOLDEN} FROM golden")
def golden_sample(spark, folder):
    """Classes filled in taxonomy order; late classes get what is left."""
    return _golden(spark, folder, 200).drop("notes", "source")


@query(f"WITH {_golden_sql(950)} SELECT {_GOLDEN} FROM golden")
def golden_sample_filled_up(spark, folder):
    """A target above the class quotas: the rest comes in corpus order from unseen texts."""
    return _golden(spark, folder, 950).drop("notes", "source")


@query(f"WITH {_golden_sql(200, balanced=True)} SELECT {_GOLDEN} FROM golden")
def golden_sample_balanced(spark, folder):
    """The rows shared out evenly: no class gets fewer than another unless it is used up."""
    return _golden(spark, folder, 200, balanced=True).drop("notes", "source")


@query(f"WITH {_golden_sql(200)} SELECT {_GOLDEN} FROM golden")
def golden_csv_round_trip(spark, folder):
    path = scratch_path(spark, "golden-csv")
    files.write_csv(_golden(spark, folder, 200), path)
    return files.scan_csv(spark, path, schemas.GOLDEN).drop("notes", "source")


@query(f"""WITH {sql.SUPPORT}, {_ADV} SELECT count(*) AS rows, (SELECT count(*) FROM support WHERE intent = 'HARDWARE_BATTERY')
  AS total_count, min(id) AS first_id, max(id) AS last_id FROM
  (SELECT id FROM support WHERE intent = 'HARDWARE_BATTERY' ORDER BY id LIMIT 50)""")
def golden_browse(spark, folder):
    """Filter, total before the limit, first rows."""
    golden = inputs.support(spark, folder).withColumnRenamed("intent", "ground_truth_intent")
    total, first = G.browse(golden, 50, intent="HARDWARE_BATTERY")
    return first.agg(F.count("*").alias("rows"), total.scalar().alias("total_count"), F.min("id").alias("first_id"),
                     F.max("id").alias("last_id"))


TIER_REPLIES = " ".join(f"WHEN {i} THEN {sql.lit(t) if t else 'agent_text'}" for i, (t, _) in enumerate(replies.RATING_TIERS))


def _tier_score(k):
    return "CASE tier " + " ".join(f"WHEN {i} THEN {s[k]}" for i, (_, s) in enumerate(replies.RATING_TIERS)) + " END"


TIER_OVERALL = "round((" + " + ".join(map(_tier_score, range(4))) + ") / 4.0, 2)::DOUBLE"


@query(f"""WITH {sql.SUPPORT}, t AS (SELECT *, CASE WHEN seq < 20 THEN seq % 3 ELSE (seq - 20) % 3 END AS tier FROM support)
SELECT id AS case_id, CASE tier {TIER_REPLIES} END AS model_reply, {_tier_score(0)} AS groundedness, {_tier_score(1)} AS brand_voice,
  {_tier_score(2)} AS actionability, {_tier_score(3)} AS safety,
  {TIER_OVERALL} AS overall_mean,
  CASE WHEN seq < 20 THEN 'manual' ELSE 'programmatic_rubric' END AS annotation_method FROM t""")
def tier_ratings(spark, folder):
    return tier_rated(spark, folder).select("case_id", "model_reply", "human_scores.*", "annotation_method")


def tier_rated(spark, folder):
    golden = inputs.support(spark, folder).select(
        "id", F.col("customer_text").alias("customer_tweet"), F.col("agent_text").alias("reference_reply"),
        F.col("intent").alias("ground_truth_intent"), F.lit("EASY").alias("difficulty"), "seq")
    return G.tier_ratings(golden, "seq", replies.RATING_TIERS, manual_notes=replies.MANUAL_NOTES,
                          tier_notes=replies.TIER_NOTES)


# ---- rule labels ----

_PLAIN = f"{sql.SUPPORT}, p AS (SELECT *, {sql.ascii_words('customer_text')} AS t FROM support)"


def _label_sql(ruleset):
    scores = sql.hit_list("t", ruleset)
    return f"""h AS (SELECT id, {scores} AS s FROM p)
SELECT id, {sql.best_class('s', list(ruleset), taxonomy.DEFAULT_CLASS)} AS class, list_max(s) AS score FROM h"""


@query(f"WITH {_PLAIN}, {_label_sql(rules.LABEL_RULES)}")
def label_class(spark, folder):
    label = R.label_class(F.col("customer_text"), rules.LABEL_RULES, taxonomy.DEFAULT_CLASS)
    return inputs.support(spark, folder).select("id", label.alias("l")).select("id", "l.class", "l.score")


@query(f"""WITH h AS (SELECT doc_id, {sql.hit_list('text', LANG_RULES)} AS s FROM documents)
SELECT doc_id, {sql.best_class('s', LANGS, DEFAULT_LANG)} AS class, list_max(s) AS score FROM h""")
def label_language(spark, folder):
    label = R.label_class(F.col("text"), LANG_RULES, DEFAULT_LANG)
    return table(spark, folder, "documents").select("doc_id", label.alias("l")).select("doc_id", "l.class", "l.score")


@query(f"""WITH {_PLAIN}, e AS (SELECT id, {sql.escalation_label('t')} AS why FROM p)
SELECT id, why IS NOT NULL AS escalate, coalesce(why, 'STANDARD_TROUBLESHOOTING') AS reason FROM e""")
def label_escalation(spark, folder):
    label = R.label_escalation(F.col("customer_text"), rules.LABEL_ESCALATION_RULES, "STANDARD_TROUBLESHOOTING")
    return inputs.support(spark, folder).select("id", label.alias("l")).select("id", "l.*")


_HITS = ", ".join(f"{sql.hits('text', p)} AS {c}" for c, p in LANG_RULES.items())


@query(f"SELECT doc_id, {_HITS} FROM documents")
def rule_hit_counts(spark, folder):
    counts = R.hit_counts(F.col("text"), LANG_RULES)
    return table(spark, folder, "documents").select("doc_id", counts.alias("h")).select(
        "doc_id", *[F.get("h", i).alias(c) for i, c in enumerate(LANGS)])


@query(f"""WITH h AS (SELECT doc_id, {_HITS} FROM documents), u AS (UNPIVOT h ON en, de, fr, es INTO NAME class VALUE n)
SELECT doc_id, class, n FROM u WHERE n > 0""")
def rule_table_hits(spark, folder):
    """Text x rule-table join, kept to the classes that hit."""
    docs = table(spark, folder, "documents").withColumn("seq", F.col("doc_id"))
    hits = R.rule_hits(docs, "text", literals.rule_table(spark, lang=LANG_RULES))
    # explode_outer: with explode, Spark would look for the hits twice, first to drop rows without any.
    return hits.select("doc_id", F.explode_outer("hits").alias("h")).filter("h IS NOT NULL").select("doc_id", "h.*")


@query(f"""WITH h AS (SELECT doc_id, {_HITS} FROM documents), u AS (UNPIVOT h ON en, de, fr, es INTO NAME class VALUE n),
t AS (SELECT *, sum(n) OVER (PARTITION BY doc_id) AS total, list_position({LANGS!r}, class) AS o FROM u)
SELECT doc_id, class, round(CASE WHEN total > 0 THEN n / total ELSE 0.25 END, 6)::DOUBLE AS share,
  row_number() OVER (PARTITION BY doc_id ORDER BY n DESC, o) AS rank FROM t""")
def normalised_ranked_classes(spark, folder):
    """Rule hits as shares, classes ranked with ties in class order."""
    shares = normalise(F.transform(R.hit_counts(F.col("text"), LANG_RULES), lambda h: h.cast("double")))
    ranked = table(spark, folder, "documents").select("doc_id", ranked_classes(shares, LANGS).alias("r"))
    return ranked.select("doc_id", F.posexplode("r").alias("p", "c")).select(
        "doc_id", "c.class", F.round("c.score", 6).alias("share"), (F.col("p") + 1).alias("rank"))


@query(f"""WITH {COLLECTED} SELECT 'kaggle_twcs' AS source, class, count(*) AS n FROM labelled GROUP BY class
UNION ALL SELECT source, lang, count(*) FROM documents GROUP BY source, lang""")
def counts_by_source(spark, folder):
    pairs = P.dedupe_by_text(P.first_reply_pairs(inputs.replies(spark, folder), inputs.messages(spark, folder)))
    labelled = R.label_class(F.col("customer_text"), LANG_RULES, DEFAULT_LANG)["class"].alias("class")
    pairs = pairs.select(F.lit(cases.REAL_SOURCE).alias("source"), labelled)
    docs = table(spark, folder, "documents").select("source", F.col("lang").alias("class"))
    return pairs.unionByName(docs).groupBy("source", "class").agg(F.count("*").alias("n"))
