"""TF-IDF, retrieval, classification, policy, replies, the whole pipeline and its evaluation."""

from __future__ import annotations

import math

from pyspark.sql import functions as F

from deskloom.functions import rules as R
from deskloom.operators.caseindex import CaseIndex
from deskloom.operators.leakage import leakage_report
from deskloom.operators.retrieval import flat_cases, search, top_k_cases
from deskloom.operators.tfidf import (CLASSIFIER_TERMS, TfidfConfig, TfidfIndex, document_frequency, fit_tfidf, retrieval_terms,
                                      term_counts, tfidf, vocabulary)
from deskloom.plans import benchmark as B
from deskloom.plans.baselines import keyword_baseline, majority_baseline, majority_class
from deskloom.plans.classifier import ClassModel, classify_by_rules, fit_classifier
from deskloom.plans.policy import escalate
from deskloom.plans.replies import draft_reply
from deskloom.plans.triage import decide, triage
from deskloom.presets import replies, rules, taxonomy
from deskloom.queries import inputs, sql
from deskloom.queries.corpora import tier_rated
from deskloom.queries.inputs import DEFAULT_LANG, HALVES_SQL, LANG_CORPUS_SQL, LANG_RULES, LANGS
from deskloom.queries.registry import query, table
from deskloom.queries.scalars import STOP_WORDS
from deskloom.session import stored, scratch_path
from deskloom.sources import files

WORDS = TfidfConfig()
CASES = retrieval_terms(STOP_WORDS)
_STOPS = ", ".join(sql.lit(w) for w in STOP_WORDS)


def _case_tokens(text: str) -> str:
    return f"list_filter({sql.words(text)}, lambda t: length(t) >= 2 AND t NOT IN ({_STOPS}))"


def _vectors(name: str, source: str, id_col: str, text: str) -> str:
    """CTEs for one side: tokens and sublinear term counts."""
    return f"""{name}_t AS (SELECT {id_col} AS id, {_case_tokens(text)} AS w FROM {source}),
{name}_tf AS (SELECT id, term, 1 + ln(count(*)) AS tf FROM (
  SELECT id, unnest(w) AS term FROM {name}_t
  UNION ALL SELECT id, unnest([w[i] || ' ' || w[i + 1] for i in range(1, len(w))]) FROM {name}_t) GROUP BY id, term)"""


def _weights(name: str) -> str:
    return f"""{name}_raw AS (SELECT id, term, tf * idf AS w FROM {name}_tf JOIN idf USING (term)),
{name}_w AS (SELECT id, term, w / sqrt(sum(w * w) OVER (PARTITION BY id)) AS w FROM {name}_raw)"""


def _top_k(queries: str, corpus: str, k: int = 3) -> str:
    """CTEs ending in hits(query_id, rank, id, similarity_score, raw_cosine_score, agent_text, ...).

    ``queries`` holds query_id, text, class; ``corpus`` the corpus columns.
    """
    return f"""{_vectors('c', corpus, 'id', 'customer_text')}, {_vectors('q', queries, 'query_id', 'text')},
idf AS (SELECT term, ln((1 + (SELECT count(*) FROM {corpus})) / (1 + count(*))) + 1 AS idf FROM c_tf GROUP BY term),
{_weights('c')}, {_weights('q')},
cosines AS (SELECT q_w.id AS query_id, c_w.id AS id, round(sum(q_w.w * c_w.w), 9) AS score FROM q_w JOIN c_w USING (term) GROUP BY 1, 2),
best AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, id) AS r FROM cosines) WHERE r <= {3 * k}),
pads AS (SELECT id FROM {corpus} ORDER BY id LIMIT {3 * k}),
padded AS (SELECT query_id, id, score, r FROM best UNION ALL
  SELECT query_id, p.id, 0, 1000 + row_number() OVER (PARTITION BY query_id ORDER BY p.id) FROM {queries} q, pads p
  WHERE NOT EXISTS (SELECT 1 FROM best b WHERE b.query_id = q.query_id AND b.id = p.id)),
pool AS (SELECT * FROM padded QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY r) <= {3 * k}),
lifted AS (SELECT p.query_id, p.r, p.id, round(score, 4) AS raw_cosine_score,
    round(score + CASE WHEN c.intent = q.class THEN 0.15 ELSE 0 END, 4) AS similarity_score,
    c.agent_text, c.customer_text, c.intent, c.auto_handle, c.escalation_reason
  FROM pool p JOIN {corpus} c ON c.id = p.id JOIN {queries} q ON q.query_id = p.query_id),
hits AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY similarity_score DESC, r) AS rank FROM lifted
  QUALIFY rank <= {k})"""


_TF = f"""tf AS (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, unnest({sql.words('text')}) AS term FROM documents)
  GROUP BY ALL)"""
_IDF = f"""{_TF}, idf AS (SELECT term, count(*) AS df, sum(tf)::BIGINT AS total,
  ln((1 + (SELECT count(*) FROM documents)) / (1 + count(*))) + 1 AS idf FROM tf GROUP BY term)"""


@query(f"WITH {_IDF} SELECT term, df, round(idf, 9) AS idf FROM idf")
def inverse_document_frequency(spark, folder):
    docs = table(spark, folder, "documents")
    return fit_tfidf(docs, "doc_id", "text", WORDS).terms.select("term", "df", F.round("idf", 9).alias("idf"))


@query(f"WITH {_IDF} SELECT term, total FROM idf ORDER BY total DESC, term LIMIT 10000")
def vocabulary_cap(spark, folder):
    counts = document_frequency(term_counts(table(spark, folder, "documents"), "doc_id", "text", WORDS))
    return vocabulary(counts, 10_000).select("term", "total")


@query(f"""WITH {_IDF}, raw AS (SELECT doc_id, term, (1 + ln(tf)) * idf AS w FROM tf JOIN idf USING (term))
SELECT doc_id AS id, term, round(w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)), 6) AS weight FROM raw""")
def tfidf_weights(spark, folder):
    return tfidf(table(spark, folder, "documents"), "doc_id", "text", WORDS).select(
        "id", "term", F.round("weight", 6).alias("weight"))


# Messages that ask: benchmark texts, and short names that share no term with the corpus.
_ASKED = f"""asked AS (SELECT 'b' || item_id AS query_id, text FROM benchmark UNION ALL SELECT 'n' || n_nationkey, n_name FROM nation),
queries AS (SELECT query_id, text, {sql.best_class(sql.hit_list('text', LANG_RULES), LANGS, DEFAULT_LANG)} AS class FROM asked)"""


def _asked(spark, folder):
    items = table(spark, folder, "benchmark").select(F.concat(F.lit("b"), "item_id").alias("query_id"), "text")
    names = table(spark, folder, "nation").select(F.concat(F.lit("n"), "n_nationkey"), "n_name")
    return items.union(names)


_HIT_COLUMNS = """query_id, rank, id, similarity_score, raw_cosine_score, auto_handle, escalation_reason"""
_TOP_SQL = f"WITH {LANG_CORPUS_SQL}, {_ASKED}, {_top_k('queries', 'lang_corpus')} SELECT {_HIT_COLUMNS} FROM hits"


def _top_cases(spark, folder, index, **kwargs):
    asked = _asked(spark, folder).withColumn("class", R.label_class(F.col("text"), LANG_RULES, DEFAULT_LANG)["class"])
    hits = top_k_cases(asked, inputs.lang_corpus(spark, folder), CASES, class_col="class", index=index, **kwargs)
    return flat_cases(hits).select(*_HIT_COLUMNS.split(", "))


@query(_TOP_SQL)
def top_cases(spark, folder):
    """The three most similar documents per message, class bonus, zero-score filling."""
    return _top_cases(spark, folder, inputs.case_index(spark, folder, inputs.lang_corpus, CASES))


@query(_TOP_SQL)
def top_cases_bounded_lists(spark, folder):
    """The same answer from posting lists shown a few at a time, hot terms salted."""
    index = TfidfIndex.build(inputs.lang_corpus(spark, folder), "id", "customer_text", CASES, 20, keep=9)
    return _top_cases(spark, folder, index, depth=30, heavy_rows=20)


@query(f"""WITH {LANG_CORPUS_SQL}, {_ASKED}, {_top_k('queries', 'lang_corpus')}
SELECT query_id AS query, id AS doc, round(score, 6) AS score, r AS rank FROM best""")
def nearest_by_cosine(spark, folder):
    """Pool of nine per message by raw cosine over the inverted index."""
    corpus = inputs.lang_corpus(spark, folder)
    index = TfidfIndex.build(corpus, "id", "customer_text", CASES)
    found = search(_asked(spark, folder), index, "query_id", "text", 9)
    return found.select("query", "doc", F.round("score", 6).alias("score"), "rank")


@query(f"""WITH {LANG_CORPUS_SQL}, {_ASKED}, {_top_k('queries', 'lang_corpus')}
SELECT query_id AS query, id AS doc, round(score, 6) AS score, r AS rank FROM best""")
def saved_index_search(spark, folder):
    """The same pool from an index that was saved and loaded."""
    path = scratch_path(spark, "index")
    TfidfIndex.build(inputs.lang_corpus(spark, folder), "id", "customer_text", CASES).save(path)
    found = search(_asked(spark, folder), TfidfIndex.load(spark, path, CASES), "query_id", "text", 9)
    return found.select("query", "doc", F.round("score", 6).alias("score"), "rank")


_POOL_SQL = f"""WITH {LANG_CORPUS_SQL}, {_ASKED}, {_top_k('queries', 'lang_corpus')}
SELECT query_id AS query, id AS doc, round(score, 6) AS score, r AS rank FROM best"""


def _pool(index, spark, folder):
    found = index.search(_asked(spark, folder), "query_id", "text", 9)
    return found.select("query", "doc", F.round("score", 6).alias("score"), "rank")


@query(_POOL_SQL)
def essential_terms_search(spark, folder):
    """The same pool from posting blocks, down to the level that can still matter."""
    return _pool(CaseIndex.build(inputs.lang_corpus(spark, folder), "id", "customer_text", CASES), spark, folder)


@query(_POOL_SQL)
def grown_index_search(spark, folder):
    """The same pool from an index that grew by two more batches of documents, was compacted, saved and loaded."""
    corpus = inputs.lang_corpus(spark, folder)
    batch = F.pmod(F.xxhash64("id"), F.lit(3))
    index = CaseIndex.build(corpus.filter(batch == 0), "id", "customer_text", CASES)
    for more in (1, 2):
        index = index.extended(corpus.filter(batch == more), "id", "customer_text")
    path = scratch_path(spark, "grown")
    index.compact().save(path)
    return _pool(CaseIndex.load(spark, path, CASES), spark, folder)


# Support messages: a generated message per benchmark item, followed by the item's text.
_INCOMING = f"""{sql.SUPPORT},
made AS ({sql.generated('benchmark', 'item_id')}),
incoming AS (SELECT item_id AS query_id, m.customer_text || ' ' || b.text AS text, intent AS truth, m.agent_text AS reference_reply,
    escalation_reason AS truth_reason, auto_handle AS truth_auto FROM made m JOIN benchmark b ON b.item_id = m.gid),
scored AS (SELECT *, {sql.ascii_words('text')} AS t, {sql.hit_list(sql.ascii_words('text'), rules.BOOST_RULES)} AS s FROM incoming),
queries AS (SELECT *, {sql.best_class('s', list(rules.BOOST_RULES), taxonomy.DEFAULT_CLASS)} AS class FROM scored)"""
_PAST = ("WHEN NOT coalesce(h.auto_handle, true) THEN coalesce(h.escalation_reason, 'PII_SECURITY_DM')")
_REASON = sql.policy_reason("q.t", "0.65", _PAST)
_KEYWORD_WHENS = " ".join(f"WHEN {sql.any_phrase('lower(text)', words)} THEN {sql.lit(reply)}"
                          for words, reply in replies.KEYWORD_REPLIES)
_PIPELINE = f"""{_INCOMING}, {_top_k('queries', 'support')},
judged AS (SELECT q.*, h.similarity_score, h.agent_text AS top_reply, h.auto_handle AS top_auto,
    h.escalation_reason AS top_reason, {_REASON} AS reason,
    ({sql.policy_reason("q.t", "0.65")}) <> 'STANDARD_TROUBLESHOOTING' OR NOT coalesce(h.auto_handle, true) AS escalated
  FROM queries q LEFT JOIN hits h ON h.query_id = q.query_id AND h.rank = 1),
decided AS (SELECT *, CASE WHEN escalated THEN {sql.lookup('reason', replies.ESCALATION_REPLIES, replies.OTHER_ESCALATION_REPLY)}
    WHEN similarity_score > 0.45 THEN top_reply {_KEYWORD_WHENS}
    ELSE {sql.lookup('class', replies.CLASS_REPLIES, replies.OTHER_CLASS_REPLY)} END AS draft_reply FROM judged)"""


def _incoming(spark, folder):
    made = inputs.template_columns(F.col("item_id"))
    return table(spark, folder, "benchmark").select(
        F.col("item_id").alias("query_id"), F.concat(made["customer_text"], F.lit(" "), F.col("text")).alias("text"),
        made["intent"].alias("truth"), (~made["auto_handle"]).alias("truth_escalated"),
        made["agent_text"].alias("reference_reply"))


def _decided(spark, folder):
    index = inputs.case_index(spark, folder, inputs.support, CASES)
    return decide(_incoming(spark, folder), inputs.support(spark, folder), CASES, index=index)


_ESC = "CASE WHEN escalated THEN 'ESCALATE_TO_HUMAN' ELSE 'AUTO_HANDLE' END"


@query(f"""WITH {_PIPELINE} SELECT query_id, class AS predicted_intent, {_ESC} AS decision, reason, round(similarity_score, 4) AS similarity,
  draft_reply FROM decided""")
def triage_decisions(spark, folder):
    """Classify by rules, retrieve, decide, reply."""
    return _decided(spark, folder).select(
        "query_id", "predicted_intent", "escalation.decision", "escalation.reason",
        F.get("top_cases", 0)["similarity_score"].alias("similarity"), "draft_reply")


@query(f"""WITH {_PIPELINE} SELECT query_id, class AS predicted_intent, {sql.lookup('class', taxonomy.CLASS_NAMES, None)} AS intent_name,
  3 AS num_retrieved, reason AS reason_code, draft_reply, '{taxonomy.BRAND_HANDLE}' AS brand FROM decided""")
def triage_envelope(spark, folder):
    """The nested result per message, flattened for comparison."""
    index = inputs.case_index(spark, folder, inputs.support, CASES)
    return triage(_incoming(spark, folder), inputs.support(spark, folder), CASES, index=index).select(
        "query_id", "intent.predicted_intent", "intent.intent_name", "retrieval.num_retrieved",
        "escalation.reason_code", "draft_reply", "meta.brand")


_CLASS_SQL = f"""{sql.SUPPORT}, p AS (SELECT *, {sql.ascii_words('customer_text')} AS t FROM support),
h AS (SELECT *, {sql.hit_list('t', rules.BOOST_RULES)} AS s FROM p),
classified AS (SELECT *, {sql.best_class('s', list(rules.BOOST_RULES), taxonomy.DEFAULT_CLASS)} AS class FROM h)"""


@query(f"""WITH {_CLASS_SQL} SELECT id, class AS predicted_intent, {sql.lookup('class', taxonomy.CLASS_NAMES, None)} AS intent_name,
  0.65::DOUBLE AS confidence, true AS is_confident FROM classified""")
def classify_rules_only(spark, folder):
    found = classify_by_rules(inputs.support(spark, folder), "customer_text", rules.BOOST_RULES)
    return found.select("id", "predicted_intent", "intent_name", "confidence", "is_confident")


_STEPS = {r[0]: r for r in rules.POLICY_RULES}
_CONF = "CASE WHEN seq % 4 = 0 THEN 0.2 ELSE 0.9 END"


@query(f"""WITH {_CLASS_SQL}, e AS (SELECT id, {sql.policy_reason('t', _CONF, "WHEN NOT auto_handle THEN escalation_reason")} AS reason,
  ({sql.policy_reason('t', _CONF)}) AS by_text, auto_handle FROM classified)
SELECT id, reason, CASE WHEN by_text <> 'STANDARD_TROUBLESHOOTING' OR NOT auto_handle THEN 'ESCALATE_TO_HUMAN' ELSE 'AUTO_HANDLE' END AS decision,
  CASE WHEN by_text <> 'STANDARD_TROUBLESHOOTING' THEN {sql.lookup('by_text', {k: v[1] for k, v in _STEPS.items()}, '-')}
       WHEN NOT auto_handle THEN 'MEDIUM' ELSE 'MINIMAL' END AS risk FROM e""")
def escalation_cascade(spark, folder):
    """Every step of the policy: text rules, low confidence, past case, automatic handling."""
    confidence = F.when(F.col("seq") % 4 == 0, 0.2).otherwise(0.9)
    outcome = escalate(F.col("customer_text"), confidence, F.col("auto_handle"), F.col("escalation_reason"))
    return inputs.support(spark, folder).select("id", outcome.alias("e")).select("id", "e.reason", "e.decision", "e.risk")


@query(f"""WITH {_CLASS_SQL}, r AS (SELECT id, CASE WHEN NOT auto_handle
    THEN {sql.lookup('escalation_reason', replies.ESCALATION_REPLIES, replies.OTHER_ESCALATION_REPLY)}
  WHEN seq % 3 = 0 THEN agent_text {_KEYWORD_WHENS.replace('lower(text)', 'lower(customer_text)')}
  ELSE {sql.lookup('intent', replies.CLASS_REPLIES, replies.OTHER_CLASS_REPLY)} END AS reply FROM classified) SELECT * FROM r""")
def draft_replies(spark, folder):
    decision = F.when(F.col("auto_handle"), taxonomy.AUTO_HANDLE).otherwise(taxonomy.ESCALATE)
    similarity = F.when(F.col("seq") % 3 == 0, 0.46).otherwise(0.45)
    reply = draft_reply(F.col("customer_text"), F.col("intent"), decision, F.col("escalation_reason"),
                        F.col("agent_text"), similarity)
    return inputs.support(spark, folder).select("id", reply.alias("reply"))


@query(f"""SELECT doc_id, (SELECT lang FROM documents GROUP BY lang ORDER BY count(*) DESC, lang LIMIT 1) AS class,
  'AUTO_HANDLE' AS decision, {sql.lit(replies.CANNED_REPLY)} AS reply FROM documents""")
def majority_baseline_answers(spark, folder):
    docs = table(spark, folder, "documents")
    answered = docs.withColumn("_major", majority_class(docs, "lang"))
    return answered.select("doc_id", majority_baseline(F.col("_major")).alias("a")).select(
        "doc_id", "a.class", "a.decision", "a.reply")


_KW_CLASS = sql.best_class(sql.phrase_list("lower(customer_text)", rules.BASELINE_KEYWORDS), list(rules.BASELINE_KEYWORDS),
                           taxonomy.DEFAULT_CLASS)
_KW_ESC = sql.any_phrase("lower(customer_text)", rules.BASELINE_ESCALATION_WORDS)


@query(f"""WITH {sql.SUPPORT}, k AS (SELECT id, {_KW_CLASS} AS class, {_KW_ESC} AS e FROM support)
SELECT id, class, CASE WHEN e THEN 'ESCALATE_TO_HUMAN' ELSE 'AUTO_HANDLE' END AS decision,
  CASE WHEN e THEN 'PII_SECURITY_DM' ELSE 'STANDARD_TROUBLESHOOTING' END AS reason,
  {sql.lit(replies.KEYWORD_REPLY_HEAD)} || replace(lower(class), '_', ' ') || {sql.lit(replies.KEYWORD_REPLY_TAIL)} ||
  CASE WHEN e THEN {sql.lit(replies.KEYWORD_REPLY_DM)} ELSE '' END AS reply FROM k""")
def keyword_baseline_answers(spark, folder):
    return inputs.support(spark, folder).select("id", keyword_baseline(F.col("customer_text")).alias("a")).select("id", "a.*")


# ---- evaluation of the three systems ----

_SYSTEMS = f"""{_PIPELINE},
k AS (SELECT *, {_KW_CLASS.replace('customer_text', 'text')} AS kw, {_KW_ESC.replace('customer_text', 'text')} AS kw_esc FROM decided),
preds AS (
  SELECT {sql.lit(B.SYSTEMS[0])} AS system, query_id, text, truth, NOT truth_auto AS truth_escalated, {sql.lit(taxonomy.CLASSES[0])} AS predicted,
    false AS predicted_escalated, {sql.lit(replies.CANNED_REPLY)} AS reply FROM k
  UNION ALL SELECT {sql.lit(B.SYSTEMS[1])}, query_id, text, truth, NOT truth_auto, kw, kw_esc,
    {sql.lit(replies.KEYWORD_REPLY_HEAD)} || replace(lower(kw), '_', ' ') || {sql.lit(replies.KEYWORD_REPLY_TAIL)} ||
    CASE WHEN kw_esc THEN {sql.lit(replies.KEYWORD_REPLY_DM)} ELSE '' END FROM k
  UNION ALL SELECT {sql.lit(B.SYSTEMS[2])}, query_id, text, truth, NOT truth_auto, class, escalated, draft_reply FROM k)"""


@query(f"WITH {_SYSTEMS} SELECT system, query_id, truth, predicted, truth_escalated, predicted_escalated, reply FROM preds")
def system_predictions(spark, folder):
    return B.predictions(_decided(spark, folder)).select(
        "system", "query_id", "truth", "predicted", "truth_escalated", "predicted_escalated", "reply")


_RUBRIC = sql.rubric("lower(text)", "lower(reply)")


@query(f"""WITH {_SYSTEMS} SELECT system, query_id, predicted AS intent,
  CASE WHEN predicted_escalated THEN 'ESCALATE_TO_HUMAN' ELSE 'AUTO_HANDLE' END AS escalation,
  {", ".join(f"{e} AS {n}" for n, e in _RUBRIC.items())} FROM preds""")
def compare_systems(spark, folder):
    """Side-by-side answers with rubric scores, unfolded to one row per system."""
    wide = B.compare_systems(_decided(spark, folder))
    sides = F.array(*[F.struct(F.lit(name).alias("system"), F.col(f"{c}.intent").alias("intent"),
                               F.col(f"{c}.escalation").alias("escalation"), F.col(f"{c}.judge_score").alias("j"))
                      for name, c in zip(B.SYSTEMS, ("baseline0", "baseline1", "proposed_agent"))])
    return (wide.select("query_id", F.explode(sides).alias("s")).select("query_id", "s.*")
            .select("system", "query_id", "intent", "escalation", "j.groundedness", "j.brand_voice", "j.actionability", "j.safety"))


@query()
def benchmark_report(spark, folder):
    """All metrics of the three systems, written as JSON and read back."""
    path = scratch_path(spark, "benchmark-report")
    golden = _incoming(spark, folder).select(F.col("text").alias("customer_tweet"))
    report = B.benchmark_report(stored(B.predictions(_decided(spark, folder))), labels=taxonomy.CLASSES,
                                leakage=leakage_report(inputs.support(spark, folder), golden),
                                ratings=tier_rated(spark, folder))
    files.write_json(report, path)
    return files.scan_json_lines(spark, path, "system string, metric_group string, metric string, value double")


@query(f"""WITH {_SYSTEMS}, m AS (SELECT system, count_if(truth_escalated AND predicted_escalated) AS tp,
  count_if(NOT truth_escalated AND predicted_escalated) AS fp, count_if(truth_escalated AND NOT predicted_escalated) AS fn,
  count_if(truth = predicted) AS correct, count(*) AS n FROM preds GROUP BY system),
w AS (SELECT system, correct / n AS accuracy, CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0 END AS precision,
  CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0 END AS recall, CASE WHEN tp + fn > 0 THEN fn / (tp + fn) ELSE 0 END AS high_risk_miss_rate,
  (tp + fn)::DOUBLE AS total_high_risk_count FROM m),
r AS (SELECT system, {", ".join(f"avg({e}) AS {n}" for n, e in _RUBRIC.items())} FROM preds GROUP BY system),
u AS (FROM (UNPIVOT (SELECT system, accuracy::DOUBLE AS accuracy, precision::DOUBLE AS precision, recall::DOUBLE AS recall,
    high_risk_miss_rate::DOUBLE AS high_risk_miss_rate, total_high_risk_count FROM w)
    ON accuracy, precision, recall, high_risk_miss_rate, total_high_risk_count INTO NAME metric VALUE value)
  UNION ALL FROM (UNPIVOT r ON groundedness, brand_voice, actionability, safety INTO NAME metric VALUE value))
SELECT system, metric, round(value, 6) AS value FROM u""")
def benchmark_report_parts(spark, folder):
    """The report's metrics that plain SQL can restate."""
    kept = ["accuracy", "precision", "recall", "high_risk_miss_rate", "total_high_risk_count",
            "groundedness", "brand_voice", "actionability", "safety"]
    report = B.benchmark_report(stored(B.predictions(_decided(spark, folder))))
    return report.filter(F.col("metric").isin(kept)).select("system", "metric", F.round("value", 6).alias("value"))


# ---- linear model ----

@query()
def triage_with_model(spark, folder):
    """The whole pipeline with a fitted model: fit on one part of the documents, decide on the benchmark's messages."""
    corpus = inputs.lang_corpus(spark, folder)
    model = fit_classifier(inputs.halves(corpus, "id")[0], "customer_text", "intent", LANGS, CLASSIFIER_TERMS)
    messages = table(spark, folder, "benchmark").select(F.col("item_id").alias("query_id"), "text")
    found = decide(messages, corpus, CASES, rules=LANG_RULES, model=model, names=dict(zip(LANGS, LANGS)),
                   index=inputs.case_index(spark, folder, inputs.lang_corpus, CASES))
    return found.select("query_id", "predicted_intent", F.round("confidence", 6).alias("confidence"), "is_confident",
                        "escalation.decision", "escalation.reason", F.size("top_cases").alias("retrieved"), "draft_reply")


@query()
def classify_with_model(spark, folder):
    """Logistic regression on one part of the documents, blended with rules on the other."""
    train, held = inputs.halves(inputs.lang_corpus(spark, folder), "id")
    model = fit_classifier(train, "customer_text", "intent", LANGS, CLASSIFIER_TERMS)
    found = model.classify(held.select("id", "customer_text", "intent"), "id", "customer_text", LANG_RULES,
                           names=dict(zip(LANGS, LANGS)))
    return found.select("id", "intent", "predicted_intent", "confidence", "is_confident", "heuristic_match",
                        F.map_entries("probabilities").alias("probabilities"))


# A linear model whose coefficients plain SQL can restate: how much likelier than overall a class's documents hold a term.
_LIFT_WEIGHT = 0.02  # keeps probabilities away from 0 and 1


def _grams_upto(tokens: str, n: int) -> str:
    return " UNION ALL ".join(
        f"SELECT id, unnest([{' || chr(32) || '.join(f'w[i + {k}]' for k in range(size))} for i in range(1, len(w) - {size - 2})]) AS term "
        f"FROM {tokens}" for size in range(1, n + 1))


def _linear_sql(asked: str) -> str:
    """CTEs from the training half to c(id, p, scores): probabilities and blended scores of ``asked`` (id, text)."""
    terms = f"""l_t AS (SELECT id, intent, {sql.words('customer_text')} AS w FROM train),
l_tf AS (SELECT id, term, count(*) AS tf FROM ({_grams_upto('l_t', CLASSIFIER_TERMS.high)}) GROUP BY ALL),
l_idf AS (SELECT term, count(*) AS df, ln((1 + (SELECT count(*) FROM train)) / (1 + count(*))) + 1 AS idf
  FROM l_tf GROUP BY term ORDER BY sum(tf) DESC, term LIMIT {CLASSIFIER_TERMS.max_terms}),
l_n AS (SELECT intent, count(*) AS n FROM train GROUP BY intent),
l_df AS (SELECT term, intent, count(*) AS dfc FROM l_tf JOIN train USING (id) SEMI JOIN l_idf USING (term) GROUP BY ALL),
l_coef AS (SELECT i.term, n.intent, {_LIFT_WEIGHT} * (ln((coalesce(dfc, 0) + 1) / (n + 2)) -
    ln((df + 1) / ((SELECT count(*) FROM train) + 2))) AS weight
  FROM l_idf i CROSS JOIN l_n n LEFT JOIN l_df d ON d.term = i.term AND d.intent = n.intent),
a_t AS (SELECT id, {sql.words('text')} AS w FROM {asked}),
a_w AS (SELECT id, term, (1 + ln(count(*))) * any_value(idf) AS w
  FROM ({_grams_upto('a_t', CLASSIFIER_TERMS.high)}) JOIN l_idf USING (term) GROUP BY id, term),
a_len AS (SELECT id, sqrt(sum(w * w)) AS len FROM a_w GROUP BY id),
a_dot AS (SELECT id, intent, sum(w * weight) AS dot FROM a_w JOIN l_coef USING (term) GROUP BY id, intent),
a_logit AS (SELECT a.id, n.intent, ln(n / (SELECT count(*) FROM train)) + coalesce(dot / len, 0) AS z
  FROM {asked} a CROSS JOIN l_n n LEFT JOIN a_dot d ON d.id = a.id AND d.intent = n.intent LEFT JOIN a_len l ON l.id = a.id),
a_p AS (SELECT id, intent, exp(z) / sum(exp(z)) OVER (PARTITION BY id) AS p FROM a_logit),
a_hit AS (SELECT id, text, {sql.hit_list('text', LANG_RULES)} AS hit FROM {asked})"""
    shares = ", ".join(f"coalesce(max(p) FILTER (intent = {sql.lit(c)}), 0)" for c in LANGS)
    return f"""{terms},
a_wide AS (SELECT id, [{shares}] AS p FROM a_p GROUP BY id),
a_mix AS (SELECT id, text, hit, [p[i] + 0.18 * hit[i] for i in range(1, {len(LANGS) + 1})] AS m FROM a_wide JOIN a_hit USING (id)),
c AS (SELECT id, text, hit, [round(v / list_sum(m), 4) for v in m] AS scores FROM a_mix)"""


_SCORED = f"""{sql.best_class('scores', LANGS, DEFAULT_LANG)} AS class, list_max(scores) AS confidence"""


def _lift_model(train) -> ClassModel:
    fitted = fit_tfidf(train, "id", "customer_text", CLASSIFIER_TERMS)
    terms = stored(fitted.terms, "lift-terms")
    tf = term_counts(train, "id", "customer_text", CLASSIFIER_TERMS, carry=("intent",), known=fitted.known)
    by_class = tf.groupBy("term", "intent").agg(F.count("*").alias("dfc"))
    sizes = {r["intent"]: r["count"] for r in train.groupBy("intent").count().collect()}
    rows = sum(sizes.values())
    size = F.create_map(*[F.lit(x) for pair in sizes.items() for x in pair])
    every = terms.select("term", "df", F.explode(F.array(*map(F.lit, sizes))).alias("intent"))
    lifts = every.join(by_class, ["term", "intent"], "left").select(
        "term", F.col("intent").alias("class"),
        (_LIFT_WEIGHT * (F.log((F.coalesce("dfc", F.lit(0)) + 1) / (size[F.col("intent")] + 2))
                         - F.log((F.col("df") + 1) / F.lit(rows + 2)))).alias("weight"))
    priors = {c: math.log(sizes[c] / rows) if c in sizes else float("-inf") for c in LANGS}
    return ClassModel.from_coefficients(terms, lifts, priors)


@query(f"""WITH {HALVES_SQL}, asked AS (SELECT id, customer_text AS text FROM held), {_linear_sql('asked')},
s AS (SELECT *, {_SCORED} FROM c)
SELECT id, class AS predicted_intent, class AS intent_name, confidence, confidence >= 0.35 AS is_confident,
  hit[list_position(scores, confidence)] > 0 AS heuristic_match,
  {", ".join(f"scores[{i + 1}] AS p_{c}" for i, c in enumerate(LANGS))} FROM s""")
def classify_with_coefficients(spark, folder):
    """A coefficient table joined to the term weights of the held-out part, blended with rules."""
    train, held = inputs.halves(inputs.lang_corpus(spark, folder), "id")
    found = _lift_model(train).classify(held.select("id", "customer_text"), "id", "customer_text", LANG_RULES,
                                        names=dict(zip(LANGS, LANGS)))
    return found.select("id", "predicted_intent", "intent_name", "confidence", "is_confident", "heuristic_match",
                        *[F.col("probabilities")[c].alias(f"p_{c}") for c in LANGS])


_MODEL_PAST = "WHEN NOT coalesce(h.auto_handle, true) THEN coalesce(h.escalation_reason, 'PII_SECURITY_DM')"


@query(f"""WITH {HALVES_SQL}, asked AS (SELECT item_id AS id, text FROM benchmark), {_linear_sql('asked')},
queries AS (SELECT id AS query_id, text, {sql.ascii_words('text')} AS t, {_SCORED} FROM c), {_top_k('queries', 'lang_corpus')},
judged AS (SELECT q.*, h.similarity_score, h.agent_text AS top_reply, {sql.policy_reason('q.t', 'q.confidence', _MODEL_PAST)} AS reason,
    ({sql.policy_reason('q.t', 'q.confidence')}) <> 'STANDARD_TROUBLESHOOTING' OR NOT coalesce(h.auto_handle, true) AS escalated
  FROM queries q LEFT JOIN hits h ON h.query_id = q.query_id AND h.rank = 1)
SELECT query_id, class AS predicted_intent, confidence, confidence >= 0.35 AS is_confident, reason,
  {_ESC} AS decision, round(similarity_score, 4) AS similarity,
  CASE WHEN escalated THEN {sql.lookup('reason', replies.ESCALATION_REPLIES, replies.OTHER_ESCALATION_REPLY)}
    WHEN similarity_score > 0.45 THEN top_reply {_KEYWORD_WHENS}
    ELSE {sql.lookup('class', replies.CLASS_REPLIES, replies.OTHER_CLASS_REPLY)} END AS draft_reply FROM judged""")
def triage_with_coefficients(spark, folder):
    """The whole pipeline on a coefficient table: classify, retrieve by the predicted class, decide, reply."""
    corpus = inputs.lang_corpus(spark, folder)
    messages = table(spark, folder, "benchmark").select(F.col("item_id").alias("query_id"), "text")
    found = decide(messages, corpus, CASES, rules=LANG_RULES, model=_lift_model(inputs.halves(corpus, "id")[0]),
                   names=dict(zip(LANGS, LANGS)), index=inputs.case_index(spark, folder, inputs.lang_corpus, CASES))
    return found.select("query_id", "predicted_intent", "confidence", "is_confident", "escalation.reason",
                        "escalation.decision", F.get("top_cases", 0)["similarity_score"].alias("similarity"), "draft_reply")
