"""Classification metrics, agreement, percentiles, text overlap."""

from __future__ import annotations

from pyspark.sql import functions as F

from deskloom.functions import rules as R
from deskloom.operators import agreement as A
from deskloom.operators import metrics as M
from deskloom.operators import overlap as O
from deskloom.operators import sketches as S
from deskloom.functions.stem import stem_tokens
from deskloom.functions.text import latin_words
from deskloom.plans import benchmark as B
from deskloom.plans.rubric import rubric_scores
from deskloom.queries import inputs, sql
from deskloom.queries.corpora import TIER_OVERALL, TIER_REPLIES, tier_rated
from deskloom.queries.inputs import DEFAULT_LANG, LANG_PHRASES, LANG_RULES, LANGS, PAIRS_SQL
from deskloom.queries.registry import query, table
from deskloom.session import stored

_BY_RULES = sql.best_class(sql.hit_list("text", LANG_RULES), LANGS, DEFAULT_LANG)
_BY_PHRASES = sql.best_class(sql.phrase_list("lower(text)", LANG_PHRASES), LANGS, DEFAULT_LANG)
PREDICTIONS = f"""preds AS (
  SELECT 'rules' AS system, doc_id, lang AS truth, {_BY_RULES} AS predicted FROM documents
  UNION ALL SELECT 'phrases', doc_id, lang, {_BY_PHRASES} FROM documents
  UNION ALL SELECT 'majority', doc_id, lang, (SELECT lang FROM documents GROUP BY lang ORDER BY count(*) DESC, lang LIMIT 1)
  FROM documents)"""


def predictions(spark, folder):
    """Three language guessers for every document."""
    docs = table(spark, folder, "documents")
    major = docs.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").limit(1).select("lang").scalar()
    guesses = F.array(
        F.struct(F.lit("rules").alias("system"), R.label_class(F.col("text"), LANG_RULES, DEFAULT_LANG)["class"].alias("predicted")),
        F.struct(F.lit("phrases").alias("system"),
                 R.label_keywords(F.col("text"), LANG_PHRASES, DEFAULT_LANG)["class"].alias("predicted")),
        F.struct(F.lit("majority").alias("system"), F.col("_major").alias("predicted")))
    return (docs.withColumn("_major", major).select("doc_id", F.col("lang").alias("truth"), F.explode(guesses).alias("g"))
            .select("g.system", "doc_id", "truth", "g.predicted"))


_COUNTS = f"""{PREDICTIONS},
cells AS (SELECT system, truth, predicted, count(*) AS n FROM preds GROUP BY ALL),
classes AS (SELECT system, truth AS class FROM cells UNION SELECT system, predicted FROM cells),
f AS (SELECT system, class,
    coalesce((SELECT sum(n) FROM cells c WHERE c.system = k.system AND truth = class AND predicted = class), 0) AS hits,
    coalesce((SELECT sum(n) FROM cells c WHERE c.system = k.system AND truth = class), 0) AS support,
    coalesce((SELECT sum(n) FROM cells c WHERE c.system = k.system AND predicted = class), 0) AS guessed FROM classes k)"""


@query(f"""WITH {PREDICTIONS} SELECT system, truth, predicted, count(*) AS n FROM preds GROUP BY ALL""")
def outcome_counts(spark, folder):
    return M.outcome_counts(predictions(spark, folder), "truth", "predicted")


@query(f"""WITH {_COUNTS} SELECT system, round(sum(hits) / sum(support), 6)::DOUBLE AS accuracy,
  round(avg(CASE WHEN support + guessed > 0 THEN 2 * hits / (support + guessed) ELSE 0 END), 6)::DOUBLE AS macro_f1,
  round(sum(support * CASE WHEN support + guessed > 0 THEN 2 * hits / (support + guessed) ELSE 0 END) / sum(support), 6)::DOUBLE
  AS weighted_f1 FROM f GROUP BY system""")
def classification_metrics(spark, folder):
    found = M.classification_metrics(predictions(spark, folder), "truth", "predicted")
    return found.select("system", *[F.round(c, 6).alias(c) for c in ("accuracy", "macro_f1", "weighted_f1")])


@query(f"""WITH {PREDICTIONS}, names AS (SELECT unnest({LANGS!r}) AS name), systems AS (SELECT DISTINCT system FROM preds)
SELECT s.system, t.name AS truth, p.name AS predicted, (SELECT count(*) FROM preds x WHERE x.system = s.system
  AND x.truth = t.name AND x.predicted = p.name) AS n FROM systems s, names t, names p""")
def confusion_matrix(spark, folder):
    return M.confusion_matrix(predictions(spark, folder), "truth", "predicted", LANGS)


@query(f"""WITH {PREDICTIONS} SELECT system, truth, {", ".join(f"count_if(predicted = '{c}') AS {c}" for c in LANGS)}
FROM preds GROUP BY system, truth""")
def confusion_table(spark, folder):
    matrix = M.confusion_matrix(predictions(spark, folder), "truth", "predicted", LANGS)
    return M.confusion_table(matrix, LANGS)


_RISKY = [r"!{2,}", LANG_RULES["fr"][0]]


@query(f"""WITH p AS (SELECT 'rules' AS system, toxic = 1 AS t, {sql.any_match('text', _RISKY)} AS p
  FROM labels JOIN documents USING (doc_id) UNION ALL SELECT 'never', toxic = 1, false FROM labels JOIN documents USING (doc_id)),
c AS (SELECT system, count_if(t AND p) AS tp, count_if(NOT t AND p) AS fp, count_if(t AND NOT p) AS fn FROM p GROUP BY system)
SELECT system, round(CASE WHEN tp + fp > 0 THEN tp / (tp + fp) ELSE 0 END, 6)::DOUBLE AS precision,
  round(CASE WHEN tp + fn > 0 THEN tp / (tp + fn) ELSE 0 END, 6)::DOUBLE AS recall,
  round(CASE WHEN 2 * tp + fp + fn > 0 THEN 2 * tp / (2 * tp + fp + fn) ELSE 0 END, 6)::DOUBLE AS f1_score,
  round(CASE WHEN tp + fn > 0 THEN fn / (tp + fn) ELSE 0 END, 6)::DOUBLE AS high_risk_miss_rate,
  fn AS missed_high_risk_count, tp + fn AS total_high_risk_count FROM c""")
def binary_metrics(spark, folder):
    rows = table(spark, folder, "labels").join(table(spark, folder, "documents"), "doc_id")
    guesses = F.array(F.struct(F.lit("rules").alias("system"), R.matches_any(F.col("text"), _RISKY).alias("p")),
                      F.struct(F.lit("never").alias("system"), F.lit(False).alias("p")))
    preds = rows.select((F.col("toxic") == 1).alias("t"), F.explode(guesses).alias("g")).select("t", "g.*")
    found = M.binary_metrics(preds, "t", "p")
    shares = ["precision", "recall", "f1_score", "high_risk_miss_rate"]
    return found.select("system", *[F.round(c, 6).alias(c) for c in shares], "missed_high_risk_count", "total_high_risk_count")


@query("""SELECT event_type, count(value) AS n, true AS within_bound FROM events GROUP BY 1 HAVING count(value) > 0""")
def merged_percentile_sketches(spark, folder):
    """The 95th percentile per event type from daily sketches, and whether its exact rank is within two per cent."""
    events = table(spark, folder, "events").select("event_type", "value", F.to_date("ts").alias("day"))
    daily = S.value_sketches(events, ["event_type", "day"], "value")
    # Stored, since a sketch made again can differ a little.
    found = stored(S.sketch_percentiles(S.merge_sketches(daily, ["event_type"]), ["event_type"], {"p95": 0.95}), "sketches")
    of_type = found.select(F.col("event_type").alias("_type"), "n", "p95")
    met = events.filter("value IS NOT NULL").join(of_type, F.col("event_type").eqNullSafe(F.col("_type")))
    ranks = met.groupBy("event_type", "n").agg(F.sum((F.col("value") < F.col("p95")).cast("long")).alias("below"),
                                               F.sum((F.col("value") <= F.col("p95")).cast("long")).alias("upto"))
    return ranks.select("event_type", "n", ((F.col("below") <= 0.97 * F.col("n")) & (F.col("upto") >= 0.93 * F.col("n")))
                        .alias("within_bound"))


@query("""SELECT o_orderstatus AS system, round(quantile_cont(o_totalprice, 0.95), 6)::DOUBLE AS p95 FROM orders GROUP BY 1""")
def percentile_95(spark, folder):
    rows = table(spark, folder, "orders").select(F.col("o_orderstatus").alias("system"), "o_totalprice")
    found = M.exact_percentile(rows, "o_totalprice", 0.95, ["system"], "p95")
    return found.select("system", F.round("p95", 6).alias("p95"))


# ---- agreement of two raters ----

RATED = """rated AS (SELECT 6.0 - substr(o_orderpriority, 1, 1)::DOUBLE AS human, floor(o_totalprice / 50000) / 2.0 AS judge FROM orders)"""


def rated(spark, folder):
    return table(spark, folder, "orders").select(
        (6.0 - F.substring("o_orderpriority", 1, 1).cast("double")).alias("human"),
        (F.floor(F.col("o_totalprice") / 50000) / 2.0).alias("judge"))


@query(f"""WITH {RATED}, c AS (SELECT count(*) AS n, corr(human, judge) AS r FROM rated)
SELECT n, round(r, 9) AS pearson_r, round(r * sqrt((n - 2) / (1 - r * r)), 6) AS t_statistic FROM c""")
def pearson(spark, folder):
    found = A.pearson(rated(spark, folder), "human", "judge")
    return found.select("n", F.round("pearson_r", 9).alias("pearson_r"), F.round("t_statistic", 6).alias("t_statistic"))


_RANKS = f"""{RATED}, ranks AS (SELECT rank() OVER (ORDER BY human) + (count(*) OVER (PARTITION BY human) - 1) / 2 AS ra,
  rank() OVER (ORDER BY judge) + (count(*) OVER (PARTITION BY judge) - 1) / 2 AS rb FROM rated)"""


@query(f"WITH {_RANKS} SELECT round(corr(ra, rb), 9) AS spearman_rho FROM ranks")
def spearman(spark, folder):
    return A.spearman(rated(spark, folder), "human", "judge").select(F.round("spearman_rho", 9).alias("spearman_rho"))


@query("""SELECT o_totalprice, count(*) AS n, (min(rk) + (count(*) - 1) / 2.0)::DOUBLE AS average_rank
FROM (SELECT o_totalprice, rank() OVER (ORDER BY o_totalprice) AS rk FROM orders) GROUP BY o_totalprice""")
def average_ranks(spark, folder):
    return A.average_ranks(table(spark, folder, "orders"), "o_totalprice")


_KAPPA = f"""{RATED}, bins AS (SELECT round_even(human, 0)::INT AS a, round_even(judge, 0)::INT AS b FROM rated),
labels AS (SELECT v, row_number() OVER (ORDER BY v) AS i FROM (SELECT a AS v FROM bins UNION SELECT b FROM bins)),
coded AS (SELECT x.i AS i, y.i AS j FROM bins JOIN labels x ON x.v = a JOIN labels y ON y.v = b),
ma AS (SELECT i, count(*) AS n FROM coded GROUP BY i), mb AS (SELECT j, count(*) AS n FROM coded GROUP BY j),
kappa AS (SELECT 1 - (SELECT sum((i - j) ** 2) FROM coded) /
  (SELECT sum(ma.n * mb.n * (ma.i - mb.j) ** 2) / (SELECT count(*) FROM coded) FROM ma, mb) AS k)"""


@query(f"WITH {_KAPPA} SELECT round(k, 9) AS kappa FROM kappa")
def quadratic_kappa(spark, folder):
    binned = rated(spark, folder).select(F.bround("human").cast("int").alias("a"), F.bround("judge").cast("int").alias("b"))
    return A.quadratic_kappa(binned, "a", "b").select(F.round("kappa", 9).alias("kappa"))


_REPORT_SQL = f"""WITH {_KAPPA}, ranks AS (SELECT rank() OVER (ORDER BY human) + (count(*) OVER (PARTITION BY human) - 1) / 2 AS ra,
  rank() OVER (ORDER BY judge) + (count(*) OVER (PARTITION BY judge) - 1) / 2 AS rb FROM rated)
SELECT count(*) AS sample_size, round((SELECT k FROM kappa), 9) AS cohen_kappa_quadratic, round(corr(human, judge), 9) AS pearson_correlation_r,
  round((SELECT corr(ra, rb) FROM ranks), 9) AS spearman_rho,
  round(100.0 * count_if(round_even(human, 0) = round_even(judge, 0)) / count(*), 6)::DOUBLE AS agreement_percentage,
  round(avg(human), 6) AS mean_human_score, round(avg(judge), 6) AS mean_judge_score FROM rated"""


def _report(found):
    return found.select("sample_size", *[F.round(c, 9).alias(c) for c in (
        "cohen_kappa_quadratic", "pearson_correlation_r", "spearman_rho")], *[F.round(c, 6).alias(c) for c in (
            "agreement_percentage", "mean_human_score", "mean_judge_score")])


@query(_REPORT_SQL)
def agreement_report(spark, folder):
    return _report(A.agreement_report(rated(spark, folder), "human", "judge"))


_GAPS = RATED.replace("AS judge FROM orders", "AS judge FROM orders WHERE o_orderkey % 7 <> 0 AND o_orderkey % 11 <> 0")


@query(_REPORT_SQL.replace(RATED, _GAPS))
def agreement_report_with_gaps(spark, folder):
    """Rows that one of the two did not rate count for nothing."""
    key = F.col("o_orderkey")
    rows = table(spark, folder, "orders").select(
        F.when(key % 7 != 0, 6.0 - F.substring("o_orderpriority", 1, 1).cast("double")).alias("human"),
        F.when(key % 11 != 0, F.floor(F.col("o_totalprice") / 50000) / 2.0).alias("judge"))
    return _report(A.agreement_report(rows, "human", "judge"))


_OVERALL = " + ".join(sql.rubric("lower(customer_text)", "lower(model_reply)").values())
_RATINGS = f"""{sql.SUPPORT}, tiers AS (SELECT *, CASE WHEN seq < 20 THEN seq % 3 ELSE (seq - 20) % 3 END AS tier FROM support),
replied AS (SELECT customer_text, CASE tier {TIER_REPLIES} END AS model_reply, {TIER_OVERALL} AS human FROM tiers),
rated AS (SELECT human, round(({_OVERALL}) / 4.0, 2)::DOUBLE AS judge FROM replied)"""


@query(_REPORT_SQL.replace(RATED, _RATINGS))
def rate_and_compare(spark, folder):
    """Ratings with the struct of human scores, rated again by the rubric."""
    return _report(B.rate_and_compare(tier_rated(spark, folder)))


@query(f"""WITH {RATED}, c AS (SELECT count(*) AS n, abs(corr(human, judge)) AS r FROM rated),
k AS (SELECT i, CASE WHEN i IN (0, 200000) THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END AS w FROM range(200001) t(i)),
f AS (SELECT any_value(n) AS n, any_value(r) AS r, sum(w * CASE WHEN i < 200000 THEN
    exp((n - 4) / 2 * ln(1 - (r + (1 - r) * i / 200000) ** 2)) ELSE 0 END) * any_value(1 - r) AS tail,
  sum(w * CASE WHEN i < 200000 THEN exp((n - 4) / 2 * ln(1 - (i / 200000) ** 2)) ELSE 0 END) AS half FROM c, k)
SELECT n, round(tail / half, 9) AS p_value FROM f""")
def pearson_p_value(spark, folder):
    """The oracle integrates the density of r under no correlation."""
    return A.pearson(rated(spark, folder), "human", "judge").select("n", F.round("p_value", 9).alias("p_value"))


# ---- rubric ----

_R = sql.rubric("q", "r")


@query(f"""WITH {sql.SUPPORT}, t AS (SELECT id, lower(customer_text) AS q, lower(agent_text) AS r FROM support
  UNION ALL SELECT 'c' || id, lower(agent_text), lower(customer_text) FROM support),
s AS (SELECT id, {", ".join(f"{e} AS {n}" for n, e in _R.items())} FROM t)
SELECT *, round((groundedness + brand_voice + actionability + safety) / 4.0, 2)::DOUBLE AS overall_score FROM s""")
def rubric(spark, folder):
    """Rubric scores of agent texts, and of the customer texts taken as replies."""
    rows = inputs.support(spark, folder)
    both = rows.select("id", F.col("customer_text").alias("q"), F.col("agent_text").alias("r")).unionByName(
        rows.select(F.concat(F.lit("c"), "id").alias("id"), F.col("agent_text").alias("q"), F.col("customer_text").alias("r")))
    return both.select("id", rubric_scores(F.col("q"), F.col("r")).alias("s")).select("id", "s.*")


@query(f"""WITH {sql.SUPPORT}, t AS (SELECT source AS system, lower(customer_text) AS q, lower(agent_text) AS r FROM support),
s AS (SELECT system, {", ".join(f"{e} AS {n}" for n, e in _R.items())} FROM t)
SELECT system, {", ".join(f"round(avg({n}), 6)::DOUBLE AS mean_{n}" for n in _R)} FROM s GROUP BY system""")
def mean_rubric_per_system(spark, folder):
    scored = inputs.support(spark, folder).select(
        F.col("source").alias("system"), rubric_scores(F.col("customer_text"), F.col("agent_text")).alias("s")).select("system", "s.*")
    found = M.mean_metrics(scored, list(_R))
    return found.select("system", *[F.round(f"mean_{n}", 6).alias(f"mean_{n}") for n in _R])


# ---- text overlap ----

def _grams(tokens: str, n: int) -> str:
    parts = " || ' ' || ".join(f"{tokens}[i + {k}]" if k else f"{tokens}[i]" for k in range(n))
    return f"[{parts} for i in range(1, len({tokens}) - {n - 2})]"


def _overlap(a: str, b: str, orders, min_chars: int = 1) -> str:
    """CTEs: g(pair_id, n, gram, c, r) and o(pair_id, n, hit, cand, ref)."""
    sides = " UNION ALL ".join(
        f"SELECT pair_id, {n} AS n, unnest({_grams(side, n)}) AS gram, {c} AS c, {r} AS r FROM toks"
        for n in orders for side, c, r in (("x", 1, 0), ("y", 0, 1)))
    return f"""toks AS (SELECT pair_id, {a} AS x, {b} AS y FROM pairs),
g AS (SELECT pair_id, n, gram, sum(c) AS c, sum(r) AS r FROM ({sides}) GROUP BY ALL),
o AS (SELECT pair_id, n, sum(least(c, r)) AS hit, sum(c) AS cand, sum(r) AS ref FROM g GROUP BY ALL)"""


_LATIN = "regexp_extract_all(lower({}), '[a-z0-9]+')"
_ROUGE = _overlap(_LATIN.format("candidate"), _LATIN.format("reference"), (1, 2))


def _f(n):
    return (f"coalesce(round((SELECT CASE WHEN cand + ref > 0 THEN 2 * hit / (cand + ref) ELSE 0 END FROM o "
            f"WHERE o.pair_id = p.pair_id AND n = {n}), 6), 0)::DOUBLE")


@query(f"WITH {PAIRS_SQL}, {_ROUGE} SELECT pair_id, {_f(1)} AS rouge1, {_f(2)} AS rouge2 FROM pairs p")
def rouge_n_unstemmed(spark, folder):
    found = O.rouge_n(inputs.reply_pairs(spark, folder), "pair_id", "candidate", "reference", stem=False)
    return found.select("pair_id", F.round("rouge1", 6).alias("rouge1"), F.round("rouge2", 6).alias("rouge2"))


@query()
def rouge_n_stemmed(spark, folder):
    return O.rouge_n(inputs.reply_pairs(spark, folder), "pair_id", "candidate", "reference")


@query()
def rouge_l(spark, folder):
    return O.rouge_l(inputs.reply_pairs(spark, folder), "pair_id", "candidate", "reference")


@query()
def word_stems(spark, folder):
    """Stem counts over all documents: tokens are counted first, so each distinct word is stemmed once."""
    words = table(spark, folder, "documents").select(F.explode(latin_words(F.col("text"))).alias("word"))
    counted = words.groupBy("word").agg(F.count("*").alias("n"))
    stems = counted.select(F.get(stem_tokens(F.array("word")), F.lit(0)).alias("stem"), "n")
    return stems.groupBy("stem").agg(F.sum("n").alias("n"))


_BLEU = _overlap(sql.words("candidate"), sql.words("reference"), (1, 2, 3, 4))


@query(f"""WITH {PAIRS_SQL}, {_BLEU},
w AS (SELECT pair_id, len(x) AS nx, len(y) AS ny FROM toks),
logs AS (SELECT w.pair_id, avg(ln(CASE WHEN coalesce(hit, 0) > 0 THEN hit ELSE 0.1 END / greatest(coalesce(cand, 0), 1))) AS mean_log,
    max(CASE WHEN k.n = 1 THEN coalesce(hit, 0) END) AS hit1
  FROM w CROSS JOIN (VALUES (1), (2), (3), (4)) k(n) LEFT JOIN o ON o.pair_id = w.pair_id AND o.n = k.n GROUP BY w.pair_id)
SELECT pair_id, round(CASE WHEN hit1 = 0 THEN 0 ELSE exp(mean_log) * (CASE WHEN nx > ny THEN 1 ELSE exp(1 - ny / nx) END) END, 6)::DOUBLE
  AS bleu4 FROM w JOIN logs USING (pair_id)""")
def bleu(spark, folder):
    found = O.bleu(inputs.reply_pairs(spark, folder), "pair_id", "candidate", "reference")
    return found.select("pair_id", F.round("bleu4", 6).alias("bleu4"))


_TWO = "list_filter({}, lambda t: length(t) >= 2)"
_COS = _overlap(_TWO.format(sql.words("candidate")), _TWO.format(sql.words("reference")), (1,))


@query(f"""WITH {PAIRS_SQL}, {_COS},
d AS (SELECT pair_id, sum(c * r) AS dot, sum((c * i) ** 2) AS cc, sum((r * i) ** 2) AS rr
  FROM (SELECT *, CASE WHEN c > 0 AND r > 0 THEN 1 ELSE ln(3 / 2) + 1 END AS i FROM g) GROUP BY pair_id)
SELECT pair_id, round(coalesce(CASE WHEN cc > 0 AND rr > 0 THEN dot / (sqrt(cc) * sqrt(rr)) END, 0), 6)::DOUBLE AS semantic_similarity
FROM pairs LEFT JOIN d USING (pair_id)""")
def pair_cosine(spark, folder):
    found = O.pair_cosine(inputs.reply_pairs(spark, folder), "pair_id", "candidate", "reference")
    return found.select("pair_id", F.round("semantic_similarity", 6).alias("semantic_similarity"))


@query()
def text_similarity(spark, folder):
    """All five overlap metrics, stemmed."""
    return O.text_similarity(inputs.reply_pairs(spark, folder), "pair_id", "candidate", "reference")


