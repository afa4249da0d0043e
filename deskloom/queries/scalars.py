"""Sources, scalar functions and predicates."""

from __future__ import annotations

from pyspark.sql import functions as F

from deskloom import schemas
from deskloom.functions import rules as R
from deskloom.functions import scores as S
from deskloom.functions import text as T
from deskloom.operators.pairing import brand_replies, outbound, replies_by_signal
from deskloom.operators.skew import top_n_per_group
from deskloom.operators.tfidf import spark_stop_words
from deskloom.plans.triage import split_blank
from deskloom.presets import cases, rules, taxonomy
from deskloom.queries import inputs, sql
from deskloom.queries.registry import query, table
from deskloom.session import scratch_path, stored
from deskloom.sources import files, literals, synthetic


@query(f"WITH {sql.MESSAGES} SELECT tweet_id, author_id, inbound, text, in_response_to_tweet_id FROM messages")
def scan_messages_csv(spark, folder):
    """Messages written to CSV (ids as '12.0', quotes and line breaks in texts) and scanned back."""
    return _csv_back(spark, folder, files.scan_messages_csv)


@query(f"WITH {sql.MESSAGES} SELECT tweet_id, author_id, inbound, text, in_response_to_tweet_id FROM messages")
def scan_messages_csv_by_ranges(spark, folder):
    """The same scan, each file read by as many tasks as it has splits."""
    return _csv_back(spark, folder, files.scan_messages_csv_by_ranges)


@query("SELECT doc_id, text, lang, source FROM documents")
def scan_json_array(spark, folder):
    """Documents written as files of one JSON array each and scanned by ranges."""
    path = scratch_path(spark, "json-arrays")
    docs = table(spark, folder, "documents").select("doc_id", "text", "lang", "source")
    arrays = (docs.groupBy(F.pmod(F.col("doc_id"), F.lit(64)).alias("part"))
              .agg(F.concat(F.lit("["), F.array_join(F.collect_list(F.to_json(F.struct(*docs.columns))), ","), F.lit("]")).alias("value")))
    arrays.write.partitionBy("part").text(path)
    return files.scan_json_array_by_ranges(spark, f"{path}/*", "doc_id long, text string, lang string, source string")


def _csv_back(spark, folder, scan):
    path = scratch_path(spark, "messages-csv")
    rows = inputs.messages(spark, folder)
    files.write_csv(rows.select(
        F.concat("tweet_id", F.lit(".0")).alias("tweet_id"), "author_id", "inbound", F.lit("").alias("created_at"),
        "text", F.lit(None).cast("string").alias("response_tweet_id"), "in_response_to_tweet_id"), path)
    return scan(spark, path).select(
        "tweet_id", "author_id", "inbound", "text", "in_response_to_tweet_id")


@query(f"WITH {sql.MESSAGES} SELECT author_id, count(*) AS n FROM messages GROUP BY author_id")
def land_messages_parquet(spark, folder):
    """CSV landed once as Parquet, then read column-pruned."""
    csv, parquet = scratch_path(spark, "land-csv"), scratch_path(spark, "land-parquet")
    rows = inputs.messages(spark, folder)
    files.write_csv(rows.select("tweet_id", "author_id", "inbound", F.lit("").alias("created_at"), "text",
                                F.lit("").alias("response_tweet_id"), "in_response_to_tweet_id"), csv)
    return files.land_messages(spark, csv, parquet).groupBy("author_id").agg(F.count("*").alias("n"))


_CORPUS = "id, customer_text, intent, agent_text, auto_handle, escalation_reason, source"


@query(f"WITH {sql.SUPPORT} SELECT {_CORPUS} FROM support")
def corpus_json_round_trip(spark, folder):
    path = scratch_path(spark, "corpus-json")
    files.write_json(inputs.support(spark, folder).select(*_CORPUS.split(", ")), path)
    return files.scan_json_lines(spark, path, schemas.CORPUS)


@query(f"""WITH {sql.TEMPLATE_TABLES}, {sql.values("seeds", "n, customer_text, intent, agent_text, auto_handle, escalation_reason",
       [(i, *row) for i, row in enumerate(cases.SEED_CASES)])},
generated AS ({sql.generated("documents", "doc_id")})
SELECT printf('synth_%05d', n) AS id, customer_text, intent, agent_text, auto_handle, escalation_reason FROM seeds
UNION ALL SELECT printf('synth_%05d', gid + {len(cases.SEED_CASES)}), customer_text, intent, agent_text, auto_handle,
  escalation_reason FROM generated""")
def expand_templates(spark, folder):
    """Seed rows, then one generated row per document id."""
    made = synthetic.generate_rows(table(spark, folder, "documents"), "doc_id", first=len(cases.SEED_CASES))
    return literals.seed_cases(spark).unionByName(made).drop("source")


@query(f"SELECT page_id, {sql.clean("'@' || (100000 + page_id) || '  ' || url || '  ' || html")} AS cleaned FROM pages")
def clean_text(spark, folder):
    raw = F.concat(F.lit("@"), (F.col("page_id") + 100000).cast("string"), F.lit("  "), "url", F.lit("  "), "html")
    return table(spark, folder, "pages").select("page_id", T.clean_text(raw).alias("cleaned"))


@query("""SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 0 THEN '' WHEN o_orderkey % 11 = 0 THEN ''
  ELSE o_custkey::VARCHAR END AS norm FROM orders""")
def norm_id(spark, folder):
    key = F.col("o_orderkey")
    raw = F.when(key % 7 == 0, F.lit(None)).when(key % 11 == 0, "nan").when(
        key % 2 == 0, F.concat(F.lit(" "), F.col("o_custkey").cast("string"), F.lit(".0"))).otherwise(
        F.col("o_custkey").cast("string"))
    return table(spark, folder, "orders").select("o_orderkey", T.norm_id(raw).alias("norm"))


@query("""SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 0 THEN '' WHEN o_orderkey % 11 = 0 THEN ''
  WHEN o_orderkey % 3 = 0 THEN (o_custkey + 0.5)::DOUBLE::VARCHAR ELSE (115700000 + o_custkey)::VARCHAR END AS norm FROM orders""")
def norm_id_of_numbers(spark, folder):
    """Ids that were read as floats, the way CSV readers leave them."""
    key, cust = F.col("o_orderkey"), F.col("o_custkey").cast("double")
    raw = F.when(key % 7 == 0, F.lit(None)).when(key % 11 == 0, F.lit("NaN").cast("double")).when(
        key % 3 == 0, cust + 0.5).otherwise(cust + 115700000)
    return table(spark, folder, "orders").select("o_orderkey", T.norm_id(raw).alias("norm"))


@query(f"SELECT doc_id, {sql.key('text')} AS key FROM documents")
def text_key(spark, folder):
    return table(spark, folder, "documents").select("doc_id", T.text_key(F.col("text")).alias("key"))


@query(f"SELECT doc_id, length({sql.clean('text')}) AS chars FROM documents WHERE length({sql.clean('text')}) >= 15")
def min_length(spark, folder):
    cleaned = table(spark, folder, "documents").select("doc_id", T.clean_text(F.col("text")).alias("text"))
    return cleaned.filter(T.long_enough(F.col("text"))).select("doc_id", F.length("text").alias("chars"))


@query(f"WITH {sql.MESSAGES} SELECT tweet_id, author_id FROM messages WHERE NOT inbound")
def outbound_filter(spark, folder):
    return outbound(inputs.messages(spark, folder)).select("tweet_id", "author_id")


@query(f"WITH {sql.MESSAGES} SELECT tweet_id, text FROM messages WHERE NOT inbound AND author_id = 'assistant'")
def brand_filter(spark, folder):
    return brand_replies(inputs.messages(spark, folder), "assistant", rules.BRAND_SIGNALS).select("tweet_id", "text")


_SIGNAL = inputs.LANG_RULES["en"][0]


@query(f"""WITH {sql.MESSAGES},
sent AS (SELECT *, 'agent' || (seq // 1000 % 17) AS agent FROM messages WHERE NOT inbound),
top AS (SELECT agent FROM sent WHERE regexp_matches(text, '(?i){_SIGNAL}') GROUP BY agent
        ORDER BY count(*) DESC, agent LIMIT 5)
SELECT tweet_id, agent AS author_id FROM sent WHERE agent IN (SELECT agent FROM top)""")
def brand_author_fallback(spark, folder):
    """No author of the brand's name: authors are chosen by how often they write in the brand's vocabulary."""
    agents = inputs.messages(spark, folder).withColumn(
        "author_id", F.concat(F.lit("agent"), F.expr("cast((seq div 1000) % 17 as string)")))
    return replies_by_signal(agents, _SIGNAL).select("tweet_id", "author_id")


@query(rf"""SELECT page_id, {sql.strip("regexp_replace('@' || (100000 + page_id) || ' ' || html, '@[A-Za-z0-9_]+', '', 'g')")}
  AS stripped FROM pages""")
def handle_strip(spark, folder):
    raw = F.concat(F.lit("@"), (F.col("page_id") + 100000).cast("string"), F.lit(" "), "html")
    return table(spark, folder, "pages").select("page_id", T.strip_handles(raw).alias("stripped"))


_HAZARD = rules.LABEL_ESCALATION_RULES["HARDWARE_PHYSICAL_DAMAGE"] + rules.LABEL_RULES["HARDWARE_BATTERY"]


@query(f"""WITH {sql.SUPPORT}, plain AS (SELECT id, {sql.ascii_words('customer_text')} AS t, lang FROM support)
SELECT id, {sql.any_match('t', _HAZARD)} AS hazard, {sql.any_match('t', inputs.LANG_RULES['en'])} AS english FROM plain""")
def regex_any(spark, folder):
    text = F.col("customer_text")
    return inputs.support(spark, folder).select(
        "id", R.matches_any(text, _HAZARD).alias("hazard"), R.matches_any(text, inputs.LANG_RULES["en"]).alias("english"))


@query(f"""WITH {sql.SUPPORT} SELECT id, {sql.any_phrase('lower(customer_text)', rules.BASELINE_ESCALATION_WORDS)} AS any_word,
  {sql.phrase_hits('lower(customer_text)', rules.BASELINE_KEYWORDS['CONNECTIVITY_SETUP'])} AS hits FROM support""")
def substring_any(spark, folder):
    lower = F.lower("customer_text")
    return inputs.support(spark, folder).select(
        "id", R.contains_any(lower, rules.BASELINE_ESCALATION_WORDS).alias("any_word"),
        R.phrase_hits(lower, rules.BASELINE_KEYWORDS["CONNECTIVITY_SETUP"]).alias("hits"))


@query(f"""SELECT token, count(*) AS n, count_if(length(token) >= 2) AS n_two
  FROM (SELECT unnest({sql.words('text')}) AS token FROM documents) GROUP BY token""")
def word_tokens(spark, folder):
    tokens = table(spark, folder, "documents").select(F.explode(T.words(F.col("text"))).alias("token"))
    return tokens.groupBy("token").agg(F.count("*").alias("n"), F.count_if(F.length("token") >= 2).alias("n_two"))


@query(f"""WITH t AS (SELECT doc_id, {sql.words('text')} AS w FROM documents),
g AS (SELECT doc_id, unnest(w) AS gram FROM t
  UNION ALL SELECT doc_id, unnest([w[i] || ' ' || w[i+1] for i in range(1, len(w))]) FROM t
  UNION ALL SELECT doc_id, unnest([w[i] || ' ' || w[i+1] || ' ' || w[i+2] for i in range(1, len(w) - 1)]) FROM t)
SELECT doc_id, count(*) AS n, count(DISTINCT gram) AS n_distinct, min(gram) AS first_gram, max(gram) AS last_gram
FROM g GROUP BY doc_id""")
def word_ngrams(spark, folder):
    return ngram_counts(table(spark, folder, "documents"))


def ngram_counts(docs):
    """(doc_id, n, n_distinct, first_gram, last_gram): row by row; only rows that share an id have their n-grams grouped."""
    grams = T.ngrams(T.words(F.col("text")), 1, 3)
    repeated = stored(docs.groupBy("doc_id").agg(F.count("*").alias("_rows")).filter("_rows > 1")
                      .select(F.col("doc_id").alias("_id")), "repeated")
    same = F.col("doc_id").eqNullSafe(F.col("_id"))
    found = T.bind(grams, lambda g: F.struct(F.size(g).cast("long").alias("n"), F.size(F.array_distinct(g)).cast("long").alias(
        "n_distinct"), F.array_min(g).alias("first_gram"), F.array_max(g).alias("last_gram")))
    single = docs.join(repeated, same, "left_anti").select("doc_id", found.alias("_f")).select("doc_id", "_f.*").filter("n > 0")
    shared = docs.join(repeated, same, "left_semi").select("doc_id", F.explode(grams).alias("gram"))
    counted = shared.groupBy("doc_id", "gram").agg(F.count("*").alias("_n"))
    return single.unionByName(counted.groupBy("doc_id").agg(
        F.sum("_n").alias("n"), F.count("*").alias("n_distinct"), F.min("gram").alias("first_gram"), F.max("gram").alias("last_gram")))


STOP_WORDS = ["the", "and", "of", "to", "is", "in", "on", "at", "by", "for", "with", "that", "this", "was", "are", "as",
              "le", "la", "les", "et", "de", "der", "die", "und", "el", "los", "que", "por", "un", "une", "en"]
_STOPS = ", ".join(sql.lit(w) for w in STOP_WORDS)


@query(f"""SELECT token, count(*) AS n FROM (SELECT unnest({sql.words('text')}) AS token FROM documents)
  WHERE token NOT IN ({_STOPS}) GROUP BY token""")
def stop_word_removal(spark, folder):
    kept = T.drop_words(T.words(F.col("text")), STOP_WORDS)
    tokens = table(spark, folder, "documents").select(F.explode(kept).alias("token"))
    return tokens.groupBy("token").agg(F.count("*").alias("n"))


@query()
def stop_words_default_list(spark, folder):
    """The platform's own English list (rows only: the list lives in Spark)."""
    kept = T.drop_words(T.words(F.col("text")), spark_stop_words())
    tokens = table(spark, folder, "documents").select(F.explode(kept).alias("token"))
    return tokens.groupBy("token").agg(F.count("*").alias("n"))


@query(f"""WITH {sql.SUPPORT} SELECT id, {sql.lookup('intent', taxonomy.CLASS_NAMES, 'Unknown')} AS intent_name,
  {sql.lookup('escalation_reason', taxonomy.ESCALATION_REASONS, taxonomy.UNKNOWN_REASON_TEXT)} AS description FROM support""")
def enum_lookup(spark, folder):
    return inputs.support(spark, folder).select(
        "id", R.lookup(F.col("intent"), taxonomy.CLASS_NAMES, "Unknown").alias("intent_name"),
        R.lookup(F.col("escalation_reason"), taxonomy.ESCALATION_REASONS, taxonomy.UNKNOWN_REASON_TEXT)
        .alias("description"))


@query(f"""WITH {sql.SUPPORT}, {sql.values("tax", "ordinal, class, name", [(i, r[0], r[1]) for i, r in enumerate(taxonomy.TAXONOMY)])}
SELECT ordinal, name, count(id) AS n FROM tax LEFT JOIN support ON intent = class GROUP BY ordinal, name""")
def taxonomy_counts(spark, folder):
    """Corpus rows per taxonomy class, in taxonomy order, empty classes kept."""
    counts = inputs.support(spark, folder).groupBy(F.col("intent").alias("class")).agg(F.count("*").alias("n"))
    return (literals.taxonomy_table(spark).join(counts, "class", "left")
            .select("ordinal", "name", F.coalesce("n", F.lit(0)).alias("n")))


@query(f"""WITH {sql.SUPPORT}, p AS (SELECT id, {sql.ascii_words('customer_text')} AS t FROM support)
SELECT id, {sql.difficulty('t', f"({sql.escalation_label('t')}) IS NOT NULL")} AS difficulty FROM p""")
def difficulty_levels(spark, folder):
    text = F.col("customer_text")
    escalated = R.label_escalation(text, rules.LABEL_ESCALATION_RULES, "-")["escalate"]
    return inputs.support(spark, folder).select(
        "id", R.difficulty(text, escalated, rules.HARD_CASE_PATTERNS).alias("difficulty"))


@query("""SELECT doc_id, printf('real_%05d', doc_id) AS real_id, printf('gold_%03d', doc_id) AS gold_id,
  replace(replace('{device} in {os_ver}', '{device}', source), '{os_ver}', lang) AS filled,
  replace(lower('CASE_OF_' || upper(lang)), '_', ' ') AS phrase FROM documents""")
def id_and_template_formats(spark, folder):
    return table(spark, folder, "documents").select(
        "doc_id", T.numbered_id("real_", F.col("doc_id")).alias("real_id"),
        T.numbered_id("gold_", F.col("doc_id"), 3).alias("gold_id"),
        T.fill_slots(F.lit("{device} in {os_ver}"), device=F.col("source"), os_ver=F.col("lang")).alias("filled"),
        T.class_phrase(F.concat(F.lit("CASE_OF_"), F.upper("lang"))).alias("phrase"))


@query("""WITH p AS (SELECT a.conv_id, row_number() OVER (PARTITION BY a.conv_id ORDER BY a.turn) AS i,
    b.text AS customer_text, a.text AS agent_text
  FROM conversations a JOIN conversations b ON b.conv_id = a.conv_id AND b.turn = a.turn - 1 WHERE a.role = 'assistant')
SELECT c.conv_id, coalesce(string_agg('Historical case ' || i || ':' || chr(10) || '  Customer: ' || substr(customer_text, 1, 200)
    || chr(10) || '  Agent reply: ' || substr(agent_text, 1, 200), chr(10) ORDER BY i) FILTER (i <= 3),
  'No historical cases retrieved.') AS context
FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN p ON p.conv_id = c.conv_id GROUP BY c.conv_id""")
def context_assembly(spark, folder):
    """Grounding text of the first three exchanges of each conversation (200 characters each, as the feature asks)."""
    pairs = inputs.reply_pairs(spark, folder).select(
        F.expr("pair_id div 1000").alias("conv_id"), "pair_id", F.substring("reference", 1, 200).alias("customer_text"),
        F.substring("candidate", 1, 200).alias("agent_text"))
    # Ranked and cut to three before anything is collected.
    first = top_n_per_group(pairs, ["conv_id"], [F.col("pair_id")], 3, spread="pair_id")
    cases_of = first.groupBy("conv_id").agg(F.transform(
        F.array_sort(F.collect_list(F.struct("pair_id", "customer_text", "agent_text"))),
        lambda c: F.struct(c["customer_text"].alias("customer_text"), c["agent_text"].alias("agent_text"))).alias("cases"))
    conversations = table(spark, folder, "conversations").select("conv_id").distinct()
    none = F.array().cast("array<struct<customer_text:string,agent_text:string>>")
    return (conversations.join(cases_of, "conv_id", "left")
            .select("conv_id", T.case_context(F.coalesce("cases", none)).alias("context")))


_UNQUOTED = sql.strip(r"""regexp_replace(regexp_replace(reply, '^"+|"+\z', '', 'g'), '^''+|''+\z', '', 'g')""")


@query(f"""WITH r AS (SELECT doc_id, CASE WHEN doc_id % 3 = 0 THEN '"' || text || '"' WHEN doc_id % 3 = 1
    THEN '''' || text || '''' ELSE source END AS reply FROM documents)
SELECT doc_id, {_UNQUOTED} AS reply
FROM r WHERE length(reply) > 10""")
def reply_post_filter(spark, folder):
    text = F.col("text")
    reply = F.when(F.col("doc_id") % 3 == 0, F.concat(F.lit('"'), text, F.lit('"'))).when(
        F.col("doc_id") % 3 == 1, F.concat(F.lit("'"), text, F.lit("'"))).otherwise(F.col("source"))
    return (table(spark, folder, "documents").select("doc_id", T.reply_or_null(reply).alias("reply"))
            .filter(F.col("reply").isNotNull()))


@query("""SELECT o_orderkey, greatest(1, least(5, o_custkey % 9 - 1))::INT AS groundedness,
  CASE WHEN o_orderkey % 4 = 0 THEN 3 ELSE greatest(1, least(5, o_custkey % 7)) END::INT AS brand_voice,
  greatest(1, least(5, o_orderkey % 6))::INT AS actionability,
  CASE WHEN o_orderkey % 13 = 1 THEN 4 WHEN o_orderkey % 13 = 2 THEN 1 WHEN o_orderkey % 13 = 3 THEN 2 ELSE 3 END AS safety,
  round_even((groundedness + brand_voice + actionability + safety) / 4.0, 2)::DOUBLE AS overall_score,
  o_orderpriority AS reasoning
FROM orders WHERE o_orderkey % 5 <> 0 AND o_orderkey % 13 NOT IN (0, 4, 5, 6, 7, 8, 9, 10, 11)""")
def parse_scores_json(spark, folder):
    """JSON score replies, some fenced, some without a key, some broken or followed by more (dropped here)."""
    key, cust = F.col("o_orderkey"), F.col("o_custkey")
    voice = F.when(key % 4 != 0, F.concat(F.lit('"brand_voice": '), (cust % 7).cast("string"), F.lit(", "))).otherwise("")
    body = F.concat(F.lit('{"groundedness": '), (cust % 9 - 1).cast("string"), F.lit(", "), voice,
                    F.lit('"actionability": '), (key % 6).cast("string"),
                    F.when(key % 13 == 0, ', "safety": "n/a"').when(key % 13 == 1, ', "safety": "4"')
                    .when(key % 13 == 2, ', "safety": true').when(key % 13 == 3, ', "safety": 2.9')
                    .when(key % 13 == 4, ', "safety": null').when(key % 13 == 5, ', "safety": "4.5"')
                    .when(key % 13 == 6, ", 'safety': 4").when(key % 13 == 8, ', "safety": [4]').otherwise(""),
                    F.lit(', "reasoning": "'), F.col("o_orderpriority"), F.lit('"}'),
                    F.when(key % 13 == 7, " That is all.").when(key % 13 == 9, " {}").when(key % 13 == 10, " and {x}")
                    .when(key % 13 == 11, ' // {"a": "}"}').otherwise(""))
    reply = F.when(key % 5 == 0, F.lit("Sorry, no scores.")).when(
        key % 3 == 0, F.concat(F.lit("```json\n"), body, F.lit("\n```"))).otherwise(body)
    parsed = table(spark, folder, "orders").select("o_orderkey", S.parse_scores_json(reply).alias("s"))
    return parsed.filter(F.col("s").isNotNull()).select("o_orderkey", "s.*")


@query(f"""WITH d AS (SELECT doc_id, CASE WHEN doc_id % 5 = 0 THEN chr(9) || ' ' || chr(10) ELSE text END AS text FROM documents)
SELECT doc_id, length({sql.strip('text')}) > 0 AS accepted FROM d""")
def blank_query_check(spark, folder):
    blank = F.when(F.col("doc_id") % 5 == 0, F.lit("\t \n")).otherwise(F.col("text"))
    docs = table(spark, folder, "documents").select("doc_id", blank.alias("text"))
    good, bad = split_blank(docs)
    return (good.select("doc_id", F.lit(True).alias("accepted"))
            .unionByName(bad.select("doc_id", F.lit(False).alias("accepted"))))


@query("""SELECT o_orderkey, round_even(o_custkey / 2.0, 0)::INT AS bin, (o_orderstatus = 'F')::INT AS flag
FROM orders""")
def rounding_and_flags(spark, folder):
    return table(spark, folder, "orders").select(
        "o_orderkey", S.half_even_bin(F.col("o_custkey") / 2.0).alias("bin"),
        S.as_flag(F.col("o_orderstatus") == "F").alias("flag"))
