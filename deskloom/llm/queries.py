"""Registered queries of this package: name -> Spark callable, name -> oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from deskloom.llm import (decontaminate, filteraudit, infill, langid, lm, mixing, neardup, pii, quality, substrings, tokenids,
                          toxicity, vectors)
from deskloom.llm.words import in_fold, short_batches

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None):
    """Register a query under its function name, with its oracle SQL if it has one."""

    def register(function: Query) -> Query:
        QUERIES[function.__name__] = function
        if sql is not None:
            ORACLE[function.__name__] = sql
        return function

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    short_batches(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")


_WORDS = r"regexp_extract_all({}, '[^\x20\x09-\x0D]+')"
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


@query(f"""WITH RECURSIVE w AS (SELECT doc_id, {_WORDS.format(_LOWER)} AS ws FROM documents),
places AS (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 3, 2))) AS i FROM w WHERE len(ws) > 0),
sets AS (SELECT DISTINCT doc_id, md5(array_to_string(ws[i:i + 4], ' ')) AS s FROM places),
sizes AS (SELECT doc_id, count(*) AS n FROM sets GROUP BY doc_id),
pairs AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM sets a JOIN sets b ON a.s = b.s AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (SELECT x, y FROM pairs JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y WHERE 100 * c >= 75 * (p.n + q.n - c)),
edges AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reach AS (SELECT doc_id, doc_id AS r FROM documents UNION SELECT edges.y, reach.r FROM reach JOIN edges ON edges.x = reach.doc_id),
found AS (SELECT doc_id, min(r) AS component_id FROM reach GROUP BY doc_id)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, component_id, doc_id = component_id AS kept FROM found LEFT JOIN sizes USING (doc_id)""")
def op1_hyperminhash(spark, folder):
    return neardup.near_duplicates(table(spark, folder, "documents"))


@query(f"""WITH w AS (SELECT doc_id, {_WORDS.format("coalesce(text, '')")} AS ws FROM documents),
places AS (SELECT doc_id, ws, unnest(range(1, len(ws) - 11)) AS i FROM w WHERE len(ws) >= 13),
windows AS (SELECT doc_id, i, md5(array_to_string(ws[i:i + 12], ' ')) AS h FROM places),
repeats AS (SELECT doc_id, i FROM (SELECT *, min(doc_id) OVER (PARTITION BY h) AS first FROM windows) WHERE first < doc_id),
gone AS (SELECT DISTINCT doc_id, i + j AS i FROM repeats, range(13) t(j)),
words AS (SELECT doc_id, unnest(ws) AS word, unnest(range(1, len(ws) + 1)) AS i FROM w),
kept AS (SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY i) AS text FROM words ANTI JOIN gone USING (doc_id, i)
  GROUP BY doc_id)
SELECT doc_id, len(ws)::BIGINT AS n_words, (len(ws) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(kept.text, '')) AS kept_sha256
FROM w LEFT JOIN kept USING (doc_id)""")
def op2_suffix_automata(spark, folder):
    return substrings.remove_repeats(table(spark, folder, "documents"))


@query()
def op3_compression_bands(spark, folder):
    return quality.quality(table(spark, folder, "documents"))


@query()
def op4_attentive_gru(spark, folder):
    docs = table(spark, folder, "documents").withColumn("held_out", in_fold("doc_id", 4, 2))
    labels = table(spark, folder, "labels").filter(~in_fold("doc_id", 4, 2))
    found = toxicity.toxicity(docs, toxicity.fit(docs, labels), carry=("held_out",))
    return found.withColumn("predicted", (F.col("score") >= 0.3).cast("int"))


@query()
def op5_language(spark, folder):
    docs = table(spark, folder, "documents").withColumn("held_out", in_fold("doc_id", 4, 2))
    model = langid.fit_languages(docs.filter(~F.col("held_out")))
    return docs.select("doc_id", "held_out", langid.language(F.col("text"), model).alias("p")).select(
        "doc_id", "held_out", "p.*")


@query()
def op6_backoff_automaton(spark, folder):
    docs = table(spark, folder, "documents").withColumn("held_out", in_fold("doc_id", 5, 1))
    return lm.learned_scores(docs, ~F.col("held_out"), carry=("held_out",))


@query()
def op7_skip_chain_crf(spark, folder):
    docs = table(spark, folder, "documents")
    found = pii.personal_data(docs, pii.fit(docs))
    digest = F.sha2(F.col("base_spans").cast("binary"), 256).alias("base_sha256")
    return found.select("doc_id", "n_email", "n_ip", "n_card", "n_phone", digest, "spans", "n_added")


@query()
def op8_mix(spark, folder):
    drawn = mixing.draws(table(spark, folder, "documents"))
    words = F.aggregate("taken", F.lit(0).cast("long"), lambda total, d: total + d["words"])
    return drawn.select("doc_id", "size", "source_size", "target", words.alias("taken"))


@query()
def op9_template_leaks(spark, folder):
    return decontaminate.leaks(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def vocabulary(name: str = "word_bpe_49k.json") -> str:
    with open(public_tokenizers.path(name), encoding="utf-8") as file:
        return file.read()


@query()
def op10_token_ids(spark, folder):
    files = tokenids.write_tokens(table(spark, folder, "documents"), vocabulary(), end_id=1)
    return tokenids.digests(tokenids.read_tokens(spark, files))


_DRAWN = "('0x' || sha256('42:' || coalesce(doc_id::VARCHAR, ''))[{0}:{0} + 7])::BIGINT"


@query(f"""WITH cut AS (SELECT doc_id, coalesce(text, '') AS t,
  regexp_extract_all(coalesce(text, ''), '[\\x20\\x09-\\x0D]*[^\\x20\\x09-\\x0D]+|[\\x20\\x09-\\x0D]+') AS u,
  {_DRAWN.format(1)} AS h1, {_DRAWN.format(9)} AS h2, {_DRAWN.format(17)} AS h3, {_DRAWN.format(25)} AS h4 FROM documents),
sized AS (SELECT *, len(u) AS n, least(h1 % (len(u) + 1), h2 % (len(u) + 1)) AS a, greatest(h1 % (len(u) + 1), h2 % (len(u) + 1)) AS b,
  CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 50 THEN 'plain'
    WHEN h4 % 100 < 80 THEN 'spm' ELSE 'psm' END AS form FROM cut),
parts AS (SELECT *, array_to_string(u[1:a], '') AS p, array_to_string(u[a + 1:b], '') AS m, array_to_string(u[b + 1:n], '') AS s FROM sized)
SELECT doc_id, n::BIGINT AS n, form, CASE WHEN form <> 'plain' THEN length(p) END::BIGINT AS prefix_chars,
  CASE WHEN form <> 'plain' THEN length(m) END::BIGINT AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
    ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256, sha256(t) AS restored_sha256 FROM parts""")
def op11_infill(spark, folder):
    cut = infill.fill_in_middle(table(spark, folder, "documents"))
    digest = lambda text: F.sha2(text.cast("binary"), 256)
    return cut.select("doc_id", "n", "form", "prefix_chars", "middle_chars", digest(F.col("output")).alias("output_sha256"),
                      digest(infill.restored(F.col("output"), F.col("form"))).alias("restored_sha256"))


@query("""WITH RECURSIVE v AS (SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings),
ok AS (SELECT vec_id, e, sqrt(list_dot_product(e, e)) AS n FROM v WHERE e IS NOT NULL AND len(e) > 0
  AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(e, lambda x: x <> 0)) > 0),
links AS (SELECT a.vec_id AS x, b.vec_id AS y FROM ok a JOIN ok b ON a.vec_id < b.vec_id AND len(a.e) = len(b.e)
  AND list_dot_product(a.e, b.e) / (a.n * b.n) >= 0.9),
edges AS (SELECT x, y FROM links UNION ALL SELECT y, x FROM links),
reach AS (SELECT vec_id, vec_id AS r FROM embeddings UNION SELECT edges.y, reach.r FROM reach JOIN edges ON edges.x = reach.vec_id),
found AS (SELECT vec_id, min(r) AS component_id FROM reach GROUP BY vec_id),
degrees AS (SELECT x, count(*) AS n FROM edges GROUP BY x)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, component_id, vec_id = component_id AS kept
FROM found LEFT JOIN degrees ON x = vec_id""")
def op12_subspace_join(spark, folder):
    return vectors.near_vectors(table(spark, folder, "embeddings"))


@query(r"""WITH d AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t,
  regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
m AS (SELECT part, (len(w) < 100)::INT + 2 * (100 * len(list_distinct(w)) < 80 * len(w))::INT
  + 4 * (100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 10 * length(t))::INT + 8 * regexp_matches(t, '[#$%&*|]')::INT
  + 16 * coalesce(doc_id > min(doc_id) OVER (PARTITION BY t), false)::INT AS mask,
  coalesce((SELECT max((quality = 1)::INT) FROM labels l WHERE l.doc_id = d.doc_id), 0) AS good,
  coalesce((SELECT max((toxic = 1)::INT) FROM labels l WHERE l.doc_id = d.doc_id), 0) AS toxic FROM d),
c AS (SELECT part, mask, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM m GROUP BY ALL),
f AS (SELECT * FROM (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)) v(name, bit)),
o AS (SELECT a.name || b.name || c.name || d.name || e.name AS filter_order, [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits
  FROM f a, f b, f c, f d, f e WHERE len(list_distinct([a.bit, b.bit, c.bit, d.bit, e.bit])) = 5),
s AS (SELECT filter_order, step, bits[step] AS bit, coalesce(list_sum(bits[1:step - 1]), 0)::INT AS before FROM o, range(1, 6) r(step)),
x AS (SELECT part, filter_order, step, bit, sum(n) FILTER (mask & before = 0 AND mask & bit = 0) AS kept,
  sum(n) FILTER (mask & before = 0 AND mask & bit > 0) AS removed, sum(n) FILTER (mask & before > 0 AND mask & bit > 0) AS redundant,
  sum(n) FILTER (mask = bit) AS unique_fails, sum(good) FILTER (mask & before = 0 AND mask & bit > 0) AS good_lost,
  sum(toxic) FILTER (mask & before = 0 AND mask & bit > 0) AS toxic_lost FROM c, s GROUP BY ALL)
SELECT part, filter_order, step::INT AS step, coalesce(kept, 0)::BIGINT AS kept, coalesce(removed, 0)::BIGINT AS removed,
  coalesce(redundant, 0)::BIGINT AS redundant, coalesce(unique_fails, 0)::BIGINT AS unique_fails,
  coalesce(good_lost, 0)::BIGINT AS good_lost, coalesce(toxic_lost, 0)::BIGINT AS toxic_lost,
  coalesce(sum(removed) OVER (PARTITION BY part, bit), 0)::BIGINT AS shapley FROM x""")
def op13_filter_audit(spark, folder):
    return filteraudit.filter_audit(table(spark, folder, "documents"), table(spark, folder, "labels"))
