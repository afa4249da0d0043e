"""Driver tables in the roles the operators expect."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from deskloom.functions.text import numbered_id
from deskloom.queries.registry import table
from deskloom.sources.synthetic import template_columns

# Function-word rules per language; written without \b so that every engine reads them alike.
_EDGE, _END = r"(^|[^\p{L}\p{N}_])", r"($|[^\p{L}\p{N}_])"
LANG_WORDS = {"en": ["the|and|of", "to|is"], "de": ["der|die|und", "nicht|ich"],
              "fr": ["le|la|les", "et|que|qui"], "es": ["el|los", "que|por|una"]}
LANG_RULES = {lang: [f"{_EDGE}({w}){_END}" for w in words] for lang, words in LANG_WORDS.items()}
LANGS = list(LANG_RULES)
LANG_PHRASES = {"en": [" the ", " of "], "de": [" der ", " und "], "fr": [" le ", " et "], "es": [" el ", " por "]}
DEFAULT_LANG = "en"


def messages(spark: SparkSession, folder: str) -> DataFrame:
    """Conversation turns as a flat message table; each turn answers the one before it."""
    turns = table(spark, folder, "conversations")
    number = F.col("conv_id") * 1000 + F.col("turn")
    return turns.select(
        number.cast("string").alias("tweet_id"), F.col("role").alias("author_id"),
        (F.col("role") != "assistant").alias("inbound"), "text",
        F.when(F.col("turn") > 0, (number - 1).cast("string")).otherwise("").alias("in_response_to_tweet_id"),
        number.alias("seq"))


def replies(spark: SparkSession, folder: str) -> DataFrame:
    return messages(spark, folder).filter(~F.col("inbound"))


def support(spark: SparkSession, folder: str) -> DataFrame:
    """Corpus rows: a generated support message followed by the whole document text."""
    docs = table(spark, folder, "documents")
    made = template_columns(F.col("doc_id"))
    return docs.select(
        numbered_id("synth_", F.col("doc_id")).alias("id"),
        F.concat(made["customer_text"], F.lit(" "), F.col("text")).alias("customer_text"),
        made["intent"].alias("intent"), made["agent_text"].alias("agent_text"),
        made["auto_handle"].alias("auto_handle"), made["escalation_reason"].alias("escalation_reason"),
        "source", F.col("doc_id").alias("seq"), "lang")


def lang_corpus(spark: SparkSession, folder: str) -> DataFrame:
    """Documents as a corpus whose class is the language; every third document (by hash) needs a human."""
    docs = table(spark, folder, "documents")
    human = F.pmod(F.conv(F.substring(F.md5(F.col("doc_id").cast("string")), 1, 4), 16, 10).cast("int"), F.lit(3)) == 0
    return docs.select(
        F.col("doc_id").alias("id"), F.col("text").alias("customer_text"), F.col("lang").alias("intent"),
        F.concat(F.lit("Reply for "), F.col("lang"), F.lit(" case "), F.col("doc_id").cast("string")).alias("agent_text"),
        (~human).alias("auto_handle"),
        F.when(human, "PII_SECURITY_DM").otherwise("STANDARD_TROUBLESHOOTING").alias("escalation_reason"),
        "source", F.col("doc_id").alias("seq"))


def halves(df: DataFrame, id_col: str) -> tuple[DataFrame, DataFrame]:
    """(corpus part, evaluation part): one in eight goes to the evaluation part by hash; no row is dropped."""
    held = F.substring(F.md5(F.col(id_col).cast("string")), 1, 1).isin("0", "1")
    return df.filter(~held), df.filter(held)


def reply_pairs(spark: SparkSession, folder: str) -> DataFrame:
    """(pair_id, candidate, reference): each assistant turn against the turn it answers."""
    turns = table(spark, folder, "conversations")
    asked = turns.select("conv_id", (F.col("turn") + 1).alias("turn"), F.col("text").alias("reference"))
    return (turns.filter(F.col("role") == "assistant").join(asked, ["conv_id", "turn"])
            .select((F.col("conv_id") * 1000 + F.col("turn")).alias("pair_id"),
                    F.col("text").alias("candidate"), "reference"))


# The same inputs for the oracle.
LANG_CORPUS_SQL = """lang_corpus AS (
  SELECT doc_id AS id, text AS customer_text, lang AS intent, 'Reply for ' || lang || ' case ' || doc_id AS agent_text,
         ('0x' || substr(md5(doc_id::VARCHAR), 1, 4))::INT % 3 <> 0 AS auto_handle,
         CASE WHEN ('0x' || substr(md5(doc_id::VARCHAR), 1, 4))::INT % 3 = 0 THEN 'PII_SECURITY_DM'
              ELSE 'STANDARD_TROUBLESHOOTING' END AS escalation_reason, source, doc_id AS seq
  FROM documents)"""
HALVES_SQL = LANG_CORPUS_SQL + """,
train AS (SELECT * FROM lang_corpus WHERE substr(md5(id::VARCHAR), 1, 1) NOT IN ('0', '1')),
held AS (SELECT * FROM lang_corpus WHERE substr(md5(id::VARCHAR), 1, 1) IN ('0', '1'))"""
PAIRS_SQL = """pairs AS (
  SELECT a.conv_id * 1000 + a.turn AS pair_id, a.text AS candidate, b.text AS reference
  FROM conversations a JOIN conversations b ON b.conv_id = a.conv_id AND b.turn = a.turn - 1
  WHERE a.role = 'assistant')"""


_INDEXES: dict[tuple[str, str, str], object] = {}


def case_index(spark: SparkSession, folder: str, corpus, config):
    """The search index of one of the corpora above (a function), built once per application and folder."""
    from deskloom.operators.caseindex import CaseIndex

    key = (spark.sparkContext.applicationId, folder, corpus.__name__)
    if key not in _INDEXES:
        _INDEXES[key] = CaseIndex.build(corpus(spark, folder), "id", "customer_text", config)
    return _INDEXES[key]
