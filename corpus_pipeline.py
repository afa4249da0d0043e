"""A training corpus from raw documents: language, near-duplicates, benchmark leaks, mixing, token files.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written as Parquet and read again as the next one's
documents. All but the last return the columns of the documents.
"""

from __future__ import annotations

from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from deskloom.llm import decontaminate, langid, mixing, neardup, tokenids
from deskloom.llm.words import in_fold, short_batches
from deskloom.session import recorded_tables, remove_tables, stored

VOCABULARY = "word_bpe_49k.json"
END_ID = 1
_LEFT: list[str] = []  # tables that earlier stages worked with


def stage(function):
    """A stage that first removes what earlier ones have left in the shared folder and its documents don't read."""

    @wraps(function)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        short_batches(spark)
        read = {part for file in docs.inputFiles() for part in file.split("/")}
        used = [path for path in _LEFT if path.rsplit("/", 1)[-1] in read]
        remove_tables(spark, [path for path in _LEFT if path not in used])
        with recorded_tables() as made:
            result = function(spark, docs, sf_dir)
        _LEFT[:] = used + made
        return result

    return run_stage


@stage
def keep_known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised; texts that are null, without letters or undecided go."""
    model = langid.fit_languages(docs.filter(~in_fold("doc_id", 4, 2)))
    return docs.filter(~langid.language(F.col("text"), model)["rejected"])


@stage
def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates; of rows that repeat an id, one; rows without id stay."""
    found = neardup.near_duplicates(docs)
    rest = docs.join(stored(found.filter(~F.col("kept")).select("doc_id"), "dropped"), "doc_id", "left_anti")
    repeated = stored(docs.filter("doc_id IS NOT NULL").groupBy("doc_id").agg(F.count("*").alias("n")).filter("n > 1")
                      .select("doc_id"), "repeated")
    if repeated.isEmpty():
        return rest.select(docs.columns)
    place = F.row_number().over(Window.partitionBy("doc_id").orderBy(F.xxhash64("text"))).alias("place")
    rows = F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row")
    first = rest.join(repeated, "doc_id", "left_semi").select(rows, place).filter("place = 1").select("row.*")
    return rest.join(repeated, "doc_id", "left_anti").select(docs.columns).union(first.select(docs.columns))


@stage
def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item, whatever its numbers, names and units."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return docs.filter(~decontaminate.is_leaky(F.col("text"), benchmark))


@stage
def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of the sources: a document occurs as often as it is taken, in shuffled shards."""
    return mixing.mixed_documents(docs)


@stage
def write_token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token files of the mix, read back: doc_id, start, n_tokens, ids_crc32 of every row."""
    with open(public_tokenizers.path(VOCABULARY), encoding="utf-8") as file:
        files = tokenids.write_tokens(docs, file.read(), end_id=END_ID)
    return tokenids.digests(tokenids.read_tokens(spark, files))


STAGES = [
    ("language", keep_known_language),
    ("near_duplicates", keep_one_of_each_group),
    ("decontamination", drop_benchmark_leaks),
    ("mixing", mix_sources),
    ("token_files", write_token_files),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, apply in STAGES:
        docs = stored(apply(spark, docs, sf_dir), name)
    return docs


ORACLE_SQL = None  # compression, registers and the tokenizer have no SQL form
