"""TF-IDF weights as a long table (id, term, df, weight): sublinear tf, smooth idf, unit length per document."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from deskloom.functions.postings import (FREQUENCIES, LENGTHS, TERM_BLOCK, block_lengths, dealt_postings, summed_runs,
                                         term_blocks, term_runs)
from deskloom.functions.text import bind, drop_words, key_digest, ngrams, text_key, words
from deskloom.functions.vocabulary import Vocabulary, counter, longer_totals, token_totals
from deskloom.operators.skew import HEAVY_ROWS, heavy_keys, skew_join, top_n_per_group
from deskloom.session import row_batches, stored

# Copies of one text an index keeps; searches may ask for pools up to this size.
KEEP_COPIES = 30
# Terms that are sent to every task at most, to count only these.
SENT_TERMS = 1 << 18
# Documents in a block of an index at most, entries of a part of its terms, about, and documents, or blocks, in an Arrow batch.
BLOCK_DOCS = 512
PART_TERMS = 1 << 20
BATCH_DOCS, BATCH_BLOCKS = "128", "2"


@dataclass(frozen=True)
class TfidfConfig:
    """Tokenizer and weighting options."""

    low: int = 1
    high: int = 1
    min_chars: int = 1
    stop_words: Sequence[str] = ()
    max_terms: int | None = None

    def tokens(self, text):
        return drop_words(words(text, self.min_chars), self.stop_words)

    def terms(self, text):
        """Array of all n-grams of a text; stop words go before n-grams are formed."""
        return ngrams(self.tokens(text), self.low, self.high)


# Word 1- to 3-grams, capped vocabulary: features of the class model.
CLASSIFIER_TERMS = TfidfConfig(low=1, high=3, max_terms=10_000)


def retrieval_terms(stop_words: Sequence[str] = ()) -> TfidfConfig:
    """1- and 2-grams of words with at least two characters: features of case retrieval."""
    return TfidfConfig(low=1, high=2, min_chars=2, stop_words=tuple(stop_words))


def spark_stop_words(language: str = "english") -> list[str]:
    """Spark ML's stop-word list, the default where the caller brings none."""
    from pyspark.ml.feature import StopWordsRemover

    return StopWordsRemover.loadDefaultStopWords(language)


def text_digest(text):
    """Key of a text for term weighting: texts that differ in case or outer blanks have the same terms."""
    return key_digest(text_key(F.coalesce(text, F.lit(""))))


def term_counts(docs: DataFrame, id_col: str, text_col: str, config: TfidfConfig, carry: Sequence[str] = (),
                known: Vocabulary | None = None) -> DataFrame:
    """(id, term, tf, carry..). The texts are spread by id before they are cut into n-grams, so the only shuffle moves
    plain texts; counting per (id, term) then needs none. Of a ``known`` vocabulary only its terms are counted."""
    # With a number, the partitions stay apart: texts grow many times when they are cut into n-grams.
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("_text"), *carry).repartition(parts, "id")
    if known is not None:
        # explode_outer: the counts are not made twice, once to see whether there are any.
        rows = texts.select("id", *carry, F.explode_outer(counter(known)(config.tokens(F.col("_text")))).alias("_t")).filter("_t IS NOT NULL")
        return rows.groupBy("id", *carry, F.col("_t.term").alias("term")).agg(F.sum("_t.tf").alias("tf")).select("id", "term", "tf", *carry)
    exploded = texts.select("id", *carry, F.explode(config.terms(F.col("_text"))).alias("term"))
    return exploded.groupBy("id", *carry, "term").agg(F.count("*").alias("tf")).select("id", "term", "tf", *carry)


def counted_terms(terms):
    """Struct(terms, tfs) of an array of terms: equal ones lie side by side once it is sorted."""
    def count(ordered):
        starts = F.filter(F.sequence(F.lit(0), F.size(ordered) - 1), lambda i: (i == 0) | (F.get(ordered, i) != F.get(ordered, i - 1)))
        return bind(F.when(F.size(ordered) > 0, starts).otherwise(F.array().cast("array<int>")), lambda at: F.struct(
            F.transform(at, lambda i: F.get(ordered, i)).alias("terms"),
            F.transform(at, lambda i, n: F.coalesce(F.get(at, n + 1), F.size(ordered)) - i).alias("tfs")))

    return bind(F.sort_array(terms), count)


def document_frequency(tf: DataFrame) -> DataFrame:
    """(term, df, total), combined before the shuffle."""
    return tf.groupBy("term").agg(F.count("*").alias("df"), F.sum("tf").alias("total"))


def vocabulary(frequencies: DataFrame, max_terms: int | None) -> DataFrame:
    """The ``max_terms`` terms with the largest total count (ties by term); all without a cap."""
    if max_terms is None:
        return frequencies
    return frequencies.orderBy(F.desc("total"), "term").limit(max_terms)


def most_frequent(docs: DataFrame, text_col: str, config: TfidfConfig) -> Vocabulary | None:
    """The ``max_terms`` terms of ``vocabulary``, without counting all n-grams. None where that would need too many candidates.

    An n-gram occurs at most as often as its parts. So the least total among the ``max_terms`` most frequent shorter terms bounds
    the longer ones that can be among them, and only n-grams of terms that reach it are counted.
    """
    if config.max_terms is None or config.low != 1:
        return None
    tokens = docs.select(config.tokens(F.col(text_col)).alias("tokens"))
    singles = stored(tokens.mapInArrow(token_totals, "term string, n bigint").groupBy("term").agg(F.sum("n").alias("n")), "totals")
    found: list[tuple[str, int]] = []
    fresh = singles
    for n in range(1, config.high + 1):
        top = [r["n"] for r in fresh.orderBy(F.desc("n")).limit(config.max_terms).select("n").collect()]
        totals = sorted([*top, *(x for _, x in found)], reverse=True)[:config.max_terms]
        least = totals[-1] if len(totals) == config.max_terms else 1
        rows = fresh.filter(F.col("n") >= least).limit(SENT_TERMS + 1).collect()
        if len(rows) > SENT_TERMS:
            return None
        if n > 1:
            rows = [(f"{states[r['code'] // size]} {words_[r['code'] % size]}", r["n"]) for r in rows]
        fresh_terms = [t for t, _ in rows]
        found = [(t, x) for t, x in [*found, *rows] if x >= least]
        if n == 1:
            words_, size = sorted(fresh_terms), max(len(fresh_terms), 1)
        if n == config.high or not fresh_terms:
            break
        # Its tokens are numbered like ``words_``, its longest states by the order of their codes.
        tree = Vocabulary.of([*words_, *(fresh_terms if n > 1 else [])])
        states = words_ if n == 1 else spelled(tree)
        counted = tokens.mapInArrow(longer_totals(tree), "code bigint, n bigint").groupBy("code").agg(F.sum("n").alias("n"))
        fresh = stored(counted, "totals")
    found.sort(key=lambda t: (-t[1], t[0].encode()))
    return Vocabulary.of([t for t, _ in found[:config.max_terms]])


def spelled(tree: Vocabulary) -> list[str]:
    """The terms of a vocabulary's longest states."""
    texts = tree.tokens
    for codes in tree.codes:
        texts = [f"{texts[c // len(tree.tokens)]} {tree.tokens[c % len(tree.tokens)]}" for c in codes.tolist()]
    return texts


def smooth_idf(n_docs, df):
    return F.log((1 + n_docs) / (1 + df)) + 1


@dataclass
class TfidfModel:
    """Fitted vocabulary: ``terms`` holds (term, df, idf)."""

    terms: DataFrame
    config: TfidfConfig
    heavy_rows: int = HEAVY_ROWS
    known: Vocabulary | None = None

    def weigh(self, tf: DataFrame) -> DataFrame:
        """Unit-length weights of counted terms; terms outside the vocabulary are dropped."""
        # Hot terms are known from their document frequency; no extra pass finds them.
        hot = heavy_keys(self.terms, "term", self.heavy_rows, rows=F.col("df"))
        joined = skew_join(tf, self.terms, "term", spread="id", heavy=hot)
        raw = joined.withColumn("_w", (1 + F.log(F.col("tf").cast("double"))) * F.col("idf"))
        length = F.sqrt(F.sum(F.col("_w") * F.col("_w")).over(Window.partitionBy("id")))
        return raw.select("id", "term", "df", (F.col("_w") / length).alias("weight"))

    def transform(self, docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
        return self.weigh(term_counts(docs, id_col, text_col, self.config, known=self.known))


def fit_tfidf(docs: DataFrame, id_col: str, text_col: str, config: TfidfConfig,
              tf: DataFrame | None = None) -> TfidfModel:
    """Vocabulary with idf; pass counted terms (``tf``) to avoid counting them again."""
    known = most_frequent(docs, text_col, config) if tf is None else None
    tf = term_counts(docs, id_col, text_col, config, known=known) if tf is None else tf
    n_docs = docs.agg(F.count("*")).scalar()
    kept = vocabulary(document_frequency(tf), config.max_terms)
    return TfidfModel(kept.select("term", "df", smooth_idf(n_docs, F.col("df")).alias("idf")), config, known=known)


def tfidf(docs: DataFrame, id_col: str, text_col: str, config: TfidfConfig) -> DataFrame:
    """Fit on the documents and weigh them; the texts are tokenised once, into a stored term-count table."""
    tf = stored(term_counts(docs, id_col, text_col, config), "tf")
    return fit_tfidf(docs, id_col, text_col, config, tf).weigh(tf)


def of_vocabulary(counts: DataFrame, max_terms: int) -> DataFrame:
    """(id, copies, terms, tfs) with the ``max_terms`` terms of ``vocabulary`` only."""
    flat = counts.select("id", "copies", F.inline(F.arrays_zip("terms", "tfs"))).toDF("id", "copies", "term", "tf")
    rows = flat.groupBy("id", "copies", "term").agg(F.sum("tf").cast("int").alias("tf"))
    frequencies = rows.groupBy("term").agg(F.sum("copies").alias("df"), F.sum(F.col("tf") * F.col("copies")).alias("total"))
    kept = stored(vocabulary(frequencies, max_terms).select("term"), "vocabulary")
    own = rows.join(kept, "term", "left_semi").groupBy("id", "copies").agg(F.collect_list(F.struct("term", "tf")).alias("_t"))
    return own.select("id", "copies", F.col("_t.term").alias("terms"), F.col("_t.tf").alias("tfs"))


def lists_per_id(counts: DataFrame, repeated: DataFrame) -> DataFrame:
    """(id, terms, tfs, copies), one row per id, from (id, copies, terms, tfs). Texts that share an id, or have none, are one document:
    its ``copies`` has a number for each term, that of others one for all terms."""
    again = counts["id"].eqNullSafe(repeated["id"])
    flat = counts.join(repeated, again, "left_semi").select("id", "copies", F.inline(F.arrays_zip("terms", "tfs")))
    terms = flat.toDF("id", "copies", "term", "tf").groupBy("id", "copies", "term").agg(F.sum("tf").cast("int").alias("tf"))
    merged = terms.groupBy("id").agg(F.collect_list(F.struct("term", "tf", "copies")).alias("_t")).select(
        "id", F.col("_t.term").alias("terms"), F.col("_t.tf").alias("tfs"), F.col("_t.copies").alias("copies"))
    plain = counts.join(repeated, again, "left_anti").select("id", "terms", "tfs", F.array("copies").alias("copies"))
    return plain.unionByName(merged)


def weighed_blocks(vectors: DataFrame, n_docs: int, docs: int, part_terms: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The blocks of (id, terms, tfs, copies), the frequencies of their terms, and the lengths of their documents."""
    spark = vectors.sparkSession
    schema = TERM_BLOCK.format(kind=dict(vectors.dtypes)["id"])
    with row_batches(spark, BATCH_DOCS):
        blocks = stored(vectors.select("id", "terms", "tfs", "copies").mapInArrow(term_blocks(docs), schema), "blocks", "zstd")
    with row_batches(spark, BATCH_BLOCKS):
        entries = blocks.agg(F.sum(F.size("sizes"))).first()[0] or 0
        parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-entries // part_terms))
        runs = blocks.select("block", "terms", "dfs").mapInArrow(term_runs(parts), "part int, block bigint, terms binary, dfs binary")
        frequencies = stored(runs.groupBy("part").applyInArrow(summed_runs, FREQUENCIES), "frequencies", "zstd")
        dealt = blocks.select("block", F.size("ids").alias("n"), "terms", "sizes", "places", "tfs").mapInArrow(
            dealt_postings(parts), "block bigint, n int, sizes binary, places binary, tfs binary")
        back = frequencies.filter("block IS NOT NULL").select("block", "part", "dfs")
        lengths = dealt.groupBy("block").cogroup(back.groupBy("block")).applyInArrow(block_lengths(n_docs), LENGTHS)
        return blocks, frequencies, stored(lengths, "lengths")


def known_terms(frequencies: DataFrame) -> DataFrame:
    """(term, df) from the frequencies of blocks."""
    return frequencies.filter("block IS NULL").select(F.inline(F.arrays_zip("terms", "df"))).toDF("term", "df")


@dataclass
class TfidfIndex:
    """Stored search tables, built once and searched by many message batches.

    Copies of a text are indexed once, under their lowest document id. Documents lie in ``blocks`` (see ``functions.postings``) with
    posting lists of their own; ``lengths`` has the lengths of their vectors, block by block; the model's ``terms`` count all
    copies. Terms leave their block once, in sorted runs, to be counted, and only the counts come back. ``members`` holds (id, copy)
    with the ``keep`` lowest document ids per text: of equally scored copies no others can be among the ``keep`` best.
    """

    model: TfidfModel
    blocks: DataFrame
    lengths: DataFrame
    members: DataFrame
    keep: int = KEEP_COPIES

    TABLES = ("blocks", "lengths", "members")

    @classmethod
    def build(cls, docs: DataFrame, id_col: str, text_col: str, config: TfidfConfig,
              heavy_rows: int = HEAVY_ROWS, keep: int = KEEP_COPIES) -> "TfidfIndex":
        lowered = F.lower(F.coalesce(F.col(text_col), F.lit("")))
        keyed = docs.select(F.col(id_col).alias("id"), text_digest(F.col(text_col)).alias("key"), lowered.alias("_text"))
        keys = stored(keyed.select("key", "id"), "keys")
        texts = keyed.groupBy("key").agg(F.min("id").alias("id"), F.first("_text").alias("_text"), F.count("*").alias("copies"))
        counted = texts.select("id", "copies", counted_terms(config.terms(F.col("_text"))).alias("_c"))
        counts = counted.select("id", "copies", "_c.terms", "_c.tfs").filter(F.size("terms") > 0)
        if config.max_terms is not None:
            counts = of_vocabulary(stored(counts, "counts", "zstd"), config.max_terms)
        firsts = keys.groupBy("key").agg(F.min("id").alias("id")).groupBy("id").agg(F.count("*").alias("n"))
        repeated = stored(firsts.filter("n > 1").select("id"), "repeated")
        if repeated.isEmpty():
            vectors = counts.withColumn("copies", F.array("copies"))
        else:
            vectors = lists_per_id(stored(counts, "counts", "zstd"), repeated)
        n_docs = keys.count()
        blocks, frequencies, lengths = weighed_blocks(vectors, n_docs, BLOCK_DOCS, PART_TERMS)
        model = TfidfModel(known_terms(frequencies).select("term", "df", smooth_idf(F.lit(n_docs), F.col("df")).alias("idf")), config, heavy_rows)
        lowest = top_n_per_group(keys, ["key"], [F.col("id")], keep, spread="id")
        members = lowest.select(F.min("id").over(Window.partitionBy("key")).alias("id"), F.col("id").alias("copy"))
        return cls(model, blocks, lengths, stored(members, "members"), keep)

    def save(self, path: str) -> None:
        with row_batches(self.blocks.sparkSession, BATCH_BLOCKS):
            self.model.terms.write.parquet(f"{path}/terms", compression="zstd")
            self.blocks.write.parquet(f"{path}/blocks", compression="zstd")
        for name in ("lengths", "members"):
            getattr(self, name).write.parquet(f"{path}/{name}", compression="zstd")
        self.members.sparkSession.range(1).select(F.lit(self.keep).alias("keep")).write.parquet(f"{path}/settings")

    @classmethod
    def load(cls, spark: SparkSession, path: str, config: TfidfConfig) -> "TfidfIndex":
        """A saved index; how many copies per text it holds was saved with it, so a larger pool is refused."""
        return cls(TfidfModel(spark.read.parquet(f"{path}/terms"), config), *(spark.read.parquet(f"{path}/{n}") for n in cls.TABLES),
                   spark.read.parquet(f"{path}/settings").first()["keep"])
