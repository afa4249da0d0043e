"""Message classification: linear model on TF-IDF n-grams blended with rule hits, or rules alone."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from deskloom.functions.rules import RuleSet, first_largest, hit_counts, label_class, lookup
from deskloom.functions.scores import normalise, ranked_classes
from deskloom.functions.text import bind
from deskloom.functions.vocabulary import Vocabulary
from deskloom.operators.skew import heavy_keys, skew_join
from deskloom.operators.tfidf import CLASSIFIER_TERMS, TfidfConfig, TfidfModel, fit_tfidf, most_frequent, term_counts
from deskloom.presets import taxonomy
from deskloom.session import stored

RULE_BOOST = 0.18
CONFIDENT = 0.35
RULES_CONFIDENCE = 0.65
# The largest coefficient table that is sent to every task instead of being joined by term.
BROADCAST_BYTES = 64 << 20


def sparse_vector(entries: Column, size: int) -> Column:
    """ML sparse vector from an array of struct(index, value) sorted by index.

    The UDT has no direct cast from a struct; reading its JSON form keeps the conversion inside the JVM. Only the solver
    needs vectors; scoring works on the coefficient table.
    """
    layout = F.struct(F.struct(F.lit(0).alias("type"), F.lit(size).alias("size"),
                               F.transform(entries, lambda e: e["index"]).alias("indices"),
                               F.transform(entries, lambda e: e["value"]).alias("values")).alias("features"))
    schema = T.StructType([T.StructField("features", VectorUDT())])
    return F.from_json(F.to_json(layout), schema)["features"]


def blend(probabilities: Column, hits: Column, boost: float = RULE_BOOST) -> Column:
    """Model probabilities plus ``boost`` per rule hit, normalised, four digits."""
    mixed = F.zip_with(probabilities, hits, lambda p, h: p + boost * h)
    return F.transform(normalise(mixed), lambda p: F.round(p, 4))


def verdict(scores: Column, hits: Column, classes: Sequence[str], names=None) -> dict[str, Column]:
    """Classification columns from blended scores."""
    best = first_largest(scores, classes)
    top = best["class"]
    return {
        "predicted_intent": top,
        "confidence": best["score"],
        "intent_name": lookup(top, names or taxonomy.CLASS_NAMES),
        "probabilities": F.map_from_arrays(F.array(*map(F.lit, classes)), scores),
        "ranked_intents": ranked_classes(scores, classes),
        "is_confident": best["score"] >= CONFIDENT,
        "heuristic_match": F.get(hits, -best["neg_ordinal"]) > 0,
    }


def classify_by_rules(df: DataFrame, text: str, rules: RuleSet, default: str = taxonomy.DEFAULT_CLASS,
                      names=None) -> DataFrame:
    """Classification columns without a model: most rule hits, fixed confidence, one-hot probabilities."""
    classes = list(rules)
    top = F.col("_label.class")
    known = F.array(*map(F.lit, classes))
    columns = {
        "predicted_intent": top,
        "confidence": F.lit(RULES_CONFIDENCE),
        "intent_name": lookup(top, names or taxonomy.CLASS_NAMES),
        "probabilities": F.map_from_arrays(known, F.transform(known, lambda c: F.when(c == top, 1.0).otherwise(0.0))),
        "ranked_intents": F.array(F.struct(top.alias("class"), F.lit(RULES_CONFIDENCE).alias("score"))),
        "is_confident": F.lit(True),
        "heuristic_match": F.lit(True),
    }
    return (df.withColumn("_label", label_class(F.col(text), rules, default))
            .withColumns(columns).drop("_label"))


def class_shares(logits: Column) -> Column:
    """Softmax of an array; a class at minus infinity gets 0."""

    def shifted(values: Column) -> Column:
        top = F.array_max(values)
        return F.transform(values, lambda v: F.exp(v - top))

    return normalise(bind(logits, shifted))


@dataclass
class ClassModel:
    """A linear model as a table: ``terms`` holds (term, df, idf, coefs), one coefficient per class in class order.

    ``intercepts`` has one number per class; a class that training never saw has minus infinity, so probability 0.
    Documents are scored by joining their term counts with this table and summing per class: no vectors are made.
    """

    terms: DataFrame
    intercepts: list[float]
    classes: list[str]
    config: TfidfConfig = CLASSIFIER_TERMS
    broadcast_bytes: int = BROADCAST_BYTES

    @classmethod
    def from_coefficients(cls, terms: DataFrame, coefficients: DataFrame, intercepts: Mapping[str, float],
                          config: TfidfConfig = CLASSIFIER_TERMS) -> "ClassModel":
        """A model from (term, df, idf) and a long table (term, class, weight); what is not listed weighs 0.

        Of repeated (term, class) rows the weights are added up; null weights count as 0, other classes are ignored.
        """
        classes = list(intercepts)
        wide = coefficients.groupBy("term").agg(F.array(*[
            F.coalesce(F.sum(F.when(F.col("class") == c, F.col("weight"))), F.lit(0.0)) for c in classes]).alias("coefs"))
        zero = F.array(*[F.lit(0.0)] * len(classes))
        table = terms.select("term", "df", "idf").join(wide, "term", "left").withColumn("coefs", F.coalesce("coefs", zero))
        return cls(stored(table, "class-model"), [float(intercepts[c]) for c in classes], classes, config)

    def coefficients(self) -> DataFrame:
        """(term, class, weight): the long table."""
        names = F.array(*map(F.lit, self.classes))
        pairs = F.explode(F.arrays_zip(names.alias("class"), F.col("coefs").alias("weight")))
        return self.terms.select("term", pairs.alias("_p")).select("term", "_p.class", "_p.weight")

    def _small(self) -> bool:
        """Whether the table may be sent to every task; its rows and the bytes of its terms are counted first."""
        rows, letters = self.terms.agg(F.count("*"), F.coalesce(F.sum(F.octet_length("term")), F.lit(0))).first()
        return letters + rows * 8 * (len(self.classes) + 4) <= self.broadcast_bytes

    def logits(self, docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
        """(id, logits) of the documents that hold a known term: intercept plus the sum of weight times coefficient.

        The length of a document's vector divides the sums at the end, so one grouping by id, which is how the term
        counts lie already, does everything.
        """
        table = self.terms.select("term", "df", "idf", "coefs")
        if self._small():
            known = Vocabulary.of(sorted({r["term"] for r in table.filter("term IS NOT NULL").select("term").collect()}))
            joined = term_counts(docs, id_col, text_col, self.config, known=known).join(F.broadcast(table), "term")
        else:
            counted = term_counts(docs, id_col, text_col, self.config)
            joined = skew_join(counted, table, "term", spread="id", heavy=heavy_keys(table, "term", rows=F.col("df")))
        raw = joined.withColumn("_w", (1 + F.log(F.col("tf").cast("double"))) * F.col("idf"))
        sums = [F.sum(F.col("_w") * F.get("coefs", F.lit(i))).alias(f"_s{i}") for i in range(len(self.classes))]
        summed = raw.groupBy("id").agg(F.sqrt(F.sum(F.col("_w") * F.col("_w"))).alias("_length"), *sums)
        return summed.select("id", F.array(*[
            F.lit(b) + F.col(f"_s{i}") / F.col("_length") for i, b in enumerate(self.intercepts)]).alias("logits"))

    def classify(self, docs: DataFrame, id_col: str, text_col: str, rules: RuleSet,
                 boost: float = RULE_BOOST, names=None) -> DataFrame:
        """The documents with classification columns. Equal texts are scored once.

        A null or empty text, and one without known terms, has the probabilities of the intercepts.
        """
        asked = docs.withColumn("_digest", F.sha2(F.coalesce(F.col(text_col), F.lit("")), 256))
        texts = asked.groupBy("_digest").agg(F.min(text_col).alias("_text"))
        by_text = self.logits(texts, "_digest", "_text").withColumnRenamed("id", "_digest")
        rows = skew_join(asked, by_text, "_digest", spread=id_col, how="left")
        known = F.coalesce("logits", F.array(*map(F.lit, self.intercepts)))
        rows = rows.withColumn("_p", class_shares(known)).drop("logits")
        rows = rows.withColumn("_hits", hit_counts(F.coalesce(F.col(text_col), F.lit("")), rules))
        rows = rows.withColumn("_scores", blend(F.col("_p"), F.col("_hits"), boost))
        return rows.withColumns(verdict(F.col("_scores"), F.col("_hits"), self.classes, names)).drop(
            "_digest", "_p", "_hits", "_scores")

    def save(self, path: str) -> None:
        self.terms.write.mode("overwrite").parquet(f"{path}/terms")
        rows = [(i, c, b) for i, (c, b) in enumerate(zip(self.classes, self.intercepts))]
        self.terms.sparkSession.createDataFrame(rows, "i int, class string, intercept double").write.mode(
            "overwrite").parquet(f"{path}/classes")

    @classmethod
    def load(cls, spark: SparkSession, path: str, classes: Sequence[str] | None = None,
             config: TfidfConfig = CLASSIFIER_TERMS) -> "ClassModel":
        """A saved model; ``classes``, where given, must be those it was saved with."""
        saved = spark.read.parquet(f"{path}/classes").orderBy("i").collect()
        known = [r["class"] for r in saved]
        if classes is not None and list(classes) != known:
            raise ValueError(f"the model was saved with the classes {known}")
        return cls(spark.read.parquet(f"{path}/terms"), [r["intercept"] for r in saved], known, config)


def _vectors(docs, id_col, text_col, terms, config, size, tf=None) -> DataFrame:
    """(id, features) of the texts that hold a known term."""
    model = TfidfModel(terms.drop("index"), config)
    weights = model.transform(docs, id_col, text_col) if tf is None else model.weigh(tf)
    indexed = weights.join(terms.select("term", "index"), "term")
    # One document's distinct terms form one array: its size is bounded by the vocabulary.
    entries = F.array_sort(F.collect_list(F.struct("index", F.col("weight").alias("value"))))
    return indexed.groupBy("id").agg(entries.alias("_e")).select("id", sparse_vector(F.col("_e"), size).alias("features"))


def _features(docs, id_col, text_col, terms, config, size, tf=None) -> DataFrame:
    """(id, features) of all texts; one without known terms gets an empty vector."""
    empty = F.array().cast("array<struct<index:int,value:double>>")
    found = _vectors(docs, id_col, text_col, terms, config, size, tf)
    return (docs.select(F.col(id_col).alias("id")).join(found, "id", "left")
            .select("id", F.coalesce("features", sparse_vector(empty, size)).alias("features")))


def fit_classifier(corpus: DataFrame, text_col: str, label_col: str, classes: Sequence[str],
                   config: TfidfConfig = CLASSIFIER_TERMS, c: float = 2.5, max_iter: int = 1000,
                   id_col: str = "id") -> ClassModel:
    """Multinomial logistic regression with balanced class weights and ridge strength 1 / (c * rows).

    Features are cached only while the solver iterates.
    """
    classes = list(classes)
    if config.max_terms is None:
        raise ValueError("the class model needs a capped vocabulary")
    known = most_frequent(corpus, text_col, config)
    tf = stored(term_counts(corpus, id_col, text_col, config, known=known), "tf")
    kept = fit_tfidf(corpus, id_col, text_col, config, tf).terms
    terms = stored(kept.withColumn("index", F.row_number().over(Window.orderBy("term")) - 1), "class-terms")
    sizes = {r[label_col]: r["count"] for r in
             corpus.filter(F.col(label_col).isin(classes)).groupBy(label_col).count().collect()}
    seen, rows = [c for c in classes if c in sizes], sum(sizes.values())
    if not seen:
        raise ValueError("no row has one of the classes")
    slopes, offsets = [[]] * len(classes), [0.0 if c in sizes else float("-inf") for c in classes]
    size = terms.count()
    if len(seen) > 1:
        ordinal = F.create_map(*[F.lit(x) for i, name in enumerate(seen) for x in (name, float(i))])
        balance = F.create_map(*[F.lit(x) for name, n in sizes.items() for x in (name, rows / (len(seen) * n))])
        labelled = (corpus.filter(F.col(label_col).isin(classes))
                    .select(F.col(id_col).alias("id"), ordinal[F.col(label_col)].alias("label"),
                            balance[F.col(label_col)].alias("balance")))
        training = labelled.join(_features(corpus, id_col, text_col, terms, config, size, tf), "id").persist()
        solver = LogisticRegression(family="multinomial", elasticNetParam=0.0, standardization=False, weightCol="balance",
                                    regParam=1.0 / (c * rows), maxIter=max_iter)
        linear = solver.fit(training)
        training.unpersist()
        fitted, places = linear.coefficientMatrix.toArray(), [classes.index(name) for name in seen]
        for row, place in enumerate(places):
            slopes[place], offsets[place] = fitted[row].tolist(), float(linear.interceptVector[row])
    columns = [s or [0.0] * size for s in slopes]
    # At most ``max_terms`` rows: the solver's result, which the driver holds already.
    table = corpus.sparkSession.createDataFrame(
        [(i, list(row)) for i, row in enumerate(zip(*columns))], "index int, coefs array<double>")
    return ClassModel(stored(terms.join(table, "index").drop("index"), "class-model"), offsets, classes, config)


def apply_scorer(df: DataFrame, scorer, schema: str) -> DataFrame:
    """Score rows with the caller's own function over iterators of pandas batches (an external model, for example)."""
    return df.mapInPandas(scorer, schema)
