import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from deskloom.functions import rules as R
from deskloom.functions import stem as S
from deskloom.operators import tfidf as T
from deskloom.queries.inputs import LANG_RULES


@pytest.fixture(scope="module")
def texts(spark):
    rng = random.Random(4)
    names = [f"w{i}" for i in range(60)] + ["\u00e9t\u00e9", "x y"]
    rows = [(i % 70, " ".join(rng.choices(names, [1 / (k + 1) for k in range(62)], k=rng.randint(0, 40)))) for i in range(90)]
    return spark.createDataFrame([*rows, (None, "w0 w1 w0"), (None, "w1 w0"), (71, None), (72, "")], "id int, t string").repartition(3).cache()


@pytest.mark.parametrize("max_terms", [5, 40, 10_000])
@pytest.mark.parametrize("stop_words", [(), ("w0",)])
def test_most_frequent_terms_without_counting_all(texts, max_terms, stop_words):
    """The same vocabulary and counts as from all n-grams; repeated and null ids are one document."""
    config = T.TfidfConfig(1, 3, stop_words=stop_words, max_terms=max_terms)
    plain = T.term_counts(texts, "id", "t", config)
    want = [r["term"] for r in T.vocabulary(T.document_frequency(plain), max_terms).collect()]
    known = T.most_frequent(texts, "t", config)
    assert sorted(known.terms) == sorted(want) and len(want) <= max_terms
    got = {(r["id"], r["term"]): r["tf"] for r in T.term_counts(texts, "id", "t", config, known=known).collect()}
    assert got == {(r["id"], r["term"]): r["tf"] for r in plain.filter(F.col("term").isin(want)).collect()}


def test_too_many_candidates_are_counted_plainly(texts, monkeypatch):
    monkeypatch.setattr(T, "SENT_TERMS", 10)
    config = T.TfidfConfig(1, 2, max_terms=30)
    assert T.most_frequent(texts, "t", config) is None
    assert T.fit_tfidf(texts, "id", "t", config).terms.count() == 30


def test_known_terms_only_are_cut(texts):
    """The classifier's counting makes no row for other n-grams, so what it moves grows with the known terms."""
    config = T.TfidfConfig(1, 3, max_terms=5)
    model = T.fit_tfidf(texts, "id", "t", config)
    assert model.known is not None and model.terms.count() == 5


def test_rules_agree_in_both_engines(spark):
    """Texts on which RE2 and Java might differ are read by Java."""
    assert R.told_by_re2(list(LANG_RULES.values())) and not R.told_by_re2([[r"\bthe\b"]]) and not R.told_by_re2([["a(?=b)"], ["\\d"]])
    found = ["the", "The end", "THE\n", "\nthe", "xthe", "the_", "to \u0130s", "\u0130s", "\u0131s", "l\u0131", "la\u0301", "\u017fprich nicht", "\u4e2d the \u4e2d",
             "\U0001f600is", "de\u0440 der", "", None, "der\n\n", "und\r", "\u00e9l los", "que\u00a0por", "ICH", "ich9", "is\x00"] + ["a the b " * 300]
    rows = spark.createDataFrame(list(enumerate(found)), "i int, t string")
    java = F.array(*[R.pattern_hits(F.col("t"), p) for p in LANG_RULES.values()])
    got = rows.select("i", R.hit_counts(F.col("t"), LANG_RULES).alias("a"), java.alias("b"), R.counts_by_re2(list(LANG_RULES.values()))(F.col("t")).alias("c"))
    for r in got.collect():
        assert r["a"] == r["b"] and r["c"] in (None, r["b"])
    assert got.filter("c IS NOT NULL").count() > 12


@pytest.mark.parametrize("most", [0, 256])
def test_rule_table_of_any_size(spark, monkeypatch, most):
    monkeypatch.setattr(R, "CONSTANT_RULES", most)
    table = spark.createDataFrame([("b", 0, "x"), ("b", 1, "[0-9]"), ("a", 2, r"\bq"), ("c", 3, "none"), (None, 4, "x")], "class string, ordinal int, pattern string")
    rows = spark.createDataFrame([(1, "x 1 q"), (2, "zz"), (3, None)], "i int, t string")
    got = {r["i"]: [tuple(h) for h in r["hits"] or []] for r in R.rule_hits(rows, "t", table).collect()}
    assert got == {1: [("b", 2), ("a", 1), (None, 1)], 2: [], 3: []}
    assert [r["hits"] for r in R.rule_hits(rows, "t", table.limit(0)).collect()] == [[], [], []]


def test_stems_make_no_object_per_token():
    """Equal tokens share their stem; lists that are null, empty or sliced keep their places."""
    lists = pa.array([["running", "the"] * 50_000, None, [], ["flies", "running"]], pa.list_(pa.string()))
    known = {}
    got = S.stemmed_lists(lists.slice(1), known)
    assert got.to_pylist() == [[], [], [S.stem("flies"), S.stem("running")]] and set(known) == {"flies", "running"}
    assert S.stemmed_lists(lists, known)[0].values.dictionary_encode().dictionary.to_pylist() == [S.stem("running"), "the"]
