"""Every operator against brute force and on awkward rows: nulls, empty and long texts, ties, repeats, clashing columns."""

import base64
import math
import random
import zlib
from pathlib import Path

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from deskloom.llm import (components, decontaminate, gru, langid, lm, mixing, neardup, pii, quality, substrings, tokenids,
                          toxicity)
from deskloom.llm.queries import ORACLE, QUERIES, vocabulary
from deskloom.session import recorded_tables
from tests.llm import brute

FOLDER = "/root/testdata/sf0.001"
# Columns that the operators use inside, as extra columns of the input.
SCHEMA = ("doc_id bigint, text string, lang string, source string, n_chars bigint, node bigint, component string, key string, "
          "size int, taken string, rank int, part int, label int, `place` string, words string, row string, id string")


def table(spark, rows):
    """(doc_id, text, lang, source) rows with all clashing columns."""
    return spark.createDataFrame([(*r, None, 1, "c", "k", 2, "t", 3, 4, 5, "p", "w", "r", "i") for r in rows], SCHEMA)


def prose(n, seed=0, vocabulary_size=400):
    rng = random.Random(seed)
    return " ".join(f"w{rng.randrange(vocabulary_size)}" for _ in range(n))


LONG = prose(30_000, 1)
AWKWARD = [
    (1, None, None, None), (2, "", "en", "a"), (3, " \n\t ", "en", "a"), (4, "one", "en", None), (5, LONG, "en", "a"),
    (6, LONG, "en", "b"), (7, prose(40, 2), "de", "b"), (7, prose(40, 2), "de", "b"), (8, prose(40, 2) + " tail", "de", "b"),
    (None, prose(40, 2), None, "a"), (9, "é ü 12 ### | $", "de", "c"), (10, "A B c", "fr", "c"), (11, "a b C", "fr", "c"),
    (12, "x" * 200_000, "fr", "c"), (13, "Ünï cödé " * 30, "es", "c"),
]


@pytest.fixture(scope="module")
def awkward(spark):
    return table(spark, AWKWARD).repartition(3).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return table(spark, [])


@pytest.fixture(scope="module")
def documents(spark):
    return spark.read.parquet(f"{FOLDER}/documents.parquet")


def pairs(df):
    return [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]


# 1 near-duplicates

def found_groups(df):
    return {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in neardup.near_duplicates(df).collect()}


def test_near_duplicates_equal_brute_force(documents):
    assert found_groups(documents) == brute.near_duplicates(pairs(documents))


def test_near_duplicates_awkward(awkward, empty):
    rows = neardup.near_duplicates(awkward).collect()
    named = [(i, t) for i, t, *_ in AWKWARD if i is not None]
    assert {r["doc_id"]: tuple(r)[1:] for r in rows if r["doc_id"]} == brute.near_duplicates(named)
    assert len(rows) == len({i for i, _ in named}) + 1
    assert [tuple(r) for r in rows if r["doc_id"] is None] == [(None, 36, None, True)]
    assert neardup.near_duplicates(empty).count() == 0


def test_near_duplicates_large_group_and_chain(spark):
    base = prose(120, 5, 5000).split()
    rng = random.Random(3)
    group = []
    for _ in range(60):
        w = list(base)
        w[rng.randrange(len(w))] = f"n{rng.random()}"
        group.append(" ".join(w))
    chain, w = [], prose(100, 6, 5000).split()
    for i in range(30):  # each is like the one before, the ends are not alike
        w = w[2:] + [f"c{i}", f"d{i}"]
        chain.append(" ".join(w))
    texts = group + [group[0]] * 40 + chain
    rng.shuffle(texts)
    docs = list(enumerate(texts))
    got = found_groups(table(spark, [(i, t, "en", "s") for i, t in docs]))
    assert got == brute.near_duplicates(docs)


def test_registers_estimate_similarity():
    rules = neardup.NearDup()
    order = neardup.donors(rules.bucket_bits)
    rng = np.random.RandomState(0)
    pool = np.unique(rng.randint(0, 1 << 63, 4000, np.int64).astype(np.uint64) * np.uint64(2))
    for share in (0.2, 0.5, 0.8):
        a, b = np.sort(pool[:2000]), np.sort(pool[int(2000 * (1 - share)):][:2000])
        expected = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
        x, y = (neardup.registers(s, order, rules)[0] for s in (a, b))
        assert abs((x == y).mean() - expected) < 0.15


def test_components(spark):
    links = [(1, 2), (2, 3), (3, 3), (5, 4), (None, 4), (4, None), (2, 1), (9, 8), (8, 7), (7, 6), (6, 10)]
    df = spark.createDataFrame(links, "a bigint, b bigint")
    got = {r["node"]: r["component"] for r in components.components(df).collect()}
    assert got == {1: 1, 2: 1, 3: 1, 4: 4, 5: 4, 6: 6, 7: 6, 8: 6, 9: 6, 10: 6}
    assert components.components(df.limit(0)).count() == 0


# 2 substrings

def test_substrings_equal_brute_force(documents):
    assert sorted(tuple(r) for r in substrings.remove_repeats(documents).collect()) == brute.remove_repeats(pairs(documents))


def test_substrings_awkward(awkward, empty):
    rows = [tuple(r) for r in substrings.remove_repeats(awkward).collect()]
    named = [(i, t) for i, t, *_ in AWKWARD if i is not None]
    assert sorted(r for r in rows if r[0] is not None) == brute.remove_repeats(named)
    assert [r[:3] for r in rows if r[0] is None] == [(None, 40, 0)]
    assert substrings.remove_repeats(empty).count() == 0


def test_substrings_same_id_different_text(spark):
    shared = prose(30, 7)
    rows = [(1, shared), (2, "a " * 20 + shared), (2, shared + " z" * 15), (3, "b " + shared + " c " + shared)]
    got = sorted(tuple(r) for r in substrings.remove_repeats(table(spark, [(i, t, "en", "s") for i, t in rows])).collect())
    assert got == brute.remove_repeats(rows)


def test_substrings_meet_on_the_whole_hash(documents, monkeypatch):
    hashes = substrings.window_hashes
    monkeypatch.setattr(substrings, "window_hashes", lambda h, width: hashes(h, width) & ~np.uint64(0xFFFFFFFF) | np.uint64(7))
    monkeypatch.setattr(substrings, "BLOCK_BYTES", 1 << 16)
    got = sorted(tuple(r) for r in substrings.remove_repeats(documents.repartition(8)).collect())
    assert got == brute.remove_repeats(pairs(documents))


def test_suffix_automaton():
    rng = random.Random(1)
    texts = [[rng.choice([b"a", b"b", b"c"]) for _ in range(40)] for _ in range(6)]
    automaton = substrings.SuffixAutomaton()
    for i, t in enumerate(texts):
        automaton.add(t, i)
    automaton.finish()
    query = [rng.choice([b"a", b"b", b"c"]) for _ in range(200)]
    want = []
    for end in range(4, 200):
        holders = [i for i, t in enumerate(texts) if any(t[p:p + 5] == query[end - 4:end + 1] for p in range(36))]
        want += [(end, holders[0])] if holders else []
    assert automaton.ends(query, 5) == want


# 3 quality

def test_quality_counts(documents, awkward, empty):
    for df in (documents, awkward):
        got = sorted((tuple(r)[:7] for r in quality.quality(df).collect()), key=repr)
        assert got == sorted(((i, *brute.base_counts(t)) for i, t in pairs(df)), key=repr)
    assert quality.quality(empty).count() == 0


def test_quality_bands(spark):
    rng = random.Random(4)
    clean = " ".join("".join(rng.choice("etaoinshrdlu") for _ in range(rng.randrange(1, 9))) for _ in range(900))
    noise = " ".join("".join(chr(rng.randrange(33, 127)) for _ in range(60)) for _ in range(60))
    repeated = " ".join(f"{i % 97} same words here again" for i in range(700))
    rows = {r["doc_id"]: r for r in quality.quality(table(spark, [(1, clean, "en", "s"), (2, noise, "en", "s"),
                                                                 (3, repeated, "en", "s")])).collect()}
    assert rows[1]["kept"] and not rows[2]["kept"] and not rows[3]["kept"]
    assert not rows[2]["base_failed"] and rows[2]["ratio"] < 1.4


def test_quality_judges_the_end_of_a_text(spark):
    rng = random.Random(5)
    words = ["".join(rng.choice("etaoinshrdlu") for _ in range(rng.randrange(3, 9))) for _ in range(400)]
    clean = " ".join(rng.choice(words) for _ in range(900))
    noise = " ".join(base64.b64encode(rng.randbytes(45)).decode() for _ in range(60))
    texts = [clean[:2048] + noise[:2040], clean[:2048] + clean[:2040], clean[:2048]]
    rows = {r["doc_id"]: r for r in quality.quality(table(spark, [(i, t, "en", "s") for i, t in enumerate(texts)])).collect()}
    assert not rows[0]["base_failed"] and 1.5 <= rows[0]["ratio"] <= 2.35
    assert not rows[0]["kept"] and rows[0]["lowest_chunk_ratio"] < 1.5 <= rows[0]["highest_chunk_ratio"]
    assert rows[2]["kept"]


# 4 toxicity

def test_gradients_match_differences():
    rng = np.random.RandomState(0)
    weights = {k: v.astype(np.float64) for k, v in gru.initial(gru.Shape(5)).items()}
    x, goal = rng.standard_normal((6, 4, 16)), np.array([1, 0, 1, 0])
    mask = (rng.rand(6, 4, 1) > 0.2).astype(float)
    mask[0] = 1

    def loss():
        states = np.concatenate([gru.run(weights, s, x @ weights[f"{s}_in"] + weights[f"{s}_b"], mask)
                                 for s in ("forth", "back")], axis=2).astype(float)
        odds = gru.pooled(weights, states, mask)[2] @ weights["out"] + weights["bias"]
        return np.mean(np.log1p(np.exp(odds)) - goal * odds)

    slopes = gru.gradients(weights, x, mask, goal)[0]
    for name, slope in slopes.items():
        at = (0,) * weights[name].ndim
        value = weights[name][at]
        weights[name][at] = value + 1e-2
        up = loss()
        weights[name][at] = value - 1e-2
        down = loss()
        weights[name][at] = value
        assert slope[at] == pytest.approx((up - down) / 2e-2, abs=2e-4)


def test_toxicity_learns_and_is_total(spark, awkward, empty):
    rng = random.Random(2)
    docs, labels = [], []
    for i in range(160):
        w = prose(rng.randrange(20, 120), i).split()
        if i % 4 == 0:
            for _ in range(4):
                w[rng.randrange(len(w))] = rng.choice(["Vile!", "rotten", "scummy,"])
        docs.append((i, " ".join(w), "en", "s"))
        labels.append((i, i % 4 == 0))
    marks = spark.createDataFrame([(i, int(t)) for i, t in labels[:120]] + [(None, 1), (999, 1), (3, None), (4, 7)],
                                  "doc_id bigint, toxic int")
    model = toxicity.fit(table(spark, docs), marks)
    scores = {r["doc_id"]: r["score"] for r in toxicity.toxicity(table(spark, docs), model).collect()}
    assert sum((scores[i] >= 0.3) != t for i, t in labels[120:]) <= 1
    rows = toxicity.toxicity(awkward, model, carry=("lang",)).collect()
    assert len(rows) == len(AWKWARD) and all(0 <= r["score"] <= 1 for r in rows)
    assert [r["score"] for r in rows if r["doc_id"] in (1, 2, 3)] == [0, 0, 0]
    assert toxicity.toxicity(empty, model).count() == 0
    alone = toxicity.fit(table(spark, docs), marks.filter("toxic = 0"))
    assert alone.weights is None and toxicity.toxicity(awkward, alone).agg(F.max("score")).first()[0] == 0


def test_toxicity_sample_is_whole_texts_within_its_bounds(spark, monkeypatch):
    rules = toxicity.ToxicityRules(toxic_docs=3, clean_docs=5, most_chars=40)
    docs = [(i % 20, f"text {i % 20} " + "x" * (100 if i % 20 == 4 else i // 20 % 2), "en", "s") for i in range(2000)] + [(None, "lost", "en", "s")] * 500
    marks = spark.createDataFrame([(i, i % 2) for i in range(20)] * 3 + [(None, 1)] * 50 + [(77, 1)], "doc_id bigint, toxic int")
    seen = []
    monkeypatch.setattr(toxicity, "train", lambda texts, labels, rules: seen.extend(zip(texts, labels)))
    toxicity.fit(table(spark, docs), marks, rules=rules)
    assert sorted(label for _, label in seen) == [0] * 5 + [1] * 3
    assert len(set(seen)) == 8 and set(seen) <= {(f"text {i} ".encode(), i % 2) for i in range(20) if i != 4}


def test_windows_cover_all_words():
    rules = toxicity.ToxicityRules()
    for n in (1, 15, 16, 31, 32, 33, 48, 49, 500):
        owner, places, mask = toxicity.windows([n], rules)
        assert set(places[mask > 0].tolist()) == set(range(n))
        assert len(owner) == max(1, math.ceil((n - 16) / 16))


# 5 language

def test_language(spark, awkward, empty, documents):
    rows = documents.withColumn("held", F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2)
    model = langid.fit_languages(rows.filter("NOT held"))
    assert sorted(model.dictionaries) == ["de", "en", "es", "fr"]
    got = rows.filter("held").select("lang", langid.language(F.col("text"), model).alias("p")).collect()
    assert sum(r["lang"] == r["p"]["lang_pred"] for r in got) >= 0.9 * len(got)
    rows = {r["doc_id"]: r["p"] for r in awkward.select("doc_id", langid.language(F.col("text"), model).alias("p")).collect()}
    assert [tuple(rows[i]) for i in (1, 2, 3)] == [("und", 0.0, 0.0, True)] * 3
    assert rows[9]["lang_pred"] != "und" and 0 <= rows[5]["score"] <= 1
    nothing = langid.fit_languages(empty)
    assert nothing.dictionaries == {} and awkward.select(langid.language(F.col("text"), nothing)["lang_pred"]).distinct().count() == 1
    assert empty.select(langid.language(F.col("text"), model)).count() == 0


def test_dictionaries_hold_text_of_all_sampled_documents(spark):
    words = ["x" + "".join(chr(97 + i // 5 ** k % 5) for k in range(4)) + "y" for i in range(150)]
    whole = langid.fit_languages(table(spark, [(i, f"{w} " * 600, "en", "s") for i, w in enumerate(words)]))
    assert whole.documents == {"en": 150} and len(whole.dictionaries["en"]) <= 112_640
    assert all(w.encode() in whole.dictionaries["en"] for w in words)
    late = langid.fit_languages(table(spark, [(i, "begin " * 400 + f"{w} " * 600, "en", "s") for i, w in enumerate(words)]))
    assert sum(w.encode() in late.dictionaries["en"] for w in words) > 50


# 6 language model

def traversed(tokens, model):
    """Word by word through the automaton: follow an arc, else a failure arc."""
    total, history = 0.0, []
    for t in tokens:
        while True:
            k = len(history)
            if k == 0:
                total += float(model.unigram(np.array([t]))[0])
                break
            code = history[-1] * len(model.words) + t
            place = int(lm.lookup(model.codes[k - 1], np.array([code]))[0]) if t >= 0 else -1
            if place >= 0:
                total += model.arcs[k - 1][place]
                break
            total += model.backoff[k - 1][history[-1]]
            history = shorter(history, model)
        history = next_states(history, t, model)
    return total


def shorter(history, model):
    """States of the history without its first word: state numbers of its suffixes, from one word up."""
    words_ = model.spelled[len(history) - 1][history[-1]]
    return states_of(words_[1:], model)


def states_of(words_, model):
    out = []
    for k in range(len(words_)):
        if k == 0:
            out.append(words_[0])
            continue
        place = int(lm.lookup(model.codes[k - 1], np.array([out[-1] * len(model.words) + words_[k]]))[0])
        if place < 0:
            return []
        out.append(place)
    return out


def next_states(history, t, model):
    if t < 0:
        return []
    words_ = (model.spelled[len(history) - 1][history[-1]] if history else []) + [t]
    for cut in range(len(words_)):
        tail = words_[cut:]
        if len(tail) <= len(model.codes) and (found := states_of(tail, model)):
            return found
    return []


def spell(model):
    model.spelled = [[[w] for w in range(len(model.words))]]
    for codes in model.codes:
        model.spelled.append([model.spelled[-1][c // len(model.words)] + [int(c % len(model.words))] for c in codes.tolist()])


@pytest.mark.parametrize("word_share", [1e-7, 1e-3])
def test_language_model(documents, word_share):
    rules = lm.LmRules(word_share=word_share, state_share=1e-5)
    docs = documents.withColumn("held", F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 1)
    model, counts = lm.fit(docs.filter("NOT held"), rules=rules)
    rows = {r["doc_id"]: r for r in lm.scores(docs, model, counts, carry=("held",)).collect()}
    tokens = {r["doc_id"]: [*brute.words(r["text"], lower=True), b""] for r in docs.collect()}
    times = {}
    for i, t in tokens.items():
        if not rows[i]["held"]:
            for w in t:
                times[w] = times.get(w, 0) + 1
    n, v = sum(times.values()), len(times)
    spell(model)
    for i, t in tokens.items():
        c = [times.get(w, 0) for w in t]
        assert (rows[i]["n_tokens"], rows[i]["n_known"], rows[i]["train_tokens"]) == (len(t), sum(x > 0 for x in c), n)
        assert rows[i]["base_score"] == pytest.approx(sum(math.log10((x + 0.5) / (n + 0.5 * (v + 1))) for x in c))
        numbers = lm.lookup(model.words, lm.tokens_of([b" ".join(t[:-1])])[0])
        late = sum(math.log10((x + 0.5) / 0.5) for x, k in zip(c, numbers) if k < 0)
        assert rows[i]["score"] == pytest.approx(traversed(numbers.tolist(), model) + late)
    held = [r for r in rows.values() if r["held"]]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)
    for k in range(len(model.codes)):  # probabilities after a state sum to one
        for history in random.Random(k).sample(range(len(model.backoff[k])), 5):
            own = model.codes[k] // len(model.words) == history
            words_ = model.codes[k][own] % len(model.words)
            if k == 0 and own.any():
                lower = (10.0 ** model.unigram(words_)).sum()
                assert (10.0 ** model.arcs[k][own]).sum() + 10.0 ** model.backoff[k][history] * (1 - lower) == pytest.approx(1)


def test_language_model_awkward(awkward, empty):
    model, counts = lm.fit(awkward)
    rows = lm.scores(awkward, model, counts).collect()
    assert len(rows) == len(AWKWARD)
    assert all(r["n_tokens"] == 1 and r["score"] == pytest.approx(r["base_score"]) for r in rows if r["doc_id"] in (1, 2, 3))
    model, counts = lm.fit(empty)
    rows = lm.scores(awkward, model, counts).collect()
    assert all(r["n_known"] == 0 and r["train_tokens"] == 0 and r["base_score"] == 0 for r in rows)
    assert lm.scores(empty, model, counts).count() == 0


@pytest.mark.parametrize("shares", [(1e-7, 1e-6), (1e-3, 1e-3), (1.0, 1.0)])
def test_language_model_counts_every_state(documents, shares):
    """What is sent to the tasks changes no score: all n-grams with two occurrences are states, also rare ones."""
    docs = documents.withColumn("held", F.col("doc_id") % 5 == 1)
    whole, counts = lm.fit(docs.filter("NOT held"), rules=lm.LmRules(word_share=0.0, state_share=0.0))
    want = {r["doc_id"]: r for r in lm.scores(docs, whole, counts, carry=("held",)).collect()}
    model = lm.fit_whole(docs.filter("NOT held"), rules=lm.LmRules(word_share=shares[0], state_share=shares[1]))
    rows = lm.whole_scores(docs, model, carry=("held",)).collect()
    assert len(rows) == len(want) and (shares[0] == 1.0) == (len(model.sent) == 0)
    for r in rows:
        w = want[r["doc_id"]]
        assert (r["held"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (w["held"], w["n_tokens"], w["n_known"], w["train_tokens"])
        assert r["base_score"] == pytest.approx(w["base_score"]) and r["score"] == pytest.approx(w["score"])


def test_language_model_rare_state(spark):
    """A pair of words that occurs twice is a state however long the training text is."""
    docs = table(spark, [(1, "rare pair here", "en", "a"), (2, "a rare pair", "en", "a"), (3, prose(4_000, 9, 5), "en", "a"),
                         (4, "pair rare", "en", "a")])
    train = docs.filter("doc_id < 4")
    rules = lm.LmRules(state_share=1e-3, word_share=1e-3)
    rows = {r["doc_id"]: r for r in lm.whole_scores(docs, lm.fit_whole(train, rules=rules)).collect()}
    assert rows[2]["score"] - rows[2]["base_score"] > 2 and rows[4]["score"] < rows[4]["base_score"] + 0.1


@pytest.mark.parametrize("order, block", [(3, 1 << 20), (3, 300), (2, 5_000), (1, 5_000), (4, 5_000)])
def test_language_model_learned_in_the_same_table(documents, monkeypatch, order, block):
    """Blocks that ask for counts give the scores of the model that is learned from a table of its own."""
    monkeypatch.setattr(lm, "BLOCK", block)
    docs = documents.withColumn("held", F.col("doc_id") % 5 == 1)
    rules = lm.LmRules(order=order)
    want = {r["doc_id"]: r for r in lm.whole_scores(docs, lm.fit_whole(docs.filter("NOT held"), rules=rules), carry=("held",)).collect()}
    found = lm.learned_scores(docs, ~F.col("held"), carry=("held",), rules=rules)
    rows = found.collect()
    assert len(rows) == len(want) and found.columns == ["doc_id", "held", "n_tokens", "n_known", "train_tokens", "base_score", "score"]
    for r in rows:
        w = want[r["doc_id"]]
        assert (r["held"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (w["held"], w["n_tokens"], w["n_known"], w["train_tokens"])
        assert r["base_score"] == pytest.approx(w["base_score"], rel=1e-9) and r["score"] == pytest.approx(w["score"], rel=1e-9)


def test_language_model_learned_awkward(awkward, empty):
    rows = lm.learned_scores(awkward, F.lit(True)).collect()
    want = {r["doc_id"]: r["score"] for r in lm.whole_scores(awkward, lm.fit_whole(awkward)).collect()}
    assert len(rows) == len(AWKWARD) and all(r["score"] == pytest.approx(want[r["doc_id"]]) for r in rows)
    rows = lm.learned_scores(awkward, F.lit(None).cast("boolean")).collect()
    assert len(rows) == len(AWKWARD)
    assert all(r["n_known"] == 0 and r["train_tokens"] == 0 and r["base_score"] == 0 for r in rows)
    assert lm.learned_scores(empty, F.lit(True)).count() == 0
    twice = awkward.unionByName(awkward).withColumn("doc_id", F.lit(None).cast("long"))
    assert lm.learned_scores(twice, F.lit(True)).count() == 2 * len(AWKWARD)


def test_language_model_disk(spark, tmp_path):
    """What the query stores is less than its texts: n-grams do not travel with the rows they came from."""
    texts = [prose(700, seed, 5_000) for seed in range(300)]
    table(spark, [(i, t, "en", "a") for i, t in enumerate(texts)]).write.parquet(str(tmp_path / "documents.parquet"))
    with recorded_tables() as paths:
        assert QUERIES["op6_backoff_automaton"](spark, str(tmp_path)).count() == len(texts)
    files = [f for path in paths for f in Path(path.removeprefix("file:")).rglob("*.parquet")]
    assert files and sum(f.stat().st_size for f in files) < sum(map(len, texts))


def test_language_model_whole_awkward(awkward, empty):
    rows = lm.whole_scores(awkward, lm.fit_whole(awkward)).collect()
    assert len(rows) == len(AWKWARD)
    assert all(r["n_tokens"] == 1 and r["score"] == pytest.approx(r["base_score"]) for r in rows if r["doc_id"] in (1, 2, 3))
    rows = lm.whole_scores(awkward, lm.fit_whole(empty)).collect()
    assert all(r["n_known"] == 0 and r["train_tokens"] == 0 and r["base_score"] == 0 for r in rows)
    assert lm.whole_scores(empty, lm.fit_whole(awkward)).count() == 0


# 7 personal data

def test_base_spans():
    text = ("a@b.c@d.e 1.2.3.4.5.6.7.8 é@x.y.z ..@a-b.c. 01.002.0003.4 999.1.1.1 x@@y.z a@b a@b..c +1 (974) 555-3436 +12 4 "
            "x 4539 1488 0343 6467; 4539148803436468")
    assert pii.written(pii.base_spans(text)) == (
        "email:0:5,ip:10:17,ip:18:25,email:34:42,ip:44:57,phone:86:103,card:112:131")
    assert pii.base_spans("9" * 100_000 + "." * 10 + "a" * 100_000 + "@") == []


def test_personal_data(spark, awkward, empty, documents):
    train = [f"{prose(6, i)} +1 ({200 + i}) 555-{1000 + i} {prose(3, i + 1)} m{i}@mail.com {prose(3, i)} {i} {prose(2, i)}"
             for i in range(80)]
    crf = pii.train(train)
    rows = [(1, "call +1 (843) 555-7672 170.106.47.218 now", "en", "s"), (2, "no 12 or 3.5 here", "en", "s"),
            (3, "+1 (300) 555-1099 or again 555-1099 in the text, version 2.0", "en", "s")]
    got = {r["doc_id"]: r for r in pii.personal_data(table(spark, rows), crf).collect()}
    assert got[1]["n_phone"] == 0 and got[1]["base_spans"] == "ip:23:37"
    assert got[2]["spans"] == "" and got[3]["n_phone"] == 1 and got[3]["spans"].startswith("phone:0:17")
    out = pii.personal_data(awkward, crf).collect()
    assert len(out) == len(AWKWARD) and all(r["spans"] == "" for r in out if not r["doc_id"] or r["doc_id"] < 4)
    assert pii.personal_data(empty, pii.fit(empty)).count() == 0
    for r in pii.personal_data(documents, pii.fit(documents)).collect():
        certain = [s for s in r["base_spans"].split(",") if s]
        assert set(certain) <= set(r["spans"].split(",")) and len(certain) == sum(r[f"n_{k}"] for k in pii.KINDS)


def pii_texts(count, start=0):
    return [f"{prose(6, i)} +1 ({200 + i % 700}) 555-{1000 + i} {prose(3, i + 1)} m{i}.x@mail{i % 9}.example.com {prose(3, i)} {i} "
            f"{prose(2, i)} {i % 250}.{i % 199}.17.{i % 97} {prose(3, i + 2)} paid {card_number(i)} {prose(2, i)}" for i in range(start, start + count)]


def card_number(i):
    body = f"4{i * 7919:014d}"
    return next(body + str(d) for d in range(10) if pii.luhn(body + str(d)))


@pytest.fixture(scope="module")
def pii_model():
    return pii.train(pii_texts(200))


def test_respelled_data_is_found(pii_model):
    rules, hits, total, false = pii.CrfRules(), 0, 0, 0
    for turn, text in enumerate(pii_texts(120, 5000)):
        out, spans, done = "", [], 0
        for a, k, b in pii.base_spans(text):
            new = pii.respelled(k, text[a:b], turn)
            out += text[done:a]
            spans.append((len(out), k, len(out) + len(new)))
            out, done = out + new, b
        out += text[done:]
        certain = pii.base_spans(out)
        got = certain + pii.added_spans([out], [certain], pii_model, rules)[0]
        hits += sum(any(g[1] == k and g[0] < b and g[2] > a for g in got) for a, k, b in spans)
        false += sum(not any(g[0] < b and g[2] > a for a, _, b in spans) for g in got)
        total += len(spans)
    assert total == 480 and hits >= 0.95 * total and false <= 0.02 * total


@pytest.mark.parametrize("text,want", [
    ("call 974-555-3436 or (974) 555-3436 today", "phone:5:17,phone:21:35"),
    ("+1 (974) 555-3436 or 974 555 3436", "phone:21:33"),
    ("order 9745553436 of 2024-03-15, 3.14159, ISBN 978-3-1614-8410-0, hash f00455934712a", ""),
    ("write to joe [at] example [dot] com now", "email:9:35"),
    ("4465758382889437 4465758382889437", "card:0:16,card:17:33"),
    ("nothing at all, at home", ""), ("", ""), ("+ ( ) . - @ [at]", "")])
def test_added_spans(pii_model, text, want):
    certain = pii.base_spans(text)
    assert pii.written(pii.added_spans([text], [certain], pii_model, pii.CrfRules())[0]) == want


def test_a_repeated_number_takes_the_label_of_its_other_place(pii_model):
    rules, between = pii.CrfRules(), "words that stand between two mentions and say nothing of them "
    alone, known = f"{between}9745553436 here", f"+1 (974) 555-3436 {between}9745553436 here"
    p = [pii.marginals(pii.graph_of([t], [pii.base_spans(t)], rules), pii_model, rules)[-1][4] for t in (alone, known)]
    assert p[0] < 0.3 and p[1] > p[0] + 0.3


def test_mentions_are_linear_and_in_order():
    assert pii.mentions("(974 x") == [(1, 4, False)]
    for text in ("1 " * 200_000, "1" * 400_000, "a@" * 200_000, " at " * 100_000, "a at b.c " * 40_000, "(" * 300_000, "+(1)" * 100_000):
        found = pii.mentions(text)
        assert all(x[1] <= y[0] for x, y in zip(found, found[1:]))


def test_sample_of_the_crf_is_bounded(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(pii, "train", lambda texts, rules: seen.append(texts))
    rows = spark.range(600).selectExpr("cast(null as long) doc_id", "concat('t ', id % 60) text")
    pii.fit(rows.unionAll(spark.sql("select 1L, repeat('9', 30000)")), rules=pii.CrfRules(sample_docs=25))
    pii.fit(rows, rules=pii.CrfRules(sample_docs=1000))
    assert [len(t) for t in seen] == [25, 60] and max(map(len, seen[0])) < 10


def test_base_spans_equal_plain_patterns(documents):
    import re

    email, ip = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"
    for row in documents.collect():
        text = row["text"] or ""
        want = [(m.start(), 0, m.end()) for m in re.finditer(email, text)]
        want += [(m.start(), 1, m.end()) for m in re.finditer(ip, text) if all(int(x) <= 255 for x in m[0].split("."))]
        for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
            d = re.sub("[^0-9]", "", m[0])
            want += [(m.start(), 2, m.end())] if 14 <= len(d) <= 19 and pii.luhn(d) else []
        want += [(m.start(), 3, m.end()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text)
                 if 10 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
        assert pii.base_spans(text) == sorted(want)


def test_message_passing_is_exact_on_a_tree():
    rules = pii.CrfRules(rounds=40)
    rng = np.random.RandomState(1)
    chain, skip = (lambda m: m + m.T)(rng.randn(5, 5)), (lambda m: m + m.T)(rng.randn(5, 5))
    crf = pii.Crf(rng.randn(rules.features, 5), chain, skip)
    graph = pii.Graph([0] * 4, [(0, 1)] * 4, [[1], [2], [3], [4]], [0] * 4, [(0, 1), (1, 2)], [(1, 3)])
    got = pii.marginals(graph, crf, rules)
    unary = [crf.unary[i + 1] for i in range(4)]
    joint = np.exp(unary[0][:, None, None, None] + unary[1][:, None, None] + unary[2][:, None] + unary[3]
                   + chain[:, :, None, None] + chain[None, :, :, None] + skip[None, :, None, :])
    joint /= joint.sum()
    for i in range(4):
        assert got[i] == pytest.approx(joint.sum(axis=tuple(k for k in range(4) if k != i)), abs=1e-6)


# 8 mixing

def test_mixing(documents, awkward, empty):
    for df in (documents, awkward):
        rows = mixing.draws(df).collect()
        assert len(rows) == df.count()
        texts = sorted(((r["doc_id"], len(brute.words(r["text"]))) for r in df.collect()), key=repr)
        assert sorted(((r["doc_id"], r["size"]) for r in rows), key=repr) == texts
        source = {}
        for r in df.collect():
            source[r["source"]] = source.get(r["source"], 0) + len(brute.words(r["text"]))
        order = sorted((s for s in source if s is not None), key=lambda s: s.encode()) + [None] * (None in source)
        want = brute.targets({s: source[s] for s in order})
        taken = {}
        for r in rows:
            words = sum(d["words"] for d in r["taken"])
            assert 0 <= words <= 2 * r["size"] and all(d["shard"] is not None for d in r["taken"])
            key = (r["source_size"], round(r["target"], 6))
            taken[key] = taken.get(key, 0) + words
        groups = {}
        for s, t in want.items():
            key = (source[s], round(t, 6))
            groups[key] = groups.get(key, 0) + t
        assert set(taken) == set(groups)
        assert all(abs(taken[k] - groups[k]) <= len(want) for k in groups)
    assert mixing.draws(empty).count() == 0 and mixing.mixed_documents(empty).count() == 0


def test_mix_does_not_depend_on_partitions(documents):
    def view(df):
        return sorted(mixing.draws(df, mix=mixing.Mix(shard_words=4096)).select("doc_id", F.to_json("taken")).collect())
    assert view(documents) == view(documents.repartition(7))


def test_splitting_tree(documents):
    mix = mixing.Mix(shard_words=4096, block_words=64)
    targets = mixing.source_targets(documents.select("source", mixing.words_in(F.col("text")).alias("size")), mix)
    quotas = mixing.shard_quotas(targets, mix).collect()
    take = {r["place"]: -(-r["take"] // 64) for r in targets.collect()}
    shards = {}
    for r in quotas:
        take[r["place"]] -= r["blocks"]
        shards[r["shard"]] = shards.get(r["shard"], 0) + r["blocks"]
    assert set(take.values()) == {0} and len(shards) >= 16
    assert max(shards.values()) - min(shards.values()) <= 1
    spread = {}
    for r in quotas:
        spread.setdefault(r["place"], set()).add(r["blocks"])
    assert any(len(s) > 1 for s in spread.values())  # drawn, not cut evenly


def test_mixed_documents(awkward):
    rows = mixing.mixed_documents(awkward)
    assert rows.columns == awkward.columns
    total = sum(len(brute.words(r["text"])) for r in rows.collect())
    drawn = mixing.draws(awkward).select(F.explode("taken").alias("d")).agg(F.sum("d.words")).first()[0]
    assert total == drawn


# 9 decontamination

ITEM = "Tom has 12 red apples and gives 5 apples to Anna before the long walk of 3 miles home with Anna"


def test_template_leaks(spark, awkward, empty):
    bench = spark.createDataFrame([(1, ITEM), (1, ITEM), (2, "too short"), (3, None), (4, "six words stand here in row")],
                                  "item_id bigint, text string")
    other = ITEM.replace("12", "30").replace("5", "seven").replace("Anna", "Lisa")
    broken = other.replace("Lisa", "Mary", 1)
    rows = [(1, f"{prose(50)}. {ITEM}. {prose(50)}", "en", "s"), (2, f"{prose(50)}. {other}", "en", "s"),
            (3, f"{prose(20)}. {broken}", "en", "s"), (4, prose(200), "en", "s"), (5, "x six words stand here in row y", "en", "s")]
    got = {(r["doc_id"], r["item_id"]): r for r in decontaminate.leaks(table(spark, rows), bench).collect()}
    assert set(got) == {(1, 1), (2, 1), (5, 4)}
    assert not got[1, 1]["changed"] and got[2, 1]["changed"] and got[1, 1]["slots"] == 6
    flags = table(spark, rows).select("doc_id", decontaminate.is_leaky(F.col("text"), bench).alias("l")).collect()
    assert {r["doc_id"] for r in flags if r["l"]} == {1, 2, 5}
    assert decontaminate.leaks(awkward, bench).count() == 0 and decontaminate.leaks(empty, bench).count() == 0
    assert decontaminate.leaks(awkward, bench.limit(0)).count() == 0
    blocks = decontaminate.leaks(table(spark, rows), bench, rules=decontaminate.Templates(block_items=1))
    assert {(r["doc_id"], r["item_id"]) for r in blocks.collect()} == set(got)


def found_leaks(spark, items, texts):
    bench = spark.createDataFrame(list(enumerate(items)), "item_id bigint, text string")
    docs = table(spark, [(i, t, "en", "s") for i, t in enumerate(texts)])
    return {(r["doc_id"], r["item_id"]): r["changed"] for r in decontaminate.leaks(docs, bench).collect()}


def test_verbatim_items_of_few_literals_are_found(spark):
    items = ["What is 12 plus 30 minus 7 times 4?", "12 + 7?", "one two three four km", "Zebra", "7 km 8 km 9 km 10 km 11 km 12 km"]
    texts = [f"so. {items[0]} so", "we ask 12 + 7? now", "so one two three four km so", "a zebra here", "12 + 8 and 7 12",
             "so. What is 13 plus 30 minus 7 times 4? so", "one two three five km", f"x 99 km {items[4]} 5 km y"]
    assert found_leaks(spark, items, texts) == {(0, 0): False, (1, 1): False, (2, 2): False, (3, 3): False, (7, 4): False}


def test_verbatim_parts_of_changed_runs_are_found(spark):
    item = "a 1 2 3 4 5 6 7 8 9 b 11 12 13 14"
    assert found_leaks(spark, [item], [item.replace("14", "99"), item.replace("6", "99")]) == {(0, 0): False}


def test_first_words_of_items_match_anywhere(spark):
    items = ["What is the longest river here?", "Question: Which of them\nBelongs to the set"]
    texts = [f"Question: {items[0]}", f"text\n{items[0]}", f"we ask {items[0]}", f"so. {items[0]}", f"so {items[1]}",
             "we ask Anna is the longest river here?", "so. Question. Which of them. Belongs to the set",
             "so Question: Anna of them\nBelongs to the set. Anna of them"]
    assert found_leaks(spark, items, texts) == {(i, 0): False for i in range(4)} | {(4, 1): False, (6, 1): False, (7, 1): True}


def test_exact_passages_are_found(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    bench = spark.read.parquet("/root/testdata/sf0.01/benchmark.parquet")
    items = [(r["item_id"], r["text"]) for r in bench.collect()]
    want = {(i, k) for i, t in pairs(docs) for k, x in items if x in t}
    got = {(r["doc_id"], r["item_id"]) for r in decontaminate.leaks(docs, bench).collect()}
    assert want <= got and len(got) <= 1.1 * len(want)


# 10 token files

def expected_tokens(rows):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    return {(i, t): [*tokenizer.encode(t or "", add_special_tokens=False).ids, 1] for i, t in rows}


def test_token_files(spark, documents, awkward, empty):
    for df in (documents, awkward):
        rows = tokenids.digests(tokenids.read_tokens(spark, tokenids.write_tokens(df, vocabulary()))).collect()
        ids = expected_tokens(pairs(df))
        by_doc = sorted(rows, key=lambda r: r["start"])
        assert [r["doc_id"] for r in by_doc] == sorted([i for i, _ in pairs(df)], key=lambda i: -1 if i is None else i)
        assert [r["start"] for r in by_doc] == np.cumsum([0, *(r["n_tokens"] for r in by_doc)])[:-1].tolist()
        want = sorted((i if i is not None else -1, len(x), zlib.crc32(np.array(x, "<u4").tobytes()))
                      for i, t in pairs(df) for x in [ids[i, t]])
        assert sorted((r["doc_id"] if r["doc_id"] is not None else -1, r["n_tokens"], r["ids_crc32"]) for r in rows) == want
    assert tokenids.read_tokens(spark, tokenids.write_tokens(empty, vocabulary())).count() == 0


def test_words_encode_like_whole_texts():
    encoder = tokenids.TextEncoder(vocabulary())
    text = ("don't we'll 'S 's ¿Qué? İstanbul ﬁne café ² Ⅷ <|endoftext|> x<|startoftext|>y ŉ ǅ Ω ΑΣ a\x00b \x1c z q ÷× 日本語 "
            "été   3½ ĲĳŁ _a_b_ 'reels")
    got = np.frombuffer(encoder.encode([text.encode()], 1)[0], encoder.kind).tolist()
    assert got == [*encoder.tokenizer.encode(text, add_special_tokens=False).ids, 1]


@pytest.mark.parametrize("values", [[], [0], [255, 256, 65535, 65536, 1 << 24, (1 << 32) - 1], list(range(1000))])
def test_variable_length_code(values):
    control, data = tokenids.pack(np.array(values, np.uint32))
    assert tokenids.unpack(control, data, len(values)).tolist() == values
    assert len(control) == -(-len(values) // 4) and len(data) == sum(max(1, -(-v.bit_length() // 8)) for v in values)


# queries and pipeline

def test_queries_are_complete():
    assert {q.split("_")[0] for q in QUERIES} == {f"op{n}" for n in range(1, 11)} and set(ORACLE) <= set(QUERIES)


def test_pipeline(spark):
    import corpus_pipeline

    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["language", "near_duplicates", "decontamination", "mixing", "token_files"]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, docs = docs, stage(spark, docs, FOLDER).cache()
        assert docs.columns == before.columns and docs.schema == before.schema
        if name == "near_duplicates":
            want = brute.near_duplicates(pairs(before))
            assert {i for i, _ in pairs(docs)} == {i for i, v in want.items() if v[2]}
        if name == "mixing":
            words = sum(len(brute.words(t)) for _, t in pairs(before))
            assert abs(sum(len(brute.words(t)) for _, t in pairs(docs)) - 1.5 * words) <= 20
    ids = expected_tokens(pairs(docs))
    rows = corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER).collect()
    assert sorted((r["doc_id"], r["n_tokens"]) for r in rows) == sorted((i, len(ids[i, t])) for i, t in pairs(docs))


def test_pipeline_awkward(spark, awkward, empty):
    import corpus_pipeline

    for df in (awkward, empty):
        docs = df
        for _, stage in corpus_pipeline.STAGES[:-1]:
            docs = stage(spark, docs, FOLDER)
            assert docs.columns == df.columns
        corpus_pipeline.STAGES[-1][1](spark, docs, FOLDER).collect()
    once = corpus_pipeline.keep_one_of_each_group(spark, awkward, FOLDER)
    assert sorted((r["doc_id"] for r in once.collect()), key=repr) == sorted([1, 2, 3, 4, 5, 7, 9, 10, 12, 13, None], key=repr)


def test_places_of_windows_survive_packing():
    rng = np.random.RandomState(4)
    for n in (0, 1, 2, 500):
        document = np.sort(rng.randint(-5, 40, n)).astype(np.int64)
        place = rng.randint(0, 1 << 40, n).astype(np.int64)
        place = place[np.lexsort((place, document))]
        steps = substrings.place_codes(document, place)
        assert (steps >= 0).all() and (substrings.places_from(document, steps) == place).all()
