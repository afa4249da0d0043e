"""Fill-in-the-middle, vector joins and the filter audit against brute force and on awkward rows."""

import hashlib
import math
import random
import re
from itertools import permutations

import numpy as np
import pytest
from pyspark.sql import functions as F

from deskloom.llm import filteraudit, infill, vectors
from tests.llm.test_llm import AWKWARD, table

UNIT = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")


# Fill-in-the-middle ---------------------------------------------------------------------------------------------------

def plain_infill(doc_id, text):
    text = text or ""
    digest = hashlib.sha256(f"42:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i:8 * i + 8], 16) for i in range(4)]
    units = UNIT.findall(text)
    a, b = sorted((h[0] % (len(units) + 1), h[1] % (len(units) + 1)))
    if not text or re.search("<[PSM]>", text) or h[2] % 100 >= 50:
        return doc_id, len(units), "plain", None, None, text
    p, m, s = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    if h[3] % 100 < 80:
        return doc_id, len(units), "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return doc_id, len(units), "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


MARKED = [(i, t, "en", "a") for i, t in enumerate(
    ["a <P> b", "x<S", "<M>", "> a < b", "<P", "S> tail ", "  ", "\n\n", "é ü  \U0001f600 x\t", "word", "<", ">", "a<b>c"] * 12, 100)]


def test_infill_equals_plain_cuts_and_restores_every_text(spark):
    rows = table(spark, AWKWARD + MARKED).repartition(3)
    got = infill.fill_in_middle(rows).withColumn("back", infill.restored(F.col("output"), F.col("form"))).collect()
    want = sorted((plain_infill(r[0], r[1]) for r in AWKWARD + MARKED), key=repr)
    assert sorted((tuple(r)[:6] for r in got), key=repr) == want
    assert {r["form"] for r in got} == {"plain", "psm", "spm"}
    texts = {(r[0], r[1] or "") for r in AWKWARD + MARKED}
    assert all((r["doc_id"], r["back"]) in texts for r in got)


def test_infill_rates_are_parameters_and_empty_tables_pass(spark):
    assert infill.fill_in_middle(table(spark, [])).count() == 0
    rows = table(spark, [(i, f"a b c {i}", "en", "a") for i in range(300)])
    none = infill.fill_in_middle(rows, rules=infill.Infill(changed_percent=0)).filter("form <> 'plain'").count()
    psm = infill.fill_in_middle(rows, rules=infill.Infill(changed_percent=100, spm_percent=0)).filter("form = 'psm'").count()
    assert (none, psm) == (0, 300)


def test_units_take_linear_time():
    import regex

    text = ("x " * 200_000 + " " * 200_000)
    assert len(regex.compile(infill.UNITS).fullmatch(text).ends(1)) == 200_001


# Vectors --------------------------------------------------------------------------------------------------------------

def brute_links(rows, cosine=0.9):
    """{id: (links, component, kept)} by comparing all pairs; the smallest vector of an id counts."""
    ids = sorted({i for i, _ in rows if i is not None})
    chosen = {}
    for i, v in rows:
        if i is not None and v is not None:
            chosen[i] = min(chosen.get(i, v), v, key=lambda x: [(-math.inf if c is None else math.inf if math.isnan(c) else c) for c in x])
    good = {i: np.array(v, float) for i, v in chosen.items()
            if v and all(c is not None and math.isfinite(c) for c in v) and any(v)}
    unit = {i: v / np.abs(v).max() / np.linalg.norm(v / np.abs(v).max()) for i, v in good.items()}
    parent, links, order = {i: i for i in ids}, dict.fromkeys(ids, 0), sorted(unit)

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for n, a in enumerate(order):
        for b in order[n + 1:]:
            if len(unit[a]) == len(unit[b]) and unit[a] @ unit[b] >= cosine:
                links[a] += 1
                links[b] += 1
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {i: (links[i], find(i), find(i) == i) for i in ids}


def as_dict(df):
    return {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in df.collect()}


def vector_table(spark, rows, kind="float"):
    extra = [(i, v, 7, 1, 2, 3, 4) for i, v in rows]
    return spark.createDataFrame(extra, f"vec_id bigint, embedding array<{kind}>, label int, node int, v int, box int, weight int")


def near_rows(dims=24, groups=40, members=8, seed=3):
    """Groups around centres at noise levels on both sides of the threshold, with exact and scaled copies and lone vectors."""
    rng = np.random.RandomState(seed)
    rows = []
    for g in range(groups):
        centre = rng.randn(dims)
        centre /= np.linalg.norm(centre)
        for _ in range(members):
            noise = rng.randn(dims) / math.sqrt(dims) * rng.choice([0.05, 0.25, 0.33, 0.45])
            rows.append((centre + noise).astype(np.float32).tolist())
        rows += [rows[-1], [2 * x for x in rows[-1]]]
    rows += rng.randn(100, dims).astype(np.float32).tolist()
    order = rng.permutation(len(rows))
    return [(int(i) * 3, rows[j]) for i, j in enumerate(order)]


@pytest.mark.parametrize("rules", [
    vectors.Subspaces(), vectors.Subspaces(block_dims=4, box_vectors=30, cell_vectors=12, strip_vectors=50, sample=256),
    vectors.Subspaces(block_dims=8, box_vectors=16, rotated_dims=2), vectors.Subspaces(block_dims=100, box_vectors=50, sample=64)])
def test_vector_links_equal_brute_force_with_any_cuts(spark, rules):
    rows = near_rows()
    assert as_dict(vectors.near_vectors(vector_table(spark, rows).repartition(4), rules=rules)) == brute_links(rows)


def test_vectors_that_cannot_be_compared_stay_alone(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, None), (2, []), (3, [0.0, 0.0]), (4, [1.0, None]), (5, [nan, 1.0]), (6, [inf, 1.0]), (7, [1.0, 1.0]), (8, [2.0, 2.0]),
            (9, [1.0, 1.0, 0.0]), (10, [1.0, 1.0, 0.001]), (11, [-1.0, -1.0]), (12, [1.0]), (13, [5.0]), (14, [-0.0, 3.0]),
            (15, [0.0, 3.0]), (16, [1e300, 1e300]), (17, [1e-300, 1e-300]), (18, [7.0, 7.0]), (18, [7.0, 7.0]), (18, None),
            (19, [1.0, -1.0]), (19, [3.0, 3.0])]
    got = as_dict(vectors.near_vectors(vector_table(spark, rows + [(None, [1.0, 1.0])], "double")))
    nameless = got.pop(None)
    assert nameless == (0, None, True)
    assert got == brute_links(rows)
    assert got[7] == (4, 7, True) and got[9] == (1, 9, True) and got[12] == (1, 12, True) and got[19][1] == 19
    assert vectors.near_vectors(vector_table(spark, [])).count() == 0
    assert as_dict(vectors.near_vectors(vector_table(spark, [(1, None)]))) == {1: (0, 1, True)}


def test_a_group_of_near_copies_is_dealt_to_cells(spark):
    rng = np.random.RandomState(5)
    centre = rng.randn(16)
    rows = [(i, (centre + 0.02 * rng.randn(16)).tolist()) for i in range(400)] + [(400 + i, centre.tolist()) for i in range(200)]
    rules = vectors.Subspaces(box_vectors=100, cell_vectors=50, strip_vectors=120)
    got = as_dict(vectors.near_vectors(vector_table(spark, rows, "double"), rules=rules))
    assert set(got.values()) == {(599, 0, False), (599, 0, True)}


def test_every_pair_in_reach_meets_once_in_a_tree():
    rng = np.random.RandomState(1)
    points, budget = rng.randn(300, 5), 1.5
    tree = vectors.cuts(points, 16)
    home, who, where = vectors.places(points, tree, budget)
    assert len(set(home.tolist())) == 16
    visits = set(zip(who.tolist(), where.tolist()))
    for a in range(300):
        for b in range(a):
            if ((points[a] - points[b]) ** 2).sum() <= budget and home[a] != home[b]:
                assert ((a, home[b]) in visits) != ((b, home[a]) in visits)


# Filter audit ---------------------------------------------------------------------------------------------------------

def fails(text, copied):
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    return {f for f, bad in zip("ABCDE", (
        len(words) < 100, 100 * len(set(words)) < 80 * len(words), 100 * len(re.findall("[A-Z]", text)) > 10 * len(text),
        re.search(r"[#$%&*|]", text) is not None, copied)) if bad}


def brute_audit(docs, labels):
    seen, rows = {}, []
    for doc_id, text, _, _ in docs:
        if doc_id is not None:
            seen[text or ""] = min(seen.get(text or "", doc_id), doc_id)
    for doc_id, text, lang, _ in docs:
        text = text or ""
        good, toxic = ({(i, k) for i, *v in labels if i is not None for k, x in zip("qt", v) if x == 1} & {(doc_id, c)} != set() for c in "qt")
        rows.append((lang or "", fails(text, doc_id is not None and text in seen and seen[text] < doc_id), good, toxic))
    out = {}
    for part in {r[0] for r in rows}:
        own = [r for r in rows if r[0] == part]
        for order in permutations("ABCDE"):
            left = own
            for step, f in enumerate(order, 1):
                gone = [r for r in left if f in r[1]]
                out[part, "".join(order), step] = [
                    len(left) - len(gone), len(gone), sum(f in r[1] for r in own) - len(gone), sum(r[1] == {f} for r in own),
                    sum(r[2] for r in gone), sum(r[3] for r in gone)]
                left = [r for r in left if f not in r[1]]
        for f in "ABCDE":
            own_cells = [k for k in out if k[0] == part and k[1][k[2] - 1] == f]
            total = sum(out[k][1] for k in own_cells)
            for k in own_cells:
                out[k].append(total)
    return out


def audit_rows():
    rng = random.Random(4)
    texts = []
    for i in range(120):
        n = rng.choice([20, 99, 100, 130])
        words = [rng.choice("abcdefgh") * rng.randrange(1, 3) if i % 3 == 0 else f"w{rng.randrange(2000)}" for _ in range(n)]
        texts.append(" ".join(words).upper() if i % 5 == 0 else " ".join(words) + rng.choice(["", "", " #", " 5 %"]))
    texts += texts[:25] + ["", None, "", " "]
    rng.shuffle(texts)
    return [(i if i % 17 else None, t, rng.choice(["en", "de", None, ""]), "s") for i, t in enumerate(texts)] + [(3, texts[3], "en", "s")]


@pytest.mark.parametrize("docs", [audit_rows(), AWKWARD])
def test_filter_audit_equals_brute_force(spark, docs):
    labels = [(i, i % 2 if i % 5 else None, int(i % 7 == 0)) for i in range(0, 150, 2)] + [(4, 1, 1), (4, 0, None), (None, 1, 1)]
    label_table = spark.createDataFrame([(*x, "u", 1) for x in labels], "doc_id bigint, quality int, toxic int, part string, mask int")
    got = filteraudit.filter_audit(table(spark, docs).repartition(3), label_table).collect()
    assert {tuple(r)[:3]: list(tuple(r)[3:]) for r in got} == brute_audit(docs, labels)


def test_filter_audit_of_an_empty_table(spark):
    labels = spark.createDataFrame([], "doc_id bigint, quality int, toxic int")
    assert filteraudit.filter_audit(table(spark, []), labels).count() == 0


def test_ranks_number_the_orders():
    for n in (1, 3, 5):
        assert [filteraudit.rank(p, n) for p in permutations(range(n))] == list(range(math.factorial(n)))
    assert [filteraudit.rank((p,), 5) for p in range(5)] == [0, 24, 48, 72, 96]


# Near copies that are not linked with the centre of their bucket -------------------------------------------------------

def test_edited_copies_meet_in_cells_and_few_pairs_leave_them(spark, monkeypatch):
    """Copies of one text with 4 to 6 edits: hardly any is similar enough to another, and no list of their pairs is made."""
    from deskloom.llm import neardup
    from tests.llm import brute

    rng = random.Random(8)
    text = [f"w{rng.randrange(400)}" for _ in range(150)]
    docs, counts = [], {}
    for i in range(400):
        copy = list(text)
        for place in rng.sample(range(150), rng.choice([4, 5, 6])):
            copy[place] = f"w{rng.randrange(400)}"
        docs.append((i, " ".join(copy)))
    store = neardup.stored

    def counted(df, name="step"):
        made = store(df, name)
        counts[name] = made.count()
        return made

    monkeypatch.setattr(neardup, "stored", counted)
    frame = spark.createDataFrame(docs, "doc_id bigint, text string").repartition(3)
    for cell in (2048, 40):
        got = neardup.near_duplicates(frame, rules=neardup.NearDup(cell_members=cell)).collect()
        assert {r["doc_id"]: tuple(r)[1:] for r in got} == brute.near_duplicates(docs)
        assert counts["possible-rest"] < 0.02 * len(docs) * (len(docs) - 1) / 2, counts


def test_pairs_just_under_the_threshold_are_no_rows(spark, monkeypatch):
    """Many texts as far apart from each other as estimates cannot tell from linked ones: rows grow with texts, not with pairs."""
    from deskloom.llm import neardup
    from tests.llm import brute

    base = [f"w{i}" for i in range(400)]
    docs = {i: " ".join(w if j % 33 or j == 0 else f"x{i}-{j}" for j, w in enumerate(base)) for i in range(60)}
    docs |= {1000 + i: t + f" more{i}" for i, t in docs.items()}
    kept, tables = neardup.stored, {}

    def stored(df, name="step"):
        tables[name] = kept(df, name)
        return tables[name]

    monkeypatch.setattr(neardup, "stored", stored)
    rows = neardup.near_duplicates(spark.createDataFrame(list(docs.items()), "doc_id long, text string")).collect()
    assert {r["doc_id"]: (r["n_shingles"], r["component_id"], r["kept"]) for r in rows} == brute.near_duplicates(docs.items())
    assert {r["component_id"] for r in rows} == set(range(60))
    assert 0 < tables["possible-rest"].select("node").distinct().count() <= len(docs)
    assert set(tables["possible-rest"].columns) == {"key", "node"} and tables["confirmed-rest"].count() <= len(docs)
