"""CSV and JSON files that many tasks read, against Spark's readers of whole files; containment and balanced quotas."""

import json
import random

import pytest
from hypothesis import given
from hypothesis import strategies as st

from deskloom.functions import runs
from deskloom.operators.golden import balanced_quotas
from deskloom.operators import leakage
from deskloom.operators.leakage import contained_texts, containment_report
from deskloom.sources import files, ranges

SCHEMA = "a string, b string, c string"


@pytest.fixture
def small_ranges(spark):
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "700")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def field(rng):
    kind = rng.randrange(6)
    text = "".join(rng.choice(["a", "é", ",", " ", "x", "\n", '""', "\n\n", "{", "}", "]"]) for _ in range(rng.randrange(1, 60)))
    return f'"{text}"' if kind < 4 else rng.choice(["plain", "7", "p q"])


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_csv_ranges_give_the_rows_of_one_task(spark, tmp_path, small_ranges, end):
    rng = random.Random(end)
    folder = tmp_path / f"csv{len(end)}"
    folder.mkdir()
    for name in ("one", "two"):
        lines = ["a,b,c", *(",".join(field(rng) for _ in range(3)) for _ in range(150))]
        (folder / f"{name}.csv").write_text(end.join(lines) + (end if name == "one" else ""), newline="")
    (folder / "head.csv").write_text("a,b,c\n")
    (folder / "none.csv").write_text("")
    assert spark.read.text(str(folder)).rdd.getNumPartitions() > 8
    got = sorted(map(tuple, files.scan_csv_by_ranges(spark, str(folder), SCHEMA).collect()), key=repr)
    want = sorted(map(tuple, files.scan_csv(spark, str(folder), SCHEMA).collect()), key=repr)
    assert len(got) == 300 and got == want


def value(rng, deep):
    if deep and rng.random() < 0.3:
        return {rng.choice("xyz"): value(rng, deep - 1) for _ in range(rng.randrange(3))}
    if deep and rng.random() < 0.3:
        return [value(rng, deep - 1) for _ in range(rng.randrange(4))]
    return rng.choice([None, True, 3.5, "", 'q"', "\\", "\\\\\"}", "}{][", "a\nb", "é}", "x" * 40])


@pytest.mark.parametrize("indent", [None, 2])
def test_json_ranges_give_all_elements(spark, tmp_path, small_ranges, indent):
    rng = random.Random(indent)
    rows = [{"id": i, "name": value(rng, 0), "rest": value(rng, 3)} for i in range(200)]
    folder = tmp_path / "json"
    folder.mkdir()
    (folder / "a.json").write_text(json.dumps(rows[:150], indent=indent, ensure_ascii=False))
    (folder / "b.json").write_text(json.dumps(rows[150:], indent=indent))
    (folder / "empty.json").write_text("[]")
    found = ranges.json_elements(spark, str(folder)).collect()
    assert sorted((json.loads(r["value"]) for r in found), key=lambda r: r["id"]) == rows
    assert [r["_element"] for r in sorted(found, key=lambda r: r["_element"]) if r["_file"].endswith("b.json")] == list(range(50))
    got = files.scan_json_array_by_ranges(spark, str(folder), "id int, name string").count()
    assert got == 200


def test_containment_equals_plain_search(spark):
    rng = random.Random(2)
    words = ["the", "cat", "sat", "on", "a", "mat", "Katze", "über", "x1"]
    docs = [" ".join(rng.choices(words, k=rng.randrange(0, 12))) for _ in range(80)] + ["", None, "  the   cat ", "THE CAT sat"]
    held = [" ".join(rng.choices(words, k=rng.randrange(1, 6))) for _ in range(40)]
    held += ["he cat s", "at", "a", "t", "sat on", "at on", " ", "", None, "zzz", "zzz the cat", "the cat", "The Cat ", "atz", docs[3], docs[4]]
    corpus = spark.createDataFrame(list(enumerate(docs)), "id int, customer_text string")
    golden = spark.createDataFrame([(i, t, 1) for i, t in enumerate(held)], "id int, customer_tweet string, _k int")
    got = {tuple(r) for r in contained_texts(corpus, golden).collect()}
    key = lambda t: (t or "").strip().lower()
    want = {(i, j) for i, g in enumerate(held) for j, d in enumerate(docs) if key(g) and key(g) in key(d)}
    assert got == want
    report = containment_report(corpus, golden).first()
    keys = {key(g) for g in held if key(g)}
    assert (report["golden_size"], report["contained"]) == (len(keys), len({key(held[i]) for i, _ in want}))
    assert contained_texts(corpus.limit(0), golden).count() == contained_texts(corpus, golden.limit(0)).count() == 0


@given(st.dictionaries(st.sampled_from("abcdefg"), st.integers(0, 30)), st.integers(0, 150))
def test_balanced_quotas_level_the_classes(sizes, wanted):
    got = balanced_quotas(sizes, "abcdefg", wanted)
    assert sum(got.values()) == min(wanted, sum(sizes.values()))
    top = max(got.values())
    assert all(n == sizes.get(c, 0) or top - n <= 1 for c, n in got.items())


def test_containment_of_long_and_short_texts_is_exact_and_shows_few_runs(spark, monkeypatch):
    """Long texts are routed by sampled runs, short ones by all of theirs; what is stored grows with hits, not with words."""
    rng = random.Random(5)
    word = lambda: f"w{rng.randint(0, 400)}"
    docs = [" ".join(word() for _ in range(rng.randint(1, 120))) for _ in range(150)]
    inside = [d[rng.randint(0, 4):max(6, len(d) - rng.randint(0, 9))] for d in docs[::5]] + docs[::7]
    held = inside + ["w1", "w1 w2", "w39 w4 ", " ".join(docs[3].split()[2:7]), "not there at all", " ", None]
    corpus = spark.createDataFrame(list(enumerate(docs)) + [(None, docs[0]), (1000, None)], "id int, customer_text string")
    golden = spark.createDataFrame(list(enumerate(held)), "id int, customer_tweet string")
    stored, tables = leakage.stored, {}

    def kept(df, name="step", *rest):
        tables.setdefault(name, []).append(stored(df, name, *rest))
        return tables[name][-1]

    monkeypatch.setattr(leakage, "stored", kept)
    want = {(i, j) for i, h in enumerate(held) if h and h.strip() for j, d in enumerate(docs) if h.strip().lower() in d}
    assert {tuple(r) for r in contained_texts(corpus, golden).collect()} == want
    # Golden texts travel once a pair, not once a run; the runs of corpus texts that are shown are sampled ones.
    assert tables["runs"][0].columns == ["_n", "_few", "run"]
    assert tables["found"][0].count() < sum(len(d.split()) for d in docs) / 8
    monkeypatch.setattr(leakage, "SENT_ROWS", 0)
    assert {tuple(r) for r in contained_texts(corpus, golden).collect()} == want


def test_texts_that_share_a_common_line_are_not_all_compared(spark, monkeypatch):
    """Where every sampled run of a held-out text is common, the words around it still tell which texts can hold it."""
    line = " ".join(f"common{i}" for i in range(40))
    docs = [f"a w{i} {line} v{i} b" for i in range(60)] + [f"a w{i} {line}" for i in range(60)]
    held = docs[:30] + ["w3", "common4", f"{line} v7", line]
    corpus = spark.createDataFrame(list(enumerate(docs)), "id int, customer_text string")
    golden = spark.createDataFrame(list(enumerate(held)), "id int, customer_tweet string")
    stored, tables = leakage.stored, {}

    def kept(df, name="step", *rest):
        tables[name] = stored(df, name, *rest)
        return tables[name]

    monkeypatch.setattr(leakage, "stored", kept)
    want = {(i, j) for i, h in enumerate(held) for j, d in enumerate(docs) if h in d}
    for anchors in (1 << 20, 9):
        monkeypatch.setattr(leakage, "SENT_ANCHORS", anchors)
        assert {tuple(r) for r in contained_texts(corpus, golden).collect()} == want
        assert tables["routed"].count() <= len(want) + len(docs)


def test_runs_are_alike_wherever_they_stand():
    import pyarrow as pa

    long = "x" * 200
    texts = pa.array(["skipped", None, f"a  b {long} é", f"q a b {long} é\u2003c", "", long[1:]]).slice(1)
    words, hashes, place = runs.cut(texts)
    assert len(words) == len(hashes) == len(place) and list(place) == [0, 1, 1, 1, 1, 2, 2, 2, 2, 2, 2, 3, 4]
    run, of = runs.runs_of(hashes, place, 3)
    of = place[of]
    assert set(run[of == 1]) < set(run[of == 2]) and len(set(run[of == 2])) == 4
    table = runs.empty_filter(len(run))
    runs.add(table, run)
    assert runs.passing(table, run).all() and not runs.passing(table, hashes).all()
