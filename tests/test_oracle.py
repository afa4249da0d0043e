"""Every registered query against its oracle SQL on the small tables."""

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import verify  # noqa: E402
from deskloom.queries.catalog import ORACLE, QUERIES  # noqa: E402

FOLDER = "/root/testdata/sf0.001"
# Checked by brute force or invariants elsewhere; their parts have SQL.
NO_ORACLE = {"stop_words_default_list", "benchmark_report", "classify_with_model", "triage_with_model", "rouge_n_stemmed",
             "rouge_l", "word_stems", "text_similarity"}
# Both sides give no row on the smallest tables.
MAY_BE_EMPTY: set[str] = set()


@pytest.fixture(scope="module")
def connection():
    return verify.connect(FOLDER)


@pytest.mark.skipif(not os.path.isdir(FOLDER), reason="test tables not present")
@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, connection, name):
    status, note, _ = verify.compare(spark, FOLDER, name, connection)
    assert status == ("rows" if name in NO_ORACLE else "EMPTY" if name in MAY_BE_EMPTY else "ok"), note


def test_oracle_names():
    assert set(QUERIES) - set(ORACLE) == NO_ORACLE
