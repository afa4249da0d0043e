"""Headline queries on local[$BENCH_CPUS] over $BENCH_SF_DIR; prints one JSON line.

Each query runs once to warm up the JVM and is then timed; the result rows are consumed by a no-op sink. ``rows_per_sec``
relates the rows of the table that a query reads most of to its time. ``index_build`` and ``index_search`` time the two
halves of case retrieval apart; the queries on cases search an index that their first run has built.
"""

from __future__ import annotations

import json
import os
import re
import time

HEADLINE = [
    "corpus_class_counts", "support_pairs", "clean_text", "first_wins_dedupe", "leakage_report", "golden_sample",
    "label_class", "label_escalation", "escalation_cascade", "draft_replies", "rubric", "keyword_baseline_answers",
    "classification_metrics", "confusion_matrix", "agreement_report", "percentile_95", "word_tokens",
    "tfidf_weights", "top_cases", "triage_decisions", "rouge_n_unstemmed", "bleu", "text_similarity",
    "benchmark_report",
]


# The table whose rows a query works through; conversations where none is named.
LARGEST = {"documents": ["clean_text", "first_wins_dedupe", "leakage_report", "golden_sample", "label_class", "label_escalation",
                         "escalation_cascade", "draft_replies", "rubric", "keyword_baseline_answers", "classification_metrics",
                         "confusion_matrix", "word_tokens", "tfidf_weights"],
           "orders": ["agreement_report", "percentile_95"], "benchmark": ["top_cases", "triage_decisions", "benchmark_report"]}


def retrieval_halves(spark, folder: str) -> dict[str, float]:
    from deskloom.operators.caseindex import CaseIndex
    from deskloom.queries import inputs
    from deskloom.queries.cases import CASES

    asked = spark.read.parquet(f"{folder}/benchmark.parquet").selectExpr("item_id AS query_id", "text")
    started = time.perf_counter()
    index = CaseIndex.build(inputs.lang_corpus(spark, folder), "id", "customer_text", CASES)
    built = time.perf_counter()
    index.search(asked, "query_id", "text", 9).write.format("noop").mode("overwrite").save()
    return {"index_build": round(built - started, 3), "index_search": round(time.perf_counter() - built, 3)}


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    from deskloom.queries.catalog import QUERIES
    from deskloom.session import local_session

    spark = local_session(cpus, os.environ.get("BENCH_MEMORY", "16g"), shuffle_partitions=max(8, int(cpus)))
    names = os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",")

    def run(name: str) -> float:
        started = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        return round(time.perf_counter() - started, 3)

    timings = {}
    for name in names:
        run(name)
        timings[name] = run(name)
    rows = {t: spark.read.parquet(f"{folder}/{t}.parquet").count() for t in ("documents", "orders", "benchmark", "conversations")}
    table_of = {name: t for t, queries in LARGEST.items() for name in queries}
    speed = {name: round(rows[table_of.get(name, "conversations")] / max(sec, 1e-3)) for name, sec in timings.items()}
    scale = re.search(r"sf([0-9.]+)", folder)
    print(json.dumps({"metric": "headline_total", "value": round(sum(timings.values()), 3), "unit": "sec",
                      "queries": timings, "sf": float(scale.group(1)) if scale else None, "cpus": int(cpus),
                      "rows_per_sec": speed, **retrieval_halves(spark, folder)}))


if __name__ == "__main__":
    main()
