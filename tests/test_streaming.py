"""Streams with state against the same rows as a batch; mergeable sketches."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from deskloom.operators import sketches as S
from deskloom.streaming.pair_stream import pair_reply_stream

START = dt.datetime(2024, 3, 1)
MESSAGES = "message_id bigint, ts timestamp, text string"
REPLIES = "reply_id bigint, parent_id bigint, ts timestamp, text string"


def at(minutes):
    return None if minutes is None else START + dt.timedelta(minutes=minutes)


def run(spark, folder, message_batches, reply_batches):
    """(rows, rows held at the end, rows dropped as late) of the pair stream over batches that arrive one after the other."""
    out, held, dropped = [], 0, 0
    for name, schema, batches in (("m", MESSAGES, message_batches), ("r", REPLIES, reply_batches)):
        for batch in batches:
            spark.createDataFrame(batch, schema).coalesce(1).write.mode("append").parquet(f"{folder}/{name}")
    streams = [spark.readStream.schema(s).option("maxFilesPerTrigger", 1).parquet(f"{folder}/{n}") for n, s in (("r", REPLIES), ("m", MESSAGES))]
    query = (pair_reply_stream(*streams, within="30 MINUTES", delay="10 minutes").writeStream
             .foreachBatch(lambda rows, _: out.extend(rows.collect())).option("checkpointLocation", f"{folder}/progress")
             .trigger(availableNow=True).start())
    query.awaitTermination()
    for progress in query.recentProgress:
        for state in progress["stateOperators"]:
            held = state["numRowsTotal"]
            dropped += state["numRowsDroppedByWatermark"]
    return sorted((r["reply_id"], r["message_id"]) for r in out), held, dropped


def test_reply_stream_equals_batch_and_forgets(spark, tmp_path):
    messages = [[(10 * b + i, at(60 * b + i), "m") for i in range(10)] for b in range(6)]
    replies = [[(1000 + 10 * b + i, 10 * b + i, at(60 * b + i + wait), "r") for i, wait in enumerate((0, 1, 30, 31, -1, 5, 5, 29, 2, 3))]
               for b in range(6)]
    messages[0] += [(None, at(0), "x"), (500, None, "x"), (3, at(3), "again")]
    replies[0] += [(2000, None, at(1), "x"), (2001, 5, None, "x"), (2002, 999, at(5), None), (1005, 5, at(10), "again")]
    flat = [spark.createDataFrame([r for b in batches for r in b], s) for batches, s in ((replies, REPLIES), (messages, MESSAGES))]
    wanted = sorted((r["reply_id"], r["message_id"]) for r in pair_reply_stream(*flat, within="30 MINUTES", delay="10 minutes").collect())
    got, held, dropped = run(spark, str(tmp_path), messages, replies)
    assert got == wanted and len(got) == 6 * 8 + 1 and dropped == 0
    assert held < 40  # the last batches only, of 127 rows


def test_late_replies_are_dropped(spark, tmp_path):
    messages = [[(1, at(0), "m")], [(2, at(300), "m")], [(3, at(600), "m")], [(4, at(900), "m")]]
    replies = [[(11, 1, at(5), "r")], [(12, 2, at(305), "r")], [(13, 3, at(605), "r")], [(14, 1, at(6), "late"), (15, 4, at(905), "r")]]
    got, _, dropped = run(spark, str(tmp_path), messages, replies)
    assert got == [(11, 1), (12, 2), (13, 3), (15, 4)] and dropped >= 1


def test_merged_sketches_keep_their_rank_bound(spark):
    rows = spark.range(40_000).select((F.col("id") % 2).alias("g"), (F.col("id") % 37).alias("day"),
                                      F.pmod(F.xxhash64("id"), F.lit(1_000_003)).cast("double").alias("v"))
    rows = rows.union(spark.createDataFrame([(0, 1, None), (7, 1, None)], "g bigint, day bigint, v double"))
    merged = S.merge_sketches(S.value_sketches(rows, ["g", "day"], "v"), ["g"])
    got = {r["g"]: r for r in S.sketch_percentiles(merged, ["g"], {"p50": 0.5, "p95": 0.95}).collect()}
    assert set(got) == {0, 1}
    for g, r in got.items():
        values = [x["v"] for x in rows.filter(f"g = {g} AND v IS NOT NULL").select("v").collect()]
        assert r["n"] == len(values)
        for name, share in (("p50", 0.5), ("p95", 0.95)):
            assert sum(v <= r[name] for v in values) / len(values) == pytest.approx(share, abs=0.02)
    assert S.value_sketches(rows.limit(0), ["g"], "v").count() == 0
