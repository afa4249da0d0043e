"""Row-local operators and windowed counts on a stream of events."""

from __future__ import annotations

from pyspark.sql import functions as F

from deskloom.queries import sql
from deskloom.queries.registry import query, table
from deskloom.session import scratch_path
from deskloom.streaming.pair_stream import pair_reply_stream
from deskloom.streaming.triage_stream import drop_repeats, triage_rows, windowed_counts

EVENT_RULES = {"problem": [r"error"], "sale": [r"purchase"], "visit": [r"view", r"click"]}
EVENT_STEPS = [("LOW_CONFIDENCE_AMBIGUITY", "LOW", "Route to a person.", [r'error.*"k": [89]'])]


def _stream(spark, folder):
    """The event table as a file stream of texts: one file, cut into four by time, so it arrives in four batches."""
    path = scratch_path(spark, "event-stream")
    texts = table(spark, folder, "events").select(
        "event_id", F.col("ts").cast("timestamp").alias("ts"), F.concat("event_type", F.lit("  "), "props").alias("text"))
    texts.repartitionByRange(4, "ts").write.parquet(path)
    return spark.readStream.schema(texts.schema).option("maxFilesPerTrigger", 1).parquet(path)


def _drain(spark, rows, mode="append"):
    """Run the stream over what is there into a Parquet sink and read the sink."""
    out = scratch_path(spark, "sink")
    (rows.writeStream.format("parquet").option("path", out).outputMode(mode)
     .option("checkpointLocation", scratch_path(spark, "progress")).trigger(availableNow=True).start().awaitTermination())
    return spark.read.schema(rows.schema).parquet(out)


def _final(spark, rows):
    """Run an aggregating stream and read its last state: every batch replaces the table, so open windows are in it."""
    out = scratch_path(spark, "state")
    (rows.writeStream.foreachBatch(lambda batch, _: batch.write.mode("overwrite").parquet(out)).outputMode("complete")
     .option("checkpointLocation", scratch_path(spark, "progress")).trigger(availableNow=True).start().awaitTermination())
    return spark.read.schema(rows.schema).parquet(out)


_TEXT = sql.clean("event_type || '  ' || props")
_TRIAGED = f"""t AS (SELECT event_id, ts, {_TEXT} AS text FROM events),
triaged AS (SELECT *, {sql.best_class(sql.hit_list('text', EVENT_RULES), list(EVENT_RULES), 'other')} AS class,
  CASE WHEN {sql.any_match('text', EVENT_STEPS[0][3])} THEN 'ESCALATE_TO_HUMAN' ELSE 'AUTO_HANDLE' END AS decision FROM t)"""


@query(f"WITH {_TRIAGED} SELECT event_id, text, class, decision FROM triaged")
def triage_stream(spark, folder):
    rows = triage_rows(_stream(spark, folder), EVENT_RULES, "other", steps=EVENT_STEPS)
    return _drain(spark, rows).select("event_id", "text", "class", "decision")


@query(f"""WITH {_TRIAGED}, w AS (SELECT time_bucket(INTERVAL 1 DAY, ts) AS window_start, class, decision, count(*) AS n
  FROM triaged GROUP BY ALL) SELECT strftime(window_start, '%Y-%m-%d') AS day, class, decision, n FROM w""")
def triage_stream_windows(spark, folder):
    """Counts per day, class and decision, those of days that are still open, too."""
    rows = triage_rows(_stream(spark, folder), EVENT_RULES, "other", steps=EVENT_STEPS)
    counts = _final(spark, windowed_counts(rows, window="1 day", delay="1 hour"))
    return counts.select(F.date_format("window_start", "yyyy-MM-dd").alias("day"), "class", "decision", "n")


@query(f"""WITH {_TRIAGED} SELECT strftime(time_bucket(INTERVAL 1 DAY, ts), '%Y-%m-%d') AS day, class, decision, count(*) AS n
FROM triaged GROUP BY ALL""")
def triage_batch_windows(spark, folder):
    """The same operators on the batch table."""
    texts = table(spark, folder, "events").select(
        F.col("ts").cast("timestamp").alias("ts"), F.concat("event_type", F.lit("  "), "props").alias("text"))
    counts = windowed_counts(triage_rows(texts, EVENT_RULES, "other", steps=EVENT_STEPS), window="1 day")
    return counts.select(F.date_format("window_start", "yyyy-MM-dd").alias("day"), "class", "decision", "n")


@query("SELECT event_type || ' ' || user_id % 50 AS text, count(DISTINCT event_type) AS n FROM events GROUP BY ALL")
def stream_first_messages(spark, folder):
    """One message per text key over a stream of several batches; the watermark delay spans the whole table."""
    path = scratch_path(spark, "event-stream")
    texts = table(spark, folder, "events").select(
        F.col("ts").cast("timestamp").alias("ts"),
        F.concat("event_type", F.lit(" "), (F.col("user_id") % 50).cast("string")).alias("text"))
    texts.repartitionByRange(3, "ts").write.parquet(path)
    stream = spark.readStream.schema(texts.schema).option("maxFilesPerTrigger", 1).parquet(path)
    return _drain(spark, drop_repeats(stream, delay="3650 days")).groupBy("text").agg(F.count("*").alias("n"))


_PARENT = "event_id - event_id % 7 - 1"


def _ordered_stream(spark, rows, batches=4):
    """The rows as a file stream whose batches arrive in the order of time, written one after the other."""
    path = scratch_path(spark, "ordered-stream")
    edges = rows.agg(F.percentile_approx("ts", [i / batches for i in range(1, batches)])).first()[0] or []
    number = sum(((F.col("ts") > F.lit(e)).cast("int") for e in edges), F.lit(0))
    for batch in range(batches):
        rows.filter(F.coalesce(number, F.lit(0)) == batch).coalesce(1).write.mode("append").parquet(path)
    return spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", 1).parquet(path)


@query(f"""WITH r AS (SELECT event_id AS reply_id, {_PARENT} AS parent_id, ts, props FROM events WHERE event_id % 3 = 1)
SELECT r.reply_id, m.event_id AS message_id, m.event_type AS message_text, r.props AS reply_text
FROM r JOIN events m ON r.parent_id = m.event_id AND r.ts >= m.ts AND r.ts <= m.ts + INTERVAL 30 MINUTE""")
def stream_reply_pairs(spark, folder):
    """Two streams of events joined as replies and messages, in four batches, with state that expires."""
    events = table(spark, folder, "events").withColumn("ts", F.col("ts").cast("timestamp"))
    messages = _ordered_stream(spark, events.select(F.col("event_id").alias("message_id"), "ts", F.col("event_type").alias("text")))
    replies = _ordered_stream(spark, events.filter("event_id % 3 = 1").select(
        F.col("event_id").alias("reply_id"), F.expr(_PARENT).alias("parent_id"), "ts", F.col("props").alias("text")))
    pairs = pair_reply_stream(replies, messages, within="30 MINUTES", delay="1 hour")
    return _drain(spark, pairs).select("reply_id", "message_id", "message_text", "reply_text")
