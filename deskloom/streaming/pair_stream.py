"""Replies meet the messages they answer while both arrive."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def pair_reply_stream(replies: DataFrame, messages: DataFrame, within: str = "1 day", delay: str = "1 hour") -> DataFrame:
    """(reply_id, message_id, message_ts, reply_ts, message_text, reply_text) of replies at most ``within`` after their message.

    ``replies``: reply_id, parent_id, ts, text; ``messages``: message_id, ts, text; streams or batches. Either may come first.
    A row waits until no partner can arrive any more: ``within`` and ``delay`` bound what is held. Rows later than ``delay``
    behind the newest are dropped on streams. Null ids and times pair with nothing; repeated rows pair each.
    """
    asked, answers = (rows.withWatermark("ts", delay) if rows.isStreaming else rows for rows in (messages, replies))
    asked = asked.select("message_id", F.col("ts").alias("message_ts"), F.col("text").alias("message_text"))
    answers = answers.select("reply_id", "parent_id", F.col("ts").alias("reply_ts"), F.col("text").alias("reply_text"))
    near = (F.col("reply_ts") >= F.col("message_ts")) & (F.col("reply_ts") <= F.col("message_ts") + F.expr(f"INTERVAL {within}"))
    return answers.join(asked, (F.col("parent_id") == F.col("message_id")) & near).select(
        "reply_id", "message_id", "message_ts", "reply_ts", "message_text", "reply_text")
