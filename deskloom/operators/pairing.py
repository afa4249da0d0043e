"""Reply-to-message pairing, brand selection and class-capped collection."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from deskloom.functions import text as T
from deskloom.functions.rules import FLAGS, RuleSet, label_class
from deskloom.operators.skew import HEAVY_ROWS, first_per_key, skew_join, top_n_per_group
from deskloom.session import stored


def outbound(messages: DataFrame) -> DataFrame:
    return messages.filter(~F.col("inbound"))


def replies_by_signal(messages: DataFrame, signal_pattern: str, top: int = 5) -> DataFrame:
    """All outbound rows of the ``top`` authors with most outbound texts matching the pattern."""
    sent = outbound(messages)
    authors = (sent.filter(F.col("text").rlike(FLAGS + signal_pattern))
               .groupBy("author_id").agg(F.count("*").alias("_n"))
               .orderBy(F.desc("_n"), "author_id").limit(top).select("author_id"))
    return sent.join(F.broadcast(authors), "author_id", "left_semi").select(*messages.columns)


def brand_replies(messages: DataFrame, brand_author: str, signal_pattern: str, top: int = 5) -> DataFrame:
    """Outbound rows of the brand author if that author exists, else of the authors chosen by signal pattern.

    The existence test reads one column and stops at the first hit.
    """
    by_name = outbound(messages).filter(F.col("author_id") == brand_author)
    if by_name.select("author_id").limit(1).count():
        return by_name
    return replies_by_signal(messages, signal_pattern, top)


def linked(replies: DataFrame) -> DataFrame:
    return replies.filter(F.coalesce(F.col("in_response_to_tweet_id"), F.lit("")) != "")


def reply_targets(messages: DataFrame, replies: DataFrame) -> DataFrame:
    """Messages some reply answers. The id side is reduced to distinct ids before the join."""
    ids = linked(replies).select(F.col("in_response_to_tweet_id").alias("tweet_id")).distinct()
    named = messages.filter(F.col("tweet_id") != "")
    return named.join(ids, "tweet_id", "left_semi").select(*messages.columns)


def parents(messages: DataFrame, replies: DataFrame) -> DataFrame:
    """(tweet_id, customer_raw): one text per answered id; of rows that share an id the last one counts.

    Ids and row numbers decide first; texts are fetched for the chosen rows only.
    """
    answered = linked(replies).select(F.col("in_response_to_tweet_id").alias("tweet_id")).distinct()
    rows = messages.filter(F.col("tweet_id") != "").select("tweet_id", "seq", F.col("text").alias("customer_raw"))
    latest = rows.join(answered, "tweet_id", "left_semi").groupBy("tweet_id").agg(F.max("seq").alias("seq"))
    return rows.join(latest, ["tweet_id", "seq"], "left_semi").drop("seq")


def pair_replies(replies: DataFrame, messages: DataFrame, heavy_rows: int = HEAVY_ROWS) -> DataFrame:
    """Inner join of each reply with the message it answers; safe when one message draws most replies."""
    sent = linked(replies).select(F.col("in_response_to_tweet_id").alias("tweet_id"),
                                  F.col("tweet_id").alias("agent_tweet_id"),
                                  F.col("text").alias("agent_raw"), "seq")
    return skew_join(sent, parents(messages, replies), "tweet_id", spread="agent_tweet_id", min_rows=heavy_rows)


def first_reply_pairs(replies: DataFrame, messages: DataFrame, min_chars: int = 15) -> DataFrame:
    """Cleaned (customer_text, agent_text) pairs, the first long-enough reply per message.

    Later replies to the same message share its text key and would be dropped as duplicates anyway. Dropping them by a
    map-side combined aggregation of (id, row number) before the join removes the skew of heavily answered messages.
    """
    sent = linked(replies).select(F.col("in_response_to_tweet_id").alias("tweet_id"), "seq",
                                  F.col("tweet_id").alias("agent_tweet_id"), "text")
    usable = sent.filter(T.long_enough(T.clean_text(F.col("text")), min_chars))
    first = usable.groupBy("tweet_id").agg(F.min("seq").alias("seq"))
    chosen = sent.join(first, ["tweet_id", "seq"], "left_semi").withColumn("agent_text", T.clean_text(F.col("text"))).drop("text")
    asked = (parents(messages, replies)
             .select("tweet_id", T.clean_text(F.col("customer_raw")).alias("customer_text"))
             .filter(T.long_enough(F.col("customer_text"), min_chars)))
    return chosen.join(asked, "tweet_id")


def dedupe_by_text(pairs: DataFrame, text: str = "customer_text", order: str = "seq") -> DataFrame:
    """First row in file order per text key. The key travels as a digest; rows are picked by their number."""
    keyed = pairs.withColumn("_key", T.key_digest(T.text_key(F.col(text))))
    return first_per_key(keyed, "_key", order).drop("_key")


def cap_per_class(rows: DataFrame, cap: int, label: str = "class", order: str = "seq", rank: str = "rn") -> DataFrame:
    """First ``cap`` rows per class in file order."""
    return top_n_per_group(rows, [label], [F.col(order)], cap, spread=order, rank=rank)


def class_cap(max_pairs: int, n_classes: int) -> int:
    return max(10, max_pairs // n_classes)


def class_positions(capped: DataFrame, classes, label: str = "class", rank: str = "rn",
                    name: str = "position") -> DataFrame:
    """0-based position in (class order, rank): rank plus the sizes of the classes before it, no global sort."""
    order = {c: i for i, c in enumerate(classes)}
    ordinal = F.create_map(*[F.lit(x) for kv in order.items() for x in kv])
    sizes = capped.groupBy(label).agg(F.count("*").alias("_n"))
    before = Window.orderBy(ordinal[F.col(label)]).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(label, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    return (capped.join(F.broadcast(offsets), label)
            .withColumn(name, (F.col("_offset") + F.col(rank) - 1).cast("long")).drop("_offset"))


def support_pairs(messages: DataFrame, replies: DataFrame, rules: RuleSet, default_class: str,
                  max_pairs: int = 3000, min_chars: int = 15) -> DataFrame:
    """Cleaned, deduplicated pairs, at most ``max(10, max_pairs // classes)`` per class, with class and position."""
    pairs = dedupe_by_text(stored(first_reply_pairs(replies, messages, min_chars), "first-replies"))
    labelled = pairs.withColumn("class", label_class(F.col("customer_text"), rules, default_class)["class"])
    # At most cap x classes rows; stored because numbering and later checks read them again.
    capped = stored(cap_per_class(labelled, class_cap(max_pairs, len(rules))), "pairs")
    return class_positions(capped, list(rules))
