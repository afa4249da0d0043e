"""Rule predicates and rule labelling as Column expressions.

A rule set is an ordered ``dict`` of class to regex list. Patterns are constants in the plan, so each is compiled once
per task, and labelling is a row-local projection that never shuffles.
"""

from __future__ import annotations

import re
import sys
from collections.abc import Iterator, Mapping, Sequence
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType

from deskloom.functions.text import bind

# Executors need not have this package: its functions travel with the tasks.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Case-insensitive, Unicode classes, and '.' stops at '\n' only.
FLAGS = "(?iUd)"

RuleSet = Mapping[str, Sequence[str]]


def _any(columns) -> Column:
    columns = list(columns)
    return reduce(lambda a, b: a | b, columns) if columns else F.lit(False)


def matches_any(text: Column, patterns: Sequence[str]) -> Column:
    """True if any pattern is found anywhere in the text."""
    return _any(text.rlike(FLAGS + p) for p in patterns)


def contains_any(lower_text: Column, phrases: Sequence[str]) -> Column:
    """True if any literal occurs in the (already lower-cased) text; no word boundary."""
    return _any(F.contains(lower_text, F.lit(p)) for p in phrases)


def pattern_hits(text: Column, patterns: Sequence[str]) -> Column:
    """How many of the patterns occur (patterns, not occurrences)."""
    return reduce(lambda a, b: a + b, [text.rlike(FLAGS + p).cast("int") for p in patterns], F.lit(0))


def phrase_hits(lower_text: Column, phrases: Sequence[str]) -> Column:
    return reduce(lambda a, b: a + b, [F.contains(lower_text, F.lit(p)).cast("int") for p in phrases], F.lit(0))


# Patterns of ASCII letters, digits and blanks, groups, alternatives, anchors and plain classes mean the same to Java and to RE2,
# which reads a text once without going back.
ALIKE = re.compile(r"(?:[A-Za-z0-9 ][?*+]?(?![?*+])|\((?!\?)|\)(?![?*+{])|[|^$]|\[\^?(?:\\p\{[LN]\}|[A-Za-z0-9_ ])+\][?*+]?(?![?*+{]))*")
# Texts on which they may differ: characters whose case or class depends on the engine, and a line feed before the end.
UNALIKE_TEXT = r"[^\x{0}-\x{12F}\x{132}-\x{52F}]|\n\z"


def counts_by_re2(rules: Sequence[Sequence[str]]):
    """Arrow UDF: for each list of patterns how many of them occur in the text; null where only Java's engine can tell."""
    lists = [list(patterns) for patterns in rules]

    @F.arrow_udf(ArrayType(IntegerType()))
    def counts(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            told = np.invert(pc.match_substring_regex(texts, UNALIKE_TEXT).fill_null(True).to_numpy(zero_copy_only=False))
            read = texts.filter(pa.array(told))
            found = np.zeros((len(read), len(lists)), np.int32)
            for i, patterns in enumerate(lists):
                for p in patterns:
                    found[:, i] += pc.match_substring_regex(read, p, ignore_case=True).to_numpy(zero_copy_only=False)
            ends = np.concatenate([[0], np.cumsum(told * len(lists))])
            yield pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(found.ravel()), mask=pa.array(~told))

    return counts


def told_by_re2(rules: Sequence[Sequence[str]]) -> bool:
    return any(rules) and all(ALIKE.fullmatch(p) for patterns in rules for p in patterns)


def hit_counts(text: Column, rules: RuleSet) -> Column:
    """Array of hit counts in class order."""
    lists = list(rules.values())
    plain = F.array(*[pattern_hits(text, patterns) for patterns in lists])
    return F.coalesce(counts_by_re2(lists)(text), plain) if told_by_re2(lists) else plain


def keyword_counts(lower_text: Column, keywords: RuleSet) -> Column:
    return F.array(*[phrase_hits(lower_text, phrases) for phrases in keywords.values()])


def first_largest(scores: Column, classes: Sequence[str]) -> Column:
    """Struct(score, class) of the largest score; the first class in order wins a tie."""
    options = F.transform(
        scores,
        lambda s, i: F.struct(s.alias("score"), (-i).alias("neg_ordinal"),
                              F.get(F.array(*map(F.lit, classes)), i).alias("class")))
    return F.array_max(options)


def _or_default(best: Column, default: str) -> Column:
    return bind(best, lambda b: F.struct(F.when(b["score"] > 0, b["class"]).otherwise(default).alias("class"),
                                         b["score"].alias("score")))


def label_class(text: Column, rules: RuleSet, default: str) -> Column:
    """Struct(class, score): the class with most pattern hits, or ``default`` with 0."""
    return _or_default(first_largest(hit_counts(text, rules), list(rules)), default)


def label_keywords(text: Column, keywords: RuleSet, default: str) -> Column:
    """Struct(class, score) by plain substring counts."""
    counted = bind(F.lower(text), lambda lower: keyword_counts(lower, keywords))
    return _or_default(first_largest(counted, list(keywords)), default)


def label_escalation(text: Column, rules: RuleSet, default: str) -> Column:
    """Struct(escalate, reason): the first reason whose patterns hit; else (false, ``default``)."""
    reason = bind(F.lower(text),
                  lambda lower: F.coalesce(*[F.when(matches_any(lower, p), F.lit(r)) for r, p in rules.items()]))
    return bind(reason, lambda r: F.struct(r.isNotNull().alias("escalate"),
                                           F.coalesce(r, F.lit(default)).alias("reason")))


def difficulty(text: Column, escalated: Column, hard_patterns: Sequence[str]) -> Column:
    """HARD on any hard pattern, else MEDIUM if escalated, else EASY."""
    return F.when(matches_any(text, hard_patterns), "HARD").when(escalated, "MEDIUM").otherwise("EASY")


def lookup(col: Column, table: Mapping[str, str], default: str | None = None) -> Column:
    """Constant-map lookup with a default."""
    pairs = [F.lit(x) for kv in table.items() for x in kv]
    return F.coalesce(F.create_map(*pairs)[col], F.lit(default))


CONSTANT_RULES = 256


def rule_hits(df: DataFrame, text: str, rule_table: DataFrame) -> DataFrame:
    """Text x rule table, reduced to hits: adds ``hits`` = array of struct(class, n) in rule order for classes with a hit.

    The rule table (class, ordinal, pattern) becomes one array, which every row is matched with in place: no pairs of
    texts and rules are made, at any number of rules. Up to ``CONSTANT_RULES`` patterns are constants, compiled once per task.
    """
    classes = rule_table.groupBy("class").agg(F.min("ordinal").alias("ordinal"), F.collect_list("pattern").alias("patterns"))
    rules = classes.agg(F.array_sort(F.collect_list(F.struct("ordinal", "class", "patterns"))).alias("rules")).first()["rules"]
    lists = [list(r["patterns"]) for r in rules]
    names = F.array(*[F.lit(r["class"]) for r in rules]).cast("array<string>")
    if sum(map(len, lists)) <= CONSTANT_RULES:
        counts = hit_counts(F.col(text), dict(enumerate(lists)))
    else:
        every = F.array(*[F.array(*map(F.lit, patterns)).cast("array<string>") for patterns in lists])
        counts = F.transform(every, lambda r: F.size(F.filter(r, lambda p: F.rlike(F.col(text), F.concat(F.lit(FLAGS), p)))))
        counts = F.coalesce(counts_by_re2(lists)(F.col(text)), counts) if told_by_re2(lists) else counts
    found = F.zip_with(names, counts.cast("array<int>"), lambda c, n: F.struct(c.alias("class"), n.alias("n")))
    return df.withColumn("hits", F.filter(found, lambda h: h["n"] > 0))
