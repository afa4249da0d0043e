"""Score parsing, normalisation and rounding as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from deskloom.functions.text import bind

RUBRIC = ["groundedness", "brand_voice", "actionability", "safety"]


def strip_code_fence(col: Column) -> Column:
    """Drop the Markdown code-fence lines of a reply that starts with a fence."""
    text = F.regexp_replace(col, r"(?U)^\s+|\s+\z", "")
    kept = F.filter(F.split(text, "\n"), lambda line: ~F.startswith(F.trim(line), F.lit("```")))
    return F.when(F.startswith(text, F.lit("```")), F.array_join(kept, "\n")).otherwise(text)


def _json_score(parsed: Column, name: str, low: int, high: int, missing: int) -> tuple[Column, Column]:
    """(whether the entry counts as a number, its clamped whole part): numbers, true and false, and whole numbers in
    quotes count; null, other texts and nested values do not."""
    entry = F.try_variant_get(parsed, f"$.{name}", "variant")
    kind = F.schema_of_variant(entry)
    text = F.try_variant_get(parsed, f"$.{name}", "string")
    number = F.when(kind == "STRING", F.when(F.rlike(text, F.lit(r"^\s*[+-]?[0-9]+\s*$")), text.try_cast("double")))\
        .when(kind == "BOOLEAN", F.when(text == "true", 1.0).otherwise(0.0))\
        .when(kind.rlike("^(BIGINT|DOUBLE|FLOAT|DECIMAL)"), text.try_cast("double"))
    value = F.when(entry.isNull(), F.lit(float(missing))).otherwise(number)
    whole = F.floor(F.abs(value)) * F.signum(value)
    return value.isNotNull() & ~F.isnan(value), F.greatest(F.lit(low), F.least(F.lit(high), whole)).cast("int")


def parse_scores_json(col: Column, low: int = 1, high: int = 5, missing: int = 3) -> Column:
    """Struct of the four rubric scores from a JSON reply, clamped, with their mean and the reasoning.

    Null if the reply is not one JSON object and nothing else. A score that is absent counts as ``missing``; one that is
    present but no number makes the whole result null.
    """
    def build(parsed: Column) -> Column:
        valid, scores = F.schema_of_variant(parsed).startswith("OBJECT"), []
        for name in RUBRIC:
            counts, score = _json_score(parsed, name, low, high, missing)
            valid = valid & counts
            scores.append(score.alias(name))
        overall = F.bround(sum(scores[1:], scores[0]) / F.lit(float(len(RUBRIC))), 2)
        reasoning = F.coalesce(F.try_variant_get(parsed, "$.reasoning", "string"), F.lit(""))
        return F.when(valid, F.struct(*scores, overall.alias("overall_score"), reasoning.alias("reasoning")))

    return bind(strip_code_fence(col), lambda text: bind(F.try_parse_json(only_object(text)), build))


def only_object(text: Column) -> Column:
    """The text if it starts like an object that closes only at its very end; the JSON parser ignores what follows a value."""
    trimmed = F.regexp_replace(text, r"^\s+|\s+\z", "")
    braces = F.regexp_replace(F.regexp_replace(trimmed, r'(?s)"(?:[^"\\]|\\.)*+"', ""), r"[^{}]", "")
    state = F.aggregate(
        F.split(braces, ""), F.struct(F.lit(0).alias("depth"), F.lit(0).alias("closed")),
        lambda s, c: F.struct((s["depth"] + F.when(c == "{", 1).when(c == "}", -1).otherwise(0)).alias("depth"),
                              (s["closed"] + F.when((c == "}") & (s["depth"] == 1), 1).otherwise(0)).alias("closed")))
    whole = bind(state, lambda s: (s["depth"] == 0) & (s["closed"] == 1))
    return F.when(trimmed.startswith("{") & trimmed.endswith("}") & whole, trimmed)


def normalise(scores: Column) -> Column:
    """Divide an array of scores by its sum; all zero becomes a uniform distribution."""

    def shares(values: Column) -> Column:
        total = F.aggregate(values, F.lit(0.0), lambda acc, s: acc + s)
        return bind(total, lambda t: F.transform(
            values, lambda s: F.when(t > 0, s / t).otherwise(F.lit(1.0) / F.size(values))))

    return bind(scores, shares)


def half_even_bin(col: Column) -> Column:
    """Integer bin with ties to even."""
    return F.bround(col, 0).cast("int")


def as_flag(col: Column) -> Column:
    return F.coalesce(col, F.lit(False)).cast("int")


def ranked_classes(scores: Column, classes) -> Column:
    """Array of struct(class, score), best first, ties in class order."""
    names = F.array(*map(F.lit, classes))
    keyed = F.transform(scores, lambda s, i: F.struct((-s).alias("neg"), i.alias("i")))
    return F.transform(F.array_sort(keyed), lambda k: F.struct(F.get(names, k["i"]).alias("class"),
                                                                (-k["neg"]).alias("score")))
