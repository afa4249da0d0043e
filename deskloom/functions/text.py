"""Scalar text functions as Column expressions.

Blank, digit and word classes follow Unicode, so the expressions agree with engines whose ``\\s``, ``\\d`` and
``\\w`` are Unicode-aware. Everything here stays inside whole-stage codegen.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

BLANK = r"[\s\x1c-\x1f]"
NON_BLANK = r"[^\s\x1c-\x1f]"
EDGE_BLANKS = rf"(?U)^{BLANK}+|{BLANK}+\z"
WORD = r"[\p{L}\p{N}_]+"
LATIN_WORD = r"[a-z0-9]+"


def bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` evaluated once per row however often ``use`` reads it."""
    return F.get(F.transform(F.array(value), use), 0)


def strip(col: Column) -> Column:
    """Remove all Unicode blanks at both ends (``F.trim`` removes U+0020 only)."""
    return F.regexp_replace(col, EDGE_BLANKS, "")


def clean_text(col: Column) -> Column:
    """URLs to ``[URL]``, numeric handles to ``@user``, blank runs to one space, ends stripped, null to ''."""
    no_urls = F.regexp_replace(col, rf"(?U)https?://{NON_BLANK}+", "[URL]")
    no_handles = F.regexp_replace(no_urls, r"(?U)@\d{4,}", "@user")
    return strip(F.regexp_replace(F.coalesce(no_handles, F.lit("")), rf"(?U){BLANK}+", " "))


def norm_id(col: Column) -> Column:
    """Id as text: null, '' and 'nan' to '', blanks stripped, one trailing '.0' dropped; float ids in plain digits."""
    text, number = col.cast("string"), col.try_cast("double")
    plain = F.regexp_replace(strip(text), r"\.0\z", "")
    whole = F.when((number == F.floor(number)) & (F.abs(number) < 1e18), number.cast("decimal(20,0)").cast("string"))
    return (F.when(text.isNull() | (F.lower(text) == "nan") | (text == ""), "")
            .when(F.typeof(col).isin("double", "float"), F.coalesce(whole, plain)).otherwise(plain))


def text_key(col: Column) -> Column:
    """Key for deduplication and leak checks: lower case, ends stripped."""
    return strip(F.lower(col))


def key_digest(key: Column) -> Column:
    """256-bit digest of a text key: shuffles move 64 characters in place of a whole text."""
    return F.sha2(key, 256)


def strip_handles(col: Column) -> Column:
    """Remove ``@name`` handles."""
    return strip(F.regexp_replace(col, r"@[A-Za-z0-9_]+", ""))


def long_enough(col: Column, minimum: int = 15) -> Column:
    """Minimum length in characters."""
    return F.length(col) >= minimum


def not_blank(col: Column) -> Column:
    return F.length(strip(F.coalesce(col, F.lit("")))) > 0


def words(col: Column, min_chars: int = 1) -> Column:
    """Lower-case word tokens of at least ``min_chars`` characters."""
    found = F.regexp_extract_all(F.lower(F.coalesce(col, F.lit(""))), F.lit(WORD), F.lit(0))
    return found if min_chars <= 1 else F.filter(found, lambda w: F.length(w) >= min_chars)


def latin_words(col: Column) -> Column:
    """Lower-case ASCII letter/digit runs (tokens of the n-gram recall metrics)."""
    return F.regexp_extract_all(F.lower(F.coalesce(col, F.lit(""))), F.lit(LATIN_WORD), F.lit(0))


def drop_words(tokens: Column, stop_words) -> Column:
    """Remove the given words; ``array_except`` would also drop duplicates."""
    stop_words = sorted(set(stop_words))
    return F.filter(tokens, lambda w: ~w.isin(stop_words)) if stop_words else tokens


def ngrams(tokens: Column, low: int = 1, high: int = 1) -> Column:
    """All n-grams for n in ``low..high``, joined by one space, duplicates kept."""

    def of_order(words_: Column, n: int) -> Column:
        if n == 1:
            return words_
        size = F.size(words_)
        starts = F.when(size >= n, F.sequence(F.lit(1), F.greatest(size - (n - 1), F.lit(1)))).otherwise(
            F.array().cast("array<int>"))
        return F.transform(starts, lambda i: F.concat_ws(" ", *[F.get(words_, i + (k - 1)) for k in range(n)]))

    if high == 1:
        return tokens
    return bind(tokens, lambda t: F.concat(*[of_order(t, n) for n in range(low, high + 1)]))


def fill_slots(template: Column, **slots: Column) -> Column:
    """Replace ``{name}`` by the slot's value."""
    for name, value in slots.items():
        template = F.replace(template, F.lit("{" + name + "}"), value)
    return template


def class_phrase(col: Column) -> Column:
    """A class code as plain words: lower case, underscores to spaces."""
    return F.translate(F.lower(col), "_", " ")


def numbered_id(prefix: str, number: Column, digits: int = 5) -> Column:
    return F.format_string(f"{prefix}%0{digits}d", number.cast("long"))


def reply_or_null(col: Column, min_chars: int = 10) -> Column:
    """Keep a generated reply longer than ``min_chars``, without the quotes around it; else null."""
    unquoted = F.regexp_replace(F.regexp_replace(col, r'^"+|"+\z', ""), r"^'+|'+\z", "")
    return F.when(F.length(col) > min_chars, strip(unquoted))


# The lines of the grounding text.
CASE_LINE, CUSTOMER_LINE, REPLY_LINE = "Historical case ", ":\n  Customer: ", "\n  Agent reply: "
NO_CASES = "No historical cases retrieved."


def case_context(cases: Column, first: int = 3, prefix: int = 200) -> Column:
    """Grounding text of the first retrieved cases (array of structs with customer_text, agent_text)."""
    lines = F.transform(
        F.slice(cases, 1, first),
        lambda c, i: F.concat(
            F.lit(CASE_LINE), (i + 1).cast("string"), F.lit(CUSTOMER_LINE), F.substring(c["customer_text"], 1, prefix),
            F.lit(REPLY_LINE), F.substring(c["agent_text"], 1, prefix)))
    return F.when(F.size(cases) > 0, F.array_join(lines, "\n")).otherwise(F.lit(NO_CASES))


def pick(id_col: Column, salt: str, choices: int) -> Column:
    """Repeatable choice 0..choices-1 from an id; the same rows give the same picks on every run and engine."""
    digest = F.md5(F.concat(F.lit(salt), id_col.cast("string")))
    return F.pmod(F.conv(F.substring(digest, 1, 8), 16, 10).cast("long"), F.lit(choices)).cast("int")


def shuffle_key(id_col: Column, seed) -> Column:
    """Repeatable pseudo-random order key."""
    return F.md5(F.concat(F.lit(str(seed)), id_col.cast("string")))
