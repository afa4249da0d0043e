"""Benchmark decontamination on canonical templates.

Numbers, names and units become typed placeholders, so a question with other numbers or names has the same template.
Windows of template tokens are looked up in a hash index of the benchmark's windows; matches on one diagonal form a run.
A run counts if it is long enough and its slots hold the item's own values. One with other values must be mostly literal
and its slots consistent: what stands for one value of the item must be one value in the document, wherever it occurs.
"""

import re
import string
import sys
from array import array
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from deskloom.llm.words import slices, text_bytes, window_hashes

# Executors need not have this package: its functions travel with the tasks.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

LITERAL, NUMBER, UNIT, NAME, BLANK = range(5)

# Words that stand for numbers and units of measure.
NUMBER_WORDS = frozenset(
    "zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen "
    "eighteen nineteen twenty thirty forty fifty sixty seventy eighty ninety hundred thousand million billion".split())
UNIT_WORDS = frozenset(
    "mm cm m km inch inches foot feet yard yards mile miles mg g kg gram grams kilogram kilograms ounce ounces pound pounds "
    "ton tons ml l liter liters litre litres gallon gallons second seconds minute minutes hour hours day days week weeks "
    "month months year years meter meters metre metres kilometer kilometers kilometre kilometres centimeter centimeters "
    "percent cent cents dollar dollars euro euros usd eur kb mb gb tb kmh mph degrees celsius fahrenheit".split())
NUMERIC = re.compile(r"[+-]?\d[\d.,:/-]*")
MEASURED = re.compile(r"[+-]?\d[\d.,]*([a-z]{1,4})")
EDGES = re.compile(r"^[\W_]+|[\W_]+$")


@dataclass(frozen=True)
class Templates:
    window: int = 8            # tokens that are looked up together
    min_run: int = 10          # tokens in a row that make a leak; an item with fewer must match whole
    min_tokens: int = 5        # items with fewer tokens are no templates: they match by their own values only
    min_literal: float = 0.6   # share of the tokens that are words, of a run with another value
    block_items: int = 20_000  # items whose index is sent to the tasks at once


class Forms(dict):
    """Raw word -> row of the columns code, kind, capital, ends (a sentence) and value."""

    def __init__(self, limit: int = 1 << 16):
        super().__init__()
        self.limit = limit
        self.rows = [array("Q"), array("b"), array("b"), array("b"), array("Q")]

    def __missing__(self, raw: bytes) -> int:
        word = raw.decode("utf-8", "replace")
        core, tail = word, ""
        if not word.isalpha():
            core = word.strip(string.punctuation)
            if not core.isalnum():
                core = EDGES.sub("", core)
            tail = word[word.rfind(core) + len(core):] if core else ""
        lower = core.lower()
        kind = LITERAL
        if not core:
            kind = BLANK
        elif lower in NUMBER_WORDS:
            kind = NUMBER
        elif lower in UNIT_WORDS:
            kind = UNIT
        elif not lower[0].isalpha() and (NUMERIC.fullmatch(lower) or (found := MEASURED.fullmatch(lower)) and
                                         found[1] in UNIT_WORDS):
            kind = NUMBER
        capital = kind == LITERAL and len(core) > 1 and core[0].isupper() and not core.isupper()
        value = xxhash.xxh3_64_intdigest(lower)
        row = (value if kind == LITERAL else kind, kind, capital, "." in tail or "!" in tail or "?" in tail, value)
        for column, field in zip(self.rows, row):
            column.append(field)
        place = self[raw] = len(self.rows[0]) - 1
        return place

    def columns(self, index: np.ndarray) -> list[np.ndarray]:
        types = np.uint64, np.int8, bool, bool, np.uint64
        return [np.frombuffer(column, kind)[index] for column, kind in zip(self.rows, types)]

    def trim(self) -> None:
        """Forget all words if there are too many; only between texts."""
        if len(self) > self.limit:
            self.__init__(self.limit)
            self.clear()


def canonical(texts: list[bytes], forms: Forms) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(codes, values, kinds, bounds) of the template tokens of all texts; text i has tokens bounds[i]:bounds[i + 1].

    Words without letter or digit are left out. A capitalised word that does not start a sentence is a name; the index has
    both readings where that depends on what stands before an item, a line or behind a colon.
    """
    forms.trim()
    words = [t.split() for t in texts]
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    if not lengths.sum():
        none = np.empty(0, np.uint64)
        return none, none, np.empty(0, np.int8), np.zeros(len(texts) + 1, np.int64)
    index = np.fromiter(map(forms.__getitem__, chain.from_iterable(words)), np.int64, int(lengths.sum()))
    owner = np.repeat(np.arange(len(words)), lengths)
    code, kind, capital, ends, value = forms.columns(index)
    full = kind != BLANK
    # A sentence also ends where a word without letters carries the full stop.
    stops = np.cumsum(ends & ~full)[full]
    code, kind, capital, ends, value, owner = (c[full] for c in (code, kind, capital, ends, value, owner))
    starts = np.ones(len(code), bool)
    starts[1:] = ends[:-1] | (owner[1:] != owner[:-1]) | (stops[1:] != stops[:-1])
    named = capital & ~starts
    kind[named] = NAME
    code[named] = NAME
    return code, value, kind, np.searchsorted(owner, np.arange(len(texts) + 1))


@dataclass
class Index:
    """Window hashes of a block of benchmark items, by window width."""

    ids: list
    codes: list[np.ndarray]
    values: list[np.ndarray]
    kinds: list[np.ndarray]
    # width -> sorted hash, item, position, which tokens (as bits) are read the other way, as a name or not
    windows: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]
    short: dict[int, tuple[np.ndarray, np.ndarray]]  # number of tokens -> sorted hash of the values, item


def two_readings(text: bytes, forms: Forms) -> np.ndarray:
    """Which tokens are capitalised and start the text, a line or what follows a colon: what stands before them in a document
    decides whether they are names there."""
    found, opens = [], True
    for line in text.split(b"\n"):
        opens = opens or bool(found)
        for raw in line.split():
            row = forms[raw]
            if forms.rows[1][row] != BLANK:
                found.append(opens and bool(forms.rows[2][row]))
                opens = False
            opens = opens or raw.endswith(b":")
    return np.array(found, bool)


def read_otherwise(code: np.ndarray, value: np.ndarray, open_: np.ndarray, width: int) -> list[tuple[int, int, int]]:
    """(hash, position, bits of the tokens read the other way) of all further readings of the windows."""
    other = np.where(code == NAME, value, np.uint64(NAME))
    out = []
    for place in range(len(code) - width + 1):
        spots = np.flatnonzero(open_[place:place + width]).tolist()
        for choice in range(1, 1 << len(spots)):
            turned = [s for k, s in enumerate(spots) if choice >> k & 1]
            window = code[place:place + width].copy()
            window[turned] = other[place:place + width][turned]
            out.append((int(window_hashes(window, width)[0]), place, sum(1 << s for s in turned)))
    return out


def build_index(items: list[tuple], rules: Templates) -> Index:
    texts, forms = [text.encode("utf-8", "surrogatepass") for _, text in items], Forms()
    code, value, kind, bounds = canonical(texts, forms)
    ids, codes, values, kinds, by_width, by_length = [], [], [], [], {}, {}
    for (item, _), text, a, b in zip(items, texts, bounds[:-1], bounds[1:]):
        if a == b:
            continue
        if b - a < rules.min_tokens:
            by_length.setdefault(int(b - a), []).append((window_hashes(value[a:b], int(b - a))[0], len(ids)))
        else:
            width = min(rules.window, int(b - a))
            hashes = window_hashes(code[a:b], width)
            more = read_otherwise(code[a:b], value[a:b], two_readings(text, forms), width)
            size = len(hashes) + len(more)
            by_width.setdefault(width, []).append((
                np.concatenate([hashes, np.array([h for h, _, _ in more], np.uint64)]), np.full(size, len(ids)),
                np.concatenate([np.arange(len(hashes)), np.array([q for _, q, _ in more], np.int64)]),
                np.concatenate([np.zeros(len(hashes), np.int64), np.array([t for _, _, t in more], np.int64)])))
        ids.append(item)
        codes.append(code[a:b])
        values.append(value[a:b])
        kinds.append(kind[a:b])
    windows = {}
    for width, parts in by_width.items():
        columns = [np.concatenate(c) for c in zip(*parts)]
        order = np.argsort(columns[0], kind="stable")
        windows[width] = tuple(c[order] for c in columns)
    short = {}
    for length, parts in by_length.items():
        hashes, item = np.array([h for h, _ in parts], np.uint64), np.array([i for _, i in parts])
        order = np.argsort(hashes, kind="stable")
        short[length] = (hashes[order], item[order])
    return Index(ids, codes, values, kinds, windows, short)


def consistent(item_values: np.ndarray, doc_values: np.ndarray, slots: np.ndarray) -> bool:
    """Each value of the item's slots stands for one value in the document."""
    seen: dict = {}
    return all(seen.setdefault(a, b) == b for a, b in zip(item_values[slots].tolist(), doc_values[slots].tolist()))


def candidates(mine: np.ndarray, hashes: np.ndarray, width: int, bounds: np.ndarray) -> tuple[np.ndarray, ...]:
    """(place, text, first and last row + 1 of the index) of the windows that the index has."""
    bits = np.zeros(1 << 16, bool)  # a first cheap look: the top bits of the index hashes
    bits[(hashes >> np.uint64(48)).astype(np.int64)] = True
    at = np.flatnonzero(bits[(mine >> np.uint64(48)).astype(np.int64)])
    first = np.searchsorted(hashes, mine[at], "left")
    last = np.searchsorted(hashes, mine[at], "right")
    text = np.searchsorted(bounds, at, "right") - 1
    ok = (last > first) & (at + width <= bounds[text + 1])
    return at[ok], text[ok], first[ok], last[ok]


def judged(theirs: np.ndarray, mine: np.ndarray, slots: np.ndarray, need: int, rules: Templates) -> tuple | None:
    """(tokens, slots, whether a slot has another value) of a run, or of its longest part with the item's own values."""
    other = slots & (theirs != mine)
    if not other.any() or np.count_nonzero(~slots) >= rules.min_literal * len(slots) and consistent(theirs, mine, slots):
        return len(slots), int(slots.sum()), bool(other.any())
    edges = np.concatenate([[-1], np.flatnonzero(other), [len(slots)]])
    k = int(np.argmax(np.diff(edges)))
    a, b = int(edges[k]) + 1, int(edges[k + 1])
    return (b - a, int(slots[a:b].sum()), False) if b - a >= need else None


def find(texts: list[bytes], index: Index, rules: Templates, forms: Forms) -> list[tuple]:
    """(text number, item number, tokens in a row, slots, whether a slot has another value), the longest run of each pair."""
    code, value, kind, bounds = canonical(texts, forms)
    places: dict[tuple, set] = {}
    widths: dict[int, int] = {}
    for width, (hashes, item, place, turned) in index.windows.items():
        for p, t, a, b in zip(*(c.tolist() for c in candidates(window_hashes(code, width), hashes, width, bounds))):
            for i, q, bits in zip(item[a:b].tolist(), place[a:b].tolist(), turned[a:b].tolist()):
                # A word that is a name in only one of the two texts must be the same word.
                if bits and any(bits >> k & 1 and value[p + k] != index.values[i][q + k] for k in range(width)):
                    continue
                places.setdefault((t, i, p - q), set()).add(q)
                widths[i] = width
    best: dict[tuple, tuple] = {}
    for (t, i, shift), found in places.items():
        width, ordered = widths[i], sorted(found)
        need = min(rules.min_run, len(index.codes[i]))
        start = 0
        for k in range(1, len(ordered) + 1):
            if k < len(ordered) and ordered[k] == ordered[k - 1] + 1:
                continue
            a, b = ordered[start], ordered[k - 1] + width
            start = k
            if b - a < need:
                continue
            slots = index.kinds[i][a:b] != LITERAL
            run = judged(index.values[i][a:b], value[a + shift:b + shift], slots, need, rules)
            if run:
                best[t, i] = max(best.get((t, i), run), run)
    for length, (hashes, item) in index.short.items():
        _, text, first, last = candidates(window_hashes(value, length), hashes, length, bounds)
        for t, a, b in set(zip(text.tolist(), first.tolist(), last.tolist())):
            for i in item[a:b].tolist():
                best[t, i] = (length, int(np.count_nonzero(index.kinds[i] != LITERAL)), False)
    return [(t, i, *run) for (t, i), run in sorted(best.items())]


def indexes(benchmark: DataFrame, id_col: str = "item_id", text_col: str = "text",
            rules: Templates = Templates()) -> list[Index]:
    """Indexes of the benchmark in blocks of about ``block_items`` items, whatever its size."""
    items = benchmark.select(F.col(id_col).alias("item"), F.col(text_col).alias("text")).filter("text IS NOT NULL").distinct()
    blocks = max(1, -(-items.count() // rules.block_items))
    built = []
    for block in range(blocks):
        rows = items.filter(F.pmod(F.xxhash64("text"), F.lit(blocks)) == block).orderBy("item", "text").collect()
        built.append(build_index([tuple(r) for r in rows], rules))
    return [index for index in built if index.ids]


def leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          rules: Templates = Templates(), **benchmark_columns) -> DataFrame:
    """(doc_id, item_id, item_tokens, matched_tokens, slots, changed): one row per document row and item it leaks.

    ``changed`` tells that a slot has another value than in the item: a re-parameterised question. Null and empty texts
    leak nothing, nor do items without a token; items of fewer than ``min_tokens`` tokens leak where all their values
    stand in a row. Repeated items count once, repeated documents each; an empty table on either side gives no rows. The benchmark is matched in blocks, each sent to all tasks.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    kind = dict(rows.dtypes)["doc_id"]
    item_name = benchmark_columns.get("id_col", "item_id")
    item_kind = dict(benchmark.dtypes)[item_name]
    schema = (f"doc_id {kind}, item_id {item_kind}, item_tokens bigint, matched_tokens bigint, slots bigint, "
              "changed boolean")
    spark = docs.sparkSession
    item_type = pa.from_numpy_dtype(np.int64) if item_kind == "bigint" else None

    def matcher(shared):
        def match(batches):
            forms = Forms()
            for part in slices(batches):
                index = shared.value
                found = find(text_bytes(part.column(1)), index, rules, forms)
                if found:
                    text, item, run, slots, changed = (list(c) for c in zip(*found))
                    yield pa.RecordBatch.from_arrays(
                        [part.column(0).take(pa.array(text)), pa.array([index.ids[i] for i in item], item_type),
                         pa.array([len(index.codes[i]) for i in item], pa.int64()), pa.array(run, pa.int64()),
                         pa.array(slots, pa.int64()), pa.array(changed, pa.bool_())],
                        names=["doc_id", "item_id", "item_tokens", "matched_tokens", "slots", "changed"])
        return match

    parts = [rows.mapInArrow(matcher(spark.sparkContext.broadcast(index)), schema)
             for index in indexes(benchmark, rules=rules, **benchmark_columns)]
    return reduce(DataFrame.union, parts) if parts else spark.createDataFrame([], schema)


def is_leaky(text: Column, benchmark: DataFrame, rules: Templates = Templates(), **benchmark_columns) -> Column:
    """Whether a text leaks any benchmark item; false for null."""

    def of(shared):
        @F.arrow_udf("boolean")
        def leaky(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
            forms = Forms()
            for texts in batches:
                hit, start = np.zeros(len(texts), bool), 0
                for part in slices([texts], 1 << 20):
                    for t, *_ in find(text_bytes(part), shared.value, rules, forms):
                        hit[start + t] = True
                    start += len(part)
                yield pa.array(hit)

        return leaky(text)

    context = benchmark.sparkSession.sparkContext
    found = [of(context.broadcast(index)) for index in indexes(benchmark, rules=rules, **benchmark_columns)]
    return reduce(Column.__or__, found, F.lit(False))
