"""Language-model scoring with a weighted backoff automaton.

Counted n-grams become states. An arc reads the next word and carries its smoothed log-probability; a failure arc leads to
the state of the next shorter history and carries its backoff weight. A text is read once from left to right.

All counts cover the whole training text. ``fit_whole`` makes every n-gram with ``min_count`` occurrences a state. The weights
of arcs and failure arcs are turned into one number per state, so a text's score is the sum over the states that its n-grams
lead to; states with at least a fixed share of all training tokens are sent to the tasks, at most 1 / share of each order, the
others stay in a table that is joined, so all of them count exactly.

``fit`` gives a model of bounded size instead: the automaton of the n-grams that reach the share, with arcs to walk along.

``learned_scores`` learns from some rows of a table and scores all of them, by the model of ``fit_whole``. Texts stay in blocks: a
block asks the parts of the key space for the counts of its distinct n-grams, and the answers carry no keys.
"""

import sys
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import TaskContext, cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from deskloom.llm.words import lower_ascii, mix, slices, text_bytes, word_hashes
from deskloom.session import stored, without_shuffle_files

# Executors need not have this package: its functions travel with the tasks.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

END = np.uint64(0)  # stands where a word has its hash


@dataclass(frozen=True)
class LmRules:
    order: int = 3
    state_share: float = 1e-6  # least count of an n-gram state / training tokens: at most 1e6 states of each order
    word_share: float = 1e-7   # words below are joined: at most 1e7 words are sent to the tasks
    min_count: int = 2         # of an n-gram state
    discount: float = 0.5


def lookup(codes: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Place of each wanted code in the sorted codes, -1 where there is none."""
    if not len(codes):
        return np.full(len(wanted), -1)
    place = np.searchsorted(codes, wanted)
    place[place == len(codes)] = 0
    return np.where(codes[place] == wanted, place, -1)


@dataclass
class Automaton:
    """Arrays of the states. ``codes[k]``: sorted (prefix state, word) codes of the n-grams with k + 2 words.

    A word's number is the place of its hash among those that are sent to the tasks, -1 for others.
    """

    tokens: int
    distinct: int
    words: np.ndarray                 # sorted hashes
    counts: np.ndarray                # of these words
    codes: list = field(default_factory=list)
    grams: list = field(default_factory=list)   # their counts
    arcs: list = field(default_factory=list)    # their log10 probabilities
    backoff: list = field(default_factory=list)  # log10 weights of the failure arcs: of words, bigrams, ...

    @property
    def unit(self) -> float:
        return self.tokens + 0.5 * (self.distinct + 1)

    def unigram(self, numbers: np.ndarray) -> np.ndarray:
        """log10 probability of words; one that is not here counts as never seen."""
        count = np.where(numbers >= 0, self.counts[np.maximum(numbers, 0)], 0) if len(self.counts) else np.zeros(len(numbers))
        return np.log10((count + 0.5) / self.unit)

    def code(self, prefix: np.ndarray, numbers: np.ndarray) -> np.ndarray:
        return np.where((prefix >= 0) & (numbers >= 0), prefix * len(self.words) + numbers, -1)

    def states(self, numbers: np.ndarray, starts: np.ndarray) -> list[np.ndarray]:
        """For each order the state that ends at every position, -1 where there is none. ``starts`` marks first tokens."""
        found = [numbers]
        for codes in self.codes:
            prefix = np.full(len(numbers), -1)
            prefix[1:] = found[-1][:-1]
            prefix[starts] = -1
            wanted = self.code(prefix, numbers)
            found.append(np.where(wanted >= 0, lookup(codes, wanted), -1))
        return found

    def read(self, numbers: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """log10 probability of every token, given those before it in its text.

        Order by order from the shortest history up: where the longer history is a state, either its own arc is taken or
        its failure arc, which costs the backoff weight on top of what the shorter history gave.
        """
        states = self.states(numbers, starts)
        result = self.unigram(numbers)
        for k, arcs in enumerate(self.arcs):
            history = np.full(len(numbers), -1)
            history[1:] = states[k][:-1]
            history[starts] = -1
            known, arc = history >= 0, states[k + 1]
            if len(self.backoff[k]):
                result = np.where(known, result + self.backoff[k][np.maximum(history, 0)], result)
            if len(arcs):
                result = np.where(arc >= 0, arcs[np.maximum(arc, 0)], result)
        return result

    def add_order(self, codes: np.ndarray, counts: np.ndarray, discount: float) -> None:
        """Add the n-grams of the next order, with their arcs and the backoff weights of their histories."""
        k, size = len(self.codes), max(len(self.words), 1)
        prefix, word = codes // size, codes % size
        of_history = self.counts if k == 0 else self.grams[-1]
        share = (counts - discount) / of_history[prefix] if len(codes) else np.zeros(0)
        if k == 0:
            lower = 10.0 ** self.unigram(word)
        else:  # the history without its first word, followed by the word, is a state of the order below
            inner = lookup(self.codes[k - 1], self.shorter(k - 1, prefix) * size + word)
            lower = 10.0 ** self.arcs[k - 1][inner] if len(codes) else np.zeros(0)
        kept = np.bincount(prefix, share, len(of_history))
        below = np.bincount(prefix, lower, len(of_history))
        weight = np.where(kept > 0, (1 - kept) / np.maximum(1 - below, 1e-12), 1.0)
        self.codes.append(codes)
        self.grams.append(counts)
        self.arcs.append(np.log10(share) if len(codes) else share)
        self.backoff.append(np.log10(np.maximum(weight, 1e-12)))

    def shorter(self, k: int, states: np.ndarray) -> np.ndarray:
        """State numbers of the n-grams of order k + 2 without their first word."""
        size = len(self.words)
        prefix, word = self.codes[k][states] // size, self.codes[k][states] % size
        return word if k == 0 else lookup(self.codes[k - 1], self.shorter(k - 1, prefix) * size + word)


def tokens_of(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(hashes of the tokens of all texts, the place of each text's first token); the end token closes a text."""
    words, lengths = word_hashes([lower_ascii(t) for t in texts])
    return np.insert(words, np.cumsum(lengths), END), np.cumsum(lengths + 1) - lengths - 1


def combined(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in rising order and the sums of their counts."""
    if not keys:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    keys, counts = np.concatenate(keys), np.concatenate(counts)
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[first], np.add.reduceat(counts, first) if len(keys) else counts


def counted(docs: DataFrame, keys_of, least: int = 1, held: int = 1 << 21) -> DataFrame:
    """(key, n) of all keys that occur ``least`` times or more. ``keys_of`` gives the keys of a list of texts.

    Tasks sum up what they read and send sorted runs of keys to the parts of the key space, so a very frequent key is one
    entry per task and no part grows with a key.
    """
    spark = docs.sparkSession
    parts = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))

    def runs(batches):
        keys, counts, size = [], [], 0

        def packed():
            key, count = combined(keys, counts)
            part = (mix(key.view(np.uint64)) % np.uint64(parts)).astype(np.int64)
            order = np.argsort(part, kind="stable")
            edges = np.searchsorted(part[order], np.arange(parts + 1))
            used = [p for p in range(parts) if edges[p] < edges[p + 1]]
            chunks = [order[edges[p]:edges[p + 1]] for p in used]
            return pa.RecordBatch.from_arrays(
                [pa.array(used, pa.int32()), pa.array([key[c].tobytes() for c in chunks], pa.binary()),
                 pa.array([count[c].astype(np.uint32).tobytes() for c in chunks], pa.binary())],
                names=["part", "keys", "counts"])

        for part in slices(batches):
            key, count = np.unique(keys_of(text_bytes(part.column(0))), return_counts=True)
            keys.append(key)
            counts.append(count)
            size += len(key)
            if size > held:
                yield packed()
                keys, counts, size = [], [], 0
        if size:
            yield packed()

    def sums(batches):
        rows = [(np.frombuffer(k, np.int64), np.frombuffer(c, np.uint32).astype(np.int64)) for b in batches
                for k, c in zip(b.column(1).to_pylist(), b.column(2).to_pylist())]
        key, count = combined([k for k, _ in rows], [c for _, c in rows])
        ok = count >= least
        yield pa.RecordBatch.from_arrays([pa.array(key[ok], pa.int64()), pa.array(count[ok], pa.int64())], names=["key", "n"])

    sent = docs.select("text").mapInArrow(runs, "part int, keys binary, counts binary")
    return sent.repartition("part").mapInArrow(sums, "key bigint, n bigint")


def _arrays(table: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """Keys and counts of a table of bounded size, sorted by key."""
    found = table.select("key", "n").toArrow()
    key, count = (found.column(i).to_numpy() for i in (0, 1))
    order = np.argsort(key)
    return key[order], count[order]


def fit(docs: DataFrame, text_col: str = "text", rules: LmRules = LmRules()) -> tuple[Automaton, DataFrame]:
    """The automaton learned from all ``docs``, and the table (key, n) of all words with their counts.

    Null texts count as empty; they still have the end token. An empty table gives an automaton that knows no token.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col(text_col).cast("string").alias("text"))

    def words_of(found):
        return tokens_of(found)[0].view(np.int64)

    words = stored(counted(texts, words_of), "words")
    total = words.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
    enough = int(np.ceil(rules.word_share * total["n"]))
    keys, counts = _arrays(words.filter(F.col("n") >= enough))
    order = np.argsort(keys.view(np.uint64))
    model = Automaton(total["n"], total["v"], keys.view(np.uint64)[order], counts[order])
    least = max(rules.min_count, int(np.ceil(rules.state_share * total["n"])))
    for _ in range(rules.order - 1):
        shared = spark.sparkContext.broadcast(model)

        def grams_of(found, shared=shared):
            known = shared.value
            tokens, first = tokens_of(found)
            numbers = lookup(known.words, tokens)
            frequent = np.where((numbers >= 0) & (known.counts[np.maximum(numbers, 0)] >= least), numbers, -1) \
                if len(known.counts) else numbers
            states = known.states(frequent, first)[-1]
            prefix = np.full(len(numbers), -1)
            prefix[1:] = states[:-1]
            prefix[first] = -1
            if known.codes:  # an n-gram can only be frequent if the one without its first word is
                frequent = np.where(states >= 0, frequent, -1)
            code = known.code(prefix, frequent)
            return code[code >= 0]

        codes, found = _arrays(counted(texts, grams_of, least))
        model.add_order(codes, found, rules.discount)
    return model, words


def scores(docs: DataFrame, model: Automaton, words: DataFrame, id_col: str = "doc_id", text_col: str = "text",
           carry: tuple = ()) -> DataFrame:
    """One row per input row: doc_id, the columns ``carry``, n_tokens, n_known, train_tokens, base_score, score.

    ``base_score`` sums the smoothed unigram log10 probabilities of the tokens, ``score`` those of the automaton. A null or
    empty text has the end token only. Repeated rows and null ids give a row each.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"), *carry)
    shared = spark.sparkContext.broadcast(model)
    kinds = dict(rows.dtypes)
    schema = (f"row bigint, doc_id {kinds['doc_id']}, " + "".join(f"{c} {kinds[c]}, " for c in carry)
              + "n_tokens bigint, n_known bigint, base_score double, score double, rare array<bigint>")

    def read(batches):
        known = shared.value
        row = TaskContext.get().partitionId() << 40
        for part in slices(batches):
            tokens, first = tokens_of(text_bytes(part.column(1)))
            numbers = lookup(known.words, tokens)
            edges = np.append(first, len(numbers))
            sums = [np.add.reduceat(x, first) for x in
                    (np.ones(len(numbers), np.int64), (numbers >= 0).astype(np.int64), known.unigram(numbers),
                     known.read(numbers, first))]
            missing = np.flatnonzero(numbers < 0)
            lists = pa.ListArray.from_arrays(pa.array(np.searchsorted(missing, edges), pa.int32()),
                                             pa.array(tokens[missing].view(np.int64), pa.int64()))
            numbers_of_rows = np.arange(row, row + part.num_rows)
            row += part.num_rows
            yield pa.RecordBatch.from_arrays(
                [pa.array(numbers_of_rows, pa.int64()), part.column(0), *part.columns[2:],
                 *(pa.array(s, pa.int64() if s.dtype == np.int64 else pa.float64()) for s in sums), lists],
                names=["row", "doc_id", *carry, "n_tokens", "n_known", "base_score", "score", "rare"])

    # Stored, so the row numbers stay the same for both uses.
    found = stored(rows.mapInArrow(read, schema), "scores")
    # Words that were not sent count as unseen so far; those that the table knows get what they lack.
    rare = (found.select("row", F.explode("rare").alias("key")).groupBy("row", "key").agg(F.count("*").alias("times"))
            .join(words, "key").groupBy("row")
            .agg(F.sum("times").alias("_known"), F.sum(F.col("times") * F.log10((F.col("n") + 0.5) / 0.5)).alias("_more")))
    more, known = F.coalesce("_more", F.lit(0.0)), F.coalesce("_known", F.lit(0))
    return found.join(rare, "row", "left").select(
        "doc_id", *carry, "n_tokens", (F.col("n_known") + known).alias("n_known"),
        F.lit(model.tokens).cast("long").alias("train_tokens"), (F.col("base_score") + more).alias("base_score"),
        (F.col("score") + more).alias("score"))


# ---- all n-grams ----

GRAM = np.uint64(0x9E3779B97F4A7C15)


@dataclass(frozen=True)
class WholeAutomaton:
    """Sums per state: ``sent`` has the sorted keys of frequent states and what reading one adds to (known, base, score);
    ``rest`` (key, known, base, more) has the same of all others, for words beyond what an unseen word adds."""

    tokens: int
    unseen: float          # log10 probability of a word that was never seen
    order: int
    sent: np.ndarray
    sums: np.ndarray       # a row for each of known, base, more
    rest: DataFrame


def gram_key(prefix: np.ndarray, inner: np.ndarray) -> np.ndarray:
    """Key of an n-gram from those of its first and of its last n - 1 words; that of a word is its hash."""
    return mix(prefix * GRAM + mix(inner))


def longer(keys: np.ndarray, place: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(prefix, inner, last token) of all n-grams, from the keys of the n - 1 words up to every token. ``place``: that of a token
    in its text."""
    last = np.flatnonzero(place >= n - 1)
    return keys[last - 1], keys[last], last


def by_part(key: np.ndarray, parts: int) -> tuple[list[int], list[np.ndarray]]:
    """Parts of the key space, and the places of their keys."""
    part = np.mod(key.view(np.int64), parts)
    order = np.argsort(part, kind="stable")
    edges = np.searchsorted(part[order], np.arange(parts + 1))
    used = np.flatnonzero(edges[1:] > edges[:-1]).tolist()
    return used, [order[edges[p]:edges[p + 1]] for p in used]


def binaries(values: np.ndarray, chunks: list[np.ndarray]) -> pa.Array:
    return pa.array([values[c].tobytes() for c in chunks], pa.binary())


def counted_grams(texts: DataFrame, n: int, least: int, held: int = 1 << 20) -> DataFrame:
    """(key, prefix, inner, n) of all n-grams that occur ``least`` times or more; sent as ``counted`` sends keys."""
    parts = 4 * int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def merged(prefix, inner, counts):
        key = gram_key(prefix, inner)
        order = np.argsort(key, kind="stable")
        first = np.flatnonzero(np.concatenate([[True], key[order][1:] != key[order][:-1]])) if len(key) else order
        at = order[first]
        return key[at], prefix[at], inner[at], np.add.reduceat(counts[order], first) if len(key) else counts

    def runs(batches):
        waiting, size = [], 0

        def packed():
            key, prefix, inner, count = merged(*map(np.concatenate, zip(*waiting)))
            used, chunks = by_part(key, parts)
            return pa.RecordBatch.from_arrays(
                [pa.array(used, pa.int32()), binaries(prefix, chunks), binaries(inner, chunks), binaries(count.astype(np.uint32), chunks)],
                names=["part", "prefix", "inner", "counts"])

        for part in slices(batches):
            tokens, first = tokens_of(text_bytes(part.column(0)))
            keys, place = states_of(tokens, first, n - 1)
            prefix, inner, _ = longer(keys[-1], place, n)
            waiting.append(merged(prefix, inner, np.ones(len(prefix), np.int64))[1:])
            size += len(waiting[-1][0])
            if size > held:
                yield packed()
                waiting, size = [], 0
        if size:
            yield packed()

    def sums(batches):
        rows = [[np.frombuffer(v, kind) for v, kind in zip(row, (np.uint64, np.uint64, np.uint32))]
                for b in batches for row in zip(*(c.to_pylist() for c in b.columns[1:]))]
        if not rows:
            return
        prefix, inner, counts = (np.concatenate([r[i] for r in rows]) for i in range(3))
        key, prefix, inner, count = merged(prefix, inner, counts.astype(np.int64))
        kept = np.flatnonzero(count >= least)
        for start in range(0, len(kept), 1 << 16):
            at = kept[start:start + (1 << 16)]
            yield pa.RecordBatch.from_arrays([pa.array(x[at].view(np.int64)) for x in (key, prefix, inner, count)],
                                             names=["key", "prefix", "inner", "n"])

    sent = texts.mapInArrow(runs, "part int, prefix binary, inner binary, counts binary")
    return sent.repartition("part").mapInArrow(sums, "key bigint, prefix bigint, inner bigint, n bigint")


def states_of(tokens: np.ndarray, first: np.ndarray, order: int) -> tuple[list[np.ndarray], np.ndarray]:
    """(for each order the keys of the n-grams that end at every token, the tokens' places in their texts). Keys that would begin
    before the text stand for nothing."""
    place = np.arange(len(tokens)) - np.repeat(first, np.diff(np.append(first, len(tokens))))
    keys = [tokens]
    for n in range(2, order + 1):
        prefix, inner, last = longer(keys[-1], place, n)
        keys.append(np.zeros(len(tokens), np.uint64))
        keys[-1][last] = gram_key(prefix, inner)
    return keys, place


def fit_whole(docs: DataFrame, text_col: str = "text", rules: LmRules = LmRules()) -> WholeAutomaton:
    """The automaton of all n-grams with ``min_count`` occurrences; the shares only say which states are sent to the tasks.

    Reading an n-gram that is a state changes the score by its arc less the way round it: its history's failure arc and the
    arc of the n-gram without its first word. The failure arc that leaves a state is added to what the state itself adds.
    """
    texts = docs.select(F.col(text_col).cast("string").alias("text"))
    words = stored(counted(texts, lambda found: tokens_of(found)[0].view(np.int64)), "words")
    total = words.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.count("*").alias("v")).first()
    unit = total["n"] + 0.5 * (total["v"] + 1)
    unseen = float(np.log10(0.5 / unit))
    states = words.select("key", "n", ((F.col("n") + 0.5) / unit).alias("share")).withColumn("gain", F.log10("share"))
    tables = []

    def table(n: int, states: DataFrame, leaving) -> DataFrame:
        word, least = n == 1, max(1, int(np.ceil((rules.word_share if n == 1 else rules.state_share) * total["n"])))
        return states.select("key", (F.col("n") >= least).alias("frequent"), F.lit(int(word)).alias("known"),
                             (F.col("gain") if word else F.lit(0.0)).alias("base"), (F.col("gain") + leaving).alias("more"))

    for n in range(2, rules.order + 1):
        grams = counted_grams(texts, n, rules.min_count)
        arcs = stored(grams.join(states.select(F.col("key").alias("prefix"), F.col("n").alias("_of")), "prefix")
                      .join(states.select(F.col("key").alias("inner"), F.col("share").alias("lower")), "inner")
                      .select("key", "prefix", "n", ((F.col("n") - rules.discount) / F.col("_of")).alias("share"), "lower"), "arcs")
        free = (1 - F.sum("share")) / F.greatest(1 - F.sum("lower"), F.lit(1e-12))
        failure = stored(arcs.groupBy("prefix").agg(F.log10(F.greatest(free, F.lit(1e-12))).alias("failure")), "failure")
        leaving = states.join(failure.withColumnRenamed("prefix", "key"), "key", "left")
        tables.append(table(n - 1, leaving, F.coalesce("failure", F.lit(0.0))))
        gain = F.log10("share") - F.log10("lower") - F.col("failure")
        states = arcs.join(failure, "prefix").select("key", "n", "share", gain.alias("gain"))
    tables.append(table(rules.order, states, F.lit(0.0)))
    whole = tables[0]
    for more in tables[1:]:
        whole = whole.unionByName(more)
    whole = stored(whole, "states")
    sent = whole.filter("frequent").select("key", "known", "base", "more").toArrow()
    key = sent.column(0).to_numpy()
    order = np.argsort(key)
    sums = np.stack([sent.column(i).to_numpy().astype(float)[order] for i in (1, 2, 3)])
    # A word that is not sent counts as unseen until it is joined.
    beyond = F.when(F.col("known") == 1, F.lit(unseen)).otherwise(0.0)
    rest = whole.filter("NOT frequent").select("key", "known", (F.col("base") - beyond).alias("base"), (F.col("more") - beyond).alias("more"))
    return WholeAutomaton(total["n"], unseen, rules.order, key[order], sums, rest)


def whole_scores(docs: DataFrame, model: WholeAutomaton, id_col: str = "doc_id", text_col: str = "text", carry: tuple = ()) -> DataFrame:
    """The rows of ``scores`` by a model of all n-grams.

    N-grams that are not sent travel, with the number of their row, to the part of the key space that has their state, and the
    sums of those that are states travel back to the run of rows they came from.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"), *carry)
    parts = 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    unseen, order = model.unseen, model.order
    shared = spark.sparkContext.broadcast((model.sent, model.sums))
    kinds = dict(rows.dtypes)
    entry = pa.struct([("part", pa.int32()), ("keys", pa.binary()), ("places", pa.binary())])
    schema = (f"row bigint, doc_id {kinds['doc_id']}, " + "".join(f"{c} {kinds[c]}, " for c in carry)
              + "n_tokens bigint, known double, base double, more double, others array<struct<part: int, keys: binary, places: binary>>")

    def read(batches):
        sent, sums = shared.value
        row = TaskContext.get().partitionId() << 40
        for part in slices(batches):
            tokens, first = tokens_of(text_bytes(part.column(1)))
            lengths = np.diff(np.append(first, len(tokens)))
            of_row = np.repeat(np.arange(len(first)), lengths)
            keys, place = states_of(tokens, first, order)
            found, others, owners = np.zeros((3, len(first))), [], []
            for n, key in enumerate(keys, 1):
                at = np.flatnonzero(place >= n - 1)
                spot = lookup(sent, key[at].view(np.int64))
                hit, miss = spot >= 0, at[spot < 0]
                for i in range(3):
                    found[i] += np.bincount(of_row[at[hit]], sums[i][spot[hit]], len(first))
                if n == 1:
                    late = np.bincount(of_row[miss], minlength=len(first)) * unseen
                    found[1] += late
                    found[2] += late
                others.append(key[miss])
                owners.append(of_row[miss].astype(np.int32))
            others, owners = np.concatenate(others), np.concatenate(owners)
            used, chunks = by_part(others, parts)
            runs = pa.StructArray.from_arrays([pa.array(used, pa.int32()), binaries(others, chunks), binaries(owners, chunks)], fields=list(entry))
            ends = np.full(len(first) + 1, len(used), np.int32)  # all of them lie in the run's first row
            ends[0] = 0
            numbers = np.arange(row, row + part.num_rows)
            row += part.num_rows
            yield pa.RecordBatch.from_arrays(
                [pa.array(numbers, pa.int64()), part.column(0), *part.columns[2:], pa.array(lengths, pa.int64()),
                 *(pa.array(x) for x in found), pa.ListArray.from_arrays(pa.array(ends), runs)],
                names=["row", "doc_id", *carry, "n_tokens", "known", "base", "more", "others"])

    def looked_up(key, asked: pa.Table, states: pa.Table) -> pa.Table:
        known = states.column("key").to_numpy()
        rising = np.argsort(known)
        known = known[rising]
        values = [states.column(c).to_numpy().astype(float)[rising] for c in ("known", "base", "more")]
        starts, owners, sums = [], [], [[], [], []]
        for start, keys, places in zip(*(asked.column(c).to_pylist() for c in ("start", "keys", "places"))):
            spot = lookup(known, np.frombuffer(keys, np.int64))
            hit = spot >= 0
            if not hit.any():
                continue
            places, own = np.unique(np.frombuffer(places, np.int32)[hit], return_inverse=True)
            starts.append(start)
            owners.append(places.tobytes())
            for i in range(3):
                sums[i].append(np.bincount(own, values[i][spot[hit]]).tobytes())
        return pa.table([pa.array(starts, pa.int64()), *(pa.array(x, pa.binary()) for x in (owners, *sums))],
                        names=["start", "places", "known", "base", "more"])

    def added(batches):
        total: dict[int, list] = {}
        for b in batches:
            for start, places, *sums in zip(*(c.to_pylist() for c in b.columns)):
                places = np.frombuffer(places, np.int32)
                have = total.get(start, np.zeros((3, 0)))
                size = max(have.shape[1], int(places.max()) + 1)
                have = np.pad(have, ((0, 0), (0, size - have.shape[1])))
                for i in range(3):
                    have[i, places] += np.frombuffer(sums[i], np.float64)
                total[start] = have
        for start, have in total.items():
            yield pa.RecordBatch.from_arrays([pa.array(start + np.arange(have.shape[1]), pa.int64()), *(pa.array(x) for x in have)],
                                             names=["row", "_known", "_base", "_more"])

    # Stored, so the row numbers stay the same for both uses.
    found = stored(rows.mapInArrow(read, schema), "scores")
    asked = found.filter(F.size("others") > 0).select(F.col("row").alias("start"), F.inline("others"))
    states = model.rest.withColumn("part", F.pmod("key", F.lit(parts)).cast("int"))
    back = asked.groupBy("part").cogroup(states.groupBy("part")).applyInArrow(
        looked_up, "start bigint, places binary, known binary, base binary, more binary")
    late = back.repartition("start").mapInArrow(added, "row bigint, _known double, _base double, _more double")

    def whole(name: str):
        return F.col(name) + F.coalesce(f"_{name}", F.lit(0.0))

    return found.drop("others").join(late, "row", "left").select(
        "doc_id", *carry, "n_tokens", F.round(whole("known")).cast("long").alias("n_known"),
        F.lit(model.tokens).cast("long").alias("train_tokens"), whole("base").alias("base_score"), whole("more").alias("score"))


# ---- learning and scoring in one table ----

BLOCK = 1 << 20  # tokens of a block, and tokens whose n-grams a part of the key space has on average


def pack(numbers: np.ndarray) -> bytes:
    """64-bit numbers, byte by byte: the high bytes of small ones compress to nothing."""
    planes = np.ascontiguousarray(numbers.view(np.uint8).reshape(-1, 8).T)
    return len(numbers).to_bytes(4, "little") + pa.Codec("zstd").compress(planes, asbytes=True)


def unpack(data: bytes) -> np.ndarray:
    count = int.from_bytes(data[:4], "little")
    planes = np.frombuffer(pa.Codec("zstd").decompress(data[4:], 8 * count, asbytes=True), np.uint8)
    return np.ascontiguousarray(planes.reshape(8, count).T).view(np.int64).ravel()


def pack_keys(keys: np.ndarray) -> bytes:
    """Keys in rising order, as steps."""
    return pack(np.diff(keys, prepend=np.uint64(0)))


def unpack_keys(data: bytes) -> np.ndarray:
    return np.cumsum(unpack(data).view(np.uint64))


def distinct(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(distinct keys in rising order, where each is, the number of every key among them)."""
    order = np.argsort(keys)
    new = np.append(True, keys[order[1:]] != keys[order[:-1]])[:len(keys)]
    numbers = np.empty(len(keys), np.int64)
    numbers[order] = np.cumsum(new) - 1
    at = order[new]
    return keys[at], at, numbers


def block_tables(docs: DataFrame) -> DataFrame:
    """Rows (item, text, learns) in blocks of about ``BLOCK`` tokens, or of one longer text."""
    def read(batches):
        block = TaskContext.get().partitionId() << 32
        items, hashes, sizes, learns = [], [], [], []

        def made():
            nonlocal block
            words, _, spots = distinct(np.concatenate(hashes))
            lengths, learn = np.concatenate(sizes), np.concatenate(learns)
            item = pa.concat_arrays(items)
            block += 1
            return pa.RecordBatch.from_arrays(
                [pa.array([block - 1], pa.int64()), pa.ListArray.from_arrays(pa.array([0, len(item)], pa.int32()), item),
                 pa.array([pack_keys(words)], pa.binary()),
                 *(pa.array([pack(x.astype(np.int64, copy=False))], pa.binary()) for x in (spots, lengths, learn)),
                 pa.array([len(spots)], pa.int64()), pa.array([int(lengths[learn].sum())], pa.int64())],
                names=["block", "items", "words", "spots", "lengths", "learn", "size", "trained"])

        for part in slices(batches):
            tokens, first = tokens_of(text_bytes(part.column(1)))
            items.append(part.column(0))
            hashes.append(tokens)
            sizes.append(np.diff(np.append(first, len(tokens))))
            learns.append(part.column(2).to_numpy(zero_copy_only=False).astype(bool))
            if sum(map(len, hashes)) >= BLOCK:
                yield made()
                items, hashes, sizes, learns = [], [], [], []
        if items:
            yield made()

    kind = docs.schema["item"].dataType.simpleString()
    return docs.mapInArrow(read, f"block bigint, items array<{kind}>, words binary, spots binary, lengths binary, learn binary, "
                                 "size bigint, trained bigint")


class Block:
    """The n-grams of a block, as far as it was told their counts.

    ``keys[n]``: its distinct n-grams in rising order; ``spots[n]``: the number of the one that ends at each token, or -1;
    ``at[n]``: a token at which each ends; ``counts[n]``, ``own[n]``: their counts, 0 for no state, and whether this block, of all
    that have it, adds it to the sums of its history; ``sums[n]``: (count, number, count without their first word) of all states
    that continue each.
    """

    def __init__(self, row: dict, answers: dict[int, np.ndarray], order: int):
        words, self.spots = unpack_keys(row["words"]), {1: unpack(row["spots"])}
        self.lengths = unpack(row["lengths"])
        self.learn = np.repeat(unpack(row["learn"]), self.lengths)
        self.first = np.cumsum(self.lengths) - self.lengths
        self.place = np.arange(len(self.learn)) - np.repeat(self.first, self.lengths)
        self.keys, self.at, self.counts, self.own, self.sums = {1: words}, {}, {}, {}, {}
        self.tell(1, answers)
        for n in range(2, order + 1):
            if n > 2 and n - 1 not in self.counts:
                break
            self.find(n)
            self.tell(n, answers)
        for n in range(1, order):
            if -n in answers:
                self.sums[n] = np.zeros((3, len(self.keys[n])), np.int64)
                self.sums[n][:, self.continued(n)] = answers[-n]

    def tell(self, n: int, answers: dict[int, np.ndarray]) -> None:
        if n in answers:
            self.counts[n], self.own[n] = answers[n][0] >> 1, (answers[n][0] & 1) == 1

    def find(self, n: int) -> None:
        """N-grams can only be states if those without their first and without their last word are."""
        keys, spots = self.keys[n - 1], self.spots[n - 1]
        ends = np.flatnonzero(self.place >= n - 1)
        if n > 2:
            state = spots >= 0
            state[state] = self.counts[n - 1][spots[state]] > 0
            ends = ends[state[ends - 1] & state[ends]]
        self.keys[n], at, numbers = distinct(gram_key(keys[spots[ends - 1]], keys[spots[ends]]))
        self.at[n] = ends[at]
        self.spots[n] = np.full(len(spots), -1)
        self.spots[n][ends] = numbers

    def continued(self, n: int) -> np.ndarray:
        """Numbers of the states that a token follows somewhere in the block."""
        spots = self.spots[n][np.flatnonzero(self.place >= 1) - 1]
        followed = np.zeros(len(self.keys[n]), bool)
        followed[spots[spots >= 0]] = True
        return np.flatnonzero(followed & (self.counts[n] > 0))

    def learned(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """(distinct n-grams, their occurrences in training texts)."""
        spots = self.spots[n]
        return self.keys[n], np.bincount(spots[spots >= 0], self.learn[spots >= 0], len(self.keys[n])).astype(np.int64)[None]

    def continuing(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        """(states, what the states that continue them and are this block's own add to their sums)."""
        own = np.flatnonzero(self.own[n + 1] & (self.counts[n + 1] > 0))
        history, inner = (self.spots[n][self.at[n + 1][own] - back] for back in (1, 0))
        added = [np.bincount(history, x, len(self.keys[n])) for x in (self.counts[n + 1][own], np.ones(len(own)), self.counts[n][inner])]
        kept = self.continued(n)
        return self.keys[n][kept], np.stack(added)[:, kept].astype(np.int64)

    def failures(self, n: int, discount: float, unit: float) -> np.ndarray:
        """log10 weights of the failure arcs that leave the n-grams, 0 where no state continues them."""
        count, number, inner = self.sums[n]
        some = number > 0
        kept = (count[some] - discount * number[some]) / self.counts[n][some]
        if n == 1:
            below = (inner[some] + 0.5 * number[some]) / unit
        else:
            below = (inner[some] - discount * number[some]) / self.counts[n - 1][self.spots[n - 1][self.at[n][some]]]
        result = np.zeros(len(some))
        result[some] = np.log10(np.maximum((1 - kept) / np.maximum(1 - below, 1e-12), 1e-12))
        return result

    def scores(self, discount: float, unit: float) -> list[np.ndarray]:
        """For each text: known tokens, base score, score."""
        share = (self.counts[1] + 0.5) / unit
        base = np.log10(share)[self.spots[1]]
        score, failure = base, np.zeros(len(share))
        for n in sorted(self.counts):
            if n > 1:
                state = np.flatnonzero(self.counts[n] > 0)
                history, inner = (self.spots[n - 1][self.at[n][state] - back] for back in (1, 0))
                lower, gain = share[inner], np.zeros(len(self.keys[n]))
                share = np.zeros(len(self.keys[n]))
                share[state] = (self.counts[n][state] - discount) / self.counts[n - 1][history]
                gain[state] = np.log10(share[state]) - np.log10(lower) - failure[history]
                failure = np.zeros(len(gain))
            else:
                gain = np.zeros(len(share))
            if n in self.sums:
                failure = self.failures(n, discount, unit)
            spots = self.spots[n]
            score = score + np.where(spots >= 0, np.append(gain + failure, 0.0)[spots], 0.0)
        return [np.add.reduceat(x, self.first) for x in ((self.counts[1] > 0)[self.spots[1]].astype(np.int64), base, score)]


def questions(keys: np.ndarray, values: np.ndarray, n: int, parts: int) -> list[dict]:
    """Rows for the parts of the key space, which are ranges of it."""
    part = ((keys >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)).astype(np.int64)
    edges = np.searchsorted(part, np.arange(parts + 1))
    return [{"n": n, "part": p, "keys": pack_keys(keys[a:b]), "numbers": pack(values[:, a:b].ravel())}
            for p, (a, b) in enumerate(zip(edges[:-1], edges[1:])) if a < b]


def learned_scores(docs: DataFrame, learns: Column, id_col: str = "doc_id", text_col: str = "text", carry: tuple = (),
                   rules: LmRules = LmRules()) -> DataFrame:
    """The rows of ``scores`` for all ``docs``, by the automaton of all n-grams of those rows where ``learns`` holds.

    Every block sends its distinct n-grams with their counts to the parts of the key space, where they are summed up, and gets the
    sums back in the order it asked. An n-gram is sent only if its shorter ones are states. One of the blocks that have a state
    adds it to the sums of its history, which the failure arcs are made from, in the next round.
    """
    spark = docs.sparkSession
    item = F.struct(F.col(id_col).alias("doc_id"), *(F.col(c) for c in carry)).alias("item")
    rows = docs.select(item, F.col(text_col).cast("string").alias("text"), F.coalesce(learns, F.lit(False)).alias("learns"))
    fields = rows.schema["item"].dataType.fields
    order, least, discount = rules.order, rules.min_count, rules.discount
    columns = ["words", "spots", "lengths", "learn"]
    blocks = stored(block_tables(rows), "blocks")
    size, tokens = (int(x or 0) for x in blocks.agg(F.sum("size"), F.sum("trained")).first())
    parts = max(4 * int(spark.conf.get("spark.sql.shuffle.partitions")), size // BLOCK)

    def told_by(answers: pa.Table) -> dict[int, np.ndarray]:
        found = sorted(zip(*(answers.column(c).to_pylist() for c in ("n", "part", "numbers"))), key=lambda r: r[:2])
        told: dict[int, list] = {kind: [np.zeros((1 if kind > 0 else 3, 0), np.int64)] for kind in range(1 - order, order + 1)}
        for kind, _, numbers in found:
            told[kind].append(unpack(numbers).reshape(1 if kind > 0 else 3, -1))
        return {kind: np.concatenate(pieces, axis=1) for kind, pieces in told.items()}

    def asked(row: dict, answers: pa.Table | None, turn: int) -> pa.Table:
        told = told_by(answers) if turn > 1 else {}
        block = Block(row, {n: told[n] for n in range(1, turn + 1) if n in told}, min(turn + 1, order))
        found = []
        for n in ([1, 2] if turn == 1 else [turn + 1]):
            if n <= order:
                found += questions(*block.learned(n), n, parts)
        if turn > 1:
            found += questions(*block.continuing(turn - 1), 1 - turn, parts)
        return pa.Table.from_pylist([{"block": row["block"]} | r for r in found], schema=pa.schema(
            [("block", pa.int64()), ("n", pa.int32()), ("part", pa.int32()), ("keys", pa.binary()), ("numbers", pa.binary())]))

    def added_up(table: pa.Table) -> pa.Table:
        table = table.sort_by("block")
        n = table.column("n")[0].as_py()
        keys = [unpack_keys(k) for k in table.column("keys").to_pylist()]
        values = np.concatenate([unpack(v).reshape(-1, len(k)) for k, v in zip(keys, table.column("numbers").to_pylist())], axis=1)
        edges, keys = np.cumsum([len(k) for k in keys]), np.concatenate(keys)
        rising = np.argsort(keys, kind="stable")
        new = np.append(True, keys[rising][1:] != keys[rising][:-1])
        sums = np.add.reduceat(values[:, rising], np.flatnonzero(new), axis=1)[:, np.cumsum(new) - 1]
        fresh = 0
        if n > 0:  # the first block that asked has the state as its own
            state = sums >= (1 if n == 1 else least)
            sums = np.where(state, 2 * sums + new, 0)
            fresh = int((state & new).sum())
        back = np.empty_like(sums)
        back[:, rising] = sums
        numbers = [pack(np.ascontiguousarray(b).ravel()) for b in np.split(back, edges[:-1], axis=1)]
        fresh = [fresh] + [0] * (len(numbers) - 1)
        return pa.table([table.column("block"), table.column("n"), table.column("part"), pa.array(numbers, pa.binary()),
                         pa.array(fresh, pa.int64())], names=["block", "n", "part", "numbers", "fresh"])

    question = "block bigint, n int, part int, keys binary, numbers binary"
    told = None
    for turn in range(1, order + 1):
        if turn == 1:
            def first_asked(batches):
                for b in batches:
                    for i in range(b.num_rows):
                        yield from asked(b.slice(i, 1).to_pylist()[0], None, 1).to_batches()

            sent = blocks.select("block", *columns).mapInArrow(first_asked, question)
        else:
            def next_asked(row: pa.Table, answers: pa.Table) -> pa.Table:
                return asked(row.to_pylist()[0], answers, turn)

            sent = (blocks.select("block", *columns).groupBy("block").cogroup(told.groupBy("block"))
                    .applyInArrow(next_asked, question))
        back = sent.groupBy("n", "part").applyInArrow(added_up, "block bigint, n int, part int, numbers binary, fresh bigint")
        with without_shuffle_files(spark):
            back = stored(back, "answers")
        told = back if told is None else told.unionByName(back)
    words = told.filter("n = 1").agg(F.sum("fresh")).first()[0] or 0
    unit = tokens + 0.5 * (words + 1)

    def scored(row: pa.Table, answers: pa.Table) -> pa.Table:
        block = Block(row.select(columns).to_pylist()[0], told_by(answers), order)
        items = row.column("items").combine_chunks().flatten()
        known, base, score = block.scores(discount, unit)
        return pa.table([*items.flatten(), pa.array(block.lengths), pa.array(known), pa.array(np.full(len(known), tokens)),
                         pa.array(base), pa.array(score)],
                        names=["doc_id", *carry, "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    kinds = "".join(f"{f.name} {f.dataType.simpleString()}, " for f in fields)
    return blocks.select("block", "items", *columns).groupBy("block").cogroup(told.groupBy("block")).applyInArrow(
        scored, kinds + "n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double")
