"""Toxicity scores of whole texts: a recurrent network reads all overlapping windows, the highest one counts."""

import sys
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from deskloom.llm import gru
from deskloom.llm.words import counts_by_text, scan, slices, text_bytes

# Executors need not have this package: its functions travel with the tasks.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Words are runs of letters and digits in lower case; all other ASCII characters part them.
LOWER = np.frombuffer(bytes(range(256)).lower(), np.uint8)
INSIDE = np.array([c >= 128 or chr(c).isalnum() for c in range(256)])


@dataclass(frozen=True)
class ToxicityRules:
    window: int = 32
    stride: int = 16
    toxic_docs: int = 1500       # labelled documents to learn from
    clean_docs: int = 4000
    most_chars: int = 8000       # of a document to learn from; longer ones are not in the sample, so it is bounded
    min_docs: int = 4            # documents in which a word must occur to get a vector of its own
    passes: int = 5
    batch: int = 128
    least_steps: int = 120       # of learning; few documents are passed through more often
    windows_at_once: int = 2048


@dataclass
class ToxicityModel:
    vocabulary: np.ndarray  # sorted hashes of the words with vectors of their own; number 0 stands for all others
    weights: dict | None          # None if only one class was seen
    prior: float
    rules: ToxicityRules


def window_starts(n_words: int, rules: ToxicityRules) -> range:
    """Starts of windows that overlap and cover all words."""
    return range(0, max(1, n_words - (rules.window - rules.stride)), rules.stride)


@dataclass
class Tokens:
    """Words of several texts one after the other: hashes, number per text, byte trigrams and each word's first one."""

    hashes: np.ndarray
    lengths: np.ndarray
    codes: np.ndarray
    first: np.ndarray

    def numbers(self, vocabulary: np.ndarray) -> np.ndarray:
        if not len(vocabulary):
            return np.zeros(len(self.hashes), np.int64)
        place = np.searchsorted(vocabulary, self.hashes)
        place[place == len(vocabulary)] = 0
        return np.where(vocabulary[place] == self.hashes, place + 1, 0)

    def pick(self, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(codes, first) of the words at these places."""
        sizes = np.diff(np.append(self.first, len(self.codes)))[places]
        first = np.cumsum(sizes) - sizes
        return self.codes[np.repeat(self.first[places] - first, sizes) + np.arange(sizes.sum())], first


def tokenise(texts: list[bytes], trigrams: int) -> Tokens:
    """The tokens of all texts, worked out piece by piece."""
    parts = [_tokens_of_piece(piece, trigrams) for _, piece in in_pieces(texts)] or [_tokens_of_piece([], trigrams)]
    before = np.cumsum([0, *(len(p.codes) for p in parts[:-1])])
    return Tokens(*(np.concatenate([getattr(p, name) for p in parts]) for name in ("hashes", "lengths", "codes")),
                  np.concatenate([p.first + b for p, b in zip(parts, before)]))


def _tokens_of_piece(texts: list[bytes], trigrams: int) -> Tokens:
    data = np.frombuffer(b" " + b" ".join(texts) + b" ", np.uint8)
    inside = INSIDE[data]
    data = np.where(inside, LOWER[data], 32).astype(np.uint64)
    first, last, hashes = scan(data.astype(np.uint8), inside)
    codes = ((data[:-2] * np.uint64(0x9E3779B1) + data[1:-1]) * np.uint64(0x85EBCA6B) + data[2:]) * np.uint64(0xC2B2AE3D27D4EB4F)
    # A word has the trigrams around each of its bytes.
    sizes = last - first
    starts = np.cumsum(sizes) - sizes
    used = np.flatnonzero(inside) - 1
    return Tokens(hashes, counts_by_text(first, texts), ((codes[used] >> np.uint64(40)) % np.uint64(trigrams)).astype(np.int32),
                  starts)


def windows(lengths: np.ndarray, rules: ToxicityRules) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text number, places of the words, mask) of all windows of texts that lie one after the other.

    Places and mask have the shape (steps, windows); places behind the end of a text are those of its last word.
    """
    lengths = np.asarray(lengths).tolist()
    starts = [window_starts(n, rules) for n in lengths]
    owner = np.repeat(np.arange(len(lengths)), [len(s) if n else 0 for s, n in zip(starts, lengths)])
    if not len(owner):
        return owner, np.zeros((rules.window, 0), np.int64), np.zeros((rules.window, 0), np.float32)
    first = np.fromiter(chain.from_iterable(s for s, n in zip(starts, lengths) if n), np.int64, len(owner))
    n = np.array(lengths)[owner]
    offset = (np.cumsum(lengths) - lengths)[owner]
    inside = first + np.arange(rules.window)[:, None]
    return owner, (offset + np.minimum(inside, n - 1)).astype(np.int32), (inside < n).astype(np.float32)


def window_odds(texts: list[bytes], vocabulary: np.ndarray, weights: dict, rules: ToxicityRules) -> tuple[np.ndarray, np.ndarray]:
    """(text number, log-odds) of all windows."""
    tokens = tokenise(texts, len(weights["char"]))
    owner, places, mask = windows(tokens.lengths, rules)
    odds = np.zeros(len(owner), np.float32)
    if len(owner):
        rows = gru.gates(weights, gru.word_inputs(weights, tokens.numbers(vocabulary), tokens.codes, tokens.first))
        for a in range(0, len(owner), rules.windows_at_once):
            b = a + rules.windows_at_once
            odds[a:b] = gru.score(weights, rows[places[:, a:b]], mask[:, a:b, None])
    return owner, odds


def in_pieces(texts: list[bytes], size: int = 1 << 19) -> Iterator[tuple[int, list[bytes]]]:
    """(number of the first text, texts) in runs of about ``size`` bytes."""
    start = total = 0
    for end, text in enumerate(texts):
        total += len(text)
        if total >= size:
            yield start, texts[start:end + 1]
            start, total = end + 1, 0
    if start < len(texts):
        yield start, texts[start:]


def score_texts(texts: list[bytes], model: ToxicityModel) -> np.ndarray:
    """Score of each text: the highest of its windows; a text without words has no window and scores 0."""
    if model.weights is None:
        return np.full(len(texts), model.prior)
    result = np.zeros(len(texts))
    for start, piece in in_pieces(texts):
        owner, odds = window_odds(piece, model.vocabulary, model.weights, model.rules)
        np.maximum.at(result, owner + start, gru.sigmoid(odds.astype(np.float64)))
    return result


def train(texts: list[bytes], labels: list[int], rules: ToxicityRules = ToxicityRules(), seed: int = 11) -> ToxicityModel:
    """Learn from labelled texts. A toxic text says only that some of its windows are toxic.

    So every pass first scores all windows and then learns from each text's highest ones: those of toxic texts as toxic,
    those of clean texts, and random ones, as clean. Word vectors start from how much more often a word occurs in toxic
    texts, which lets the first choice of windows find them.
    """
    random = np.random.RandomState(seed)
    labels = np.array(labels, np.int64)
    weights = gru.initial(gru.Shape(1), seed)
    tokens = tokenise(texts, len(weights["char"]))
    full = tokens.lengths > 0
    prior = float(labels.mean()) if len(labels) else 0.0
    if len(set(labels[full].tolist())) < 2:
        return ToxicityModel(np.empty(0, np.uint64), None, prior, rules)
    # In how many clean and toxic texts each word occurs.
    text = np.repeat(np.arange(len(texts)), tokens.lengths)
    distinct, number = np.unique(tokens.hashes, return_inverse=True)
    seen = np.unique(number * len(texts) + text)
    counts = np.stack([np.bincount(seen[labels[seen % len(texts)] == c] // len(texts), minlength=len(distinct)) for c in (0, 1)])
    vocabulary = distinct[counts.sum(axis=0) >= rules.min_docs]
    shares = (counts[:, counts.sum(axis=0) >= rules.min_docs] + 0.5) / (np.bincount(labels, minlength=2)[:, None] + 1)
    lean = np.concatenate([[0.0], np.clip(np.log(shares[1] / shares[0]), -3, 3)])
    weights = gru.initial(gru.Shape(len(lean)), seed)
    weights["word"][:, 0] = lean / 1.5
    weights["word"][0] = 0
    numbers = tokens.numbers(vocabulary)
    owner, places, mask = windows(tokens.lengths, rules)
    ranking = lean[numbers][places].max(axis=0)  # the first choice of windows
    adam, toxic = gru.Adam(), labels[owner] == 1
    size = weights["word"].shape[1]
    turn = 0
    while turn < rules.passes or adam.steps < rules.least_steps:
        if turn:
            ranking = np.concatenate([window_odds(piece, vocabulary, weights, rules)[1] for _, piece in in_pieces(texts)])
        turn += 1
        order = np.lexsort((-ranking, owner))
        rank = np.empty(len(owner), np.int64)
        rank[order] = np.arange(len(owner)) - np.searchsorted(owner, owner)[order]
        hard = np.flatnonzero(rank < np.where(toxic, 2, 1))
        plain = np.flatnonzero(~toxic)
        some = random.choice(plain, min(len(plain), len(hard)), replace=False)
        chosen = random.permutation(np.concatenate([hard, some]))
        for a in range(0, len(chosen), rules.batch):
            pick = chosen[a:a + rules.batch]
            here = places[:, pick].reshape(-1)
            codes, first = tokens.pick(here)
            vectors = gru.word_inputs(weights, numbers[here], codes, first).reshape(rules.window, len(pick), -1)
            slopes, d_inputs, _ = gru.gradients(weights, vectors, mask[:, pick, None], labels[owner[pick]])
            d_inputs = d_inputs.reshape(len(here), -1)
            slopes["word"], slopes["char"] = np.zeros_like(weights["word"]), np.zeros_like(weights["char"])
            np.add.at(slopes["word"], numbers[here], d_inputs[:, :size])
            slopes["word"][0] = 0
            counts = np.diff(np.append(first, len(codes)))
            np.add.at(slopes["char"], codes, np.repeat(d_inputs[:, size:] / counts[:, None], counts, axis=0))
            adam.step(weights, slopes)
    return ToxicityModel(vocabulary, weights, prior, rules)


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic",
        rules: ToxicityRules = ToxicityRules()) -> ToxicityModel:
    """A model from at most ``toxic_docs`` and ``clean_docs`` labelled documents, smallest hash of the id first.

    The sample holds whole texts of at most ``most_chars`` characters. Labels other than 0 and 1, null ids and labels without
    such a document teach nothing. Rows that repeat an id count once, with the smallest text. Without both classes there is no
    network, and every text scores the share of toxic ones.
    """
    marks = labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("label")).filter(
        "id IS NOT NULL AND label IN (0, 1)").distinct()
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).filter(
        F.length("text") <= rules.most_chars)
    marks = marks.join(texts.select("id"), "id", "left_semi").withColumn("order", F.xxhash64("id"))
    # Each task keeps its own smallest hashes; no task sees all rows of a label.
    sample = [marks.filter(F.col("label") == label).orderBy("order", "id").limit(most)
              for label, most in ((1, rules.toxic_docs), (0, rules.clean_docs))]
    chosen = sorted((place, r["label"], r["id"]) for part in sample for place, r in enumerate(part.collect()))
    if not chosen:
        return train([], [], rules)
    ids = docs.sparkSession.createDataFrame([(i,) for i in {i for *_, i in chosen}], f"id {dict(marks.dtypes)['id']}")
    found = dict(texts.join(F.broadcast(ids), "id").groupBy("id").agg(F.min("text")).collect())
    return train([found[i].encode("utf-8", "surrogatepass") for *_, i in chosen], [label for _, label, _ in chosen], rules)


def toxicity(docs: DataFrame, model: ToxicityModel, id_col: str = "doc_id", text_col: str = "text",
             carry: tuple = ()) -> DataFrame:
    """One row per input row: doc_id, the columns ``carry``, score. Texts without words, null ones too, score 0."""
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"), *carry)
    shared = spark.sparkContext.broadcast(model)
    kinds = dict(rows.dtypes)

    def rate(batches):
        for part in slices(batches):
            result = score_texts(text_bytes(part.column(1)), shared.value)
            yield pa.RecordBatch.from_arrays([part.column(0), *part.columns[2:], pa.array(result, pa.float64())],
                                             names=["doc_id", *carry, "score"])

    return rows.mapInArrow(rate, f"doc_id {kinds['doc_id']}, " + "".join(f"{c} {kinds[c]}, " for c in carry) + "score double")
