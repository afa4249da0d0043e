"""Counting the terms of a given vocabulary: token arrays in, counts out, as Arrow UDFs. Terms are n-grams of tokens, joined by
one space; other n-grams of a text are never made."""

from __future__ import annotations

import sys
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import functions as F

# Executors need not have this package: its functions travel with the tasks.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


ROWS = 1000  # token arrays that are counted at a time, at most


def runs(lists) -> Iterator:
    """Arrow rows in runs of ``ROWS``, at least one."""
    for start in range(0, max(len(lists), 1), ROWS):
        yield lists.slice(start, ROWS)


def find(codes: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Place of each wanted code in the sorted codes, -1 where there is none."""
    if not len(codes):
        return np.full(len(wanted), -1)
    place = np.minimum(np.searchsorted(codes, wanted), len(codes) - 1)
    return np.where((wanted >= 0) & (codes[place] == wanted), place, -1)


@dataclass(frozen=True)
class Vocabulary:
    """A tree of tokens: ``codes[k]`` are the sorted codes (state of the first k + 1 tokens, next token) of the beginnings with k + 2
    tokens; ``numbers[k]`` are the terms that end in a state with k + 1 tokens, -1 where none does."""

    terms: list[str]
    tokens: list[str]
    codes: list[np.ndarray]
    numbers: list[np.ndarray]

    @classmethod
    def of(cls, terms: Sequence[str]) -> "Vocabulary":
        split = [t.split(" ") for t in terms]
        tokens = sorted({w for s in split for w in s})
        place = {w: i for i, w in enumerate(tokens)}
        states, codes = [place[s[0]] for s in split], []
        numbers = [np.full(len(tokens), -1)]
        for n in range(1, max(map(len, split), default=1) + 1):
            if n > 1:
                code = [x * len(tokens) + place[s[n - 1]] if len(s) >= n else -1 for s, x in zip(split, states)]
                codes.append(np.array(sorted({c for c in code if c >= 0}), np.int64))
                states = find(codes[-1], np.array(code, np.int64)).tolist()
                numbers.append(np.full(len(codes[-1]), -1))
            for i, s in enumerate(split):
                if len(s) == n:
                    numbers[-1][states[i]] = i
        return cls(list(terms), tokens, codes, numbers)

    def states(self, lists: pa.Array) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
        """(for each length the state that ends at every token, numbers of the tokens, the tokens' lists)."""
        sizes = lists.value_lengths().fill_null(0).to_numpy()
        owner = np.repeat(np.arange(len(lists)), sizes)
        numbers = pc.fill_null(pc.index_in(lists.flatten(), value_set=pa.array(self.tokens, pa.string())), -1).to_numpy().astype(np.int64)
        found = [numbers]
        for codes in self.codes:
            found.append(find(codes, self.longer(found[-1], numbers, owner)))
        return found, numbers, owner

    def longer(self, states: np.ndarray, numbers: np.ndarray, owner: np.ndarray) -> np.ndarray:
        """Code of the state before each token and the token, -1 where either is missing."""
        code = np.full(len(numbers), -1)
        code[1:] = np.where((states[:-1] >= 0) & (numbers[1:] >= 0) & (owner[1:] == owner[:-1]),
                            states[:-1] * len(self.tokens) + numbers[1:], -1)
        return code


def counter(vocabulary: Vocabulary):
    """Arrow UDF: token arrays to arrays of struct(term, tf) of the vocabulary's terms."""
    kind = pa.struct([("term", pa.string()), ("tf", pa.int32())])

    @F.arrow_udf("array<struct<term:string,tf:int>>")
    def counts(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        names, size = pa.array(vocabulary.terms, pa.string()), max(len(vocabulary.terms), 1)

        def counted(lists: pa.Array) -> pa.Array:
            states, _, owner = vocabulary.states(lists)
            pairs = []
            for state, number in zip(states, vocabulary.numbers):
                term = number[np.maximum(state, 0)] if len(number) else np.full(len(state), -1)
                kept = (state >= 0) & (term >= 0)
                pairs.append(owner[kept] * size + term[kept])
            pair, tf = np.unique(np.concatenate(pairs), return_counts=True)
            entries = pa.StructArray.from_arrays([names.take(pa.array(pair % size)), pa.array(tf.astype(np.int32))], fields=list(kind))
            ends = np.searchsorted(pair // size, np.arange(len(lists) + 1))
            return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), entries)

        for lists in batches:
            yield pa.concat_arrays([counted(part) for part in runs(lists)])

    return counts


def token_totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Batches of token arrays to (term, n)."""
    for batch in batches:
        counts = pc.value_counts(batch.column(0).flatten())
        yield pa.RecordBatch.from_arrays([counts.field(0), counts.field(1)], names=["term", "n"])


def longer_totals(vocabulary: Vocabulary):
    """Batches of token arrays to (code, n) of the terms one token longer than the vocabulary's longest whose beginning and whose
    end, without the first token, are in it."""

    def totals(batches):
        for lists in (part for batch in batches for part in runs(batch.column(0))):
            states, numbers, owner = vocabulary.states(lists)
            code = vocabulary.longer(states[-1], numbers, owner)
            code, n = np.unique(code[(code >= 0) & (states[-1] >= 0)], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(code, pa.int64()), pa.array(n, pa.int64())], names=["code", "n"])

    return totals
