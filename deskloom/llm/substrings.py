"""Substring deduplication with suffix automata of reference shards.

Text that an earlier document already holds is removed: every word that lies in a window of ``width`` words which also
starts in a document with a smaller id.

Fingerprints of all windows tell where to look: which places repeat, and in which earlier document. Those places of the
earlier documents are the reference text. It is cut into shards; a suffix automaton is built of each, and the later
documents' repeated places are streamed through the automaton of the shard that holds their counterpart. Its matching
statistics decide, on the words themselves, what is removed. A shard is sent to the tasks that need it, not to all.
"""

import hashlib
import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from deskloom.llm.words import mix, slices, text_bytes, window_hashes, word_hashes
from deskloom.session import stored

# Executors need not have this package: its functions travel with the tasks.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

BLOCK_BYTES = 4 << 20  # of text whose windows are compared at once


@dataclass(frozen=True)
class SubstringRules:
    width: int = 13             # words of a window
    spans_per_task: int = 50_000  # that are streamed through one copy of a shard


class SuffixAutomaton:
    """Automaton of all substrings of some word sequences, each state with the smallest document that holds it."""

    def __init__(self):
        self.next: list[dict] = [{}]
        self.link, self.length, self.first = [-1], [0], [1 << 62]

    def _state(self, length: int, first: int) -> int:
        self.next.append({})
        self.link.append(-1)
        self.length.append(length)
        self.first.append(first)
        return len(self.length) - 1

    def _split(self, state: int, word: bytes) -> int:
        """The state of what ``state`` and ``word`` make, cut off from a state that also holds longer text."""
        after = self.next[state][word]
        if self.length[after] == self.length[state] + 1:
            return after
        clone = self._state(self.length[state] + 1, self.first[after])
        self.next[clone] = dict(self.next[after])
        self.link[clone], self.link[after] = self.link[after], clone
        while state >= 0 and self.next[state].get(word) == after:
            self.next[state][word] = clone
            state = self.link[state]
        return clone

    def add(self, words: list[bytes], document: int) -> None:
        last = 0
        for word in words:
            if word in self.next[last]:
                last = self._split(last, word)
                self.first[last] = min(self.first[last], document)
                continue
            new, state = self._state(self.length[last] + 1, document), last
            while state >= 0 and word not in self.next[state]:
                self.next[state][word] = new
                state = self.link[state]
            self.link[new] = 0 if state < 0 else self._split(state, word)
            last = new

    def finish(self) -> None:
        """What holds a text holds its suffixes."""
        for state in sorted(range(1, len(self.length)), key=self.length.__getitem__, reverse=True):
            up = self.link[state]
            self.first[up] = min(self.first[up], self.first[state])

    def ends(self, words: list[bytes], width: int) -> list[tuple[int, int]]:
        """(place, smallest document) for the last place of every ``width``-word window that the automaton holds."""
        found, state, size = [], 0, 0
        for place, word in enumerate(words):
            while state and word not in self.next[state]:
                state = self.link[state]
                size = self.length[state]
            if word in self.next[state]:
                state, size = self.next[state][word], size + 1
            if size >= width:
                at = state
                while self.length[self.link[at]] >= width:
                    at = self.link[at]
                found.append((place, self.first[at]))
        return found


def planes(values: np.ndarray) -> bytes:
    """Integers as byte planes, compressed; high bytes are mostly zero."""
    return zstandard.compress(values.astype("<u8").view(np.uint8).reshape(-1, 8).T.tobytes(), 1)


def from_planes(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(zstandard.decompress(data), np.uint8).reshape(8, -1).T).view("<u8").reshape(-1)


def place_codes(document: np.ndarray, place: np.ndarray) -> np.ndarray:
    """Rising places of rising documents as the steps inside a document and the first place of each: never negative, so the
    high byte planes stay empty."""
    steps = place.copy()
    same = document[1:] == document[:-1]
    steps[1:][same] -= place[:-1][same]
    return steps


def places_from(document: np.ndarray, steps: np.ndarray) -> np.ndarray:
    sums = np.cumsum(steps)
    first = np.flatnonzero(np.diff(document, prepend=document[:1] - 1))
    return sums - np.repeat(sums[first] - steps[first], np.diff(np.append(first, len(steps))))


def group_of(documents: np.ndarray, groups: int) -> np.ndarray:
    return (mix(documents.astype(np.int64).view(np.uint64)) % np.uint64(groups)).astype(np.int64)


def hit_rows(document: np.ndarray, place: np.ndarray, earlier: np.ndarray, groups: int) -> Iterator[tuple]:
    """(group, packed hits): windows by their document; ``earlier`` is a smaller document with the window, or -1 if the
    window itself is that of the smaller document."""
    group = group_of(document, groups)
    order = np.lexsort((place, document, group))
    group, hits = group[order], np.stack([document, place, earlier]).astype(np.int64)[:, order]
    edges = np.flatnonzero(np.concatenate([[True], group[1:] != group[:-1], [True]])) if len(group) else np.zeros(1, int)
    for a, b in zip(edges[:-1], edges[1:]):
        part = hits[:, a:b]
        part[0, 1:] = np.diff(part[0])
        yield int(group[a]), planes(np.concatenate(part).view(np.uint64))


def hits_from(packed: bytes) -> np.ndarray:
    hits = from_planes(packed).view(np.int64).reshape(3, -1).copy()
    hits[0] = np.cumsum(hits[0])
    return hits


def repeated(key: np.ndarray, document: np.ndarray, place: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(document, place, earlier, rows of the smallest document of each key): the hits among equal keys of several
    documents. A key can have several rows in one document."""
    order = np.argsort(key)
    key = key[order]
    new = np.ones(len(key), bool)
    new[1:] = key[1:] != key[:-1]
    starts = np.flatnonzero(new)
    again = np.flatnonzero(~new)
    if not len(again):
        none = np.empty(0, np.int64)
        return none, none, none, order
    shared = np.unique(np.searchsorted(starts, again, "right") - 1)  # keys with several rows
    sizes = np.diff(np.append(starts, len(key)))[shared]
    group = np.repeat(np.arange(len(shared)), sizes)
    rows = order[np.repeat(starts[shared] - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())]
    by_document = np.lexsort((place[rows], document[rows], group))
    rows = rows[by_document]
    heads = rows[np.cumsum(sizes) - sizes]
    later = document[rows] > document[heads][group]
    led = heads[np.unique(group[later])]
    alone = np.ones(len(starts), bool)
    alone[shared] = False
    smallest = np.concatenate([order[starts[alone]], rows[~later]])
    return (np.concatenate([document[rows[later]], document[led]]), np.concatenate([place[rows[later]], place[led]]),
            np.concatenate([document[heads][group[later]], np.full(len(led), -1)]), smallest)


def fingerprints(rows: DataFrame, rules: SubstringRules, parts: int, groups: int) -> DataFrame:
    """(key, group, packed): hits inside a block of documents (group >= 0), and for each part of the key space every
    window of the block, as it stands in the smallest document (group -1).

    A window that very many documents share leaves a block once, however often it occurs there. Windows meet on all 64 bits
    of their hash: another window with an equal key would hide the true earlier document.
    """

    def read(batches):
        for block in slices(batches, BLOCK_BYTES):
            ids = np.array(block.column(0).to_pylist(), np.int64)
            words, lengths = word_hashes(text_bytes(block.column(1)))
            window = window_hashes(words, rules.width)
            if not len(window):
                continue
            starts = np.cumsum(lengths) - lengths
            owner = np.repeat(np.arange(len(lengths)), lengths)[:len(window)]
            place = np.arange(len(window)) - starts[owner]
            inside = place + rules.width <= lengths[owner]
            window, document, place = window[inside], ids[owner[inside]], place[inside]
            later, at, earlier, first = repeated(window, document, place)
            out = [(g, g, p) for g, p in hit_rows(later, at, earlier, groups)]
            first = first[np.lexsort((place[first], document[first]))]
            window, document, place = window[first], document[first], place[first]
            key, part = np.divmod(window, np.uint64(parts))  # both together are the whole hash
            part = part.astype(np.int64)
            order = np.argsort(part, kind="stable")
            edges = np.searchsorted(part[order], np.arange(parts + 1))
            for p in range(parts):
                own = order[edges[p]:edges[p + 1]]
                if len(own):
                    numbers = np.concatenate([document[own][:1], np.diff(document[own]), place_codes(document[own], place[own])])
                    out.append((p, -1, planes(np.concatenate([key[own], numbers.view(np.uint64)]))))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(
                    zip(*out), (pa.int32(), pa.int32(), pa.binary()))], names=["key", "group", "packed"])

    return rows.mapInArrow(read, "key int, group int, packed binary")


def all_hits(prints: DataFrame, groups: int) -> DataFrame:
    """(group, packed) of all hits: those found inside blocks and those between blocks."""

    def between(found):
        key, document, place = (np.concatenate(c) for c in zip(*found))
        later, at, earlier, _ = repeated(key, document, place)
        rows = list(hit_rows(later, at, earlier, groups))
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(
                zip(*rows), (pa.int32(), pa.binary()))], names=["group", "packed"])

    def meet(batches):
        current, found = None, []
        for batch in batches:
            group = batch.column(1).to_numpy()
            inner = pa.array(np.flatnonzero(group >= 0))
            if len(inner):
                yield pa.RecordBatch.from_arrays([batch.column(1).take(inner), batch.column(2).take(inner)],
                                                 names=["group", "packed"])
            for i in np.flatnonzero(group < 0).tolist():
                part, packed = batch.column(0)[i].as_py(), batch.column(2)[i].as_py()
                if part != current and found:
                    yield from between(found)
                    found = []
                current = part
                key, *numbers = from_planes(packed).reshape(3, -1)
                document = np.cumsum(numbers[0].view(np.int64))
                found.append((key, document, places_from(document, numbers[1].view(np.int64))))
        if found:
            yield from between(found)

    return prints.repartition("key").sortWithinPartitions("key").mapInArrow(meet, "group int, packed binary")


def runs(places: np.ndarray, width: int) -> list[tuple[int, int]]:
    """(first word, last word + 1) of the text that windows at rising places cover, cut where a window is missing."""
    cuts = np.flatnonzero(np.diff(places) > 1) + 1
    return [(int(p[0]), int(p[-1]) + width) for p in np.split(places, cuts) if len(p)]


def finished(words: list[bytes], spans: list[tuple[int, int]]) -> tuple[int, int, str]:
    """(words, words removed, digest of the kept words)."""
    removed = np.zeros(len(words), bool)
    for a, b in spans:
        removed[a:b] = True
    kept = [w for w, r in zip(words, removed.tolist()) if not r] if spans else words
    return len(words), len(words) - len(kept), hashlib.sha256(b" ".join(kept)).hexdigest()


# What a task that reads a document with its hits gives: finished documents, documents that wait for the automata,
# reference text and text to stream.
DONE, WAITING, REFERENCE, STREAM = range(4)
# ``number`` is the count of words of finished documents, else it tells texts with the same id apart.
PLACED = "kind int, doc_id bigint, earlier bigint, start int, words binary, number bigint, digest string"


def place_hits(rows: DataFrame, hits: DataFrame, rules: SubstringRules, groups: int) -> DataFrame:
    """Documents meet their hits: one shuffle of the texts. Those of a slice that go to the same group travel in one frame."""

    def grouped(batches):
        packer = zstandard.ZstdCompressor(level=3)
        for part in slices(batches, BLOCK_BYTES):
            ids, texts = part.column(0).cast(pa.int64()).to_numpy(), text_bytes(part.column(1))
            group = group_of(ids, groups)
            out = []
            for g in np.unique(group).tolist():
                own = np.flatnonzero(group == g)
                held = [texts[i] for i in own]
                out.append((g, ids[own].tobytes(), np.array([len(t) for t in held], np.int64).tobytes(), packer.compress(b"".join(held))))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(
                    zip(*out), (pa.int32(), pa.binary(), pa.binary(), pa.binary()))], names=["group", "ids", "sizes", "text"])

    texts = rows.mapInArrow(grouped, "group int, ids binary, sizes binary, text binary").select(
        "group", F.lit(1).alias("role"), "ids", "sizes", "text")
    none = F.lit(None).cast("binary")
    packed = hits.select("group", F.lit(0).alias("role"), none.alias("ids"), none.alias("sizes"), F.col("packed").alias("text"))
    met = packed.union(texts).repartition("group").sortWithinPartitions("group", "role")

    def extract(batches):
        group, held, known = None, [], None
        unpacker, packer = zstandard.ZstdDecompressor(), zstandard.ZstdCompressor(level=3)

        def documents(ids, sizes, data):
            """(id, text) of the documents of a frame; hits have no ids and come as they are."""
            if ids is None:
                yield None, data
                return
            texts, at = unpacker.decompress(data), 0
            for doc, size in zip(np.frombuffer(ids, np.int64).tolist(), np.frombuffer(sizes, np.int64).tolist()):
                yield doc, texts[at:at + size]
                at += size

        for part in slices(batches, 2 << 20):
            out = []
            frames = zip(*(part.column(i).to_pylist() for i in range(5)))
            for g, role, doc, data in ((g, r, d, t) for g, r, *frame in frames for d, t in documents(*frame)):
                if g != group:
                    group, held, known = g, [], None
                if role == 0:
                    held.append(hits_from(data))
                    continue
                if known is None:
                    known = np.concatenate(held, axis=1) if held else np.zeros((3, 0), np.int64)
                    known = known[:, np.lexsort((known[1], known[2], known[0]))]
                words, tag = data.split(), xxhash.xxh3_64_intdigest(data) >> 1
                a, b = np.searchsorted(known[0], [doc, doc + 1])
                mine = known[1:, a:b]
                mine = mine[:, mine[0] + rules.width <= len(words)]
                if not mine.shape[1]:
                    out.append((DONE, doc, None, None, None, *finished_columns(words)))
                    continue
                for earlier in np.unique(mine[1]).tolist():
                    for start, end in runs(np.unique(mine[0][mine[1] == earlier]), rules.width):
                        span = b" ".join(words[start:end])
                        out.append((REFERENCE, doc, doc, start, span, tag, None) if earlier < 0
                                   else (STREAM, doc, earlier, start, span, tag, None))
                if (mine[1] >= 0).any():
                    out.append((WAITING, doc, None, None, packer.compress(data), tag, None))
                else:
                    out.append((DONE, doc, None, None, None, *finished_columns(words)))
            if out:
                types = (pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.int64(), pa.string())
                yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(zip(*out), types)],
                                                 names=["kind", "doc_id", "earlier", "start", "words", "number", "digest"])

    return met.mapInArrow(extract, PLACED)


def finished_columns(words: list[bytes]) -> tuple[int, str]:
    n, _, digest = finished(words, [])
    return n, digest


def streamed(spans: DataFrame, rules: SubstringRules, shards: int) -> DataFrame:
    """(doc_id, number, first, last): the text that the automata find in smaller documents. Hot shards are built several times."""
    shard = F.pmod(F.xxhash64("earlier"), F.lit(shards)).cast("int")
    spans = spans.select(shard.alias("shard"), (F.col("kind") == STREAM).cast("int").alias("role"), "doc_id", "number", "start", "words")
    copies = (spans.filter("role = 1").groupBy("shard")
              .agg(F.ceil(F.count("*") / F.lit(rules.spans_per_task)).cast("int").alias("copies")))
    dealt = spans.join(copies, "shard")
    copy = F.when(F.col("role") == 1, F.array(F.pmod(F.xxhash64("doc_id", "start"), F.col("copies")).cast("int"))).otherwise(
        F.sequence(F.lit(0), F.col("copies") - 1))
    met = (dealt.withColumn("copy", F.explode(copy)).select("shard", "copy", "role", "doc_id", "number", "start", "words")
           .repartition(F.col("shard"), F.col("copy")).sortWithinPartitions("shard", "copy", "role", "doc_id"))

    def stream(batches):
        current, automaton, ready, memory = None, None, False, {}
        for part in slices(batches):
            out = []
            for s, c, role, doc, tag, start, data in zip(*(part.column(i).to_pylist() for i in range(7))):
                if (s, c) != current:
                    current, automaton, ready, memory = (s, c), SuffixAutomaton(), False, {}
                if role == 0:
                    automaton.add(data.split(), doc)
                    continue
                if not ready:
                    automaton.finish()
                    ready = True
                if data not in memory:  # passages that many documents share are streamed once
                    if len(memory) > 10_000:
                        memory.clear()
                    memory[data] = automaton.ends(data.split(), rules.width)
                ends = np.array([place for place, first in memory[data] if first < doc], np.int64)
                out += [(doc, tag, start + a, start + b) for a, b in runs(ends - rules.width + 1, rules.width)] if len(ends) else []
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(
                    zip(*out), (pa.int64(), pa.int64(), pa.int32(), pa.int32()))], names=["doc_id", "number", "first", "last"])

    return met.mapInArrow(stream, "doc_id bigint, number bigint, first int, last int")


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   rules: SubstringRules = SubstringRules()) -> DataFrame:
    """One row per input row: doc_id, n_words, n_removed, kept_sha256 (of the kept words, joined by blanks).

    Windows are judged on the input. Null and empty texts have no words. Rows that repeat an id are documents of the same
    rank: neither takes from the other. A row without id is no reference and loses nothing. Ids are whole numbers.
    """
    spark = docs.sparkSession
    groups = int(spark.conf.get("spark.sql.shuffle.partitions"))  # of documents
    parts = 4 * groups  # of the key space; a task takes several, one by one
    rows = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit(""))
                       .alias("text"))
    named = rows.filter("doc_id IS NOT NULL")
    hits = all_hits(fingerprints(named, rules, parts, groups), groups)
    placed = stored(place_hits(named, hits, rules, groups), "placed")
    spans = placed.filter(F.col("kind").isin(REFERENCE, STREAM)).drop("digest")
    found = (streamed(spans, rules, parts).groupBy("doc_id", "number")
             .agg(F.collect_list(F.struct("first", "last")).alias("spans")))  # bounded by the length of the document
    waiting = placed.filter(F.col("kind") == WAITING).select("doc_id", "number", F.col("words").alias("text"))
    waiting = waiting.join(found, ["doc_id", "number"], "left").select("doc_id", "text", "spans")
    bare = rows.filter("doc_id IS NULL").select("doc_id", F.col("text").cast("binary"))

    def finish(batches):
        unpacker = zstandard.ZstdDecompressor()
        for part in slices(batches, 2 << 20):
            packed = part.num_columns == 3  # texts with spans come compressed
            spans = part.column(2).to_pylist() if packed else [None] * part.num_rows
            out = [finished((unpacker.decompress(text) if packed else text).split(), [(s["first"], s["last"]) for s in own or ()])
                   for text, own in zip(part.column(1).to_pylist(), spans)]
            yield pa.RecordBatch.from_arrays([part.column(0), *(pa.array(list(c), t) for c, t in zip(
                zip(*out), (pa.int64(), pa.int64(), pa.string())))], names=["doc_id", "n_words", "n_removed", "kept_sha256"])

    schema = "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string"
    done = placed.filter(F.col("kind") == DONE).select("doc_id", F.col("number").alias("n_words"), F.lit(0).cast("bigint").alias("n_removed"),
                                                       F.col("digest").alias("kept_sha256"))
    return done.union(waiting.mapInArrow(finish, schema)).union(bare.mapInArrow(finish, schema))
