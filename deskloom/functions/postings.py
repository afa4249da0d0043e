"""Posting lists of blocks of documents, and the search of such blocks: Arrow batches in, Arrow batches out.

A block holds some documents and, for every term in them, its list: places in the block and counts. The idf of a term is the
same for its whole list, so the weights in a list are compared without it; a search brings it along with its own weights.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext, cloudpickle

# Executors need not have this package: its functions travel with the tasks.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

BLOCK_BYTES = 16 << 20  # of counted terms in a block, about
PAIRS = 1 << 20         # (query, posting) pairs that are added up at once, about


@dataclass(frozen=True)
class Asked:
    """The terms of some queries: ``terms[i]`` is asked by ``queries[ends[i]:ends[i + 1]]`` with ``gains`` (weight in the query
    times idf). Queries are numbered by their place in ``ids``."""

    ids: pa.Array
    terms: pa.Array
    ends: np.ndarray
    queries: np.ndarray
    gains: np.ndarray

    @classmethod
    def of(cls, rows: pa.Table) -> "Asked":
        """From the columns query, term, gain."""
        query, term = (whole(rows.column(c)).dictionary_encode("encode") for c in ("query", "term"))
        number, place = query.indices.to_numpy(), term.indices.to_numpy()
        order = np.lexsort((number, place))
        ends = np.concatenate([[0], np.cumsum(np.bincount(place, minlength=len(term.dictionary)))])
        return cls(query.dictionary, term.dictionary, ends, number[order], rows.column("gain").to_numpy()[order])


def whole(column) -> pa.Array:
    return column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column


def pieces(batches, rows: int, max_bytes: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """The rows in runs of at most ``rows`` and about ``max_bytes``, a larger single row alone."""
    for batch in batches:
        step = max(1, min(rows, int(batch.num_rows * max_bytes / max(batch.nbytes, 1))))
        for start in range(0, batch.num_rows, step):
            yield batch.slice(start, step)


def ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """starts[0], starts[0] + 1, ... (sizes[0] numbers), then those of the next, and so on."""
    return np.arange(sizes.sum()) + np.repeat(starts - np.cumsum(sizes) + sizes, sizes)


def list_of(values: pa.Array) -> pa.Array:
    """One row that holds all values."""
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)


def weights(tfs: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Weights of postings but for the idf of their term."""
    return (1 + np.log(tfs.astype(float))) / lengths


def best_in(asked, pool: int, digits: int):
    """Blocks (ids, lengths, terms, sizes, places, tfs, repeats) to (query, doc, score): all that can be among the ``pool`` best
    documents of a query, ties by doc.

    What the heaviest postings of a block add up to bounds its scores. A query opens a block only if that bound reaches the
    score that ``pool`` documents of earlier blocks have; scores are compared after rounding to ``digits``.
    """
    slack = 10.0 ** -digits

    def search(batches):
        known = asked.value
        n = len(known.ids)
        best, floor = np.zeros((n, pool)), np.zeros(n)
        for batch in batches:
            for row in range(batch.num_rows):
                ids, lengths, terms, sizes, places, tfs = (batch.column(i)[row].values for i in range(6))
                at = pc.fill_null(pc.index_in(terms, value_set=known.terms), -1).to_numpy()
                hit = np.flatnonzero(at >= 0)
                if not len(hit):
                    continue
                lengths, sizes, places, tfs = (x.to_numpy() for x in (lengths, sizes, places, tfs))
                weight, starts = weights(tfs, lengths[places]), np.cumsum(sizes) - sizes
                count = known.ends[at[hit] + 1] - known.ends[at[hit]]
                entry, of = ranges(known.ends[at[hit]], count), np.repeat(hit, count)
                query, gain = known.queries[entry], known.gains[entry]
                heaviest = np.maximum.reduceat(weight, starts)
                bound = np.bincount(query, gain * heaviest[of], minlength=n) * batch.column(6)[row].as_py()
                able = np.flatnonzero((bound > 0) & (bound >= floor - 2 * slack))
                if not len(able):
                    continue
                number = np.full(n, -1)
                number[able] = np.arange(len(able))
                kept = number[query] >= 0
                query, gain, of = number[query[kept]], gain[kept], of[kept]
                scores = np.zeros(len(able) * len(ids))
                edges = np.searchsorted(np.cumsum(sizes[of]), np.arange(PAIRS, int(sizes[of].sum()), PAIRS))
                for first, last in zip([0, *edges], [*edges, len(of)]):
                    if first == last:
                        continue
                    size = sizes[of[first:last]]
                    posting = ranges(starts[of[first:last]], size)
                    cell = np.repeat(query[first:last] * len(ids), size) + places[posting]
                    scores += np.bincount(cell, np.repeat(gain[first:last], size) * weight[posting], minlength=len(scores))
                scores = scores.reshape(len(able), len(ids))
                rounded = np.round(scores, digits)
                most = rounded.max(axis=1)
                better = np.flatnonzero((most > 0) & (most >= floor[able]))
                if not len(better):
                    continue
                place = np.argsort(-rounded[better], axis=1, kind="stable")[:, :pool]  # ids rise with their places
                top = np.take_along_axis(rounded[better], place, axis=1)
                of_query = able[better]
                chosen, column = np.nonzero((top > 0) & (top >= floor[of_query][:, None]))
                found = place[chosen, column]
                yield pa.RecordBatch.from_arrays(
                    [known.ids.take(pa.array(of_query[chosen])), ids.take(pa.array(found)), pa.array(scores[better[chosen], found])],
                    names=["query", "doc", "score"])
                best[of_query] = np.sort(np.concatenate([best[of_query], top], axis=1), axis=1)[:, -pool:]
                floor[of_query] = best[of_query, 0]

    return search


# ---- blocks, and the lengths of their documents, which are kept apart ----

TERM_BLOCK = ("block bigint, ids array<{kind}>, terms array<string>, dfs array<bigint>, sizes array<int>, places array<int>, tfs array<int>, "
              "repeats int")
FREQUENCIES = "block bigint, part int, dfs binary, terms array<string>, df array<bigint>"
LENGTHS = "block bigint, lengths array<double>"
CELLS = 1 << 21  # (query, document) sums that are held at once, about
ODD = np.uint64(0x9E3779B97F4A7C15)


def parts_of(terms: pa.Array, parts: int) -> np.ndarray:
    """A part for every term, from a hash of its bytes."""
    ends = np.frombuffer(terms.buffers()[1], np.int32)[terms.offset:terms.offset + len(terms) + 1].astype(np.int64)
    if not len(terms) or ends[0] == ends[-1]:
        return np.zeros(len(terms), np.int64)
    letters = np.frombuffer(terms.buffers()[2], np.uint8)[ends[0]:ends[-1]].astype(np.uint64) + np.uint64(1)
    powers = np.cumprod(np.full(64, ODD))
    sizes = np.diff(ends)
    letters *= powers[ranges(np.zeros(len(sizes), np.int64), sizes) % 64]
    found = np.zeros(len(terms), np.uint64)
    found[sizes > 0] = np.add.reduceat(letters, (ends[:-1] - ends[0])[sizes > 0])
    return ((found ^ (found >> np.uint64(29))) * ODD >> np.uint64(32)).astype(np.int64) % parts


def joined(batches, rows: int, max_bytes: int = BLOCK_BYTES):
    """The rows as tables of about ``rows``, or of about ``max_bytes`` where they are long."""
    waiting, count, size = [], 0, 0
    for part in pieces(batches, rows, max_bytes):
        if waiting and (count + part.num_rows > rows or size + part.nbytes > max_bytes):
            yield pa.Table.from_batches(waiting)
            waiting, count, size = [], 0, 0
        waiting.append(part)
        count, size = count + part.num_rows, size + part.nbytes
    if waiting:
        yield pa.Table.from_batches(waiting)


def term_blocks(docs: int):
    """Batches (id, terms, tfs, copies) to blocks of at most ``docs`` documents, ordered by id; the terms of a block are sorted.

    ``copies`` has one number for all terms of a document, or one for each. ``dfs`` adds them up per term.
    """

    def build(batches):
        block = TaskContext.get().partitionId() << 32
        for part in joined(batches, docs):
            part = part.take(pc.sort_indices(part, sort_keys=[("id", "ascending")], null_placement="at_start"))
            ids, terms, tfs, copies = (whole(c) for c in part.columns)
            encoded = terms.flatten().dictionary_encode()
            if not len(encoded):
                continue
            rising = pc.sort_indices(encoded.dictionary)
            rank = np.empty(len(rising), np.int64)
            rank[rising.to_numpy()] = np.arange(len(rising))
            code = rank[encoded.indices.to_numpy()]
            sizes, given = (pc.list_value_length(x).to_numpy() for x in (terms, copies))
            share = np.repeat(copies.flatten().to_numpy(), np.repeat(np.where(given == 1, sizes, 1), given))
            place = np.repeat(np.arange(len(ids)), sizes)
            order = np.lexsort((place, code))
            lists = np.bincount(code)
            dfs = np.add.reduceat(share[order], np.cumsum(lists) - lists)
            same = (code[order][1:] == code[order][:-1]) & (place[order][1:] == place[order][:-1])
            repeats = 1 if not same.any() else int(np.unique(code * len(ids) + place, return_counts=True)[1].max())
            columns = [ids, encoded.dictionary.take(rising), pa.array(dfs, pa.int64()), pa.array(lists, pa.int32()),
                       pa.array(place[order], pa.int32()), pa.array(tfs.flatten().to_numpy()[order], pa.int32())]
            yield pa.RecordBatch.from_arrays(
                [pa.array([block], pa.int64()), *(list_of(c) for c in columns), pa.array([repeats], pa.int32())],
                names=["block", "ids", "terms", "dfs", "sizes", "places", "tfs", "repeats"])
            block += 1

    return build


def squeezed(values: bytes) -> bytes:
    return len(values).to_bytes(8, "little") + pa.Codec("zstd").compress(values, asbytes=True)


def unsqueezed(values: bytes) -> bytes:
    return pa.Codec("zstd").decompress(values[8:], int.from_bytes(values[:8], "little"), asbytes=True)


def by_parts(terms: pa.Array, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """(places of the terms, part by part; where each part begins and the last ends)."""
    part = parts_of(terms, parts)
    order = np.argsort(part, kind="stable")
    return order, np.searchsorted(part[order], np.arange(parts + 1))


def term_runs(parts: int):
    """Batches (block, terms, dfs) to (part, block, terms, dfs): the sorted terms of a block that belong to a part, squeezed."""

    def send(batches):
        for batch in batches:
            for row in range(batch.num_rows):
                terms, dfs = batch.column(1)[row].values, batch.column(2)[row].values.to_numpy()
                order, edges = by_parts(terms, parts)
                used = np.flatnonzero(edges[1:] > edges[:-1])
                dealt, dfs = terms.take(pa.array(order)), dfs[order]
                lists = pa.ListArray.from_arrays(pa.array([*edges[used], edges[-1]], pa.int32()), dealt)
                texts = pc.binary_join(lists, "\n").to_pylist()
                yield pa.RecordBatch.from_arrays(
                    [pa.array(used, pa.int32()), pa.array([batch.column(0)[row].as_py()] * len(used), pa.int64()),
                     pa.array([squeezed(t.encode()) for t in texts], pa.binary()),
                     pa.array([squeezed(dfs[edges[p]:edges[p + 1]].tobytes()) for p in used], pa.binary())],
                    names=["part", "block", "terms", "dfs"])

    return send


def summed_runs(key, runs):
    """The runs of a part to ``FREQUENCIES``: for each block the whole frequencies of its run, in its order, and a row of all terms."""
    lists = [pc.split_pattern(pa.array([unsqueezed(t).decode()]), "\n").values for t in runs.column("terms").to_pylist()]
    counts = [np.frombuffer(unsqueezed(c), np.int64) for c in runs.column("dfs").to_pylist()]
    encoded = pa.concat_arrays(lists).dictionary_encode()
    code = encoded.indices.to_numpy()
    df = np.zeros(len(encoded.dictionary), np.int64)
    np.add.at(df, code, np.concatenate(counts))
    ends = np.cumsum([0, *map(len, counts)])
    found = [squeezed(df[code[a:b]].tobytes()) for a, b in zip(ends, ends[1:])]
    rising = pc.sort_indices(encoded.dictionary)
    n, part = len(found), key[0].as_py()
    empty = [None] * n
    return pa.table([pa.array([*runs.column("block").to_pylist(), None], pa.int64()), pa.array([part] * (n + 1), pa.int32()),
                     pa.array([*found, None], pa.binary()),
                     pa.chunked_array([pa.array(empty, pa.list_(pa.string())), list_of(encoded.dictionary.take(rising))]),
                     pa.chunked_array([pa.array(empty, pa.list_(pa.int64())), list_of(pa.array(df[rising.to_numpy()]))])],
                    names=["block", "part", "dfs", "terms", "df"])


def dealt_postings(parts: int):
    """Batches (block, n, terms, sizes, places, tfs) to (block, n, sizes, places, tfs): the lists of a block in the order of its runs."""

    def send(batches):
        for batch in batches:
            for row in range(batch.num_rows):
                terms, sizes, places, tfs = (batch.column(i)[row].values for i in range(2, 6))
                order, _ = by_parts(terms, parts)
                sizes, places, tfs = (x.to_numpy() for x in (sizes, places, tfs))
                at = ranges((np.cumsum(sizes) - sizes)[order], sizes[order])
                packed = [squeezed(x.astype(np.int32).tobytes()) for x in (sizes[order], places[at], tfs[at])]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(row, 1), batch.column(1).slice(row, 1),
                                                  *(pa.array([x], pa.binary()) for x in packed)],
                                                 names=["block", "n", "sizes", "places", "tfs"])

    return send


def block_lengths(n_docs: int):
    """(postings of a block, the frequencies of its runs) to the lengths of its documents' vectors."""

    def lengths(key, postings, runs):
        sizes, places, tfs = (np.frombuffer(unsqueezed(postings.column(c)[0].as_py()), np.int32) for c in ("sizes", "places", "tfs"))
        runs = runs.sort_by("part")
        df = np.frombuffer(b"".join(unsqueezed(x) for x in runs.column("dfs").to_pylist()), np.int64)
        idf = np.log((1 + n_docs) / (1 + df)) + 1
        raw = (1 + np.log(tfs.astype(float))) * np.repeat(idf, sizes)
        square = np.bincount(places, raw * raw, postings.column("n")[0].as_py())
        return pa.table([pa.array([key[0].as_py()], pa.int64()), list_of(pa.array(np.sqrt(square)))], names=["block", "lengths"])

    return lengths


def shown_best(asked, pool: int, digits: int, depth: int, growth: int):
    """Blocks (ids, lengths, terms, sizes, places, tfs, repeats) to (query, doc, score): all that can be among the ``pool`` best
    documents of a query, ties by doc.

    Each term shows its ``depth`` heaviest postings in the block at first. What the next ones weigh bounds what hidden postings can
    add; a query whose best document could not reach the score that ``pool`` documents of earlier blocks have is finished, the others
    go on with lists ``growth`` times as deep, until these are complete.
    """
    slack = 2 * 10.0 ** -digits

    def search(batches):
        known = asked.value
        n = len(known.ids)
        best, floor = np.zeros((n, pool)), np.zeros(n)
        for batch in batches:
            for row in range(batch.num_rows):
                ids, lengths, terms, sizes, places, tfs = (batch.column(i)[row].values for i in range(6))
                at = pc.fill_null(pc.index_in(terms, value_set=known.terms), -1).to_numpy()
                hit = np.flatnonzero(at >= 0)
                if not len(hit):
                    continue
                lengths, sizes, places, tfs = (x.to_numpy() for x in (lengths, sizes, places, tfs))
                # The asked lists, each with its heaviest postings first.
                own = sizes[hit].astype(np.int64)
                posting = ranges((np.cumsum(sizes, dtype=np.int64) - sizes)[hit], own)
                place, weight = places[posting], weights(tfs[posting], lengths[places[posting]])
                order = np.lexsort((place, -weight, np.repeat(np.arange(len(hit)), own)))
                place, weight, starts = place[order], weight[order], np.cumsum(own) - own
                count = known.ends[at[hit] + 1] - known.ends[at[hit]]
                entry, of = ranges(known.ends[at[hit]], count), np.repeat(np.arange(len(hit)), count)
                query, gain = known.queries[entry], known.gains[entry]
                repeats = batch.column(6)[row].as_py()
                bound = np.bincount(query, gain * weight[starts[of]], minlength=n) * repeats
                able = np.flatnonzero((bound > 0) & (bound >= floor - slack))
                step = max(1, CELLS // len(ids))
                for some in (able[i:i + step] for i in range(0, len(able), step)):
                    number = np.full(n, -1)
                    number[some] = np.arange(len(some))
                    kept = number[query] >= 0
                    asks, adds, lists = number[query[kept]], gain[kept], of[kept]
                    scores = np.zeros(len(some) * len(ids))
                    live, shown, deep = np.ones(len(some), bool), 0, depth
                    while len(asks):
                        size = np.minimum(own[lists], deep) - np.minimum(own[lists], shown)
                        edges = np.searchsorted(np.cumsum(size), np.arange(PAIRS, int(size.sum()), PAIRS))
                        for first, last in zip([0, *edges], [*edges, len(lists)]):
                            if first == last:
                                continue
                            these = ranges(starts[lists[first:last]] + shown, size[first:last])
                            cell = np.repeat(asks[first:last] * len(ids), size[first:last]) + place[these]
                            scores += np.bincount(cell, np.repeat(adds[first:last], size[first:last]) * weight[these], minlength=len(scores))
                        more = own[lists] > deep
                        asks, adds, lists = asks[more], adds[more], lists[more]
                        hidden = np.bincount(asks, adds * weight[starts[lists] + deep], minlength=len(some)) * repeats
                        reach = scores.reshape(len(some), -1).max(axis=1) + hidden
                        live &= (hidden == 0) | (reach >= floor[some] - slack)
                        more = live[asks]
                        asks, adds, lists = asks[more], adds[more], lists[more]
                        shown, deep = deep, deep * growth
                    table = scores.reshape(len(some), len(ids))
                    rounded = np.round(table, digits)
                    most = rounded.max(axis=1)
                    better = np.flatnonzero(live & (most > 0) & (most >= floor[some]))
                    if not len(better):
                        continue
                    first = np.argsort(-rounded[better], axis=1, kind="stable")[:, :pool]  # ids rise with their places
                    top = np.take_along_axis(rounded[better], first, axis=1)
                    of_query = some[better]
                    chosen, column = np.nonzero((top > 0) & (top >= floor[of_query][:, None]))
                    found = first[chosen, column]
                    yield pa.RecordBatch.from_arrays(
                        [known.ids.take(pa.array(of_query[chosen])), ids.take(pa.array(found)), pa.array(table[better[chosen], found])],
                        names=["query", "doc", "score"])
                    best[of_query] = np.sort(np.concatenate([best[of_query], top], axis=1), axis=1)[:, -pool:]
                    floor[of_query] = best[of_query, 0]

    return search
