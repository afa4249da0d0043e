"""MinHash near-deduplication with HyperMinHash registers.

A document is the set of its distinct five-word shingles. Each of its registers belongs to a bucket of the hash space and
stores, of the smallest hash there, the number of leading zeros and the mantissa bits that follow. Bands of registers
propose pairs; the share of equal registers, corrected for chance collisions, drops those that are clearly too far apart;
the rest is confirmed on the full shingle sets.

Copies with equal sets are one node, found by an aggregation. No bucket's pairs are listed: first every member is compared
with the smallest one of its bucket. Of buckets that this leaves in several components, the members are compared with the
one that shares most shingles with the others. Those that are still apart, and whose unshared shingles allow a link at all,
are dealt to cells, where their registers are compared. Members that an estimate leaves a link meet in cells again, with their
whole sets: only links that join what is still apart leave a cell.
"""

import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from deskloom.llm.components import components
from deskloom.llm.words import lower_ascii, slices, text_bytes, window_hashes, word_hashes
from deskloom.session import stored

# Executors need not have this package: its functions travel with the tasks.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


@dataclass(frozen=True)
class NearDup:
    words: int = 5            # in a shingle
    percent: int = 75         # least intersection / union of linked documents
    bucket_bits: int = 8      # 2 ** bucket_bits registers
    mantissa_bits: int = 10
    bands: int = 32
    band_rows: int = 4        # registers in a band
    sigmas: float = 4.0       # deviations by which an estimate may fall short before a pair is dropped
    members_per_task: int = 256  # members that are compared with one centre in a row
    part_shingles: int = 1 << 20  # shingles that meet in one part of the hash space, about
    cell_members: int = 2048  # members of a bucket whose registers a task holds at once, about
    cell_shingles: int = 1 << 21  # and shingles of their sets


def shingles(texts: list[bytes], width: int) -> Iterator[np.ndarray]:
    """For each text its distinct shingle hashes in rising order; a shorter text is one shingle, one without words none."""
    words, lengths = word_hashes([lower_ascii(t) for t in texts])
    windows = window_hashes(words, width)
    start = 0
    for n in lengths.tolist():
        if n >= width:
            yield np.unique(windows[start:start + n - width + 1])
        else:
            yield window_hashes(words[start:start + n], n) ^ np.uint64(n) if n else np.empty(0, np.uint64)
        start += n


def donors(bits: int) -> np.ndarray:
    """For every bucket a fixed order in which empty ones look for a filled one."""
    return np.array([np.random.RandomState(b).permutation(1 << bits) for b in range(1 << bits)])


def registers(shingle: np.ndarray, order: np.ndarray, rules: NearDup) -> tuple[np.ndarray, np.ndarray]:
    """(one register per bucket, which buckets are filled) of rising shingle hashes.

    Empty buckets take the register of the first filled one in their order, so that equal registers stay as likely as
    the Jaccard similarity for short documents, too.
    """
    bucket = (shingle >> np.uint64(64 - rules.bucket_bits)).astype(np.int64)
    first = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1]]))
    rest = (shingle[first] << np.uint64(rules.bucket_bits)) >> np.uint64(11)  # 53 bits: exact as a float
    length = np.frexp(rest.astype(np.float64))[1].astype(np.int64)
    zeros = 53 - length
    normal = rest << zeros.astype(np.uint64)  # the leading one is bit 52
    mantissa = (normal >> np.uint64(52 - rules.mantissa_bits)) & np.uint64((1 << rules.mantissa_bits) - 1)
    out = np.zeros(1 << rules.bucket_bits, np.uint16)
    filled = np.zeros(len(out), bool)
    out[bucket[first]] = (zeros.astype(np.uint64) << np.uint64(rules.mantissa_bits)) | mantissa
    filled[bucket[first]] = True
    if len(first) < len(out):
        empty = np.flatnonzero(~filled)
        choice = order[empty]
        out[empty] = out[choice[np.arange(len(empty)), filled[choice].argmax(axis=1)]]
    return out, filled


def sketches(docs: DataFrame, id_col: str, text_col: str, rules: NearDup) -> DataFrame:
    """(doc_id, n_shingles, digest, filled, sketch): a digest of the whole set, a bit per bucket, the registers."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))

    def sketch(batches):
        order = donors(rules.bucket_bits)
        for part in slices(batches):
            found = []
            for s in shingles(text_bytes(part.column(1)), rules.words):
                digest = xxhash.xxh3_128_digest(s.tobytes())
                values, filled = registers(s, order, rules) if len(s) else (None, None)
                found.append((len(s), digest, *((np.packbits(filled).tobytes(), values.tobytes()) if len(s) else (None, None))))
            columns = [pa.array(list(c), t) for c, t in zip(zip(*found), (pa.int64(), pa.binary(), pa.binary(), pa.binary()))]
            yield pa.RecordBatch.from_arrays([part.column(0), *columns],
                                             names=["doc_id", "n_shingles", "digest", "filled", "sketch"])

    kind = dict(rows.dtypes)["doc_id"]
    return rows.mapInArrow(sketch, f"doc_id {kind}, n_shingles bigint, digest binary, filled binary, sketch binary")


def band_keys(nodes: DataFrame, rules: NearDup) -> DataFrame:
    """(band, key, node) for each band of registers."""
    width = 2 * rules.band_rows
    keys = F.transform(F.sequence(F.lit(0), F.lit(rules.bands - 1)),
                       lambda b: F.xxhash64(b, F.substring("sketch", b * width + 1, F.lit(width))))
    return nodes.select(F.posexplode(keys).alias("band", "key"), "node")


def near_enough(left, right, own, other, n_a, n_b, rules: NearDup) -> np.ndarray:
    """Which pairs of registers (rows of ``left`` and ``right``, with the buckets they fill) leave a link possible.

    The estimate is the share of equal registers among the m buckets that either set fills. Registers of unrelated
    documents are equal by chance with probability 0.17 * 2 ** -mantissa_bits * 4 q / (1 + q) ** 2, q being the ratio of
    the set sizes; the share is corrected for it. Its variance for similarity J and a union of f shingles is
    J (1 - J) ((1 + 1 / (f - 1)) / m - 1 / (f - 1)): next to none if hardly any bucket holds two shingles.
    """
    goal = rules.percent / 100
    filled = (own | other).sum(axis=1)
    chance = 0.169919487 * 2.0 ** -rules.mantissa_bits * 4 * n_a * n_b / (n_a + n_b) ** 2
    share = (((left == right) & own & other).sum(axis=1) / filled - chance) / (1 - chance)
    union = np.maximum((n_a + n_b) / (1 + goal) - 1, 1)
    deviation = np.sqrt(goal * (1 - goal) * np.maximum((1 + 1 / union) / filled - 1 / union, 0))
    return share >= goal - rules.sigmas * deviation - 1 / filled


def matrix(column: pa.Array) -> np.ndarray:
    """Equally long byte strings as rows of bytes."""
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(len(column), -1)


def estimated(pairs: DataFrame, nodes: DataFrame, rules: NearDup) -> DataFrame:
    """The pairs (a, b) that sizes and registers leave possible."""
    side = nodes.select("node", "n_shingles", "filled", "sketch")
    both = (pairs.join(side.toDF("a", "n_a", "filled_a", "sketch_a"), "a")
            .join(side.toDF("b", "n_b", "filled_b", "sketch_b"), "b")
            .filter(F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * rules.percent))

    def near(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            left, right = (matrix(batch.column(i)).view(np.uint16) for i in (4, 5))
            own, other = (np.unpackbits(matrix(batch.column(i)), axis=1).astype(bool) for i in (6, 7))
            n_a, n_b = (batch.column(i).to_numpy().astype(float) for i in (2, 3))
            ok = near_enough(left, right, own, other, n_a, n_b, rules)
            yield batch.select([0, 1]).filter(pa.array(ok))

    kind = dict(pairs.dtypes)["a"]
    return both.select("a", "b", "n_a", "n_b", "sketch_a", "sketch_b", "filled_a", "filled_b").mapInArrow(near, f"a {kind}, b {kind}")


def crossing(members: DataFrame, nodes: DataFrame, rules: NearDup, sets: DataFrame | None = None) -> DataFrame:
    """Bucket members (band, key, node, component, shared, n_shingles) of different components against each other.

    Without ``sets`` the rows (key, node) of members that bounds and registers leave a link with another one. With the ``sets``
    (node, shingles) of such members, links (a, b), a < b, that are confirmed on them and join what is still apart in the cell.

    Members of a bucket live in cells, by a hash, and visit the later cells of their bucket; a cell holds the registers of
    those that live there, and what comes after them passes by. Pairs are never rows: a member is one row at most for each of
    its visits, and a cell has fewer links than members. A pair is looked at in the first band that its registers share.
    """
    cells = members.groupBy("key").agg(F.greatest(
        F.ceil(F.count("*") / F.lit(rules.cell_members)), F.ceil(F.sum("n_shingles") / F.lit(rules.cell_shingles))).cast("int").alias("cells"))
    own = F.pmod(F.xxhash64("node"), F.col("cells")).cast("int")
    placed = (members.join(cells, "key").withColumn("_own", own)
              .withColumn("cell", F.explode(F.sequence(F.col("_own"), F.col("cells") - 1)))
              .withColumn("role", (F.col("cell") > F.col("_own")).cast("int"))
              .join(nodes.select("node", "filled", "sketch"), "node"))
    columns = ["key", "cell", "role", "node", "component", "shared", "n_shingles", "filled", "sketch", "band"]
    if sets is not None:
        placed, columns = placed.join(sets, "node"), [*columns, "shingles"]
    streamed = placed.select(*columns).repartition("key", "cell").sortWithinPartitions("key", "cell", "role")
    exact = sets is not None

    def compare(batches):
        cell, held, sets_held, joined = None, None, [], {}

        def root(c):
            while c in joined:
                c = joined[c]
            return c

        for part in slices(batches, 1 << 20):
            places = np.column_stack([part.column(i).to_numpy() for i in (0, 1)])
            role, band = part.column(2).to_numpy(), part.column(9).to_numpy()
            rows = [*(part.column(i).to_numpy() for i in (3, 4, 5, 6)), np.unpackbits(matrix(part.column(7)), axis=1).astype(bool),
                    matrix(part.column(8)).view(np.uint16)]
            own_sets = [np.frombuffer(s, np.uint64) for s in part.column(10).to_pylist()] if exact else []
            breaks = np.flatnonzero((places[1:] != places[:-1]).any(axis=1)) + 1
            found = set()
            for start, stop in zip([0, *breaks], [*breaks, len(role)]):
                if tuple(places[start]) != cell:
                    cell, held, sets_held, joined = tuple(places[start]), None, [], {}
                lives, before = int((role[start:stop] == 0).sum()), len(held[0]) if held else 0
                if lives:
                    fresh = [c[start:start + lives] for c in rows]
                    held = [np.concatenate(c) for c in zip(held, fresh)] if held else [c.copy() for c in fresh]
                    sets_held += own_sets[start:start + lives]
                for i in range(stop - start if held else 0):
                    seen = before + min(i, lives)  # what lives here, for one of them what came before it
                    node, component, shared, n, fills, values = (c[:seen] for c in held)
                    node_i, component_i, shared_i, n_i, fills_i, values_i = (c[start + i] for c in rows)
                    most = np.minimum(shared, shared_i)
                    able = np.flatnonzero((component != component_i) & (most * 100 >= (n + n_i - most) * rules.percent) & (node != node_i))
                    if len(able):
                        able = able[near_enough(values[able], values_i, fills[able], fills_i, n[able].astype(float), float(n_i), rules)]
                    if len(able):
                        width = rules.bands * rules.band_rows
                        alike = (values[able, :width] == values_i[:width]).reshape(len(able), rules.bands, rules.band_rows).all(axis=2)
                        able = able[~alike.any(axis=1) | (alike.argmax(axis=1) == band[start + i])]
                    if not exact:
                        found.update((cell[0], x) for x in ([*node[able].tolist(), int(node_i)] if len(able) else ()))
                        continue
                    for j in able.tolist():
                        ends = root(int(component[j])), root(int(component_i))
                        if ends[0] == ends[1]:
                            continue
                        common = len(np.intersect1d(sets_held[j], own_sets[start + i], assume_unique=True))
                        if 100 * common >= rules.percent * (n[j] + n_i - common):
                            joined[max(ends)] = min(ends)
                            found.add((min(int(node_i), int(node[j])), max(int(node_i), int(node[j]))))
            if found:
                yield pa.RecordBatch.from_arrays([pa.array([int(x) for x in c], pa.int64()) for c in zip(*found)], names=names)

    names = ["a", "b"] if exact else ["key", "node"]
    return streamed.mapInArrow(compare, ", ".join(f"{c} bigint" for c in names)).distinct()


def shingle_sets(members: DataFrame, docs: DataFrame, id_col: str, text_col: str, rules: NearDup) -> DataFrame:
    """(node, shingles): the whole sets of members (node, digest)."""
    texts = docs.select(F.col(id_col).alias("node"), F.col(text_col).cast("string").alias("text")).filter("text IS NOT NULL")
    rows = members.join(texts, "node").select("node", "digest", "text")

    def cut(batches):
        for part in slices(batches):
            sets = [s.tobytes() for s in shingles(text_bytes(part.column(2)), rules.words)]
            own = [xxhash.xxh3_128_digest(s) == d for s, d in zip(sets, part.column(1).to_pylist())]
            yield pa.RecordBatch.from_arrays([part.column(0).cast(pa.int64()), pa.array(sets, pa.binary())],
                                             names=["node", "shingles"]).filter(pa.array(own, pa.bool_()))

    return rows.mapInArrow(cut, "node bigint, shingles binary").dropDuplicates(["node"])


def confirmed(pairs: DataFrame, nodes: DataFrame, docs: DataFrame, id_col: str, text_col: str, rules: NearDup) -> DataFrame:
    """The pairs (a, b) whose full shingle sets are similar enough.

    All pairs of one ``a`` meet as a stream: its text first, then those of its partners, so a task holds one set and one
    text. A centre with many partners is dealt to several tasks.
    """
    counts = pairs.groupBy("a").agg(F.ceil(F.count("*") / F.lit(rules.members_per_task)).cast("int").alias("salts"))
    dealt = pairs.join(counts, "a").withColumn("salt", F.pmod(F.xxhash64("b"), F.col("salts")).cast("int"))
    centres = counts.select(F.col("a").alias("doc_id"), "a", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"),
                            F.lit(0).alias("role"))
    wanted = centres.union(dealt.select("b", "a", "salt", F.lit(1)))
    digests = nodes.select(F.col("node").alias("doc_id"), "digest")
    texts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text")).filter("text IS NOT NULL")
    rows = wanted.join(digests, "doc_id").join(texts, "doc_id")
    streamed = (rows.select("a", "salt", "role", "doc_id", "digest", "text")
                .repartition(F.col("a"), F.col("salt")).sortWithinPartitions("a", "salt", "role"))

    def compare(batches):
        centre, mine = None, None
        for part in slices(batches):
            found = []
            sets = shingles(text_bytes(part.column(5)), rules.words)
            for a, role, b, digest, s in zip(*(part.column(i).to_pylist() for i in (0, 2, 3, 4)), sets):
                if xxhash.xxh3_128_digest(s.tobytes()) != digest:
                    continue  # another row with the same id
                if role == 0:
                    centre, mine = a, s
                elif centre == a:
                    common = len(np.intersect1d(mine, s, assume_unique=True))
                    if 100 * common >= rules.percent * (len(mine) + len(s) - common):
                        found.append((a, b))
            if found:
                kind = part.column(0).type
                yield pa.RecordBatch.from_arrays([pa.array(list(c), kind) for c in zip(*found)], names=["a", "b"])

    kind = dict(pairs.dtypes)["a"]
    return streamed.mapInArrow(compare, f"a {kind}, b {kind}").distinct()


def own_shingles(members: DataFrame, docs: DataFrame, id_col: str, text_col: str, rules: NearDup) -> DataFrame:
    """(node, own): how many shingles of each member (node, digest, n_shingles; stored) no other member holds.

    Tasks send every shingle they read to its part of the hash space, with its member or, if several hold it, without;
    what arrives there once belongs to one member alone.
    """
    total = members.agg(F.sum("n_shingles")).first()[0] or 0
    parts = -(-total // rules.part_shingles) or 1
    texts = docs.select(F.col(id_col).alias("node"), F.col(text_col).cast("string").alias("text")).filter("text IS NOT NULL")
    rows = members.join(texts, "node").select("node", "digest", "text")

    def single(key, node):
        order = np.argsort(key)
        key, node = key[order], node[order]
        first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.empty(0, int)
        alone = np.diff(np.append(first, len(key))) == 1
        return key[first], node[first], alone

    def send(batches):
        for part in slices(batches):
            sets = list(shingles(text_bytes(part.column(2)), rules.words))
            wanted = [xxhash.xxh3_128_digest(s.tobytes()) == d for s, d in zip(sets, part.column(1).to_pylist())]
            nodes = part.column(0).to_pylist()
            if not any(wanted):
                continue
            key = np.concatenate([s for s, w in zip(sets, wanted) if w])
            node = np.repeat([n for n, w in zip(nodes, wanted) if w], [len(s) for s, w in zip(sets, wanted) if w])
            key, node, alone = single(key, node.astype(np.int64))
            place = (key >> np.uint64(20)) % np.uint64(parts)
            order = np.argsort(place, kind="stable")
            edges = np.searchsorted(place[order], np.arange(parts + 1))
            out = []
            for p in range(parts):
                own = order[edges[p]:edges[p + 1]]
                if len(own):
                    out.append((p, key[own].tobytes(), node[own].tobytes(), alone[own].tobytes()))
            yield pa.RecordBatch.from_arrays([pa.array(list(c), t) for c, t in zip(
                zip(*out), (pa.int32(), pa.binary(), pa.binary(), pa.binary()))], names=["part", "keys", "nodes", "alone"])

    def count(batches):
        found = [(np.frombuffer(k, np.uint64), np.frombuffer(n, np.int64), np.frombuffer(o, bool)) for b in batches
                 for k, n, o in zip(*(b.column(i).to_pylist() for i in (1, 2, 3)))]
        if found:
            key, node, alone = (np.concatenate(c) for c in zip(*found))
            # A shingle that several members of one task hold arrives as if twice.
            _, node, alone = single(np.concatenate([key, key[~alone]]), np.concatenate([node, node[~alone]]))
            node, own = np.unique(node[alone], return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(node, pa.int64()), pa.array(own, pa.int64())], names=["node", "own"])

    sent = rows.mapInArrow(send, "part int, keys binary, nodes binary, alone binary")
    return (sent.repartition("part").mapInArrow(count, "node bigint, own bigint").groupBy("node")
            .agg(F.sum("own").alias("own")))


def within_reach(shared_a: str, n_a: str, shared_b: str, n_b: str, rules: NearDup) -> Column:
    """Whether two sets can be similar enough, given how many of their shingles any other member holds."""
    most = F.least(shared_a, shared_b)
    return most * 100 >= (F.col(n_a) + F.col(n_b) - most) * rules.percent


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    rules: NearDup = NearDup()) -> DataFrame:
    """One row per id: doc_id, n_shingles, component_id (smallest id it can reach by links), kept (it is that id).

    Texts without words (null, empty, blanks) are linked with nothing. Rows that repeat an id count once, with the text
    whose shingle set has the smallest digest. A row without id cannot be linked: it is returned as it is, kept, with a
    null component. An empty table gives no rows; other columns play no part. Ids must be whole numbers.
    """
    sketched = stored(sketches(docs, id_col, text_col, rules), "sketches")
    named = sketched.filter("doc_id IS NOT NULL")
    chosen = stored(named.groupBy("doc_id").agg(F.min(F.struct("digest", "n_shingles")).alias("s"))
                    .select("doc_id", "s.digest", "s.n_shingles"), "documents")
    classes = chosen.filter("n_shingles > 0").groupBy("digest").agg(F.min("doc_id").alias("node"))
    content = named.select(F.col("doc_id").alias("node"), F.col("digest").alias("_d"), "n_shingles", "filled", "sketch")
    nodes = stored(classes.join(content, "node").filter(F.col("digest") == F.col("_d")).drop("_d")
                   .dropDuplicates(["node"]), "nodes")
    keys = band_keys(nodes, rules)

    # Every member of a bucket against the smallest one.
    centres = keys.groupBy("key").agg(F.min("node").alias("a"), F.max("node").alias("_last")).filter("a < _last").drop("_last")
    stars = stored(keys.join(centres, "key").filter("node > a").select("a", F.col("node").alias("b")).distinct(), "stars")
    possible = stored(estimated(stars, nodes, rules), "possible")
    links = stored(confirmed(possible, nodes, docs, id_col, text_col, rules), "confirmed")
    reached = stored(components(links), "components")

    # Buckets whose members are still in different components. What a member shares with none of the others bounds how
    # similar it can be to any: heavily edited copies drop out, and the member that shares most is the best centre.
    def open_members(component):
        placed = keys.join(component, "node", "left").select("band", "key", "node", F.coalesce("component", "node").alias("component"))
        mixed = (placed.groupBy("key").agg(F.min("component").alias("_low"), F.max("component").alias("_high"))
                 .filter("_low < _high").select("key"))
        return placed.join(mixed, "key")

    unsettled = stored(open_members(reached), "unsettled")
    members = stored(unsettled.select("node").distinct().join(nodes.select("node", "digest", "n_shingles"), "node"), "members")
    own = own_shingles(members, docs, id_col, text_col, rules)
    sizes = stored(members.join(own, "node", "left").select(
        "node", "n_shingles", (F.col("n_shingles") - F.coalesce("own", F.lit(0))).alias("shared"))
        .filter(F.col("shared") * 100 >= F.col("n_shingles") * rules.percent), "shared")
    bounded = stored(unsettled.join(sizes, "node"), "bounded")
    best = (bounded.groupBy("key").agg(F.max(F.struct("shared", (-F.col("node")).alias("_n"), "n_shingles", "component")).alias("c"))
            .select("key", (-F.col("c._n")).alias("_a"), F.col("c.shared").alias("_s"), F.col("c.n_shingles").alias("_m"),
                    F.col("c.component").alias("_c")))
    again = (bounded.join(best, "key").filter("node <> _a AND component <> _c")
             .filter(within_reach("shared", "n_shingles", "_s", "_m", rules))
             .select(F.least("node", "_a").alias("a"), F.greatest("node", "_a").alias("b")).distinct()
             .join(stars, ["a", "b"], "left_anti"))
    second = stored(again, "second-stars")
    more = stored(confirmed(stored(estimated(second, nodes, rules), "possible-second"), nodes, docs, id_col, text_col, rules),
                  "confirmed-second")
    links = links.union(more)
    reached = stored(components(links), "components-second")

    # The rest: members of different components against each other, as far as their bounds allow.
    rest = bounded.drop("component").join(reached, "node", "left").withColumn("component", F.coalesce("component", "node"))
    open_ = rest.groupBy("key").agg(F.min("component").alias("_low"), F.max("component").alias("_high")).filter("_low < _high")
    rest = stored(rest.join(open_.select("key"), "key", "left_semi"), "rest")
    able = stored(crossing(rest, nodes, rules), "possible-rest")
    sets = stored(shingle_sets(nodes.select("node", "digest").join(able.select("node").distinct(), "node"), docs, id_col, text_col, rules),
                  "sets")
    late = stored(crossing(rest.join(able, ["key", "node"], "left_semi"), nodes, rules, sets), "confirmed-rest")
    final = reached if late.isEmpty() else stored(components(links.union(late)), "components-all")

    ends = nodes.select("digest", "node").join(final, "node", "left").select(
        "digest", F.coalesce("component", "node").alias("component"))
    found = chosen.join(ends, "digest", "left").select(
        "doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))
    nameless = sketched.filter("doc_id IS NULL").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"))
    return found.union(nameless).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))
