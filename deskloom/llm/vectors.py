"""Near-duplicate vectors by a subspace pigeonhole join.

Unit vectors of cosine >= c lie within the squared distance 2 - 2 c. An orthonormal rotation keeps distances, and cut into
blocks of a few dimensions, the squared distance is the sum over blocks; so in at least one block it is within that
block's share of the budget. The rotation (principal axes of a sample) and the dealing of axes to blocks give each block
its part of the variance, and the budget is shared in that proportion. Any rotation, blocks and shares give the same links.

Range join in a block: a tree of median cuts over the sample divides the block's space into boxes. A vector lives in its
box and also visits each later box that its range touches, so two vectors within the range meet exactly once. A box with
more vectors than a task should take is dealt to several cells; a vector then visits all cells of a box, and the later
ones of its own. Within a cell numpy finds the pairs within the range and verifies them on the whole vectors. A pair within
range in several blocks counts in the one where it takes the least part of the budget. No pair leaves a task: what
is handed on are, per vector, its number of links and one link to the group it was found in.
"""

import math
import sys
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from deskloom.llm.components import components
from deskloom.session import stored

# Executors need not have this package: its functions travel with the tasks.
cloudpickle.register_pickle_by_value(sys.modules[__name__])


@dataclass(frozen=True)
class Subspaces:
    cosine: float = 0.9
    block_dims: int = 16
    sample: int = 4096        # vectors at most, by a hash of the id, that fit the rotation and the cuts
    box_vectors: int = 4096   # vectors that a box should hold
    cell_vectors: int = 8192  # vectors that live in a cell at most, about
    strip_vectors: int = 65536  # vectors that visit a cell in one task, about
    rotated_dims: int = 1024  # longer vectors are cut into blocks as they are


def usable(values: np.ndarray) -> np.ndarray:
    """Rows as unit vectors in double precision; all zero where a row is zero or not finite."""
    with np.errstate(all="ignore"):
        top = np.abs(values).max(axis=1, initial=0.0)
        good = np.isfinite(top) & (top > 0)
        scaled = np.where(good[:, None], values, 0.0) / np.where(good, top, 1.0)[:, None]
        length = np.sqrt(np.einsum("ij,ij->i", scaled, scaled))
    return scaled / np.where(good, length, 1.0)[:, None]


def fit(sample: np.ndarray, dims: int, boxes: int, rules: Subspaces) -> dict:
    """The rotation, the blocks, their budgets and the cuts of each block's tree as plain arrays."""
    blocks = max(1, round(dims / rules.block_dims))
    axes, variance = np.eye(dims), np.full(dims, 1.0)
    if len(sample) > 1:
        if dims <= rules.rotated_dims:
            variance, axes = np.linalg.eigh(np.cov(sample.T).reshape(dims, dims))
            variance, axes = variance[::-1], axes[:, ::-1]
        else:
            variance = sample.var(axis=0)
    order = np.argsort(-variance, kind="stable")
    turn = np.arange(dims) % (2 * blocks)  # to and fro, so that blocks get equal parts
    owner = np.where(turn < blocks, turn, 2 * blocks - 1 - turn)
    members = [order[owner == b] for b in range(blocks)]
    weight = np.array([variance[m].sum() + 1e-3 * variance.sum() * len(m) / dims + 1e-12 * len(m) for m in members])
    budget = (2 - 2 * rules.cosine) * weight / weight.sum()
    edges = np.cumsum([0] + [len(m) for m in members])
    rotation = np.ascontiguousarray(axes[:, np.concatenate(members)])
    turned = sample @ rotation if len(sample) else np.empty((0, dims))
    trees = [cuts(turned[:, edges[b]:edges[b + 1]], boxes) for b in range(blocks)]
    return {"rotation": rotation, "edges": edges, "budget": budget, "trees": trees}


def cuts(points: np.ndarray, boxes: int) -> list[tuple]:
    """A tree of median cuts: (axis, place, left, right) for a node, (-1, number, 0, 0) for a box; the widest axis is cut."""
    tree: list[tuple] = []
    numbers = iter(range(1 << 30))

    def grow(own: np.ndarray, wanted: int) -> int:
        at = len(tree)
        tree.append((-1, 0, 0, 0))
        axis = int(own.var(axis=0).argmax()) if len(own) else 0
        place = float(np.median(own[:, axis])) if len(own) else 0.0
        below = own[:, axis] < place if len(own) else np.empty(0, bool)
        if wanted < 2 or len(own) < 8 or not below.any():
            tree[at] = (-1, next(numbers), 0, 0)
            return at
        left = grow(own[below], wanted // 2)
        tree[at] = (axis, place, left, grow(own[~below], wanted - wanted // 2))
        return at

    grow(points, boxes)
    return tree


def places(points: np.ndarray, tree: list[tuple], budget: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(box of each point; then for every visit its point and box): the later boxes within the budget's distance."""
    home = np.zeros(len(points), np.int64)
    who, where = [], []

    def descend(at: int, rows: np.ndarray, inside: np.ndarray, excess: np.ndarray) -> None:
        """``excess``: per row and axis how far the point lies outside the node's box."""
        axis, place, left, right = tree[at]
        if axis < 0:
            home[rows[inside]] = place
            who.append(rows[~inside])
            where.append(np.full(int((~inside).sum()), place, np.int64))
            return
        distance = points[rows, axis] - place
        for child, below in ((left, True), (right, False)):
            beyond = np.maximum(distance, 0) if below else np.maximum(-distance, 0)
            wider = excess.copy()
            wider[:, axis] = np.maximum(excess[:, axis], beyond)
            stays = inside & ((distance < 0) if below else (distance >= 0))
            near = stays | (np.einsum("ij,ij->i", wider, wider) <= budget * (1 + 1e-9) + 1e-12)
            descend(child, rows[near], stays[near], wider[near])

    descend(0, np.arange(len(points)), np.ones(len(points), bool), np.zeros_like(points))
    who, where = np.concatenate(who), np.concatenate(where)
    later = where > home[who]
    return home, who[later], where[later]


class Cell:
    """The vectors that live in a cell, which meet each other and then visitors, batch by batch."""

    def __init__(self, ids: np.ndarray, weights: np.ndarray, vectors: np.ndarray, block: int, model: dict, rules: Subspaces):
        self.ids, self.weights, self.vectors, self.block, self.model, self.rules = ids, weights, vectors, block, model, rules
        self.turned = vectors @ model["rotation"]
        # One product gives all squared distances: (-2 x, |x|^2, 1) . (y, 1, |y|^2); in single precision, with room for its error.
        own = self.turned[:, self._axes()]
        self.right = np.column_stack([own, np.ones(len(own)), np.einsum("ij,ij->i", own, own)]).astype(np.float32).T.copy()
        self.links, self.root = np.zeros(len(ids), np.int64), np.arange(len(ids))

    def _axes(self) -> slice:
        return slice(*self.model["edges"][self.block:self.block + 2])

    def among(self) -> None:
        """All pairs of those that live here."""
        for a, b in self._pairs(self.vectors, self.turned, True):
            np.add.at(self.links, a, self.weights[b])
            np.add.at(self.links, b, self.weights[a])
            self.root = joined(self.root, a, b)

    def visit(self, weights: np.ndarray, vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(links, id of the group's root) of each visitor; the root is only right where there are links."""
        links, count = np.zeros(len(vectors), np.int64), len(self.ids)
        root = np.concatenate([self.root, np.arange(count, count + len(vectors))])
        for a, b in self._pairs(vectors, vectors @ self.model["rotation"], False):
            np.add.at(links, a, self.weights[b])
            np.add.at(self.links, b, weights[a])
            root = joined(root, a + count, b)
        self.root = root[:count]
        return links, self.ids[np.minimum(root[count:], count - 1)]

    def _pairs(self, vectors, turned, inner: bool, rows: int = 512, pairs: int = 1 << 15):
        """Linked pairs (position in ``vectors``, position here) that belong to this block; inner ones once."""
        own, (edges, budget), count = turned[:, self._axes()], (self.model["edges"], self.model["budget"]), len(self.ids)
        left = np.column_stack([-2 * own, np.einsum("ij,ij->i", own, own), np.ones(len(own))]).astype(np.float32)
        for start in range(0, len(vectors), rows):
            near = np.flatnonzero((left[start:start + rows] @ self.right) <= np.float32(budget[self.block] + 1e-5))
            for piece in range(0, len(near), pairs):
                a, b = np.divmod(near[piece:piece + pairs], count)
                a += start
                if inner:
                    a, b = a[a > b], b[a > b]
                fits = np.einsum("ij,ij->i", vectors[a], self.vectors[b]) >= self.rules.cosine
                a, b = a[fits], b[fits]
                apart = turned[a] - self.turned[b]
                share = np.maximum(np.add.reduceat(apart * apart, edges[:-1], axis=1) / budget, 1e-12)
                here = share.argmin(axis=1) == self.block
                if here.any():
                    yield a[here], b[here]


def joined(root: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Roots after the pairs (a, b) have joined their groups; roots are positions, the lowest of a group."""
    while len(a):
        low = np.minimum(root[a], root[b])
        apart = root[a] != root[b]
        if not apart.any():
            break
        a, b, low = a[apart], b[apart], low[apart]
        for side in (a, b):
            np.minimum.at(root, root[side].copy(), low)
        while True:  # chains of roots to their ends
            higher = root[root]
            if np.array_equal(higher, root):
                break
            root = higher
    return root


def near_vectors(table: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
                 rules: Subspaces = Subspaces()) -> DataFrame:
    """One row per id: vec_id, n_links (other vectors with cosine >= rules.cosine), component_id (smallest id it can reach,
    itself included), kept (it is that id).

    Vectors that are null, empty, zero or hold a null or non-finite component are linked with nothing, nor are vectors of
    different lengths with each other. Equal vectors are one node with a weight. Rows that repeat an id count once, with the
    smallest vector; a row without id cannot be linked and is returned, kept, with a null component. An empty table gives
    no rows; other columns play no part. Ids must be whole numbers.
    """
    spark = table.sparkSession
    rows = table.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).alias("v"))
    chosen = rows.filter("vec_id IS NOT NULL").groupBy("vec_id").agg(F.min("v").alias("v"))
    finite = F.forall("v", lambda x: x.isNotNull() & (F.abs(x) < float("inf")) & ~F.isnan(x)) & F.exists("v", lambda x: x != 0)
    linkable = stored(chosen.filter(F.coalesce(finite, F.lit(False))), "vectors")
    nodes = stored(linkable.groupBy("v").agg(F.min("vec_id").alias("node"), F.count("*").alias("weight")), "nodes")
    links = []
    for dims, in nodes.select(F.size("v").alias("d")).groupBy("d").agg(F.sum(F.lit(1)).alias("n")).filter("n > 1").select("d").collect():
        links.append(block_links(nodes.filter(F.size("v") == dims), dims, rules))
    none = spark.createDataFrame([], "node bigint, links bigint, root bigint")
    for more in links:
        none = none.union(more)
    found = stored(none, "links")
    reached = components(found.select("node", "root"), "node", "root")
    # A cell's root is its first vector, not always a smaller id: components takes links of any direction.
    totals = found.groupBy("node").agg(F.sum("links").alias("links")).join(reached, "node", "full")
    state = (nodes.join(totals, "node", "left")
             .select("v", (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"),
                     F.coalesce("component", "node").alias("component_id")))
    own = linkable.join(state, "v").select("vec_id", "n_links", "component_id")
    rest = (rows.select("vec_id").distinct().filter("vec_id IS NOT NULL").join(linkable.select("vec_id"), "vec_id", "left_anti")
            .select("vec_id", F.lit(0).cast("long"), F.col("vec_id")))
    nameless = rows.filter("vec_id IS NULL").select("vec_id", F.lit(0).cast("long"), "vec_id")
    return own.union(rest).union(nameless).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))


def block_links(nodes: DataFrame, dims: int, rules: Subspaces) -> DataFrame:
    """(node, links, root): per vector and cell its links, weighed, and one vector of the group they belong to."""
    spark = nodes.sparkSession
    count = nodes.count()
    boxes = max(1, min(math.ceil(count / rules.box_vectors), rules.sample // 8))
    drawn = nodes.select("node", "v").orderBy(F.xxhash64("node"), "node").limit(rules.sample).select("v").collect()
    model = fit(usable(np.array([r.v for r in drawn], float)), dims, boxes, rules)
    shared = spark.sparkContext.broadcast(model)  # dims * dims numbers and the cuts

    def read(column: pa.Array) -> np.ndarray:
        return column.flatten().to_numpy(zero_copy_only=False).astype(float).reshape(len(column), dims)

    def place(batches):
        model = shared.value
        for batch in batches:
            for start in range(0, batch.num_rows, 1024):
                part = batch.slice(start, 1024)
                turned = usable(read(part.column(1))) @ model["rotation"]
                for b, tree in enumerate(model["trees"]):
                    edges = model["edges"]
                    home, who, where = places(turned[:, edges[b]:edges[b + 1]], tree, model["budget"][b])
                    every = np.concatenate([np.arange(len(home)), who])
                    boxed = np.concatenate([home, where])
                    lives = np.arange(len(every)) < len(home)
                    yield pa.RecordBatch.from_arrays(
                        [part.column(0).take(pa.array(every)), pa.array(np.full(len(every), b, np.int32)),
                         pa.array(boxed.astype(np.int32)), pa.array(lives)], names=["node", "block", "box", "lives"])

    placed = stored(nodes.select("node", "v").mapInArrow(place, "node bigint, block int, box int, lives boolean"), "places")
    # A box with more vectors than a cell should hold is dealt to cells, and what visits a cell to strips of it.
    held = placed.groupBy("block", "box").agg(F.count_if("lives").alias("n"), F.count_if(~F.col("lives")).alias("visits")).filter("n > 0")
    held = held.select("block", "box", F.ceil(F.col("n") / rules.cell_vectors).cast("int").alias("cells"),
                       F.greatest(F.lit(1), F.ceil((F.col("visits") + F.col("n")) / rules.strip_vectors)).cast("int").alias("strips"))
    dealt = (placed.join(F.broadcast(held), ["block", "box"])  # blocks * boxes rows at most; visits to empty boxes end here
             .withColumn("own", F.when(F.col("lives"), F.pmod(F.xxhash64("node"), F.col("cells")).cast("int")))
             .withColumn("strip", F.pmod(F.xxhash64("node", F.lit(1)), F.col("strips")).cast("int")))
    last = lambda n: F.col(n) - 1
    lives = (dealt.filter("lives").select("node", "block", "box", F.col("own").alias("cell"),
                                          F.explode(F.sequence(F.lit(0), last("strips"))).alias("strip"), F.lit(0).alias("role")))
    first = F.coalesce(F.col("own") + 1, F.lit(0))
    calls = (dealt.filter(first < F.col("cells"))
             .select("node", "block", "box", F.explode(F.sequence(first, last("cells"))).alias("cell"), "strip", F.lit(1).alias("role")))
    place_of = ["block", "box", "cell", "strip"]
    streamed = (lives.union(calls).join(nodes.select("node", "weight", "v"), "node")
                .select(*place_of, "role", "node", "weight", "v").repartition(*place_of).sortWithinPartitions(*place_of, "role"))

    def link(batches):
        model, key, living, cell = shared.value, None, [], None

        def opened():
            made = Cell(*(np.concatenate(c) for c in zip(*living)), key[0], model, rules)
            if key[3] == 0:
                made.among()
            return made

        def closed(cell):
            found = np.flatnonzero(cell.links)
            return rows_of(cell.ids[found], cell.links[found], cell.ids[cell.root[found]])

        for batch in batches:
            keys = np.column_stack([batch.column(i).to_numpy() for i in range(5)])
            breaks = np.flatnonzero((keys[1:] != keys[:-1]).any(axis=1)) + 1
            for start, stop in zip([0, *breaks], [*breaks, batch.num_rows]):
                if start == stop:
                    continue
                if tuple(keys[start, :4]) != key:
                    if living:
                        yield closed(cell or opened())
                    key, living, cell = tuple(keys[start, :4]), [], None
                part = batch.slice(start, stop - start)
                ids, weights = part.column(5).to_numpy(), part.column(6).to_numpy()
                vectors = usable(read(part.column(7)))
                if keys[start, 4] == 0:
                    living.append((ids, weights, vectors))
                else:
                    cell = cell or opened()
                    links, roots = cell.visit(weights, vectors)
                    found = np.flatnonzero(links)
                    yield rows_of(ids[found], links[found], roots[found])
        if living:
            yield closed(cell or opened())

    def rows_of(*columns):
        return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names=["node", "links", "root"])

    return streamed.mapInArrow(link, "node bigint, links bigint, root bigint")
