"""Exact near-duplicate vectors by dual traversal of cover trees.

Vectors are compared within their label. On the unit sphere a cosine of at least t is a distance
of at most sqrt(2 - 2 t), and distances obey the triangle inequality: two nodes whose centres are
farther apart than that plus both covering radii hold no pair, and two nodes whose centres are nearer
than that less both radii hold nothing but pairs.

1. Equal vectors of a label become one, with a count, so groups of copies are compared once.
2. Every label is cut into tiles of about ``TILE_FLOATS`` numbers: vectors go to their nearest pivot,
   one a tile expected, and large cells are cut by a hash. Pivots are picked from the label at random,
   at most ``PIVOTS_PER_LABEL`` for one label and ``PIVOT_FLOATS`` numbers in all; which ones changes
   the work, never the result.
3. A tile's tree is grown once: nested levels with radii that halve. The tree goes to the tasks of
   all tiles it may have pairs with, by the distance of their pivots and the radii of their cells.
4. A task walks two trees at once, level by level. Pairs of children are first held against a bound
   from ``HEAD`` rotated coordinates and the length of the rest, many in one matrix product; what is
   left by the distance of the centres. Pairs of single vectors are decided by cosine in double
   precision. Out come the number of links of each vector and only the links that join two parts.

Unlike vectors in many dimensions lie about equally far apart, which no tree can prune; for these the
bound is computed for all pairs of a label, so that part of the work grows with the square of a label.

Rows: vectors that are null, empty, zero or hold null or non-finite parts, and rows with a null
label, link with nothing; so do vectors of different lengths with one another. Rows that repeat
an id are separate vectors for n_links, and one node for the component. Rows with a null id have
no component, and are kept. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import math
import pickle
from collections import Counter
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import map_batches, stored
from tidemark.llm.components import connected_components

TILE_FLOATS = 1 << 18
"""Numbers in the vectors of a tile: 4,096 vectors of 64 numbers."""
LEAST_SIZE = 16
"""Shorter vectors count as so long when tiles are measured."""
PIVOT_FLOATS = 1 << 22
PIVOTS_PER_LABEL = 256
FINEST = 2.0**-6
SLACK = 1e-9
HEAD = 16
TOGETHER = 128
PAIRS = 1 << 19
"""Pairs of nodes that are looked at in one go."""


@cache
def _head(size: int) -> np.ndarray:
    """Orthonormal directions, the same in every run."""
    drawn = np.random.Generator(np.random.PCG64(5)).normal(size=(size, min(HEAD, size)))
    return np.linalg.qr(drawn)[0]


class CoverTree:
    """Levels of nodes over unit vectors, which are put in an order in which nodes are runs.

    Level k has covering radius 2 / 2**k at most; ``radius`` is what its points really need. The
    first child of a node has the same centre, the first point of its run, so each level contains the
    centres above it. On the last level every point is a node.
    """

    def __init__(self, points: np.ndarray):
        n = len(points)
        self.order, starts, reach = np.arange(n), np.array([0, n]), 2.0
        self.starts: list[np.ndarray] = []
        self.radius: list[np.ndarray] = []
        while True:
            radius = self._radii(points[self.order], starts)
            self.starts.append(starts)
            self.radius.append(radius)
            if reach <= FINEST or radius.max() <= FINEST:
                break
            reach /= 2
            starts = self._finer(points, starts, radius, reach)
        # The runs of coarser levels are the same, as their nodes only had their points rearranged.
        self.starts.append(np.arange(n + 1))
        self.radius.append(np.zeros(n))
        self.points = points[self.order]
        self.first = [np.searchsorted(b, a) for a, b in zip(self.starts, self.starts[1:], strict=False)]

    @staticmethod
    def _radii(points: np.ndarray, starts: np.ndarray) -> np.ndarray:
        centres = np.repeat(points[starts[:-1]], np.diff(starts), axis=0)
        apart = np.sqrt(((points - centres) ** 2).sum(axis=1))
        return np.maximum.reduceat(apart, starts[:-1])

    def _finer(self, points, starts, radius, reach) -> np.ndarray:
        """Splits the nodes that are wider than ``reach``; returns where the new ones start."""
        edges = [starts]
        for node in np.flatnonzero(radius > reach):
            a, b = starts[node], starts[node + 1]
            groups = self._split(points, self.order[a:b], reach)
            self.order[a:b] = np.concatenate(groups)
            edges.append(a + np.cumsum([len(g) for g in groups])[:-1])
        return np.unique(np.concatenate(edges))

    @staticmethod
    def _split(points: np.ndarray, rows: np.ndarray, reach: float) -> list[np.ndarray]:
        """Groups of rows within ``reach`` of the first of the group; centres are farther apart."""
        least, out = 1 - reach * reach / 2, []
        while len(rows):
            head = points[rows[:TOGETHER]]
            dots = head @ head.T
            covered, chosen = np.zeros(len(head), bool), []
            for k in range(len(head)):
                if not covered[k]:
                    chosen.append(k)
                    covered |= dots[k] >= least
            near = points[rows] @ head[chosen].T >= least
            near[chosen, np.arange(len(chosen))] = True
            group = near.argmax(axis=1)
            hit = near[np.arange(len(rows)), group]
            order = np.argsort(group[hit], kind="stable")
            sizes = np.bincount(group[hit], minlength=len(chosen))
            out += np.split(rows[hit][order], np.cumsum(sizes)[:-1])
            rows = rows[~hit]
        return out

    def bounds(self, reach: float) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """Per level, rows x and y for its nodes: two nodes of two trees can only hold a pair if
        the product of the x of one and the y of the other is not negative.

        With h the first rotated coordinates and r the length of the rest, h.h' + r r' is no less
        than the cosine of the centres, which has to be at least 1 - (reach + radii)^2 / 2.
        """
        head = self.points @ _head(self.points.shape[1])
        rest = np.sqrt(np.maximum(0.0, 1 - (head * head).sum(axis=1)))
        sketch = np.column_stack((head, rest))
        left, right = [], []
        for starts, radius in zip(self.starts, self.radius, strict=True):
            own, wide = sketch[starts[:-1]], radius + reach + SLACK
            one = np.ones(len(own))
            left.append(np.column_stack((own, wide * wide / 2, wide, one)))
            right.append(np.column_stack((own, one, radius, radius * radius / 2 - 1)))
        return left, right

    def children(self, level: int, nodes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First child and number of children of nodes; on the last level nodes are their own."""
        if level >= len(self.first):
            return nodes, np.ones(len(nodes), np.int64)
        first = self.first[level]
        return first[nodes], first[nodes + 1] - first[nodes]

    def centres(self, level: int, nodes: np.ndarray) -> np.ndarray:
        level = min(level, len(self.starts) - 1)
        return self.points[self.starts[level][nodes]]


def _crossed(first_a, n_a, first_b, n_b) -> tuple[np.ndarray, np.ndarray]:
    """All pairs of a child of the one and a child of the other, for each pair of nodes."""
    many = n_a * n_b
    nth = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
    wide = np.repeat(n_b, many)
    return np.repeat(first_a, many) + nth // wide, np.repeat(first_b, many) + nth % wide


def dual_traversal(one: CoverTree, two: CoverTree, reach: float, count: Counter | None = None):
    """Yields (all, level, nodes of ``one``, nodes of ``two``).

    With ``all`` every point of the first node is within ``reach`` of every point of the second. Else
    the level is the last and the points may be within reach. Nothing else is. For ``two is one``
    every unordered pair of nodes is met once, a node with itself included.
    """
    same, count = two is one, Counter() if count is None else count
    depth = max(len(one.starts), len(two.starts)) - 1
    left, right = one.bounds(reach)[0], two.bounds(reach)[1]

    def at(of: list, level: int):
        return of[min(level, len(of) - 1)]

    def survivors(level: int, i: np.ndarray, j: np.ndarray):
        """Pairs of children, one level further down, that the bound lets through."""
        x, y = at(left, level + 1), at(right, level + 1)
        (fi, ni), (fj, nj) = one.children(level, i), two.children(level, j)
        many = ni * nj
        for k in np.flatnonzero(many > 4096):
            step = max(1, PAIRS // int(nj[k]))
            for a in range(int(fi[k]), int(fi[k] + ni[k]), step):
                b = min(a + step, int(fi[k] + ni[k]))
                # Of a node's children with themselves, pairs in one order are enough.
                low = a if same and i[k] == j[k] else int(fj[k])
                high = int(fj[k] + nj[k])
                count["bounds"] += (b - a) * (high - low)
                rows, columns = np.nonzero(x[a:b] @ y[low:high].T >= -SLACK)
                yield rows + a, columns + low
        few = np.flatnonzero(many <= 4096)
        total = np.cumsum(many[few])
        cuts = np.searchsorted(total, np.arange(PAIRS, total[-1] if len(total) else 0, PAIRS))
        for part in np.split(few, np.unique(cuts)):
            if len(part):
                a, b = _crossed(fi[part], ni[part], fj[part], nj[part])
                count["bounds"] += len(a)
                close = np.einsum("ij,ij->i", x[a], y[b]) >= -SLACK
                yield a[close], b[close]

    def walk(level: int, i: np.ndarray, j: np.ndarray):
        for a, b in survivors(level, i, j):
            if same:
                a, b = a[a <= b], b[a <= b]
            below = level + 1
            for k in range(0, len(a), PAIRS // 8):
                p, q = a[k : k + PAIRS // 8], b[k : k + PAIRS // 8]
                count["products"] += len(p)
                apart = np.sqrt(((one.centres(below, p) - two.centres(below, q)) ** 2).sum(axis=1))
                radii = at(one.radius, below)[p] + at(two.radius, below)[q]
                sure = apart + radii <= reach - SLACK
                maybe = ~sure & (apart - radii <= reach + SLACK)
                if sure.any():
                    yield True, below, p[sure], q[sure]
                if not maybe.any():
                    continue
                if below == depth:
                    yield False, below, p[maybe], q[maybe]
                else:
                    yield from walk(below, p[maybe], q[maybe])

    if len(one.points) and len(two.points):
        root = np.zeros(1, np.int64)
        yield from walk(0, root, root)


class Tile:
    """Vectors with their ids and counts of copies, in the order of their tree."""

    def __init__(self, ids: np.ndarray, copies: np.ndarray, vectors: np.ndarray):
        norms = np.sqrt((vectors * vectors).sum(axis=1))
        self.tree = CoverTree(vectors / norms[:, None])
        order = self.tree.order
        self.ids, self.copies, self.vectors, self.norms = (
            x[order] for x in (ids, copies, vectors, norms)
        )

    def __getstate__(self):
        tree = self.tree
        return self.ids, self.copies, self.vectors, self.norms, tree.starts, tree.radius, tree.first

    def __setstate__(self, state):
        self.ids, self.copies, self.vectors, self.norms, starts, radius, first = state
        tree = self.tree = CoverTree.__new__(CoverTree)
        tree.starts, tree.radius, tree.first = starts, radius, first
        tree.points = self.vectors / self.norms[:, None]


class _Parts:
    """Which of ``n`` points are joined; keeps the links that joined two parts."""

    def __init__(self, n: int):
        self.part = np.arange(n)
        self.links: list[tuple[int, int]] = []

    def join(self, a: np.ndarray, b: np.ndarray):
        one, two = self.part[a], self.part[b]
        differ = np.flatnonzero(one != two)
        if not len(differ):
            return
        low, high = np.minimum(one, two)[differ], np.maximum(one, two)[differ]
        pairs, at = np.unique(low * len(self.part) + high, return_index=True)
        up: dict[int, int] = {}

        def top(x: int) -> int:
            while x in up:
                x = up[x]
            return x

        for pair, k in zip(pairs.tolist(), differ[at].tolist(), strict=True):
            x, y = top(pair // len(self.part)), top(pair % len(self.part))
            if x != y:
                up[max(x, y)] = min(x, y)
                self.links.append((int(a[k]), int(b[k])))
        table = np.arange(len(self.part))
        for x in up:
            table[x] = top(x)
        self.part = table[self.part]


def compare(one: Tile, two: Tile, cosine: float, count: Counter | None = None):
    """Links that join two parts, and (ids, numbers of links) of the vectors that have some."""
    same = two is one
    shift = 0 if same else len(one.ids)
    parts = _Parts(shift + len(two.ids))
    counts = np.zeros(shift + len(two.ids), np.int64)
    steps = np.zeros(len(counts) + 1, np.int64)  # its running sum is added to all counts
    sums = [np.concatenate(([0], np.cumsum(t.copies))) for t in (one, two)]
    reach = math.sqrt(max(0.0, 2 - 2 * cosine))
    for sure, level, a, b in dual_traversal(one.tree, two.tree, reach, count):
        if not sure:
            a, b = (a[a != b], b[a != b]) if same else (a, b)
            dots = np.einsum("ij,ij->i", one.vectors[a], two.vectors[b])
            hit = dots / (one.norms[a] * two.norms[b]) >= cosine
            a, b = a[hit], b[hit]
            np.add.at(counts, a, two.copies[b])
            np.add.at(counts, b + shift, one.copies[a])
            parts.join(a, b + shift)
            continue
        start_a, start_b = (t.tree.starts[min(level, len(t.tree.starts) - 1)] for t in (one, two))
        (a0, a1), (b0, b1) = (start_a[a], start_a[a + 1]), (start_b[b], start_b[b + 1])
        own = same & (a == b)
        np.add.at(steps, a0, sums[1][b1] - sums[1][b0])
        np.add.at(steps, a1, sums[1][b0] - sums[1][b1])
        apart = ~own
        np.add.at(steps, b0[apart] + shift, (sums[0][a1] - sums[0][a0])[apart])
        np.add.at(steps, b1[apart] + shift, (sums[0][a0] - sums[0][a1])[apart])
        # A vector is no partner of its own.
        inside, _ = _crossed(a0[own], (a1 - a0)[own], a0[own], np.ones(own.sum(), np.int64))
        np.add.at(counts, inside, -one.copies[inside])
        for x, y in ((a0, a1 - a0), (b0 + shift, b1 - b0)):
            left, right = _crossed(x, y, (b0 + shift) if x is a0 else a0, np.ones(len(a), np.int64))
            parts.join(left, right)
    counts += np.cumsum(steps)[:-1]
    ids = one.ids if same else np.concatenate((one.ids, two.ids))
    some = np.flatnonzero(counts)
    return [(int(ids[a]), int(ids[b])) for a, b in parts.links], (ids[some], counts[some])


# --- tasks -------------------------------------------------------------------------------------


def _runs(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[tuple[tuple, pa.Table]]:
    """Rows sorted by ``keys``, one table for each."""
    key, parts = None, []
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = np.column_stack([batch.column(k).to_numpy() for k in keys])
        edges = np.flatnonzero((columns[1:] != columns[:-1]).any(axis=1)) + 1
        for a, b in zip([0, *edges], [*edges, batch.num_rows], strict=True):
            now = tuple(int(x) for x in columns[a])
            if now != key and parts:
                yield key, pa.Table.from_batches(parts)
                parts = []
            key = now
            parts.append(batch.slice(a, b - a))
    if parts:
        yield key, pa.Table.from_batches(parts)


KIND = ["label", "size"]
TILE_KEYS = [*KIND, "cell", "block"]
TASK_KEYS = [*KIND, "low", "high"]


def _tiles(cells, cosine: float):
    """Rows of tiles to a tree each, once for every task it has a part in."""
    reach = math.sqrt(max(0.0, 2 - 2 * cosine))
    names = [*TASK_KEYS, "side", "tile"]

    def partners(key, blocks):
        label, size, cell, block = key
        if (label, size) not in cells.value:
            return [(cell, b) for b in range(blocks)]
        points, radius, n_blocks = cells.value[label, size]
        apart = np.sqrt(np.maximum(0.0, 2 - 2 * points @ points[cell]))
        close = apart <= reach + SLACK + radius + radius[cell]
        close[cell] = True
        return [(int(c), b) for c in np.flatnonzero(close) for b in range(n_blocks[c])]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for key, rows in _runs(batches, TILE_KEYS):
            vectors = rows.column("embedding").combine_chunks().flatten().to_numpy(zero_copy_only=False)
            tile = Tile(
                rows.column("member").to_numpy(),
                rows.column("copies").to_numpy(),
                vectors.astype(np.float64).reshape(rows.num_rows, key[1]),
            )
            packed = pickle.dumps(tile, protocol=5)
            own = key[2:]
            for other in partners(key, rows.column("blocks")[0].as_py()):
                low, high = (c << 32 | b for c, b in sorted((own, other)))
                row = [key[0], key[1], low, high, int(own > other), packed]
                kinds = [pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.binary()]
                columns = [pa.array([v], k) for v, k in zip(row, kinds, strict=True)]
                yield pa.record_batch(columns, names=names)

    return work


def _work(cosine: float):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in _runs(batches, TASK_KEYS):
            tiles = [pickle.loads(t.as_buffer()) for t in rows.column("tile")]
            links, (ids, counts) = compare(tiles[0], tiles[-1], cosine)
            n = len(links)
            a = np.concatenate((np.array([x for x, _ in links], np.int64), ids))
            b = pa.array([y for _, y in links] + [None] * len(ids), pa.int64())
            many = pa.array([None] * n + counts.tolist(), pa.int64())
            yield pa.record_batch([pa.array(a), b, many], names=["a", "b", "links"])

    return work


def _usable(embedding: Column) -> Column:
    finite = F.forall(
        embedding, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf")))
    )
    return F.coalesce(finite & F.exists(embedding, lambda x: x != 0), F.lit(False))


def _cost() -> Column:
    return F.greatest(F.col("size"), F.lit(LEAST_SIZE))


def _pivots(vectors: DataFrame) -> dict[tuple[int, int], np.ndarray]:
    """Unit vectors per (label, length) that fills more than one tile."""
    whole = vectors.count()
    share = F.least(
        F.lit(PIVOTS_PER_LABEL),
        F.ceil(F.col("n") * _cost() / TILE_FLOATS),
        F.floor(F.col("n") / max(1, whole) * PIVOT_FLOATS / _cost()),
    )
    large = (
        vectors.groupBy(*KIND)
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("pivots", share.cast("int"))
        .where("pivots > 1")
    )
    # Whichever rows the draw puts first will do as pivots.
    picked = (
        vectors.join(large, KIND)
        .where(F.rand(7) * F.col("n") < 4 * F.col("pivots"))
        .withColumn("draw", F.rand(8))
        .withColumn("nth", F.row_number().over(Window.partitionBy(*KIND).orderBy("draw")))
        .where("nth <= pivots")
        .select(*KIND, "embedding")
        .collect()
    )
    rows: dict[tuple[int, int], list] = {}
    for r in picked:
        rows.setdefault((r["label"], r["size"]), []).append(r["embedding"])
    points = {key: np.array(own, np.float64) for key, own in rows.items()}
    return {key: p / np.sqrt((p * p).sum(axis=1))[:, None] for key, p in points.items()}


def _nearest(pivots):
    """Adds the nearest pivot of each vector and its distance; 0 and 2 without pivots."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = pivots.value
        for part in batches:
            cell = np.zeros(part.num_rows, np.int32)
            apart = np.full(part.num_rows, 2.0)
            kinds = np.column_stack([part.column(c).to_numpy() for c in KIND])
            for key in {tuple(k) for k in kinds.tolist()} & known.keys():
                at = np.flatnonzero((kinds == key).all(axis=1))
                own = part.column("embedding").take(pa.array(at))
                points = own.flatten().to_numpy().astype(np.float64).reshape(len(at), key[1])
                points /= np.sqrt((points * points).sum(axis=1))[:, None]
                dots = points @ known[key].T
                cell[at] = dots.argmax(axis=1)
                apart[at] = np.sqrt(np.maximum(0.0, 2 - 2 * dots.max(axis=1)))
            columns = {n: part.column(n) for n in part.schema.names}
            columns |= {"cell": pa.array(cell), "apart": pa.array(apart)}
            yield pa.record_batch(list(columns.values()), names=list(columns))

    return work


def _cells(pivots: dict, cells: DataFrame) -> dict:
    """Pivots, radii and numbers of blocks of the cells of every label that has pivots."""
    known = {key: (p, np.zeros(len(p)), np.zeros(len(p), np.int64)) for key, p in pivots.items()}
    # At most as many rows as there are pivots.
    for r in cells.where("apart_from IS NOT NULL").collect() if known else []:
        _, radius, blocks = known[r["label"], r["size"]]
        radius[r["cell"]], blocks[r["cell"]] = r["apart_from"], r["blocks"]
    return known


def near_vectors(rows: DataFrame, cosine: float = 0.93) -> DataFrame:
    """Rows (vec_id, n_links, component_id, kept) for rows (vec_id, embedding, label)."""
    rows = rows.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding", "label")
    usable = _usable(F.col("embedding")) & F.col("label").isNotNull()
    marked = rows.select(
        "vec_id",
        F.when(usable, F.col("label")).cast("int").alias("label"),
        F.when(usable, F.xxhash64("embedding", F.lit(1))).alias("mark_a"),
        F.when(usable, F.xxhash64(F.lit(2), "embedding")).alias("mark_b"),
        F.when(usable, F.col("embedding")).alias("embedding"),
    )
    marks = ["label", "mark_a", "mark_b"]
    classes = stored(
        marked.where("label IS NOT NULL")
        .groupBy(*marks)
        .agg(
            F.coalesce(F.min("vec_id"), F.lit(0)).alias("least"),
            F.count(F.lit(1)).alias("copies"),
            F.count("vec_id").alias("named"),
            F.any_value("embedding").alias("embedding"),
        )
        .select("*", F.size("embedding").alias("size"), F.monotonically_increasing_id().alias("member")),
        "classes",
    )
    marked = stored(marked.drop("embedding"), "vectors")
    heads = classes.select("member", *KIND, "copies", "embedding")
    pivots = _pivots(heads)
    context = heads.sparkSession.sparkContext
    numbers = heads.schema["embedding"].dataType.simpleString()
    placed = stored(
        map_batches(
            heads,
            _nearest(context.broadcast(pivots)),
            f"member long, label int, size int, copies long, embedding {numbers}, cell int, apart double",
        ),
        "cells",
    )
    cells = stored(
        placed.groupBy(*KIND, "cell").agg(
            F.max(F.when(F.col("apart") < 2, F.col("apart"))).alias("apart_from"),
            F.ceil(F.count(F.lit(1)) * F.max(_cost()) / TILE_FLOATS).cast("int").alias("blocks"),
        ),
        "cells",
    )
    shared = context.broadcast(_cells(pivots, cells))
    block = F.pmod(F.xxhash64("member", F.lit(3)), F.col("blocks")).cast("int").alias("block")
    by_tile = (
        placed.join(cells.select(*KIND, "cell", "blocks"), [*KIND, "cell"])
        .select("member", *KIND, "cell", "copies", "embedding", "blocks", block)
        .repartition(*TILE_KEYS)
        .sortWithinPartitions(*TILE_KEYS)
    )
    dealt = (
        map_batches(
            by_tile,
            _tiles(shared, cosine),
            "label int, size int, low long, high long, side int, tile binary",
        )
        .repartition(*TASK_KEYS)
        .sortWithinPartitions(*TASK_KEYS, "side")
    )
    found = stored(map_batches(dealt, _work(cosine), "a long, b long, links long"), "links")
    links = found.where("b IS NOT NULL")
    counts = found.where("b IS NULL").groupBy(F.col("a").alias("member")).agg(F.sum("links").alias("links"))
    parts = connected_components(links).withColumnRenamed("node", "member")
    least = stored(
        classes.join(parts, "member", "left")
        .join(counts, "member", "left")
        .select(
            *marks, "least", "named", F.coalesce("component", "member").alias("part"),
            (F.col("copies") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"),
        ),
        "classes",
    )
    smallest = stored(
        least.where("named > 0").groupBy("part").agg(F.min("least").alias("component_id")), "parts"
    )
    named = stored(
        least.join(smallest, "part", "left").select(*marks, "n_links", "component_id"), "classes"
    )
    out = marked.select("vec_id", *marks).join(named, marks, "left")
    component = F.when(F.col("vec_id").isNotNull(), F.coalesce("component_id", "vec_id"))
    return out.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        (F.col("vec_id").isNull() | (component == F.col("vec_id"))).alias("kept"),
    )
