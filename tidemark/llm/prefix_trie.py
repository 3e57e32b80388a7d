"""Prefix trie of conversations: nodes, members and sums over subtrees.

A node is a distinct sequence of first turns (role, text); the root is the empty one. It is told
by a 128-bit digest, the exclusive or of a hash of every turn with its place.

1. ``positions`` numbers the turns of every conversation: rows are range partitioned by conversation
   and order, so a long conversation lies in several tasks, and what its earlier tasks hold is added.
2. ``paths`` gives for every conversation the digest after each of its turns. Conversations are cut into
   blocks of ``BLOCK`` turns; the digest of the blocks before is added to each.
3. Paths are dealt to shards by conversation and block, not by prefix, so a prefix that many
   conversations share loads no single shard. A shard lists its distinct digests and gives each a slot
   of a minimal perfect hash; a slot keeps its digest, so every look-up is verified. Members, least
   member and ends are scattered into flat arrays by slot and added up over shards.
4. Every node's own values now belong to one shard, that of its least member, whose path holds all its
   ancestors. Each shard accumulates them through an array of parent slots, deepest first; sums
   of the shards are added. What a conversation owns in later blocks enters at the end of each block.
5. The ids of members that end in a node are sorted over ranges, joined in chunks and hashed in order.
   A SHA-256 is one sequence by its nature: the chunks of one node pass through one task, a chunk
   at a time.

Rows: turns are ordered by turn, role, text, nulls first; null roles and texts are empty. Repeated
rows are repeated turns. Rows without a conv_id are turns of no conversation and left out. Texts of
any length are hashed whole. An empty table has no nodes. Other columns are not read, whatever
their names.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import map_batches, stored
from tidemark.llm.words import mix

BLOCK = 4096
"""Turns of one conversation that are handled together."""
SHARD_ROWS = 50_000
"""Rows of a shard, on average."""
CHUNK_BYTES = 1 << 20
EVERY, MOST = 5, 9


# --- turns and paths ---------------------------------------------------------------------------


def positions(rows: DataFrame) -> DataFrame:
    """Stored rows (conv_id, pos, mark_a, mark_b, n_bytes): turns numbered from 1 in each conversation."""
    order = ["conv_id", "turn", "role", "text", "_row"]
    role, text = (F.coalesce(F.col(c), F.lit("")) for c in ("role", "text"))
    spread = (
        rows.where("conv_id IS NOT NULL")
        .select(F.col("conv_id").cast("long").alias("conv_id"), "turn", "role", "text")
        .withColumn("_row", F.monotonically_increasing_id())
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .select(
            "conv_id",
            F.monotonically_increasing_id().alias("at"),
            F.xxhash64(role, text).alias("mark_a"),
            F.xxhash64(text, F.lit(11), role).alias("mark_b"),
            F.octet_length(text).cast("long").alias("n_bytes"),
        )
    )
    part = F.shiftright("at", 33).alias("part")
    spread = stored(spread, "turns").select("*", part)
    here = Window.partitionBy("conv_id", "part").orderBy("at")
    earlier = Window.partitionBy("conv_id").orderBy("part").rowsBetween(
        Window.unboundedPreceding, -1
    )
    # A task holds at most one conversation that an earlier one began: a row a task.
    before = (
        spread.groupBy("conv_id", "part")
        .agg(F.count(F.lit(1)).alias("n"))
        .select("conv_id", "part", F.sum("n").over(earlier).alias("before"))
        .where("before IS NOT NULL")
    )
    numbered = spread.withColumn("_here", F.row_number().over(here)).join(
        F.broadcast(before), ["conv_id", "part"], "left"
    )
    pos = F.col("_here") + F.coalesce("before", F.lit(0))
    return stored(numbered.select("conv_id", pos.alias("pos"), "mark_a", "mark_b", "n_bytes"), "turns")


def _block(depth: str | Column, block: int) -> Column:
    place = F.col(depth) if isinstance(depth, str) else depth
    return F.greatest(F.floor((place - 1) / block), F.lit(0)).cast("long")


def as_they_are(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Numbered turns as paths of their own: (turns with depth, lengths)."""
    lengths = turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("length"))
    return turns.withColumnRenamed("pos", "depth"), stored(lengths, "lengths")


def rebuilt(
    turns: DataFrame, every: int = EVERY, most: int = MOST, block: int = BLOCK
) -> tuple[DataFrame, DataFrame]:
    """Conversations that begin with the first turns of another: (turns with depth, lengths).

    Conversation c takes the first h turns of c - c % ``every``, h being crc32(c) % ``most``, then its
    own after its first h.
    """
    lengths = stored(
        turns.groupBy("conv_id").agg(F.count(F.lit(1)).alias("n")), "lengths"
    )
    head = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % most).alias("head")
    base = (F.col("conv_id") - F.col("conv_id") % every).alias("base")
    lent = lengths.select(F.col("conv_id").alias("base"), F.col("n").alias("n_base"))
    taken = F.least("head", F.coalesce("n_base", F.lit(0)))
    info = stored(
        lengths.select("conv_id", "n", base, head)
        .join(lent, "base", "left")
        .select(
            "conv_id",
            "n",
            "base",
            "head",
            taken.alias("taken"),
            (taken + F.greatest(F.col("n") - F.col("head"), F.lit(0))).alias("length"),
        ),
        "lengths",
    )
    columns = ["depth", "mark_a", "mark_b", "n_bytes"]
    borrowed = (
        info.select("conv_id", "base", "head")
        .join(
            turns.where(F.col("pos") < most).withColumnsRenamed({"conv_id": "base", "pos": "depth"}),
            "base",
        )
        .where("depth <= head")
        .select("conv_id", *columns)
    )
    # One row a block of turns, so that a long conversation meets its shift in many tasks.
    shift = info.select(
        "conv_id",
        "head",
        "taken",
        F.explode(F.sequence(F.lit(0).cast("long"), _block("n", block))).alias("block"),
    )
    own = (
        turns.withColumn("block", _block("pos", block))
        .join(shift, ["conv_id", "block"])
        .where("pos > head")
        .withColumn("depth", F.col("pos") - F.col("head") + F.col("taken"))
        .select("conv_id", *columns)
    )
    return borrowed.unionByName(own), info.select("conv_id", "length")


def paths(turns: DataFrame, lengths: DataFrame, block: int = BLOCK) -> DataFrame:
    """Stored rows (conv_id, depth, block, a, b, up_a, up_b, n_bytes, ends): a node of each path.

    (a, b) is the node's digest, (up_a, up_b) its parent's; the root's is (0, 0).
    """
    steps = turns.select(
        "conv_id",
        F.col("depth").cast("long").alias("depth"),
        _block("depth", block).alias("block"),
        F.xxhash64("depth", "mark_a", "mark_b").alias("step_a"),
        F.xxhash64("mark_b", "depth", F.lit(5), "mark_a").alias("step_b"),
        "n_bytes",
    )
    own = Window.partitionBy("conv_id", "block").orderBy("depth")
    earlier = Window.partitionBy("conv_id").orderBy("block").rowsBetween(
        Window.unboundedPreceding, -1
    )
    within = stored(
        steps.withColumns(
            {f"in_{x}": F.bit_xor(f"step_{x}").over(own) for x in "ab"}
        ),
        "steps",
    )
    # The last digest of each full block: few rows, of conversations longer than a block.
    full = (
        within.where(F.col("depth") % block == 0)
        .select("conv_id", "block", "in_a", "in_b")
        .unionByName(
            within.where((F.col("depth") % block == 1) & (F.col("depth") > 1)).select(
                "conv_id", "block", F.lit(0).cast("long").alias("in_a"), F.lit(0).cast("long").alias("in_b")
            )
        )
        .groupBy("conv_id", "block")
        .agg(F.bit_xor("in_a").alias("in_a"), F.bit_xor("in_b").alias("in_b"))
        .select(
            "conv_id",
            "block",
            *[F.bit_xor(f"in_{x}").over(earlier).alias(f"before_{x}") for x in "ab"],
        )
        .where("before_a IS NOT NULL")
    )
    digest = {
        x: F.col(f"in_{x}").bitwiseXOR(F.coalesce(f"before_{x}", F.lit(0).cast("long")))
        for x in "ab"
    }
    shape = ["conv_id", "depth", "block", "a", "b", "up_a", "up_b", "n_bytes"]
    inner = (
        within.join(full, ["conv_id", "block"], "left")
        .withColumns(digest)
        .withColumns({f"up_{x}": F.col(x).bitwiseXOR(F.col(f"step_{x}")) for x in "ab"})
        .select(*shape)
    )
    zero = F.lit(0).cast("long")
    roots = lengths.select("conv_id", *[zero.alias(c) for c in shape[1:]])
    stops = lengths.select("conv_id", F.col("length").cast("long").alias("depth"), F.lit(True).alias("ends"))
    return stored(
        inner.unionByName(roots)
        .join(stops, ["conv_id", "depth"], "left")
        .withColumn("ends", F.coalesce("ends", F.lit(False))),
        "paths",
    )


# --- slots -------------------------------------------------------------------------------------


class Slots:
    """A minimal perfect hash of distinct 128-bit digests, with the digests in their slots.

    On every level the digests left are hashed into a table half as large again; those alone in
    their place are numbered in order of place, the others go on to the next level.
    """

    def __init__(self, a: np.ndarray, b: np.ndarray):
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []
        left, given = np.arange(len(a)), 0
        while len(left):
            if len(self.levels) > 200:
                raise ValueError("equal digests have no slots of their own")
            size = max(64, len(left) + len(left) // 2)
            place = self._place(a[left], b[left], len(self.levels), size)
            alone = np.bincount(place, minlength=size) == 1
            number = np.cumsum(alone) - 1 + given
            self.levels.append((alone, number))
            given += int(alone.sum())
            left = left[~alone[place]]
        slot = self._find(a, b)
        self.a, self.b = np.empty_like(a), np.empty_like(b)
        self.a[slot], self.b[slot] = a, b

    def __len__(self) -> int:
        return len(self.a)

    @staticmethod
    def _place(a: np.ndarray, b: np.ndarray, level: int, size: int) -> np.ndarray:
        salt = np.uint64(0x9E3779B97F4A7C15 * (2 * level + 1) % 2**64)
        return (mix(a ^ mix(b + salt)) % np.uint64(size)).astype(np.int64)

    def _find(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        slot, left = np.full(len(a), -1), np.arange(len(a))
        for level, (alone, number) in enumerate(self.levels):
            place = self._place(a[left], b[left], level, len(alone))
            hit = alone[place]
            slot[left[hit]] = number[place[hit]]
            left = left[~hit]
        return slot

    def find(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The slot of each digest; -1 for one that is not in the table."""
        slot = self._find(a, b)
        if len(self):
            slot[(slot >= 0) & ((self.a[slot] != a) | (self.b[slot] != b))] = -1
        return slot


def _distinct(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Where each distinct digest stands first."""
    order = np.lexsort((b, a))
    new = np.ones(len(order), bool)
    new[1:] = (a[order][1:] != a[order][:-1]) | (b[order][1:] != b[order][:-1])
    return order[new]


def _by_shard(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[int, int], dict]]:
    """((block, shard), columns) of rows sorted by the two; digests as unsigned numbers."""
    key, parts = None, []

    def whole():
        names = parts[0].schema.names
        joined = pa.Table.from_batches(parts)
        columns = {n: joined.column(n).to_numpy() for n in names}
        return {n: c.view(np.uint64) if n in ("a", "b", "up_a", "up_b") else c for n, c in columns.items()}

    for batch in batches:
        if not batch.num_rows:
            continue
        block, shard = batch.column("block").to_numpy(), batch.column("shard").to_numpy()
        edges = np.flatnonzero((block[1:] != block[:-1]) | (shard[1:] != shard[:-1])) + 1
        for start, stop in zip([0, *edges], [*edges, batch.num_rows], strict=True):
            now = (int(block[start]), int(shard[start]))
            if now != key and parts:
                yield key, whole()
                parts = []
            key = now
            parts.append(batch.slice(start, stop - start))
    if parts:
        yield key, whole()


def _rows(key: tuple[int, int], columns: dict[str, np.ndarray]) -> pa.RecordBatch:
    n = len(next(iter(columns.values())))
    columns = {"block": np.full(n, key[0]), "shard": np.full(n, key[1])} | columns
    signed = {k: v.view(np.int64) if v.dtype == np.uint64 else v.astype(np.int64) for k, v in columns.items()}
    return pa.record_batch([pa.array(v) for v in signed.values()], names=list(signed))


def _scatter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Members, least member and ends of a shard's nodes."""
    for key, rows in _by_shard(batches):
        first = _distinct(rows["a"], rows["b"])
        slots = Slots(rows["a"][first], rows["b"][first])
        slot = slots.find(rows["a"], rows["b"])
        n = len(slots)
        members = np.bincount(slot, rows["weight"], n)
        ends = np.bincount(slot, rows["weight"] * rows["ends"], n)
        least = np.full(n, np.iinfo(np.int64).max)
        np.minimum.at(least, slot, rows["conv_id"])
        out = {"a": slots.a, "b": slots.b}
        for name in ("up_a", "up_b", "depth", "n_bytes", "anchor"):
            out[name] = np.empty(n, rows[name].dtype)
            out[name][slot] = rows[name]
        yield _rows(key, out | {"n": members, "ends": ends, "least": least})


def _accumulate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums over the subtrees of a shard's nodes of what the shard owns."""
    for key, rows in _by_shard(batches):
        slots = Slots(rows["a"], rows["b"])
        n = len(slots)
        at = slots.find(rows["a"], rows["b"])
        flat = {}
        for name, column in rows.items():
            flat[name] = np.empty(n, column.dtype)
            flat[name][at] = column
        has_parent = (flat["depth"] > 0) & (flat["anchor"] == 0)
        parent = np.full(n, -1)
        parent[has_parent] = slots.find(flat["up_a"][has_parent], flat["up_b"][has_parent])
        if (parent[has_parent] < 0).any():
            raise ValueError("a node's parent is not in its shard")
        own = flat["owned"] == 1
        leaves = flat["more_leaves"] + (own & (flat["ends"] == flat["n"]))
        saved = flat["more_saved"] + own * (flat["n"] - 1) * flat["n_bytes"]
        children = np.bincount(parent[own & has_parent], minlength=n)
        order = np.argsort(-flat["depth"], kind="stable")
        order = order[has_parent[order]]
        steps = np.flatnonzero(np.diff(flat["depth"][order])) + 1
        for level in np.split(order, steps):
            np.add.at(leaves, parent[level], leaves[level])
            np.add.at(saved, parent[level], saved[level])
        inside = flat["anchor"] == 0
        up = np.where(own & has_parent, flat["least"][parent], -1)
        out = {name: flat[name] for name in ("depth", "least", "n")}
        yield _rows(
            key,
            {"a": slots.a, "b": slots.b}
            | out
            | {"leaves": leaves * inside, "saved": saved * inside, "children": children,
               "up": up, "has_up": own & has_parent},
        )


# --- ends --------------------------------------------------------------------------------------


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted (a, b, conv_id) to pieces (a, b, first, ids) of ids joined by commas."""

    def batch(node, first, ids):
        columns = [pa.array([node[0]]), pa.array([node[1]]), pa.array([first]), pa.array([",".join(ids)])]
        return pa.record_batch(columns, names=["a", "b", "first", "ids"])

    node, first, ids, size = None, 0, [], 0
    for part in batches:
        for a, b, conv in zip(*(part.column(c).to_pylist() for c in ("a", "b", "conv_id")), strict=True):
            if ids and ((a, b) != node or size > CHUNK_BYTES):
                yield batch(node, first, ids)
                ids, size = [], 0
            if not ids:
                node, first = (a, b), conv
            ids.append(str(conv))
            size += len(ids[-1]) + 1
    if ids:
        yield batch(node, first, ids)


def _hash_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted pieces to one digest per node."""

    def batch(node, running):
        columns = [pa.array([node[0]]), pa.array([node[1]]), pa.array([running.hexdigest()])]
        return pa.record_batch(columns, names=["a", "b", "ends_sha256"])

    node, running = None, None
    for part in batches:
        for a, b, ids in zip(*(part.column(c).to_pylist() for c in ("a", "b", "ids")), strict=True):
            if (a, b) != node:
                if node:
                    yield batch(node, running)
                node, running = (a, b), hashlib.sha256(ids.encode())
            else:
                running.update(b"," + ids.encode())
    if node:
        yield batch(node, running)


def _end_digests(nodes_of_ends: DataFrame) -> DataFrame:
    order = ["a", "b", "conv_id"]
    chunks = map_batches(
        nodes_of_ends.select(*order).repartitionByRange(*order).sortWithinPartitions(*order),
        _chunks,
        "a long, b long, first long, ids string",
    )
    together = chunks.repartition("a", "b").sortWithinPartitions("a", "b", "first")
    return map_batches(together, _hash_chunks, "a long, b long, ends_sha256 string")


# --- the trie ----------------------------------------------------------------------------------


def _dealt(rows: DataFrame) -> DataFrame:
    return rows.repartition("block", "shard").sortWithinPartitions("block", "shard")


def trie(path_rows: DataFrame, block: int = BLOCK, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """The nodes of stored :func:`paths`."""
    n_shards = -(-path_rows.count() // shard_rows) or 1

    def shard(conv: str) -> Column:
        return F.pmod(F.xxhash64(conv), F.lit(n_shards)).cast("long")

    one, zero = F.lit(1).cast("long"), F.lit(0).cast("long")
    ends = F.col("ends").cast("long").alias("ends")
    columns = ["conv_id", "depth", "a", "b", "up_a", "up_b", "n_bytes"]
    members = path_rows.select(*columns, "block", ends, one.alias("weight"), zero.alias("anchor"))
    # The last node of a block stands for the path before the next one.
    edges = path_rows.where((F.col("depth") > 0) & (F.col("depth") % block == 0) & ~F.col("ends"))
    anchors = edges.select(
        *columns, (F.col("block") + 1).alias("block"), zero.alias("ends"), zero.alias("weight"), one.alias("anchor")
    )
    shape = "block long, shard long, a long, b long, "
    local = stored(
        map_batches(
            _dealt(members.unionByName(anchors).withColumn("shard", shard("conv_id"))),
            _scatter,
            shape + "up_a long, up_b long, depth long, n_bytes long, anchor long, n long, ends long, least long",
        ),
        "local",
    )
    # A digest stands once in a shard, so what meets here is bounded by the number of shards.
    whole = stored(
        local.where("anchor = 0")
        .groupBy("a", "b")
        .agg(
            F.sum("n").alias("n"), F.sum("ends").alias("ends"), F.min("least").alias("least"),
            F.max("depth").alias("depth"), F.max("n_bytes").alias("n_bytes"),
        ),
        "nodes",
    )
    later = (
        whole.withColumn("block", _block("depth", block))
        .where("block > 0")
        .groupBy(F.col("least").alias("conv_id"), "block")
        .agg(
            F.sum((F.col("ends") == F.col("n")).cast("long")).alias("leaves"),
            F.sum((F.col("n") - 1) * F.col("n_bytes")).alias("saved"),
        )
    )
    from_here = Window.partitionBy("conv_id").orderBy(F.desc("next"))
    carried = (
        edges.select("conv_id", "block", "a", "b", (F.col("block") + 1).alias("next"))
        .join(later.withColumnRenamed("block", "next"), ["conv_id", "next"], "left")
        .select(
            shard("conv_id").alias("shard"),
            "block",
            "a",
            "b",
            *[
                F.sum(F.coalesce(c, F.lit(0).cast("long"))).over(from_here).alias(f"more_{c}")
                for c in ("leaves", "saved")
            ],
        )
        .groupBy("block", "shard", "a", "b")
        .agg(F.sum("more_leaves").alias("more_leaves"), F.sum("more_saved").alias("more_saved"))
    )
    owned = (F.col("anchor") == 0) & (shard("least") == F.col("shard"))
    known = (
        local.drop("n", "ends", "least", "depth", "n_bytes")
        .join(whole, ["a", "b"])
        .join(carried, ["block", "shard", "a", "b"], "left")
        .withColumn("owned", owned.cast("long"))
        .fillna(0, ["more_leaves", "more_saved"])
    )
    sums = map_batches(
        _dealt(known),
        _accumulate,
        shape + "depth long, least long, n long, leaves long, saved long, children long, up long, has_up long",
    )
    nodes = stored(
        sums.groupBy("a", "b").agg(
            F.max("least").alias("conv_id"),
            F.max("depth").alias("depth"),
            F.max(F.when(F.col("has_up") == 1, F.col("up"))).alias("parent_conv_id"),
            F.max("n").alias("n_convs"),
            F.sum("children").alias("n_children"),
            F.sum("leaves").alias("n_leaves"),
            F.sum("saved").alias("saved_tokens"),
        ),
        "nodes",
    )
    digests = _end_digests(path_rows.where("ends"))
    return nodes.join(digests, ["a", "b"], "left").select(
        "conv_id",
        "depth",
        "parent_conv_id",
        "n_convs",
        "n_children",
        "n_leaves",
        "saved_tokens",
        F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
    )


def rebuilt_trie(rows: DataFrame, block: int = BLOCK, shard_rows: int = SHARD_ROWS) -> DataFrame:
    """Rows (conv_id, turn, role, text) to the trie of their :func:`rebuilt` conversations."""
    return trie(paths(*rebuilt(positions(rows), block=block), block=block), block, shard_rows)


ORACLE_SQL = """
WITH turns AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id
                            ORDER BY turn NULLS FIRST, role NULLS FIRST, text NULLS FIRST) AS pos
  FROM conversations WHERE conv_id IS NOT NULL
), convs AS (
  SELECT conv_id AS c, max(pos) AS n, conv_id - conv_id % 5 AS base,
         xor(list_reduce(
               list_prepend(CAST(4294967295 AS BIGINT),
                            [CAST(ascii(x) AS BIGINT) FOR x IN string_split(CAST(conv_id AS VARCHAR), '')]),
               lambda crc, byte: list_reduce(
                 list_prepend(xor(crc, byte), [CAST(i AS BIGINT) FOR i IN range(8)]),
                 lambda v, i: CASE WHEN v % 2 = 1 THEN xor(v // 2, CAST(3988292384 AS BIGINT))
                                ELSE v // 2 END)),
             CAST(4294967295 AS BIGINT)) % 9 AS h
  FROM turns GROUP BY conv_id
), info AS (
  SELECT a.c, a.base, a.h, least(a.h, coalesce(b.n, 0)) AS m,
         least(a.h, coalesce(b.n, 0)) + greatest(a.n - a.h, 0) AS length
  FROM convs a LEFT JOIN convs b ON b.c = a.base
), rebuilt AS (
  SELECT c, pos AS d, role, text FROM info JOIN turns ON conv_id = base AND pos <= h
  UNION ALL
  SELECT c, pos - h + m, role, text FROM info JOIN turns ON conv_id = c AND pos > h
), paths AS (
  SELECT x.c, x.d, max(strlen(x.text)) AS bytes,
         string_agg(strlen(y.role) || ':' || y.role || strlen(y.text) || ':' || y.text, '' ORDER BY y.d) AS k
  FROM rebuilt x JOIN rebuilt y ON y.c = x.c AND y.d <= x.d GROUP BY x.c, x.d
  UNION ALL
  SELECT c, 0, 0, '' FROM info
), nodes AS (
  SELECT k, p.d, min(p.c) AS conv_id, count(*) AS n, max(bytes) AS bytes,
         count(*) FILTER (p.d = length) AS n_ends,
         string_agg(CAST(p.c AS VARCHAR), ',' ORDER BY p.c) FILTER (p.d = length) AS ends
  FROM paths p JOIN info USING (c) GROUP BY k, p.d
), below AS (
  SELECT p.k, sum((v.n - 1) * v.bytes) AS saved, count(*) FILTER (v.n_ends = v.n) AS leaves,
         count(*) FILTER (v.d = p.d + 1) AS children
  FROM nodes v JOIN paths p ON p.c = v.conv_id AND p.d <= v.d GROUP BY p.k
)
SELECT v.conv_id, v.d AS depth, u.conv_id AS parent_conv_id, v.n AS n_convs,
       children AS n_children, leaves AS n_leaves, CAST(saved AS BIGINT) AS saved_tokens,
       sha256(coalesce(v.ends, '')) AS ends_sha256
FROM nodes v JOIN below USING (k)
LEFT JOIN paths p ON p.c = v.conv_id AND p.d = v.d - 1
LEFT JOIN nodes u ON u.k = p.k
"""
