import hashlib
import math
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import prefix_trie as op

SCHEMA = "conv_id long, turn long, role string, text string"
COLUMNS = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def nulls_first(row):
    return [(x is not None, x if x is not None else 0) for x in row[1:]]


def plain_rebuilt(rows):
    """conv_id -> rebuilt list of (role, text); % has the sign of what is divided, as in SQL."""
    turns = defaultdict(list)
    for conv, turn, role, text in sorted(rows, key=nulls_first):
        if conv is not None:
            turns[conv].append((role or "", text or ""))
    out = {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 9
        out[c] = turns.get(c - int(math.fmod(c, 5)), [])[:h] + own[h:]
    return out


def plain_trie(conversations):
    members = defaultdict(list)
    for c, turns in conversations.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    leaves, saved, rows = {}, {}, []
    for node in sorted(members, key=len, reverse=True):
        below = children.get(node, [])
        leaves[node] = sum(leaves[x] for x in below) or 1
        own = (len(members[node]) - 1) * len(node[-1][1].encode()) if node else 0
        saved[node] = own + sum(saved[x] for x in below)
        ends = sorted(c for c in members[node] if len(conversations[c]) == len(node))
        rows.append(
            (min(members[node]), len(node), min(members[node[:-1]]) if node else None, len(members[node]),
             len(below), leaves[node], saved[node], hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest())
        )
    return sorted(rows, key=str)


def collected(frame):
    assert tuple(frame.columns) == COLUMNS
    return sorted((tuple(r) for r in frame.collect()), key=str)


def drawn_rows(seed, n_convs, longest, n_texts):
    r = random.Random(seed)
    rows = []
    for c in range(n_convs):
        for turn in range(r.randint(0, longest)):
            rows.append((c, turn, r.choice(["user", "assistant"]), f"té {r.randrange(n_texts)}" * r.randint(0, 1)))
    return rows


ODD = [
    (None, 0, "user", "nobody's"), (200, None, "user", "null turn"), (200, 0, None, "b"), (200, 0, None, "a"),
    (200, 1, "user", None), (200, 1, "user", None), (201, 5, "x", ""), (-7, 0, "user", "below zero"),
    (-5, 0, "user", "base of it"), (300, 0, "user", "long " * 200_000), (300, 1, "user", "z"),
]


def test_against_plain_version(spark):
    rows = drawn_rows(1, 60, 12, 2) + ODD
    frame = spark.createDataFrame(rows, SCHEMA)
    assert collected(op.rebuilt_trie(frame)) == plain_trie(plain_rebuilt(rows))


def test_small_blocks_and_shards_give_the_same(spark):
    # Long copies of conversations reach over several blocks and end within and at their edges.
    rows = drawn_rows(2, 25, 9, 1)
    rows += [(c, t, "user", f"{t % 3}") for c in (40, 41, 45, 46) for t in range(14 + c % 4)]
    rows += [(50, t, "user", f"{t % 3}") for t in range(17)] + [(55, t, "user", f"{t % 3}") for t in range(9)]
    frame = spark.createDataFrame(rows, SCHEMA)
    assert collected(op.rebuilt_trie(frame, block=3, shard_rows=20)) == plain_trie(plain_rebuilt(rows))


def test_trie_of_conversations_as_they_are(spark):
    rows = drawn_rows(3, 30, 6, 2)
    turns = op.positions(spark.createDataFrame(rows, SCHEMA))
    found = collected(op.trie(op.paths(*op.as_they_are(turns), block=4), 4, 50))
    own = defaultdict(list)
    for c, _, role, text in rows:
        own[c].append((role, text))
    assert found == plain_trie(own)


def test_positions_of_one_long_conversation_in_many_tasks(spark):
    n = 5000
    frame = spark.range(n).select(
        F.lit(1).alias("conv_id"), F.lit(0).alias("turn"), F.lit("u").alias("role"), F.lit("same").alias("text")
    )
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        places = op.positions(frame)
        assert sorted(r.pos for r in places.select("pos").collect()) == list(range(1, n + 1))
        assert [r.n for r in places.groupBy("conv_id").agg(F.max("pos").alias("n")).collect()] == [n]
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_many_members_end_in_one_node(spark, monkeypatch):
    monkeypatch.setattr(op, "CHUNK_BYTES", 50)
    rows = [(5 * c, 0, "user", "hello") for c in range(3000)]
    plain = [(c, t, "u", x) for c, t, _, x in rows]
    turns = op.positions(spark.createDataFrame(plain, SCHEMA))
    found = collected(op.trie(op.paths(*op.as_they_are(turns))))
    assert found == plain_trie({c: [("u", "hello")] for c, *_ in rows})


def test_empty_table_and_other_columns(spark):
    frame = spark.createDataFrame([(1, 0, "user", "x", 9, 8)], SCHEMA + ", depth int, block int")
    assert collected(op.rebuilt_trie(frame)) == plain_trie(plain_rebuilt([(1, 0, "user", "x")]))
    assert op.rebuilt_trie(frame.limit(0)).collect() == []


@pytest.mark.parametrize("n", [0, 1, 2, 1000, 40_000])
def test_slots_are_a_verified_perfect_hash(n):
    r = np.random.default_rng(n)
    a, b = (r.integers(0, 2**64, n, dtype=np.uint64) for _ in range(2))
    a[: n // 4] = 7  # half of a digest may repeat
    slots = op.Slots(a, b)
    assert sorted(slots.find(a, b).tolist()) == list(range(n))
    assert (slots.find(a, b + np.uint64(1)) == -1).all()


def test_digests_that_collide_in_one_half_get_their_own_slots():
    a = np.arange(500, dtype=np.uint64)
    b = np.zeros(500, np.uint64)
    both = op.Slots(np.concatenate((a, b)), np.concatenate((b + np.uint64(900), a + np.uint64(1))))
    assert len(both) == 1000 and (both.find(a, b + np.uint64(900)) >= 0).all()
    with pytest.raises(ValueError):
        op.Slots(b, b)
