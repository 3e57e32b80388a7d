import math
import random

import numpy as np
import pytest
from brute import components, table_rows

from tidemark.llm import cover_tree_dedup as op

SCHEMA = "vec_id long, embedding array<float>, label int"


def expected(rows, cosine=0.93):
    """(vec_id, links, component) by comparing all pairs."""
    good = []
    for i, v, label in rows:
        ok = v is not None and label is not None and None not in v and np.isfinite(v).all() and np.any(v)
        x = np.array(v, np.float32).astype(float) if ok else None
        good.append((i, x, label, ok))
    links, counts = [], [0] * len(rows)
    for a, (i, x, label, ok) in enumerate(good):
        for b, (j, y, other, ok2) in enumerate(good):
            if a == b or not (ok and ok2) or label != other or len(x) != len(y):
                continue
            if x @ y / math.sqrt((x @ x) * (y @ y)) >= cosine:
                counts[a] += 1
                links.append((i, j))
    part = components([r[0] for r in rows], links)
    return sorted((r[0], n, part[r[0]]) for r, n in zip(rows, counts, strict=True))


def got(spark, rows):
    out = op.near_vectors(spark.createDataFrame(rows, SCHEMA)).collect()
    assert all(r.kept == (r.vec_id == r.component_id) for r in out)
    return sorted((r.vec_id, r.n_links, r.component_id) for r in out)


def cloud(seed, n, size, spread, labels=2):
    r = np.random.default_rng(seed)
    centres = r.normal(size=(max(1, n // 12), size))
    rows = centres[r.integers(0, len(centres), n)] + spread * r.normal(size=(n, size))
    return [(k, v.astype(np.float32).tolist(), int(r.integers(labels))) for k, v in enumerate(rows)]


@pytest.mark.parametrize("floats", [1 << 18, 320])
def test_equals_comparing_all_pairs(spark, monkeypatch, floats):
    monkeypatch.setattr(op, "TILE_FLOATS", floats)
    rows = cloud(3, 160, 8, 0.2)
    rows += [(1000 + k, rows[5][1], rows[5][2]) for k in range(30)]  # copies
    rows += [(2000 + k, [2 * x for x in rows[k][1]], rows[k][2]) for k in range(10)]
    random.Random(1).shuffle(rows)
    want = expected(rows)
    assert sum(n for _, n, _ in want) > 500
    assert got(spark, rows) == want


def test_source_table(spark):
    rows = [(r.vec_id, r.embedding, r.label) for r in table_rows(spark, "embeddings")]
    assert got(spark, rows) == expected(rows)


def test_odd_rows(spark):
    a, nan, inf = [1.0, 0.0], float("nan"), float("inf")
    rows = [(1, a, 0), (2, a, 0), (3, a, None), (4, a, None), (5, None, 0), (6, [0.0, 0.0], 0),
            (7, [nan, 1.0], 0), (8, [inf, 1.0], 0), (9, [None, 1.0], 0), (10, [], 0), (11, [1.0], 0),
            (12, [3e38, 0.0], 0), (13, [1e-45, 0.0], 0), (14, [-1.0, 0.0], 0)]
    assert got(spark, rows) == expected(rows)
    frame = spark.createDataFrame([*rows, (None, a, 0), (2, a, 0)], SCHEMA)
    frame = frame.selectExpr("*", "1 AS member", "2 AS n_links", "3 AS component_id")
    out = sorted(((r.vec_id, r.n_links, r.component_id, r.kept) for r in op.near_vectors(frame).collect()), key=str)
    assert (1, 5, 1, True) in out and out.count((2, 5, 1, False)) == 2
    assert (None, 5, None, True) in out
    assert op.near_vectors(frame.limit(0)).count() == 0


def unit(points):
    return points / np.sqrt((points * points).sum(axis=1))[:, None]


def test_tree_levels_cover_and_nest():
    r = np.random.default_rng(5)
    points = r.normal(size=(200, 6))
    points[100:150] = points[:50] + 0.02 * r.normal(size=(50, 6))
    points = unit(points)
    tree = op.CoverTree(points)
    assert sorted(tree.order.tolist()) == list(range(200))
    assert np.array_equal(points[tree.order], tree.points)
    before = set()
    for k, (starts, radius) in enumerate(zip(tree.starts, tree.radius, strict=True)):
        assert starts[0] == 0 and starts[-1] == 200 and (np.diff(starts) > 0).all()
        assert before <= set(starts.tolist())
        before = set(starts.tolist())
        for a, b, own in zip(starts[:-1], starts[1:], radius, strict=True):
            far = np.sqrt(((tree.points[a:b] - tree.points[a]) ** 2).sum(axis=1)).max()
            assert far <= own + 1e-12 and (k == 0 or own <= 2.0 / 2**k + 1e-7)
    assert len(tree.starts[-1]) == 201


def pairs_met(one, two, reach):
    """How often the traversal yields each pair of points, and which it says are surely linked."""
    met, surely = {}, set()
    for sure, level, a, b in op.dual_traversal(one, two, reach):
        s, t = (x.starts[min(level, len(x.starts) - 1)] for x in (one, two))
        for i, j in zip(a, b, strict=True):
            for p in range(s[i], s[i + 1]):
                for q in range(t[j], t[j + 1]):
                    met[p, q] = met.get((p, q), 0) + 1
                    if sure:
                        surely.add((p, q))
    return met, surely


@pytest.mark.parametrize("size", [1, 2, 5, 30])
def test_traversal_loses_no_pair_and_meets_none_twice(size):
    r = np.random.default_rng(6)
    sides = []
    for _ in range(2):
        points = r.normal(size=(150, size))
        points[60:110] = points[:50] + 0.05 * r.normal(size=(50, size))
        sides.append(op.CoverTree(unit(points)))
    met, surely = pairs_met(*sides, 0.374)
    dots = sides[0].points @ sides[1].points.T
    near = {tuple(x) for x in np.argwhere(dots >= 1 - 0.374**2 / 2 + 1e-9).tolist()}
    assert near <= met.keys() and set(met.values()) <= {1}
    assert all(dots[p] >= 1 - 0.374**2 / 2 - 1e-12 for p in surely)
    if size == 30:
        assert len(met) < 150 * 150 / 20
    met, _ = pairs_met(sides[0], sides[0], 0.374)
    dots = sides[0].points @ sides[0].points.T
    assert all((p, q) in met or (q, p) in met for p, q in np.argwhere(dots >= 0.9301).tolist())


def tile(points, copies=None):
    n = len(points)
    return op.Tile(np.arange(n), np.ones(n, np.int64) if copies is None else copies, points)


def test_comparing_tiles_equals_comparing_all_pairs():
    r = np.random.default_rng(9)
    centres = r.normal(size=(40, 20))
    for spread in (0.01, 0.25):
        a, b = (centres[r.integers(0, 40, n)] + spread * r.normal(size=(n, 20)) for n in (300, 200))
        copies = r.integers(1, 4, 300)
        dots = unit(a) @ unit(b).T >= 0.93
        links, (ids, counts) = op.compare(tile(a, copies), op.Tile(np.arange(300, 500), np.ones(200, np.int64), b), 0.93)
        want = np.concatenate((dots.sum(axis=1), (dots * copies[:, None]).sum(axis=0)))
        assert dict(zip(ids.tolist(), counts.tolist(), strict=True)) == {k: n for k, n in enumerate(want.tolist()) if n}
        pairs = [(x, 300 + y) for x, y in np.argwhere(dots).tolist()]
        assert components(range(500), links) == components(range(500), pairs)
        assert all(dots[min(p), max(p) - 300] for p in links)
        own = unit(a) @ unit(a).T >= 0.93
        whole = tile(a, copies)
        links, (ids, counts) = op.compare(whole, whole, 0.93)
        want = (own * copies[None, :]).sum(axis=1) - copies
        assert dict(zip(ids.tolist(), counts.tolist(), strict=True)) == {k: n for k, n in enumerate(want.tolist()) if n}
        assert components(range(300), links) == components(range(300), np.argwhere(own).tolist())


def test_work_on_clustered_vectors_is_far_below_all_pairs():
    r = np.random.default_rng(4)
    n, size = 4000, 32
    points = r.normal(size=(25, size))[r.integers(0, 25, n)] + 0.04 * r.normal(size=(n, size))
    count = op.Counter()
    whole = tile(points)
    op.compare(whole, whole, 0.93, count)
    assert count["products"] < n * n / 2 / 200
    assert count["bounds"] < n * n / 2 / 20


def test_unlike_vectors_need_few_whole_products():
    whole = tile(np.random.default_rng(8).normal(size=(2000, 64)))
    count = op.Counter()
    op.compare(whole, whole, 0.93, count)
    assert count["products"] < 2000 * 2000 / 2 / 40


def test_a_label_cut_by_pivots_and_blocks(spark, monkeypatch):
    monkeypatch.setattr(op, "TILE_FLOATS", 1024)
    monkeypatch.setattr(op, "PIVOTS_PER_LABEL", 5)
    rows = cloud(11, 700, 16, 0.1, labels=1)
    assert got(spark, rows) == expected(rows)


def test_very_long_vectors(spark):
    r = np.random.default_rng(2)
    rows = [(k, r.normal(size=20_000).astype(np.float32).tolist(), 0) for k in range(6)]
    rows += [(10 + k, [x * 1.5 for x in rows[k][1]], 0) for k in range(3)]
    assert got(spark, rows) == expected(rows)
