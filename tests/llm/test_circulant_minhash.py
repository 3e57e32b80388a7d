import random

import numpy as np
import pyarrow as pa
import pytest
from brute import shingles, table_rows, text_groups, words

from tidemark.llm import circulant_minhash as op
from tidemark.llm import words as W
from tidemark.llm.components import connected_components


def docs(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, text string")


def family(seed, size, length, changes):
    """Texts that differ from one another in some words."""
    r = random.Random(seed)
    base = [f"w{r.randrange(9999)}" for _ in range(length)]
    out = []
    for _ in range(size):
        copy = list(base)
        for _ in range(r.randrange(changes + 1)):
            copy[r.randrange(length)] = f"x{r.randrange(9999)}"
        out.append(" ".join(copy))
    return out


def result(spark, rows, **settings):
    return {
        r.doc_id: r for r in op.near_duplicates(docs(spark, rows), **settings).collect()
    }


def test_equals_comparing_all_pairs(spark):
    texts = [t for s in range(4) for t in family(s, 12, 90, 5)] + ["one two", "one  TWO", "", None]
    rows = list(enumerate(texts))
    random.Random(1).shuffle(rows)
    got, want = result(spark, rows), text_groups(rows, 85)
    for i, text in rows:
        assert got[i].n_shingles == len(shingles(text))
        assert got[i].component_id == want[i]
        assert got[i].kept == (want[i] == i)


def test_a_large_bucket_is_compared_in_chunks(spark, monkeypatch):
    monkeypatch.setattr(op, "CHUNK", 7)
    rows = list(enumerate(family(9, 60, 120, 9)))
    got, want = result(spark, rows), text_groups(rows, 85)
    assert len(set(want.values())) > 1
    assert {i: r.component_id for i, r in got.items()} == want


def test_the_limit_itself_links(spark):
    a = [f"a{k}" for k in range(21)]  # 17 shingles of five words
    b = a + ["b0", "b1", "b2"]  # three more: 17 of 20
    c = a + ["c0", "c1", "c2", "c3"]  # 17 of 21
    got = result(spark, [(1, " ".join(a)), (2, " ".join(b)), (3, " ".join(c))])
    assert [got[i].component_id for i in (1, 2, 3)] == [1, 1, 3]


def test_source_table(spark):
    rows = [(r.doc_id, r.text) for r in table_rows(spark, "documents")]
    got, want = result(spark, rows), text_groups(rows, 85)
    assert {i: r.component_id for i, r in got.items()} == want


def test_odd_rows(spark):
    rows = [(None, "a b c d e f"), (None, None), (5, "a b c d e f"), (5, "a b c d e f"), (4, " \t\n"), (7, "a b c d e f")]
    frame = docs(spark, rows).selectExpr("*", "1 AS component_id", "2 AS member", "3 AS bands")
    out = op.near_duplicates(frame).collect()
    assert len(out) == 6
    assert sorted((r.doc_id, r.component_id, r.kept) for r in out if r.doc_id is not None) == [
        (4, 4, True), (5, 5, True), (5, 5, True), (7, 5, False)]
    assert [(r.component_id, r.kept) for r in out if r.doc_id is None] == [(None, True)] * 2
    assert op.near_duplicates(docs(spark, [])).count() == 0


def test_very_long_text(spark):
    text = " ".join(f"w{k % 50021}" for k in range(200_000))
    got = result(spark, [(1, text), (2, text + " end"), (3, "other words that stand alone here")])
    assert [got[i].component_id for i in (1, 2, 3)] == [1, 1, 3]


def test_signature_estimates_similarity():
    r = np.random.default_rng(5)
    shared = r.integers(0, 2**63, 800, dtype=np.uint64)
    sets = [np.concatenate((shared, r.integers(0, 2**63, 100, dtype=np.uint64))) for _ in range(2)]
    first = np.array([0, 900, 1800])
    signature = op.signatures(np.concatenate(sets), first, 400)
    assert abs((signature[0] == signature[1]).mean() - 0.8) < 0.08
    assert len(np.unique(signature[0])) > 300  # shifted permutations pick different shingles


@pytest.mark.parametrize("texts", [["A b\tC", None, "", "é É ß", " x "], [""], ["a" * 70000, "b c"]])
def test_words_and_shingles(texts):
    found = W.words_of(pa.array(texts, pa.string()))
    assert found.counts.tolist() == [len(words(t)) for t in texts]
    seen = {}
    for row, text in enumerate(texts):
        for h, w in zip(found.hashes[found.first[row] : found.first[row + 1]], words(text), strict=True):
            assert seen.setdefault(w, h) == h
    assert len(set(seen.values())) == len(seen)


def test_components_of_a_chain_and_a_star(spark):
    chain = [(k, k + 1) for k in range(30)]
    star = [(100, k) for k in range(101, 150)]
    links = spark.createDataFrame([*chain, *star, (None, 3), (200, 200)], "a long, b long")
    got = {r.node: r.component for r in connected_components(links).collect()}
    assert got == {k: 0 for k in range(31)} | {k: 100 for k in range(100, 150)} | {200: 200}
