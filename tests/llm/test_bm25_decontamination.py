import random

import numpy as np
from brute import table_rows

from tidemark.llm import bm25_decontamination as op

DOCS, ITEMS = "doc_id long, text string", "item_id long, text string"


def frames(spark, docs, items):
    return spark.createDataFrame(docs, DOCS), spark.createDataFrame(items, ITEMS)


def hits(spark, docs, items, **settings):
    return {(r.doc_id, r.item_id): r for r in op.find_leaks(*frames(spark, docs, items), **settings).collect()}


def sample(r, n):
    return " ".join(f"w{r.randrange(4000)}" for _ in range(n))


def test_source_table_equals_text_search(spark):
    sf = "/root/testdata/sf0.01"
    docs = [(r.doc_id, r.text) for r in table_rows(spark, "documents", sf)]
    items = [(r.item_id, r.text) for r in table_rows(spark, "benchmark", sf)]
    want = {(d, i) for d, text in docs for i, item in items if item in text}
    assert want and set(hits(spark, docs, items)) == want


def test_wand_finds_what_adding_up_all_postings_finds():
    r = random.Random(4)
    texts = [sample(r, r.randrange(5, 60)) for _ in range(150)]
    for index in op.build_indexes(list(range(150)), texts, 0.5):
        for _ in range(200):
            terms = sorted(r.sample(range(len(index.terms)), min(len(index.terms), r.randrange(1, 200))))
            sums = {}
            for t in terms:
                for item, impact in zip(*index.postings[t], strict=True):
                    sums[item] = sums.get(item, 0) + impact
            want = {i: s for i, s in sums.items() if s >= 1 - 1e-9}
            got = dict(index.wand(terms))
            assert got.keys() == want.keys()
            assert all(abs(got[i] - want[i]) < 1e-9 for i in want)


def test_block_bound_loses_no_passage():
    r = random.Random(6)
    texts = [sample(r, 30) for _ in range(90)]
    (index,) = op.build_indexes(list(range(90)), texts, 0.5)
    docs = [sample(r, 50) + " " + texts[k] + " " + sample(r, 20) for k in range(90)]
    words = op._words(docs)
    place = np.minimum(np.searchsorted(index.terms, words.hashes), len(index.terms) - 1)
    term = np.where(index.terms[place] == words.hashes, place, -1)
    _, begin, end = index.windows(words.counts, words.first)
    possible = {k for k, _ in index.possible(term, begin, end)}
    for k in range(len(begin)):
        own = term[begin[k] : end[k]]
        if index.wand(np.unique(own[own >= 0]).tolist()):
            assert k in possible


def test_every_copy_lies_whole_in_a_passage(spark):
    r = random.Random(7)
    items = [(1, sample(r, 30)), (2, sample(r, 400)), (3, sample(r, 7) + ". " + sample(r, 6))]
    docs = [(10 * shift + i, sample(r, shift) + "\n" + text.upper() + "!  " + sample(r, 90))
            for shift in (0, 1, 17, 63, 200) for i, text in items]
    assert set(hits(spark, docs, items)) == {(d, d % 10) for d, _ in docs}


def test_question_alone_is_no_leak(spark):
    r = random.Random(8)
    question, answer = sample(r, 25) + "?", sample(r, 25)
    item = (1, f"{question} {answer}")
    assert op.split_item(item[1])[0] == question
    got = hits(spark, [(1, sample(r, 99) + " " + question), (2, question + " " + answer), (3, answer)],
               [item], share=0.3)
    assert set(got) == {(2, 1)}
    one = got[2, 1]
    assert one.question_overlap == one.answer_overlap == 1 and abs(one.score - 1) < 1e-9


def test_odd_rows(spark):
    text = "what is the name of the river. it is the long river of the north"
    docs = [(1, None), (2, ""), (None, text), (4, text), (4, text), (5, "the " * 5000)]
    items = [(7, text), (7, text), (8, None), (9, ""), (None, "a b c d e f g h i j")]
    docs_, items_ = frames(spark, docs, items)
    docs_ = docs_.selectExpr("*", "1 AS item_id", "2 AS score")
    got = sorted((r.doc_id or 0, r.item_id) for r in op.find_leaks(docs_, items_).collect())
    assert got == [(0, 7)] * 2 + [(4, 7)] * 4
    left = op.without_leaks(docs_, items_)
    assert left.columns == docs_.columns and sorted(r.doc_id for r in left.collect()) == [1, 2, 5]
    assert op.find_leaks(docs_, items_.limit(0)).count() == 0
    assert op.without_leaks(docs_.limit(0), items_).count() == 0


def test_items_in_several_blocks(spark, monkeypatch):
    monkeypatch.setattr(op, "ITEMS", 10)
    r = random.Random(9)
    items = [(k, sample(r, 20)) for k in range(35)]
    docs = [(k, sample(r, 40) + " " + items[k][1]) for k in range(35)]
    assert set(hits(spark, docs, items)) == {(k, k) for k in range(35)}


def test_blocks_use_the_statistics_of_all_items(spark, monkeypatch):
    """Near copies, and items of different lengths, give the same hits in one block and in several."""
    r = random.Random(3)
    items = [
        (k, " ".join(f"w{int(r.paretovariate(0.7)) % 400}" for _ in range(r.randrange(8, 60)))) for k in range(80)
    ]
    docs = []
    for k, text in items:
        own = text.split()
        for i in range(0, len(own), 9):
            own[i] = "other"
        docs.append((k, " ".join([f"x{j}" for j in range(k % 50)] + own)))
    frames = spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")
    hits = []
    for limit in (1000, 9):
        monkeypatch.setattr(op, "ITEMS", limit)
        rows = op.find_leaks(*frames, overlap=0.1).collect()
        hits.append({(h.doc_id, h.item_id, h.first_word): h.score for h in rows})
    assert hits[0] and hits[0].keys() == hits[1].keys()
    assert all(abs(hits[0][k] - hits[1][k]) < 1e-9 for k in hits[0])
