"""Benchmark decontamination: BM25 with block-max WAND, then question and answer overlap.

The index holds the test items; the training passages are the queries. A passage is a window of
twice as many words as the longest item of an index, taken at every such length, so each copy of
an item lies whole inside one passage. Items are indexed by length class, so a long item does
not widen the passages for short ones.

An item's threshold is a share of the score it gets from its own text. Impacts are divided by the
threshold of their item, so an item is above its threshold if its impacts sum to 1 or more.
Retrieval is exact: every item at or above 1 is found. First, for a whole run of passages in
numpy, the block maxima of a passage's distinct terms are summed per block of items, which sorts
out passages that no block can satisfy. Block-max WAND then runs for the passages that remain.

A hit counts as contamination if of both halves of the item, question and answer, a share of the
word 5-grams stands in the passage. An item has one text: the question ends with the sentence
that ends nearest to its middle, or in the middle if no sentence ends inside.

The items are taken in blocks of at most ``ITEMS`` by id hash, each indexed on the driver (its
size is bounded) and broadcast. The term statistics and the window of a length class are those of
all items, counted in Spark if there is more than one block, so hits do not depend on the blocks.
Training texts pass once per block and are never shuffled.

Rows: null or empty texts hit nothing, on either side. Repeated items are reported each; repeated
documents too. Null ids are kept. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import math
import re
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import words as W
from tidemark.llm.common import map_batches, slices, stored

ITEMS = 50_000
BLOCK = 4
K1, B = 1.2, 0.75
GRAM = 5
SHORTEST_WINDOW = 32
SLICE_BYTES = 2 << 20

_SENTENCE_END = re.compile(r"[.!?\n]")


def _words(texts: list[str | None]) -> W.Words:
    return W.words_of(pa.array(texts, pa.string()), split_at_marks=True)


def split_item(text: str) -> tuple[str, str]:
    """Question and answer."""
    middle = len(text) / 2
    ends = [m.end() for m in _SENTENCE_END.finditer(text) if text[m.end() :].strip(" .!?\n")]
    ends = [e for e in ends if text[:e].strip(" .!?\n")]
    if ends:
        at = min(ends, key=lambda e: abs(e - middle))
    else:
        at = text.rfind(" ", 0, int(middle) + 1)
        at = at if at > 0 else int(middle)
    return text[:at], text[at:]


def _grams(hashes: np.ndarray, width: int) -> np.ndarray:
    n = len(hashes) - width + 1
    rolled = np.zeros(max(0, n), np.uint64)
    for j in range(width):
        rolled = rolled * W._GRAM + hashes[j : j + len(rolled)]
    return np.unique(rolled)


@dataclass
class _Half:
    width: int
    grams: np.ndarray

    def share(self, passage: np.ndarray) -> float:
        if not len(self.grams):
            return 1.0
        found = np.isin(self.grams, _grams(passage, self.width), assume_unique=True)
        return float(found.mean())


def _half(text: str) -> _Half:
    hashes = _words([text]).hashes
    width = min(GRAM, len(hashes))
    return _Half(width, _grams(hashes, width) if width else hashes)


@dataclass
class _Statistics:
    """Of all items of a length class; ``df`` for the sorted ``terms``, those of one block or more."""

    n: int
    mean: float
    longest: int
    terms: np.ndarray
    df: np.ndarray


class ItemIndex:
    """Inverted index, with block maxima, of the items of one length class.

    ``of_all`` has the statistics of all items, if these are only some of them.
    """

    def __init__(self, ids: list, texts: list[str], share: float, of_all: _Statistics | None = None):
        self.ids = ids
        words = _words(texts)
        counts = words.counts
        self.halves = [tuple(map(_half, split_item(t))) for t in texts]
        n = len(ids)
        owner = words.rows()
        key, where = np.unique(words.hashes, return_inverse=True)
        entry, tf = np.unique(where * n + owner, return_counts=True)
        term, item = entry // n, entry % n
        df = np.bincount(term, minlength=len(key))
        if of_all is None:
            of_all = _Statistics(n, counts.mean(), int(counts.max()), key, df)
        self.stride = max(SHORTEST_WINDOW, of_all.longest)
        df_all = of_all.df[np.searchsorted(of_all.terms, key)]
        idf = np.log1p((of_all.n - df_all + 0.5) / (df_all + 0.5))
        length = K1 * (1 - B + B * counts / of_all.mean)
        impact = idf[term] * tf * (K1 + 1) / (tf + length[item])
        own = np.bincount(item, impact, minlength=n)
        impact = impact / (share * own[item])
        self.terms = key
        self.begin = np.concatenate(([0], np.cumsum(df)))
        self.items, self.impacts = item, impact
        self.most = np.maximum.reduceat(impact, self.begin[:-1])
        # Block maxima of each term, and the postings and maxima for WAND as plain lists.
        block = term * (n // BLOCK + 1) + item // BLOCK
        edge = np.flatnonzero(np.concatenate(([True], block[1:] != block[:-1])))
        self.block_of = (item // BLOCK)[edge]
        self.block_most = np.maximum.reduceat(impact, edge)
        self.block_begin = np.searchsorted(edge, self.begin)
        self.blocks = n // BLOCK + 1
        self.postings = [
            (item[a:b].tolist(), impact[a:b].tolist())
            for a, b in zip(self.begin[:-1], self.begin[1:], strict=True)
        ]
        self.block_lists = [
            dict(zip(self.block_of[a:b].tolist(), self.block_most[a:b].tolist(), strict=True))
            for a, b in zip(self.block_begin[:-1], self.block_begin[1:], strict=True)
        ]

    def windows(self, counts: np.ndarray, first: np.ndarray):
        """Row, begin and end of the passages of texts with these word counts."""
        n = np.where(counts > 0, np.maximum(1, -(-counts // self.stride) - 1), 0)
        row = np.repeat(np.arange(len(counts)), n)
        nth = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        begin = first[row] + nth * self.stride
        return row, begin, np.minimum(begin + 2 * self.stride, first[row + 1])

    def possible(self, term: np.ndarray, begin: np.ndarray, end: np.ndarray):
        """Passages with a block whose upper bound reaches 1, each with its distinct terms.

        ``term`` is -1 for words that are in no item.
        """
        known = np.flatnonzero(term >= 0)
        lo, hi = np.searchsorted(known, begin), np.searchsorted(known, end)
        step = max(1, 4_000_000 // (256 + self.blocks))
        for a in range(0, len(begin), step):
            n = (hi - lo)[a : a + step]
            passage = np.repeat(np.arange(len(n)), n)
            at = np.arange(n.sum()) + np.repeat(lo[a : a + step] - (np.cumsum(n) - n), n)
            passage, own = np.divmod(
                np.unique(passage * len(self.terms) + term[known[at]]), len(self.terms)
            )
            m = self.block_begin[own + 1] - self.block_begin[own]
            entry = np.arange(m.sum()) + np.repeat(self.block_begin[own] - (np.cumsum(m) - m), m)
            cell = np.repeat(passage, m) * self.blocks + self.block_of[entry]
            sums = np.bincount(cell, self.block_most[entry], minlength=len(n) * self.blocks)
            most = sums.reshape(len(n), self.blocks).max(axis=1)
            edge = np.searchsorted(passage, np.arange(len(n) + 1))
            for k in np.flatnonzero(most >= 1 - 1e-9):
                yield a + int(k), own[edge[k] : edge[k + 1]].tolist()

    def wand(self, terms: list[int]) -> list[tuple[int, float]]:
        """Items whose impacts for these distinct terms sum to 1 or more, by block-max WAND."""
        limit, found = 1 - 1e-9, []
        most, lists = self.most, self.block_lists
        cursors = [[self.postings[t][0][0], 0, t] for t in terms]
        while cursors:
            cursors.sort()
            bound, pivot = 0.0, -1
            for k, (_, _, t) in enumerate(cursors):
                bound += most[t]
                if bound >= limit:
                    pivot = k
                    break
            if pivot < 0:
                break
            item = cursors[pivot][0]
            while pivot + 1 < len(cursors) and cursors[pivot + 1][0] == item:
                pivot += 1
            block = item // BLOCK
            if sum(lists[t].get(block, 0.0) for _, _, t in cursors[: pivot + 1]) < limit:
                target = (block + 1) * BLOCK
                if pivot + 1 < len(cursors):
                    target = min(target, cursors[pivot + 1][0])
                moved = range(pivot + 1)
            elif cursors[0][0] == item:
                score = sum(self.postings[t][1][at] for _, at, t in cursors[: pivot + 1])
                if score >= limit:
                    found.append((item, score))
                target, moved = item + 1, range(pivot + 1)
            else:
                target = item
                moved = [k for k in range(pivot + 1) if cursors[k][0] < item]
            for k in moved:
                items = self.postings[cursors[k][2]][0]
                at = bisect_left(items, target, cursors[k][1])
                cursors[k][0] = items[at] if at < len(items) else math.inf
                cursors[k][1] = at
            cursors = [c for c in cursors if c[0] != math.inf]
        return found

    def hits(self, words: W.Words, overlap: float):
        """(row, item, score, question share, answer share, first word), the best per row and item."""
        place = np.minimum(np.searchsorted(self.terms, words.hashes), len(self.terms) - 1)
        term = np.where(self.terms[place] == words.hashes, place, -1)
        row, begin, end = self.windows(words.counts, words.first)
        best: dict[tuple[int, int], tuple] = {}
        for k, own in self.possible(term, begin, end):
            for item, score in self.wand(own):
                passage = words.hashes[begin[k] : end[k]]
                question, answer = (h.share(passage) for h in self.halves[item])
                if question >= overlap and answer >= overlap:
                    key = (int(row[k]), item)
                    new = (score, question, answer, int(begin[k] - words.first[row[k]]))
                    best[key] = max(best.get(key, new), new)
        return [(r, i, *rest) for (r, i), rest in sorted(best.items())]


def _size(n_words: int) -> int:
    """The length class: one for each power of two of the number of words."""
    return max(SHORTEST_WINDOW, int(n_words)).bit_length()


def build_indexes(
    ids: list, texts: list[str | None], share: float, of_all: dict[int, _Statistics] | None = None
) -> list[ItemIndex]:
    """One index for each length class; ``of_all`` has the statistics of all items by class."""
    classes: dict[int, list[int]] = {}
    for k, n in enumerate(_words(texts).counts):
        if n:
            classes.setdefault(_size(n), []).append(k)
    return [
        ItemIndex([ids[k] for k in own], [texts[k] for k in own], share, of_all and of_all[size])
        for size, own in sorted(classes.items())
    ]


def _item_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Length class, number of words and distinct terms of every item with words."""
    for part in slices(batches, SLICE_BYTES, "text"):
        words = W.words_of(part.column("text"), split_at_marks=True)
        some = np.flatnonzero(words.counts)
        terms = [
            np.unique(words.hashes[words.first[k] : words.first[k + 1]]).view(np.int64) for k in some
        ]
        yield pa.record_batch(
            [
                part.column("block").take(pa.array(some)),
                pa.array([_size(words.counts[k]) for k in some], pa.int32()),
                pa.array(words.counts[some], pa.int64()),
                pa.array(terms, pa.list_(pa.int64())),
            ],
            names=["block", "size", "n_words", "terms"],
        )


def _item_blocks(items: DataFrame, share: float) -> Iterator[list[ItemIndex]]:
    items = items.select("item_id", "text").where("text IS NOT NULL")
    blocks = max(1, math.ceil(items.count() / ITEMS))
    part = F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)).cast("int")
    items = items.withColumn("block", part)
    if blocks > 1:
        found = map_batches(
            items.select("block", "text"),
            _item_terms,
            "block int, size int, n_words long, terms array<long>",
        )
        found = stored(found, "item-terms")
        sizes = found.groupBy("size").agg(
            F.count(F.lit(1)).alias("n"), F.sum("n_words").alias("s"), F.max("n_words").alias("m")
        ).collect()  # one row for each power of two
        each = found.select("block", "size", F.explode("terms").alias("term"))
        df = stored(each.groupBy("size", "term").agg(F.count(F.lit(1)).alias("df")), "item-df")
    for block in range(blocks):
        of_all = None
        if blocks > 1:
            own = each.where(F.col("block") == block).select("size", "term").distinct()
            own = own.join(df, ["size", "term"]).select("size", "term", "df").toArrow()
            size, term, n = (own.column(k).to_numpy() for k in range(3))
            of_all = {}
            for row in sizes:
                mine = size == row["size"]
                key, order = np.unique(term[mine].view(np.uint64), return_index=True)
                of_all[row["size"]] = _Statistics(row.n, row.s / row.n, row.m, key, n[mine][order])
        rows = items.where(F.col("block") == block).select("item_id", "text").toArrow()
        yield build_indexes(rows.column(0).to_pylist(), rows.column(1).to_pylist(), share, of_all)


def find_leaks(
    docs: DataFrame, items: DataFrame, share: float = 0.5, overlap: float = 0.5
) -> DataFrame:
    """Rows (doc_id, item_id, score, question_overlap, answer_overlap, first_word).

    One for every document (doc_id, text) and test item (item_id, text) that it contains, with the
    best passage. ``score`` is BM25 as a share of what the item gets from its own text.
    """
    names = ["doc_id", "item_id", "score", "question_overlap", "answer_overlap", "first_word"]
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    spark, found = docs.sparkSession, []
    for indexes in _item_blocks(items, share):
        shared = spark.sparkContext.broadcast(indexes)

        def work(batches, shared=shared):
            for part in slices(batches, SLICE_BYTES, "text"):
                words = W.words_of(part.column("text"), split_at_marks=True)
                docs_ = part.column("doc_id")
                rows = [
                    (docs_[r].as_py(), index.ids[i], s * share, q, a, w)
                    for index in shared.value
                    for r, i, s, q, a, w in index.hits(words, overlap)
                ]
                if rows:
                    kinds = [pa.int64()] * 2 + [pa.float64()] * 3 + [pa.int64()]
                    yield pa.record_batch(
                        [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)],
                        names=names,
                    )

        schema = (
            "doc_id long, item_id long, score double, question_overlap double, "
            "answer_overlap double, first_word long"
        )
        found.append(map_batches(docs, work, schema))
    out = found[0]
    for more in found[1:]:
        out = out.unionByName(more)
    return out


def without_leaks(
    docs: DataFrame, items: DataFrame, share: float = 0.5, overlap: float = 0.5
) -> DataFrame:
    """The rows of ``docs``, all columns, whose text contains no test item."""
    for indexes in _item_blocks(items, share):
        shared = docs.sparkSession.sparkContext.broadcast(indexes)

        def work(batches, shared=shared):
            for part in slices(batches, SLICE_BYTES, "text"):
                words = W.words_of(part.column("text"), split_at_marks=True)
                keep = np.ones(part.num_rows, bool)
                for index in shared.value:
                    for hit in index.hits(words, overlap):
                        keep[hit[0]] = False
                yield part.filter(pa.array(keep))

        docs = map_batches(docs, work, docs.schema)
    return docs
