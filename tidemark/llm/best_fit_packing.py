"""Best-fit packing of tokenised documents by exact complements.

How pieces go together depends on their lengths alone, and there are at most ``capacity`` lengths.
So the plan is made from a histogram of lengths, whose size does not depend on the data:

1. From the longest length down, single lengths, then pairs, then triples that exactly fill the
   gap are looked up in an index of available sums, and as many sequences of that kind are made as
   the counts allow.
2. What is left is placed best-fit, longest first, again for all pieces of a length at once.

The plan says for every length which of its pieces, by rank, go to which sequences and offsets.
Pieces are ranked per length and task that cut them, so a frequent length is spread over as many
tasks as the texts were.

Ids are those of the tokenizer as its file has it: added tokens such as ``<|endoftext|>`` that stand
in a text get their own id. Texts that hold one are encoded whole.

Rows: a null text is empty and packs as the lone end id. Rows that repeat an id are separate
documents. Null ids are kept. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import os
import re
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm import words as W
from tidemark.llm.common import map_batches, slices, stored, worker_cache

CAPACITY = 2048
END_ID = 0
SLICE_BYTES = 2 << 20
KNOWN_PIECES = 1_000_000
"""Pieces of text whose ids a worker remembers before it starts afresh."""
ENCODED_TOGETHER = 4096

# Where the split rule of this tokenizer family (words with one leading blank, runs of digits, of
# other signs, of white space, English contractions) always ends a token, texts are cut:
# before a blank that begins a word, and between a Latin letter and an ASCII sign, except
# where a blank, an apostrophe or the end of a longer white space precedes the letter.
# Texts with a blank at the end or before white space are encoded whole.
_NO_CUT = re.compile(r" (?:\s|\Z)")
_LETTER, _SIGN, _APOSTROPHE, _BLANK, _WHITE = 1, 2, 4, 8, 16


def _kinds() -> np.ndarray:
    kinds = np.zeros(256, np.uint8)
    kinds[0x21:0x7F] = _SIGN
    kinds[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] = _LETTER
    kinds[0xC3:0xCA] = _LETTER  # first bytes of U+00C0 to U+027F
    kinds[0x27], kinds[0x20] = _APOSTROPHE, _BLANK
    kinds[0x09:0x0E] = _WHITE
    return kinds


_KINDS = _kinds()


def _cut_places(data: np.ndarray) -> np.ndarray:
    """Whether a piece of text begins at each byte."""
    kind = _KINDS[data]
    wide = np.flatnonzero(data[:-1] >= 0xC3)
    wide = wide[kind[wide] == _LETTER]
    # U+00D7 and U+00F7 are no letters.
    signs = wide[(data[wide] == 0xC3) & ((data[wide + 1] & 0xDF) == 0x97)]
    kind[wide + 1] = _LETTER
    kind[signs], kind[signs + 1] = 0, 0
    begins = kind == _BLANK
    before, here = kind[:-1], kind[1:]
    leaves = (here & (_SIGN | _APOSTROPHE | _WHITE)).astype(bool) & (before == _LETTER)
    enters = before == _SIGN
    after_one = (kind[:-2] & (_LETTER | _SIGN | _APOSTROPHE)).astype(bool)
    enters[1:] |= (before[1:] == _WHITE) & after_one
    begins[1:] |= leaves | (enters & (here == _LETTER))
    return begins


class Encoder:
    """Ids of whole texts; pieces of text seen before are not encoded again.

    Pieces are told apart by a 64-bit hash of their bytes: among the million that are kept at a
    time, two share one with a probability of 3 in 100 million.
    """

    def __init__(self, path: str):
        # Spark runs a task on each core; threads of the tokenizer would only get in the way.
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self._clear()

    def _clear(self):
        self.codes: dict[int, int] = {}
        self.begin, self.size = np.empty(0, np.int64), np.empty(0, np.int64)
        self.flat = np.empty(0, np.uint32)

    def _encode(self, texts: list[str]) -> list[list[int]]:
        # In parts, as the tokenizer's own results take far more room than the ids.
        out: list[list[int]] = []
        for k in range(0, len(texts), ENCODED_TOGETHER):
            part = texts[k : k + ENCODED_TOGETHER]
            out += [e.ids for e in self.tokenizer.encode_batch_fast(part, add_special_tokens=False)]
        return out

    def _learn(self, hashes: list[int], texts: list[str]):
        ids = self._encode(texts)
        sizes = np.array([len(x) for x in ids], np.int64)
        self.codes.update(zip(hashes, range(len(self.size), len(self.size) + len(ids)), strict=True))
        self.begin = np.append(self.begin, len(self.flat) + np.cumsum(sizes) - sizes)
        self.size = np.append(self.size, sizes)
        self.flat = np.append(
            self.flat, np.fromiter(chain.from_iterable(ids), np.uint32, int(sizes.sum()))
        )

    def _cut_ids(self, texts: list[str]) -> list[np.ndarray]:
        data, offsets = W.text_bytes(pa.array(texts, pa.string()))
        if not len(data):
            return [np.empty(0, np.uint32) for _ in texts]
        begins = _cut_places(data)
        begins[offsets[:-1][offsets[:-1] < offsets[1:]]] = True
        start = np.flatnonzero(begins)
        end = np.append(start[1:], len(data))
        distinct, at, where = np.unique(
            W.span_hashes(data, start, end), return_index=True, return_inverse=True
        )
        known = list(map(self.codes.get, keys := distinct.tolist()))
        new = [k for k, code in enumerate(known) if code is None]
        if new:
            if len(self.size) > KNOWN_PIECES:
                self._clear()
                new = list(range(len(keys)))
            raw = data.tobytes()
            pieces_ = [raw[start[at[k]] : end[at[k]]].decode() for k in new]
            self._learn([keys[k] for k in new], pieces_)
            known = list(map(self.codes.get, keys))
        codes = np.array(known, np.int64)[where]
        sizes = self.size[codes]
        ends = np.cumsum(sizes)
        ids = self.flat[np.arange(ends[-1]) + np.repeat(self.begin[codes] - (ends - sizes), sizes)]
        edges = np.concatenate(([0], ends))[np.searchsorted(start, offsets)]
        return [ids[a:b] for a, b in zip(edges[:-1], edges[1:], strict=True)]

    def ids(self, texts: list[str]) -> list[np.ndarray]:
        whole = [
            k for k, t in enumerate(texts) if _NO_CUT.search(t) or any(a in t for a in self.added)
        ]
        apart = set(whole)
        cut = [k for k in range(len(texts)) if k not in apart]
        out: dict[int, np.ndarray] = dict(
            zip(cut, self._cut_ids([texts[k] for k in cut]), strict=True)
        )
        if whole:
            for k, ids in zip(whole, self._encode([texts[k] for k in whole]), strict=True):
                out[k] = np.array(ids, np.uint32)
        return [out[k] for k in range(len(texts))]


def cut(total: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of a document; only the first may be shorter than the rest."""
    lead = total % capacity or capacity
    starts = [0, *range(lead, total, capacity)]
    return [(s, (lead if s == 0 else capacity)) for s in starts]


def pieces(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, with_ids: bool = False):
    """Rows (row, doc_id, piece, start, length, ids_crc32[, ids]); ``row`` is unique per row."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = worker_cache(tokenizer_path, lambda: Encoder(tokenizer_path))
        row = TaskContext.get().partitionId() << 33
        for part in slices(batches, SLICE_BYTES, "text"):
            texts = [t or "" for t in part.column("text").to_pylist()]
            out = []
            for doc, ids in zip(part.column("doc_id").to_pylist(), encode.ids(texts), strict=True):
                ids = np.append(ids, np.uint32(END_ID)).astype("<u4")
                for number, (start, length) in enumerate(cut(len(ids), capacity)):
                    own = ids[start : start + length]
                    out.append((row, doc, number, start, length, zlib.crc32(own.tobytes())))
                    if with_ids:
                        out[-1] += (own,)
                    row += 1
            names = ["row", "doc_id", "piece", "start", "length", "ids_crc32", "ids"]
            kinds = [pa.int64(), pa.int64(), pa.int32()] + [pa.int64()] * 3 + [pa.list_(pa.int64())]
            columns = list(zip(*out, strict=True))
            yield pa.record_batch(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=False)],
                names=names[: len(columns)],
            )

    schema = "row long, doc_id long, piece int, start long, length long, ids_crc32 long"
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    schema += ", ids array<long>" if with_ids else ""
    return map_batches(rows, work, schema, cache=tokenizer_path)


class _Sums:
    """Which single, pair and triple sums of available lengths exist."""

    def __init__(self, counts: np.ndarray):
        self.counts = counts
        self._pairs: np.ndarray | None = None

    def take(self, lengths: tuple[int, ...], times: int):
        for length in lengths:
            self.counts[length] -= times
        if any(not self.counts[length] for length in lengths):
            self._pairs = None

    def times(self, lengths: tuple[int, ...]) -> int:
        """How often these lengths can be taken together."""
        return min(int(self.counts[x]) // lengths.count(x) for x in lengths)

    def _pair_sums(self) -> np.ndarray:
        if self._pairs is None:
            have = (self.counts > 0).astype(np.float64)
            size = 2 * len(have)
            spectrum = np.fft.rfft(have, size)
            self._pairs = np.fft.irfft(spectrum * spectrum, size) > 0.5
        return self._pairs

    def _pair(self, target: int, most: int, other: tuple[int, ...]):
        """The pair with the largest first length, at most ``most``, that fits beside ``other``."""
        top = min(most, target - 1)
        a = np.arange(top, (target - 1) // 2, -1)
        a = a[(self.counts[a] > 0) & (self.counts[target - a] > 0)] if len(a) else a
        for x in a:
            if self.times((*other, int(x), target - int(x))):
                return int(x), target - int(x)
        return None

    def fill(self, length: int, gap: int) -> tuple[int, ...] | None:
        """One, two or three available lengths that fill ``gap`` exactly beside ``length``."""
        if self.counts[gap] and self.times((length, gap)):
            return (gap,)
        if gap >= 2 and (pair := self._pair(gap, gap, (length,))):
            return pair
        if gap >= 3:
            sums = self._pair_sums()
            a = np.arange(gap - 2, (gap - 1) // 3, -1)
            for x in a[(self.counts[a] > 0) & sums[gap - a]]:
                if pair := self._pair(gap - int(x), int(x), (length, int(x))):
                    return (int(x), *pair)
        return None


def plan(histogram: dict[int, int], capacity: int = CAPACITY) -> np.ndarray:
    """Rows (length, from rank, each, first sequence, offset) for lengths below ``capacity``.

    Pieces of ``length`` from that rank up to the next row's go ``each`` to a sequence, side by
    side from ``offset``, to consecutive sequences. The number of rows depends on ``capacity``.
    """
    counts = np.zeros(capacity + 1, np.int64)
    for length, n in histogram.items():
        if 0 < length < capacity:
            counts[length] = n
    kinds: list[tuple[dict[int, int], int]] = []  # lengths of one sequence, how many sequences
    sums = _Sums(counts)
    for length in range(capacity - 1, 0, -1):
        while counts[length] and (rest := sums.fill(length, capacity - length)):
            lengths = (length, *rest)
            times = sums.times(lengths)
            sums.take(lengths, times)
            kinds.append(({x: lengths.count(x) for x in lengths}, times))
    open_by_gap: dict[int, list[tuple[dict[int, int], int]]] = {}
    for length in range(capacity - 1, 0, -1):
        left = int(counts[length])
        while left:
            gap = min((g for g, some in open_by_gap.items() if some and g >= length), default=0)
            if gap:
                lengths, times = open_by_gap[gap].pop()
            else:
                gap, lengths, times = capacity, {}, left
            each = gap // length
            if left < each:
                each = left
            used = min(times, left // each)
            if gap < capacity and used < times:
                open_by_gap[gap].append((lengths, times - used))
            left -= used * each
            now = gap - each * length
            open_by_gap.setdefault(now, []).append((lengths | {length: each}, used))
    kinds += [kind for some in open_by_gap.values() for kind in some]
    rank = np.zeros(capacity + 1, np.int64)
    rows, sequence = [], 0
    for lengths, times in kinds:
        offset = 0
        for length, each in lengths.items():
            rows.append((length, rank[length], each, sequence, offset))
            rank[length] += each * times
            offset += each * length
        sequence += times
    return np.array(sorted(rows), np.int64).reshape(-1, 5)


def _place(layout):
    names = ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = layout.value
        keys = (rows[:, 0] << 48) + rows[:, 1]
        for batch in batches:
            length, rank = (batch.column(c).to_numpy() for c in ("length", "rank"))
            at = rows[np.searchsorted(keys, (length << 48) + rank, "right") - 1]
            nth = rank - at[:, 1]
            sequence = at[:, 3] + nth // at[:, 2]
            offset = at[:, 4] + nth % at[:, 2] * length
            kept = [batch.column(c) for c in names[:5]]
            yield pa.record_batch([*kept, pa.array(sequence), pa.array(offset)], names=names)

    return work


def pack(pieces_: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """Adds sequence_id and offset to stored rows of :func:`pieces`."""
    columns = ["doc_id", "piece", "start", "length", "ids_crc32"]
    kinds = pieces_.where(F.col("length") < capacity).groupBy("length").count()
    histogram = {r["length"]: r["count"] for r in kinds.collect()}  # below capacity rows
    layout = pieces_.sparkSession.sparkContext.broadcast(plan(histogram, capacity))
    # A piece as long as a sequence is one; its own row number names it, below all others.
    alone = pieces_.where(F.col("length") == capacity).select(
        *columns, (-1 - F.col("row")).alias("sequence_id"), F.lit(0).cast("long").alias("offset")
    )
    short = pieces_.where(F.col("length") < capacity).withColumn(
        "part", F.shiftright("row", 33).cast("int")
    )
    earlier = Window.partitionBy("length").orderBy("part").rowsBetween(
        Window.unboundedPreceding, -1
    )
    before = (
        short.groupBy("length", "part")
        .agg(F.count(F.lit(1)).alias("n"))
        .select("length", "part", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))
    )
    within = F.row_number().over(Window.partitionBy("length", "part").orderBy("row"))
    ranked = (
        short.withColumn("within", within)
        .join(before, ["length", "part"])
        .select(*columns, (F.col("before") + F.col("within") - 1).alias("rank"))
    )
    schema = (
        "doc_id long, piece int, start long, length long, ids_crc32 long, "
        "sequence_id long, offset long"
    )
    return map_batches(ranked, _place(layout), schema).unionByName(alone)


def pack_documents(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY) -> DataFrame:
    """Rows (doc_id, piece, start, length, ids_crc32, sequence_id, offset) for (doc_id, text)."""
    return pack(stored(pieces(docs, tokenizer_path, capacity), "pieces"), capacity)
