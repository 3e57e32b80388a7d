"""Scoring with a log-frequency Bloom filter that holds quantised n-gram counts.

Training, over all training texts:

* every task reduces its texts to distinct words with counts, packed by hash into shards; a second
  task per shard adds them up. The same is done for word pairs. The number of shards follows the
  corpus, and one frequent word is at most one entry per task, so shards stay even and bounded.
* a count c is kept as the level of the largest step not above it. The filter holds the n-gram
  with each number from 1 to its level; asking for level 1, 2, ... until the answer is no gives
  the level back. Each shard has a filter segment of its own, sized by its entries. No n-gram is
  left out.

Scoring: the filter and the exact counts of the ``FREQUENT`` most frequent words are broadcast.
The second has a fixed size. The first is measured: segments go out in groups of at most
``FILTER_BYTES``. One pass over the texts asks all groups: a task gathers the n-grams of a run of
texts, takes one group after the other into memory, asks it for the n-grams of its shards, and
notes the levels of words and pairs beside the texts. The fit and the scores read them there, so
they are the same, and take the same two passes, however many groups there are. Counts of all
other words, for the exact base score, are joined by word.

The model: p(w | h) = k(h) min(1, c(h w) / c(h)) + (1 - k(h)) p(w), with p(w) the add-one estimate
and k(h) one weight per level of c(h), fitted on all training texts, each scored with its own
counts taken out, in a pass before the scoring.
Counts in numerators are rounded down and those below up. The end of a text is a token, and the
history of its first word.

Rows: a null text is empty and consists of the end alone. Rows that repeat an id are scored one by
one; a null id counts as empty text in the split. An empty training side gives N = 0, V = 0 and
probability 1 for each token. Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import words as W
from tidemark.llm.common import id_remainder, map_batches, slices, stored

SLICE_BYTES = 1 << 20
FREQUENT = 1 << 16
FILTER_BYTES = 128 << 20
ENTRIES_PER_SHARD = 1_500_000
BITS_PER_ENTRY = 10
PROBES = 4
SEGMENT_RUN = 1 << 18
RUN_BYTES = 8 << 20
RUN_BYTES_OF_GROUPS = 32 << 20
"""Texts asked about together; more where groups have to be taken into memory again for each run."""
ASKED = 1 << 15
"""N-grams asked about at once: with the segment they fall into, they stay in a processor's cache."""
STEP = 1.25
"""Ratio of two count levels; small counts are exact."""

END = W.mix(np.array([0x5EED], np.uint64))[0]


def _levels() -> np.ndarray:
    """The least count of every level; level numbers are places in this array."""
    steps = [0, 1]
    while steps[-1] < 1 << 50:
        steps.append(max(steps[-1] + 1, int(steps[-1] * STEP)))
    return np.array(steps, np.int64)


LEVELS = _levels()


def level_of(counts: np.ndarray) -> np.ndarray:
    return np.searchsorted(LEVELS, counts, "right") - 1


def tokens_of(texts: pa.Array) -> W.Words:
    """Word hashes of every text with its end token appended."""
    words = W.words_of(texts)
    n = len(words.first) - 1
    first = words.first + np.arange(n + 1)
    out = np.empty(first[-1], np.uint64)
    last = first[1:] - 1
    is_word = np.ones(len(out), bool)
    is_word[last] = False
    out[is_word] = words.hashes
    out[last] = END
    return W.Words(out, first)


def _joined(parts: list[W.Words]) -> W.Words:
    first = np.cumsum(np.concatenate([[0], *(part.counts for part in parts)]))
    return W.Words(np.concatenate([part.hashes for part in parts]), first)


def histories(tokens: W.Words) -> np.ndarray:
    """The token before each; the end token stands before the first of a text."""
    before = np.empty_like(tokens.hashes)
    before[1:] = tokens.hashes[:-1]
    before[tokens.first[:-1]] = END
    return before


def pairs(before: np.ndarray, token: np.ndarray) -> np.ndarray:
    return W.mix(before * W._GRAM + token)


def _merged(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    key, count = np.concatenate(keys), np.concatenate(counts)
    order = np.argsort(key, kind="stable")
    key, count = key[order], count[order]
    begin = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
    return key[begin], np.add.reduceat(count, begin)


def _shard(keys: np.ndarray, shards: int) -> np.ndarray:
    return ((keys >> np.uint64(32)) * np.uint64(shards) >> np.uint64(32)).astype(np.int64)


def _packed(order: int, shards: int):
    """Distinct n-grams of a task with their counts, one row per shard."""
    hold = 1 << 20  # n-grams gathered before they are merged

    def rows(keys, counts):
        key, count = _merged(keys, counts)
        edge = np.searchsorted(_shard(key, shards), np.arange(shards + 1))
        some = np.flatnonzero(np.diff(edge))
        return pa.record_batch(
            [
                pa.array(some.astype(np.int32)),
                pa.array([key[edge[s] : edge[s + 1]].tobytes() for s in some], pa.binary()),
                pa.array(
                    [count[edge[s] : edge[s + 1]].astype("<u4").tobytes() for s in some],
                    pa.binary(),
                ),
            ],
            names=["shard", "keys", "counts"],
        )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, counts, held = [], [], 0
        for part in slices(batches, SLICE_BYTES, "text"):
            tokens = tokens_of(part.column("text"))
            grams = tokens.hashes if order == 1 else pairs(histories(tokens), tokens.hashes)
            key, count = np.unique(grams, return_counts=True)
            keys.append(key)
            counts.append(count)
            held += len(key)
            if held > hold:
                yield rows(keys, counts)
                keys, counts, held = [], [], 0
        if keys:
            yield rows(keys, counts)

    return work


def _by_shard(batches: Iterator[pa.RecordBatch]):
    """(shard, keys, counts) with the sums of every shard; a shard's rows come one after another."""
    current, keys, counts = None, [], []
    for batch in batches:
        for shard, key, count in zip(*batch.columns, strict=True):
            if shard.as_py() != current:
                if keys:
                    yield current, *_merged(keys, counts)
                current, keys, counts = shard.as_py(), [], []
            keys.append(np.frombuffer(key.as_buffer(), np.uint64))
            counts.append(np.frombuffer(count.as_buffer(), "<u4").astype(np.int64))
    if keys:
        yield current, *_merged(keys, counts)


def _count_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for _, key, count in _by_shard(batches):
        yield pa.record_batch(
            [pa.array(key.view(np.int64)), pa.array(count)], names=["word", "n"]
        )


def _hashes(keys: np.ndarray, levels: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each n-gram at a level: where its probes begin, and the step from one to the next."""
    one = W.mix(keys + levels.astype(np.uint64) * W._GRAM)
    return one, W.mix(one) | np.uint64(1)


def _bit(number: np.ndarray, size: np.ndarray | int) -> np.ndarray:
    """A number's bit in a segment of ``size`` bits, below 2**32: by its upper half, with no division."""
    half = np.uint64(32)
    return (((number >> half) * np.uint64(size)) >> half).view(np.int64)


def _segment(keys: np.ndarray, counts: np.ndarray) -> np.ndarray:
    level = level_of(counts)
    entry = np.repeat(np.arange(len(keys)), level)
    number = np.arange(len(entry)) - np.repeat(np.cumsum(level) - level, level) + 1
    size = max(64, int(len(entry) * BITS_PER_ENTRY + 63) // 64 * 64)
    bits = np.zeros(size, np.uint8)
    for a in range(0, len(entry), SEGMENT_RUN):  # a run at a time, to need little memory
        run = slice(a, a + SEGMENT_RUN)
        one, two = _hashes(keys[entry[run]], number[run])
        for _ in range(PROBES):
            bits[_bit(one, size)] = 1
            one += two
    return np.packbits(bits, bitorder="little")


def _segment_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for shard, key, count in _by_shard(batches):
        data = _segment(key, count).tobytes()
        yield pa.record_batch(
            [pa.array([shard], pa.int32()), pa.array([data], pa.binary())], names=["shard", "bits"]
        )


def _word_segments(shards: int):
    """Filter segments from the table of word counts, one shard's rows after another."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, keys, counts = None, [], []

        def made():
            data = _segment(np.concatenate(keys), np.concatenate(counts)).tobytes()
            return pa.record_batch(
                [pa.array([current], pa.int32()), pa.array([data], pa.binary())],
                names=["shard", "bits"],
            )

        for batch in batches:
            shard = batch.column("shard").to_numpy()
            edges = np.flatnonzero(np.diff(shard)) + 1
            for a, b in zip([0, *edges], [*edges, len(shard)], strict=True):
                if shard[a] != current:
                    if keys:
                        yield made()
                    current, keys, counts = int(shard[a]), [], []
                keys.append(batch.column("word").to_numpy()[a:b].view(np.uint64))
                counts.append(batch.column("n").to_numpy()[a:b])
        if keys:
            yield made()

    return work


class LogFrequencyFilter:
    """Segments of a filter, some of ``shards``; answers with levels."""

    def __init__(self, shards: int, segments: dict[int, bytes | memoryview]):
        self.shards = shards
        own = np.array(list(segments), np.int64)
        sizes = np.array([len(data) for data in segments.values()], np.int64)
        self.present = np.zeros(shards, bool)
        self.present[own] = True
        self.size, self.begin = np.full(shards, 64, np.int64), np.zeros(shards, np.int64)
        self.size[own] = 8 * sizes
        self.begin[own] = 8 * (np.cumsum(sizes) - sizes)
        self.bits = np.frombuffer(b"".join(segments.values()), np.uint8)

    def _set(self, number: np.ndarray, size: np.ndarray, begin: np.ndarray) -> np.ndarray:
        place = _bit(number, size) + begin
        return (self.bits[place >> 3] >> (place & 7).astype(np.uint8)) & 1 == 1

    def levels(self, keys: np.ndarray) -> np.ndarray:
        """The level of every n-gram by asking for one after another; 0 where it is absent."""
        return levels_from(keys, [lambda: self]).astype(np.int64)

    def note(self, distinct: np.ndarray, out: np.ndarray) -> None:
        """Puts the levels of sorted n-grams into ``out``, where these segments hold them."""
        own = np.flatnonzero(self.present)
        if len(own):
            first, last = (-(-(int(s) << 32) // self.shards) << 32 for s in (own[0], own[-1] + 1))
            begin = np.searchsorted(distinct, np.uint64(first))
            end = np.searchsorted(distinct, np.uint64(last)) if last < 1 << 64 else len(distinct)
            for a in range(begin, end, ASKED):
                some = slice(a, min(end, a + ASKED))
                np.maximum(out[some], self._levels(distinct[some]), out=out[some])

    def _levels(self, distinct: np.ndarray) -> np.ndarray:
        shard = _shard(distinct, self.shards)
        out = np.zeros(len(distinct), np.uint8)
        live = np.flatnonzero(self.present[shard])
        while len(live):
            one, two = _hashes(distinct[live], out[live] + 1)
            size, begin = self.size[shard[live]].astype(np.uint64), self.begin[shard[live]]
            yes = self._set(one, size, begin)
            if 2 * np.count_nonzero(yes) < len(yes):  # what the first probe denies is not asked again
                live, one, two, size, begin = (x[yes] for x in (live, one, two, size, begin))
                yes = np.ones(len(live), bool)
            for _ in range(PROBES - 1):
                one = one + two
                yes &= self._set(one, size, begin)
            live = live[yes]
            out[live] += 1
        return out


def levels_from(keys: np.ndarray, filters) -> np.ndarray:
    """The levels, below 256, of n-grams by parts of a filter that are fetched one after the other.

    N-grams are asked about in the order of their shards.
    """
    order = np.argsort(keys)
    keys = keys[order]
    new = np.ones(len(keys), bool)
    np.not_equal(keys[1:], keys[:-1], out=new[1:])
    distinct = keys[new]
    del keys  # of a run of texts, as much as all the rest
    level = np.zeros(len(distinct), np.uint8)
    for fetch in filters:
        fetch().note(distinct, level)
    out = np.empty(len(order), np.uint8)
    out[order] = np.repeat(level, np.diff(np.append(np.flatnonzero(new), len(new))))
    return out


def _in_turn(shared: list) -> list:
    """Fetches each broadcast group for its use; if there are several, the one before is dropped."""
    if len(shared) < 2:
        return [lambda group=group: group.value for group in shared]

    def fetch(group):
        for other in shared:
            vars(other).pop("_value", None)  # a worker keeps what it has read; it reads it again
        return group.value

    return [lambda group=group: fetch(group) for group in shared]


def _shards_for(entries: int) -> int:
    return max(1, math.ceil(entries / ENTRIES_PER_SHARD))


def _a_shard_a_task(rows: DataFrame, shards: int) -> DataFrame:
    """Deals rows by ``shard`` itself: its hash would put up to five shards, or more, into one task,
    which then has to hold and sort them together."""
    return rows.repartitionById(shards, "shard")


def _gathered(docs: DataFrame, order: int, shards: int, work, schema: str) -> DataFrame:
    packed = map_batches(
        docs.select("text"), _packed(order, shards), "shard int, keys binary, counts binary"
    )
    return map_batches(_a_shard_a_task(packed, shards), work, schema)


def _groups(table: DataFrame, limit: int) -> list[list[int]]:
    """Shards, in groups whose segments take at most ``limit`` bytes together."""
    sizes = table.select("shard", F.octet_length("bits").alias("n")).orderBy("shard").collect()
    groups, room = [], 0
    for row in sizes:  # one row for each 1.5 million pairs
        if not groups or row.n > room:
            groups.append([])
            room = limit
        groups[-1].append(row.shard)
        room -= row.n
    return groups


def _load(table: DataFrame, shards: int, wanted: list[int]) -> LogFrequencyFilter:
    rows = table.where(F.col("shard").isin(wanted)).select("shard", "bits").toArrow()
    bits = (memoryview(x.as_buffer()) for x in rows.column(1))
    return LogFrequencyFilter(shards, dict(zip(rows.column(0).to_pylist(), bits, strict=True)))


def _noted(part: pa.RecordBatch, column: str) -> np.ndarray:
    levels = b"".join(x.as_buffer() for x in part.column(column))
    return np.frombuffer(levels, np.uint8).astype(np.int64)


def _bytes_of(levels: np.ndarray, first: np.ndarray) -> pa.Array:
    """One byte a token, a row per text."""
    edges = pa.py_buffer((first - first[0]).astype(np.int32))
    data = pa.py_buffer(levels[first[0] : first[-1]])
    return pa.BinaryArray.from_buffers(pa.binary(), len(first) - 1, [None, edges, data])


class _Model:
    """What scoring needs of the counts; every method works on arrays of tokens.

    ``words`` is None where the levels of the tokens stand beside the texts.
    """

    def __init__(self, words: LogFrequencyFilter | None, end: int, total: int, distinct: int):
        self.words, self.end, self.total, self.distinct = words, end, total, distinct

    def word_levels(self, part: pa.RecordBatch, tokens: W.Words) -> np.ndarray:
        if self.words is not None:
            return self.words.levels(tokens.hashes)
        return _noted(part, "levels")

    def alone(self, level: np.ndarray, own=0) -> np.ndarray:
        """Probability of each token by itself."""
        return (np.maximum(LEVELS[level] - own, 0) + 1) / (self.total + self.distinct + 1)

    @staticmethod
    def ratio(pair_level: np.ndarray, history_level: np.ndarray, own=0, own_history=0):
        """c(h w) / c(h), without the counts of the text itself where they are given."""
        above = LEVELS[history_level + 1] - 1 - own_history
        return np.minimum(1, np.maximum(LEVELS[pair_level] - own, 0) / np.maximum(above, 1))

    def history_levels(self, level: np.ndarray, tokens: W.Words) -> np.ndarray:
        before = np.empty_like(level)
        before[1:] = level[:-1]
        before[tokens.first[:-1]] = self.end
        return before


def _filters(table: DataFrame, shards: int, limit: int) -> Iterator[LogFrequencyFilter]:
    for group in _groups(table, limit) or [[]]:
        yield _load(table, shards, group)


def _runs(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[list[pa.RecordBatch]]:
    """Slices of about ``limit`` bytes of text together."""
    run, size = [], 0
    for part in slices(batches, SLICE_BYTES, "text"):
        more = pc.sum(pc.binary_length(part.column("text"))).as_py() or 0
        if run and size + more > limit:
            yield run
            run, size = [], 0
        run.append(part)
        size += more
    if run:
        yield run


def _note_both(model_, *pair_groups, word_groups=()):
    """Columns of the rows, ``levels`` and ``pair_levels``, by all groups of the filters.

    ``word_groups`` are those of the words where the model does not hold them.
    """

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = model_.value.words
        word_filters = _in_turn(list(word_groups)) if words is None else [lambda: words]
        pair_filters = _in_turn(list(pair_groups))
        several = max(len(word_filters), len(pair_filters)) > 1
        for run in _runs(batches, RUN_BYTES_OF_GROUPS if several else RUN_BYTES):
            tokens = _joined([tokens_of(part.column("text")) for part in run])
            level = levels_from(tokens.hashes, word_filters)
            pair = levels_from(pairs(histories(tokens), tokens.hashes), pair_filters)
            row = 0
            for part in run:
                first = tokens.first[row : row + part.num_rows + 1]
                row += part.num_rows
                columns = {c: part.column(c) for c in ("doc_id", "text", "held_out", "row")}
                columns["levels"] = _bytes_of(level, first)
                columns["pair_levels"] = _bytes_of(pair, first)
                yield pa.record_batch(columns)

    return work


_NOTED_SCHEMA = (
    "doc_id long, text string, held_out boolean, row long, levels binary, pair_levels binary"
)


def _own_counts(keys: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """How often each key occurs in its text, given by ``rows``."""
    both = W.mix(keys + W.mix(rows.astype(np.uint64)))
    _, where, n = np.unique(both, return_inverse=True, return_counts=True)
    return n[where]


GRID = np.array([0.0, 0.02, 0.05, 0.1, 0.2, 0.3, 0.45, 0.6, 0.75, 0.9])
UNIT = 1 << 20
"""Gains are summed as whole numbers of this part of 1, so their order does not matter."""


def _gains(model_, filter_):
    """Per history level and weight of the grid: what mixing in the pairs of this group gains.

    Without ``filter_`` the levels of all pairs stand beside the texts."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, pair_filter = model_.value, filter_ and filter_.value
        gain = np.zeros((len(LEVELS), len(GRID)), np.int64)
        for part in slices(batches, SLICE_BYTES, "text"):
            tokens = tokens_of(part.column("text"))
            level = model.word_levels(part, tokens)
            own = _own_counts(tokens.hashes, tokens.rows())
            own_past = np.empty_like(own)
            own_past[1:] = own[:-1]
            own_past[tokens.first[:-1]] = 1  # the end, once in every text
            keys = pairs(histories(tokens), tokens.hashes)
            if pair_filter:
                mine = np.flatnonzero(pair_filter.present[_shard(keys, pair_filter.shards)])
                pair_level = pair_filter.levels(keys[mine])
            else:
                mine, pair_level = np.arange(len(keys)), _noted(part, "pair_levels")
            keys, before = keys[mine], model.history_levels(level, tokens)[mine]
            ratio = model.ratio(
                pair_level, before, _own_counts(keys, tokens.rows()[mine]), own_past[mine]
            )
            seen = ratio > 0
            ratio = ratio[seen] / model.alone(level[mine[seen]], own[mine[seen]])
            unseen = np.bincount(before[~seen], minlength=len(LEVELS))
            for k, weight in enumerate(GRID):
                more = np.rint(UNIT * np.log10(weight * ratio + (1 - weight)))
                gain[:, k] += np.bincount(before[seen], more, minlength=len(LEVELS)).astype(np.int64)
                gain[:, k] += unseen * int(np.rint(UNIT * np.log10(1 - weight)))
        some = np.flatnonzero(gain.any(axis=1))
        level, k = np.repeat(some, len(GRID)), np.tile(np.arange(len(GRID)), len(some))
        yield pa.record_batch(
            [pa.array(level), pa.array(k), pa.array(gain[level, k])], names=["level", "k", "gain"]
        )

    return work


def _fit_weights(train: DataFrame, model_) -> np.ndarray:
    """One weight per history level: the best of a grid over all pairs of the texts."""
    gain = np.zeros((len(LEVELS), len(GRID)), np.int64)
    parts = map_batches(train, _gains(model_, None), "level long, k long, gain long")
    for row in parts.groupBy("level", "k").agg(F.sum("gain").alias("gain")).collect():
        gain[row.level, row.k] += row.gain  # some hundred levels with ten weights each
    weights = GRID[gain.argmax(axis=1)]
    weights[0] = 0  # an unknown history says nothing
    return weights


def _scores(model_, frequent_, filter_, weights: np.ndarray, lead: bool):
    """Per text: sums over its tokens. ``lead`` says if this is the first group of segments."""
    names = ["row", "doc_id", "held_out", "n_tokens", "known", "base", "score", "rare", "times"]
    kinds = [
        pa.int64(), pa.int64(), pa.bool_(), pa.int64(), pa.int64(), pa.float64(), pa.float64(),
        pa.list_(pa.int64()), pa.list_(pa.int32()),
    ]

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, (words, counts) = model_.value, frequent_.value
        pair_filter = filter_ and filter_.value
        log_size = math.log10(model.total + model.distinct + 1)
        for part in slices(batches, SLICE_BYTES, "text"):
            tokens = tokens_of(part.column("text"))
            first = tokens.first[:-1]
            own = model.word_levels(part, tokens)
            alone, before = model.alone(own), model.history_levels(own, tokens)
            if pair_filter:
                level = pair_filter.levels(pairs(histories(tokens), tokens.hashes))
            else:
                level = _noted(part, "pair_levels")
            weight = weights[before]
            unseen = np.log10(1 - weight) + np.log10(alone)
            seen = np.log10(weight * model.ratio(level, before) + (1 - weight) * alone)
            gain = np.where(level > 0, seen - unseen, 0.0) + (unseen if lead else 0.0)
            score = np.add.reduceat(gain, first)
            place = np.minimum(np.searchsorted(words, tokens.hashes), max(0, len(words) - 1))
            known = words[place] == tokens.hashes if len(words) else np.zeros(len(gain), bool)
            log_count = np.where(known, np.log10(counts[place] + 1.0), 0.0) if len(words) else 0.0 * gain
            base = np.add.reduceat(log_count, first) - log_size * tokens.counts
            owner = tokens.rows()[~known]
            rare, times = np.empty(0, np.uint64), np.empty(0, np.int64)
            edge = np.zeros(len(first) + 1, np.int64)
            if len(owner) and lead:
                order = np.lexsort((tokens.hashes[~known], owner))
                owner, rare = owner[order], tokens.hashes[~known][order]
                new = np.flatnonzero(
                    np.concatenate(([True], (np.diff(owner) != 0) | (rare[1:] != rare[:-1])))
                )
                times = np.diff(np.append(new, len(owner)))
                owner, rare = owner[new], rare[new]
                edge = np.searchsorted(owner, np.arange(len(first) + 1))
            edge = pa.array(edge.astype(np.int32))
            columns = [
                part.column("row"), part.column("doc_id"), part.column("held_out"),
                pa.array(tokens.counts), pa.array(np.add.reduceat(known.astype(np.int64), first)),
                pa.array(base), pa.array(score),
                pa.ListArray.from_arrays(edge, pa.array(rare.view(np.int64))),
                pa.ListArray.from_arrays(edge, pa.array(times.astype(np.int32))),
            ]
            yield pa.record_batch(columns, schema=pa.schema(list(zip(names, kinds, strict=True))))

    return work


_SCORE_SCHEMA = (
    "row long, doc_id long, held_out boolean, n_tokens long, known long, base double, "
    "score double, rare array<long>, times array<int>"
)


def score_documents(
    docs: DataFrame, divisor: int = 7, remainder: int = 2, filter_bytes: int = FILTER_BYTES
) -> DataFrame:
    """Rows (doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score).

    Documents (doc_id, text) whose id's crc32 modulo ``divisor`` is ``remainder`` are held out.
    """
    spark = docs.sparkSession
    docs = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        "text",
        (id_remainder("doc_id", divisor) == remainder).alias("held_out"),
    )
    train = docs.where("NOT held_out")
    guess = train.select(F.sum(F.octet_length("text"))).first()[0] or 0
    shards = _shards_for(guess // 5)  # tokens of five bytes; only sets the number of shards
    counts = stored(
        _gathered(train, 1, shards, _count_rows, "word long, n long"), "word-counts"
    )
    totals = counts.agg(F.sum("n"), F.count(F.lit(1))).first()
    total, distinct = totals[0] or 0, totals[1]
    top = counts.orderBy(F.desc("n"), "word").limit(FREQUENT).toArrow()
    words, n = top.column(0).to_numpy().view(np.uint64), top.column(1).to_numpy()
    order = np.argsort(words)
    frequent = (words[order], n[order])

    word_shards = _shards_for(distinct)
    hashed = F.shiftrightunsigned("word", 32) * word_shards
    shard = F.shiftrightunsigned(hashed, 32).cast("int")
    word_bits = stored(
        map_batches(
            _a_shard_a_task(counts.select(shard.alias("shard"), "word", "n"), word_shards),
            _word_segments(word_shards),
            "shard int, bits binary",
        ),
        "word-filter",
    )
    pair_bits = stored(
        _gathered(train, 2, shards, _segment_rows, "shard int, bits binary"),
        "pair-filter",
    )
    share = spark.sparkContext.broadcast
    docs = docs.withColumn("row", F.monotonically_increasing_id())
    word_groups, end = [], 0
    for part in _filters(word_bits, word_shards, filter_bytes):
        end = max(end, int(part.levels(np.array([END], np.uint64))[0]))
        word_groups.append(share(part))
    pair_groups = [share(part) for part in _filters(pair_bits, shards, filter_bytes)]
    shared_model, shared_words = share(_Model(None, end, total, distinct)), share(frequent)
    note = _note_both(shared_model, *pair_groups, word_groups=word_groups)
    docs = stored(map_batches(docs, note, _NOTED_SCHEMA), "noted")
    for group in word_groups + pair_groups:
        group.destroy()

    weights = _fit_weights(docs.where("NOT held_out"), shared_model)
    scores = _scores(shared_model, shared_words, None, weights, True)
    lead = stored(map_batches(docs, scores, _SCORE_SCHEMA), "scores")
    rare = lead.select("row", F.explode(F.arrays_zip("rare", "times")).alias("x")).select(
        "row", F.col("x.rare").alias("word"), F.col("x.times").alias("times")
    )
    sums = (
        rare.join(counts, "word")
        .groupBy("row")
        .agg(
            F.sum(F.col("times") * F.log10(F.col("n") + 1)).alias("rare_base"),
            F.sum("times").alias("rare_known"),
        )
    )
    return lead.join(sums, "row", "left").select(
        "doc_id",
        "held_out",
        "n_tokens",
        (F.col("known") + F.coalesce("rare_known", F.lit(0))).cast("long").alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        (F.col("base") + F.coalesce("rare_base", F.lit(0.0))).alias("base_score"),
        "score",
    )
