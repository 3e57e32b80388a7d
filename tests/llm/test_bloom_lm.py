import math
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from brute import table_rows, words

from tidemark.llm import bloom_lm as op

SCHEMA = "doc_id long, text string"


def expected(rows):
    """Per row: held out, tokens, known tokens, base score; and the number of training tokens."""
    counts, out = Counter(), []
    held = [zlib.crc32(("" if i is None else str(i)).encode()) % 7 == 2 for i, _ in rows]
    for (_, text), out_ in zip(rows, held, strict=True):
        if not out_:
            counts.update([*words(text), None])
    n, v = sum(counts.values()), len(counts)
    for (i, text), h in zip(rows, held, strict=True):
        own = [*words(text), None]
        base = sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in own)
        out.append((i, h, len(own), sum(counts[w] > 0 for w in own), n, base))
    return out


def check(got, rows):
    key = lambda r: (r[0] is None, r[0] or 0, r[2], r[5])
    got = sorted(([r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score] for r in got), key=key)
    for a, b in zip(got, sorted(expected(rows), key=key), strict=True):
        assert a[:5] == list(b[:5])
        assert abs(a[5] - b[5]) <= 1e-9 * max(1, abs(b[5]))


def test_source_table(spark):
    sf = "/root/testdata/sf0.01"
    rows = [(r.doc_id, r.text) for r in table_rows(spark, "documents", sf)]
    out = op.score_documents(spark.read.parquet(f"{sf}/documents.parquet")).collect()
    check(out, rows)
    assert all(r.score <= 0 for r in out)
    held = [r for r in out if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held)


def test_rare_words_are_counted_by_join(spark, monkeypatch):
    monkeypatch.setattr(op, "FREQUENT", 5)
    rows = [(k, f"the word{k % 7} of the day{k % 50} {'x ' * (k % 4)}") for k in range(120)]
    check(op.score_documents(spark.createDataFrame(rows, SCHEMA)).collect(), rows)


def test_odd_rows(spark):
    rows = [(1, None), (2, ""), (3, " \t\n"), (None, "A a"), (5, "a"), (5, "a"), (6, "z" * 9999)]
    frame = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS score", "2 AS row", "3 AS held_out")
    check(op.score_documents(frame).collect(), rows)
    assert op.score_documents(frame.limit(0)).count() == 0


def test_nothing_to_learn_from(spark):
    held = next(k for k in range(99) if zlib.crc32(str(k).encode()) % 7 == 2)
    rows = [(held, "some words")]
    (r,) = op.score_documents(spark.createDataFrame(rows, SCHEMA)).collect()
    assert (r.n_known, r.train_tokens, r.base_score, r.score) == (0, 0, 0.0, 0.0)


def test_groups_of_segments_give_the_same_scores(spark, monkeypatch):
    monkeypatch.setattr(op, "ENTRIES_PER_SHARD", 40)
    monkeypatch.setattr(op, "_fit_weights", lambda *a: np.where(np.arange(len(op.LEVELS)) > 0, 0.3, 0.0))
    rows = [(k, " ".join(f"w{(k * j) % 97}" for j in range(30))) for k in range(150)]
    frame = spark.createDataFrame(rows, SCHEMA)
    one = {r.doc_id: r.score for r in op.score_documents(frame).collect()}
    groups = []
    monkeypatch.setattr(op, "_groups", lambda t, n, f=op._groups: groups.append(f(t, n)) or groups[-1])
    more = {r.doc_id: r.score for r in op.score_documents(frame, filter_bytes=300).collect()}
    assert len(groups) == 2 and all(len(g) > 1 for g in groups)
    assert all(abs(one[k] - more[k]) < 1e-9 for k in one)


def test_weights_are_fitted_on_all_groups(spark, monkeypatch):
    monkeypatch.setattr(op, "ENTRIES_PER_SHARD", 40)
    rows = [(k, " ".join(f"w{(k * j) % 97}" for j in range(30))) for k in range(150)]
    frame = spark.createDataFrame(rows, SCHEMA)
    fitted = []
    monkeypatch.setattr(op, "_fit_weights", lambda *a, f=op._fit_weights: fitted.append(f(*a)) or fitted[-1])
    one = {r.doc_id: r.score for r in op.score_documents(frame).collect()}
    more = {r.doc_id: r.score for r in op.score_documents(frame, filter_bytes=300).collect()}
    assert fitted[0].max() > 0 and fitted[0].tolist() == fitted[1].tolist()
    assert all(abs(one[k] - more[k]) < 1e-9 for k in one)


def test_weights_do_not_depend_on_the_order_of_texts(spark, monkeypatch):
    """A source of more than 2,000 texts in fixed phrases, and one of the same words at random."""
    r = np.random.default_rng(5)
    fixed = [" ".join(f"w{(k + j) % 40}" for j in range(12)) for k in range(2500)]
    mixed = [" ".join(f"w{w}" for w in r.integers(0, 40, 12)) for _ in range(2500)]
    rows = list(enumerate(fixed + mixed))
    fitted = []
    monkeypatch.setattr(op, "_fit_weights", lambda *a, f=op._fit_weights: fitted.append(f(*a)) or fitted[-1])
    one, two = (
        {r.doc_id: r.score for r in op.score_documents(spark.createDataFrame(x, SCHEMA)).collect()}
        for x in (rows, rows[::-1])
    )
    assert fitted[0].max() > 0 and fitted[0].tolist() == fitted[1].tolist()
    assert all(abs(one[k] - two[k]) < 1e-9 for k in one)


def test_pairs_seen_once_count(spark, monkeypatch):
    monkeypatch.setattr(op, "_fit_weights", lambda *a: np.where(np.arange(len(op.LEVELS)) > 0, 0.3, 0.0))
    held = [k for k in range(200) if zlib.crc32(str(k).encode()) % 7 == 2][:2]
    train = [k for k in range(200) if zlib.crc32(str(k).encode()) % 7 != 2][:40]
    rows = [(k, f"a{j} b{j}") for j, k in enumerate(train)]
    rows += [(held[0], "a3 b3"), (held[1], "a3 b4")]  # the first pair was seen, the second was not
    score = {r.doc_id: r.score for r in op.score_documents(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert score[held[0]] > score[held[1]] + 0.5


def test_groups_agree_on_rows_if_splits_change(spark, monkeypatch, run_dir):
    monkeypatch.setattr(op, "ENTRIES_PER_SHARD", 40)
    monkeypatch.setattr(op, "_fit_weights", lambda *a: np.where(np.arange(len(op.LEVELS)) > 0, 0.3, 0.0))
    rows = [(k, " ".join(f"w{(k * j) % 97}" for j in range(k % 40))) for k in range(150)]
    spark.createDataFrame(rows, SCHEMA).repartition(9).write.mode("overwrite").parquet(f"{run_dir}/docs")
    frame = spark.read.schema(SCHEMA).parquet(f"{run_dir}/docs")
    one = {r.doc_id: r.score for r in op.score_documents(frame).collect()}
    sizes, loads = ("1", "100MB"), []

    def load(table, shards, wanted, f=op._load):
        loads.append(wanted)
        out = f(table, shards, wanted)
        spark.conf.set("spark.sql.files.openCostInBytes", sizes[len(loads) % 2])
        return out

    monkeypatch.setattr(op, "_load", load)
    # The word filter is one group; only the pair filter takes several.
    monkeypatch.setattr(op, "_groups", lambda t, n, f=op._groups, c=[]: c.append(0) or f(t, n if len(c) > 1 else 1 << 30))
    try:
        more = {r.doc_id: r.score for r in op.score_documents(frame, filter_bytes=300).collect()}
    finally:
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert len(loads) > 3 and one.keys() == more.keys()
    assert all(abs(one[k] - more[k]) < 1e-9 for k in one)


def test_filter_returns_levels():
    r = np.random.default_rng(2)
    keys = np.unique(r.integers(0, 2**63, 20_000, dtype=np.uint64))
    counts = r.zipf(1.4, len(keys)).clip(1, 10**9)
    shard = op._shard(keys, 3)
    parts = {s: op._segment(keys[shard == s], counts[shard == s]).tobytes() for s in range(3)}
    found = op.LogFrequencyFilter(3, parts)
    level = found.levels(keys)
    assert (level >= op.level_of(counts)).all()  # never too low
    assert (level == op.level_of(counts)).mean() > 0.97
    absent = found.levels(r.integers(2**63, 2**64 - 1, 20_000, dtype=np.uint64))
    assert (absent > 0).mean() < 0.03


def test_probabilities_sum_to_at_most_one(spark):
    """Over all known words and the unknown one, after every history."""
    text = "a b a c a b d b a " * 20
    counts = Counter([*text.split(), "\0"])
    n, v = sum(counts.values()), len(counts)
    pairs = Counter(zip(text.split(), text.split()[1:], strict=False))
    for h in "abcd":
        up = op.LEVELS[op.level_of(np.array([counts[h]])) + 1][0] - 1
        total = 1 / (n + v + 1) * 0.7
        for w in counts:
            low = op.LEVELS[op.level_of(np.array([pairs[h, w]]))][0]
            p1 = (op.LEVELS[op.level_of(np.array([counts[w]]))][0] + 1) / (n + v + 1)
            total += 0.3 * min(1, low / up) + 0.7 * p1
        assert total <= 1


class Sent:
    def __init__(self, value):
        self.value = value


def test_noted_levels_stand_for_the_filters():
    """One group: words and pairs are looked up once; fit and scores then need no filter."""
    rng = np.random.default_rng(3)
    texts = [" ".join(f"w{w}" for w in rng.zipf(1.5, n) % 300) for n in rng.integers(0, 60, 200)]
    docs = pa.record_batch(
        {
            "doc_id": pa.array(range(200), pa.int64()),
            "text": texts,
            "held_out": [False] * 200,
            "row": pa.array(range(200), pa.int64()),
        }
    )
    tokens = op.tokens_of(docs.column("text"))

    def made(grams):
        keys, counts = np.unique(grams, return_counts=True)
        shard = op._shard(keys, 3)
        parts = {s: op._segment(keys[shard == s], counts[shard == s]).tobytes() for s in range(3)}
        found = op.LogFrequencyFilter(3, parts)
        assert (found.levels(keys) >= op.level_of(counts)).all()
        assert (found.levels(keys) == op.level_of(counts)).mean() > 0.9
        return found, keys, counts

    words, keys, counts = made(tokens.hashes)
    pair_filter, *_ = made(op.pairs(op.histories(tokens), tokens.hashes))
    end = int(words.levels(np.array([op.END]))[0])
    size = (end, int(counts.sum()), len(keys))
    asked, noted = Sent(op._Model(words, *size)), Sent(op._Model(None, *size))
    frequent, weights = Sent((keys, counts)), np.full(len(op.LEVELS), 0.3)
    beside = list(op._note_both(asked, Sent(pair_filter))(iter([docs])))
    fit = [list(op._gains(asked, Sent(pair_filter))(iter([docs]))), list(op._gains(noted, None)(iter(beside)))]
    assert fit[0] == fit[1]
    scores = [
        list(op._scores(asked, frequent, Sent(pair_filter), weights, True)(iter([docs]))),
        list(op._scores(noted, frequent, None, weights, True)(iter(beside))),
    ]
    assert scores[0] == scores[1]


def test_a_task_fills_one_shard(spark):
    """Shards dealt by their hash met in tasks, five of 98, and were sorted and held together."""
    rows = [(k, " ".join(f"w{k * j}" for j in range(30))) for k in range(150)]

    def seen(batches):
        shards = {s for batch in batches for s in batch.column("shard").to_pylist()}
        yield pa.record_batch([pa.array(sorted(shards), pa.int32()), pa.array([len(shards)] * len(shards), pa.int32())], names=["shard", "n"])

    found = op._gathered(spark.createDataFrame(rows, SCHEMA), 2, 40, seen, "shard int, n int").collect()
    assert sorted(r.shard for r in found) == list(range(40)) and {r.n for r in found} == {1}


def test_texts_are_read_once_for_all_groups(spark, monkeypatch):
    """There was a pass for the fit and one for the scores for each group of the filter."""
    monkeypatch.setattr(op, "ENTRIES_PER_SHARD", 40)
    rows = [(k, " ".join(f"w{(k * j) % 97}" for j in range(30))) for k in range(150)]
    frame = spark.createDataFrame(rows, SCHEMA)
    passes, loads = [], []
    monkeypatch.setattr(op, "map_batches", lambda *a, f=op.map_batches: passes.append(a[2]) or f(*a))
    monkeypatch.setattr(op, "_load", lambda *a, f=op._load: loads.append(a[2]) or f(*a))
    one = {r.doc_id: r.score for r in op.score_documents(frame).collect()}
    count = len(passes)
    assert len(loads) == 2
    more = {r.doc_id: r.score for r in op.score_documents(frame, filter_bytes=300).collect()}
    assert len(loads) > 12 and len(passes) == 2 * count
    assert one == more


def test_parts_of_a_filter_answer_as_the_whole():
    r = np.random.default_rng(6)
    keys = np.unique(r.integers(0, 2**64 - 1, 90_000, dtype=np.uint64))
    counts = r.zipf(1.4, len(keys)).clip(1, 10**9)
    shard = op._shard(keys, 7)
    parts = {s: op._segment(keys[shard == s], counts[shard == s]).tobytes() for s in (0, 1, 2, 4, 6)}
    whole = op.LogFrequencyFilter(7, parts)
    asked = np.concatenate([keys[::2], keys[::3], r.integers(0, 2**64 - 1, 50_000, dtype=np.uint64)])
    r.shuffle(asked)
    level = whole.levels(asked)
    known = np.searchsorted(keys, asked).clip(0, len(keys) - 1)
    held = (keys[known] == asked) & ~np.isin(op._shard(asked, 7), [3, 5])
    assert (level[held] >= op.level_of(counts)[known[held]]).all()
    assert not level[np.isin(op._shard(asked, 7), [3, 5])].any()
    alone = [int(whole.levels(asked[k : k + 1])[0]) for k in range(300)]
    assert level[:300].tolist() == alone
    groups = [Sent(op.LogFrequencyFilter(7, {s: parts[s] for s in own})) for own in ([0, 1], [2, 4], [6], [])]
    assert op.levels_from(asked, op._in_turn(groups[:2]) + [lambda g=g: g.value for g in groups[2:]]).tolist() == level.tolist()
    assert not len(op.levels_from(asked[:0], [lambda: whole]))


def test_a_task_holds_one_group_at_a_time():
    class Group:
        """As a broadcast in a worker: read when asked for, and kept."""

        @property
        def value(self):
            if not hasattr(self, "_value"):
                self._value = object()
            return self._value

    groups = [Group() for _ in range(5)]
    for fetch in op._in_turn(groups) * 2:
        fetch()
        assert sum(hasattr(g, "_value") for g in groups) == 1
    (fetch,) = op._in_turn(groups[:1])
    assert fetch() is fetch()  # a single one is kept


def test_runs_of_texts_lose_no_row(monkeypatch):
    """Runs of one slice and of many; null, empty and long texts at their edges."""
    texts = [None, "", "a b", "x " * 90, None, "c", " ", "b a " * 40, "", None]
    docs = pa.record_batch(
        {
            "doc_id": pa.array(range(10), pa.int64()),
            "text": pa.array(texts, pa.string()),
            "held_out": [False] * 10,
            "row": pa.array(range(10), pa.int64()),
        }
    )
    tokens = op.tokens_of(docs.column("text"))
    made = []
    for grams in (tokens.hashes, op.pairs(op.histories(tokens), tokens.hashes)):
        keys, counts = np.unique(grams, return_counts=True)
        made.append(op.LogFrequencyFilter(1, {0: op._segment(keys, counts).tobytes()}))
    model, group = Sent(op._Model(made[0], 0, 1, 1)), Sent(made[1])
    monkeypatch.setattr(op, "SLICE_BYTES", 100)
    out = []
    for size in (1, 150, 1 << 20):
        monkeypatch.setattr(op, "RUN_BYTES", size)
        batches = [docs.slice(0, 4), docs.slice(4, 0), docs.slice(4)]
        found = pa.Table.from_batches(list(op._note_both(model, group)(iter(batches)))).to_pydict()
        assert found["text"] == texts and found["row"] == list(range(10))
        assert [len(x) for x in found["levels"]] == [len(x) for x in found["pair_levels"]] == tokens.counts.tolist()
        out.append(found)
    assert out[0] == out[1] == out[2]
    assert list(b"".join(out[0]["levels"])) == made[0].levels(tokens.hashes).tolist()
