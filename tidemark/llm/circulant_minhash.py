"""Near-duplicate documents: circulant MinHash, banding, exact Jaccard verification.

All signature coordinates come from two permutations of the 32-bit numbers. The first scatters
the shingles; the second is applied after a circular shift that differs per coordinate.

Steps, all on whole texts:

1. One pass makes per document its number of shingles, a fingerprint of the shingle set and the
   band keys. Documents with the same set form one class, whose least id stands for it, so
   groups of exact copies shrink to one row before anything is compared.
2. Classes that share a band key form a bucket; buckets with the same members are kept once.
3. Buckets are cut into chunks of a bounded number of members. Full sets are compared inside a
   task, which returns only links that join two parts, so at most one row per member leaves it,
   never all pairs. A first round compares within chunks for a few bands. The second round
   takes all bands and every pair of members that the first left in different components.
4. Components of the links are the groups.

Rows: a null text counts as empty. Texts without words link with nothing. Rows that repeat an id
count as one document. Rows with a null id link with nothing and are kept. Other columns are
ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm import words as W
from tidemark.llm.common import map_batches, slices, stored
from tidemark.llm.components import connected_components

SLICE_BYTES = 1 << 20
CHUNK = 256
"""Members of a bucket that a task compares with as many others."""
MARKS = 1 << 26

# Multipliers of the two permutations, and the step of the circular shift; all odd.
_SCATTER = (np.uint32(0x85EBCA6B), np.uint32(0xC2B2AE35))
_PERMUTE = (np.uint32(0x9E3779B1), np.uint32(0x85EBCA77))
_STEP = 0x61C88647


def _scatter(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint32(16))) * _SCATTER[0]
    x = (x ^ (x >> np.uint32(13))) * _SCATTER[1]
    return x ^ (x >> np.uint32(16))


def _permute(x: np.ndarray) -> np.ndarray:
    x = x * _PERMUTE[0]
    x ^= x >> np.uint32(15)
    x *= _PERMUTE[1]
    x ^= x >> np.uint32(13)
    return x


def signatures(shingles: np.ndarray, first: np.ndarray, size: int) -> np.ndarray:
    """One row of ``size`` coordinates for every set; the sets must not be empty."""
    places = _scatter((shingles >> np.uint64(32)).astype(np.uint32))
    out = np.empty((len(first) - 1, size), np.uint32)
    for k in range(size):
        shift = np.uint32(k * _STEP & 0xFFFFFFFF)
        out[:, k] = np.minimum.reduceat(_permute(places + shift), first[:-1])
    return out


def _sets(texts: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct shingles of every row, sorted, and where each row's begin."""
    hashes, first = W.shingle_hashes(W.words_of(texts), width)
    parts = [np.unique(hashes[a:b]) for a, b in zip(first[:-1], first[1:], strict=True)]
    sizes = np.array([len(p) for p in parts], np.int64)
    return np.concatenate(parts) if parts else hashes, np.concatenate(([0], np.cumsum(sizes)))


def _describe(width: int, bands: int, rows: int):
    """Id, set size, set fingerprint and band keys of every document."""
    schema = pa.schema(
        [
            ("doc_id", pa.int64()),
            ("n_shingles", pa.int64()),
            ("mark_a", pa.int64()),
            ("mark_b", pa.int64()),
            ("bands", pa.list_(pa.int64())),
        ]
    )

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, SLICE_BYTES, "text"):
            flat, first = _sets(part.column("text"), width)
            n = np.diff(first)
            some = np.flatnonzero(n)
            marks = np.zeros((2, len(n)), np.uint64)
            keys = np.zeros((len(some), bands), np.uint64)
            if len(some):
                begin = first[some]
                for side, salt in enumerate((1, 2)):
                    salted = W.mix(flat + np.uint64(salt))
                    marks[side, some] = np.add.reduceat(salted, begin)
                signature = signatures(flat, np.append(begin, len(flat)), bands * rows)
                for band in range(bands):
                    key = np.full(len(some), band + 1, np.uint64)
                    for j in range(rows):
                        key = W.mix(key * W._GRAM + signature[:, band * rows + j])
                    keys[:, band] = key
            places = np.zeros(len(n) + 1, np.int32)
            places[1:] = np.cumsum(np.where(n > 0, bands, 0))
            yield pa.record_batch(
                [
                    part.column("doc_id").cast(pa.int64()),
                    pa.array(n),
                    pa.array(marks[0].view(np.int64)),
                    pa.array(marks[1].view(np.int64)),
                    pa.ListArray.from_arrays(
                        pa.array(places), pa.array(keys.reshape(-1).view(np.int64))
                    ),
                ],
                schema=schema,
            )

    return work


def _set_rows(width: int, wanted):
    """Shingle sets of the documents whose id is marked in the bitmap ``wanted``."""
    schema = pa.schema([("member", pa.int64()), ("shingles", pa.binary())])

    def marked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = wanted.value
        for batch in batches:
            place = batch.column("place").to_numpy()
            yes = (bits[place >> 6] >> (place & 63).astype(np.uint64)) & np.uint64(1) == 1
            yield batch.filter(pa.array(yes))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(marked(batches), SLICE_BYTES, "text"):
            flat, first = _sets(part.column("text"), width)
            data = [flat[a:b].tobytes() for a, b in zip(first[:-1], first[1:], strict=True)]
            yield pa.record_batch(
                [part.column("doc_id"), pa.array(data, pa.binary())], schema=schema
            )

    return work


class _Parts:
    """Union-find over the labels that one task sees."""

    def __init__(self):
        self.up: dict[int, int] = {}

    def top(self, x: int) -> int:
        while (y := self.up.get(x, x)) != x:
            self.up[x] = self.up.get(y, y)
            x = y
        return x

    def join(self, x: int, y: int) -> bool:
        x, y = self.top(x), self.top(y)
        if x != y:
            self.up[max(x, y)] = min(x, y)
        return x != y


def _overlaps(sets: list[np.ndarray]):
    """A function from a set's number to its intersection sizes with all sets of the group."""
    if len(sets) <= 4:
        return lambda i: np.array(
            [len(np.intersect1d(sets[i], s, assume_unique=True)) for s in sets]
        )
    sizes = [len(s) for s in sets]
    owner = np.repeat(np.arange(len(sets)), sizes)
    _, code = np.unique(np.concatenate(sets), return_inverse=True)
    order = np.argsort(code, kind="stable")
    owner_of, begin = owner[order], np.concatenate(([0], np.cumsum(np.bincount(code))))
    place = np.concatenate(([0], np.cumsum(sizes)))

    def of(i: int) -> np.ndarray:
        mine = code[place[i] : place[i + 1]]
        lengths = begin[mine + 1] - begin[mine]
        starts = np.repeat(begin[mine] - (np.cumsum(lengths) - lengths), lengths)
        return np.bincount(owner_of[np.arange(lengths.sum()) + starts], minlength=len(sets))

    return of


def _links(members: list[tuple[int, int, bool, np.ndarray]], percent: int):
    """Links between members (id, component, asks, set) that are in different components.

    Every member that asks is compared with all others; a link is left out if it would join two
    members that earlier links of this task have joined.
    """
    parts, found = _Parts(), []
    sets = [m[3] for m in members]
    sizes = np.array([len(s) for s in sets])
    component = [m[1] for m in members]
    of = _overlaps(sets)
    for i, (member, own, asks, _) in enumerate(members):
        if not asks:
            continue
        both = of(i)
        near = 100 * both >= percent * (sizes + sizes[i] - both)
        for j in np.flatnonzero(near):
            if members[j][0] != member and parts.join(own, component[j]):
                found.append((member, members[j][0]))
    return found


def _compare(percent: int):
    """Reads rows sorted by task and compares each task's members."""
    schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])
    keys = ("bucket", "i", "j")

    def flush(members):
        return _links(members, percent) if len(members) > 1 else []

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, members, out = None, [], []
        for batch in batches:
            for row in zip(
                *(batch.column(c).to_pylist() for c in (*keys, "member", "component", "asks")),
                batch.column("shingles"),
                strict=True,
            ):
                if row[:3] != current:
                    out += flush(members)
                    current, members = row[:3], []
                members.append(
                    (row[3], row[4], row[5], np.frombuffer(row[6].as_buffer(), np.uint64).copy())
                )
            if out:
                yield pa.record_batch([pa.array(x) for x in zip(*out, strict=True)], schema=schema)
                out = []
        out += flush(members)
        if out:
            yield pa.record_batch([pa.array(x) for x in zip(*out, strict=True)], schema=schema)

    return work


def _bitmap(ids: DataFrame) -> np.ndarray:
    """A bitmap of ``MARKS`` hashed places with the bits of these ids (one column) set.

    It has the same size whatever the data. Documents marked by chance only cost their set, as
    sets are joined by id later.
    """
    rows = (
        ids.select(_place(ids.columns[0]).alias("place"))
        .groupBy(F.shiftright("place", 6).alias("word"))
        .agg(F.expr("bit_or(shiftleft(1L, cast(place & 63 AS int)))").alias("bits"))
        .toArrow()
    )
    out = np.zeros(MARKS >> 6, np.uint64)
    out[rows.column(0).to_numpy()] = rows.column(1).to_numpy().view(np.uint64)
    return out


def _place(column: str) -> Column:
    return F.pmod(F.xxhash64(column), F.lit(MARKS))


def _tasks(members: DataFrame, within_chunks: bool) -> DataFrame:
    """Who is compared where: rows (bucket, i, j, member, component, asks).

    ``members`` has (bucket, member, component). Of every bucket, the members outside its largest
    component ask; they are compared with all members. ``within_chunks`` keeps to pairs inside one
    chunk instead, which is work in proportion to the members.
    """
    parts = members.groupBy("bucket", "component").agg(F.count(F.lit(1)).alias("n"))
    sizes = (
        parts.groupBy("bucket")
        .agg(
            F.sum("n").alias("total"),
            F.max(F.struct("n", "component")).alias("largest"),
            F.count(F.lit(1)).alias("parts"),
        )
        .where("parts > 1")
        .select(
            "bucket",
            F.col("largest.component").alias("largest"),
            F.ceil(F.col("total") / CHUNK).cast("int").alias("chunks"),
            F.ceil((F.col("total") - F.col("largest.n")) / CHUNK).cast("int").alias("asking"),
        )
    )
    rows = members.join(stored(sizes, "buckets"), "bucket").withColumn(
        "asks", F.col("component") != F.col("largest")
    )
    spread = F.xxhash64("member", F.lit(7))
    own = F.pmod(spread, F.col("chunks")).cast("int")
    asking = F.pmod(spread, F.col("asking")).cast("int")
    picked = ["bucket", "member", "component"]
    if within_chunks:
        return rows.select(
            "bucket", own.alias("i"), own.alias("j"), "member", "component", F.lit(True).alias("asks")
        )
    asked = rows.where("asks").select(
        *picked,
        asking.alias("i"),
        F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("j"),
        F.lit(True).alias("asks"),
    )
    # Where a bucket is a single task, those that ask are there already.
    others = rows.where("NOT asks OR chunks > 1").select(
        *picked,
        F.explode(F.sequence(F.lit(0), F.col("asking") - 1)).alias("i"),
        own.alias("j"),
        F.lit(False).alias("asks"),
    )
    columns = ["bucket", "i", "j", "member", "component", "asks"]
    return asked.select(columns).unionByName(others.select(columns))


def _verified(tasks: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    ready = (
        tasks.join(sets, "member")
        .select("bucket", "i", "j", "member", "component", "asks", "shingles")
        .repartition("bucket", "i", "j")
        .sortWithinPartitions("bucket", "i", "j")
    )
    return map_batches(ready, _compare(percent), "a long, b long")


def near_duplicates(
    docs: DataFrame,
    percent: int = 85,
    width: int = 5,
    bands: int = 20,
    rows: int = 5,
    first_bands: int = 4,
) -> DataFrame:
    """Rows (doc_id, n_shingles, component_id, kept) for rows (doc_id, text).

    Two documents are linked if their sets of ``width``-word shingles share at least ``percent``
    per cent of their union. With the defaults a pair at 85 per cent is missed with probability
    (1 - 0.85**5)**20, about 1 in 100,000, if nothing else joins it.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    described = stored(
        map_batches(
            docs,
            _describe(width, bands, rows),
            "doc_id long, n_shingles long, mark_a long, mark_b long, bands array<long>",
        ),
        "signatures",
    )
    marks = ["n_shingles", "mark_a", "mark_b"]
    usable = described.where("n_shingles > 0 AND doc_id IS NOT NULL")
    classes = stored(
        usable.groupBy(*marks).agg(F.min("doc_id").alias("member")), "classes"
    )
    heads = usable.join(classes, marks).where("doc_id = member")
    banded = heads.select(
        "member", F.posexplode("bands").alias("band", "bucket")
    ).distinct()
    whole = banded.groupBy("bucket").agg(
        F.count(F.lit(1)).alias("n"),
        F.bit_xor(F.xxhash64("member")).alias("x"),
        F.sum(F.hash("member").cast("long")).alias("s"),
        F.min("band").alias("band"),
    )
    unlike = (
        whole.where("n > 1")
        .groupBy("n", "x", "s")
        .agg(F.min(F.struct("band", "bucket")).alias("one"))
        .select("one.band", "one.bucket")
    )
    members = stored(
        banded.select("member", "bucket").join(stored(unlike, "buckets"), "bucket"), "members"
    )
    wanted = docs.sparkSession.sparkContext.broadcast(_bitmap(members.select("member")))
    marked = docs.where("doc_id IS NOT NULL").withColumn("place", _place("doc_id"))
    sets = stored(
        map_batches(marked, _set_rows(width, wanted), "member long, shingles binary"), "sets"
    )
    alone = members.withColumn("component", F.col("member"))
    near = stored(
        _verified(_tasks(alone.where(F.col("band") < first_bands), True), sets, percent), "links"
    )
    parts = connected_components(near).withColumnRenamed("node", "member")
    known = stored(
        members.join(parts, "member", "left").select(
            "bucket", "member", F.coalesce("component", "member").alias("component")
        ),
        "members",
    )
    rest = stored(_verified(_tasks(known, False), sets, percent), "links")
    groups = connected_components(near.unionByName(rest)).withColumnRenamed("node", "member")
    named = stored(
        classes.join(groups, "member", "left").select(
            *marks, F.coalesce("component", "member").alias("component_id")
        ),
        "classes",
    )
    out = described.select("doc_id", *marks).join(named, marks, "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id"))
    return out.select(
        "doc_id",
        "n_shingles",
        component.alias("component_id"),
        (F.col("doc_id").isNull() | (component == F.col("doc_id"))).alias("kept"),
    )
