"""Quality classifier: an ensemble of few rules over statistics of a text.

1. Every text gives ``STATISTICS``, shares and means of its signs, words and lines, counted over
   the whole text in numpy, a run of rows at a time. They are stored, one narrow row per text.
2. A forest of shallow trees (Spark ML) is grown on the labelled rows, all of them. Every path from
   a root to a node is a rule: a conjunction of bounds on some statistics.
3. Logistic regression with a lasso penalty (Spark ML) weighs the rules and drops most of them.
4. What is left is compiled into one Spark column expression over the stored statistics, which
   scores all rows in the JVM, without a model object on the workers.

Nothing of the corpus reaches the driver but the trees and the weights; their size depends on the
number of trees and their depth only.

Rows: a null text is empty, and an empty text has all statistics 0; both are scored like any other.
A document's label is the majority of its label rows (1 in a tie); null labels do not count, and
labels without a document are not used. Documents that repeat an id all have its label. With no
label, or with labels of one kind alone, every score is the share of ones, (ones + 1) / (labels + 2).
Other columns are never read, whatever their names.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator, Mapping
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm import words as W
from tidemark.llm.common import id_remainder, map_batches, slices, stored

TREES = 24
DEPTH = 3
PENALTY = 0.002
ITERATIONS = 60
SEED = 12
THRESHOLD = 0.3
SLICE_BYTES = 1 << 20

STATISTICS = (
    "log_words",
    "word_chars",
    "longest_word",
    "letter_share",
    "upper_share",
    "digit_share",
    "wide_share",
    "space_share",
    "stop_share",
    "mark_share",
    "odd_share",
    "odd_end_share",
    "repeated_words",
    "line_chars",
    "stopped_lines",
    "repeated_lines",
)


def _table(signs: bytes) -> np.ndarray:
    out = np.zeros(256, bool)
    out[list(signs)] = True
    return out


_UPPER, _LOWER = _table(bytes(range(65, 91))), _table(bytes(range(97, 123)))
_DIGIT = _table(b"0123456789")
_SPACE = _table(b" \t\n\v\f\r")
_STOP = _table(b".,;:")
_MARK = _table(b"!?")
_ODD = _table(b"#$%&*+/<=>@[\\]^_`{|}~")
_END = _table(b".!?")


def _share(part: np.ndarray, whole: np.ndarray) -> np.ndarray:
    return part / np.maximum(whole, 1)


def statistics(texts: pa.Array) -> dict[str, np.ndarray]:
    """:data:`STATISTICS` of every text."""
    data, offsets = W.text_bytes(texts)
    rows = len(offsets) - 1

    def per_row(mask: np.ndarray) -> np.ndarray:
        total = np.zeros(len(mask) + 1, np.int64)
        np.cumsum(mask, out=total[1:])
        return total[offsets[1:]] - total[offsets[:-1]]

    chars = per_row((data & 0xC0) != 0x80)
    upper, lower = per_row(_UPPER[data]), per_row(_LOWER[data])
    wide = per_row(data >= 0xC0)

    words = W.words_of(texts)
    n_words, owner = words.counts, words.rows()
    inside = ~_SPACE[data]
    last = inside.copy()
    last[:-1] &= ~inside[1:]
    ends = offsets[1:][offsets[1:] > offsets[:-1]]
    last[ends - 1] = inside[ends - 1]
    sizes = _word_sizes(data, offsets, inside, last)
    longest = np.zeros(rows, np.int64)
    np.maximum.at(longest, owner, sizes)

    start, end = _lines(data, offsets)
    line_row = np.searchsorted(offsets, start, "right") - 1
    n_lines = np.bincount(line_row, minlength=rows)
    stopped = np.bincount(line_row[_END[data[end - 1]]], minlength=rows)
    line_bytes = np.bincount(line_row, end - start, minlength=rows)
    return {
        "log_words": np.log1p(n_words),
        "word_chars": _share(per_row(inside & ((data & 0xC0) != 0x80)), n_words),
        "longest_word": longest.astype(np.float64),
        "letter_share": _share(upper + lower + wide, chars),
        "upper_share": _share(upper, upper + lower),
        "digit_share": _share(per_row(_DIGIT[data]), chars),
        "wide_share": _share(wide, chars),
        "space_share": _share(per_row(_SPACE[data]), chars),
        "stop_share": _share(per_row(_STOP[data]), chars),
        "mark_share": _share(per_row(_MARK[data]), chars),
        "odd_share": _share(per_row(_ODD[data]), chars),
        "odd_end_share": _share(per_row(last & _ODD[data]), n_words),
        "repeated_words": _repeated(owner, words.hashes, rows),
        "line_chars": _share(line_bytes, n_lines),
        "stopped_lines": _share(stopped, n_lines),
        "repeated_lines": _repeated(line_row, W.span_hashes(data, start, end), rows),
    }


def _word_sizes(data, offsets, inside, last) -> np.ndarray:
    """Bytes of each word, in order."""
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    edges = offsets[:-1][offsets[1:] > offsets[:-1]]
    first[edges] = inside[edges]
    return np.flatnonzero(last) + 1 - np.flatnonzero(first)


def _lines(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the lines that are not empty begin and end."""
    begins = np.zeros(len(data) + 1, bool)
    begins[offsets] = True
    begins[np.flatnonzero(data == 10) + 1] = True
    edges = np.flatnonzero(begins)
    start, end = edges[:-1], edges[1:].copy()
    end -= data[end - 1] == 10
    return start[end > start], end[end > start]


def _repeated(owner: np.ndarray, hashes: np.ndarray, rows: int) -> np.ndarray:
    """Share of things that some earlier one of the same row equals."""
    key = W.mix(hashes ^ W.mix(owner.astype(np.uint64) + np.uint64(1)))
    _, at = np.unique(key, return_index=True)
    total = np.bincount(owner, minlength=rows)
    return 1 - _share(np.bincount(owner[at], minlength=rows) + (total == 0), total)


def with_statistics(docs: DataFrame) -> DataFrame:
    """Rows (doc_id, statistics) for rows (doc_id, text)."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, SLICE_BYTES, "text"):
            found = statistics(part.column("text"))
            columns = [pa.array(found[name].astype(np.float64)) for name in STATISTICS]
            yield pa.record_batch([part.column("doc_id"), *columns], names=["doc_id", *STATISTICS])

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, " + ", ".join(f"{name} double" for name in STATISTICS)
    return map_batches(docs.select("doc_id", "text"), work, schema)


# --- rules -------------------------------------------------------------------------------------


@dataclass(frozen=True)
class Rule:
    """Bounds (statistic, above, up to); a row fits if above < value <= up to for all of them."""

    bounds: tuple[tuple[str, float, float], ...]

    def fits(self, row: Mapping[str, float]) -> bool:
        return all(low < row[name] <= high for name, low, high in self.bounds)

    def column(self) -> Column:
        out = F.lit(True)
        for name, low, high in self.bounds:
            if low > -math.inf:
                out &= F.col(name) > low
            if high < math.inf:
                out &= F.col(name) <= high
        return out


def tree_paths(description: str, names: tuple[str, ...] = STATISTICS) -> list[Rule]:
    """A rule for every node but the roots of the trees, as Spark ML writes them out.

    Conditions on one statistic become one pair of bounds. Equal rules, and of the two sides of a
    first split the second, which says the same, are left out.
    """
    found: dict[Rule, None] = {}
    path: list[tuple[str, float, float]] = []
    for line in description.splitlines():
        match = re.match(r"(\s*)(If|Else) \(feature (\d+) (<=|>) (\S+)\)", line)
        if not match:
            if line.lstrip().startswith("Tree "):
                path, outer = [], None
            continue
        indent, branch, feature, sign, value = match.groups()
        outer = len(indent) if outer is None else outer
        level = len(indent) - outer
        bound = (-math.inf, float(value)) if sign == "<=" else (float(value), math.inf)
        path[level:] = [(names[int(feature)], *bound)]
        if level or branch == "If":
            merged: dict[str, tuple[float, float]] = {}
            for name, low, high in path:
                before = merged.get(name, (-math.inf, math.inf))
                merged[name] = (max(low, before[0]), min(high, before[1]))
            found[Rule(tuple((n, *merged[n]) for n in sorted(merged)))] = None
    return list(found)


@dataclass(frozen=True)
class RuleModel:
    rules: tuple[Rule, ...]
    weights: tuple[float, ...]
    intercept: float

    def column(self) -> Column:
        """The probability of label 1 as an expression over the columns :data:`STATISTICS`."""
        total = F.lit(self.intercept)
        for rule, weight in zip(self.rules, self.weights, strict=True):
            total += F.when(rule.column(), F.lit(weight)).otherwise(F.lit(0.0))
        return F.lit(1.0) / (F.lit(1.0) + F.exp(-total))

    def score(self, row: Mapping[str, float]) -> float:
        parts = zip(self.rules, self.weights, strict=True)
        total = self.intercept + sum(w for rule, w in parts if rule.fits(row))
        return 1 / (1 + math.exp(-total))


def fit(
    rows: DataFrame,
    trees: int = TREES,
    depth: int = DEPTH,
    penalty: float = PENALTY,
    seed: int = SEED,
) -> RuleModel:
    """Learns from stored rows with :data:`STATISTICS` and ``label`` (0 or 1)."""
    counts = {r["label"]: r["count"] for r in rows.groupBy("label").count().collect()}
    ones, total = counts.get(1, 0), sum(counts.values())
    if len(counts) < 2:
        return RuleModel((), (), math.log((ones + 1) / (total - ones + 1)))
    label = F.col("label").cast("double").alias("label")
    names = F.array(*[F.col(name) for name in STATISTICS])
    forest = RandomForestClassifier(
        numTrees=trees, maxDepth=depth, featureSubsetStrategy="onethird", seed=seed
    ).fit(rows.select(label, array_to_vector(names).alias("features")))
    rules = tree_paths(forest.toDebugString)
    if not rules:
        return RuleModel((), (), math.log((ones + 1) / (total - ones + 1)))
    hits = F.array(*[F.when(rule.column(), 1.0).otherwise(0.0) for rule in rules])
    lasso = LogisticRegression(elasticNetParam=1.0, regParam=penalty, maxIter=ITERATIONS).fit(
        rows.select(label, array_to_vector(hits).alias("features"))
    )
    kept = [(r, float(w)) for r, w in zip(rules, lasso.coefficients, strict=True) if w]
    return RuleModel(
        tuple(r for r, _ in kept), tuple(w for _, w in kept), float(lasso.intercept)
    )


def majority(labels: DataFrame, column: str) -> DataFrame:
    """Rows (doc_id, label), one per id."""
    known = labels.where(f"doc_id IS NOT NULL AND `{column}` IN (0, 1)")
    share = F.avg(F.col(column).cast("double"))
    return known.groupBy("doc_id").agg((share >= 0.5).cast("int").alias("label"))


def score_documents(
    docs: DataFrame, labels: DataFrame, divisor: int = 5, remainder: int = 0
) -> DataFrame:
    """Rows (doc_id, held_out, score, predicted) for all documents (doc_id, text).

    Rows whose id's crc32 modulo ``divisor`` is ``remainder`` are held out from training.
    """
    known = stored(with_statistics(docs), "statistics")
    held_out = id_remainder("doc_id", divisor) == remainder
    training = stored(
        known.where(~held_out)
        .join(majority(labels, "quality"), "doc_id")
        .select("label", *STATISTICS),
        "labelled",
    )
    scored = known.select(
        "doc_id", held_out.alias("held_out"), fit(training).column().alias("score")
    )
    return scored.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
