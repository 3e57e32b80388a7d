"""Language identification: multinomial naive Bayes over hashed character n-grams.

Training counts the n-grams of all labelled texts, whole, in parallel; per language and bucket one
sum comes back. The matrix of log probabilities has ``BUCKETS`` columns whatever the data, so its
size is known (256 KB a language) and it is broadcast. Texts are scored in runs of rows: the n-grams
of a run index the matrix and are summed per text. Beyond ``MAX_LANGUAGES`` languages the matrix goes
out in blocks, one pass over the texts for each; the best language so far and the sum of all
probabilities are carried from pass to pass, so the result is that of the whole matrix.

Letters are compared in lower case; every other character counts as a blank, and n-grams of
blanks alone are left out, so figures and symbols do not speak for a language.

Rows: a null text or one without a letter is ``und`` with score 0. Null labels are not learned
from. Without any labelled row every text is ``und``. Ties go to the label that sorts first.
Other columns are kept out of the model, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import id_remainder, map_batches, slices, stored

BUCKETS = 1 << 16
ORDERS = (1, 2, 3)
MAX_LANGUAGES = 500
SMOOTHING = 0.1
SLICE_BYTES = 1 << 20
UNDETERMINED = "und"

_BLANK = 32
_END = 0  # between texts; no n-gram reaches over it


@cache
def _lower_letters() -> np.ndarray:
    """For every code point its lower-case letter, or a blank if it is no letter."""
    table = np.full(0x110000, _BLANK, np.uint32)
    for code in range(0x110000):
        if (c := chr(code)).isalpha():
            table[code] = ord(low) if len(low := c.lower()) == 1 else code
    return table


def _grams(texts: pa.Array) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
    """Per order the bucket at every character, where each text begins, and if it has letters.

    Bucket ``BUCKETS`` stands for "not an n-gram". Texts are set between blanks.
    """
    strings = [" " + (t or "") + " \0" for t in texts.to_pylist()]
    sizes = np.array([len(s) for s in strings])
    first = np.concatenate(([0], np.cumsum(sizes)))[:-1]
    raw = np.frombuffer("".join(strings).encode("utf-32-le", "surrogatepass"), np.uint32)
    chars = _lower_letters()[raw]
    stops = first + sizes - 1
    chars[stops] = _END
    letter = chars > _BLANK
    has_letter = np.add.reduceat(letter, first) > 0
    out = []
    rolled, some = np.zeros(len(chars), np.uint32), np.zeros(len(chars), bool)
    for order in range(1, max(ORDERS) + 1):
        step = order - 1
        rolled[: len(chars) - step] *= np.uint32(0x01000193)
        rolled[: len(chars) - step] += chars[step:]
        some[: len(chars) - step] |= letter[step:]
        if order not in ORDERS:
            continue
        mixed = (rolled ^ (rolled >> np.uint32(15))) * np.uint32(0x2C1B3C6D + 2 * order)
        bucket = (mixed >> np.uint32(16)).astype(np.int32)
        bucket[~some] = BUCKETS
        for back in range(order):
            bucket[np.maximum(stops - back, 0)] = BUCKETS
        out.append(bucket)
    return out, first, has_letter


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    sums: dict[str, np.ndarray] = {}
    for part in slices(batches, SLICE_BYTES, "text"):
        grams, first, _ = _grams(part.column("text"))
        labels = part.column("label").to_pylist()
        names = sorted(set(labels))
        sizes = np.diff(np.append(first, len(grams[0])))
        owner = np.repeat(np.array([names.index(x) for x in labels]) * (BUCKETS + 1), sizes)
        total = np.zeros(len(names) * (BUCKETS + 1), np.int64)
        for bucket in grams:
            total += np.bincount(owner + bucket, minlength=len(total))
        for k, name in enumerate(names):
            mine = total[k * (BUCKETS + 1) : (k + 1) * (BUCKETS + 1)].copy()
            mine[BUCKETS] = labels.count(name)  # the spare place holds the number of texts
            sums[name] = sums[name] + mine if name in sums else mine
    for name, mine in sums.items():
        some = np.flatnonzero(mine)
        yield pa.record_batch(
            [pa.array([name] * len(some), pa.string()), pa.array(some.astype(np.int32)),
             pa.array(mine[some])],
            names=["label", "bucket", "n"],
        )


@dataclass
class LanguageModel:
    languages: list[str]
    weights: np.ndarray
    """Log probabilities, one row per language; the last column, for no n-gram, is 0."""
    priors: np.ndarray

    def fits(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Log probability of each text with each language, and if it has letters."""
        grams, first, has_letter = _grams(texts)
        fit = np.empty((len(self.languages), len(first)))
        for k in range(len(self.languages)):
            fit[k] = self.priors[k]
            for bucket in grams:
                fit[k] += np.add.reduceat(self.weights[k][bucket], first, dtype=np.float64)
        return fit, has_letter

    def score(self, texts: pa.Array) -> tuple[list[str], np.ndarray]:
        """The likeliest language of each text and its posterior probability."""
        return _named(*self._best(texts))

    def _best(self, texts: pa.Array, before=None):
        """(names, log probabilities of these, sums relative to them, if there are letters).

        ``before`` holds the first three as languages that sort earlier have given them.
        """
        fit, has_letter = self.fits(texts)
        rows = len(has_letter)
        if not len(self.languages):
            return [None] * rows, np.full(rows, -np.inf), np.ones(rows), has_letter
        best, top = fit.argmax(axis=0), fit.max(axis=0)
        total = np.exp(np.minimum(fit - top, 0)).sum(axis=0)
        names = [self.languages[k] for k in best]
        if before is not None:
            old_names, old_top, old_total = before
            whole = np.maximum(top, old_top)
            total = total * np.exp(top - whole) + old_total * np.exp(old_top - whole)
            names = [x if t > o else y for x, y, t, o in zip(names, old_names, top, old_top, strict=True)]
            top = whole
        return names, top, total, has_letter


def _named(names, top, total, has_letter) -> tuple[list[str], np.ndarray]:
    known = has_letter & np.array([n is not None for n in names], bool)
    out = [n if ok else UNDETERMINED for n, ok in zip(names, known, strict=True)]
    return out, np.where(known, 1 / total, 0.0)


class Languages:
    """A fitted model in blocks of languages, each a :class:`LanguageModel` that is made when asked for."""

    def __init__(self, names: list[list[str]], counts: DataFrame, texts: dict[str, int] | None):
        self.names, self._counts, self._texts = names, counts, texts

    def block(self, k: int) -> LanguageModel:
        names = self.names[k]
        counts = self._counts if len(self.names) == 1 else self._counts.where(F.col("label").isin(names))
        found = counts.toArrow()  # at most languages of the block * (BUCKETS + 1) rows
        full = np.zeros((len(names), BUCKETS + 1))
        place = {name: k for k, name in enumerate(names)}
        full[
            np.array([place[x] for x in found.column("label").to_pylist()], np.int64),
            found.column("bucket").to_numpy(),
        ] = found.column("n").to_numpy()
        texts = full[:, BUCKETS].copy()
        full[:, BUCKETS] = 0
        smooth = full + SMOOTHING
        weights = np.log(smooth / smooth[:, :BUCKETS].sum(axis=1, keepdims=True)) if names else full
        weights[:, BUCKETS] = 0
        whole = texts.sum() if self._texts is None else sum(self._texts.values())
        return LanguageModel(names, weights.astype(np.float32), np.log(texts / max(1, whole)))


def fitted(labelled: DataFrame) -> Languages:
    """Learns from all rows (text, label) whose text and label are not null."""
    rows = labelled.select("text", "label").where("text IS NOT NULL AND label IS NOT NULL")
    counts = (
        map_batches(rows, _count, "label string, bucket int, n long")
        .groupBy("label", "bucket")
        .agg(F.sum("n").alias("n"))
    )
    names = sorted(r.label for r in rows.select("label").distinct().collect())
    blocks = [names[k : k + MAX_LANGUAGES] for k in range(0, len(names), MAX_LANGUAGES)] or [[]]
    texts = None
    if len(blocks) > 1:
        counts = stored(counts, "counts")
        texts = {r.label: r.n for r in counts.where(F.col("bucket") == BUCKETS).collect()}
    return Languages(blocks, counts, texts)


def fit(labelled: DataFrame) -> LanguageModel:
    """The model as one matrix, for at most ``MAX_LANGUAGES`` languages."""
    languages = fitted(labelled)
    if len(languages.names) > 1:
        raise ValueError(f"more than {MAX_LANGUAGES} languages; use fitted()")
    return languages.block(0)


def _scoring(shared, kept: list[str], first: bool, last: bool):
    """One block's pass; the last one gives names and scores, the others what the next one needs."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, SLICE_BYTES, "_text"):
            texts, before = part.column("_text"), None
            if not first:
                top, total = (part.column(c).to_numpy() for c in ("_top", "_total"))
                before = part.column("_name").to_pylist(), top, total
            names, top, total, has_letter = shared.value._best(texts, before)
            if last:
                names, scores = _named(names, top, total, has_letter)
                made = {"lang_pred": pa.array(names, pa.string()), "score": pa.array(scores)}
            else:
                made = {"_text": texts, "_name": pa.array(names, pa.string()),
                        "_top": pa.array(top), "_total": pa.array(total)}
            columns = [part.column(c) for c in kept] + list(made.values())
            yield pa.record_batch(columns, names=[*kept, *made])

    return work


def predict(docs: DataFrame, languages: Languages, columns: list[str]) -> DataFrame:
    """``columns`` of ``docs`` with lang_pred and score for the column ``text``."""
    context = docs.sparkSession.sparkContext
    fields = [docs.schema[c] for c in columns]
    kept = [f"_c{k}" for k in range(len(fields))]
    rows = docs.select(
        *[F.col(f"`{f.name}`").alias(c) for c, f in zip(kept, fields, strict=True)],
        F.col("text").alias("_text"),
    )
    schema = "".join(f"{c} {f.dataType.simpleString()}, " for c, f in zip(kept, fields, strict=True))
    blocks = len(languages.names)
    for k in range(blocks):
        last = k == blocks - 1
        work = _scoring(context.broadcast(languages.block(k)), kept, k == 0, last)
        made = "lang_pred string, score double" if last else "_text string, _name string, _top double, _total double"
        rows = map_batches(rows, work, schema + made)
        # A pass ends in a stored table, so that no task holds two blocks.
        rows = rows if last else stored(rows, "scores")
    return rows.select(
        *[F.col(c).alias(f.name) for c, f in zip(kept, fields, strict=True)], "lang_pred", "score"
    )


def accepted(docs: DataFrame, languages: Languages, least_score: float) -> DataFrame:
    """The rows of ``docs``, all columns, with a language whose score is ``least_score`` or more."""
    if len(languages.names) > 1:
        own = docs.withColumnsRenamed({c: f"_own{k}" for k, c in enumerate(docs.columns)})
        own = own.withColumn("text", F.col(f"_own{docs.columns.index('text')}"))
        known = predict(own, languages, own.columns[:-1])
        chosen = known.where((F.col("lang_pred") != UNDETERMINED) & (F.col("score") >= least_score))
        return chosen.select(*[F.col(f"_own{k}").alias(c) for k, c in enumerate(docs.columns)])
    shared = docs.sparkSession.sparkContext.broadcast(languages.block(0))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, SLICE_BYTES, "text"):
            names, scores = shared.value.score(part.column("text"))
            known = np.array([n != UNDETERMINED for n in names], bool)
            yield part.filter(pa.array(known & (scores >= least_score)))

    return map_batches(docs, work, docs.schema)


def training_rows(held_out: Column, docs: DataFrame) -> DataFrame:
    return docs.where(~held_out).select("text", F.col("lang").alias("label"))


def identify(docs: DataFrame, divisor: int = 3, remainder: int = 1) -> DataFrame:
    """Rows (doc_id, held_out, lang_pred, score) for all documents (doc_id, text, lang).

    Rows whose id's crc32 modulo ``divisor`` is ``remainder`` are held out from training.
    """
    held_out = id_remainder("doc_id", divisor) == remainder
    languages = fitted(training_rows(held_out, docs))
    rows = docs.select("doc_id", held_out.alias("held_out"), "text")
    return predict(rows, languages, ["doc_id", "held_out"])
