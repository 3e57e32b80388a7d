"""Fill-in-the-middle: cut texts at units into prefix, middle and suffix, and join them anew.

A text is its units, `[A-Za-z]+|[^A-Za-z]` over code points, one after the other. Two draws place
the cuts, a third says if a text is left plain and a fourth which of the two orders it takes.
Draws come from a hash of the row's id (``draws_of``), so a row always gives the same result.

    psm   <P> prefix <S> suffix <M> middle
    spm   <S> suffix <P> prefix <M> middle

The work on a batch is ``pyarrow.compute`` alone: units are split into list arrays, flattened with
the index of their text, numbered within it, filtered by role, put back into one list per text and
role, and joined. ``restore`` rebuilds the text from form and output: a text that holds a marker stays
plain, so the first marker of each kind is always the one that was set.

Rows: a null text is empty, and empty texts are plain. A null id draws like the empty id.
Repeated rows give repeated results. A text of any length is cut whole, in a batch of its own.
Other columns are carried along, whatever their names; those named like a result are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import map_batches, slices

SLICE_BYTES = 1 << 20
SEED = "1"
PLAIN, PSM, SPM = "plain", "psm", "spm"
RESULTS = ("n", "form", "prefix_chars", "middle_chars", "output")

# A unit in bytes of UTF-8, and a byte that no UTF-8 text holds.
_UNIT = rb"([A-Za-z]+|[\x00-\x7F]|[\xC0-\xFF][\x80-\xBF]*)"
_EDGE = b"\xff"


@dataclass(frozen=True)
class Markers:
    prefix: str = "<P>"
    suffix: str = "<S>"
    middle: str = "<M>"

    @property
    def all(self) -> tuple[str, str, str]:
        return self.prefix, self.suffix, self.middle


@dataclass(frozen=True)
class Shares:
    """Of a hundred: texts that are transformed, and of these the ones in suffix-first order."""

    transformed: int = 90
    suffix_first: int = 20


def draws_of(id_column: str, seed: str = SEED) -> list[Column]:
    """Four unsigned 32-bit numbers: the first groups of the SHA-256 of seed and id."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_column).cast("string"), F.lit("")))
    digest = F.sha2(text.cast("binary"), 256)
    return [F.conv(F.substring(digest, 1 + 8 * k, 8), 16, 10).cast("long") for k in range(4)]


def _remainder(a, b) -> pa.Array:
    return pc.subtract(a, pc.multiply(pc.divide(a, b), b))


def _lists(values: pa.Array, sizes: pa.Array) -> pa.Array:
    ends = pc.cumulative_sum(sizes)
    offsets = pa.concat_arrays([pa.array([0], pa.int64()), ends.cast(pa.int64())])
    return pa.LargeListArray.from_arrays(offsets, values)


def units(texts: pa.Array) -> tuple[pa.Array, pa.Array]:
    """The units of all texts, and how many each text has."""
    raw = texts.cast(pa.large_string()).cast(pa.large_binary())
    # Every unit is followed by an edge, so that each split ends in one empty piece.
    marked = pc.replace_substring_regex(raw, pattern=_UNIT, replacement=rb"\1" + _EDGE)
    split = pc.split_pattern(marked, pattern=_EDGE).cast(pa.large_list(pa.large_binary()))
    counts = pc.subtract(pc.list_value_length(split), pa.scalar(1, pa.int64()))
    parents = pc.list_parent_indices(split)
    ordinal = _ordinals(parents, split)
    inside = pc.less(ordinal, pc.take(counts, parents))
    return pc.filter(pc.list_flatten(split), inside), counts


def _ordinals(parents: pa.Array, lists: pa.Array) -> pa.Array:
    """The place of each flattened value within its list."""
    sizes = pc.list_value_length(lists).cast(pa.int64())
    begins = pc.subtract(pc.cumulative_sum(sizes), sizes)
    return pc.subtract(pa.array(np.arange(len(parents))), pc.take(begins, parents))


def transform_batch(
    texts: pa.Array, draws: list[pa.Array], markers: Markers = Markers(), shares: Shares = Shares()
) -> dict[str, pa.Array]:
    """The columns :data:`RESULTS` for texts and their four draws."""
    texts = pc.fill_null(texts, "")
    flat, n = units(texts)
    places = pc.add(n, pa.scalar(1, pa.int64()))
    one, two = (_remainder(h, places) for h in draws[:2])
    low, high = pc.min_element_wise(one, two), pc.max_element_wise(one, two)
    lists = _lists(flat, n)
    parents = pc.list_parent_indices(lists)
    ordinal = _ordinals(parents, lists)
    below = pc.less(ordinal, pc.take(low, parents))
    above = pc.greater_equal(ordinal, pc.take(high, parents))
    roles = {
        "prefix": (below, low),
        "middle": (pc.invert(pc.or_(below, above)), pc.subtract(high, low)),
        "suffix": (above, pc.subtract(n, high)),
    }
    empty = pa.scalar(b"", pa.large_binary())
    part = {
        name: pc.binary_join(_lists(pc.filter(flat, mask), sizes), empty).cast(pa.large_string())
        for name, (mask, sizes) in roles.items()
    }
    held = [pc.match_substring(texts, pattern=m) for m in markers.all]
    plain = pc.or_(
        pc.or_(pc.equal(n, 0), pc.or_(held[0], pc.or_(held[1], held[2]))),
        pc.greater_equal(_remainder(draws[2], pa.scalar(100, pa.int64())), shares.transformed),
    )
    spm = pc.less(_remainder(draws[3], pa.scalar(100, pa.int64())), shares.suffix_first)
    p, s, m = (pa.scalar(x, pa.large_string()) for x in markers.all)
    nothing = pa.scalar("", pa.large_string())
    join = pc.binary_join_element_wise
    psm_text = join(p, part["prefix"], s, part["suffix"], m, part["middle"], nothing)
    spm_text = join(s, part["suffix"], p, part["prefix"], m, part["middle"], nothing)
    none = pa.scalar(None, pa.int64())
    return {
        "n": n,
        "form": pc.if_else(plain, PLAIN, pc.if_else(spm, SPM, PSM)),
        "prefix_chars": pc.if_else(plain, none, pc.utf8_length(part["prefix"])),
        "middle_chars": pc.if_else(plain, none, pc.utf8_length(part["middle"])),
        "output": pc.if_else(
            plain, texts.cast(pa.large_string()), pc.if_else(spm, spm_text, psm_text)
        ),
    }


def _split(texts: pa.Array, marker: str) -> tuple[pa.Array, pa.Array]:
    """What stands before and after the first ``marker`` of each text."""
    both = pc.split_pattern(texts, pattern=marker, max_splits=1)
    return pc.list_element(both, 0), pc.list_element(both, 1)


def restore_batch(forms: pa.Array, outputs: pa.Array, markers: Markers = Markers()) -> pa.Array:
    """The texts that gave these outputs. An output that is not in its form is an error."""
    outputs = outputs.cast(pa.large_string())
    rows, texts = [], []
    for form in (PLAIN, PSM, SPM):
        mask = pc.equal(forms, form)
        own = pc.filter(outputs, mask)
        if form != PLAIN:
            one, two = markers.prefix, markers.suffix
            if form == SPM:
                one, two = two, one
            _, rest = _split(own, one)
            first, rest = _split(rest, two)
            second, middle = _split(rest, markers.middle)
            prefix, suffix = (first, second) if form == PSM else (second, first)
            own = pc.binary_join_element_wise(
                prefix, middle, suffix, pa.scalar("", pa.large_string())
            )
        rows.append(pc.indices_nonzero(mask))
        texts.append(own)
    return pa.concat_arrays(texts).take(pc.sort_indices(pa.concat_arrays(rows)))


def _with_kept(rows: DataFrame, kept: list[str], inputs: dict, results: str, work) -> DataFrame:
    """``kept`` columns of ``rows`` and the results of ``work`` on a record batch of ``inputs``.

    Columns travel under names of our own, so theirs may be anything.
    """
    fields = [rows.schema[c] for c in kept]
    own = [f"_c{k}" for k in range(len(fields))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in slices(batches, SLICE_BYTES, "_text"):
            made = work(part)
            columns = [part.column(c) for c in own] + list(made.values())
            yield pa.record_batch(columns, names=[*own, *made])

    inner = rows.select(
        *[F.col(f"`{f.name}`").alias(c) for f, c in zip(fields, own, strict=True)],
        *[value.alias(name) for name, value in inputs.items()],
    )
    schema = "".join(f"{c} {f.dataType.simpleString()}, " for c, f in zip(own, fields, strict=True))
    out = map_batches(inner, run, schema + results)
    names = [part.split()[0] for part in results.split(", ")]
    return out.select(
        *[F.col(c).alias(f.name) for c, f in zip(own, fields, strict=True)], *names
    )


def transform(
    rows: DataFrame,
    id_column: str = "doc_id",
    keep: list[str] | None = None,
    seed: str = SEED,
    markers: Markers = Markers(),
    shares: Shares = Shares(),
) -> DataFrame:
    """Adds :data:`RESULTS` to rows with an id and a ``text``; ``keep`` names the columns to stay."""
    kept = [c for c in (rows.columns if keep is None else keep) if c not in RESULTS]

    def work(part: pa.RecordBatch) -> dict[str, pa.Array]:
        draws = [part.column(f"_h{k}") for k in range(4)]
        made = transform_batch(part.column("_text"), draws, markers, shares)
        return made | {"output": made["output"].cast(pa.string())}

    inputs = {"_text": F.col("text"), **{f"_h{k}": d for k, d in enumerate(draws_of(id_column, seed))}}
    results = "n long, form string, prefix_chars long, middle_chars long, output string"
    return _with_kept(rows, kept, inputs, results, work)


def restore(rows: DataFrame, markers: Markers = Markers()) -> DataFrame:
    """Adds ``restored``, the text rebuilt from ``form`` and ``output`` alone."""
    kept = [c for c in rows.columns if c not in ("restored", "output")]

    def work(part: pa.RecordBatch) -> dict[str, pa.Array]:
        texts = restore_batch(part.column("_form"), part.column("_text"), markers)
        return {"output": part.column("_text"), "restored": texts.cast(pa.string())}

    inputs = {"_text": F.col("output"), "_form": F.col("form")}
    return _with_kept(rows, kept, inputs, "output string, restored string", work)


def digests(rows: DataFrame) -> DataFrame:
    """The result of :func:`transform` on documents with its texts as digests."""
    sha = lambda c: F.sha2(F.col(c).cast("binary"), 256)
    return restore(rows).select(
        "doc_id",
        "n",
        "form",
        "prefix_chars",
        "middle_chars",
        sha("output").alias("output_sha256"),
        sha("restored").alias("restored_sha256"),
    )


ORACLE_SQL = """
WITH cut AS (
  SELECT doc_id, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS u,
         sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h
  FROM documents
), drawn AS (
  SELECT doc_id, t, u, len(u) AS n,
         CAST('0x' || substr(h, 1, 8) AS BIGINT) AS h1, CAST('0x' || substr(h, 9, 8) AS BIGINT) AS h2,
         CAST('0x' || substr(h, 17, 8) AS BIGINT) AS h3, CAST('0x' || substr(h, 25, 8) AS BIGINT) AS h4
  FROM cut
), placed AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
         CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>')
                   OR h3 % 100 >= 90 THEN 'plain'
              WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM drawn
), parts AS (
  SELECT *, coalesce(array_to_string(u[1:a], ''), '') AS p,
         coalesce(array_to_string(u[a + 1:b], ''), '') AS m,
         coalesce(array_to_string(u[b + 1:n], ''), '') AS s
  FROM placed
)
SELECT doc_id, n, form,
       CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
                        ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(t) AS restored_sha256
FROM parts
"""
