import hashlib
import re

import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.llm import fim as op


def plain_version(doc_id, text):
    """Form, units and pieces of one text by the definition."""
    text = text or ""
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]
    n = len(units)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    p, m, s = ("".join(x) for x in (units[:a], units[a:b], units[b:]))
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return n, "plain", None, None, text
    if h[3] % 100 < 20:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}"
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}"


def check(spark, rows):
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    got = op.restore(op.transform(frame)).collect()
    key = lambda r: tuple(str(x) for x in r)
    want = sorted(((i, t, *plain_version(i, t), t or "") for i, t in rows), key=key)
    found = sorted(
        ((r.doc_id, r.text, r.n, r.form, r.prefix_chars, r.middle_chars, r.output, r.restored) for r in got),
        key=key,
    )
    assert found == want
    return got


def test_against_the_definition(spark):
    texts = [None, "", " ", "a", "Ab cd", "é ü　x", "🙂🙂", "a<P>b", "x <S", "<<S>", "<M", "\n\r\n\t\x00z",
             "word1 word2, end.", "é́", "\U0010ffff", "\x7f\x80"]
    rows = [(100 * k + j, t) for k, t in enumerate(texts) for j in range(12)]
    rows += [(None, "no id here"), (-5, "below zero"), (7, "same"), (7, "same"), (7, "other")]
    got = check(spark, rows)
    assert {r.form for r in got} == {"plain", "psm", "spm"}


def test_source_table(spark):
    frame = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    check(spark, [tuple(r) for r in frame.collect()])


def test_very_long_text(spark):
    check(spark, [(k, f"{'long words, é! ' * 200_000}{k}") for k in range(3)])


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 2**40), st.text(alphabet="ab Z<>PSM.é\n🙂", max_size=30)), max_size=8))
def test_any_texts_come_back(rows):
    texts = pa.array([t for _, t in rows], pa.string())
    hexes = [hashlib.sha256(f"1:{i}".encode()).hexdigest() for i, _ in rows]
    draws = [pa.array([int(h[8 * k : 8 * k + 8], 16) for h in hexes], pa.int64()) for k in range(4)]
    made = op.transform_batch(texts, draws)
    out = [tuple(made[c][k].as_py() for c in op.RESULTS) for k in range(len(rows))]
    assert out == [plain_version(i, t) for i, t in rows]
    assert op.restore_batch(made["form"], made["output"]).to_pylist() == [t for _, t in rows]


def test_other_markers_and_shares(spark):
    frame = spark.createDataFrame([(k, f"one <P> two {k}") for k in range(40)], "doc_id long, text string")
    markers = op.Markers("[pre]", "[suf]", "[mid]")
    made = op.transform(frame, seed="9", markers=markers, shares=op.Shares(100, 100))
    rows = op.restore(made, markers).collect()
    assert {r.form for r in rows} == {"spm"} and all(r.restored == r.text for r in rows)
    assert all(r.output.startswith("[suf]") for r in rows)


def test_empty_table_and_clashing_names(spark):
    frame = spark.createDataFrame(
        [(1, "some text", 5, "x", 0)], "doc_id long, text string, n int, form string, _text int"
    )
    row = op.transform(frame).first()
    assert row["_text"] == 0 and row.n == 3 and row.form in ("plain", "psm", "spm")
    empty = op.restore(op.transform(frame.where(F.lit(False))))
    assert empty.count() == 0 and "restored" in empty.columns
