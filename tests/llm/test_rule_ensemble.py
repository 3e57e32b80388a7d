import math
import zlib
from collections import Counter

import pyarrow as pa
import pytest
from brute import words
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import rule_ensemble as op

SF = "/root/testdata/sf0.01"


def share(a, b):
    return a / b if b else 0.0


def plain_statistics(text):
    text = text or ""
    w = words(text)
    raw = [x for x in text.replace("\t", " ").replace("\n", " ").replace("\v", " ").replace("\f", " ").replace("\r", " ").split(" ") if x]
    lines = [x for x in text.split("\n") if x]
    upper = sum("A" <= c <= "Z" for c in text)
    lower = sum("a" <= c <= "z" for c in text)
    wide = sum(ord(c) > 127 for c in text)
    of = lambda signs: share(sum(c in signs for c in text), len(text))
    odd = "#$%&*+/<=>@[\\]^_`{|}~"
    return {
        "log_words": math.log1p(len(w)),
        "word_chars": share(sum(map(len, w)), len(w)),
        "longest_word": max((len(x.encode()) for x in w), default=0),
        "letter_share": share(upper + lower + wide, len(text)),
        "upper_share": share(upper, upper + lower),
        "digit_share": of("0123456789"),
        "wide_share": share(wide, len(text)),
        "space_share": of(" \t\n\v\f\r"),
        "stop_share": of(".,;:"),
        "mark_share": of("!?"),
        "odd_share": of(odd),
        "odd_end_share": share(sum(x[-1] in odd for x in raw), len(raw)),
        "repeated_words": share(len(w) - len(set(w)), len(w)),
        "line_chars": share(sum(len(x.encode()) for x in lines), len(lines)),
        "stopped_lines": share(sum(x[-1] in ".!?" for x in lines), len(lines)),
        "repeated_lines": share(len(lines) - len(set(lines)), len(lines)),
    }


def check_statistics(texts):
    found = op.statistics(pa.array(texts, pa.string()))
    assert tuple(found) == op.STATISTICS
    for k, text in enumerate(texts):
        want = plain_statistics(text)
        got = {name: float(found[name][k]) for name in op.STATISTICS}
        assert got == pytest.approx(want), text


@settings(max_examples=150, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="aB é!#.1\n\t🙂|", max_size=25)), max_size=7))
def test_statistics_by_definition(texts):
    check_statistics(texts)


def test_statistics_of_source_texts_and_odd_ones(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    check_statistics([r.text for r in rows] + [None, "", " \n ", "\n\n", "x" * 100_000, "a b\n" * 50_000])
    check_statistics([])


FOREST = """RandomForestClassificationModel: uid=x, numTrees=2, numClasses=2, numFeatures=16
  Tree 0 (weight 1.0):
    If (feature 10 <= 0.25)
     If (feature 0 <= 3.5)
      Predict: 0.0
     Else (feature 0 > 3.5)
      If (feature 0 <= 9.0E-1)
       Predict: 0.0
      Else (feature 0 > 9.0E-1)
       Predict: 1.0
    Else (feature 10 > 0.25)
     Predict: 0.0
  Tree 1 (weight 1.0):
    If (feature 10 <= 0.25)
     Predict: 1.0
    Else (feature 10 > 0.25)
     Predict: 0.0
"""


def test_paths_of_trees_become_rules():
    inf = math.inf
    odd = ("odd_share", -inf, 0.25)
    assert op.tree_paths(FOREST) == [
        op.Rule((odd,)),
        op.Rule((("log_words", -inf, 3.5), odd)),
        op.Rule((("log_words", 3.5, inf), odd)),
        op.Rule((("log_words", 3.5, 0.9), odd)),
    ]


def test_compiled_expression_equals_the_rules(spark):
    model = op.RuleModel(tuple(op.tree_paths(FOREST)), (1.5, -2.0, 0.25, 4.0), -0.5)
    docs = spark.createDataFrame(
        [(1, "a few words"), (2, "###### ###"), (3, None), (4, "word " * 500), (None, "##")],
        "doc_id long, text string",
    )
    rows = op.with_statistics(docs).withColumn("score", model.column()).collect()
    assert len(rows) == 5
    for r in rows:
        assert r.score == pytest.approx(model.score(r.asDict()), abs=1e-12)


def test_held_out_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    rows = op.score_documents(docs, labels).collect()
    assert Counter(r.doc_id for r in rows) == Counter(r.doc_id for r in docs.select("doc_id").collect())
    truth = {r.doc_id: r.quality for r in labels.collect()}
    held = [r for r in rows if r.held_out and r.doc_id in truth]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in rows)
    assert len(held) > 40
    assert sum(r.predicted == truth[r.doc_id] for r in held) >= 0.97 * len(held)


def test_odd_rows_labels_and_names(spark):
    docs = spark.createDataFrame(
        [(k, f"good words here {k}." if k % 2 else "##### $$$$ %%%%", "a", 1.0) for k in range(60)]
        + [(3, None, "b", None), (3, "", None, 2.0), (None, "no id", "c", 0.0)],
        "doc_id long, text string, label string, log_words double",
    )
    labels = spark.createDataFrame(
        [(k, k % 2, 0) for k in range(60)] * 2 + [(1, None, 1), (None, 1, 1), (999, 0, 0), (5, 0, None)],
        "doc_id long, quality int, toxic int",
    )
    rows = op.score_documents(docs, labels).collect()
    assert len(rows) == 63 and all(0 <= r.score <= 1 for r in rows)
    by_id = {r.doc_id: r for r in rows if r.doc_id not in (3, None)}
    assert all(by_id[k].predicted == k % 2 for k in by_id)
    for none in (labels.where("quality = 7"), labels.where("doc_id = 999")):
        assert {r.score for r in op.score_documents(docs, none).collect()} == {0.5}
    only = op.score_documents(docs, labels.where("quality = 1 AND doc_id = 1")).collect()
    assert {round(r.score, 9) for r in only} == {round(2 / 3, 9)}
    assert op.score_documents(docs.limit(0), labels).count() == 0
