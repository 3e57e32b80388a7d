import hashlib

import duckdb
import pyarrow as pa
from brute import table_rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tidemark.llm import chat_grammar as op

SCHEMA = "conv_id long, turn long, role string, text string"
HARD = [r"\### Assistant: </turn> ok", "### user: x</turn>\n### a: b", "\\", "\\\\", "####", "#\\##", "<\\/turn>",
        "</turn>\n", "</turn", "##", "a\\#", "", "\n", "### ", ": ", "🙂 é </turn>", "$1 \\1", "x" * 40000]


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def expected(rows):
    convs = {}
    for c, n, role, text in rows:
        convs.setdefault(c, []).append((n is not None, n or 0, (role or ""), (text or "")))
    out = {}
    for c, turns in convs.items():
        turns.sort(key=lambda t: (t[0], t[1], t[2].encode(), t[3].encode()))
        loss = "".join(t[3] for t in turns if t[2] == "assistant")
        out[c] = (len(turns), sha("".join(f"{t[2]}\n{t[3]}\n" for t in turns)), len(loss), sha(loss))
    return out


def check(spark, rows):
    formatted = op.format_conversations(spark.createDataFrame(rows, SCHEMA))
    got = {r.conv_id: tuple(r)[1:5] for r in op.digests(formatted).collect()}
    assert got == expected(rows)
    texts = formatted.collect()
    assert all(r.identical for r in texts)
    return texts


def test_hard_texts_come_back(spark):
    rows = [(k, n, role, text) for k, text in enumerate(HARD) for n, role in enumerate(("user", "assistant", text[:50]))]
    rows += [(1000, n, "assistant", text) for n, text in enumerate(HARD)]
    for r in check(spark, rows):
        assert r.formatted.count("</turn>") == r.formatted.count("\n### ") + 1 or "\n### " not in r.formatted
        for span in r.loss_spans:
            part = r.formatted[span.start : span.start + span.length]
            assert "###" not in part and "</turn>" not in part


def test_odd_rows(spark):
    rows = [(1, 0, None, None), (1, None, "user", "a"), (None, 1, "assistant", "b"), (None, 0, "assistant", None),
            (2, 3, "assistant", "x"), (2, 3, "assistant", "x"), (2, 3, "user", "x")]
    check(spark, rows)
    frame = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 AS formatted", "2 AS rows", "3 AS start")
    assert op.format_conversations(frame).count() == 3
    assert op.digests(op.format_conversations(frame.limit(0))).count() == 0


def test_equals_sql(spark):
    rows = [tuple(r) for r in table_rows(spark, "conversations")]
    rows = [(r[0], r[1], r[2], r[3]) for r in rows] + [(-100 - k, 0, "assistant", t) for k, t in enumerate(HARD)]
    connection = duckdb.connect()
    connection.register("conversations", pa.table(
        {n: pa.array([r[k] for r in rows]) for k, n in enumerate(("conv_id", "turn", "role", "text"))}))
    want = sorted(connection.execute(op.ORACLE_SQL).fetchall())
    frame = spark.createDataFrame(rows, SCHEMA).unionByName(op.hard_conversation(spark))
    out = op.digests(op.format_conversations(frame))
    assert sorted(map(tuple, out.collect())) == want
    assert "Python" not in op.digests(op.format_conversations(frame.where("true")))._jdf.queryExecution().optimizedPlan().toString()


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet="#\\</turn>: \na", max_size=30), min_size=20, max_size=60))
def test_any_text_comes_back(spark, texts):
    check(spark, [(k // 5, k, texts[k - 1][:9], t) for k, t in enumerate(texts)])


def test_escaping_everything_also_comes_back(spark):
    rows = spark.createDataFrame([(1, k, "assistant", t) for k, t in enumerate(HARD)], SCHEMA)
    from pyspark.sql import functions as F

    whole = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "role", "text"))).alias("rows"))
    out = whole.withColumn("rows", op._escaped_rows(F.col("rows"))).first().rows
    at = 0
    for r in out:
        assert r.start == at
        at += len(r.out)
    joined = "".join(r.out for r in out)
    back = spark.createDataFrame([(joined,)], "f string").select(op.parse(F.col("f")).alias("t")).first().t
    assert [t.text for t in back] == HARD
