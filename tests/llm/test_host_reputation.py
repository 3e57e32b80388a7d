import duckdb
import pyarrow as pa
import pytest

from tidemark.llm import host_reputation as op

PAGES, LABELS = "page_id long, url string", "doc_id long, quality int, toxic int"


def by_sql(pages, labels):
    connection = duckdb.connect()
    connection.register("pages", pa.table({"page_id": pa.array([p[0] for p in pages], pa.int64()),
                                           "url": pa.array([p[1] for p in pages], pa.string())}))
    connection.register("labels", pa.table({n: pa.array([x[k] for x in labels], pa.int64())
                                            for k, n in enumerate(("doc_id", "quality", "toxic"))}))
    return sorted(connection.execute(op.ORACLE_SQL).fetchall(), key=str)


def by_spark(spark, pages, labels):
    out = op.judge(spark.createDataFrame(pages, PAGES), spark.createDataFrame(labels, LABELS))
    assert out.columns == ["page_id", "host", "path", "rule", "verdict"]
    return sorted(map(tuple, out.collect()), key=str)


@pytest.mark.parametrize("url, host, path, rule", [
    ("http://Example.COM/en/1?x#y", "example.com", "/en/1", "example.com/en/"),
    ("http://a.www.example.com/en/", "a.www.example.com", "/en/", "www.example.com/en/"),
    ("https://notexample.com/en/", "notexample.com", "/en/", "com/"),
    ("x://b.net/fr/?q", "b.net", "/fr/", "net/fr/"),
    ("x://b.net/FR/", "b.net", "/FR/", None),
    ("http://c.com", "c.com", "", None),
    ("http://c.com?a/b", "c.com", "", None),
    ("http://c.com#://d.net/es/", "c.com", "", None),
    ("a/b://É.COM:80/p?u", "É.com:80", "/p", None),
    ("no scheme", "", "", None),
    ("://", "", "", None),
    (None, "", "", None),
    ("", "", "", None),
])
def test_parts_and_rules(spark, url, host, path, rule):
    frame = spark.createDataFrame([(1, url)], PAGES)
    parts = op.host_and_path(frame.url)
    row = frame.select(*parts, *op.by_rule(*parts)).first()
    assert (row[0], row[1], row[2]) == (host, path, rule)
    assert row[3] == ({r.text: r.verdict for r in op.RULES}.get(rule))


def made():
    pages, labels = [], []
    for k in range(900):
        host = ("good.org", "bad.org", "x.bad.org", "a.co.uk", "b.c.co.uk", "rare%d.org" % k)[min(5, k % 7)]
        pages.append((k, f"http://{host}/p{k}"))
        if k % 3:
            bad = ("bad" in host and k % 10 < 9) or k % 17 == 0
            labels.append((k, 0 if bad else 1, 1 if bad and k % 2 else 0))
    return pages, labels


def test_verdicts_follow_the_labels(spark):
    pages, labels = made()
    out = by_spark(spark, pages, labels)
    assert out == by_sql(pages, labels)
    blocked = {r[1] for r in out if r[4] == "block"}
    assert {"bad.org", "x.bad.org"} <= blocked and not blocked & {"good.org", "a.co.uk"}


def test_odd_rows(spark):
    pages = [(1, None), (1, None), (None, "http://a.org/"), (2, "http://a.org/"), (3, "http://1.2.3.4:80/x"),
             (4, "http://" + "a." * 5000 + "net/es/"), (5, "http://./"), (6, "http://../en/")]
    labels = [(1, None, None), (2, 0, None), (2, 0, None), (2, 1, 0), (None, 0, 1), (99, 0, 1), (3, None, 1)]
    assert by_spark(spark, pages, labels) == by_sql(pages, labels)
    assert by_spark(spark, pages, []) == by_sql(pages, [])
    assert by_spark(spark, [], labels) == []


def test_extra_columns(spark):
    pages = spark.createDataFrame([(1, "http://a.org/")], PAGES).selectExpr("*", "1 AS host", "2 AS bad", "3 AS quality")
    labels = spark.createDataFrame([(1, 0, 0)], LABELS).selectExpr("*", "1 AS page_id", "2 AS host")
    assert op.judge(pages, labels).count() == 1


def test_plan_is_native(spark):
    pages, labels = made()
    out = op.judge(spark.createDataFrame(pages, PAGES), spark.createDataFrame(labels, LABELS))
    assert "Python" not in out._jdf.queryExecution().toString()
