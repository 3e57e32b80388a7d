import corpus_pipeline
from brute import table_rows, text_groups
from test_best_fit_packing import check


SF = "/root/testdata/sf0.001"


def test_equals_brute_force(spark):
    rows = [(r.doc_id, r.text) for r in table_rows(spark, "documents")]
    rows = [(i, t) for i, t in rows if t and any(c.isalpha() for c in t)]
    groups = text_groups(rows, corpus_pipeline.SIMILARITY)
    rows = [(i, t) for i, t in rows if groups[i] == i]
    items = [r.text for r in table_rows(spark, "benchmark")]
    rows = [(i, t) for i, t in rows if not any(item in t for item in items)]
    out = corpus_pipeline.run(spark, SF).collect()
    assert {r.doc_id for r in out} == {i for i, _ in rows}
    check(out, rows)


def test_stages_keep_columns_and_handle_odd_rows(spark):
    text = "some words that make up a text of their own. and more of them"
    rows = [(None, text, "en", "s", 1, 7), (1, None, "en", "s", 0, 7), (2, "", None, None, None, 7),
            (3, "123 456", "en", "s", 7, 7), (4, text, "en", None, 1, None), (4, text, "en", None, 1, None),
            (5, text, None, "s", 1, 7), (6, "other words " * 4000, "en", "s", 1, 7)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long, member long")
    columns = docs.columns
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF)
        assert docs.columns == columns
    assert sorted((r.doc_id or -1) for r in docs.collect()) == [-1, 4, 6]
    empty = docs.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        empty = stage(spark, empty, SF)
    assert empty.count() == 0


def test_unlike_texts_under_one_id_both_stay(spark):
    texts = ["one text about something quite long enough to have shingles",
             "another one that shares nothing with the first but its number",
             "a third that is copied under a number of its own, word for word"]
    rows = [(1, texts[0], 0), (1, texts[1], 1), (2, texts[1], 2), (0, texts[0] + " more", 3), (3, texts[2], 4),
            (3, texts[2], 5), (None, texts[2], 6)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, _row int")
    out = corpus_pipeline.near_dedup(spark, docs, SF)
    assert out.columns == docs.columns
    kept = [tuple(r)[:2] for r in out.collect()]
    assert sorted(kept, key=str) == sorted(
        [(0, texts[0] + " more"), (1, texts[1]), (3, texts[2]), (None, texts[2])], key=str
    )


def test_registered():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language_id", "near_dedup", "decontamination", "packing"]
    assert corpus_pipeline.ORACLE_SQL is None and set(corpus_pipeline.QUERIES) == {"pipeline"}


