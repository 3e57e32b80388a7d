"""A corpus pipeline: documents in, packed training sequences out.

Every stage takes (spark, docs, sf_dir) and gives a DataFrame; it is written to the shared folder
and read back as the next stage's documents. All but the last keep the columns of ``documents``.

1. language ID: learns from two thirds of the documents at hand and drops those without a
   letter or whose best language has a posterior below ``LEAST_SCORE``.
2. MinHash near-dedup: of each group of documents linked at 80 per cent of their 5-word
   shingles, the one with the least id stays. Rows are told apart by their place in the stored
   input, not by their id: unlike texts under one id are judged each on its own, and of rows
   that repeat both one stays. Rows without an id stay.
3. benchmark decontamination: drops documents that hold a test item's question and answer.
4. best-fit packing of what is left.

Null texts are dropped by the first stage. Empty tables pass through every stage. Columns beyond
those of ``documents`` are carried along unchanged, except by the last stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import (
    best_fit_packing,
    bm25_decontamination,
    circulant_minhash,
    naive_bayes_langid,
)
from tidemark.llm.common import id_remainder, stored, table
from tidemark.llm.queries import vocabulary

LEAST_SCORE = 0.5
SIMILARITY = 80
BANDS = 28


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    held_out = id_remainder("doc_id", 3) == 1
    languages = naive_bayes_langid.fitted(naive_bayes_langid.training_rows(held_out, docs))
    return naive_bayes_langid.accepted(docs, languages, LEAST_SCORE)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    row = "_row"
    while row in docs.columns:
        row += "_"
    rows = stored(docs.withColumn(row, F.monotonically_increasing_id()), "documents")
    named = rows.where("doc_id IS NOT NULL")
    groups = circulant_minhash.near_duplicates(
        named.select(F.col(row).alias("doc_id"), "text"), percent=SIMILARITY, bands=BANDS
    )
    kept = (
        named.select(row, "doc_id")
        .join(groups.select(F.col("doc_id").alias(row), "component_id"), row)
        .groupBy("component_id")
        .agg(F.min(F.struct("doc_id", row))[row].alias(row))
    )
    # The rows kept grow with the corpus, so they are never broadcast, however few there are.
    kept = stored(kept.select(row), "kept").hint("merge")
    first = named.join(kept, row, "left_semi")
    return first.unionByName(rows.where("doc_id IS NULL")).select(docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bm25_decontamination.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return best_fit_packing.pack_documents(docs, vocabulary("byte_bpe_50k.json"))


STAGES = [
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("packing", packing),
]

# Language ID, MinHash and packing have no SQL form; tests/llm compares with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    name, stage = STAGES[-1]
    return stored(stage(spark, docs, sf_dir), name)


QUERIES = {"pipeline": run}
ORACLES: dict[str, str] = {}
