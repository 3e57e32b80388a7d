"""Registered queries of the operators, each over its whole tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import (
    best_fit_packing,
    bloom_lm,
    bm25_decontamination,
    chat_grammar,
    circulant_minhash,
    cover_tree_dedup,
    dom_tree_model,
    fim,
    host_reputation,
    naive_bayes_langid,
    prefix_trie,
    rule_ensemble,
    warc_derivatives,
)
from tidemark.llm.common import table


def vocabulary(name: str) -> str:
    """Where a public tokenizer's file is; the same place on every machine."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_warc_derivatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    responses = warc_derivatives.page_responses(table(spark, sf_dir, "pages"))
    return warc_derivatives.derivatives(responses, ("page_id",))


def op2_dom_tree_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dom_tree_model.extract_pages(table(spark, sf_dir, "pages"))


def op3_bm25_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bm25_decontamination.find_leaks(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )


def op4_cover_tree_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cover_tree_dedup.near_vectors(table(spark, sf_dir, "embeddings"), cosine=0.93)


def op5_bloom_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bloom_lm.score_documents(table(spark, sf_dir, "documents"))


def op6_host_reputation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return host_reputation.judge(table(spark, sf_dir, "pages"), table(spark, sf_dir, "labels"))


def op7_chat_grammar(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    rows = rows.unionByName(chat_grammar.hard_conversation(spark))
    return chat_grammar.digests(chat_grammar.format_conversations(rows))


def op8_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return best_fit_packing.pack_documents(
        table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json")
    )


def op9_naive_bayes_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return naive_bayes_langid.identify(table(spark, sf_dir, "documents"))


def op10_circulant_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return circulant_minhash.near_duplicates(table(spark, sf_dir, "documents"), percent=85)


def op11_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return fim.digests(fim.transform(docs, keep=["doc_id"]))


def op12_rule_ensemble(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rule_ensemble.score_documents(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    )


def op13_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.rebuilt_trie(table(spark, sf_dir, "conversations"))


QUERIES = {
    "op1_warc_derivatives": op1_warc_derivatives,
    "op2_dom_tree_model": op2_dom_tree_model,
    "op6_host_reputation": op6_host_reputation,
    "op7_chat_grammar": op7_chat_grammar,
    "op4_cover_tree_dedup": op4_cover_tree_dedup,
    "op3_bm25_decontamination": op3_bm25_decontamination,
    "op5_bloom_lm": op5_bloom_lm,
    "op8_best_fit_packing": op8_best_fit_packing,
    "op9_naive_bayes_langid": op9_naive_bayes_langid,
    "op10_circulant_minhash": op10_circulant_minhash,
    "op11_fill_in_middle": op11_fill_in_middle,
    "op12_rule_ensemble": op12_rule_ensemble,
    "op13_prefix_trie": op13_prefix_trie,
}

ORACLES = {
    "op6_host_reputation": host_reputation.ORACLE_SQL,
    "op7_chat_grammar": chat_grammar.ORACLE_SQL,
    "op11_fill_in_middle": fim.ORACLE_SQL,
    "op13_prefix_trie": prefix_trie.ORACLE_SQL,
}
