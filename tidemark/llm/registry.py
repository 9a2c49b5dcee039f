"""Queries of the training-data operators, with their oracle SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import bpe, chat, decontaminate, language_model, lexical_search, line_dedup, main_text, near_duplicates, pii, prefix_trie, quality_rules, simhash, toxicity


def tokenizer_path() -> str:
    """The byte-level vocabulary the encoding queries are run with."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.digest(decontaminate.contamination(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark")))


def op7_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates.near_duplicate_components(read(spark, sf_dir, "documents"), k=2)
    return found.select("doc_id", "n_shingles", "component_id", "kept")


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.report(read(spark, sf_dir, "documents"))


def op8_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encoded(read(spark, sf_dir, "documents"), tokenizer_path(), with_ids=False)


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = language_model.classify(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
    return found.select("doc_id", "lang", "n_symbols", "perplexity", "n_tokens", "word_perplexity", "accepted")


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline  # here, as the pipeline itself reads this module

    return corpus_pipeline.run(spark, sf_dir)


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op3_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_text.extract(read(spark, sf_dir, "pages"))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality_rules.classify(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op9_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pseudonyms(read(spark, sf_dir, "documents"), key="tidemark")


def op6_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = chat.with_hostile_turns(read(spark, sf_dir, "conversations"))
    return chat.read_back(chat.formatted(rows, tokenizer_path()))


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.trie(read(spark, sf_dir, "conversations"))


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.rank_documents(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op13_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_components(read(spark, sf_dir, "documents"))


QUERIES = {
    "pipeline": pipeline,
    "op1_toxicity": op1_toxicity,
    "op2_decontamination": op2_decontamination,
    "op3_main_text": op3_main_text,
    "op4_quality_classifier": op4_quality_classifier,
    "op5_quality_rules": op5_quality_rules,
    "op6_chat_format": op6_chat_format,
    "op7_near_duplicates": op7_near_duplicates,
    "op8_bpe": op8_bpe,
    "op9_pii": op9_pii,
    "op10_line_dedup": op10_line_dedup,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_lexical_search": op12_lexical_search,
    "op13_simhash": op13_simhash,
}
ORACLES = {
    "op2_decontamination": decontaminate.ORACLE_SQL,
    "op6_chat_format": chat.ORACLE_SQL,
    "op7_near_duplicates": near_duplicates.ORACLE_SQL,
    "op11_prefix_trie": prefix_trie.ORACLE_SQL,
    "op12_lexical_search": lexical_search.ORACLE_SQL,
}
