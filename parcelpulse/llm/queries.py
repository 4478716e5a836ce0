"""One registered query per operator, with production parameters over whole tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from parcelpulse.llm import (
    conversation_trie,
    decontaminate,
    language_fusion,
    minhash_dedup,
    mixture_cube,
    periodic_runs,
    pii_bootstrap,
    projected_neighbours,
    secret_automaton,
    suffix_dedup,
    token_files,
    toxicity_grammar,
    url_models,
)
from parcelpulse.llm.common import table

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def op1_pii_bootstrap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii_bootstrap.personal_data(table(spark, sf_dir, "documents"))


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op3_toxicity_grammar(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity_grammar.train(docs, table(spark, sf_dir, "labels"))
    return toxicity_grammar.score(docs, model)


def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.encoded(table(spark, sf_dir, "documents"), TOKENIZER)


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(table(spark, sf_dir, "documents"), length=100)


def op6_projected_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return projected_neighbours.nearest(table(spark, sf_dir, "embeddings"), every=20, k=20)


def op7_language_fusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_fusion.page_languages(
        table(spark, sf_dir, "pages"), table(spark, sf_dir, "documents")
    )


def op8_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash_dedup.near_duplicates(table(spark, sf_dir, "documents"))


def op9_secret_automaton(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_automaton.find_secrets(table(spark, sf_dir, "documents"))


def op10_mixture_cube(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixture_cube.mix(table(spark, sf_dir, "documents"))


def op11_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie.conversation_trie(table(spark, sf_dir, "conversations"))


def op12_url_models(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_models.judge_urls(table(spark, sf_dir, "pages")).select("page_id", "host", "path", "rule", "verdict")


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs.run_digests(table(spark, sf_dir, "documents"))


QUERIES = {
    query.__name__: query
    for query in (
        op1_pii_bootstrap,
        op2_decontaminate,
        op3_toxicity_grammar,
        op4_token_files,
        op5_suffix_dedup,
        op6_projected_neighbours,
        op7_language_fusion,
        op8_minhash_dedup,
        op9_secret_automaton,
        op10_mixture_cube,
        op11_conversation_trie,
        op12_url_models,
        op13_periodic_runs,
    )
}
