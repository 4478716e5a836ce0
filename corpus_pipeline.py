"""A training corpus from raw documents, stage by stage.

Each stage takes what the one before kept, and its decisions take effect: toxic documents go, one
document of each near-duplicate group stays, documents that hold test items go, the mix
takes documents as often as its targets say, and the rest is written as token files.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from parcelpulse.llm import decontaminate, minhash_dedup, mixture_cube, token_files, toxicity_grammar
from parcelpulse.llm.common import stash, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    model = toxicity_grammar.train(docs, table(spark, sf_dir, "labels"))
    return toxicity_grammar.reject_toxic(docs, model)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return minhash_dedup.one_of_each(docs)


def drop_test_items(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.remove_leaks(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixture_cube.take(docs)


def write_token_files(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return token_files.encoded(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("toxicity", drop_toxic),
    ("minhash near-dedup", drop_near_duplicates),
    ("benchmark decontamination", drop_test_items),
    ("mixing to target weights", mix_sources),
    ("token files", write_token_files),
]

# The tokenizer and the learned scores have no SQL; tests compare with a brute-force run.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stash(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return STAGES[-1][1](spark, docs, sf_dir)
