"""Corpus pipeline: language, near duplicates, benchmark leaks, source mix, token files.

``run`` applies the stages to ``documents``. Each stage's rows are written as Parquet
under spark.checkpoint.dir and read again as the next stage's input, so a lost executor
repeats at most one stage. All but the last stage return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shelfline.llm import decontaminate, language, mixing, near_dups, token_files
from shelfline.llm.common import Scratch, table
from shelfline.llm.queries import TOKENIZER, domain_of_source, target_weight
from shelfline.session import scratch_path

#: Share of the remaining words that the mix may take.
MIX_SHARE = 0.8


def known_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can be told; learned from the rows of this stage that are not held out."""
    return language.in_known_language(docs, language.learn(docs))


def without_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (five-word shingles, similarity 0.8)."""
    return near_dups.one_of_each_group(docs)


def without_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no ten-word window of a benchmark item."""
    return decontaminate.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents chosen by the target weights of domains, languages and sources, each at most once."""
    return mixing.keep_mixed(docs, domain_of_source(), target_weight, share=MIX_SHARE)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token files' contents: doc_id, start, n_tokens, ids_crc32."""
    path = scratch_path(spark, "pipeline-token-files")
    token_files.write_token_files(docs, path, token_files.tokenizer_path(TOKENIZER))
    return token_files.read_token_files(spark, path)


STAGES = [
    ("known_language", known_language),
    ("without_near_duplicates", without_near_duplicates),
    ("without_benchmark", without_benchmark),
    ("mixed", mixed),
    ("token_ids", token_ids),
]

# Language filters, shingle hashes and the tokenizer are beyond SQL; tests compare run() with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark, "pipeline")
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        before, docs = docs, scratch.write(stage(spark, docs, sf_dir), name)
        scratch.drop(before)
    name, stage = STAGES[-1]
    return scratch.write(stage(spark, docs, sf_dir), name)
