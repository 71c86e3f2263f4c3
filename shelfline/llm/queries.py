"""One registered query per operator, on the whole of its tables."""

from __future__ import annotations

from collections.abc import Callable
from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from shelfline.llm import byte_bpe, decontaminate, language, licenses, manifest, mixing, near_dups, private_data, quality, repeats, secrets, spelling, token_files
from shelfline.llm.common import held_out_column, table
from shelfline.session import scratch_path

Query = Callable[[SparkSession, str], DataFrame]
TOKENIZER = "byte_bpe_50k.json"
RANKS = "byte_bpe_multi_50k.tiktoken"


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.decontaminate(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(table(spark, sf_dir, "documents")).drop("blocks")


def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "token-files")
    token_files.write_token_files(table(spark, sf_dir, "documents"), path, TOKENIZER)
    return token_files.read_token_files(spark, path)


def op4_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    told = language.identify(docs, language.learn(docs))
    return told.select("doc_id", held_out_column(F.col("doc_id")).alias("held_out"), "lang_pred", "score")


def op5_private_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return private_data.find_private(table(spark, sf_dir, "documents"))


def op6_repeated_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.remove_repeats(table(spark, sf_dir, "documents")).drop("spans")


def op7_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, _ = secrets.scan(table(spark, sf_dir, "documents"))
    return documents


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def domain_of_source() -> Column:
    """The numbered sources of the given tables dealt to four domains."""
    number = F.regexp_extract("source", "([0-9]+)", 1).try_cast("int")
    return F.when(F.col("source").isNotNull(), F.concat(F.lit("domain"), (F.coalesce(number, F.lit(0)) % 4).cast("string")))


def target_weight(level: str, name: Column) -> Column:
    """Target weights of the registered mix: domains 4:3:2:1, English 5 to 2 of any other language, sources alike."""
    if level == "domain":
        return F.when(name == "domain0", 4).when(name == "domain1", 3).when(name == "domain2", 2).otherwise(1)
    if level == "lang":
        return F.when(name == "en", 5).otherwise(2)
    return F.lit(1)


def op8_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(table(spark, sf_dir, "documents"), domain_of_source(), target_weight)


def op10_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dups.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, percent=85)


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(table(spark, sf_dir, "documents"))


def op12_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    def tampered(values: dict[str, Column]) -> tuple[Column, dict[str, Column]]:
        lowered = F.translate(values["text"], ascii_uppercase, ascii_lowercase)
        return F.crc32(values["doc_id"].cast("string").cast("binary")) % 5 == 0, {"text": lowered}

    found = manifest.manifest(table(spark, sf_dir, "documents"), tampered)
    return found.select(
        "doc_id", "leaf", "subroot", "root", manifest.proof(F.col("path")).alias("proof_sha256"), "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )


def op13_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = byte_bpe.round_trip(table(spark, sf_dir, "documents"), RANKS)
    return coded.select("doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("data", 256).alias("decoded_sha256"))


QUERIES: dict[str, Query] = {
    "op1_decontaminate": op1_decontaminate,
    "op2_license_scan": op2_license_scan,
    "op3_token_files": op3_token_files,
    "op4_language": op4_language,
    "op5_private_data": op5_private_data,
    "op6_repeated_strings": op6_repeated_strings,
    "op7_secret_scan": op7_secret_scan,
    "op8_mix_sources": op8_mix_sources,
    "op9_quality_rules": op9_quality_rules,
    "op10_near_duplicates": op10_near_duplicates,
    "op11_spelling_variants": op11_spelling_variants,
    "op12_manifest": op12_manifest,
    "op13_byte_bpe": op13_byte_bpe,
}
