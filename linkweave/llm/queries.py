"""Queries of the training-data operators, with production parameters over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontaminate, mixing, ngram_join, pii, quality, sentence_spans, sharding, suffix_dedup, token_counts, toxicity

#: Fixed here; the path of the vocabulary comes from the installed package that holds the files.
TOKENIZER = "byte_bpe_50k.json"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.surrogates(_table(spark, sf_dir, "documents"))


def op2_toxicity_severity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model, _ = toxicity.train(docs, _table(spark, sf_dir, "labels"))
    return toxicity.severity(docs, model)


def op3_temperature_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_table(spark, sf_dir, "documents"))


def op4_best_fit_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = sharding.shard_documents(_table(spark, sf_dir, "documents"), shards=16)
    return found.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op5_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = ngram_join.near_duplicates(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "class_id", "n_links", "n_copies", "text_key")


def op6_compression_bands(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality_rules(_table(spark, sf_dir, "documents"))


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.decontaminate(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.drop("item_ids", "hit_spans")


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return token_counts.token_counts(_table(spark, sf_dir, "documents"), str(public_tokenizers.path(TOKENIZER)))


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.remove_repeats(_table(spark, sf_dir, "documents"))


def op10_sentence_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sentence_spans.remove_repeated_sentences(_table(spark, sf_dir, "documents"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    some = [
        op1_pii_surrogates, op2_toxicity_severity, op3_temperature_mix, op4_best_fit_shards, op5_ngram_jaccard,
        op6_compression_bands, op7_decontamination, op8_token_counts, op9_suffix_dedup, op10_sentence_spans, pipeline,
    ]
    return {f.__name__: f for f in some}


def oracle_sql() -> dict[str, str]:
    return {"op7_decontamination": decontaminate.ORACLE}
