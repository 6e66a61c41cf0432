"""A corpus pipeline from raw documents to shards; each stage is one operator over all its predecessor kept."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from linkweave.llm import decontaminate, mixing, ngram_join, quality, sharding
from linkweave.llm.common import written


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the compression bands."""
    return quality.keep_good(docs)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class."""
    return ngram_join.keep_one(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without benchmark passages: spans are cut out; a document with more than a fifth of its words in them goes."""
    return decontaminate.remove_contamination(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the temperature mix places them, block by block and permuted inside a block."""
    return mixing.mix_rows(docs)


def sharding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every placed document with its shard and slot; slots follow the mix."""
    return sharding.shard_documents(docs, shards=16, order=file_order(docs))


def file_order(docs: DataFrame) -> tuple[Column, Column] | None:
    """(file, row in the file) of ``docs``: the order in which the stage before wrote them. None if it isn't read from files."""
    name = F.col("_metadata.file_name")
    try:
        docs.select(name, "_metadata.row_index")
    except AnalysisException:
        return None
    return F.struct(F.regexp_extract(name, r"^part-(\d+)", 1).cast("long").alias("part"), name.alias("name")), F.col("_metadata.row_index")


STAGES = [
    ("quality", quality_stage),
    ("near_duplicates", near_duplicate_stage),
    ("decontamination", decontamination_stage),
    ("mixing", mixing_stage),
    ("sharding", sharding_stage),
]

# Every stage: null and empty texts fail the quality rules, so later stages see none from ``run``; given some, near
# duplicates keep one of them, decontamination keeps them, a source of nothing else has no place in the mix, and
# sharding places them. Repeated rows are rows of their own but in near duplicates, which leave one. An empty
# table gives none; further columns are carried along by all stages but the last, whatever their names.

#: Compression ratios and MinHash bands have no SQL form; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result but the last is written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = written(docs)
    return docs
