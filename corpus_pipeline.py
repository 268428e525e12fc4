"""The corpus pipeline: five operators in a row, each on all that the one before kept."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from terrace.llm import contamination, mixing, quality, resemblance, simhash, tokens
from terrace.llm.common import table
from terrace.sources.scratch import scratch_path

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules or a certified cutoff reject go."""
    return quality.accepted(docs, table(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays: by fingerprint, or by shingles."""
    return simhash.one_of_each(docs, similarity=resemblance.SIMILARITY)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a window of a benchmark item go."""
    return contamination.without_passages(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their files and rows in the order of the mixture."""
    return mixing.mixed(docs)


def file_order(docs: DataFrame) -> list[Column]:
    """The order in which the rows lie in the files they are read from; else by id.

    Spark names the files of a sorted table by their place, and a row has its place in the
    file. Frames that are not read from files have no such order.
    """
    try:
        place = docs.select("_metadata.file_name", "_metadata.row_index")
    except AnalysisException:
        return [F.col("doc_id")]
    number = F.regexp_extract("_metadata.file_name", r"part-(\d+)", 1).try_cast("bigint")
    return [number, *[F.col(f"_metadata.{c}") for c in place.columns]]


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token files in the order of the mixture; where each document starts, and its checksum."""
    return tokens.checksums(tokens.stored_tokens(docs, file_order(docs)))


STAGES: list[tuple[str, Stage]] = [
    ("quality rules", quality_rules),
    ("SimHash near-dedup", near_dedup),
    ("benchmark decontamination", decontaminate),
    ("mixing sources", mix_sources),
    ("token-ID output", write_tokens),
]

#: SimHash components and the tokenizer cannot be written in SQL; tests hold the rows
#: against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; each result is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, f"stage-{name.replace(' ', '-')}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
