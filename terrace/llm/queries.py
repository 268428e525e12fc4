"""The queries of the corpus operators, over the whole table each is meant for, and their SQL.

The operators keep their own outputs; the queries derive digest columns from them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from terrace.llm import (
    bpe, contamination, divergence, langid, lines, lm, mixing, quality, ranking, secrets, simhash,
    tokens, toxicity,
)
from terrace.llm.common import table


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = quality.judged(_documents(spark, sf_dir), table(spark, sf_dir, "labels"))
    return found.drop("digest")


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = contamination.find_passages(
        _documents(spark, sf_dir), table(spark, sf_dir, "benchmark")
    )
    items = F.array_join(F.array_sort("items"), ",")
    return found.withColumn("n_hit", contamination.n_hit()).select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(items.cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op3_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.find_secrets(_documents(spark, sf_dir))
    base = [rule.kind for rule in secrets.BASE_RULES]
    known = F.filter("findings", lambda f: f["kind"].isin(base))

    def count(kind: str) -> Column:
        of_kind = F.filter("findings", lambda f: f["kind"] == kind)
        return F.size(of_kind).cast("bigint").alias(f"n_{kind}")

    return found.select(
        "doc_id",
        *map(count, base),
        F.sha2(secrets.spans_text(known).cast("binary"), 256).alias("base_sha256"),
        secrets.spans_text(F.col("findings")).alias("spans"),
    )


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identified(_documents(spark, sf_dir))


def op5_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.scored(_documents(spark, sf_dir))


def op6_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = mixing.scheduled(_documents(spark, sf_dir))
    return placed.select(
        "doc_id", "source", "mix_block", "mix_release", "mix_deadline", "mix_slot", "mix_start"
    )


def op7_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.checksums(tokens.stored_tokens(_documents(spark, sf_dir)))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lines.without_boilerplate(_documents(spark, sf_dir))


def op9_simhash_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(_documents(spark, sf_dir))
    digits = F.lower(F.lpad(F.hex("fingerprint"), 16, "0"))
    return found.select("doc_id", digits.alias("fingerprint"), "component_id")


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.scored(_documents(spark, sf_dir), table(spark, sf_dir, "labels"))


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audited(_documents(spark, sf_dir))


def op12_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.digests(_documents(spark, sf_dir))


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.ranked(_documents(spark, sf_dir), table(spark, sf_dir, "benchmark"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_quality_rules, op2_decontamination, op3_secret_scan, op4_language_id, op5_lm_score,
        op6_source_mix, op7_token_files, op8_line_dedup, op9_simhash_groups, op10_toxicity,
        op11_source_divergence, op12_byte_bpe, op13_ranked_search, pipeline,
    )
}
