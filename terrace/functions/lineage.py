"""Audit columns. The time comes from the caller, so that a run has one and a test can fix it."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Run:
    """One run of a job; its time is UTC."""

    at: datetime = field(default_factory=lambda: datetime.now(timezone.utc))

    @property
    def date(self) -> str:
        return self.at.astimezone(timezone.utc).strftime("%Y-%m-%d")

    @property
    def stamp(self) -> str:
        return self.at.astimezone(timezone.utc).strftime("%Y%m%d_%H%M%S")


def raw_lineage(df: DataFrame, run: Run, entity: str, path: Column | str) -> DataFrame:
    """When a row came in, from which file or stream, and as part of what."""
    return df.withColumns(
        {
            "_ingestion_date": F.lit(run.date),
            "_ingestion_timestamp": F.lit(run.stamp),
            "_source_path": F.lit(path) if isinstance(path, str) else path,
            "_source_entity": F.lit(entity),
        }
    )


def conformed_lineage(df: DataFrame, run: Run, entity: str) -> DataFrame:
    """Added next to the raw lineage, which stays."""
    return df.withColumns(
        {
            "_silver_processing_date": F.lit(run.date),
            "_silver_processing_timestamp": F.lit(run.stamp),
            "_silver_source_entity": F.lit(entity),
            "_source_layer": F.lit("bronze"),
            "_pipeline_stage": F.lit("silver"),
        }
    )


def analytical_lineage(df: DataFrame, run: Run, root: str) -> DataFrame:
    return df.withColumns(
        {
            "_gold_processing_date": F.lit(run.date),
            "_gold_processing_timestamp": F.lit(run.stamp),
            "_gold_source_bucket": F.lit(root),
            "_pipeline_stage": F.lit("gold"),
        }
    )
