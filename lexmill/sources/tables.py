"""Parquet tables of a data directory."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

#: Test tables and corpus tables that live in one parquet file or folder each.
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "articles provenance relations decisions revue_index revue_decisions revue_decision_texts "
    "withdrawn_documents chamber_ref size_limits mix_targets"
).split()


def table(spark: SparkSession, directory: str, name: str) -> DataFrame:
    """One table; the scan stays lazy so that filters and column lists reach it."""
    if name not in TABLES:
        raise ValueError(f"unknown table: {name}")
    return spark.read.parquet(f"{directory}/{name}.parquet")
