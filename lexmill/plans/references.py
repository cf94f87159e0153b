"""Problem 4: references to records that do not exist."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from lexmill.operators.references import Reference, orphan_counts, orphan_references
from lexmill.plans.registry import Registry
from lexmill.sources.tables import table

registry = Registry()

_SQL = """
WITH refs AS (
  SELECT 'relations' AS table_name, id AS row_id, target_id AS key, TRY_CAST(created_at AS TIMESTAMP) AS ref_at FROM relations
  UNION ALL SELECT 'articles', id, parent_document_id, TRY_CAST(created_at AS TIMESTAMP) FROM articles
  UNION ALL SELECT 'provenance', id, canonical_id, TRY_CAST(ingested_at AS TIMESTAMP) FROM provenance
), judged AS (
  SELECT r.table_name, r.row_id, r.ref_at,
    CASE WHEN d.canonical_id IS NULL AND w.canonical_id IS NOT NULL THEN 'deleted'
         WHEN d.canonical_id IS NULL THEN 'missing'
         WHEN TRY_CAST(d.created_at AS TIMESTAMP) > r.ref_at THEN 'late' END AS kind
  FROM refs r LEFT JOIN documents d ON d.canonical_id = r.key
  LEFT JOIN (SELECT DISTINCT canonical_id FROM withdrawn_documents) w ON w.canonical_id = r.key
  WHERE r.key IS NOT NULL
)
"""


def _orphans(spark: SparkSession, directory: str) -> DataFrame:
    return orphan_references(
        [
            Reference("relations", table(spark, directory, "relations"), "id", "target_id", "created_at"),
            Reference("articles", table(spark, directory, "articles"), "id", "parent_document_id", "created_at"),
            Reference("provenance", table(spark, directory, "provenance"), "id", "canonical_id", "ingested_at"),
        ],
        table(spark, directory, "documents"),
        "canonical_id",
        "created_at",
        table(spark, directory, "withdrawn_documents"),
        "canonical_id",
    )


@registry.query(_SQL + "SELECT DISTINCT table_name, row_id, kind FROM judged WHERE kind IS NOT NULL")
def p4_found(spark: SparkSession, directory: str) -> DataFrame:
    return _orphans(spark, directory).select("table_name", "row_id", "kind")


@registry.query(
    _SQL
    + """SELECT table_name, strftime(ref_at, '%Y-%m') AS month, kind, CAST(count(*) AS BIGINT) AS n_rows
FROM judged WHERE kind IS NOT NULL GROUP BY ALL"""
)
def p4_by_month(spark: SparkSession, directory: str) -> DataFrame:
    return orphan_counts(_orphans(spark, directory))
