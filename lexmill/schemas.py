"""Schemas of the corpus tables and the vocabularies of their enumerations."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DOCUMENTS = (
    "canonical_id string, document_type string, document_nature string, jurisdiction string, court_level string, chamber string, "
    "section string, title string, document_number string, publication_number string, date string, year int, language string, "
    "subject string, keywords string, legal_references string, principle string, court_response string, disposition string, "
    "full_text string, text_format string, text_completeness string, extraction_method string, extraction_quality string, "
    "language_pair_id string, parent_document_id string, canonical_hash string, anonymization_status string, created_at string, updated_at string"
)
PROVENANCE = (
    "canonical_id string, source_db string, source_table string, source_id long, source_url string, raw_path string, pdf_path string, "
    "content_hash string, ingested_at string"
)
ARTICLES = "parent_document_id string, article_number string, title string, text string, language string, ordinal int, created_at string"
RELATIONS = "source_id string, target_id string, relation_type string, confidence double, metadata string, created_at string"

# Values that enumerations may take.
DOCUMENT_TYPES = (
    "LAW", "DECREE", "ORDER", "DECISION", "CIRCULAR", "NOTICE", "OPINION", "REVIEW_ARTICLE", "INDEX_ENTRY", "OTHER", "ORDINANCE",
)
COMPLETENESS = ("FULL_TEXT", "PARTIAL_TEXT", "INDEX_ONLY")
QUALITIES = ("HIGH", "MEDIUM", "LOW_CONFIDENCE")


def outside(value: Column, allowed: tuple[str, ...]) -> Column:
    """Whether a value is none of the allowed ones; null is allowed."""
    return F.coalesce(~value.isin(*allowed), F.lit(False))
