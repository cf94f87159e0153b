"""Lookups and search over the corpus."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def like(text: Column, pattern: str) -> Column:
    """SQL LIKE that folds ASCII case only; ``%`` and ``_`` of the pattern are wildcards, nothing escapes."""
    folded = pattern.translate(str.maketrans(UPPER, LOWER))
    regex = "".join(".*" if c == "%" else "." if c == "_" else f"\\Q{c}\\E" for c in folded)
    return F.translate(text, UPPER, LOWER).rlike(f"(?s)^{regex}$")


def document_detail(documents: DataFrame, provenance: DataFrame) -> DataFrame:
    """JON-01, JON-02, QRY-03: documents with their provenance, null where there is none."""
    columns = [F.col(c).alias(f"prov_{c}") for c in provenance.columns if c != "canonical_id"]
    return documents.join(provenance.select("canonical_id", *columns), "canonical_id", "left")


def search(documents: DataFrame, query: str | None, source: str | None, order: str, fields: tuple[str, ...], limit: int = 40) -> DataFrame:
    """QRY-02, SRT-02: newest documents of a source that hold the query in one of the fields."""
    out = documents
    if source:
        out = out.filter(F.col("source") == source)
    if query:
        hit = F.lit(False)
        for f in fields:
            hit = hit | F.coalesce(like(F.col(f), f"%{query}%"), F.lit(False))
        out = out.filter(hit)
    return out.orderBy(F.desc(order)).limit(limit)


def articles_of(articles: DataFrame, document: str) -> DataFrame:
    """QRY-01, SRT-01: articles of a document by ordinal."""
    return articles.filter(F.col("parent_document_id") == document).orderBy("ordinal")


def relations_of(relations: DataFrame, document: str) -> DataFrame:
    """QRY-01, SRT-06: relations from or to a document by type."""
    return relations.filter((F.col("source_id") == document) | (F.col("target_id") == document)).orderBy("relation_type", "id")


def preview(documents: DataFrame) -> DataFrame:
    """QRY-04: subject and text shortened for a list."""
    return documents.select("canonical_id", F.substring("subject", 1, 80).alias("subject"), F.substring("full_text", 1, 3000).alias("text"))
