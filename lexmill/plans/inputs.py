"""What the readers make of paths, payloads and pages, rendered from the corpus tables so that the result is known."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexmill.functions.extract import issue_numbers, page_issue
from lexmill.operators.audit import hash_matches
from lexmill.plans import sqltext as S
from lexmill.plans.matches import match_ladder
from lexmill.plans.matches import registry as MATCHES
from lexmill.plans.registry import Registry
from lexmill.sources import files as I
from lexmill.sources.tables import table

registry = Registry()

_FR = "lower(language) LIKE 'fr%'"
_CODE = f"CASE WHEN {_FR} THEN 'FR' ELSE 'AR' END || lpad(CAST(year AS VARCHAR), 4, '0') || lpad(CAST(doc_id % 1000 AS VARCHAR), 3, '0')"


def _paths(spark: SparkSession, directory: str) -> DataFrame:
    rows = table(spark, directory, "documents").filter("year IS NOT NULL")
    french = F.startswith(F.lower("language"), F.lit("fr"))
    code = F.concat(F.when(french, "FR").otherwise("AR"), F.lpad(F.col("year").cast("string"), 4, "0"), F.lpad((F.col("doc_id") % 1000).cast("string"), 3, "0"))
    path = F.concat(F.lit("/data/OCR-"), F.when(french, "Fr/").otherwise("Ar/"), F.col("year").cast("string"), F.lit("/"), code, F.lit(".pdf/markdown.md"))
    return rows.select("doc_id", path.alias("path"), F.lit("").alias("text"))


@registry.query(f"SELECT '/data/OCR-' || CASE WHEN {_FR} THEN 'Fr/' ELSE 'Ar/' END || year || '/' || {_CODE} || '.pdf/markdown.md' AS path, year, lpad(CAST(doc_id % 1000 AS VARCHAR), 3, '0') AS issue, CASE WHEN {_FR} THEN 'FR' ELSE 'AR' END AS language FROM documents WHERE year IS NOT NULL")
def issue_paths(spark: SparkSession, directory: str) -> DataFrame:
    return I.parsed_issues(_paths(spark, directory)).select("path", "year", "issue", "language")


@registry.query(f"SELECT DISTINCT CASE WHEN {_FR} THEN 'FR' ELSE 'AR' END AS language, year, lpad(CAST(doc_id % 1000 AS VARCHAR), 3, '0') AS issue FROM documents WHERE year IS NOT NULL")
def issue_inventory(spark: SparkSession, directory: str) -> DataFrame:
    return I.issue_inventory(_paths(spark, directory)).select("language", "year", "issue")


@registry.query("SELECT CAST(doc_id AS INTEGER) AS nid, text FROM documents")
def node_ocr(spark: SparkSession, directory: str) -> DataFrame:
    rows = table(spark, directory, "documents")
    named = rows.select(F.concat(F.lit("/c/nid_"), F.col("doc_id").cast("string"), F.lit("_a.pdf/markdown.md")).alias("path"), "text")
    direct = rows.select(F.concat(F.lit("/c/nid_"), F.col("doc_id").cast("string"), F.lit(".pdf/markdown.md")).alias("path"), F.lit("other").alias("text"))
    return I.node_ocr(named.unionByName(direct)).select("nid", "text")


@registry.query("SELECT id, coalesce(full_text, '') || chr(10) || chr(10) || '---' || chr(10) || chr(10) || 'end' AS text FROM revue_decision_texts")
def ocr_payload(spark: SparkSession, directory: str) -> DataFrame:
    page = lambda c: F.struct(F.coalesce(c, F.lit("")).alias("markdown"))
    answer = F.to_json(F.struct(F.struct(F.array(page(F.col("full_text")), page(F.lit("end"))).alias("pages")).alias("data")))
    return table(spark, directory, "revue_decision_texts").select("id", I.ocr_document(answer).alias("text"))


@registry.query("SELECT id, source_url AS url FROM decisions")
def sitemap(spark: SparkSession, directory: str) -> DataFrame:
    xml = F.concat(F.lit("<urlset><url><loc>"), "source_url", F.lit("</loc></url></urlset>"))
    return table(spark, directory, "decisions").select("id", F.explode(I.sitemap_urls(xml)).alias("url"))


@registry.query(f"SELECT id, {S.padded('issue_number', 3)} AS issue, 'https://g.example.invalid/FTP/JO-FRANCAIS/' || issue_year || '/F' || issue_year || {S.padded('issue_number', 3)} || '.pdf' AS url FROM revue_decisions WHERE issue_number IS NOT NULL AND issue_year IS NOT NULL")
def annual_index(spark: SparkSession, directory: str) -> DataFrame:
    rows = table(spark, directory, "revue_decisions").filter("issue_number IS NOT NULL AND issue_year IS NOT NULL")
    html = F.concat(F.lit("<a href=\"javascript:MaxWin('"), F.col("issue_number").cast("string"), F.lit("')\">n</a>"))
    found = rows.select("id", "issue_year", F.explode(issue_numbers(html, F.lit("FR"))).alias("issue"))
    return found.select("id", "issue", I.issue_url(F.lit("FR"), F.col("issue_year"), F.col("issue"), "https://g.example.invalid").alias("url"))


@registry.query("SELECT id, issue_number AS number, issue_year AS year FROM revue_decisions WHERE issue_number IS NOT NULL AND issue_year IS NOT NULL")
def resource_issues(spark: SparkSession, directory: str) -> DataFrame:
    rows = table(spark, directory, "revue_decisions").filter("issue_number IS NOT NULL AND issue_year IS NOT NULL")
    title = F.concat(F.lit("مجلة-عدد-"), F.lpad(F.col("issue_number").cast("string"), 2, "0"), F.lit("-"), F.col("issue_year").cast("string"))
    return rows.select("id", page_issue(title).alias("i")).select("id", "i.number", "i.year")


@registry.query("SELECT id, content_hash IS NOT DISTINCT FROM sha256(text) AS same FROM decisions WHERE raw_path IS NOT NULL")
def recorded_hashes(spark: SparkSession, directory: str) -> DataFrame:
    rows = table(spark, directory, "decisions").filter("raw_path IS NOT NULL")
    recorded = rows.select("id", F.concat("raw_path", F.lit("#"), F.col("id").cast("string")).alias("path"), F.col("content_hash").alias("sha256"))
    files = rows.select(F.concat("raw_path", F.lit("#"), F.col("id").cast("string")).alias("path"), F.encode("text", "UTF-8").alias("content"))
    return hash_matches(recorded, files).select("id", "same")


_ANSWER = ("canonical_id", "document_type", "jurisdiction", "chamber", "title", "document_number", "date", "year", "language", "subject", "principle", "full_text", "text_completeness")


@registry.query(f"SELECT canonical_id, CAST(to_json({{{', '.join(f'{c}: {c}' for c in _ANSWER)}}}) AS VARCHAR) AS json FROM documents")
def document_json(spark: SparkSession, directory: str) -> DataFrame:
    made = F.to_json(F.struct(*_ANSWER), {"ignoreNullFields": "false"})
    return table(spark, directory, "documents").select("canonical_id", made.alias("json"))


@registry.query("SELECT id, decision_number AS nid, chamber AS kind FROM decisions")
def seed_rows(spark: SparkSession, directory: str) -> DataFrame:
    """Seeds written as a JSON list and read back."""
    rows = table(spark, directory, "decisions").select("id", F.to_json(F.array(F.struct(F.col("decision_number").alias("nid"), F.col("chamber").alias("kind"))), {"ignoreNullFields": "false"}).alias("json"))
    return rows.select("id", F.explode(I.seeds(F.col("json"), "nid string, kind string")).alias("s")).select("id", "s.nid", "s.kind")


@registry.query("SELECT id, raw_path, text AS html FROM decisions")
def archived_html(spark: SparkSession, directory: str) -> DataFrame:
    """Pages archived under a name of their own beside the rows that name them."""
    rows = table(spark, directory, "decisions")
    named = rows.select("id", "raw_path", F.concat(F.lit("/raw/"), F.col("id").cast("string"), F.lit(".html")).alias("archived"), "text")
    files = named.select(F.concat(F.lit("/other"), "archived").alias("path"), "text")
    found = I.archived_pages(files, named.select("id", F.col("raw_path").alias("kept"), F.col("archived").alias("raw_path")))
    return found.select("id", F.col("kept").alias("raw_path"), "html")


@registry.query(f"SELECT verdict, level, count(*) AS n FROM ({MATCHES.sql['match_ladder']}) GROUP BY 1, 2")
def match_statistics(spark: SparkSession, directory: str) -> DataFrame:
    return match_ladder(spark, directory).groupBy("verdict", "level").agg(F.count("*").alias("n"))
