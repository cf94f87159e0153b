"""Staged decisions of the three court sources to canonical rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexmill.functions.classify import anonymization, completeness, extraction_quality
from lexmill.functions.dates import padded, year_of
from lexmill.functions.extract import disposition, legal_references, parties
from lexmill.functions.fixed import NODE_PATCHES
from lexmill.functions.text import clean_text, keywords_json
from lexmill.operators.identity import clone_suffix, council_base, court_base, review_base, with_clones, with_suffix


def shown(value: Column) -> Column:
    """A value within a title, where a missing one is written ``None``."""
    return F.coalesce(value.cast("string"), F.lit("None"))


def court_documents(rows: DataFrame) -> DataFrame:
    """PRJ-02: canonical rows of the supreme court's pages."""
    text = F.coalesce("text", F.lit(""))
    base = rows.withColumn("__hash", F.coalesce(F.nullif("content_hash", F.lit("")), F.sha2(text, 256)))
    base = base.withColumn("__base", court_base(F.col("decision_number"), F.col("date")))
    base = with_suffix(base, "__base", F.substring("__hash", 1, 8))
    return base.select(
        "canonical_id",
        F.lit("DECISION").alias("document_type"),
        F.lit("JUDICIAL_DECISION").alias("document_nature"),
        F.lit("SUPREME_COURT").alias("jurisdiction"),
        "chamber",
        F.concat(F.lit("قرار المحكمة العليا رقم "), shown(F.col("decision_number")), F.lit(" بتاريخ "), shown(F.col("date"))).alias("title"),
        F.col("decision_number").alias("document_number"),
        "date",
        year_of(F.col("date")).alias("year"),
        F.lit("AR").alias("language"),
        "subject",
        keywords_json(F.col("keywords"), commas=True).alias("keywords"),
        "legal_references",
        "principle",
        "court_response",
        "disposition",
        text.alias("full_text"),
        completeness(text, "court").alias("text_completeness"),
        F.lit("NATIVE_HTML").alias("extraction_method"),
        F.lit("HIGH").alias("extraction_quality"),
        F.col("__hash").alias("canonical_hash"),
        anonymization(F.col("parties"), "court").alias("anonymization_status"),
        F.struct(
            F.lit("coursupreme.db").alias("source_db"),
            F.lit("decisions").alias("source_table"),
            F.col("id").alias("source_id"),
            "source_url",
            "raw_path",
            F.col("__hash").alias("content_hash"),
        ).alias("provenance"),
    )


def next_start(rows: DataFrame, issue: list[str], page: str) -> DataFrame:
    """WIN-06: the next strictly later start page of the same issue, in ``next_page``.

    Only the distinct start pages of an issue are ordered, so an issue with many rows costs its pages.
    """
    pages = rows.filter(F.col(page).isNotNull()).select(*issue, page).distinct()
    following = F.lead(page).over(Window.partitionBy(*issue).orderBy(page))
    found = pages.withColumn("next_page", following).filter("next_page IS NOT NULL")
    keys = [*issue, page]
    found = found.select(*[F.col(k).alias(f"__{k}") for k in keys], "next_page")
    condition = F.lit(True)
    for k in keys:
        condition = condition & F.col(k).eqNullSafe(F.col(f"__{k}"))
    return rows.join(found, condition, "left").drop(*[f"__{k}" for k in keys])


def page_range_text(ranges: DataFrame, pages: DataFrame, issue: list[str], key: str) -> DataFrame:
    """SRC-07, JON-12: pages first_page to last_page of an issue, joined by blank lines; missing pages are skipped.

    Ranges are exploded to pages, so the join is an equi join however long a range is.
    """
    wanted = ranges.filter("last_page >= first_page").select(key, *issue, F.explode(F.sequence("first_page", "last_page")).alias("page_no"))
    found = wanted.join(pages.select(*issue, "page_no", "text"), [*issue, "page_no"])
    joined = found.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("page_no", "text"))).alias("p"))
    return joined.select(key, F.array_join(F.col("p.text"), "\n\n").alias("text"))


def review_documents(rows: DataFrame, texts: DataFrame, pages: DataFrame | None = None) -> DataFrame:
    """PRJ-03, JON-13: canonical rows of the review's decisions.

    A stored text wins; without one the pages from the start page (1 if missing)
    to the page before the next start, or three pages on, are read.
    """
    stored = texts.select(F.col("decision_id").alias("id"), F.coalesce("full_text", F.lit("")).alias("stored"))
    base = rows.join(stored, "id", "left")
    base = base.withColumn("y", F.coalesce("issue_year", F.lit(0))).withColumn("n", F.coalesce("issue_number", F.lit(0)))
    if pages is None:
        base = base.withColumn("raw", F.coalesce("stored", F.lit("")))
    else:
        start = F.coalesce(F.nullif("pdf_start_page", F.lit(0)), F.lit(1))
        base = next_start(base.withColumn("first_page", start), ["y", "n"], "first_page")
        base = base.withColumn("last_page", F.coalesce(F.col("next_page") - 1, F.col("first_page") + 3))
        named = pages.select(F.col("issue_year").alias("y"), F.col("issue_number").alias("n"), "page_no", "text")
        read = page_range_text(base.filter("stored IS NULL"), named, ["y", "n"], "id").withColumnRenamed("text", "read")
        base = base.join(read, "id", "left").withColumn("raw", F.coalesce("stored", "read", F.lit("")))
    base = base.withColumn("clean", F.coalesce(clean_text(F.col("raw")), F.lit("")))
    base = base.withColumn("__hash", F.sha2("clean", 256)).withColumn("__base", review_base(F.col("y"), F.col("n"), F.col("decision_number")))
    base = with_suffix(base, "__base", F.concat(F.substring("__hash", 1, 8), F.lit("_id"), F.col("id").cast("string")))
    given = F.nullif("keywords", F.lit(""))
    issue = F.concat(F.col("y").cast("string"), F.lit("/"), padded(F.col("n"), 2))
    number = F.coalesce(F.nullif("decision_number", F.lit("")), F.concat(F.lit("id-"), F.col("id").cast("string")))
    date = F.coalesce(F.nullif("date", F.lit("")), F.concat(F.lit("revue "), issue))
    size = completeness(F.col("clean"), "review")
    return base.select(
        "canonical_id",
        F.coalesce(F.nullif("chamber", F.lit("")), "chamber_raw").alias("chamber"),
        F.concat(F.lit("قرار المحكمة العليا رقم "), number, F.lit(" بتاريخ "), date).alias("title"),
        F.col("decision_number").alias("document_number"),
        issue.alias("publication_number"),
        "date",
        year_of(F.col("date"), F.col("y")).alias("year"),
        "subject",
        keywords_json(given, commas=False).alias("keywords"),
        "legal_references",
        "principle",
        disposition(F.col("clean"), "review").alias("disposition"),
        F.col("clean").alias("full_text"),
        size.alias("text_completeness"),
        extraction_quality(size).alias("extraction_quality"),
        F.col("__hash").alias("canonical_hash"),
        F.lit("NOT_ANONYMIZED").alias("anonymization_status"),
        F.struct(
            F.lit("coursupreme_revue.db").alias("source_db"),
            F.lit("revue_decisions").alias("source_table"),
            F.col("id").alias("source_id"),
            F.concat(F.lit("downloads/revue/revue_"), F.col("y").cast("string"), F.lit("_"), padded(F.col("n"), 2), F.lit(".pdf")).alias("pdf_path"),
            F.col("__hash").alias("content_hash"),
        ).alias("provenance"),
    )


def patched_nodes(rows: DataFrame) -> DataFrame:
    """PRJ-05: number, date and year of the nodes whose page has none, only where the number is missing."""
    patches = rows.sparkSession.createDataFrame(NODE_PATCHES, "nid long, p_number string, p_date string, p_year string")
    missing = F.nullif("decision_number", F.lit("")).isNull() & F.col("p_number").isNotNull()
    out = rows.join(F.broadcast(patches), "nid", "left")  # five rows
    for column in ("number", "date", "year"):
        target = "decision_number" if column == "number" else column
        out = out.withColumn(f"__{column}", F.when(missing, F.col(f"p_{column}")).otherwise(F.col(target)))
    for column in ("number", "date", "year"):
        out = out.withColumn("decision_number" if column == "number" else column, F.col(f"__{column}"))
    return out.drop("__number", "__date", "__year", "p_number", "p_date", "p_year")


def council_documents(rows: DataFrame, ocr: DataFrame) -> DataFrame:
    """PRJ-04: canonical rows of the administrative court; ``ocr``: nid, text, path."""
    base = patched_nodes(rows).join(ocr.select("nid", F.col("text").alias("ocr_text"), F.col("path").alias("ocr_path")), "nid", "left")
    base = base.withColumn("clean", F.coalesce(clean_text(F.col("ocr_text")), F.lit(""))).withColumn("__hash", F.sha2("clean", 256))
    base = base.withColumn("__base", council_base(F.col("decision_number"), F.col("date")))
    base = with_clones(base, "__base", "pdf_hash", "__clone")
    base = base.withColumn("__suffix", clone_suffix(F.col("__hash"), F.col("nid"), F.col("__clone")))
    base = with_suffix(base, "__base", F.col("__suffix")).withColumn("__parties", parties(F.col("clean")))
    review = F.col("node_type") == "publications-revue"
    size = completeness(F.col("clean"), "council")
    issue = F.coalesce(F.nullif("decision_number", F.lit("")), "year")
    return base.select(
        "canonical_id",
        F.when(review, "REVIEW_ARTICLE").otherwise("DECISION").alias("document_type"),
        F.when(review, "DOCTRINE_REVIEW").otherwise("JUDICIAL_DECISION").alias("document_nature"),
        F.lit("STATE_COUNCIL").alias("jurisdiction"),
        "chamber",
        "section",
        F.when(review, F.concat(F.lit("مجلة مجلس الدولة - العدد "), shown(issue)))
        .otherwise(F.concat(F.lit("قرار مجلس الدولة رقم "), shown(F.col("decision_number")), F.lit(" بتاريخ "), shown(F.col("date"))))
        .alias("title"),
        F.col("decision_number").alias("document_number"),
        "date",
        year_of(F.col("date"), F.col("year"), strict=True).alias("year"),
        "subject",
        keywords_json(F.col("keywords"), commas=False).alias("keywords"),
        legal_references(F.col("clean")).alias("legal_references"),
        "principle",
        disposition(F.col("clean"), "council").alias("disposition"),
        F.col("clean").alias("full_text"),
        size.alias("text_completeness"),
        extraction_quality(size).alias("extraction_quality"),
        F.col("__hash").alias("canonical_hash"),
        anonymization(F.col("__parties"), "council").alias("anonymization_status"),
        F.struct(
            F.lit("conseildetat.db").alias("source_db"),
            F.lit("decisions").alias("source_table"),
            F.col("id").alias("source_id"),
            "source_url",
            F.coalesce("ocr_path", "raw_path").alias("raw_path"),
            F.col("__hash").alias("content_hash"),
        ).alias("provenance"),
    )
