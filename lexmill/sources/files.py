"""Files: issues, pages, OCR output, sitemaps, archives and PDFs, by Spark's own readers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def whole_texts(spark: SparkSession, folder: str, glob: str = "*") -> DataFrame:
    """``path, text`` of every file below a folder."""
    read = spark.read.option("wholetext", True).option("recursiveFileLookup", True).option("pathGlobFilter", glob)
    return read.text(folder).select(F.col("_metadata.file_path").alias("path"), F.col("value").alias("text"))


def parsed_issues(files: DataFrame, year: int | None = None, issue: str | None = None, language: str | None = None, this_year: int = 2025) -> DataFrame:
    """SRC-05: issues with language, year and number from arguments, else the path, else defaults."""
    parent = F.element_at(F.split("path", "/"), -2)
    code = r"([A-Z]{2})([0-9]{4})([0-9]{3})"
    by_folder = F.when(F.contains("path", F.lit("/OCR-Fr/")), "FR").when(F.contains("path", F.lit("/OCR-Ar/")), "AR")
    prefix = F.nullif(F.regexp_extract(parent, code, 1), F.lit(""))
    given = lambda v: F.lit(v) if v is not None else F.lit(None)
    return files.select(
        "path",
        "text",
        F.coalesce(given(year), F.regexp_extract(parent, code, 2).try_cast("int"), F.lit(this_year)).alias("year"),
        F.coalesce(given(issue), F.nullif(F.regexp_extract(parent, code, 3), F.lit("")), F.lit("001")).alias("issue"),
        F.coalesce(given(language), by_folder, F.when(prefix == "FR", "FR").when(prefix.isNotNull(), "AR"), F.lit("FR")).alias("language"),
    )


def issue_inventory(paths: DataFrame) -> DataFrame:
    """SRC-06: one file an issue of ``.../OCR-Fr|Ar/year/issue/file``, ``markdown.md`` before the issue's own name.

    Years that are no number are left out; the issue's number is characters 7 to 9 of its name, if it has nine.
    """
    part = lambda n: F.element_at(F.split("path", "/"), n)
    stem = F.regexp_replace(part(-2), r"\.pdf$", "")
    rows = paths.select(
        "path",
        F.when(part(-4) == "OCR-Fr", "FR").when(part(-4) == "OCR-Ar", "AR").alias("language"),
        part(-3).try_cast("int").alias("year"),
        stem.alias("stem"),
        part(-1).alias("file"),
    ).filter("language IS NOT NULL AND year IS NOT NULL")
    rows = rows.filter((F.col("file") == "markdown.md") | (F.col("file") == F.concat("stem", F.lit(".md"))))
    first = Window.partitionBy("language", "year", "stem").orderBy(F.col("file") != "markdown.md")
    rows = rows.withColumn("n", F.row_number().over(first)).filter("n = 1").drop("n")
    number = F.when(F.length("stem") >= 9, F.substring("stem", 7, 3)).otherwise(F.col("stem"))
    return rows.select("path", "language", "year", number.alias("issue")).orderBy("language", "year", "issue")


def issue_pages(files: DataFrame) -> DataFrame:
    """Pages of ``.../year/issue_NN/pages/page-N/markdown.md``."""
    pattern = r"/(\d{4})/issue_(\d+)/pages/page-(\d+)/markdown\.md$"
    number = lambda g: F.regexp_extract("path", pattern, g).try_cast("int")
    return files.filter(F.col("path").rlike(pattern)).select(
        number(1).alias("issue_year"), number(2).alias("issue_number"), number(3).alias("page_no"), "text", "path"
    )


def node_ocr(files: DataFrame) -> DataFrame:
    """SRC-08: OCR text of a node: the first folder ``nid_<n>_...``, else ``nid_<n>.pdf``."""
    folder = F.element_at(F.split("path", "/"), -2)
    rows = files.filter(F.endswith("path", F.lit("/markdown.md"))).select(
        F.regexp_extract(folder, r"^nid_(\d+)(?:_|\.pdf$)", 1).try_cast("int").alias("nid"), folder.rlike(r"^nid_\d+\.pdf$").alias("direct"), "path", "text"
    )
    best = F.min_by(F.struct("text", "path"), F.struct("direct", "path"))
    return rows.filter("nid IS NOT NULL").groupBy("nid").agg(best.alias("b")).select("nid", "b.text", "b.path")


def ocr_pages(payload: Column) -> Column:
    """SRC-09: page texts of an OCR answer, ``pages`` at the top or below ``data``."""
    schema = "struct<pages:array<struct<markdown:string>>,data:struct<pages:array<struct<markdown:string>>>>"
    parsed = F.from_json(payload, schema)
    return F.coalesce(parsed["pages"], parsed["data"]["pages"])["markdown"]


def ocr_document(payload: Column) -> Column:
    """SRC-09: the pages of an OCR answer in one text."""
    return F.array_join(F.transform(ocr_pages(payload), lambda p: F.coalesce(p, F.lit(""))), "\n\n---\n\n")


def sitemap_urls(xml: Column) -> Column:
    """SRC-11: locations of a sitemap, percent signs decoded."""
    return F.transform(F.regexp_extract_all(xml, F.lit("<loc>([^<]+)</loc>"), F.lit(1)), lambda u: F.try_url_decode(u))


def seed_list(spark: SparkSession, path: str) -> DataFrame:
    """SRC-14: a JSON list of seeds."""
    return spark.read.option("multiLine", True).json(path)


def seeds(text: Column, schema: str) -> Column:
    """SRC-14: the seeds of a JSON list as an array of structs; null if it is none."""
    return F.from_json(text, f"array<struct<{', '.join(f'{n}: {t}' for n, t in (p.split() for p in schema.split(', ')))}>>")


def page_count(content: Column) -> Column:
    """SRC-15: pages of a PDF's bytes, by their objects; compressed object streams are not opened."""
    return F.regexp_count(F.decode(content, "ISO-8859-1"), F.lit(r"/Type\s*/Page\b"))


def binary_files(spark: SparkSession, folder: str, glob: str = "*.pdf") -> DataFrame:
    """SRC-15: ``path, size, content`` of files."""
    read = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob)
    return read.load(folder).select("path", F.col("length").alias("size"), "content")


def archived_pages(files: DataFrame, rows: DataFrame) -> DataFrame:
    """SRC-16: archived pages beside the rows whose ``raw_path`` names them."""
    name = F.regexp_extract("path", "[^/]+$", 0)
    pages = files.select(name.alias("file"), F.col("text").alias("html"))
    return rows.withColumn("file", F.regexp_extract("raw_path", "[^/]+$", 0)).join(pages, "file", "left").drop("file")


def issue_url(language: Column, year: Column, issue: Column, site: str) -> Column:
    """EXT-08: where an issue's PDF lies; folders differ by language."""
    folder = F.when(language == "FR", "JO-FRANCAIS").otherwise("jo-arabe")
    letter = F.when(language == "FR", "F").otherwise("A")
    return F.concat(F.lit(site.rstrip("/") + "/FTP/"), folder, F.lit("/"), year.cast("string"), F.lit("/"), letter, year.cast("string"), issue, F.lit(".pdf"))
