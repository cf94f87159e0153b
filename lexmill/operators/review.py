"""The review: decisions out of scanned pages, guide tables out of positioned words."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexmill.functions.classify import parser_status
from lexmill.functions.dates import tolerant_int, year_before_dash
from lexmill.functions.fixed import DECISION_LINE, DISPOSITION_LINE, FIELD_LINES, GUIDE_HEADERS, REVIEW_CHAMBERS, SECTION_LINE
from lexmill.functions.patterns import portable
from lexmill.functions.text import normalize_guide_text, strip


def page_lines(pages: DataFrame, issue: list[str]) -> DataFrame:
    """Lines of pages with their number, from 0."""
    return pages.select(*issue, "page_no", F.posexplode(F.split("text", "\n")).alias("line_no", "line"))


def segment(pages: DataFrame, issue: list[str]) -> DataFrame:
    """EXT-13, WIN-08..10: decisions of an issue from the lines of its pages.

    A start line opens an island; its chamber is the last section seen before.
    Each labelled field takes its first value, the operative part sets a flag.
    Lines are ordered within their page; over an issue only the pages' numbers of
    starts and last sections are. A page is there once; of texts for one page the lowest counts.
    """
    line = F.col("line")
    starts = line.rlike(portable(DECISION_LINE)) & ~line.rlike(r"\.{2,}\s*\d+\s*$")
    section = F.nullif(F.regexp_replace(strip(F.regexp_extract(line, portable(SECTION_LINE), 1)), portable(r"\s+"), " "), F.lit(""))
    once = pages.groupBy(*issue, "page_no").agg(F.min("text").alias("text"))
    rows = page_lines(once, issue).withColumn("starts", starts).withColumn("section", F.when(~starts, section))
    sums = rows.groupBy(*issue, "page_no").agg(
        F.sum(F.col("starts").cast("int")).alias("n_starts"), F.max_by("section", F.when(F.col("section").isNotNull(), F.col("line_no"))).alias("last_section")
    )
    before = Window.partitionBy(*issue).orderBy("page_no").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(
        *[F.col(c).alias(f"of_{c}") for c in (*issue, "page_no")],
        F.coalesce(F.sum("n_starts").over(before), F.lit(0)).alias("past_starts"),
        F.last("last_section", True).over(before).alias("past_section"),
    )
    same = F.lit(True)
    for c in (*issue, "page_no"):
        same = same & F.col(c).eqNullSafe(F.col(f"of_{c}"))
    ordered = Window.partitionBy(*issue, "page_no").orderBy("line_no")
    rows = rows.withColumn("started", F.sum(F.col("starts").cast("int")).over(ordered.rowsBetween(Window.unboundedPreceding, 0)))
    rows = rows.withColumn("section_here", F.last("section", True).over(ordered.rowsBetween(Window.unboundedPreceding, -1)))
    rows = rows.join(sums, same).withColumn("island", F.col("started") + F.col("past_starts")).withColumn("chamber_before", F.coalesce("section_here", "past_section"))
    at = F.struct("page_no", "line_no")
    fields = {}
    taken = F.lit(False)
    for name, label in FIELD_LINES.items():
        pattern = portable(rf"^\s*\**\s*{label}\s*\**\s*:?\s*(.*)")
        value = F.trim(strip(F.regexp_extract(line, pattern, 1)), F.lit("*"))
        fits = line.rlike(pattern) & ~F.col("starts")
        fields[name] = F.min_by(F.when(fits & ~taken, value), F.when(fits & ~taken & (value != ""), at))
        taken = taken | fits
    begin = F.col("starts")
    out = rows.filter("island > 0").groupBy(*issue, "island").agg(
        F.min_by(F.regexp_extract(line, portable(DECISION_LINE), 1), F.when(begin, at)).alias("decision_number"),
        F.min_by(F.replace(F.regexp_extract(line, portable(DECISION_LINE), 2), F.lit("/"), F.lit("-")), F.when(begin, at)).alias("date"),
        F.min(F.when(begin, F.col("page_no"))).alias("start_page"),
        F.min_by("chamber_before", F.when(begin, at)).alias("chamber_raw"),
        *[v.alias(k) for k, v in fields.items()],
        F.max(line.rlike(portable(DISPOSITION_LINE)) & ~begin & ~taken).alias("has_disposition"),
    )
    chambers = F.create_map(*[F.lit(x) for p in REVIEW_CHAMBERS.items() for x in p])
    return out.withColumn("chamber", F.try_element_at(chambers, F.coalesce("chamber_raw", F.lit("")))).drop("island")


def _header(text: Column) -> Column:
    compact = F.replace(text, F.lit(" "), F.lit(""))
    chain = None
    for alias, name in GUIDE_HEADERS.items():
        chain = (F if chain is None else chain).when(F.contains(compact, F.lit(alias)), name)
    return chain


def guide_columns(cells: DataFrame) -> DataFrame:
    """EXT-14: column bands of a page from the first row of the grid that names a header.

    ``cells``: page, row_no, col_no, x0, x1, top, bottom, text (in reading order).
    A page without a number column has none.
    """
    named = cells.withColumn("field", _header(F.col("text")))
    first = named.filter("field IS NOT NULL").groupBy("page").agg(F.min("row_no").alias("header_row"))
    bands = named.join(first, "page").filter("row_no = header_row AND field IS NOT NULL")
    last = Window.partitionBy("page", "field").orderBy(F.desc("col_no"))  # of two columns with one name the later
    bands = bands.withColumn("k", F.row_number().over(last)).filter("k = 1")
    numbered = bands.filter("field = 'decision_number'").select("page")
    return bands.join(numbered, "page", "left_semi").select("page", "field", "x0", "x1", "header_row")


def guide_entries(words: DataFrame, cells: DataFrame) -> DataFrame:
    """JON-11, WIN-13: index entries of a guide's pages from positioned words.

    A word belongs to the row band that holds its centre, 2 points of slack, and
    to the first column within 8 points, else to the nearest below 30. Both joins
    are on the page, which bounds them.
    """
    columns = guide_columns(cells)
    header = columns.groupBy("page").agg(F.first("header_row").alias("header_row"))
    bands = (
        cells.join(header, "page").filter("row_no > header_row").groupBy("page", "row_no").agg(F.min("top").alias("band_top"), F.max("bottom").alias("band_bottom"))
    )
    placed = words.withColumn("y", (F.col("top") + F.col("bottom")) / 2).withColumn("x", (F.col("x0") + F.col("x1")) / 2)
    placed = placed.select("page", F.col("text").alias("word"), "top", F.col("x0").alias("w0"), "x", "y", F.monotonically_increasing_id().alias("w"))
    in_row = placed.join(bands, "page").filter("y BETWEEN band_top - 2 AND band_bottom + 2")
    near = in_row.join(columns.select("page", "field", "x0", "x1"), "page")
    inside = F.col("x").between(F.col("x0") - 8, F.col("x1") + 8)
    gap = F.least(F.abs(F.col("x") - F.col("x0")), F.abs(F.col("x") - F.col("x1")))
    rank = F.struct(F.when(inside, 0).otherwise(1), F.when(inside, F.col("x0")).otherwise(gap), F.col("x0"))
    best = near.filter(inside | (gap < 30)).groupBy("page", "row_no", "w", "word", "top", "w0").agg(F.min_by("field", rank).alias("field"))
    lines = best.groupBy("page", "row_no", "field", F.bround(F.col("top") / 4).alias("line")).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("w0", "word"))), lambda s: s["word"]), " ").alias("text")
    )
    texts = lines.groupBy("page", "row_no", "field").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("line", "text"))), lambda s: s["text"]), "\n").alias("text")
    )
    texts = texts.withColumn("text", F.nullif(normalize_guide_text(F.col("text")), F.lit("")))
    wide = texts.groupBy("page", "row_no").pivot("field", sorted(set(GUIDE_HEADERS.values()))).agg(F.first("text"))
    number = F.replace("decision_number", F.lit(" "), F.lit(""))
    year, page = year_before_dash(F.col("decision_year")), tolerant_int(F.col("start_page"))
    return wide.select(
        F.col("page").alias("source_page"), "row_no", number.alias("decision_number"), year.alias("decision_year"), tolerant_int(F.col("issue_number")).alias("issue_number"),
        year.alias("issue_year"), page.alias("start_page"), "chamber", "subject", "principle", "legal_reference", parser_status(number, year, page).alias("parser_status"),
    )
