"""Matches between sources by number, year, chamber and date; page offsets; page ranges."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexmill.functions.dates import bare_number, padded


def index_matches(entries: DataFrame, decisions: DataFrame) -> DataFrame:
    """JON-06: verdict, level and decision of every index entry with a number.

    A decision with the same number and year is exact (level 1), one whose
    chamber contains the entry's probable (2), the first with the number probable
    (3); none is NEW (3), a number of zeros only UNCERTAIN (0). Among equals the
    lowest id wins. The candidates of a number are reduced before the join, so a
    hot number costs one row per year and chamber.
    """
    found = decisions.filter("status = 'telecharge'").select(
        bare_number(F.col("decision_number"), True).alias("num"),
        F.col("id").alias("d_id"),
        F.substring("date", 1, 4).try_cast("int").alias("d_year"),
        F.col("chamber").alias("d_chamber"),
    )
    found = found.filter("num IS NOT NULL").groupBy("num", "d_year", "d_chamber").agg(F.min("d_id").alias("d_id"))
    asked = entries.filter("decision_number IS NOT NULL").withColumn("num", bare_number(F.col("decision_number"), True))
    same_year = (F.coalesce("decision_year", F.lit(0)) != 0) & (F.col("d_year") == F.col("decision_year"))
    in_chamber = (F.coalesce("chamber", F.lit("")) != "") & F.contains("d_chamber", "chamber")
    level = F.when(same_year, 1).when(in_chamber, 2).when(F.col("d_id").isNotNull(), 3)
    ranked = asked.join(found, "num", "left").select("id", "issue_year", "issue_number", "num", "d_id", level.alias("level"))
    best = ranked.groupBy("id", "issue_year", "issue_number", "num").agg(F.min(F.struct("level", "d_id")).alias("best"))
    none = F.col("best.d_id").isNull()
    issue = F.concat(
        F.lit("revue_"), F.coalesce(F.nullif("issue_year", F.lit(0)).cast("string"), F.lit("XXXX")), F.lit("-"), padded(F.coalesce("issue_number", F.lit(0)), 2)
    )
    return best.select(
        F.col("id").alias("entry_id"),
        F.when(F.col("num").isNull(), "UNCERTAIN").when(none, "NEW").when(F.col("best.level") == 1, "MATCH_EXACT").otherwise("MATCH_PROBABLE").alias("verdict"),
        F.when(F.col("num").isNull(), 0).when(none, 3).otherwise(F.col("best.level")).alias("level"),
        F.col("best.d_id").alias("decision_id"),
        F.when(none, issue).otherwise("supreme_court_html+revue").alias("sources"),
    )


def date_verdicts(rows: DataFrame, decisions: DataFrame, agrees) -> DataFrame:
    """JON-07, JON-08: NEW without the number, exact if ``agrees(dates)``, else probable; numbers of zeros are ``0``."""
    dates = (
        decisions.filter("status = 'telecharge' AND decision_number IS NOT NULL")
        .groupBy(bare_number(F.col("decision_number"), False).alias("num"))
        .agg(F.collect_set("date").alias("dates"))  # dates of one number, each once
    )
    keyed = rows.withColumn("num", bare_number(F.col("decision_number"), False))
    verdict = F.when(F.col("dates").isNull(), "NEW").when(F.coalesce(agrees(F.col("dates")), F.lit(False)), "MATCH_EXACT").otherwise("MATCH_PROBABLE")
    return keyed.join(dates, "num", "left").withColumn("verdict", verdict).drop("num", "dates")


def same_date(dates: Column) -> Column:
    return F.array_contains(dates, F.col("date"))


def same_year_prefix(dates: Column) -> Column:
    """A date that begins with the entry's year; a missing year agrees with any date."""
    year = F.coalesce(F.nullif("decision_year", F.lit(0)).cast("string"), F.lit(""))
    return F.exists(dates, lambda d: F.startswith(d, year))


def cross_source_edges(review: DataFrame, court: DataFrame) -> DataFrame:
    """JON-16: numbers and dates of the review against those of the court, classed by date.

    Rows of one source with the same number and date are one class, with its size
    and lowest id; classes of a number are paired, not rows.
    """

    def classes(rows: DataFrame, name: str) -> DataFrame:
        keyed = rows.select(bare_number(F.col("decision_number"), True).alias("num"), F.col("date").alias(f"{name}_date"), "id").filter("num IS NOT NULL")
        return keyed.groupBy("num", f"{name}_date").agg(F.min("id").alias(f"{name}_id"), F.count("*").alias(f"n_{name}"))

    a, b = F.col("review_date"), F.col("court_date")
    kind = (
        F.when(a == b, "SAME_DECISION_DIFFERENT_SOURCE")
        .when(F.substring(a, 1, 4) == F.substring(b, 1, 4), "POSSIBLE_SAME_DECISION")
        .when(a.isNull() | b.isNull(), "UNDATED")
        .otherwise("SAME_NUMBER_DIFFERENT_DECISION")
    )
    return classes(review, "review").join(classes(court, "court"), "num").withColumn("kind", kind)


def offset_samples(decisions: DataFrame, entries: DataFrame) -> DataFrame:
    """JON-09: page differences of decisions found in the text and their last index entry, per issue."""
    issue = ["issue_year", "issue_number"]
    printed = (
        entries.filter("start_page IS NOT NULL")
        .withColumn("num", F.coalesce(bare_number(F.col("decision_number"), False), F.lit("0")))
        .groupBy(*issue, "num")
        .agg(F.max_by("start_page", "id").alias("start_page"))
    )
    found = decisions.filter("decision_number IS NOT NULL AND pdf_start_page IS NOT NULL AND NOT endswith(coalesce(source, ''), 'index_guide')")
    found = found.withColumn("num", bare_number(F.col("decision_number"), False))
    return found.join(printed, [*issue, "num"]).select(*issue, (F.col("pdf_start_page") - F.col("start_page")).alias("offset"), F.col("id").alias("seq"))


def footer_samples(pages: DataFrame) -> DataFrame:
    """WIN-11: page differences from footers ``- n -`` in the last three lines of the first 150 pages."""
    issue = ["issue_year", "issue_number"]
    lines = F.split(F.regexp_replace("text", r"\A\s+|\s+\z", ""), "\n")
    last = F.slice(lines, F.greatest(F.size(lines) - 2, F.lit(1)), 3)
    numbers = F.transform(last, lambda x: F.regexp_extract(x, r"^\s*-\s*(\d+)\s*-\s*$", 1).try_cast("int"))
    printed = F.get(F.filter(numbers, lambda n: n.between(1, 2000)), F.lit(0))
    # what is ranked has no text
    narrow = pages.select(*issue, "page_no", printed.alias("printed"))
    first = Window.partitionBy(*issue).orderBy("page_no")
    early = narrow.withColumn("k", F.row_number().over(first)).filter("k <= 150")
    return early.select(*issue, (F.col("page_no") - F.col("printed")).alias("offset"), F.col("page_no").alias("seq")).filter("offset IS NOT NULL")


def search_samples(entries: DataFrame, pages: DataFrame, reach: int = 10) -> DataFrame:
    """JON-10: the least offset from -10 to 10 at which the page holds the number, of the first 20 entries of an issue.

    Offsets are exploded, so pages meet entries in an equi join.
    """
    issue = ["issue_year", "issue_number"]
    first = Window.partitionBy(*issue).orderBy("start_page", "id")
    some = entries.filter("decision_number IS NOT NULL AND start_page IS NOT NULL").select(*issue, "id", "decision_number", "start_page").withColumn("k", F.row_number().over(first)).filter("k <= 20")
    tried = some.withColumn("offset", F.explode(F.sequence(F.lit(-reach), F.lit(reach)))).withColumn("page_no", F.col("start_page") + F.col("offset"))
    found = tried.join(pages.select(*issue, "page_no", "text"), [*issue, "page_no"]).filter(F.contains("text", "decision_number"))
    return found.groupBy(*issue, F.col("id").alias("seq")).agg(F.min("offset").alias("offset"))


def offset_mode(samples: DataFrame, method: str) -> DataFrame:
    """AGG-13: the most frequent offset of an issue (of equals the first met), its support and confidence."""
    issue = ["issue_year", "issue_number"]
    counts = samples.groupBy(*issue, "offset").agg(F.count("*").alias("samples"), F.min("seq").alias("first"))
    every = Window.partitionBy(*issue)
    best = every.orderBy(F.desc("samples"), "first")
    rows = counts.withColumn("total_samples", F.sum("samples").over(every)).withColumn("k", F.row_number().over(best)).filter("k = 1")
    percent = F.col("samples") / F.col("total_samples") * 100
    if method == "text_search":
        confidence = F.when((F.col("samples") >= 3) & (percent >= 70), "MEDIUM").otherwise("LOW")
    else:
        confidence = F.when((F.col("samples") >= 5) & (percent >= 80), "HIGH").when((F.col("samples") >= 2) & (percent >= 60), "MEDIUM").otherwise("LOW")
    if method == "page_footers":
        rows = rows.filter(F.abs("offset") <= 20)
    return rows.select(
        *issue, F.col("offset").alias("offset_value"), confidence.alias("confidence"), F.lit(method).alias("method"), "samples", "total_samples",
        F.bround(percent, 1).alias("consensus_pct"),
    )


def best_offsets(issues: DataFrame, by_method: list[DataFrame]) -> DataFrame:
    """One offset an issue: good markers, good footers, any markers, any footers, search, else 0 as a fallback."""
    issue = ["issue_year", "issue_number"]
    columns = ["offset_value", "confidence", "method", "samples", "total_samples", "consensus_pct"]
    every = by_method[0]
    for more in by_method[1:]:
        every = every.unionByName(more)
    order = {"text_markers": 0, "page_footers": 1, "text_search": 2}
    rank = F.create_map(*[F.lit(x) for p in order.items() for x in p])[F.col("method")]
    good = F.col("confidence").isin("HIGH", "MEDIUM") & (F.col("method") != "text_search")
    ranked = every.withColumn("rank", rank + F.when(good, 0).otherwise(10))
    best = ranked.groupBy(*issue).agg(F.min_by(F.struct(*columns), "rank").alias("b"))
    fallback = {"offset_value": F.lit(0), "confidence": F.lit("FALLBACK"), "method": F.lit("fallback"), "samples": F.lit(0), "total_samples": F.lit(0), "consensus_pct": F.lit(0.0)}
    return issues.select(*issue).distinct().join(best, issue, "left").select(*issue, *[F.coalesce(F.col(f"b.{c}"), fallback[c]).alias(c) for c in columns])


def legacy_ranges(entries: DataFrame, offsets: DataFrame, last_pages: DataFrame) -> DataFrame:
    """WIN-07: page range of every index entry: to the page before the next entry's, the last to the end, within the issue."""
    issue = ["issue_year", "issue_number"]
    some = entries.filter("decision_number IS NOT NULL AND start_page IS NOT NULL").select(*issue, "id", "decision_number", "start_page").join(offsets.select(*issue, "offset_value"), issue).join(last_pages, issue)
    following = F.lead("start_page").over(Window.partitionBy(*issue).orderBy("start_page", "id"))
    start = F.col("start_page") + F.col("offset_value")
    first = F.greatest(F.lit(1), F.least(start, F.col("last_page")))
    stop = F.coalesce(following + F.col("offset_value") - 1, F.col("last_page"))
    return some.withColumn("first", first).withColumn("stop", stop).select(
        *issue, "id", "decision_number", F.col("first").alias("pdf_start_page"), F.greatest("first", F.least("stop", "last_page")).alias("pdf_end_page")
    )


def paired_ids(entries: DataFrame, existing: DataFrame) -> DataFrame:
    """SNK-11: the existing decision of every entry: same number and page, else the next unused one of the number.

    ``entries`` and ``existing``: issue_year, issue_number, decision_number, page, id.
    An entry whose exact partner is taken by an earlier one gets none.
    """
    key = ["issue_year", "issue_number", "decision_number"]
    last = Window.partitionBy(*key, "page").orderBy(F.desc("id"))
    exact_side = existing.withColumn("k", F.row_number().over(last)).filter("k = 1").select(*key, "page", F.col("id").alias("decision_id"))
    first = Window.partitionBy(*key, "page").orderBy("id")
    hit = entries.withColumn("k", F.row_number().over(first)).join(exact_side, [*key, "page"], "left")
    exact = hit.filter("decision_id IS NOT NULL AND k = 1").select(*key, "id", "decision_id")
    open_entries = hit.filter("decision_id IS NULL").select(*key, "id", "page")
    unused = existing.join(exact.select(*key, F.col("decision_id").alias("id")), [*key, "id"], "left_anti")
    by_order = lambda df, *order: df.withColumn("n", F.row_number().over(Window.partitionBy(*key).orderBy(*order)))
    rest = by_order(open_entries, "page", "id").join(by_order(unused, "page", "id").select(*key, "n", F.col("id").alias("decision_id")), [*key, "n"])
    return exact.select("id", "decision_id").unionByName(rest.select("id", "decision_id"))
