"""Set algebra over URLs and discovery methods."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexmill.operators.load import one_per_key


def reconcile(site: DataFrame, stored: DataFrame, column: str = "url") -> DataFrame:
    """SET-01: each URL with where it is: site only, stored only or both; nulls are left out."""
    a = site.filter(F.col(column).isNotNull()).select(column).distinct().withColumn("on_site", F.lit(True))
    b = stored.filter(F.col(column).isNotNull()).select(column).distinct().withColumn("in_store", F.lit(True))
    side = F.when(F.col("in_store").isNull(), "site_only").when(F.col("on_site").isNull(), "stored_only").otherwise("both")
    return a.join(b, column, "full_outer").select(column, side.alias("side"))


def verdict(reconciled: DataFrame) -> DataFrame:
    """SET-01: counts of the three sides, PASS if nothing differs."""
    counts = {s: F.count_if(F.col("side") == s).alias(s) for s in ("site_only", "stored_only", "both")}
    out = reconciled.agg(*counts.values())
    return out.withColumn("verdict", F.when((F.col("site_only") == 0) & (F.col("stored_only") == 0), "PASS").otherwise("FAIL"))


def category_coverage(listed: DataFrame, stored: DataFrame) -> DataFrame:
    """SET-02, SET-05: per category how many of its URLs are stored and missing. ``listed``: category, url."""
    known = stored.select("url").distinct().withColumn("in_store", F.lit(1))
    return (
        listed.distinct()
        .join(known, "url", "left")
        .groupBy("category")
        .agg(F.count("*").alias("n_urls"), F.count("in_store").alias("n_stored"), F.count_if(F.col("in_store").isNull()).alias("n_missing"))
    )


def discovery_methods(found: DataFrame) -> DataFrame:
    """SET-03: per URL the methods that found it, in order. ``found``: url, method."""
    return found.groupBy("url").agg(F.array_sort(F.collect_set("method")).alias("methods"))


def single_method(methods: DataFrame) -> DataFrame:
    """AGG-17: URLs that only one method found, per method."""
    return methods.filter(F.size("methods") == 1).groupBy(F.get("methods", F.lit(0)).alias("method")).agg(F.count("*").alias("n"))


def shared_targets(pages: DataFrame) -> DataFrame:
    """AGG-17: links to files that more than one page has: file, number of pages, page. ``pages``: url, pdf_url."""
    unique = pages.distinct()
    shared = unique.groupBy("pdf_url").agg(F.count("*").alias("n")).filter("n > 1")
    return unique.join(shared, "pdf_url").select("pdf_url", "n", "url")


def first_by_url(items: DataFrame, order: str) -> DataFrame:
    """SET-04: the first item of every URL, in order."""
    return one_per_key(items, ["url"], order)
