"""Canonical ids: a readable base, and a suffix only for members of a colliding group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexmill.functions.dates import padded
from lexmill.functions.text import slug


def court_base(number: Column, date: Column) -> Column:
    return F.concat(F.lit("cs_decision_"), slug(number, "sans_numero"), F.lit("_"), slug(date, "sans_date", lower=False), F.lit("_ar"))


def council_base(number: Column, date: Column) -> Column:
    return F.concat(F.lit("cde_decision_"), slug(number, "sans_numero"), F.lit("_"), slug(date, "sans_date"), F.lit("_ar"))


def review_base(year: Column, issue: Column, number: Column) -> Column:
    """Year 0 or null is ``0000``; a numeric issue has two digits at least."""
    y = slug(F.nullif(year.cast("string"), F.lit("0")), "0000")
    return F.concat(F.lit("cs_revue_"), y, F.lit("_"), F.coalesce(padded(issue, 2), F.lit("00")), F.lit("_"), slug(number, "sans_numero"), F.lit("_ar"))


def gazette_base(year: Column, issue: Column, kind_slug: Column, number: Column, ordinal: Column, language: Column) -> Column:
    kept = F.nullif(F.lower(F.regexp_replace(number, "[^a-zA-Z0-9-]", "")), F.lit(""))
    part = F.when(F.nullif(number, F.lit("")).isNotNull(), F.coalesce(kept, F.lit(""))).otherwise(F.concat(F.lit("ord"), ordinal.cast("string")))
    return F.concat_ws("_", F.lit("joradp"), year.cast("string"), padded(issue, 3), kind_slug, part, F.lower(language))


def with_suffix(rows: DataFrame, base: str, suffix: Column, scope: tuple[str, ...] = (), into: str = "canonical_id") -> DataFrame:
    """WIN-05: ``base``, with ``_suffix`` where several rows of the scope share it.

    Within a scope, which bounds the group, rows are counted in a window. Without
    one the colliding bases are counted apart, combined before the shuffle, and
    joined back, so that a base that a third of all rows share is no single task.
    """
    if scope:
        counted = rows.withColumn("__collides", F.count("*").over(Window.partitionBy(*scope, base)) > 1)
    else:
        counted = rows.join(repeated(rows, [base], "__collides"), base, "left")
    collides = F.coalesce("__collides", F.lit(False))
    return counted.withColumn(into, F.when(collides, F.concat(F.col(base), F.lit("_"), suffix)).otherwise(F.col(base))).drop("__collides")


def repeated(rows: DataFrame, key: list[str], flag: str) -> DataFrame:
    """Keys that several rows have, with a true ``flag``."""
    return rows.groupBy(*key).agg(F.count("*").alias("__n")).filter("__n > 1").select(*key, F.lit(True).alias(flag))


def with_clones(rows: DataFrame, base: str, pdf_hash: str, flag: str) -> DataFrame:
    """JON-14: flags rows whose group has another row with the same PDF hash; nulls are equal."""
    clones = repeated(rows, [base, pdf_hash], flag).select(F.col(base).alias("__b"), F.col(pdf_hash).alias("__h"), flag)
    return rows.join(clones, (F.col(base) == F.col("__b")) & F.col(pdf_hash).eqNullSafe(F.col("__h")), "left").drop("__b", "__h")


def clone_suffix(content_hash: Column, nid: Column, clone: Column) -> Column:
    """JON-14: the node id joins the suffix of a clone."""
    short = F.substring(content_hash, 1, 8)
    return F.when(clone, F.concat(short, F.lit("_nid"), nid.cast("string"))).otherwise(short)
