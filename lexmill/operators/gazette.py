"""Gazette issues to acts and articles, in native expressions.

Every match of a heading gets marks around it; splitting at the marks gives the
pieces, their lengths the positions. Rejected headings do not end an act. An issue
is one row, so repeats, ordinals and colliding bases are settled within its row,
without a shuffle. Repeated rows come out alike.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexmill.functions.classify import act_kinds, heading_subject
from lexmill.functions.dates import act_number, date_ar, date_fr, heading_number, padded
from lexmill.functions.fixed import (
    ARTICLE_AR, ARTICLE_FR, CONTENTS_LINE, ERRATUM, FOLLOW_AR, FOLLOW_FR, HEADS_AR, HEADS_FR, PREAMBLES_AR, PREAMBLES_FR,
    SIGNATURE_AR, SIGNATURE_FR,
)
from lexmill.functions.patterns import SPACE, portable
from lexmill.functions.text import let, plain_digits, strip
from lexmill.operators.identity import gazette_base

_OPEN = r"(?:^|\n)(?:#+\s*|\*\*)?"
HEADING = {
    "FR": portable(rf"(?iu){_OPEN}((?:{'|'.join(HEADS_FR)})\s+(?:{'|'.join(FOLLOW_FR)})[^\n]+)"),
    "AR": portable(rf"{_OPEN}((?:{'|'.join(HEADS_AR)})(?:\s+[^.\n]{{1,50}}?)?\s+(?:{'|'.join(FOLLOW_AR)})[^\n]+)"),
}
PREAMBLE = {"FR": portable(f"(?iu)(?:{'|'.join(PREAMBLES_FR)})"), "AR": portable(f"(?:{'|'.join(PREAMBLES_AR)})")}
ARTICLE = {"FR": portable(rf"(?iu){_OPEN}{ARTICLE_FR}"), "AR": portable(rf"{_OPEN}{ARTICLE_AR}")}
SIGNATURE = {"FR": portable(SIGNATURE_FR.replace("(?i)", "(?iu)")), "AR": portable(SIGNATURE_AR)}


def _per_language(language: Column, make) -> Column:
    return F.when(language == "AR", make("AR")).otherwise(make("FR"))


def candidates(text: Column, language: Column) -> Column:
    """EXT-11, FLT-01..03: headings as structs (start, end, heading, in_contents, in_erratum, has_preamble)."""
    marked = _per_language(language, lambda k: F.regexp_replace(text, HEADING[k], "\x01$0\x02$1\x02"))

    def one(parts: Column, start: Column) -> Column:
        whole, heading = F.get(parts, F.lit(0)), F.get(parts, F.lit(1))
        heading = F.rtrim(F.rtrim(strip(heading), F.lit("*")), F.lit("."))

        def judged(h: Column) -> Column:
            end = start + F.length(h["whole"])
            ahead = F.greatest(F.lit(0), start - 60)
            before = F.lower(strip(F.substring(text, ahead + 1, start - ahead)))
            after = F.substring(text, end + 1, F.lit(1200))
            return F.struct(
                start.alias("start"),
                end.alias("end"),
                h["heading"].alias("heading"),
                h["heading"].rlike(portable(CONTENTS_LINE)).alias("in_contents"),
                before.rlike(portable(ERRATUM)).alias("in_erratum"),
                _per_language(language, lambda k: after.rlike(PREAMBLE[k])).alias("has_preamble"),
            )

        return let(F.struct(whole.alias("whole"), heading.alias("heading")), judged)

    def all_of(pieces: Column) -> Column:
        # pieces are (text before the first heading), then (heading with what opens it, heading, text that follows)
        length = lambda p: F.length(F.get(p, F.lit(0))) + F.coalesce(F.length(F.get(p, F.lit(2))), F.lit(0))
        starts = F.aggregate(pieces, F.array(F.lit(0)), lambda a, p: F.concat(a, F.array(F.element_at(a, -1) + length(p))))
        placed = F.slice(F.arrays_zip(pieces.alias("parts"), starts.alias("start")), 2, F.greatest(F.size(pieces) - 1, F.lit(0)))
        return F.transform(placed, lambda p: one(p["parts"], p["start"]))

    return let(F.transform(F.split(marked, "\x01", -1), lambda p: F.split(p, "\x02", 3)), all_of)


def accepted(found: Column) -> Column:
    """Headings outside contents and errata with a preamble; if none has one, all outside."""

    def chosen(every: Column) -> Column:
        outside = F.filter(every, lambda c: ~c["in_contents"] & ~c["in_erratum"])
        return let(outside, lambda o: let(F.filter(o, lambda c: c["has_preamble"]), lambda v: F.when(F.size(v) > 0, v).otherwise(o)))

    return let(found, chosen)


def acts(issues: DataFrame, year: str = "year", issue: str = "issue", language: str = "language", text: str = "text") -> DataFrame:
    """Acts of issues, one row each, with number, date, subject, hash, ordinal and canonical id."""
    key = [year, issue, language]
    kind = F.col(language)
    base = issues.withColumn("__text", F.translate(F.when(kind == "AR", plain_digits(F.col(text))).otherwise(F.col(text)), "\x01\x02", "\x1a\x1a"))
    base = base.select(*key, "__text", accepted(candidates(F.col("__text"), kind)).alias("__heads"))

    def span(h: Column, i: Column) -> Column:
        stop = F.coalesce(F.get(F.col("__heads"), i + 1)["start"], F.length("__text"))
        body = strip(F.substring(F.col("__text"), h["start"] + 1, stop - h["start"]))
        return let(body, lambda t: F.struct(h["start"].alias("start"), h["heading"].alias("heading"), t.alias("full_text"), F.sha2(t, 256).alias("content_hash")))

    def firsts(found: Column) -> Column:
        """Without later acts of the same heading and hash."""
        names = F.transform(found, lambda a: F.concat_ws("\x02", a["heading"], a["content_hash"]))
        return let(names, lambda n: F.filter(found, lambda a, i: F.array_position(n, F.get(n, i)) == i + 1))

    def named(a: Column, i: Column) -> Column:
        head, early = a["heading"], F.substring(a["full_text"], 1, 500)
        known = F.struct(act_kinds(head, kind).alias("kinds"), heading_number(head, kind).alias("raw_number"))

        def rest(k: Column) -> Column:
            number = act_number(k["raw_number"], F.col(year))
            date = F.when(kind == "AR", F.coalesce(date_ar(head), date_ar(early))).otherwise(F.coalesce(date_fr(head), date_fr(early)))
            return let(
                number,
                lambda n: F.struct(
                    *[a[c].alias(c) for c in ("start", "heading", "full_text", "content_hash")],
                    (i + 1).alias("ordinal"),
                    k["kinds"]["type"].alias("document_type"),
                    k["kinds"]["slug"].alias("type_slug"),
                    k["raw_number"].alias("raw_number"),
                    n.alias("number"),
                    date.alias("date"),
                    heading_subject(head, kind).alias("subject"),
                    gazette_base(F.col(year), F.col(issue), k["kinds"]["slug"], n, i + 1, kind).alias("base_id"),
                ),
            )

        return let(known, rest)

    acts_ = base.select(*key, let(F.transform("__heads", span), firsts).alias("__acts")).select(*key, F.transform("__acts", named).alias("__acts"))
    bases = F.transform("__acts", lambda a: a["base_id"])
    # an inner explode would filter by the size of its array first, and compute it once more for that
    rows = acts_.select(*key, bases.alias("__bases"), F.explode_outer("__acts").alias("act")).filter("act IS NOT NULL").select(*key, "act.*", "__bases")
    collides = F.array_position("__bases", F.col("base_id")) + F.array_position(F.reverse("__bases"), F.col("base_id")) != F.size("__bases") + 1
    suffixed = F.concat("base_id", F.lit("_"), F.substring("content_hash", 1, 8))
    return rows.withColumn("canonical_id", F.when(collides, suffixed).otherwise(F.col("base_id"))).drop("__bases")


def act_documents(rows: DataFrame, year: str = "year", issue: str = "issue", language: str = "language") -> DataFrame:
    """PRJ-01: canonical rows of acts."""
    return rows.select(
        "canonical_id",
        "document_type",
        F.lit("LEGISLATIVE_NORM").alias("document_nature"),
        F.lit("REPUBLIC").alias("jurisdiction"),
        F.lit("LEGISLATIVE").alias("court_level"),
        F.col("heading").alias("title"),
        F.coalesce(F.nullif("number", F.lit("")), "raw_number").alias("document_number"),
        F.concat(F.lit("JO "), F.col(year).cast("string"), F.lit("-"), padded(F.col(issue), 3)).alias("publication_number"),
        "date",
        F.col(year).alias("year"),
        F.col(language).alias("language"),
        "subject",
        "full_text",
        F.lit("markdown").alias("text_format"),
        F.lit("FULL_TEXT").alias("text_completeness"),
        F.lit("MARKDOWN_PARSE").alias("extraction_method"),
        F.lit("HIGH").alias("extraction_quality"),
        F.col("content_hash").alias("canonical_hash"),
        F.lit("NOT_ANONYMIZED").alias("anonymization_status"),
    )


def split_articles(text: Column, language: Column) -> Column:
    """EXT-12, WIN-02: articles as structs (ordinal, article_number, text); a signature ends the last one."""
    marked = _per_language(language, lambda k: F.regexp_replace(text, ARTICLE[k], "\x01$1\x02"))

    def all_of(pieces: Column) -> Column:
        count = F.size(pieces) - 1

        def one(piece: Column, i: Column) -> Column:
            number = F.substring_index(piece, "\x02", 1)
            body = F.substring(piece, F.length(number) + 2, F.length(piece))
            cut = _per_language(language, lambda k: F.regexp_replace(body, SIGNATURE[k] + r"[\s\S]*", ""))
            body = F.when(i == count - 1, cut).otherwise(body)
            body = strip(F.regexp_replace(strip(body), rf"^[{SPACE}—*:-]+", ""))
            number = strip(number)
            return F.struct((i + 1).alias("ordinal"), F.when(F.lower(number) == "premier", "1er").otherwise(number).alias("article_number"), body.alias("text"))

        return F.when(count > 0, F.transform(F.slice(pieces, 2, F.greatest(count, F.lit(1))), one))

    return let(F.split(marked, "\x01", -1), all_of)


def articles(rows: DataFrame, key: str, text: str = "full_text", language: str = "language") -> DataFrame:
    """Articles of acts in order."""
    return rows.select(key, language, F.explode_outer(split_articles(F.col(text), F.col(language))).alias("a")).filter("a IS NOT NULL").select(
        F.col(key).alias("parent_document_id"), "a.article_number", F.lit(None).cast("string").alias("title"), "a.text", language, "a.ordinal"
    )


def bilingual_pairs(rows: DataFrame, scope: list[str], order: str = "ordinal", document_id: str = "canonical_id") -> DataFrame:
    """JON-05: French and Arabic acts of one issue with the same type and number.

    The last Arabic act of a key is the partner; it points back at its last
    French one. Gives ``canonical_id, language_pair_id`` for both sides.
    """
    numbered = rows.filter(F.nullif("document_number", F.lit("")).isNotNull())
    key = [*scope, "document_type", "document_number"]
    last = Window.partitionBy(*key).orderBy(F.desc(order))
    arabic = numbered.filter("language = 'AR'").withColumn("n", F.row_number().over(last)).filter("n = 1")
    french = numbered.filter("language = 'FR'").select(*key, F.col(document_id).alias("fr_id"), F.col(order).alias("fr_order"))
    paired = french.join(arabic.select(*key, F.col(document_id).alias("ar_id")), key)
    back = paired.groupBy("ar_id").agg(F.max_by("fr_id", "fr_order").alias("fr_id"))
    return paired.select(F.col("fr_id").alias(document_id), F.col("ar_id").alias("language_pair_id")).unionByName(
        back.select(F.col("ar_id").alias(document_id), F.col("fr_id").alias("language_pair_id"))
    )
