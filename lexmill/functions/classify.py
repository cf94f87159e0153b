"""Classes: acts, chambers, nodes, resources, completeness, quality, PDF kinds."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lexmill.functions.fixed import ACTS_AR, ACTS_FR, CHAMBER_CLASSES, NODE_TYPES, SUBJECT_AR, SUBJECT_FR
from lexmill.functions.text import let, strip


def act_kinds(heading: Column, language: Column) -> Column:
    """CLS-01: struct of type and slug of an act by its heading; first rule that fits."""

    def kind(name: str, slug: str) -> Column:
        return F.struct(F.lit(name).alias("type"), F.lit(slug).alias("slug"))

    def chosen(text: Column) -> Column:
        out = None
        for which, rules in (("AR", ACTS_AR), ("FR", ACTS_FR)):
            chain = None
            for pattern, name, slug in rules:
                fits = text.rlike(("(?U)^" if which == "AR" else "(?iu)(?U)^") + pattern)
                chain = (F if chain is None else chain).when(fits, kind(name, slug))
            out = (F if out is None else out).when(language == which, chain.otherwise(kind("OTHER", "act")))
        return out

    return F.when(heading.isNotNull(), let(strip(heading), chosen))


def act_type(heading: Column, language: Column) -> Column:
    return act_kinds(heading, language)["type"]


def act_slug(heading: Column, language: Column) -> Column:
    return act_kinds(heading, language)["slug"]


def heading_subject(heading: Column, language: Column) -> Column:
    """CLS-02: from the verb that opens the subject to the end, without stops there."""
    french = F.regexp_extract(heading, rf"(?iu)(?U)\b(?:{'|'.join(SUBJECT_FR)})\s+.+$", 0)
    arabic = F.regexp_extract(heading, rf"(?U)\b(?:{'|'.join(SUBJECT_AR)})\s+.+$", 0)
    return F.nullif(F.rtrim(strip(F.when(language == "AR", arabic).otherwise(french)), F.lit(".")), F.lit(""))


def taxonomy_class(classes: Column) -> Column:
    """CLS-03: the first CSS class that names a chamber group."""
    names = "|".join(sorted(CHAMBER_CLASSES))
    return F.get(F.filter(F.split(classes, r"\s+"), lambda c: c.rlike(rf"^(?:{names})(?:-\d+)?$")), F.lit(0))


def chamber_of_class(css: Column) -> Column:
    """CLS-03: the chamber group of a CSS class."""
    chain = None
    for prefix, label in CHAMBER_CLASSES.items():
        chain = (F if chain is None else chain).when(F.startswith(css, F.lit(prefix)), label)
    return chain


def node_type(classes: Column) -> Column:
    """CLS-04: the first CSS class that is a kind of node."""
    return F.get(F.filter(F.split(classes, r"\s+"), lambda c: c.isin(*NODE_TYPES)), F.lit(0))


def resource_type(title: Column) -> Column:
    """CLS-05: kind of a review resource by its decoded title."""
    guide = F.contains(title, F.lit("قرارات")) | F.contains(title, F.lit("البحث"))
    return (
        F.when(F.contains(title, F.lit("عدد خاص")) | F.contains(title, F.lit("خص")), "SPECIAL_ISSUE")
        .when(title.rlike(r"عدد[-\s]?\d{2}") & F.contains(title, F.lit("مجلة")), "REVUE")
        .when(F.contains(title, F.lit("دليل")) & guide, "GUIDE")
        .when(F.contains(title, F.lit("دليل")), "INDEX")
        .otherwise("OTHER")
    )


def completeness(text: Column, source: str) -> Column:
    """CLS-06: FULL_TEXT, PARTIAL_TEXT or INDEX_ONLY by length; ``source``: court, review or council."""
    if source == "court":
        return F.when(F.length(strip(text)) > 100, "FULL_TEXT").otherwise("PARTIAL_TEXT")
    partial = {"review": 200, "council": 300}[source]
    size = F.coalesce(F.length(text), F.lit(0))
    return F.when(size >= 1000, "FULL_TEXT").when(size >= partial, "PARTIAL_TEXT").otherwise("INDEX_ONLY")


def extraction_quality(kind: Column) -> Column:
    """CLS-06: the quality that goes with a completeness."""
    return F.when(kind == "FULL_TEXT", "HIGH").when(kind == "PARTIAL_TEXT", "MEDIUM").otherwise("LOW_CONFIDENCE")


def anonymization(parties: Column, source: str) -> Column:
    """CLS-07: court pages with parties are anonymized, the council's with initials, the review's never."""
    if source == "court":
        hidden = F.nullif(parties, F.lit("")).isNotNull()
    elif source == "council":
        hidden = F.contains(parties, F.lit("(")) | F.contains(parties, F.lit("."))
    else:
        hidden = F.lit(False)
    return F.when(hidden, "ANONYMIZED").otherwise("NOT_ANONYMIZED")


def filled(value: Column) -> Column:
    """Neither null nor empty."""
    return F.coalesce(F.length(value) > 0, F.lit(False))


def quality_class(number: Column, date: Column, subject: Column, text: Column, rest: list[Column]) -> Column:
    """CLS-08: C without the core or with a short text, A with all the rest, else B (D is never given)."""
    core = filled(number) & filled(date) & filled(subject) & (F.coalesce(F.length(text), F.lit(0)) > 100)
    every = F.lit(True)
    for value in rest:
        every = every & filled(value)
    return F.when(~core, "C").when(every, "A").otherwise("B")


def pdf_kind(content: Column) -> Column:
    """CLS-09: NATIVE, SCANNED or HYBRID by counts of fonts, images and pages in the bytes."""
    text = F.decode(content, "ISO-8859-1")
    pages = F.regexp_count(text, F.lit(r"/Type\s*/Page\b"))
    fonts = F.regexp_count(text, F.lit(r"/Type\s*/Font\b"))
    images = F.regexp_count(text, F.lit(r"/Subtype\s*/Image\b"))
    return F.when((fonts > 0) & (images <= pages), "NATIVE").when((images >= pages) & (fonts == 0), "SCANNED").otherwise("HYBRID")


def parser_status(number: Column, year: Column, page: Column) -> Column:
    """CLS-10: error without a number, ok with year and page (neither 0), else partial."""
    known = (F.coalesce(year, F.lit(0)) != 0) & (F.coalesce(page, F.lit(0)) != 0)
    return F.when(~filled(number), "error").when(known, "ok").otherwise("partial")


def pdf_valid(content: Column, size: Column, least: int) -> Column:
    """AUD-07: null for a PDF of at least ``least`` bytes, else what is wrong with it."""
    return (
        F.when(F.coalesce(F.substring(content, 1, 4) != F.lit(b"%PDF"), F.lit(True)), "magic")
        .when(size == 0, "empty")
        .when(size < least, "small")
    )
