"""Scalar functions over the corpus tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexmill.functions import classify as C
from lexmill.functions import dates as D
from lexmill.functions import extract as E
from lexmill.functions import text as T
from lexmill.functions.fixed import (
    ACTS_AR, ACTS_FR, ADVERSARY_INSIDE, ADVERSARY_START, ARABIC_MARKS, DISPOSITION_REVIEW, MONTHS_AR, MONTHS_COUNCIL, MONTHS_FR, ORGANISATIONS, REFERENCE_ARTICLE, REFERENCE_LABEL,
    REFERENCE_VISA, SUBJECT_AR, SUBJECT_FR,
)
from lexmill.functions.patterns import boundless, portable
from lexmill.plans import sqltext as S
from lexmill.plans.registry import Registry
from lexmill.sources.files import page_count
from lexmill.sources.tables import table

registry = Registry()
col = F.col


def language_of(column: str) -> Column:
    code = F.lower(column)
    return F.when(F.startswith(code, F.lit("ar")), "AR").when(F.startswith(code, F.lit("fr")), "FR")


def scalar(name: str, source: str, row_id: str, columns: Callable[[], dict[str, Column]], sql: dict[str, str] | None, where: str | None = None) -> None:
    """Register a projection of a whole table."""

    def run(spark: SparkSession, directory: str) -> DataFrame:
        rows = table(spark, directory, source)
        if where:
            rows = rows.filter(where)
        return rows.select(row_id, *[v.alias(k) for k, v in columns().items()])

    text = None
    if sql is not None:
        text = f"SELECT {row_id}, " + ", ".join(f"{v} AS {k}" for k, v in sql.items()) + f" FROM {source}" + (f" WHERE {where}" if where else "")
    registry.query(text, name)(run)


scalar("clean_text", "documents", "doc_id", lambda: {"clean": T.clean_text(col("full_text"))}, {"clean": S.clean("full_text")})
scalar("ligature_fold", "decisions", "id", lambda: {"folded": T.normalize_arabic(col("subject"), True)}, {"folded": S.clean(f"regexp_replace({S.ligatures('subject')}, '[{ARABIC_MARKS}]', '', 'g')")})
scalar("nfc_text", "decisions", "id", lambda: {"composed": T.nfc(col("subject"))}, {"composed": "nfc_normalize(subject)"})


@registry.query("SELECT id, nfc_normalize(subject) AS composed FROM decisions")
def registered_functions(spark: SparkSession, directory: str) -> DataFrame:
    """The functions registered for SQL, called from SQL."""
    T.register(spark)
    return table(spark, directory, "decisions").selectExpr("id", "lexmill_nfc(subject) AS composed")
_RUN = "[0-9]+(?:[.,:/-][0-9]+)*|[A-Za-z]+"
_BACK = "reverse(decision_number)"
scalar(
    "visual_to_logical", "revue_index", "id", lambda: {"logical": T.visual_to_logical(col("decision_number"))},
    {"logical": f"""CASE WHEN decision_number IS NULL THEN NULL ELSE array_to_string(list_transform(
        list_zip(regexp_split_to_array({_BACK}, '{_RUN}'), list_transform(regexp_extract_all({_BACK}, '{_RUN}'), lambda x: reverse(x))),
        lambda z: coalesce(z[1], '') || coalesce(z[2], '')), '') END"""},
)
scalar("guide_text", "revue_index", "id", lambda: {"logical": T.normalize_guide_text(col("raw_text"))}, None)
scalar("plain_digits", "documents", "doc_id", lambda: {"plain": T.plain_digits(col("text"))}, {"plain": "translate(text, '٠١٢٣٤٥٦٧٨٩', '0123456789')"})
_HEAD = "substring(full_text, 1, 3000)"
scalar(
    "detect_language", "documents", "doc_id", lambda: {"language_found": T.dominant_language(col("full_text"))},
    {"language_found": rf"""CASE WHEN length(regexp_replace({_HEAD}, '[^\x{{0600}}-\x{{06FF}}]', '', 'g')) > length(regexp_replace({_HEAD}, '[^a-zA-Z]', '', 'g')) THEN 'AR' ELSE 'FR' END"""},
)
scalar(
    "keywords_json", "decisions", "id", lambda: {"court": T.keywords_json(col("keywords"), True), "other": T.keywords_json(col("keywords"), False)},
    {"court": S.sqlite_keywords("keywords", r"[-–—,\n]+"), "other": S.sqlite_keywords("keywords", r"[-–—:\n]+")},
)
scalar("unreadable_font", "documents", "doc_id", lambda: {"needs_ocr": T.needs_ocr(col("text"))}, {"needs_ocr": r"length(regexp_replace(text, '[^\x{E000}-\x{F8FF}]', '', 'g')) > 100"})
scalar("label_prefix", "documents", "doc_id", lambda: {"label": T.label_of(col("text")), "value": T.without_label(col("text"))}, {"label": S.strip("split_part(text, ':', 1)"), "value": rf"regexp_replace(text, '\A[^:]+:[{S.STRIP}\n]*', '')"})
scalar("text_hash", "documents", "doc_id", lambda: {"hash": T.sha256(col("full_text"))}, {"hash": "sha256(full_text)"})

# dates and numbers
_FR, _AR = r"\b([0-9]{1,2})(?:er)?\s+([a-zéèûô]+)\s+([0-9]{4})(?:[^\p{L}\p{N}_]|$)", rf"(?:^|[^\p{{L}}\p{{N}}_])([0-9]{{1,2}})\s*({'|'.join(MONTHS_AR)})\s*(?:سنة\s+|عام\s+)?([0-9]{{4}})(?:[^\p{{L}}\p{{N}}_]|$)"


def _date_sql(x: str, pattern: str, months: dict[str, str], fold: bool, flags: str) -> str:
    name = f"regexp_extract({x}, {S.quoted(flags + pattern)}, 2)"
    name = f"translate(lower({name}), 'éèû', 'eeu')" if fold else name
    day = f"lpad(CAST(CAST({S.found(x, pattern, 1, flags)} AS INTEGER) AS VARCHAR), 2, '0')"
    return f"{S.found(x, pattern, 3, flags)} || '-' || {S.mapping(months)}[{name}] || '-' || {day}"


def french_arabic_date_sql(x: str, language: str) -> str:
    if language == "FR":
        return _date_sql(x, portable(_FR), MONTHS_FR, True, "(?i)")
    return _date_sql(f"translate({x}, '٠١٢٣٤٥٦٧٨٩', '0123456789')", portable(_AR), MONTHS_AR, False, "")


scalar("dates_fr", "documents", "doc_id", lambda: {"date_found": D.date_fr(col("title"))}, {"date_found": french_arabic_date_sql("title", "FR")})
scalar("dates_ar", "documents", "doc_id", lambda: {"date_found": D.date_ar(col("title"))}, {"date_found": french_arabic_date_sql("title", "AR")})


def _numeric_sql(x: str, between: str) -> str:
    a, b = rf"(\d{{4}})[{between}](\d{{1,2}})[{between}](\d{{1,2}})", rf"(\d{{1,2}})[{between}](\d{{1,2}})[{between}](\d{{4}})"

    def one(pattern: str, y: int, m: int, d: int) -> str:
        part = lambda g: S.found(x, pattern, g)
        fits = f"CAST({part(m)} AS INTEGER) BETWEEN 1 AND 12 AND CAST({part(d)} AS INTEGER) BETWEEN 1 AND 31"
        pad = lambda g: f"lpad(CAST(CAST({part(g)} AS INTEGER) AS VARCHAR), 2, '0')"
        return f"CASE WHEN {fits} THEN {part(y)} || '-' || {pad(m)} || '-' || {pad(d)} END"

    return f"coalesce({one(a, 1, 2, 3)}, {one(b, 3, 2, 1)})"


scalar("dates_numeric", "decisions", "id", lambda: {"iso": D.normalize_date(col("date"))}, {"iso": _numeric_sql("date", "-/.")})
_CN = rf"(\d{{1,2}})\s+({'|'.join(MONTHS_COUNCIL)})\s+(\d{{4}})"
scalar("dates_council", "documents", "doc_id", lambda: {"iso": D.council_date(col("title"))}, {"iso": f"coalesce({_date_sql(S.clean('title'), _CN, MONTHS_COUNCIL, False, '')}, {_numeric_sql(S.clean('title'), '/-')})"})
scalar("first_year", "decisions", "id", lambda: {"year_found": D.first_year(col("date"))}, {"year_found": S.found("date", r"\b(19\d\d|20\d\d)\b")})
scalar(
    "year_of_date", "revue_decisions", "id",
    lambda: {"court": D.year_of(col("date")), "review": D.year_of(col("date"), col("issue_year")), "council": D.year_of(col("date"), col("issue_year"), True)},
    {
        "court": "CASE WHEN length(date) >= 4 THEN TRY_CAST(substring(date, 1, 4) AS INTEGER) END",
        "review": r"coalesce(CASE WHEN regexp_matches(substring(date, 1, 4), '^\d{4}$') THEN CAST(substring(date, 1, 4) AS INTEGER) END, nullif(issue_year, 0))",
        "council": "CASE WHEN length(date) >= 4 THEN TRY_CAST(substring(date, 1, 4) AS INTEGER) ELSE nullif(issue_year, 0) END",
    },
)
def act_number_sql() -> str:
    """From columns ``document_number`` and ``year``."""
    kept = "translate(regexp_replace(document_number, '[^0-9–/-]', '', 'g'), '–/', '--')"
    first, second, suffix = f"string_split({kept}, '-')[1]", f"string_split({kept}, '-')[2]", "right(CAST(year AS VARCHAR), 2)"
    two = lambda p: f"{suffix} || '-' || {S.padded(f'TRY_CAST({p} AS INTEGER)', 2)}"
    return f"""CASE WHEN nullif(document_number, '') IS NULL THEN NULL WHEN len(string_split({kept}, '-')) <> 2 THEN {kept}
        WHEN {second} = {suffix} AND {first} <> {suffix} THEN coalesce({two(first)}, {first} || '-' || {second})
        WHEN {first} = {suffix} THEN coalesce({two(second)}, {first} || '-' || {second}) ELSE {first} || '-' || {second} END"""


scalar("act_number", "documents", "doc_id", lambda: {"number": D.act_number(col("document_number"), col("year"))}, {"number": act_number_sql()})
_NUM = r"\s*([0-9]{2,4}[-–/][0-9]{1,4}|[0-9]+)"


def heading_number_sql(x: str, language: str) -> str:
    return f"CASE WHEN {language} = 'AR' THEN {S.found(x, 'رقم' + _NUM)} ELSE {S.found(x, r'(?:^|[^\p{L}\p{N}_])n°?' + portable(_NUM), 1, '(?i)')} END"


scalar(
    "heading_number", "documents", "doc_id", lambda: {"number": D.heading_number(col("title"), language_of("language"))}, {"number": heading_number_sql("title", S.language("language"))}
)
scalar("decision_numbers", "revue_index", "id", lambda: {"number": D.decision_number(col("decision_number"))}, {"number": S.found(S.clean("decision_number"), r"(\d+)")})
scalar(
    "norm_number_variants", "decisions", "id", lambda: {"null_if_zero": D.bare_number(col("decision_number"), True), "zero": D.bare_number(col("decision_number"), False)},
    {"null_if_zero": f"nullif(ltrim({S.strip('decision_number')}, '0'), '')", "zero": "CASE WHEN decision_number IS NOT NULL THEN coalesce(nullif(ltrim(decision_number, '0'), ''), '0') END"},
)
scalar(
    "tolerant_ints", "revue_index", "id", lambda: {"number": D.tolerant_int(col("decision_number")), "first": D.year_before_dash(col("decision_number"))},
    {
        "number": "CASE WHEN regexp_matches(replace(decision_number, ' ', ''), '^[0-9]+$') THEN TRY_CAST(replace(decision_number, ' ', '') AS INTEGER) END",
        "first": f"""CASE WHEN regexp_matches({S.strip("split_part(decision_number, '-', 1)")}, '^[0-9]+$') THEN TRY_CAST({S.strip("split_part(decision_number, '-', 1)")} AS INTEGER) END""",
    },
)


# classes
def kinds_sql(part: int) -> str:
    """From columns ``t`` (heading) and ``l`` (language)."""

    def chain(rules: tuple, flags: str) -> str:
        whens = " ".join(f"WHEN regexp_matches(t, {S.quoted(flags + '^' + boundless(p))}) THEN '{(kind, slug)[part - 1]}'" for p, kind, slug in rules)
        return f"CASE {whens} ELSE '{('OTHER', 'act')[part - 1]}' END"

    return f"CASE WHEN l = 'AR' THEN {chain(ACTS_AR, '')} WHEN l = 'FR' THEN {chain(ACTS_FR, '(?i)')} END"


@registry.query(f"SELECT doc_id, {kinds_sql(1)} AS act_type, {kinds_sql(2)} AS act_slug FROM (SELECT doc_id, {S.strip('title')} AS t, {S.language('language')} AS l FROM documents WHERE title IS NOT NULL)")
def classify_prefix(spark: SparkSession, directory: str) -> DataFrame:
    rows = table(spark, directory, "documents").filter("title IS NOT NULL")
    return rows.select("doc_id", C.act_type(col("title"), language_of("language")).alias("act_type"), C.act_slug(col("title"), language_of("language")).alias("act_slug"))


def _subject_sql(verbs: tuple[str, ...], flags: str) -> str:
    pattern = flags + r"(?:^|[^\p{L}\p{N}_])(" + portable(f"(?:{'|'.join(verbs)})\\s+.+$") + ")"
    return f"regexp_extract(title, {S.quoted(pattern)}, 1)"


def subject_sql(language: str) -> str:
    """From column ``title``."""
    return f"nullif(rtrim({S.strip(f"CASE WHEN {language} = 'AR' THEN {_subject_sql(SUBJECT_AR, '')} ELSE {_subject_sql(SUBJECT_FR, '(?i)')} END")}, '.'), '')"


scalar("heading_subject", "documents", "doc_id", lambda: {"subject_found": C.heading_subject(col("title"), language_of("language"))}, {"subject_found": subject_sql(S.language("language"))})
scalar(
    "chamber_classes", "decisions", "id", lambda: {"css": C.taxonomy_class(F.concat(F.lit("post decision "), "chamber_class")), "group_label": C.chamber_of_class(col("chamber_class"))},
    {
        "css": "CASE WHEN regexp_matches(chamber_class, '^(civil-chambers|criminal-chambers|compensation-committee|significant-decisions|joint-chambers)(-[0-9]+)?$') THEN chamber_class END",
        "group_label": "CASE " + " ".join(f"WHEN starts_with(chamber_class, '{k}') THEN '{v}'" for k, v in C.CHAMBER_CLASSES.items()) + " END",
    },
)
scalar("node_types", "documents", "doc_id", lambda: {"node_type": C.node_type(F.concat_ws(" ", F.lit("node"), F.when(col("document_type") == "DECISION", "jurisprudence")))}, {"node_type": "CASE WHEN document_type = 'DECISION' THEN 'jurisprudence' END"})
scalar(
    "resource_types", "documents", "doc_id", lambda: {"kind": C.resource_type(F.coalesce(col("title"), F.lit("")))},
    {"kind": r"CASE WHEN contains(t, 'عدد خاص') OR contains(t, 'خص') THEN 'SPECIAL_ISSUE' WHEN regexp_matches(t, 'عدد[-\s]?\d{2}') AND contains(t, 'مجلة') THEN 'REVUE' WHEN contains(t, 'دليل') AND (contains(t, 'قرارات') OR contains(t, 'البحث')) THEN 'GUIDE' WHEN contains(t, 'دليل') THEN 'INDEX' ELSE 'OTHER' END".replace("(t,", "(coalesce(title, ''),")},
)
_LEN = "coalesce(length(full_text), 0)"
scalar(
    "completeness_quality", "documents", "doc_id",
    lambda: {"court": C.completeness(col("full_text"), "court"), "review": C.completeness(col("full_text"), "review"), "council": C.completeness(col("full_text"), "council"), "quality": C.extraction_quality(C.completeness(col("full_text"), "review"))},
    {
        "court": f"CASE WHEN length({S.strip('full_text')}) > 100 THEN 'FULL_TEXT' ELSE 'PARTIAL_TEXT' END",
        "review": f"CASE WHEN {_LEN} >= 1000 THEN 'FULL_TEXT' WHEN {_LEN} >= 200 THEN 'PARTIAL_TEXT' ELSE 'INDEX_ONLY' END",
        "council": f"CASE WHEN {_LEN} >= 1000 THEN 'FULL_TEXT' WHEN {_LEN} >= 300 THEN 'PARTIAL_TEXT' ELSE 'INDEX_ONLY' END",
        "quality": f"CASE WHEN {_LEN} >= 1000 THEN 'HIGH' WHEN {_LEN} >= 200 THEN 'MEDIUM' ELSE 'LOW_CONFIDENCE' END",
    },
)
scalar(
    "anonymization", "decisions", "id", lambda: {"court": C.anonymization(col("parties"), "court"), "council": C.anonymization(col("parties"), "council"), "review": C.anonymization(col("parties"), "review")},
    {
        "court": "CASE WHEN nullif(parties, '') IS NOT NULL THEN 'ANONYMIZED' ELSE 'NOT_ANONYMIZED' END",
        "council": "CASE WHEN contains(parties, '(') OR contains(parties, '.') THEN 'ANONYMIZED' ELSE 'NOT_ANONYMIZED' END",
        "review": "'NOT_ANONYMIZED'",
    },
)
_REST = ("chamber", "principle", "court_response", "disposition")


@registry.query(
    f"""SELECT class, count(*) AS n FROM (SELECT CASE
      WHEN NOT (coalesce(document_number, '') <> '' AND coalesce(date, '') <> '' AND coalesce(subject, '') <> '' AND {_LEN} > 100) THEN 'C'
      WHEN {' AND '.join(f"coalesce({c}, '') <> ''" for c in _REST)} THEN 'A' ELSE 'B' END AS class FROM documents) GROUP BY 1"""
)
def quality_class(spark: SparkSession, directory: str) -> DataFrame:
    made = C.quality_class(col("document_number"), col("date"), col("subject"), col("full_text"), [col(c) for c in _REST])
    return table(spark, directory, "documents").groupBy(made.alias("class")).agg(F.count("*").alias("n"))


scalar("parser_status", "revue_index", "id", lambda: {"status": C.parser_status(col("decision_number"), col("decision_year"), col("start_page"))}, {"status": "CASE WHEN coalesce(decision_number, '') = '' THEN 'error' WHEN coalesce(decision_year, 0) <> 0 AND coalesce(start_page, 0) <> 0 THEN 'ok' ELSE 'partial' END"})


# a file for every decision: its text, then as many fonts as years' last digit says, and an image where there is a disposition
_FILE_SQL = "CASE WHEN text IS NULL THEN '' WHEN length(text) % 5 = 0 THEN 'x' ELSE '%PDF-1.4 /Type /Page ' END || CASE WHEN length(text) % 2 = 0 THEN '/Type /Font ' ELSE '' END || repeat('/Subtype /Image ', CAST(coalesce(length(text) % 3, 0) AS INTEGER)) || repeat(' ', CAST(coalesce(length(text) % 90, 0) AS INTEGER))"


@registry.query(f"""WITH f AS (SELECT id, {_FILE_SQL} AS content FROM decisions), n AS (SELECT id, content, len(regexp_extract_all(content, '/Type\\s*/Page\\b')) AS pages,
  len(regexp_extract_all(content, '/Type\\s*/Font\\b')) AS fonts, len(regexp_extract_all(content, '/Subtype\\s*/Image\\b')) AS images FROM f)
SELECT id, CASE WHEN fonts > 0 AND images <= pages THEN 'NATIVE' WHEN images >= pages AND fonts = 0 THEN 'SCANNED' ELSE 'HYBRID' END AS kind,
  CASE WHEN substring(content, 1, 4) <> '%PDF' THEN 'magic' WHEN length(content) = 0 THEN 'empty' WHEN length(content) < 100 THEN 'small' END AS problem, CAST(pages AS INTEGER) AS n_pages FROM n""")
def pdf_checks(spark: SparkSession, directory: str) -> DataFrame:
    """Files rendered from all decisions, of all kinds and sizes."""
    size = F.coalesce(F.length("text"), F.lit(0))
    start = F.when(col("text").isNull(), "").when(size % 5 == 0, "x").otherwise("%PDF-1.4 /Type /Page ")
    fonts = F.when(col("text").isNotNull() & (size % 2 == 0), "/Type /Font ").otherwise("")
    content = F.encode(F.concat(start, fonts, F.repeat(F.lit("/Subtype /Image "), size % 3), F.repeat(F.lit(" "), size % 90)), "UTF-8")
    files = table(spark, directory, "decisions").select("id", content.alias("content"))
    return files.select("id", C.pdf_kind(col("content")).alias("kind"), C.pdf_valid(col("content"), F.octet_length("content"), 100).alias("problem"), page_count(col("content")).alias("n_pages"))


# extraction
scalar(
    "dispositions", "documents", "doc_id", lambda: {"disposition_found": E.disposition(T.clean_text(col("full_text")), "review")},
    {"disposition_found": S.clean(f"nullif(regexp_extract({S.clean('full_text')}, {S.quoted(portable(DISPOSITION_REVIEW))}, 0), '')")},
)
def _any_sql(x: str, words: tuple[str, ...], test: str) -> str:
    return "(" + " OR ".join(f"{test}({x}, {S.quoted(w)})" for w in words) + ")"


_LINES = f"list_filter(list_transform(string_split(substring(full_text, 1, 2500), chr(10)), lambda x: {S.strip('x')}), lambda x: x <> '' AND NOT starts_with(x, '#') AND NOT starts_with(x, '!['))"
_ADVERSARY = f"({_any_sql('x[1]', ADVERSARY_INSIDE, 'contains')} OR {_any_sql('x[1]', ADVERSARY_START, 'starts_with')})"
_STEP = f"CASE WHEN {_ADVERSARY} OR ({_any_sql('x[1]', ORGANISATIONS, 'contains')} AND len(a) BETWEEN 1 AND 3) THEN list_concat(a, x) ELSE a END"
_SEEN = f"list_reduce(list_transform({_LINES}, lambda x: [x]), lambda a, x: {_STEP}, CAST([] AS VARCHAR[]))"
scalar("parties_found", "documents", "doc_id", lambda: {"parties": E.parties(col("full_text"))}, {"parties": S.clean(f"nullif(array_to_string(({_SEEN})[1:3], ' | '), '')")}, "full_text IS NOT NULL")


def _every_sql(x: str, pattern: str) -> str:
    return f"list_filter(list_transform(regexp_extract_all({x}, {S.quoted(portable(pattern))}, 1), lambda v: {S.clean('v')}), lambda v: v IS NOT NULL)"


_REFS = f"list_concat(list_concat({_every_sql('t', REFERENCE_LABEL)}, {_every_sql('substring(t, 1, 3000)', REFERENCE_VISA)}), {_every_sql('t', REFERENCE_ARTICLE)})"


@registry.query(f"""SELECT doc_id, nullif(array_to_string(list_filter(r, lambda x, i: list_position(r, x) = i)[1:8], ' | '), '') AS refs
FROM (SELECT doc_id, {_REFS} AS r FROM (SELECT doc_id, full_text AS t FROM documents WHERE full_text IS NOT NULL))""")
def legal_references(spark: SparkSession, directory: str) -> DataFrame:
    rows = table(spark, directory, "documents").filter("full_text IS NOT NULL")
    return rows.select("doc_id", E.legal_references(col("full_text")).alias("refs"))


scalar(
    "canonical_urls", "decisions", "id", lambda: {"url": E.canonical_url(F.concat(col("source_url"), F.lit("?x=1#top")), "https://court.example.invalid/"), "is_decision": E.canonical_url(col("source_url"), "https://court.example.invalid/").rlike(r"/decision/[^/]+/?$")},
    {"url": "CASE WHEN ends_with(source_url, '/') THEN source_url ELSE source_url || '/' END", "is_decision": "regexp_matches(source_url, '/decision/[^/]+/?$')"},
)
scalar(
    "file_names", "decisions", "id",
    lambda: {"archive": E.archive_name(col("source_url")), "attachment": E.attachment_name(col("id"), F.concat(col("source_url"), F.lit("a.pdf?v=2"))), "slug": E.url_slug(col("source_url"))},
    {
        "archive": "substring(sha256(source_url), 1, 16) || '.html'",
        "attachment": "'nid_' || CAST(id AS VARCHAR) || '_' || regexp_extract(source_url || 'a.pdf', '[^/]+$', 0)",
        "slug": r"coalesce(nullif(substring(regexp_replace(replace(trim(regexp_extract(source_url, '^[a-z]+://[^/]*([^?#]*)', 1), '/'), '/', '_'), '[^\p{L}\p{N}_.-]', '_', 'g'), 1, 120), ''), 'root')",
    },
)
_KIND = "CASE WHEN id % 2 = 0 THEN 'REVUE' ELSE 'INDEX' END"
scalar(
    "logical_names", "revue_decisions", "id", lambda: {"name": E.logical_name(F.expr(_KIND), col("issue_year"), col("issue_number"), col("decision_number"), F.concat(F.lit("https://x.invalid/a/"), F.coalesce("decision_number", F.lit("")), F.lit(".pdf")))},
    {"name": f"CASE WHEN {_KIND} = 'REVUE' THEN 'revue' ELSE 'index' END || '_' || CASE WHEN coalesce(issue_year, 0) <> 0 AND coalesce(issue_number, 0) <> 0 THEN issue_year || '_' || {S.padded('issue_number', 2)} WHEN coalesce(issue_year, 0) <> 0 THEN issue_year || '_' || substring(sha256(decision_number), 1, 8) ELSE substring(coalesce(decision_number, ''), 1, 40) || '_' || substring(sha256(decision_number), 1, 8) END || '.pdf'"},
)
