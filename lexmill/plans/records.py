"""Acts, articles, decisions and their identity."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexmill.functions.extract import COUNCIL_RECORD, COURT_RECORD, council_page, court_page, decision_urls, last_page, link_kind, pdf_links
from lexmill.functions.fixed import ARTICLE_AR, ARTICLE_FR, CONTENTS_LINE, ERRATUM, SIGNATURE_AR, SIGNATURE_FR
from lexmill.functions.patterns import SPACE, portable
from lexmill.operators.courts import council_documents, court_documents, next_start, page_range_text, review_documents
from lexmill.operators.gazette import HEADING, PREAMBLE, act_documents, acts, articles, bilingual_pairs
from lexmill.operators.identity import court_base, with_suffix
from lexmill.plans import sqltext as S
from lexmill.plans.registry import Registry
from lexmill.plans.texts import act_number_sql, french_arabic_date_sql, heading_number_sql, kinds_sql, language_of, subject_sql
from lexmill.sources.tables import table

registry = Registry()

# staging scans: every column, by id
STAGED = {"scan_decisions": "decisions", "scan_review": "revue_decisions", "scan_review_texts": "revue_decision_texts"}
for _name, _table in STAGED.items():

    def _scan(spark: SparkSession, directory: str, source: str = _table) -> DataFrame:
        rows = table(spark, directory, source).drop("extra_sections", "extra_metadata")
        return rows.orderBy("id")

    registry.query(f"SELECT * EXCLUDE (extra_sections, extra_metadata) FROM {_table} ORDER BY id" if _table == "decisions" else f"SELECT * FROM {_table} ORDER BY id", _name)(_scan)

COURT_BASE = f"'cs_decision_' || {S.slug('decision_number', 'sans_numero')} || '_' || {S.slug('date', 'sans_date', False)} || '_ar'"
_HASH = "coalesce(nullif(content_hash, ''), sha256(coalesce(text, '')))"


@registry.query(f"""SELECT id, CASE WHEN count(*) OVER (PARTITION BY base) > 1 THEN base || '_' || substring(h, 1, 8) ELSE base END AS canonical_id
FROM (SELECT id, {COURT_BASE} AS base, {_HASH} AS h FROM decisions)""")
def canonical_ids(spark: SparkSession, directory: str) -> DataFrame:
    rows = table(spark, directory, "decisions").withColumn("base", court_base(F.col("decision_number"), F.col("date")))
    digest = F.coalesce(F.nullif("content_hash", F.lit("")), F.sha2(F.coalesce("text", F.lit("")), 256))
    return with_suffix(rows, "base", F.substring(digest, 1, 8)).select("id", "canonical_id")


@registry.query(f"""SELECT id, 'قرار المحكمة العليا رقم ' || coalesce(decision_number, 'None') || ' بتاريخ ' || coalesce(date, 'None') AS title,
  CASE WHEN length(date) >= 4 THEN TRY_CAST(substring(date, 1, 4) AS INTEGER) END AS year, {S.sqlite_keywords('keywords', r'[-–—,\n]+')} AS keywords,
  CASE WHEN length({S.strip("coalesce(text, '')")}) > 100 THEN 'FULL_TEXT' ELSE 'PARTIAL_TEXT' END AS text_completeness, {_HASH} AS canonical_hash,
  CASE WHEN nullif(parties, '') IS NOT NULL THEN 'ANONYMIZED' ELSE 'NOT_ANONYMIZED' END AS anonymization_status, raw_path
FROM decisions""")
def court_records(spark: SparkSession, directory: str) -> DataFrame:
    rows = court_documents(table(spark, directory, "decisions"))
    return rows.select(F.col("provenance.source_id").alias("id"), "title", "year", "keywords", "text_completeness", "canonical_hash", "anonymization_status", "provenance.raw_path")


_Y, _N = "coalesce(issue_year, 0)", "coalesce(issue_number, 0)"
_RBASE = f"'cs_revue_' || {S.slug(f'nullif({_Y}, 0)', '0000')} || '_' || {S.padded(_N, 2)} || '_' || {S.slug('decision_number', 'sans_numero')} || '_ar'"


@registry.query(f"""WITH t AS (SELECT r.*, coalesce({S.clean("coalesce(x.full_text, '')")}, '') AS clean FROM revue_decisions r LEFT JOIN revue_decision_texts x ON x.decision_id = r.id),
b AS (SELECT *, {_RBASE} AS base, sha256(clean) AS h FROM t)
SELECT id, CASE WHEN count(*) OVER (PARTITION BY base) > 1 THEN base || '_' || substring(h, 1, 8) || '_id' || id ELSE base END AS canonical_id,
  coalesce(nullif(chamber, ''), chamber_raw) AS chamber, {_Y} || '/' || {S.padded(_N, 2)} AS publication_number,
  CASE WHEN length(clean) >= 1000 THEN 'FULL_TEXT' WHEN length(clean) >= 200 THEN 'PARTIAL_TEXT' ELSE 'INDEX_ONLY' END AS text_completeness, h AS canonical_hash
FROM b""")
def review_records(spark: SparkSession, directory: str) -> DataFrame:
    rows = review_documents(table(spark, directory, "revue_decisions"), table(spark, directory, "revue_decision_texts"))
    return rows.select(F.col("provenance.source_id").alias("id"), "canonical_id", "chamber", "publication_number", "text_completeness", "canonical_hash")


_CBASE = f"'cde_decision_' || {S.slug('document_number', 'sans_numero')} || '_' || {S.slug('date', 'sans_date')} || '_ar'"


@registry.query(f"""WITH t AS (SELECT *, coalesce({S.clean("coalesce(full_text, '')")}, '') AS clean FROM documents WHERE source = 'conseildetat_html'),
b AS (SELECT *, {_CBASE} AS base, sha256(clean) AS h FROM t)
SELECT doc_id AS id, CASE WHEN count(*) OVER (PARTITION BY base) = 1 THEN base WHEN count(*) OVER (PARTITION BY base, canonical_hash) > 1
  THEN base || '_' || substring(h, 1, 8) || '_nid' || doc_id ELSE base || '_' || substring(h, 1, 8) END AS canonical_id,
  'قرار مجلس الدولة رقم ' || coalesce(document_number, 'None') || ' بتاريخ ' || coalesce(date, 'None') AS title,
  CASE WHEN length(date) >= 4 THEN TRY_CAST(substring(date, 1, 4) AS INTEGER) ELSE nullif(year, 0) END AS year,
  CASE WHEN length(clean) >= 1000 THEN 'HIGH' WHEN length(clean) >= 300 THEN 'MEDIUM' ELSE 'LOW_CONFIDENCE' END AS extraction_quality
FROM b""")
def council_records(spark: SparkSession, directory: str) -> DataFrame:
    documents = table(spark, directory, "documents").filter("source = 'conseildetat_html'")
    staged = documents.select(
        F.col("doc_id").alias("id"), F.col("doc_id").alias("nid"), F.lit("jurisprudence").alias("node_type"), F.col("document_number").alias("decision_number"),
        "date", F.col("year").cast("string").alias("year"), "chamber", "section", "keywords", "subject", "principle", F.col("canonical_hash").alias("pdf_hash"),
        F.lit(None).cast("string").alias("source_url"), F.lit(None).cast("string").alias("raw_path"),
    )
    ocr = documents.select(F.col("doc_id").alias("nid"), F.col("full_text").alias("text"), F.lit("ocr").alias("path"))
    rows = council_documents(staged, ocr)
    return rows.select(F.col("provenance.source_id").alias("id"), "canonical_id", "title", "year", "extraction_quality")


# gazette
_GAZETTE = "source IN ('joradp_fr', 'joradp_ar')"


def _issues(spark: SparkSession, directory: str) -> DataFrame:
    """Each gazette document as an issue of its own: its title, then its text."""
    rows = table(spark, directory, "documents").filter(_GAZETTE).filter("full_text IS NOT NULL")
    return rows.select(F.col("year"), F.col("doc_id").cast("string").alias("issue"), language_of("language").alias("language"), F.concat_ws("\n", "title", "full_text").alias("text"))


def _acts_sql() -> str:
    """Headings, spans, exact repeats and ordinals in SQL; one language at a time."""

    def one(language: str) -> str:
        heading, preamble = (S.quoted(x.replace("(?iu)", "(?i)")) for x in (HEADING[language], PREAMBLE[language]))
        text = "translate(t, '٠١٢٣٤٥٦٧٨٩', '0123456789')" if language == "AR" else "t"
        return f"""SELECT * FROM (WITH i AS (SELECT doc_id, year, l, {text} AS text FROM issues WHERE l = '{language}'),
  m AS (SELECT doc_id, year, l, text, string_split(regexp_replace(text, {heading}, chr(1) || '\\0', 'g'), chr(1)) AS pieces FROM i),
  e AS (SELECT doc_id, year, l, text, generate_subscripts(pieces, 1) AS k, unnest(pieces) AS piece FROM m),
  s AS (SELECT *, sum(length(piece)) OVER (PARTITION BY doc_id ORDER BY k) - length(piece) AS start FROM e),
  c AS (SELECT doc_id, year, l, text, start, length(regexp_extract(piece, {heading}, 0)) AS size, rtrim(rtrim({S.strip(f'regexp_extract(piece, {heading}, 1)')}, '*'), '.') AS heading FROM s WHERE k > 1),
  f AS (SELECT *, regexp_matches(substring(text, CAST(start + size + 1 AS BIGINT), 1200), {preamble}) AS valid FROM c
    WHERE NOT regexp_matches(heading, {S.quoted(portable(CONTENTS_LINE))})
    AND NOT regexp_matches(lower({S.strip('substring(text, CAST(greatest(start - 60, 0) + 1 AS BIGINT), CAST(least(start, 60) AS BIGINT))')}), {S.quoted(portable(ERRATUM))})),
  v AS (SELECT *, bool_or(valid) OVER (PARTITION BY doc_id) AS has_some FROM f),
  a AS (SELECT doc_id, year, l, text, start, heading, coalesce(lead(start) OVER (PARTITION BY doc_id ORDER BY start), length(text)) AS stop FROM v WHERE valid OR NOT has_some),
  g AS (SELECT doc_id, year, l, start, heading, {S.strip('substring(text, CAST(start + 1 AS BIGINT), CAST(stop - start AS BIGINT))')} AS full_text FROM a),
  h AS (SELECT *, sha256(full_text) AS content_hash FROM g),
  d AS (SELECT *, row_number() OVER (PARTITION BY doc_id, heading, content_hash ORDER BY start) AS n FROM h)
  SELECT doc_id, year, l, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY start) AS INTEGER) AS ordinal, heading, full_text, content_hash FROM d WHERE n = 1)"""

    return f"""WITH issues AS (SELECT doc_id, year, {S.language('language')} AS l, concat_ws(chr(10), title, full_text) AS t FROM documents WHERE {_GAZETTE} AND full_text IS NOT NULL)
{one('FR')} UNION ALL {one('AR')}"""


def _act_rows_sql() -> str:
    """The rows of acts: number, date, subject, and the id with its suffix where bases collide."""
    date = lambda x: f"CASE WHEN l = 'AR' THEN {french_arabic_date_sql(x, 'AR')} ELSE {french_arabic_date_sql(x, 'FR')} END"
    return f"""WITH a AS ({_acts_sql()}),
n AS (SELECT *, heading AS title, {S.strip('heading')} AS t, {heading_number_sql('heading', 'l')} AS raw_number FROM a),
k AS (SELECT *, raw_number AS document_number, {kinds_sql(1)} AS document_type, {kinds_sql(2)} AS type_slug, coalesce({date('heading')}, {date('substring(full_text, 1, 500)')}) AS date,
  {subject_sql('l')} AS subject FROM n),
m AS (SELECT *, {act_number_sql()} AS number FROM k),
b AS (SELECT *, concat_ws('_', 'joradp', CAST(year AS VARCHAR), {S.padded('doc_id', 3)}, type_slug,
  CASE WHEN nullif(number, '') IS NOT NULL THEN lower(regexp_replace(number, '[^a-zA-Z0-9-]', '', 'g')) ELSE 'ord' || ordinal END, lower(l)) AS base FROM m)
SELECT CASE WHEN count(*) OVER (PARTITION BY doc_id, base) > 1 THEN base || '_' || substring(content_hash, 1, 8) ELSE base END AS canonical_id, document_type,
  'LEGISLATIVE_NORM' AS document_nature, 'REPUBLIC' AS jurisdiction, 'LEGISLATIVE' AS court_level, heading AS title, coalesce(nullif(number, ''), raw_number) AS document_number,
  'JO ' || CAST(year AS VARCHAR) || '-' || {S.padded('doc_id', 3)} AS publication_number, date, year, l AS language, subject, full_text, 'markdown' AS text_format,
  'FULL_TEXT' AS text_completeness, 'MARKDOWN_PARSE' AS extraction_method, 'HIGH' AS extraction_quality, content_hash AS canonical_hash, 'NOT_ANONYMIZED' AS anonymization_status FROM b"""


@registry.query(_act_rows_sql())
def gazette_acts(spark: SparkSession, directory: str) -> DataFrame:
    return act_documents(acts(_issues(spark, directory)))


@registry.query(f"SELECT doc_id, ordinal, heading, content_hash FROM ({_acts_sql()})")
def act_segments(spark: SparkSession, directory: str) -> DataFrame:
    return acts(_issues(spark, directory)).select(F.col("issue").cast("long").alias("doc_id"), "ordinal", "heading", "content_hash")


def _marked_sql(language: str) -> str:
    article, flags = (ARTICLE_AR, "") if language == "AR" else (ARTICLE_FR, "(?i)")
    pattern = portable(rf"{flags}(?:^|\n)(?:#+\s*|\*\*)?{article}")
    return f"regexp_replace(full_text, {S.quoted(pattern)}, chr(1) || '\\1' || chr(2), 'g')"


def _signed_sql(language: str, x: str) -> str:
    pattern = portable((SIGNATURE_AR if language == "AR" else SIGNATURE_FR) + r"[\s\S]*")
    return f"regexp_replace({x}, {S.quoted(pattern)}, '')"


_L = S.language("language")
_CUT = f"CASE WHEN i = n AND l = 'AR' THEN {_signed_sql('AR', 'body')} WHEN i = n THEN {_signed_sql('FR', 'body')} ELSE body END"


@registry.query(f"""WITH p AS (SELECT canonical_id, l, string_split(CASE WHEN l = 'AR' THEN {_marked_sql('AR')} ELSE {_marked_sql('FR')} END, chr(1)) AS pieces
  FROM (SELECT canonical_id, full_text, {_L} AS l FROM documents WHERE {_GAZETTE} AND full_text IS NOT NULL)),
e AS (SELECT canonical_id, l, len(pieces) - 1 AS n, unnest(range(1, len(pieces))) AS i, unnest(pieces[2:]) AS piece FROM p),
s AS (SELECT *, split_part(piece, chr(2), 1) AS number, substring(piece, length(split_part(piece, chr(2), 1)) + 2) AS body FROM e)
SELECT canonical_id AS parent_document_id, CAST(i AS INTEGER) AS ordinal, CASE WHEN lower({S.strip('number')}) = 'premier' THEN '1er' ELSE {S.strip('number')} END AS article_number,
  {S.strip(f'''regexp_replace({S.strip(_CUT)}, '^[{SPACE}—*:-]+', '')''')} AS text FROM s""")
def articles_ordered(spark: SparkSession, directory: str) -> DataFrame:
    rows = table(spark, directory, "documents").filter(_GAZETTE).filter("full_text IS NOT NULL")
    rows = rows.select("canonical_id", language_of("language").alias("language"), "full_text")
    return articles(rows, "canonical_id").select("parent_document_id", "ordinal", "article_number", "text")


_NUMBERED = f"""SELECT doc_id, canonical_id, substring(publication_number, 3) AS p, document_type AS t, document_number AS n, {_L} AS l FROM documents
  WHERE publication_number IS NOT NULL AND nullif(document_number, '') IS NOT NULL"""


@registry.query(f"""WITH o AS ({_NUMBERED}), d AS (SELECT * FROM o UNION ALL SELECT doc_id + 1000000000, canonical_id || '_tr', p, t, n, CASE WHEN l = 'AR' THEN 'FR' WHEN l = 'FR' THEN 'AR' END FROM o),
ar AS (SELECT p, t, n, arg_max(canonical_id, doc_id) AS ar_id FROM d WHERE l = 'AR' GROUP BY ALL),
m AS (SELECT d.canonical_id AS fr_id, d.doc_id, ar.ar_id FROM d JOIN ar USING (p, t, n) WHERE d.l = 'FR')
SELECT fr_id AS canonical_id, ar_id AS language_pair_id FROM m UNION ALL SELECT ar_id, arg_max(fr_id, doc_id) FROM m GROUP BY ar_id""")
def bilingual(spark: SparkSession, directory: str) -> DataFrame:
    """Numbered documents with a translation rendered for each, since the corpus numbers none alike in both languages."""
    rows = table(spark, directory, "documents").filter("publication_number IS NOT NULL")
    issue = F.substring("publication_number", 3, 100)
    rows = rows.select("doc_id", "canonical_id", issue.alias("issue"), "document_type", "document_number", language_of("language").alias("language"))
    other = F.when(F.col("language") == "AR", "FR").when(F.col("language") == "FR", "AR")
    translated = rows.select((F.col("doc_id") + 1_000_000_000).alias("doc_id"), F.concat("canonical_id", F.lit("_tr")).alias("canonical_id"), "issue", "document_type", "document_number", other.alias("language"))
    return bilingual_pairs(rows.unionByName(translated), ["issue"], "doc_id")


# pages
def pages(spark: SparkSession, directory: str) -> DataFrame:
    """Stored texts as pages of their issue: issue_year, issue_number, page_no, text; the lowest id of a page wins."""
    texts = table(spark, directory, "revue_decision_texts").select(F.col("decision_id").alias("id"), F.col("pdf_start_page").alias("page_no"), F.col("full_text").alias("text"), F.col("id").alias("tid"))
    issues = table(spark, directory, "revue_decisions").select("id", "issue_year", "issue_number")
    rows = texts.join(issues, "id").filter("text IS NOT NULL AND page_no IS NOT NULL AND issue_year IS NOT NULL AND issue_number IS NOT NULL")
    return rows.groupBy("issue_year", "issue_number", "page_no").agg(F.min_by("text", "tid").alias("text"))


PAGES_SQL = """pages AS (SELECT issue_year, issue_number, x.pdf_start_page AS page_no, arg_min(x.full_text, x.id) AS text FROM revue_decision_texts x
  JOIN revue_decisions r ON r.id = x.decision_id WHERE x.full_text IS NOT NULL AND x.pdf_start_page IS NOT NULL AND issue_year IS NOT NULL AND issue_number IS NOT NULL GROUP BY ALL)"""


@registry.query("""SELECT id, (SELECT min(o.pdf_start_page) FROM revue_decisions o WHERE o.issue_year IS NOT DISTINCT FROM r.issue_year
  AND o.issue_number IS NOT DISTINCT FROM r.issue_number AND o.pdf_start_page > r.pdf_start_page) AS next_page FROM revue_decisions r WHERE pdf_start_page IS NOT NULL""")
def next_start_page(spark: SparkSession, directory: str) -> DataFrame:
    rows = table(spark, directory, "revue_decisions").filter("pdf_start_page IS NOT NULL")
    return next_start(rows, ["issue_year", "issue_number"], "pdf_start_page").select("id", "next_page")


@registry.query(f"""WITH {PAGES_SQL}, r AS (SELECT id, issue_year, issue_number, pdf_start_page AS a, pdf_start_page + 3 AS b FROM revue_decisions WHERE pdf_start_page IS NOT NULL)
SELECT r.id, string_agg(p.text, chr(10) || chr(10) ORDER BY p.page_no) AS text FROM r JOIN pages p ON p.issue_year = r.issue_year AND p.issue_number = r.issue_number AND p.page_no BETWEEN r.a AND r.b GROUP BY r.id""")
def page_range(spark: SparkSession, directory: str) -> DataFrame:
    rows = table(spark, directory, "revue_decisions").filter("pdf_start_page IS NOT NULL")
    ranges = rows.select("id", "issue_year", "issue_number", F.col("pdf_start_page").alias("first_page"), (F.col("pdf_start_page") + 3).alias("last_page"))
    return page_range_text(ranges, pages(spark, directory), ["issue_year", "issue_number"], "id")


# HTML: pages rendered from the decisions table, so that what is read back is known
def _court_html(rows: DataFrame) -> DataFrame:
    item = lambda label, c: F.concat(F.lit(f"<li>{label}: "), F.coalesce(c, F.lit("")), F.lit("</li>"))
    html = F.concat(
        F.lit('<html><body><article id="p1" class="post decision '), F.coalesce("chamber_class", F.lit("x")), F.lit('"><div class="entry-content"><ul>'),
        item("رقم القرار", F.col("decision_number")), item("تاريخ القرار", F.col("date")), F.lit("<li><h5>المبدأ :</h5><p>"), F.coalesce("disposition", F.lit("")),
        F.lit('</p></li></ul></div></article><div class="pagination"><a class="page-numbers" href="?paged=7">7</a></div><a href="/decision/'),
        F.col("id").cast("string"), F.lit('?a=1">x</a><a href="/f/guide.pdf">دليل</a></body></html>'),
    )
    return rows.select("id", html.alias("html"))


_S = lambda x: f"nullif({S.clean(S.ligatures(x))}, '')"


@registry.query(f"""SELECT id, CASE WHEN regexp_matches(chamber_class, '^(civil-chambers|criminal-chambers|compensation-committee|significant-decisions|joint-chambers)(-[0-9]+)?$') THEN chamber_class END AS chamber_class,
  {_S("coalesce(decision_number, '')")} AS decision_number, {_S("coalesce(date, '')")} AS date, {_S("coalesce(disposition, '')")} AS principle FROM decisions""")
def html_records(spark: SparkSession, directory: str) -> DataFrame:
    rows = _court_html(table(spark, directory, "decisions")).select("id", court_page(F.col("html")).alias("r"))
    assert "principle" in COURT_RECORD.names and "pdf_url" in COUNCIL_RECORD.names
    return rows.select("id", "r.chamber_class", "r.decision_number", "r.date", "r.principle")


@registry.query("""SELECT id, 'https://court.example.invalid/decision/' || id || '/' AS url, 7 AS last_page, 'https://court.example.invalid/f/guide.pdf' AS pdf, 'pdf' AS kind FROM decisions""")
def html_links(spark: SparkSession, directory: str) -> DataFrame:
    rows, base = _court_html(table(spark, directory, "decisions")), "https://court.example.invalid/"
    html = F.col("html")
    return rows.select(
        "id", F.get(decision_urls(html, base), F.lit(0)).alias("url"), last_page(html).alias("last_page"), F.get(pdf_links(html, base), F.lit(0)).alias("pdf"),
        link_kind(F.lit("دليل"), F.lit("/f/guide.pdf")).alias("kind"),
    )


@registry.query("SELECT id, 'jurisprudence' AS node_type, " + _S("coalesce(decision_number, '')") + " AS decision_number, " + _S("coalesce(chamber, '')") + " AS chamber, '/a.pdf' AS pdf_url FROM decisions")
def council_html(spark: SparkSession, directory: str) -> DataFrame:
    box = lambda name, c: F.concat(F.lit(f'<div class="field field--name-{name}"><div class="field__label">x</div><div class="field__item">'), F.coalesce(c, F.lit("")), F.lit("</div></div>"))
    rows = table(spark, directory, "decisions")
    html = F.concat(F.lit('<article class="node jurisprudence">'), box("field-numm-arr", F.col("decision_number")), box("field-chamber-juris", F.col("chamber")), F.lit('<a href="/a.pdf">p</a></article>'))
    read = rows.select("id", council_page(html).alias("r")).select("id", "r.node_type", "r.decision_number", "r.chamber", "r.pdf_url")
    # a field without an item shows its label's rest, which is empty here
    return read
