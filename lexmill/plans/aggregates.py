"""Counts, rates, audits and set algebra over the corpus tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexmill.functions.fixed import CHAMBER_CLASSES
from lexmill.operators import audit as A
from lexmill.operators import reconcile as R
from lexmill.operators.identity import court_base, with_suffix
from lexmill.operators.report import as_json, as_markdown
from lexmill.plans.records import COURT_BASE, PAGES_SQL, pages
from lexmill.plans.records import registry as RECORDS
from lexmill.plans.registry import Registry
from lexmill.sources.tables import table

registry = Registry()
CORPUS = ("documents", "provenance", "articles", "relations")


def filled_sql(c: str) -> str:
    return f"(CAST({c} AS VARCHAR) IS NOT NULL AND CAST({c} AS VARCHAR) <> '')"


@registry.query(" UNION ALL ".join(f"SELECT '{t}' AS name, count(*) AS n FROM {t}" for t in CORPUS))
def table_counts(spark: SparkSession, directory: str) -> DataFrame:
    out = None
    for name in CORPUS:
        one = table(spark, directory, name).agg(F.count("*").alias("n")).select(F.lit(name).alias("name"), "n")
        out = one if out is None else out.unionByName(one)
    return out


for _source, _column in (("documents", "language"), ("documents", "source"), ("documents", "text_completeness"), ("documents", "document_type"), ("decisions", "status"), ("revue_index", "parser_status"), ("revue_decisions", "match_verdict")):

    def _count(spark: SparkSession, directory: str, source: str = _source, column: str = _column) -> DataFrame:
        return A.count_by(table(spark, directory, source), column)

    registry.query(f"SELECT {_column} AS value, count(*) AS n FROM {_source} GROUP BY 1", f"count_{_source}_by_{_column}")(_count)


@registry.query("SELECT canonical_hash, n, member FROM (SELECT canonical_hash, doc_id AS member, count(*) OVER (PARTITION BY canonical_hash) AS n FROM documents) WHERE n > 1")
def content_hash_dups(spark: SparkSession, directory: str) -> DataFrame:
    return A.duplicate_groups(table(spark, directory, "documents"), ["canonical_hash"], "doc_id")


@registry.query("SELECT decision_number, date, n, member FROM (SELECT decision_number, date, id AS member, count(*) OVER (PARTITION BY decision_number, date) AS n FROM decisions WHERE decision_number IS NOT NULL AND date IS NOT NULL) WHERE n > 1")
def number_date_dups(spark: SparkSession, directory: str) -> DataFrame:
    return A.duplicate_groups(table(spark, directory, "decisions").filter("decision_number IS NOT NULL AND date IS NOT NULL"), ["decision_number", "date"], "id")


@registry.query("SELECT count(*) AS n_groups FROM (SELECT 1 FROM articles GROUP BY parent_document_id, ordinal HAVING count(*) > 1)")
def dup_parent_ordinal(spark: SparkSession, directory: str) -> DataFrame:
    return A.duplicate_count(table(spark, directory, "articles"), ["parent_document_id", "ordinal"])


_FIELDS = ("decision_number", "date", "chamber", "subject", "parties", "keywords", "legal_references", "principle", "disposition", "text")


@registry.query(" UNION ALL ".join(f"SELECT '{c}' AS field, count(*) FILTER (NOT {filled_sql(c)}) AS n_missing, round_even(count(*) FILTER (NOT {filled_sql(c)}) / greatest(count(*), 1) * 100, 1) AS rate_pct FROM decisions" for c in _FIELDS))
def missing_rates(spark: SparkSession, directory: str) -> DataFrame:
    return A.missing_rates(table(spark, directory, "decisions"), list(_FIELDS))


@registry.query("""SELECT count(*) AS n, CAST(floor(coalesce(sum(l), 0) / greatest(count(*), 1)) AS BIGINT) AS mean_length, coalesce(min(l), 0) AS min_length, coalesce(max(l), 0) AS max_length,
  count(*) FILTER (l IS NULL OR l < 200) AS n_short FROM (SELECT nullif(length(text), 0) AS l FROM decisions)""")
def text_lengths(spark: SparkSession, directory: str) -> DataFrame:
    return A.length_summary(table(spark, directory, "decisions"), "text", 200)


_EXPECTED = {"title": 100, "date": 90, "keywords": 50}


@registry.query(" UNION ALL ".join(f"SELECT '{c}' AS field, count(*) FILTER ({filled_sql(c)} AND {c} <> '[]') AS present, {n} AS expected, CASE WHEN count(*) FILTER ({filled_sql(c)} AND {c} <> '[]') = {n} THEN 'CONFORME' ELSE 'ECART' END AS status FROM documents" for c, n in _EXPECTED.items()))
def field_presence(spark: SparkSession, directory: str) -> DataFrame:
    expected = spark.createDataFrame(list(_EXPECTED.items()), "field string, expected int")
    return A.presence(table(spark, directory, "documents"), list(_EXPECTED), expected)


_OK = "chamber IS NOT DISTINCT FROM chamber_raw"


@registry.query(f"""WITH c AS (SELECT count(*) FILTER ({_OK}) AS tp, 0 AS fp, count(*) FILTER (NOT ({_OK})) AS fn FROM revue_decisions)
SELECT *, CAST(1.0 AS DOUBLE) AS precision, tp / (tp + fn) AS recall, 2 * (tp / (tp + fn)) / (1 + tp / (tp + fn)) AS f1 FROM c""")
def gold_prf(spark: SparkSession, directory: str) -> DataFrame:
    checks = table(spark, directory, "revue_decisions").select(F.col("chamber").eqNullSafe(F.col("chamber_raw")).alias("ok"))
    return A.gold_scores(checks)


@registry.query(f"""WITH c AS (SELECT count(*) FILTER ({_OK}) AS tp, count(*) FILTER (NOT ({_OK}) AND chamber IS NOT NULL) AS fp, count(*) FILTER (NOT ({_OK})) AS fn FROM revue_decisions)
SELECT *, tp / (tp + fp) AS precision, tp / (tp + fn) AS recall, 2 * (tp / (tp + fp)) * (tp / (tp + fn)) / (tp / (tp + fp) + tp / (tp + fn)) AS f1 FROM c""")
def gold_true_prf(spark: SparkSession, directory: str) -> DataFrame:
    ok = F.col("chamber").eqNullSafe(F.col("chamber_raw"))
    checks = table(spark, directory, "revue_decisions").select(ok.alias("ok"), (~ok & F.col("chamber").isNotNull()).alias("extra"))
    return A.gold_scores(checks, F.col("extra"))


_KNOWN = ("decouvert", "telecharge", "valide", "erreur")


@registry.query("SELECT category, language, " + ", ".join(f"count(*) FILTER (status = '{s}') AS {s}" for s in _KNOWN) + " FROM decisions GROUP BY 1, 2")
def coverage_pivot(spark: SparkSession, directory: str) -> DataFrame:
    return A.coverage(table(spark, directory, "decisions"), ["category", "language"], "status", _KNOWN)


@registry.query("SELECT count(*) AS total, count(*) FILTER (status = 'telecharge') AS downloaded, count(*) FILTER (status = 'valide') AS validated, count(*) FILTER (status = 'erreur') AS errors FROM decisions")
def coverage_totals(spark: SparkSession, directory: str) -> DataFrame:
    has = lambda s: F.count_if(F.col("status") == s)
    return table(spark, directory, "decisions").agg(F.count("*").alias("total"), has("telecharge").alias("downloaded"), has("valide").alias("validated"), has("erreur").alias("errors"))


def _orphans_sql(child: str, key: str, parent: str = "documents", parent_key: str = "canonical_id") -> str:
    return f"(SELECT count(*) FROM {child} c WHERE NOT EXISTS (SELECT 1 FROM {parent} p WHERE p.{parent_key} = c.{key}))"


_CHECKS = {
    **{f"count_{t}": (f"(SELECT count(*) FROM {t})", False) for t in CORPUS},
    "ids_empty": ("(SELECT count(*) FROM documents WHERE coalesce(canonical_id, '') = '')", True),
    "ids_repeated": ("(SELECT count(*) - count(DISTINCT canonical_id) FROM documents)", True),
    "provenance_without_document": (_orphans_sql("provenance", "canonical_id"), True),
    "document_without_provenance": (_orphans_sql("documents", "canonical_id", "provenance"), True),
    "article_without_document": (_orphans_sql("articles", "parent_document_id"), True),
    "relation_without_target": (_orphans_sql("relations", "target_id"), True),
    "relation_without_source": (_orphans_sql("relations", "source_id"), True),
    "duplicate_article_positions": ("(SELECT count(*) FROM (SELECT 1 FROM articles GROUP BY parent_document_id, ordinal HAVING count(*) > 1))", True),
    "first_year": ("(SELECT min(year) FROM documents)", False),
    "last_year": ("(SELECT max(year) FROM documents)", False),
    "distinct_years": ("(SELECT count(DISTINCT year) FROM documents)", False),
}


@registry.query(" UNION ALL ".join(f"SELECT '{n}' AS name, CAST({q} AS BIGINT) AS value, {f'{q} = 0' if zero else 'true'} AS ok" for n, (q, zero) in _CHECKS.items()))
def audit_checks(spark: SparkSession, directory: str) -> DataFrame:
    return A.corpus_checks(*[table(spark, directory, t) for t in CORPUS])


@registry.query("SELECT id FROM provenance c WHERE NOT EXISTS (SELECT 1 FROM documents p WHERE p.canonical_id = c.canonical_id)")
def orphan_provenance(spark: SparkSession, directory: str) -> DataFrame:
    return A.child_without_parent(table(spark, directory, "provenance"), "canonical_id", table(spark, directory, "documents"), "canonical_id").select("id")


@registry.query(" UNION ALL ".join(f"SELECT '{t}.{k}' AS reference, {_orphans_sql(t, k)} AS n_violations" for t, k in (("articles", "parent_document_id"), ("relations", "source_id"), ("relations", "target_id"), ("provenance", "canonical_id"))))
def fk_check(spark: SparkSession, directory: str) -> DataFrame:
    references = (("articles", "parent_document_id"), ("relations", "source_id"), ("relations", "target_id"), ("provenance", "canonical_id"))
    children = {f"{name}.{key}": (table(spark, directory, name), key) for name, key in references}
    return A.orphan_counts(children, table(spark, directory, "documents"), "canonical_id")


@registry.query("""SELECT *, n_after >= n_before AND n_empty = 0 AS ok FROM (
  SELECT 'documents' AS name, (SELECT count(*) FROM documents WHERE canonical_id IN (SELECT canonical_id FROM provenance)) AS n_before, count(*) AS n_after,
    count(*) FILTER (coalesce(text, '') = '') AS n_empty FROM documents
  UNION ALL SELECT 'articles', (SELECT count(*) FROM articles WHERE parent_document_id IN (SELECT canonical_id FROM documents)), count(*), count(*) FILTER (coalesce(text, '') = '') FROM articles)""")
def load_regression(spark: SparkSession, directory: str) -> DataFrame:
    """Before a load: documents with provenance and articles with documents; after it: all of them."""
    documents, articles = table(spark, directory, "documents"), table(spark, directory, "articles")
    known = documents.join(table(spark, directory, "provenance").select("canonical_id"), "canonical_id", "left_semi")
    placed = articles.join(documents.select(F.col("canonical_id").alias("parent_document_id")), "parent_document_id", "left_semi")
    return A.regression({"documents": known, "articles": placed}, {"documents": documents, "articles": articles}, {"documents": "text", "articles": "text"})


_COURT = RECORDS.sql["canonical_ids"]


@registry.query(f"""WITH i AS ({_COURT}), b AS (SELECT id, {COURT_BASE} AS base FROM decisions), j AS (SELECT * FROM i JOIN b USING (id))
SELECT count(*) AS total, count(DISTINCT id) AS n_sources, count(DISTINCT canonical_id) AS n_ids, count(*) FILTER (base <> canonical_id) AS n_suffixed,
  count(DISTINCT canonical_id) = count(DISTINCT id) AS "unique", true AS as_expected FROM j""")
def court_report(spark: SparkSession, directory: str) -> DataFrame:
    rows = table(spark, directory, "decisions").withColumn("base", court_base(F.col("decision_number"), F.col("date")))
    digest = F.coalesce(F.nullif("content_hash", F.lit("")), F.sha2(F.coalesce("text", F.lit("")), 256))
    return A.court_report(with_suffix(rows, "base", F.substring(digest, 1, 8)).select("id", "base", "canonical_id"), "id", "base", "canonical_id")


def _repeated_sql(kind: str, columns: tuple[str, ...]) -> str:
    key = " || '|' || ".join(columns)
    return f"SELECT '{kind}' AS kind, {key} AS key FROM decisions WHERE {' AND '.join(map(filled_sql, columns))} GROUP BY {', '.join(columns)} HAVING count(*) > 1"


_RAW = "(SELECT raw_path, max(octet_length(encode(text))) AS bytes FROM decisions WHERE raw_path IS NOT NULL AND text IS NOT NULL GROUP BY 1)"
_CLASSES = tuple(CHAMBER_CLASSES)


@registry.query(" UNION ALL ".join([
    _repeated_sql("number_and_date_repeated", ("decision_number", "date")),
    f"SELECT 'unknown_chamber_class', source_url FROM decisions WHERE NOT coalesce(regexp_matches(chamber_class, '^({'|'.join(_CLASSES)})'), false)",
    f"SELECT 'no_number', source_url FROM decisions WHERE NOT {filled_sql('decision_number')}",
    f"SELECT 'no_date', source_url FROM decisions WHERE NOT {filled_sql('date')}",
    _repeated_sql("number_repeated", ("decision_number",)),
    _repeated_sql("content_repeated", ("content_hash",)),
    f"SELECT 'raw_missing', source_url FROM decisions d LEFT JOIN {_RAW} r USING (raw_path) WHERE r.bytes IS NULL",
    f"SELECT 'raw_empty', source_url FROM decisions d JOIN {_RAW} r USING (raw_path) WHERE r.bytes = 0",
    f"SELECT 'raw_small', source_url FROM decisions d JOIN {_RAW} r USING (raw_path) WHERE r.bytes > 0 AND r.bytes < 10000",
]))
def url_anomalies(spark: SparkSession, directory: str) -> DataFrame:
    """The text's size stands in for that of the archived page."""
    decisions = table(spark, directory, "decisions")
    sizes = decisions.filter("raw_path IS NOT NULL AND text IS NOT NULL").groupBy("raw_path").agg(F.max(F.octet_length("text")).alias("bytes"))
    return A.anomalies(decisions, sizes, 10_000, _CLASSES)


@registry.query("SELECT arg_min(doc_id, {a: coalesce(date, '9999'), b: doc_id}) AS earliest, arg_max(doc_id, {a: coalesce(date, '0000'), b: -doc_id}) AS latest FROM documents")
def date_extremes(spark: SparkSession, directory: str) -> DataFrame:
    return A.extremes(table(spark, directory, "documents"), "date", "doc_id")


@registry.query("SELECT arg_min(doc_id, {a: date, b: doc_id}) FILTER (date IS NOT NULL AND coalesce(disposition, '') <> '') AS first_id FROM documents")
def first_disposition(spark: SparkSession, directory: str) -> DataFrame:
    return A.first_where(table(spark, directory, "documents"), F.coalesce("disposition", F.lit("")) != "", "date", "doc_id")


@registry.query("""WITH s AS (SELECT DISTINCT issue_year, start_page FROM revue_index WHERE start_page IS NOT NULL AND issue_year IS NOT NULL),
n AS (SELECT *, lead(start_page) OVER (PARTITION BY issue_year ORDER BY start_page) AS nxt FROM s)
SELECT issue_year, CAST(unnest(range(start_page + 1, nxt)) AS INTEGER) AS missing FROM n WHERE nxt > start_page + 1""")
def sequence_gaps(spark: SparkSession, directory: str) -> DataFrame:
    return A.sequence_gaps(table(spark, directory, "revue_index").filter("issue_year IS NOT NULL"), "issue_year", "start_page")


@registry.query("""SELECT count(*) AS total, count(*) FILTER (parser_status = 'ok') AS ok, count(*) FILTER (parser_status = 'partial') AS partial, count(*) FILTER (parser_status = 'error') AS error,
  min(coalesce(decision_year, issue_year)) AS first_year, max(coalesce(decision_year, issue_year)) AS last_year FROM revue_index""")
def index_stats(spark: SparkSession, directory: str) -> DataFrame:
    year, status = F.coalesce("decision_year", "issue_year"), F.col("parser_status")
    counts = [F.count_if(status == s).alias(s) for s in ("ok", "partial", "error")]
    return table(spark, directory, "revue_index").agg(F.count("*").alias("total"), *counts, F.min(year).alias("first_year"), F.max(year).alias("last_year"))


@registry.query("""SELECT i.issue_year, i.issue_number, count(r.id) AS n_decisions, count(r.id) = 0 AS is_empty FROM (SELECT DISTINCT issue_year, issue_number FROM revue_index) i
LEFT JOIN revue_decisions r ON r.issue_year = i.issue_year AND r.issue_number = i.issue_number GROUP BY ALL""")
def issue_summary(spark: SparkSession, directory: str) -> DataFrame:
    issue = ["issue_year", "issue_number"]
    counted = table(spark, directory, "revue_decisions").groupBy(*issue).agg(F.count("*").alias("n"))
    n = F.coalesce("n", F.lit(0))
    return table(spark, directory, "revue_index").select(*issue).distinct().join(counted, issue, "left").select(*issue, n.alias("n_decisions"), (n == 0).alias("is_empty"))


@registry.query("SELECT source, document_type, chamber, year, count(*) AS n, round_even(count(*) FILTER (text_completeness = 'FULL_TEXT') / count(*) * 100, 1) AS full_pct FROM documents GROUP BY 1, 2, 3, 4")
def census(spark: SparkSession, directory: str) -> DataFrame:
    share = F.bround(F.count_if(F.col("text_completeness") == "FULL_TEXT") / F.count("*") * 100, 1)
    return table(spark, directory, "documents").groupBy("source", "document_type", "chamber", "year").agg(F.count("*").alias("n"), share.alias("full_pct"))


@registry.query("SELECT category, count(*) AS total, count(*) FILTER (status = 'telecharge') AS success, count(*) FILTER (status = 'erreur') AS failed FROM decisions GROUP BY 1")
def discovery_stats(spark: SparkSession, directory: str) -> DataFrame:
    has = lambda s: F.count_if(F.col("status") == s)
    return table(spark, directory, "decisions").groupBy("category").agg(F.count("*").alias("total"), has("telecharge").alias("success"), has("erreur").alias("failed"))


@registry.query(f"""WITH {PAGES_SQL}, p AS (SELECT issue_year, issue_number, count(*) AS n_ocr FROM pages GROUP BY ALL), t AS (SELECT issue_year, issue_number, max(pdf_start_page) AS n_pdf FROM revue_decisions GROUP BY ALL)
SELECT issue_year, issue_number, n_ocr, n_pdf, round_even(100 * n_ocr / n_pdf, 1) AS coverage_pct FROM p JOIN t USING (issue_year, issue_number)""")
def ocr_coverage(spark: SparkSession, directory: str) -> DataFrame:
    issue = ["issue_year", "issue_number"]
    read = pages(spark, directory).groupBy(*issue).agg(F.count("*").alias("n_ocr"))
    printed = table(spark, directory, "revue_decisions").groupBy(*issue).agg(F.max("pdf_start_page").alias("n_pdf"))
    return read.join(printed, issue).withColumn("coverage_pct", F.bround(100 * F.col("n_ocr") / F.col("n_pdf"), 1))


# set algebra
def _site(spark: SparkSession, directory: str) -> DataFrame:
    return table(spark, directory, "decisions").filter("category <> 'penal'").select(F.col("source_url").alias("url"))


def _stored(spark: SparkSession, directory: str) -> DataFrame:
    return table(spark, directory, "decisions").filter("status = 'telecharge'").select(F.col("source_url").alias("url"))


_SIDES = """WITH a AS (SELECT DISTINCT source_url AS url, true AS x FROM decisions WHERE category <> 'penal' AND source_url IS NOT NULL), b AS (SELECT DISTINCT source_url AS url, true AS y FROM decisions WHERE status = 'telecharge' AND source_url IS NOT NULL),
s AS (SELECT url, CASE WHEN y IS NULL THEN 'site_only' WHEN x IS NULL THEN 'stored_only' ELSE 'both' END AS side FROM a FULL JOIN b USING (url))"""


@registry.query(_SIDES + " SELECT url, side FROM s")
def url_reconciliation(spark: SparkSession, directory: str) -> DataFrame:
    return R.reconcile(_site(spark, directory), _stored(spark, directory))


@registry.query(_SIDES + """, c AS (SELECT count(*) FILTER (side = 'site_only') AS site_only, count(*) FILTER (side = 'stored_only') AS stored_only, count(*) FILTER (side = 'both') AS both FROM s)
SELECT *, CASE WHEN site_only = 0 AND stored_only = 0 THEN 'PASS' ELSE 'FAIL' END AS verdict FROM c""")
def url_verdict(spark: SparkSession, directory: str) -> DataFrame:
    return R.verdict(R.reconcile(_site(spark, directory), _stored(spark, directory)))


@registry.query("""WITH l AS (SELECT DISTINCT category, source_url AS url FROM decisions), k AS (SELECT DISTINCT source_url AS url, 1 AS here FROM decisions WHERE status = 'telecharge')
SELECT category, count(*) AS n_urls, count(here) AS n_stored, count(*) - count(here) AS n_missing FROM l LEFT JOIN k USING (url) GROUP BY 1""")
def category_coverage(spark: SparkSession, directory: str) -> DataFrame:
    listed = table(spark, directory, "decisions").select("category", F.col("source_url").alias("url"))
    return R.category_coverage(listed, _stored(spark, directory))


def _found(spark: SparkSession, directory: str) -> DataFrame:
    return table(spark, directory, "events").select((F.col("user_id")).cast("string").alias("url"), F.col("event_type").alias("method"))


@registry.query("SELECT CAST(user_id AS VARCHAR) AS url, array_to_string(list_sort(list(DISTINCT event_type)), ',') AS methods FROM events GROUP BY 1")
def discovery_methods(spark: SparkSession, directory: str) -> DataFrame:
    return R.discovery_methods(_found(spark, directory)).select("url", F.array_join("methods", ",").alias("methods"))


@registry.query("SELECT m AS method, count(*) AS n FROM (SELECT min(event_type) AS m FROM events GROUP BY user_id, CAST(ts AS DATE) HAVING count(DISTINCT event_type) = 1) GROUP BY 1")
def single_method(spark: SparkSession, directory: str) -> DataFrame:
    url = F.concat_ws("/", "user_id", F.to_date("ts").cast("string"))
    found = table(spark, directory, "events").select(url.alias("url"), F.col("event_type").alias("method"))
    return R.single_method(R.discovery_methods(found))


@registry.query("""SELECT pdf_url, n, url FROM (SELECT *, count(*) OVER (PARTITION BY pdf_url) AS n FROM (SELECT DISTINCT publication_number AS pdf_url, canonical_id AS url FROM documents WHERE publication_number IS NOT NULL)) WHERE n > 1""")
def shared_targets(spark: SparkSession, directory: str) -> DataFrame:
    rows = table(spark, directory, "documents").filter("publication_number IS NOT NULL")
    return R.shared_targets(rows.select(F.col("canonical_id").alias("url"), F.col("publication_number").alias("pdf_url")))


@registry.query("SELECT id, url FROM (SELECT id, source_url AS url, row_number() OVER (PARTITION BY source_url ORDER BY id) AS k FROM decisions) WHERE k = 1")
def first_by_url(spark: SparkSession, directory: str) -> DataFrame:
    return R.first_by_url(table(spark, directory, "decisions").select("id", F.col("source_url").alias("url")), "id")


@registry.query("SELECT DISTINCT issue_year, issue_number FROM revue_index ORDER BY 1, 2")
def issues_with_entries(spark: SparkSession, directory: str) -> DataFrame:
    return table(spark, directory, "revue_index").select("issue_year", "issue_number").distinct().orderBy("issue_year", "issue_number")


@registry.query("""SELECT '| ' || status || ' | ' || n || ' |' AS line, '{"status":"' || status || '","n":' || n || '}' AS json FROM (SELECT status, count(*) AS n FROM decisions GROUP BY 1)""")
def status_report(spark: SparkSession, directory: str) -> DataFrame:
    rows = table(spark, directory, "decisions").groupBy("status").agg(F.count("*").alias("n"))
    return as_markdown(rows).withColumn("status", F.split("line", r" \| ?")[0]).join(as_json(rows).withColumn("status", F.concat(F.lit("| "), F.get_json_object("json", "$.status"))), "status").select("line", "json")
