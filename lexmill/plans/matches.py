"""Matches between sources, offsets and page ranges."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lexmill.operators import matching as M
from lexmill.operators.review import guide_entries, segment
from lexmill.plans import sqltext as S
from lexmill.plans.records import PAGES_SQL, pages
from lexmill.plans.registry import Registry
from lexmill.sources.tables import table

registry = Registry()

_NULL = f"nullif(ltrim({S.strip('decision_number')}, '0'), '')"
_ZERO = "CASE WHEN decision_number IS NOT NULL THEN coalesce(nullif(ltrim(decision_number, '0'), ''), '0') END"
_HTML = f"SELECT {_NULL} AS num, id AS d_id, TRY_CAST(substring(date, 1, 4) AS INTEGER) AS d_year, chamber AS d_chamber FROM decisions WHERE status = 'telecharge'"


@registry.query(f"""WITH h AS (SELECT * FROM ({_HTML}) WHERE num IS NOT NULL),
r AS (SELECT e.id, e.issue_year, e.issue_number, e.num, h.d_id, CASE WHEN coalesce(e.decision_year, 0) <> 0 AND h.d_year = e.decision_year THEN 1
  WHEN coalesce(e.chamber, '') <> '' AND contains(h.d_chamber, e.chamber) THEN 2 WHEN h.d_id IS NOT NULL THEN 3 END AS level
  FROM (SELECT *, {_NULL} AS num FROM revue_index WHERE decision_number IS NOT NULL) e LEFT JOIN h USING (num)),
b AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY level NULLS LAST, d_id) AS k FROM r)
SELECT id AS entry_id, CASE WHEN num IS NULL THEN 'UNCERTAIN' WHEN d_id IS NULL THEN 'NEW' WHEN level = 1 THEN 'MATCH_EXACT' ELSE 'MATCH_PROBABLE' END AS verdict,
  CASE WHEN num IS NULL THEN 0 WHEN d_id IS NULL THEN 3 ELSE level END AS level, d_id AS decision_id,
  CASE WHEN d_id IS NULL THEN 'revue_' || coalesce(CAST(nullif(issue_year, 0) AS VARCHAR), 'XXXX') || '-' || {S.padded('coalesce(issue_number, 0)', 2)} ELSE 'supreme_court_html+revue' END AS sources
FROM b WHERE k = 1""")
def match_ladder(spark: SparkSession, directory: str) -> DataFrame:
    return M.index_matches(table(spark, directory, "revue_index"), table(spark, directory, "decisions"))


@registry.query(f"""WITH h AS (SELECT {_ZERO} AS num, list(DISTINCT date) FILTER (date IS NOT NULL) AS dates, true AS here FROM decisions WHERE status = 'telecharge' AND decision_number IS NOT NULL GROUP BY 1)
SELECT r.id, CASE WHEN h.here IS NULL THEN 'NEW' WHEN coalesce(list_contains(h.dates, r.date), false) THEN 'MATCH_EXACT' ELSE 'MATCH_PROBABLE' END AS verdict
FROM (SELECT *, {_ZERO} AS num FROM revue_decisions) r LEFT JOIN h USING (num)""")
def match_exact_date(spark: SparkSession, directory: str) -> DataFrame:
    return M.date_verdicts(table(spark, directory, "revue_decisions"), table(spark, directory, "decisions"), M.same_date).select("id", "verdict")


@registry.query(f"""WITH h AS (SELECT {_ZERO} AS num, list(DISTINCT date) FILTER (date IS NOT NULL) AS dates, true AS here FROM decisions WHERE status = 'telecharge' AND decision_number IS NOT NULL GROUP BY 1)
SELECT r.id, CASE WHEN h.here IS NULL THEN 'NEW' WHEN len(list_filter(h.dates, lambda d: starts_with(d, coalesce(CAST(nullif(r.decision_year, 0) AS VARCHAR), '')))) > 0 THEN 'MATCH_EXACT' ELSE 'MATCH_PROBABLE' END AS verdict
FROM (SELECT *, {_ZERO} AS num FROM revue_index) r LEFT JOIN h USING (num)""")
def match_year_prefix(spark: SparkSession, directory: str) -> DataFrame:
    return M.date_verdicts(table(spark, directory, "revue_index"), table(spark, directory, "decisions"), M.same_year_prefix).select("id", "verdict")


@registry.query(f"""WITH a AS (SELECT {_NULL} AS num, date AS review_date, min(id) AS review_id, count(*) AS n_review FROM revue_decisions GROUP BY 1, 2),
b AS (SELECT {_NULL} AS num, date AS court_date, min(id) AS court_id, count(*) AS n_court FROM decisions GROUP BY 1, 2)
SELECT *, CASE WHEN review_date = court_date THEN 'SAME_DECISION_DIFFERENT_SOURCE' WHEN substring(review_date, 1, 4) = substring(court_date, 1, 4) THEN 'POSSIBLE_SAME_DECISION'
  WHEN review_date IS NULL OR court_date IS NULL THEN 'UNDATED' ELSE 'SAME_NUMBER_DIFFERENT_DECISION' END AS kind FROM a JOIN b USING (num)""")
def cross_source_edges(spark: SparkSession, directory: str) -> DataFrame:
    return M.cross_source_edges(table(spark, directory, "revue_decisions"), table(spark, directory, "decisions"))


def _mode_sql(samples: str, confidence: str, method: str, extra: str = "") -> str:
    return f"""SELECT issue_year, issue_number, "offset" AS offset_value, {confidence} AS confidence, '{method}' AS method, samples, total_samples, round_even(samples / total_samples * 100, 1) AS consensus_pct
FROM (SELECT *, CAST(sum(samples) OVER (PARTITION BY issue_year, issue_number) AS BIGINT) AS total_samples, row_number() OVER (PARTITION BY issue_year, issue_number ORDER BY samples DESC, first) AS k
  FROM (SELECT issue_year, issue_number, "offset", count(*) AS samples, min(seq) AS first FROM ({samples}) GROUP BY ALL)) WHERE k = 1{extra}"""


_PCT = "samples / total_samples * 100"
_THREE = f"CASE WHEN samples >= 5 AND {_PCT} >= 80 THEN 'HIGH' WHEN samples >= 2 AND {_PCT} >= 60 THEN 'MEDIUM' ELSE 'LOW' END"
_TWO = f"CASE WHEN samples >= 3 AND {_PCT} >= 70 THEN 'MEDIUM' ELSE 'LOW' END"
_MARKERS = f"""WITH idx AS (SELECT issue_year, issue_number, coalesce({_ZERO}, '0') AS num, arg_max(start_page, id) AS start_page FROM revue_index WHERE start_page IS NOT NULL GROUP BY ALL)
  SELECT d.issue_year, d.issue_number, d.pdf_start_page - idx.start_page AS "offset", d.id AS seq FROM (SELECT *, {_ZERO} AS num FROM revue_decisions
  WHERE decision_number IS NOT NULL AND pdf_start_page IS NOT NULL AND NOT ends_with(coalesce(source, ''), 'index_guide')) d JOIN idx USING (issue_year, issue_number, num)"""


# hardly a stored decision is in the guide of its issue; each entry is also read from its page, the issue's number later
_READ = _MARKERS.replace("FROM revue_decisions\n", """FROM (SELECT issue_year, issue_number, decision_number, pdf_start_page, source, id FROM revue_decisions
  UNION ALL SELECT issue_year, issue_number, decision_number, start_page + issue_number, NULL, id + 1000000000 FROM revue_index)\n""")


@registry.query(_mode_sql(_READ, _THREE, "text_markers"))
def page_offset_mode(spark: SparkSession, directory: str) -> DataFrame:
    columns = ("issue_year", "issue_number", "decision_number", "pdf_start_page", "source", "id")
    entries = table(spark, directory, "revue_index")
    read = entries.withColumns({"pdf_start_page": F.col("start_page") + F.col("issue_number"), "source": F.lit(None).cast("string"), "id": F.col("id") + 1_000_000_000})
    decisions = table(spark, directory, "revue_decisions").select(*columns).unionByName(read.select(*columns))
    return M.offset_mode(M.offset_samples(decisions, entries), "text_markers")


_FOOTERS_OF = lambda source: rf"""early AS (SELECT *, row_number() OVER (PARTITION BY issue_year, issue_number ORDER BY page_no) AS k FROM {source}),
  l AS (SELECT *, string_split(regexp_replace(text, '\A\s+|\s+\z', '', 'g'), chr(10)) AS lines FROM early WHERE k <= 150),
  n AS (SELECT *, list_filter(list_transform(lines[greatest(len(lines) - 2, 1):], lambda x: TRY_CAST(nullif(regexp_extract(x, '^\s*-\s*(\d+)\s*-\s*$', 1), '') AS INTEGER)), lambda v: v BETWEEN 1 AND 2000) AS found FROM l)
  SELECT issue_year, issue_number, page_no - found[1] AS "offset", page_no AS seq FROM n WHERE len(found) > 0"""  # noqa: E731
_FOOTERS = f"WITH {PAGES_SQL}, {_FOOTERS_OF('pages')}"
# the stored pages have no footers of the form looked for; each gets one, its issue's number off
_FOOTED = f"""WITH {PAGES_SQL}, footed AS (SELECT issue_year, issue_number, page_no, text || chr(10) || '- ' || (page_no + issue_number) || ' -' || chr(10) AS text FROM pages), {_FOOTERS_OF('footed')}"""


@registry.query(_mode_sql(_FOOTED, _THREE, "page_footers", ' AND abs("offset") <= 20'))
def footer_offsets(spark: SparkSession, directory: str) -> DataFrame:
    footer = F.concat(F.lit("\n- "), (F.col("page_no") + F.col("issue_number")).cast("string"), F.lit(" -\n"))
    return M.offset_mode(M.footer_samples(pages(spark, directory).withColumn("text", F.concat("text", footer))), "page_footers")


_SEARCH_IN = lambda source: f"""e AS (SELECT *, row_number() OVER (PARTITION BY issue_year, issue_number ORDER BY start_page, id) AS k FROM revue_index WHERE decision_number IS NOT NULL AND start_page IS NOT NULL)
  SELECT e.issue_year, e.issue_number, e.id AS seq, min(p.page_no - e.start_page) AS "offset" FROM e JOIN {source} p ON p.issue_year = e.issue_year AND p.issue_number = e.issue_number
  AND p.page_no BETWEEN e.start_page - 10 AND e.start_page + 10 AND contains(p.text, e.decision_number) WHERE e.k <= 20 GROUP BY ALL"""  # noqa: E731
_SEARCH = f"WITH {PAGES_SQL}, {_SEARCH_IN('pages')}"
# no stored page holds the number of an entry of its issue; each entry's page is rendered, the issue's number later
_RENDERED = f"""WITH rendered AS (SELECT issue_year, issue_number, start_page + issue_number AS page_no, 'ملف رقم ' || decision_number AS text FROM revue_index
  WHERE decision_number IS NOT NULL AND start_page IS NOT NULL AND issue_number IS NOT NULL), {_SEARCH_IN('rendered')}"""


@registry.query(_mode_sql(_RENDERED, _TWO, "text_search"))
def offset_probe(spark: SparkSession, directory: str) -> DataFrame:
    entries = table(spark, directory, "revue_index")
    rendered = entries.filter("decision_number IS NOT NULL AND start_page IS NOT NULL AND issue_number IS NOT NULL")
    shown = rendered.select("issue_year", "issue_number", (F.col("start_page") + F.col("issue_number")).alias("page_no"), F.concat(F.lit("ملف رقم "), "decision_number").alias("text"))
    return M.offset_mode(M.search_samples(entries, shown), "text_search")


def _all_offsets(spark: SparkSession, directory: str) -> DataFrame:
    entries, shown = table(spark, directory, "revue_index"), pages(spark, directory)
    methods = [
        M.offset_mode(M.offset_samples(table(spark, directory, "revue_decisions"), entries), "text_markers"),
        M.offset_mode(M.footer_samples(shown), "page_footers"),
        M.offset_mode(M.search_samples(entries, shown), "text_search"),
    ]
    return M.best_offsets(entries, methods)


_BEST = f"""WITH m AS ({_mode_sql(_MARKERS, _THREE, 'text_markers')}), f AS ({_mode_sql(_FOOTERS, _THREE, 'page_footers', ' AND abs("offset") <= 20')}), s AS ({_mode_sql(_SEARCH, _TWO, 'text_search')}),
a AS (SELECT *, CASE method WHEN 'text_markers' THEN 0 WHEN 'page_footers' THEN 1 ELSE 2 END + CASE WHEN confidence IN ('HIGH', 'MEDIUM') AND method <> 'text_search' THEN 0 ELSE 10 END AS rank
  FROM (SELECT * FROM m UNION ALL SELECT * FROM f UNION ALL SELECT * FROM s)),
b AS (SELECT *, row_number() OVER (PARTITION BY issue_year, issue_number ORDER BY rank) AS k FROM a)
SELECT i.issue_year, i.issue_number, coalesce(offset_value, 0) AS offset_value, coalesce(confidence, 'FALLBACK') AS confidence, coalesce(method, 'fallback') AS method, coalesce(samples, 0) AS samples,
  coalesce(total_samples, 0) AS total_samples, coalesce(consensus_pct, 0.0) AS consensus_pct
FROM (SELECT DISTINCT issue_year, issue_number FROM revue_index) i LEFT JOIN (SELECT * FROM b WHERE k = 1) b USING (issue_year, issue_number)"""


@registry.query(_BEST)
def best_offsets(spark: SparkSession, directory: str) -> DataFrame:
    return _all_offsets(spark, directory)


@registry.query(f"""WITH o AS ({_BEST}), m AS (SELECT issue_year, issue_number, max(pdf_start_page) AS last_page FROM revue_decisions GROUP BY ALL HAVING max(pdf_start_page) IS NOT NULL),
e AS (SELECT i.*, o.offset_value, m.last_page, lead(start_page) OVER (PARTITION BY issue_year, issue_number ORDER BY start_page, id) AS nxt FROM revue_index i JOIN o USING (issue_year, issue_number) JOIN m USING (issue_year, issue_number)
  WHERE decision_number IS NOT NULL AND start_page IS NOT NULL),
c AS (SELECT *, greatest(1, least(start_page + offset_value, last_page)) AS a, coalesce(nxt + offset_value - 1, last_page) AS b FROM e)
SELECT issue_year, issue_number, id, decision_number, a AS pdf_start_page, greatest(a, least(b, last_page)) AS pdf_end_page FROM c""")
def legacy_ranges(spark: SparkSession, directory: str) -> DataFrame:
    last = table(spark, directory, "revue_decisions").groupBy("issue_year", "issue_number").agg(F.max("pdf_start_page").alias("last_page"))
    return M.legacy_ranges(table(spark, directory, "revue_index"), _all_offsets(spark, directory), last.filter("last_page IS NOT NULL"))


_KEY = "issue_year, issue_number, decision_number"


@registry.query(f"""WITH e AS (SELECT {_KEY}, start_page AS page, id FROM revue_index WHERE decision_number IS NOT NULL AND start_page IS NOT NULL),
x AS (SELECT {_KEY}, pdf_start_page AS page, id FROM revue_decisions WHERE decision_number IS NOT NULL AND pdf_start_page IS NOT NULL
  UNION ALL SELECT {_KEY}, page + id % 3, id + 1000000000 FROM e),
xs AS (SELECT {_KEY}, page, max(id) AS decision_id FROM x GROUP BY ALL),
h AS (SELECT e.*, row_number() OVER (PARTITION BY {', '.join('e.' + k for k in _KEY.split(', '))}, e.page ORDER BY e.id) AS k, xs.decision_id FROM e LEFT JOIN xs USING (issue_year, issue_number, decision_number, page)),
exact AS (SELECT {_KEY}, id, decision_id FROM h WHERE decision_id IS NOT NULL AND k = 1),
free AS (SELECT *, row_number() OVER (PARTITION BY {_KEY} ORDER BY page, id) AS n FROM x WHERE id NOT IN (SELECT decision_id FROM exact)),
open AS (SELECT *, row_number() OVER (PARTITION BY {_KEY} ORDER BY page, id) AS n FROM h WHERE decision_id IS NULL)
SELECT id, decision_id FROM exact UNION ALL SELECT open.id, free.id FROM open JOIN free USING (issue_year, issue_number, decision_number, n)""")
def paired_ids(spark: SparkSession, directory: str) -> DataFrame:
    key = _KEY.split(", ")
    entries = table(spark, directory, "revue_index").filter("decision_number IS NOT NULL AND start_page IS NOT NULL").select(*key, F.col("start_page").alias("page"), "id")
    existing = table(spark, directory, "revue_decisions").filter("decision_number IS NOT NULL AND pdf_start_page IS NOT NULL").select(*key, F.col("pdf_start_page").alias("page"), "id")
    # decisions read from the index itself, some a page or two off
    read = entries.select(*key, (F.col("page") + (F.col("id") % 3).cast("int")).alias("page"), (F.col("id") + 1_000_000_000).alias("id"))
    return M.paired_ids(entries, existing.unionByName(read))


@registry.query(f"""SELECT issue_year, id AS issue_number, decision_number, replace(date, '/', '-') AS date, 1 AS start_page, 'الغرفة المدنية' AS chamber_raw, nullif({S.strip("coalesce(subject, '-')")}, '') AS subject,
  CAST(NULL AS VARCHAR) AS keywords, CAST(NULL AS VARCHAR) AS legal_references, CAST(NULL AS VARCHAR) AS principle, true AS has_disposition, 'الغرف المدنية' AS chamber
FROM revue_decisions WHERE regexp_matches(decision_number, '^[0-9]+$') AND regexp_matches(date, '^[0-9]{{4}}[-/][0-9]{{2}}[-/][0-9]{{2}}$') AND issue_year IS NOT NULL""")
def review_segments(spark: SparkSession, directory: str) -> DataFrame:
    """Decisions of issues whose pages are rendered from the decisions table, one issue per decision year."""
    rows = table(spark, directory, "revue_decisions").filter("decision_number IS NOT NULL AND date IS NOT NULL AND issue_year IS NOT NULL")
    text = F.concat(
        F.lit("# 1. الغرفة المدنية\nملف رقم "), F.col("decision_number"), F.lit(" قرار بتاريخ "), F.replace("date", F.lit("-"), F.lit("/")), F.lit("\nالموضوع: "),
        F.coalesce("subject", F.lit("-")), F.lit("\nقررت المحكمة العليا"),
    )
    shown = rows.select("issue_year", F.col("id").alias("issue_number"), F.lit(1).alias("page_no"), text.alias("text"))
    return segment(shown, ["issue_year", "issue_number"])


@registry.query("""SELECT CAST(id AS INTEGER) AS source_page, 1 AS row_no, CAST(id AS VARCHAR) AS decision_number, decision_year, issue_number, decision_year AS issue_year, start_page,
  CAST(NULL AS VARCHAR) AS chamber, CAST(NULL AS VARCHAR) AS subject, CAST(NULL AS VARCHAR) AS principle, CAST(NULL AS VARCHAR) AS legal_reference,
  CASE WHEN coalesce(decision_year, 0) <> 0 AND coalesce(start_page, 0) <> 0 THEN 'ok' ELSE 'partial' END AS parser_status FROM revue_index""")
def nearest_column(spark: SparkSession, directory: str) -> DataFrame:
    """A guide's page rendered for every index entry as positioned words; letters of a word run in visual order.

    Two words stand within their column, one outside but near, one is too far from any.
    """
    page = F.col("id").alias("page")
    heads = [("رقم القارر", 0.0, 40.0), ("الصفحة", 50.0, 80.0), ("السنة", 90.0, 120.0), ("العدد", 130.0, 160.0)]
    rows = table(spark, directory, "revue_index")

    def at(text: Column, x0: float, x1: float, top: float) -> Column:
        return F.struct(text.cast("string").alias("text"), *[F.lit(v).alias(n) for n, v in (("x0", x0), ("x1", x1), ("top", top), ("bottom", top + 5.0))])

    placed = F.array(
        at(F.col("id"), 5.0, 30.0, 13.0), at(F.col("start_page"), 84.0, 85.0, 13.0), at(F.col("decision_year"), 95.0, 110.0, 13.0),
        at(F.col("issue_number"), 140.0, 145.0, 13.0), at(F.lit("far"), 500.0, 520.0, 13.0),
    )
    words = rows.select(page, F.explode(placed).alias("w")).select("page", "w.*").filter("text IS NOT NULL")
    cell = lambda r, k, a, b, top, t: F.struct(*[F.lit(v).alias(n) for n, v in (("row_no", r), ("col_no", k), ("x0", a), ("x1", b), ("top", top), ("bottom", top + 10.0), ("text", t))])
    grid = F.array(*[cell(0, k, a, b, 0.0, t) for k, (t, a, b) in enumerate(heads)], cell(1, 0, 0.0, 160.0, 10.0, ""))
    return guide_entries(words, rows.select(page, F.explode(grid).alias("c")).select("page", "c.*"))
