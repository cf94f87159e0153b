"""Loads, lookups, status logs and rate limits."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexmill.operators import lifecycle as L
from lexmill.operators import load as O
from lexmill.operators import search as Q
from lexmill.plans.registry import Registry
from lexmill.schemas import ARTICLES, COMPLETENESS, DOCUMENT_TYPES, DOCUMENTS, PROVENANCE, QUALITIES, RELATIONS, outside
from lexmill.session import checkpoint_folder
from lexmill.sources.tables import table
from lexmill.streaming.loads import load_stream

registry = Registry()

# the target holds the pages that are not penal, the batch those that are not civil, so that they share some
_TARGET, _BATCH = "coalesce(category, '') <> 'penal'", "coalesce(category, '') <> 'civil'"
_COLS = ("source_url", "status", "subject", "content_hash", "discovered_at", "id")


def _halves(spark: SparkSession, directory: str) -> tuple[DataFrame, DataFrame]:
    rows = table(spark, directory, "decisions")
    target = O.one_per_key(rows.filter(_TARGET).select(*_COLS), ["source_url"], "id")
    batch = rows.filter(_BATCH).select(*_COLS).withColumn("subject", F.concat("subject", F.lit("!"))).withColumn("status", F.lit("nouveau"))
    return target, batch


_PARTS = f"""WITH t AS (SELECT source_url, status, subject, content_hash, discovered_at, id FROM (SELECT *, row_number() OVER (PARTITION BY source_url ORDER BY id) AS k FROM decisions WHERE {_TARGET}) WHERE k = 1),
b AS (SELECT source_url, 'nouveau' AS status, subject || '!' AS subject, content_hash, discovered_at, id FROM decisions WHERE {_BATCH}),
f AS (SELECT * EXCLUDE (k) FROM (SELECT *, row_number() OVER (PARTITION BY source_url ORDER BY id) AS k FROM b) WHERE k = 1),
l AS (SELECT * EXCLUDE (k) FROM (SELECT *, row_number() OVER (PARTITION BY source_url ORDER BY id DESC) AS k FROM b) WHERE k = 1)"""
_LIST = ", ".join(_COLS)


@registry.query(_PARTS + f" SELECT {_LIST} FROM t UNION ALL SELECT {_LIST} FROM f WHERE source_url NOT IN (SELECT source_url FROM t)")
def insert_or_ignore(spark: SparkSession, directory: str) -> DataFrame:
    return O.insert_or_ignore(*_halves(spark, directory), ["source_url"], "id")[0]


@registry.query(_PARTS + " SELECT count(*) AS n_inserted FROM f WHERE source_url NOT IN (SELECT source_url FROM t)")
def inserted_count(spark: SparkSession, directory: str) -> DataFrame:
    return O.insert_or_ignore(*_halves(spark, directory), ["source_url"], "id")[1].agg(F.count("*").alias("n_inserted"))


def _merge_sql(take: dict[str, str]) -> str:
    parts = [f"coalesce(l.source_url, t.source_url) AS source_url"]
    parts += [f"CASE WHEN l.id IS NULL THEN t.{c} ELSE {take.get(c, 'l.' + c)} END AS {c}" for c in _COLS if c != "source_url"]
    return _PARTS + f" SELECT {', '.join(parts)} FROM t FULL JOIN l ON l.source_url = t.source_url"


@registry.query(_merge_sql({"discovered_at": "CASE WHEN t.id IS NULL THEN l.discovered_at ELSE t.discovered_at END"}))
def upsert(spark: SparkSession, directory: str) -> DataFrame:
    return O.upsert(*_halves(spark, directory), ["source_url"], "id", keep=("discovered_at",))


@registry.query(_merge_sql({"subject": "coalesce(nullif(l.subject, ''), t.subject)"}))
def partial_upsert(spark: SparkSession, directory: str) -> DataFrame:
    return O.partial_upsert(*_halves(spark, directory), ["source_url"], "id", ("subject",))


@registry.query(_merge_sql({}))
def replace_last(spark: SparkSession, directory: str) -> DataFrame:
    return O.replace_last(*_halves(spark, directory), ["source_url"], "id")


@registry.query("""WITH b AS (SELECT issue_year, issue_number, id + 1000000 AS id FROM revue_decisions WHERE match_verdict = 'NEW')
SELECT issue_year, issue_number, id FROM revue_decisions r WHERE NOT EXISTS (SELECT 1 FROM b WHERE b.issue_year = r.issue_year AND b.issue_number = r.issue_number) UNION ALL SELECT * FROM b""")
def replace_partitions(spark: SparkSession, directory: str) -> DataFrame:
    rows = table(spark, directory, "revue_decisions")
    batch = rows.filter("match_verdict = 'NEW'").select("issue_year", "issue_number", (F.col("id") + 1_000_000).alias("id"))
    return O.replace_partitions(rows.select("issue_year", "issue_number", "id"), batch, ["issue_year", "issue_number"])


@registry.query("SELECT id, CASE WHEN status = 'erreur' THEN 'decouvert' ELSE status END AS status, CASE WHEN status = 'erreur' THEN coalesce(substring(repeat(error, 500), 1, 2000), error) ELSE error END AS error FROM decisions")
def status_patch(spark: SparkSession, directory: str) -> DataFrame:
    rows = table(spark, directory, "decisions").select("id", "status", "error")
    changes = rows.filter("status = 'erreur'").select("id", F.lit("decouvert").alias("status"), F.repeat("error", 500).alias("error"))
    return O.patch(rows, changes, ["id"], "id", {"error": 2000})


@registry.query("SELECT (SELECT count(DISTINCT canonical_id) FROM documents) AS n_documents, 0 AS n_again")
def idempotent_reload(spark: SparkSession, directory: str) -> DataFrame:
    """AUD-03: the documents loaded into an empty table, then once more."""
    rows = table(spark, directory, "documents").select("doc_id", "canonical_id")
    target, _ = O.insert_or_ignore(O.empty_table(spark, rows.schema), rows, ["canonical_id"], "doc_id")
    _, again = O.insert_or_ignore(target, rows, ["canonical_id"], "doc_id")
    return target.agg(F.count("*").alias("n_documents")).join(again.agg(F.count("*").alias("n_again")))


@registry.query("""SELECT 'documents' AS name, (SELECT count(DISTINCT canonical_id) FROM documents) AS n_inserted UNION ALL SELECT 'provenance', (SELECT count(DISTINCT canonical_id) FROM provenance)
UNION ALL SELECT 'articles', (SELECT count(*) FROM (SELECT DISTINCT parent_document_id, ordinal FROM articles))""")
def batch_insert(spark: SparkSession, directory: str) -> DataFrame:
    keys = {"documents": ["canonical_id"], "provenance": ["canonical_id"], "articles": ["parent_document_id", "ordinal"]}
    batch = {n: table(spark, directory, n).select(*k, F.col("doc_id" if n == "documents" else "id").alias("seq")) for n, k in keys.items()}
    empty = {n: O.empty_table(spark, b.schema) for n, b in batch.items()}
    _, new = O.insert_batch(empty, batch, keys, "seq")
    out = None
    for name, rows in new.items():
        one = rows.agg(F.count("*").alias("n_inserted")).select(F.lit(name).alias("name"), "n_inserted")
        out = one if out is None else out.unionByName(one)
    return out


@registry.query("SELECT doc_id, canonical_id FROM documents")
def strict_insert(spark: SparkSession, directory: str) -> DataFrame:
    rows = table(spark, directory, "documents").select("doc_id", "canonical_id")
    return O.strict_insert(O.empty_table(spark, rows.schema), rows, ["canonical_id"])


_SCHEMAS = {"documents": DOCUMENTS, "provenance": PROVENANCE, "articles": ARTICLES, "relations": RELATIONS}
_NAMES = {n: ", ".join(f"'{part.split()[0]}'" for part in s.split(", ")) for n, s in _SCHEMAS.items()}


@registry.query(" UNION ALL ".join(f"""SELECT '{n}' AS name, column_name AS field, CASE column_type WHEN 'VARCHAR' THEN 'string' WHEN 'INTEGER' THEN 'int' WHEN 'BIGINT' THEN 'bigint' ELSE lower(column_type) END AS type,
  true AS empty_twice FROM (DESCRIBE {n}) WHERE column_name IN ({_NAMES[n]})""" for n in _SCHEMAS))
def table_schemas(spark: SparkSession, directory: str) -> DataFrame:
    """Fields and types of tables made empty, to be those of the stored ones; making one twice changes nothing."""
    del directory
    rows = []
    for name, schema in _SCHEMAS.items():
        made = O.empty_table(spark, schema)
        again = O.insert_or_ignore(made, O.empty_table(spark, schema), [made.columns[0]], made.columns[-1])[0]
        rows += [(name, f.name, f.dataType.simpleString(), again.schema == made.schema) for f in made.schema]
    return spark.createDataFrame(rows, "name string, field string, type string, empty_twice boolean")


_ENUMS = {"document_type": DOCUMENT_TYPES, "text_completeness": COMPLETENESS, "extraction_quality": QUALITIES}


@registry.query(" UNION ALL ".join(f"SELECT '{c}' AS field, count(*) FILTER ({c} NOT IN ({', '.join(repr(v) for v in values)})) AS n_outside FROM documents" for c, values in _ENUMS.items()))
def enum_check(spark: SparkSession, directory: str) -> DataFrame:
    counts = table(spark, directory, "documents").agg(*[F.count_if(outside(F.col(c), v)).alias(c) for c, v in _ENUMS.items()])
    return counts.selectExpr("stack(3, " + ", ".join(f"'{c}', {c}" for c in _ENUMS) + ") AS (field, n_outside)")


# lookups
@registry.query("SELECT d.canonical_id, d.title, p.source_db AS prov_source_db, p.raw_path AS prov_raw_path FROM documents d LEFT JOIN provenance p ON p.canonical_id = d.canonical_id")
def doc_detail(spark: SparkSession, directory: str) -> DataFrame:
    detail = Q.document_detail(table(spark, directory, "documents"), table(spark, directory, "provenance"))
    return detail.select("canonical_id", "title", "prov_source_db", "prov_raw_path")


_FOLD = lambda c: f"translate({c}, '{Q.UPPER}', '{Q.LOWER}')"
_FIELDS = ("canonical_id", "document_number", "title", "subject")


@registry.query("SELECT doc_id, title FROM documents WHERE source = 'joradp_fr' AND (" + " OR ".join(f"{_FOLD(c)} LIKE '%dossier_m%'" for c in _FIELDS) + ") ORDER BY doc_id DESC LIMIT 40")
def search_latest40(spark: SparkSession, directory: str) -> DataFrame:
    return Q.search(table(spark, directory, "documents"), "Dossier_M", "joradp_fr", "doc_id", _FIELDS).select("doc_id", "title")


_HOT = "(SELECT parent_document_id FROM articles GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)"


@registry.query(f"SELECT id, ordinal, article_number FROM articles WHERE parent_document_id = {_HOT}")
def document_articles(spark: SparkSession, directory: str) -> DataFrame:
    rows = table(spark, directory, "articles")
    hot = rows.groupBy("parent_document_id").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "parent_document_id").first()
    return Q.articles_of(rows, hot[0] if hot else "").select("id", "ordinal", "article_number")


_HUB = "(SELECT target_id FROM relations GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)"


@registry.query(f"SELECT id, relation_type FROM relations WHERE source_id = {_HUB} OR target_id = {_HUB}")
def document_relations(spark: SparkSession, directory: str) -> DataFrame:
    rows = table(spark, directory, "relations")
    hub = rows.groupBy("target_id").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "target_id").first()
    return Q.relations_of(rows, hub[0] if hub else "").select("id", "relation_type")


@registry.query("SELECT canonical_id, substring(subject, 1, 80) AS subject, substring(full_text, 1, 3000) AS text FROM documents")
def previews(spark: SparkSession, directory: str) -> DataFrame:
    return Q.preview(table(spark, directory, "documents"))


@registry.query("SELECT id, source_url, error FROM decisions WHERE status = 'erreur' ORDER BY id LIMIT 20")
def error_sample(spark: SparkSession, directory: str) -> DataFrame:
    return table(spark, directory, "decisions").filter("status = 'erreur'").orderBy("id").limit(20).select("id", "source_url", "error")


@registry.query("SELECT doc_id, title FROM documents WHERE year = 1999 AND language = 'FR' ORDER BY doc_id")
def sources_by_year(spark: SparkSession, directory: str) -> DataFrame:
    return table(spark, directory, "documents").filter("year = 1999 AND language = 'FR'").orderBy("doc_id").select("doc_id", "title")


@registry.query("SELECT id, source_url FROM decisions WHERE status IN ('decouvert', 'erreur') ORDER BY id")
def pending_urls(spark: SparkSession, directory: str) -> DataFrame:
    return L.pending(table(spark, directory, "decisions"), "status", ("decouvert", "erreur"), "id").select("id", "source_url")


@registry.query("SELECT id FROM provenance WHERE coalesce(pdf_path, '') <> ''")
def with_pdf(spark: SparkSession, directory: str) -> DataFrame:
    return table(spark, directory, "provenance").filter("coalesce(pdf_path, '') <> ''").select("id")


# status logs and limits
@registry.query("SELECT user_id, arg_max(event_type, {a: ts, b: event_id}) AS status, max(ts) AS at FROM events GROUP BY 1")
def latest_status(spark: SparkSession, directory: str) -> DataFrame:
    return L.latest_status(table(spark, directory, "events"), "user_id", "event_type", "ts", "event_id")


@registry.query("""WITH m AS (SELECT *, event_type = 'error' AS miss FROM events), i AS (SELECT *, sum(CASE WHEN miss THEN 0 ELSE 1 END) OVER (PARTITION BY user_id ORDER BY event_id) AS island FROM m),
r AS (SELECT *, CASE WHEN miss THEN sum(CASE WHEN miss THEN 1 ELSE 0 END) OVER (PARTITION BY user_id, island ORDER BY event_id) ELSE 0 END AS run FROM i),
s AS (SELECT *, min(CASE WHEN run >= 2 THEN event_id END) OVER (PARTITION BY user_id) AS stop FROM r) SELECT user_id, event_id FROM s WHERE stop IS NULL OR event_id <= stop""")
def early_stop(spark: SparkSession, directory: str) -> DataFrame:
    rows = table(spark, directory, "events").select("user_id", "event_id", "event_type")
    return L.until_misses(rows, ["user_id"], "event_id", F.col("event_type") == "error", 2).select("user_id", "event_id")


@registry.query("""WITH p AS (SELECT user_id, CAST(date_trunc('day', ts) AS DATE) AS day, count(*) FILTER (event_type = 'purchase') AS n FROM events GROUP BY ALL),
s AS (SELECT *, min(CASE WHEN n = 0 THEN day END) OVER (PARTITION BY user_id) AS stop FROM p) SELECT user_id, day, n FROM s WHERE stop IS NULL OR day < stop""")
def until_empty_page(spark: SparkSession, directory: str) -> DataFrame:
    days = table(spark, directory, "events").groupBy("user_id", F.to_date("ts").alias("day")).agg(F.count_if(F.col("event_type") == "purchase").alias("n"))
    return L.until_empty(days, ["user_id"], "day", "n")


@registry.query("SELECT event_id, CASE WHEN event_id % 9 <= 0 THEN 0.0 ELSE list_sum(list_transform(range(1, event_id % 9 + 1), lambda n: least(60.0, pow(2.0, n)))) END AS wait FROM events")
def backoff(spark: SparkSession, directory: str) -> DataFrame:
    return table(spark, directory, "events").select("event_id", L.backoff_seconds((F.col("event_id") % 9).cast("int")).alias("wait"))


@registry.query("""WITH e AS (SELECT user_id, event_id, epoch_us(ts) AS a FROM events), i AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY a, event_id) - 1 AS i FROM e)
SELECT user_id, event_id, i * 2000000 + max(a - i * 2000000) OVER (PARTITION BY user_id ORDER BY a, event_id ROWS UNBOUNDED PRECEDING) AS start FROM i""")
def limiter_schedule(spark: SparkSession, directory: str) -> DataFrame:
    arrivals = table(spark, directory, "events").select("user_id", "event_id", F.unix_micros(F.col("ts").cast("timestamp")).alias("a"))
    return L.limited_starts(arrivals, ["user_id"], "a", "event_id", 2_000_000).select("user_id", "event_id", "start")


@registry.query("""SELECT canonical_id, id AS first_id, source_url FROM (SELECT *, row_number() OVER (PARTITION BY canonical_id ORDER BY id) AS k FROM provenance WHERE canonical_id IS NOT NULL) WHERE k = 1""")
def micro_batches(spark: SparkSession, directory: str) -> DataFrame:
    """STR-04: provenance as a stream of files, loaded in micro-batches, then once more by another stream that adds nothing."""
    folder = f"{checkpoint_folder(spark)}/stream-{uuid.uuid4().hex}"
    source = f"{directory}/provenance.parquet"
    stream = spark.readStream.schema(spark.read.parquet(source).schema).option("maxFilesPerTrigger", 4).parquet(f"{directory}/[p]rovenance.parquet")  # a pattern may name a file or a folder
    parse = lambda batch: batch.filter("canonical_id IS NOT NULL").select("canonical_id", F.col("id").alias("first_id"), "source_url")
    for name in ("once", "again"):
        load_stream(stream, parse, f"{folder}/table", ["canonical_id"], "first_id", f"{folder}/{name}").awaitTermination()
    return spark.read.parquet(f"{folder}/table").select("canonical_id", "first_id", "source_url")
