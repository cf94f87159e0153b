"""Queries of the training-data operators over whole tables, production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lexmill.llm.budget import budget_totals, language_code, token_budget
from lexmill.llm.chunking import piece_counts, rebuilt, split_pieces
from lexmill.llm.linkage import decision_attributes, index_attributes, link
from lexmill.llm.lookalikes import consistent_forms, suspect_forms
from lexmill.llm.mixing import mix_shares, mix_sources, token_table
from lexmill.llm.packing import container_texts, container_use, containers, sized_items
from lexmill.llm.scans import Corpus, edited, scanned_texts, train_models
from lexmill.llm.truncation import ending_odds, truncated, truncation_rates
from lexmill.llm.vocabulary import chamber_labels, map_chambers
from lexmill.plans.registry import Registry
from lexmill.session import checkpointed
from lexmill.sources.tables import table

registry = Registry()


def size_limit(spark: SparkSession, directory: str, target: str, field: str, unit: str) -> tuple[int, int]:
    """``max_size`` and ``overlap`` of a field; ``size_limits`` has a handful of rows."""
    limits = table(spark, directory, "size_limits")
    row = limits.filter(
        (F.col("target_table") == target) & (F.col("target_field") == field) & (F.col("unit") == unit)
    ).first()
    if row is None:
        raise ValueError(f"size_limits has no entry for {target}.{field} in {unit}")
    return int(row["max_size"]), int(row["overlap"])


_P5 = (("documents", "full_text", "doc_id"), ("articles", "text", "id"))
_WS = r"[\x{9}-\x{D}\x{1C}-\x{20}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"


def _p5_sql(name: str, field: str, row_id: str) -> str:
    return f"""SELECT '{name}' AS table_name, {row_id} AS row_id,
  CASE WHEN list_max(list_transform(regexp_split_to_array({field}, '{_WS}'), lambda x: length(x))) > max_size
       THEN 'unbroken' ELSE 'regular' END AS kind
FROM {name}, (SELECT max_size FROM size_limits WHERE target_table = '{name}' AND target_field = '{field}' AND unit = 'char')
WHERE length({field}) > max_size"""


@registry.query("\nUNION ALL\n".join(_p5_sql(*x) for x in _P5))
def p5_found(spark: SparkSession, directory: str) -> DataFrame:
    out = None
    for name, field, row_id in _P5:
        most, overlap = size_limit(spark, directory, name, field, "char")
        one = piece_counts(table(spark, directory, name), row_id, field, most, overlap).select(
            F.lit(name).alias("table_name"),
            "row_id",
            F.when(F.col("longest_run") > most, "unbroken").otherwise("regular").alias("kind"),
        )
        out = one if out is None else out.unionByName(one)
    return out


@registry.query()
def p5_pieces(spark: SparkSession, directory: str) -> DataFrame:
    out = None
    for name, field, row_id in _P5:
        most, overlap = size_limit(spark, directory, name, field, "char")
        one = split_pieces(table(spark, directory, name), row_id, field, most, overlap).select(
            F.lit(name).alias("table_name"), "row_id", "piece_no", "start", "end", "piece"
        )
        out = one if out is None else out.unionByName(one)
    return out


def _p5_rebuilt_sql(name: str, field: str, row_id: str) -> str:
    return f"SELECT '{name}' AS table_name, {row_id} AS row_id, sha256({field}) AS text_hash, true AS within_size, true AS overlaps FROM {name} WHERE {field} IS NOT NULL"


@registry.query("\nUNION ALL\n".join(_p5_rebuilt_sql(*x) for x in _P5))
def p5_rebuilt(spark: SparkSession, directory: str) -> DataFrame:
    """What the pieces say of their texts: put together again without overlaps, none too long, neighbours sharing the overlap."""
    out = None
    for name, field, row_id in _P5:
        most, overlap = size_limit(spark, directory, name, field, "char")
        pieces = split_pieces(table(spark, directory, name), row_id, field, most, overlap)
        one = rebuilt(pieces, most, overlap).select(F.lit(name).alias("table_name"), "row_id", F.sha2("text", 256).alias("text_hash"), "within_size", "overlaps")
        out = one if out is None else out.unionByName(one)
    return out


_P1 = (("decisions", "chamber"), ("revue_decisions", "chamber_raw"))


@registry.query()
def p1_found(spark: SparkSession, directory: str) -> DataFrame:
    reference = table(spark, directory, "chamber_ref")
    labels = reference.select(F.explode(F.array("label_ar", "label_fr")).alias("label")).filter("label IS NOT NULL")
    out = None
    for name, field in _P1:
        typed = (
            table(spark, directory, name)
            .select(F.lit(name).alias("table_name"), F.col("id").alias("row_id"), F.col(field).alias("value"))
            .filter(F.col("value").isNotNull())
            .join(labels, F.col("value") == F.col("label"), "left_anti")
        )
        one = map_chambers(typed, "value", reference).select(
            "table_name", "row_id", F.coalesce(F.get("chambers", F.lit(0))["entry_id"], F.lit(0)).alias("chamber_id")
        )
        out = one if out is None else out.unionByName(one)
    return out


_P7 = (("documents", "full_text", "doc_id"), ("revue_index", "normalized_text", "id"), ("decisions", "subject", "id"))


@registry.query()
def p7_found(spark: SparkSession, directory: str) -> DataFrame:
    out = None
    for name, field, row_id in _P7:
        one = suspect_forms(table(spark, directory, name), row_id, field).filter("changed")
        one = one.select(F.lit(name).alias("table_name"), "row_id")
        out = one if out is None else out.unionByName(one)
    return out


@registry.query()
def p7_forms(spark: SparkSession, directory: str) -> DataFrame:
    out = None
    for name, field, row_id in _P7:
        one = consistent_forms(table(spark, directory, name), row_id, field)
        one = one.select(F.lit(name).alias("table_name"), "row_id", "form", "changed")
        out = one if out is None else out.unionByName(one)
    return out


def _budget(spark: SparkSession, directory: str) -> DataFrame:
    documents = table(spark, directory, "documents")
    return token_budget(documents, "doc_id", "full_text", "source", "language", "document_type")


@registry.query()
def p6_tokens(spark: SparkSession, directory: str) -> DataFrame:
    return _budget(spark, directory)


@registry.query()
def p6_totals(spark: SparkSession, directory: str) -> DataFrame:
    return budget_totals(_budget(spark, directory))


def _containers(spark: SparkSession, directory: str) -> tuple[DataFrame, DataFrame, int]:
    documents = table(spark, directory, "documents")
    capacity, _ = size_limit(spark, directory, "documents", "text", "token")
    items = sized_items(documents, "doc_id", "text", capacity)
    return containers(items, capacity, documents.count()), documents, capacity


@registry.query()
def p8_containers(spark: SparkSession, directory: str) -> DataFrame:
    return _containers(spark, directory)[0]


@registry.query()
def p8_use(spark: SparkSession, directory: str) -> DataFrame:
    packed, _, capacity = _containers(spark, directory)
    return container_use(packed, capacity)


@registry.query()
def p8_texts(spark: SparkSession, directory: str) -> DataFrame:
    packed, documents, _ = _containers(spark, directory)
    return container_texts(packed, documents, "doc_id", "text")


def _mix(spark: SparkSession, directory: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    targets = table(spark, directory, "mix_targets")
    tokens = token_table(table(spark, directory, "documents"), "doc_id", "source", "text")
    return mix_sources(tokens, targets), tokens, targets


@registry.query()
def p9_selection(spark: SparkSession, directory: str) -> DataFrame:
    return _mix(spark, directory)[0]


@registry.query()
def p9_shares(spark: SparkSession, directory: str) -> DataFrame:
    return mix_shares(*_mix(spark, directory))


def _endings(spark: SparkSession, directory: str) -> DataFrame:
    documents = table(spark, directory, "documents")
    return truncated(checkpointed(ending_odds(documents, "doc_id", "text", language_code(F.col("language")))))


@registry.query()
def p10_found(spark: SparkSession, directory: str) -> DataFrame:
    return _endings(spark, directory).filter("is_cut").select("doc_id")


@registry.query()
def p10_rates(spark: SparkSession, directory: str) -> DataFrame:
    return truncation_rates(table(spark, directory, "documents"), "doc_id", "source", "text", _endings(spark, directory))


def _links(spark: SparkSession, directory: str) -> DataFrame:
    reference = table(spark, directory, "chamber_ref")
    left = index_attributes(table(spark, directory, "revue_index"), reference)
    right = decision_attributes(table(spark, directory, "decisions"), reference)
    return link(left, right)


@registry.query()
def p2_found(spark: SparkSession, directory: str) -> DataFrame:
    return _links(spark, directory).select(F.col("left_id").alias("index_id"), F.col("right_id").alias("decision_id"))


@registry.query()
def p2_confidence(spark: SparkSession, directory: str) -> DataFrame:
    return _links(spark, directory).select(F.col("left_id").alias("index_id"), F.col("right_id").alias("decision_id"), "confidence")


def _edited(spark: SparkSession, directory: str) -> DataFrame:
    chambers = chamber_labels(table(spark, directory, "chamber_ref"))
    rows = scanned_texts(table(spark, directory, "revue_decision_texts"), table(spark, directory, "revue_index"))
    corpus = Corpus(rows, chambers)
    return edited(corpus, train_models(corpus))


@registry.query()
def p3_found(spark: SparkSession, directory: str) -> DataFrame:
    return _edited(spark, directory).filter("kind IS NOT NULL").select("table_name", "row_id", "line_no", "kind")


@registry.query()
def p3_repaired(spark: SparkSession, directory: str) -> DataFrame:
    return _edited(spark, directory).filter("kind IS NULL").select("table_name", "row_id", "repaired")
