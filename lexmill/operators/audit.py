"""Audits and quality reports over the corpus tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexmill.functions.classify import filled


#: Statuses that a coverage report may have as columns.
MOST_STATUSES = 1000


def child_without_parent(child: DataFrame, child_key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """JON-03, JON-04: rows whose key no parent has; a null key has none, either."""
    keys = parent.select(F.col(parent_key).alias("__k"))
    return child.join(keys, F.col(child_key) == F.col("__k"), "left_anti")


def orphan_counts(children: dict[str, tuple[DataFrame, str]], parent: DataFrame, parent_key: str) -> DataFrame:
    """JON-04: ``reference, n_violations`` of all children in one join; equal keys of a reference are counted before it."""
    every = None
    for name, (rows, key) in children.items():
        one = rows.select(F.lit(name).alias("reference"), F.col(key).alias("__key"))
        every = one if every is None else every.unionByName(one)
    keyed = every.groupBy("reference", "__key").agg(F.count("*").alias("n"))
    parents = parent.select(F.col(parent_key).alias("__k"), F.lit(True).alias("__there")).distinct()
    joined = keyed.join(parents, F.col("__key") == F.col("__k"), "left")
    counts = joined.groupBy("reference").agg(F.coalesce(F.sum(F.when(F.col("__there").isNull(), F.col("n"))), F.lit(0)).alias("n_violations"))
    names = parent.sparkSession.createDataFrame([(n,) for n in children], "reference string")
    return names.join(counts, "reference", "left").select("reference", F.coalesce("n_violations", F.lit(0)).alias("n_violations"))


def count_by(rows: DataFrame, column: str) -> DataFrame:
    """AGG-02, AGG-06: rows per value, nulls a group of their own; the column must be one of the table's."""
    if not column.isidentifier() or column not in rows.columns:
        raise ValueError(f"no such column: {column}")
    return rows.groupBy(F.col(column).alias("value")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "value")


def duplicate_groups(rows: DataFrame, key: list[str], row_id: str) -> DataFrame:
    """AGG-03, AGG-14: members of groups of two rows or more: key, size of the group, id.

    Groups are counted before the shuffle and joined back; no group is held in one place.
    """
    groups = rows.groupBy(*key).agg(F.count("*").alias("n")).filter("n > 1").select(*[F.col(k).alias(f"__{k}") for k in key], "n")
    condition = F.lit(True)
    for k in key:
        condition = condition & F.col(k).eqNullSafe(F.col(f"__{k}"))
    return rows.join(groups, condition).select(*key, "n", F.col(row_id).alias("member"))


def duplicate_count(rows: DataFrame, key: list[str]) -> DataFrame:
    """AGG-04: how many keys occur more than once."""
    return rows.groupBy(*key).agg(F.count("*").alias("n")).filter("n > 1").agg(F.count("*").alias("n_groups"))


def missing_rates(rows: DataFrame, columns: list[str]) -> DataFrame:
    """AGG-08: per column how many values are null or empty, and their share in percent, one pass."""
    counts = rows.agg(F.count("*").alias("total"), *[F.count_if(~filled(F.col(c).cast("string"))).alias(c) for c in columns])
    pairs = ", ".join(f"'{c}', `{c}`" for c in columns)
    spread = counts.selectExpr("total", f"stack({len(columns)}, {pairs}) AS (field, n_missing)")
    return spread.select("field", "n_missing", F.bround(F.col("n_missing") / F.greatest("total", F.lit(1)) * 100, 1).alias("rate_pct"))


def length_summary(rows: DataFrame, text: str, short: int) -> DataFrame:
    """AGG-09, AGG-10: mean over all rows cut to an integer, shortest, longest, texts below a length or missing."""
    size = F.when(filled(F.col(text)), F.length(text))
    mean = F.floor(F.coalesce(F.sum(size), F.lit(0)) / F.greatest(F.count("*"), F.lit(1)))
    return rows.agg(
        F.count("*").alias("n"),
        mean.cast("long").alias("mean_length"),
        F.coalesce(F.min(size), F.lit(0)).alias("min_length"),
        F.coalesce(F.max(size), F.lit(0)).alias("max_length"),
        F.count_if(size.isNull() | (size < short)).alias("n_short"),
    )


def presence(rows: DataFrame, columns: list[str], expected: DataFrame) -> DataFrame:
    """AGG-11: values present (not null, empty or ``[]``) per column against ``expected``: field, expected."""
    counts = rows.agg(*[F.count_if(filled(F.col(c).cast("string")) & (F.col(c).cast("string") != "[]")).alias(c) for c in columns])
    pairs = ", ".join(f"'{c}', `{c}`" for c in columns)
    spread = counts.selectExpr(f"stack({len(columns)}, {pairs}) AS (field, present)")
    return spread.join(expected, "field").withColumn("status", F.when(F.col("present") == F.col("expected"), "CONFORME").otherwise("ECART"))


def gold_scores(checks: DataFrame, false_positive: Column | None = None) -> DataFrame:
    """AGG-12: true positives, false positives and negatives, precision, recall and F1 of boolean ``ok``.

    Without ``false_positive`` none is counted, as in the scores to match.
    """
    tp, fn = F.count_if(F.col("ok")), F.count_if(~F.col("ok"))
    fp = F.lit(0).cast("long") if false_positive is None else F.count_if(false_positive)
    out = checks.agg(tp.alias("tp"), fp.alias("fp") if false_positive is not None else F.max(F.lit(0)).cast("long").alias("fp"), fn.alias("fn"))
    precision = F.coalesce(F.try_divide("tp", F.col("tp") + F.col("fp")), F.lit(1.0))
    recall = F.coalesce(F.try_divide("tp", F.col("tp") + F.col("fn")), F.lit(1.0))
    out = out.withColumn("precision", precision).withColumn("recall", recall)
    f1 = F.coalesce(F.try_divide(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall")), F.lit(0.0))
    return out.withColumn("f1", f1)


def coverage(rows: DataFrame, key: list[str], status: str, known: tuple[str, ...]) -> DataFrame:
    """AGG-07: rows per key and status, known statuses always, others appended."""
    found = [r[0] for r in rows.filter(F.col(status).isNotNull()).select(status).distinct().limit(MOST_STATUSES + 1).collect()]
    if len(found) > MOST_STATUSES:
        raise ValueError(f"{status} has too many values for columns")
    order = [*known, *sorted(set(found) - set(known))]
    return rows.groupBy(*key).pivot(status, order).agg(F.count(F.lit(1))).fillna(0, order)


def _checks(frame: DataFrame, names: list[str], zero: tuple[str, ...] = ()) -> DataFrame:
    """Columns of one row as rows of name, value and whether it holds: a value in ``zero`` must be 0."""
    pairs = ", ".join(f"'{n}', CAST(`{n}` AS BIGINT)" for n in names)
    out = frame.selectExpr(f"stack({len(names)}, {pairs}) AS (name, value)")
    return out.withColumn("ok", F.when(F.col("name").isin(*zero), F.col("value") == 0).otherwise(True) if zero else F.lit(True))


def corpus_checks(documents: DataFrame, provenance: DataFrame, articles: DataFrame, relations: DataFrame) -> DataFrame:
    """AUD-01, AUD-02, AGG-05: the corpus audit as rows of name, value and whether it holds; a few passes over keys and years."""
    ids = documents.groupBy("canonical_id").agg(F.count("*").alias("n"))
    ids = ids.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("count_documents"),
        F.coalesce(F.sum(F.when(~filled(F.col("canonical_id")), F.col("n"))), F.lit(0)).alias("ids_empty"),
        (F.coalesce(F.sum("n"), F.lit(0)) - F.count("canonical_id")).alias("ids_repeated"),
    )
    years = documents.groupBy("year").agg(F.lit(1).alias("one")).agg(F.min("year").alias("first_year"), F.max("year").alias("last_year"), F.count("year").alias("distinct_years"))
    places = articles.groupBy("parent_document_id", "ordinal").agg(F.count("*").alias("n"))
    places = places.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("count_articles"), F.count_if(F.col("n") > 1).alias("duplicate_article_positions"))
    to_documents = {
        "provenance_without_document": (provenance, "canonical_id"),
        "article_without_document": (articles, "parent_document_id"),
        "relation_without_target": (relations, "target_id"),
        "relation_without_source": (relations, "source_id"),
    }
    orphans = orphan_counts(to_documents, documents, "canonical_id").unionByName(orphan_counts({"document_without_provenance": (documents, "canonical_id")}, provenance, "canonical_id"))
    counts = [rows.agg(F.count("*").alias(f"count_{name}")) for name, rows in (("provenance", provenance), ("relations", relations))]
    parts = [
        _checks(ids, ["count_documents", "ids_empty", "ids_repeated"], ("ids_empty", "ids_repeated")),
        _checks(years, ["first_year", "last_year", "distinct_years"]),
        _checks(places, ["count_articles", "duplicate_article_positions"], ("duplicate_article_positions",)),
        *[_checks(c, c.columns) for c in counts],
        orphans.select(F.col("reference").alias("name"), F.col("n_violations").cast("long").alias("value"), (F.col("n_violations") == 0).alias("ok")),
    ]
    out = parts[0]
    for more in parts[1:]:
        out = out.unionByName(more)
    return out


def regression(before: dict[str, DataFrame], after: dict[str, DataFrame], texts: dict[str, str]) -> DataFrame:
    """AUD-04: per table its rows before and after a load and whether none were lost, and how many texts are empty."""
    out = None
    for name, rows in after.items():
        empty = F.count_if(~filled(F.col(texts[name]))) if name in texts else F.max(F.lit(0)).cast("long")
        now = rows.agg(F.count("*").alias("n_after"), F.coalesce(empty, F.lit(0)).alias("n_empty"))
        one = now.join(before[name].agg(F.count("*").alias("n_before")))
        one = one.select(F.lit(name).alias("name"), "n_before", "n_after", "n_empty", ((F.col("n_after") >= F.col("n_before")) & (F.col("n_empty") == 0)).alias("ok"))
        out = one if out is None else out.unionByName(one)
    return out


def court_report(identified: DataFrame, row_id: str, base: str, final: str, expected: int | None = None) -> DataFrame:
    """AUD-05: rows, distinct sources, distinct ids, rows whose id got a suffix, and whether ids are unique and, if given, exactly ``expected`` got one."""
    per_id = identified.groupBy(final).agg(F.count("*").alias("n"), F.count_if(F.col(base) != F.col(final)).alias("suffixed"), F.countDistinct(row_id).alias("rows"))
    out = per_id.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("total"), F.coalesce(F.sum("rows"), F.lit(0)).alias("n_sources"), F.count("*").alias("n_ids"), F.coalesce(F.sum("suffixed"), F.lit(0)).alias("n_suffixed"))
    right = F.lit(True) if expected is None else F.col("n_suffixed") == expected
    return out.withColumn("unique", F.col("n_ids") == F.col("n_sources")).withColumn("as_expected", right)


def anomalies(decisions: DataFrame, raw_sizes: DataFrame, least_bytes: int, known_classes: tuple[str, ...]) -> DataFrame:
    """AUD-06: labelled anomalies of crawled decisions: kind and key (URL, number or hash).

    ``raw_sizes``: raw_path, bytes of the archived pages.
    """
    url = F.col("source_url")
    unknown = ~F.coalesce(F.col("chamber_class").rlike("^(" + "|".join(known_classes) + ")"), F.lit(False))

    def repeated(kind: str, columns: list[str]) -> DataFrame:
        some = decisions
        for c in columns:
            some = some.filter(filled(F.col(c)))
        return some.groupBy(*columns).agg(F.count("*").alias("n")).filter("n > 1").select(F.lit(kind).alias("kind"), F.concat_ws("|", *columns).alias("key"))

    sized = decisions.join(raw_sizes.select("raw_path", "bytes"), "raw_path", "left")
    size = F.col("bytes")
    parts = [
        repeated("number_and_date_repeated", ["decision_number", "date"]),
        decisions.filter(unknown).select(F.lit("unknown_chamber_class").alias("kind"), url.alias("key")),
        decisions.filter(~filled(F.col("decision_number"))).select(F.lit("no_number").alias("kind"), url.alias("key")),
        decisions.filter(~filled(F.col("date"))).select(F.lit("no_date").alias("kind"), url.alias("key")),
        repeated("number_repeated", ["decision_number"]),
        repeated("content_repeated", ["content_hash"]),
        sized.filter(size.isNull()).select(F.lit("raw_missing").alias("kind"), url.alias("key")),
        sized.filter(size == 0).select(F.lit("raw_empty").alias("kind"), url.alias("key")),
        sized.filter((size > 0) & (size < least_bytes)).select(F.lit("raw_small").alias("kind"), url.alias("key")),
    ]
    out = parts[0]
    for more in parts[1:]:
        out = out.unionByName(more)
    return out


def extremes(rows: DataFrame, date: str, row_id: str) -> DataFrame:
    """WIN-12: ids of the earliest and latest dated rows; of equals the lowest id; undated rows come last."""
    return rows.agg(
        F.min_by(row_id, F.struct(F.coalesce(date, F.lit("9999")), row_id)).alias("earliest"),
        F.max_by(row_id, F.struct(F.coalesce(date, F.lit("0000")), -F.col(row_id))).alias("latest"),
    )


def first_where(rows: DataFrame, holds: Column, date: str, row_id: str) -> DataFrame:
    """WIN-12: id of the earliest dated row for which something holds; of equals the lowest id; null if there is none."""
    wanted = holds & F.col(date).isNotNull()
    return rows.agg(F.min_by(row_id, F.when(wanted, F.struct(date, row_id))).alias("first_id"))


def hash_matches(recorded: DataFrame, files: DataFrame) -> DataFrame:
    """AUD-08: whether the recorded SHA-256 is that of the file; ``files``: path, content."""
    actual = files.select("path", F.sha2("content", 256).alias("actual"))
    return recorded.join(actual, "path", "left").withColumn("same", F.col("sha256").eqNullSafe(F.col("actual")))


def sequence_gaps(rows: DataFrame, group: str, number: str) -> DataFrame:
    """WIN-14: numbers missing between the lowest and highest of each group."""
    seen = rows.filter(F.col(number).isNotNull()).select(group, number).distinct()
    following = F.lead(number).over(Window.partitionBy(group).orderBy(number))
    jump = seen.withColumn("__next", following).filter(F.col("__next") > F.col(number) + 1)
    return jump.select(group, F.explode(F.sequence(F.col(number) + 1, F.col("__next") - 1)).alias("missing"))
