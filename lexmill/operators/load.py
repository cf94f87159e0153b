"""Loads into keyed tables as pure functions of target and batch.

Spark has no unique keys; each load says what the target holds afterwards. The
batch is reduced to one row a key before it meets the target.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def empty_table(spark, schema: StructType | str) -> DataFrame:
    """SNK-01: a table with its columns and no rows."""
    return spark.createDataFrame([], schema)


def one_per_key(batch: DataFrame, key: list[str], order: str, last: bool = False) -> DataFrame:
    """The first or last row of every key in order of arrival; a null order comes first, of equal orders one row is taken.

    An aggregate, so a key that a third of all rows have is combined before it is shuffled.
    """
    place = F.struct(F.col(order).isNotNull().alias("known"), F.col(order).alias("order"))
    row = F.struct(*[F.col(c) for c in batch.columns])
    picked = (F.max_by if last else F.min_by)(row, place)
    return batch.groupBy(*key).agg(picked.alias("__row")).select("__row.*")


def insert_or_ignore(target: DataFrame, batch: DataFrame, key: list[str], order: str) -> tuple[DataFrame, DataFrame]:
    """SNK-02, SNK-05: the new target and the rows inserted: the first of each key that the target lacks."""
    new = one_per_key(batch, key, order).join(target.select(*key), key, "left_anti").select(*target.columns)
    return target.unionByName(new), new


def strict_insert(target: DataFrame, batch: DataFrame, key: list[str]) -> DataFrame:
    """SNK-03: target and batch; a key that is there or comes twice fails the query when it runs."""
    every = target.select(*target.columns).unionByName(batch.select(*target.columns))
    count = F.count("*").over(Window.partitionBy(*key))
    message = F.concat(F.lit("duplicate key: "), F.concat_ws("|", *[F.col(k).cast("string") for k in key]))
    checked = every.withColumn("__c", count)
    return checked.filter(F.when(F.col("__c") > 1, F.raise_error(message).cast("boolean")).otherwise(True)).drop("__c")


def insert_batch(tables: dict[str, DataFrame], batch: dict[str, DataFrame], keys: dict[str, list[str]], order: str) -> tuple[dict, dict]:
    """SNK-04: insert-or-ignore of several tables; new tables and inserted rows by name."""
    done = {name: insert_or_ignore(tables[name], batch[name], keys[name], order) for name in tables}
    return {n: d[0] for n, d in done.items()}, {n: d[1] for n, d in done.items()}


def _merged(target: DataFrame, batch: DataFrame, key: list[str], take: dict[str, Column]) -> DataFrame:
    """Full outer join of both sides under ``t`` and ``s``; ``take`` says what a column becomes where the batch has the key."""
    t = target.select(*[F.col(c).alias(f"t_{c}") for c in target.columns], F.lit(True).alias("t__in"))
    s = batch.select(*[F.col(c).alias(f"s_{c}") for c in batch.columns], F.lit(True).alias("s__in"))
    on = [F.col(f"t_{k}").eqNullSafe(F.col(f"s_{k}")) for k in key]
    condition = on[0]
    for more in on[1:]:
        condition = condition & more
    joined = t.join(s, condition, "full_outer")
    out = []
    for c in target.columns:
        new = F.coalesce(F.col(f"s_{c}"), F.col(f"t_{c}")) if c in key else take.get(c, F.col(f"s_{c}") if c in batch.columns else F.col(f"t_{c}"))
        out.append(F.when(F.col("s__in").isNotNull(), new).otherwise(F.col(f"t_{c}")).alias(c))
    return joined.select(*out)


def upsert(target: DataFrame, batch: DataFrame, key: list[str], order: str, keep: tuple[str, ...] = (), take: dict[str, Column] | None = None) -> DataFrame:
    """SNK-06: the last row of each key replaces every column but ``keep``, which only new keys set."""
    kept = {c: F.when(F.col("t__in").isNotNull(), F.col(f"t_{c}")).otherwise(F.col(f"s_{c}")) for c in keep}
    return _merged(target, one_per_key(batch, key, order, last=True), key, kept | (take or {}))


def partial_upsert(target: DataFrame, batch: DataFrame, key: list[str], order: str, if_empty: tuple[str, ...]) -> DataFrame:
    """SNK-07: like upsert, but an empty new value leaves the old one of these columns."""
    take = {c: F.coalesce(F.nullif(F.col(f"s_{c}"), F.lit("")), F.col(f"t_{c}")) for c in if_empty}
    return upsert(target, batch, key, order, take=take)


def replace_last(target: DataFrame, batch: DataFrame, key: list[str], order: str) -> DataFrame:
    """SNK-08: the last row of every key wins, those of the batch over those of the target."""
    return upsert(target, batch, key, order)


def replace_partitions(target: DataFrame, batch: DataFrame, partition: list[str]) -> DataFrame:
    """SNK-09: rows of the batch's partitions are replaced by the batch."""
    touched = batch.select(*partition).distinct()
    return target.join(touched, partition, "left_anti").select(*target.columns).unionByName(batch.select(*target.columns))


def write_partitions(batch: DataFrame, path: str, partition: list[str]) -> None:
    """SNK-09 at rest: only the partitions that the batch has are overwritten."""
    batch.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partition).parquet(path)


def patch(target: DataFrame, changes: DataFrame, key: list[str], order: str, limit: dict[str, int] | None = None) -> DataFrame:
    """SNK-10: non-null values of the last change of a key replace those of known rows; ``limit`` cuts long ones."""
    last = one_per_key(changes, key, order, last=True)
    known = last.join(target.select(*key), key, "left_semi")
    take = {}
    for c in changes.columns:
        if c in target.columns and c not in key:
            new = F.substring(F.col(f"s_{c}"), 1, limit[c]) if limit and c in limit else F.col(f"s_{c}")
            take[c] = F.coalesce(new, F.col(f"t_{c}"))
    return _merged(target, known.select(*[c for c in known.columns if c in target.columns]), key, take)
