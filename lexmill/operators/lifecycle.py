"""Status logs, early stops, retries and rate limits as queries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexmill.session import checkpointed, shuffle_width


def latest_status(log: DataFrame, key: str, status: str, at: str, tie: str) -> DataFrame:
    """STR-01: the last status of every key; of equal times the highest tie breaker."""
    return log.groupBy(key).agg(F.max_by(status, F.struct(at, tie)).alias("status"), F.max(at).alias("at"))


def pending(rows: DataFrame, status: str, wanted: tuple[str, ...], order: str, limit: int | None = None) -> DataFrame:
    """FLT-04: rows still to be worked on, in order, on request the first few."""
    out = rows.filter(F.col(status).isin(*wanted)).orderBy(order)
    return out.limit(limit) if limit is not None else out


#: Rows that a stretch of an ordered group has, about.
STRETCH_ROWS = 250_000


def _stretches(rows: DataFrame, group: list[str], order: list[str]) -> DataFrame:
    """Rows with ``__part``: stretches of about ``STRETCH_ROWS`` rows in the order of group and ``order``, a hot group in several.

    Written, so that all that follows sees the same stretches.
    """
    width = shuffle_width(rows.sparkSession, rows.count(), STRETCH_ROWS)
    return checkpointed(rows.repartitionByRange(width, *group, *order).withColumn("__part", F.spark_partition_id()))


def _same(group: list[str], prefix: str = "__of_") -> Column:
    out = F.lit(True)
    for g in group:
        out = out & F.col(g).eqNullSafe(F.col(f"{prefix}{g}"))
    return out


def _named(rows: DataFrame, group: list[str], prefix: str = "__of_") -> DataFrame:
    return rows.select(*[F.col(c).alias(f"{prefix}{c}") if c in group else F.col(c) for c in rows.columns])


def until_misses(scan: DataFrame, group: list[str], order: str, missed: Column, most: int) -> DataFrame:
    """STR-02: rows of a scan up to the one that makes ``most`` misses in a row, per group.

    Runs are counted in stretches; a stretch's first run goes on from those before, of which only lengths are passed on.
    """
    rows = _stretches(scan.select(*group, order, F.coalesce(missed, F.lit(False)).alias("__miss")), group, [order])
    inside = Window.partitionBy(*group, "__part").orderBy(order)
    rows = rows.withColumn("__island", F.sum(F.when(~F.col("__miss"), 1).otherwise(0)).over(inside))
    run = F.sum(F.col("__miss").cast("int")).over(Window.partitionBy(*group, "__part", "__island").orderBy(order))
    rows = rows.withColumn("__run", F.when(F.col("__miss"), run).otherwise(0))
    within = rows.filter(F.col("__run") == most).groupBy(*group).agg(F.min(order).alias("__stop"))
    # per stretch: its first run, its last run, whether it is all misses
    ends = rows.groupBy(*group, "__part").agg(
        F.max(F.when(F.col("__island") == 0, F.col("__run")).otherwise(0)).alias("__first"), F.max_by("__run", order).alias("__last"), F.max("__island").alias("__hits")
    )
    before = Window.partitionBy(*group).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    broken = F.coalesce(F.max(F.when(F.col("__hits") > 0, F.col("__part"))).over(before), F.lit(-1))
    ends = ends.withColumn("__since", broken).withColumn("__past", F.collect_list(F.struct("__part", "__last")).over(before))
    carried = F.aggregate(F.filter("__past", lambda p: p["__part"] >= F.col("__since")), F.lit(0).cast("long"), lambda a, p: a + p["__last"])
    going_on = ends.select(*group, F.col("__part").alias("__at"), carried.alias("__carried"), "__first").filter("__carried > 0")
    going_on = _named(going_on.filter(F.col("__first") + F.col("__carried") >= most), group)
    first_runs = rows.filter((F.col("__island") == 0) & F.col("__miss"))
    across = first_runs.join(going_on, _same(group) & (F.col("__part") == F.col("__at"))).filter(F.col("__run") + F.col("__carried") >= most)
    stops = within.unionByName(across.groupBy(*group).agg(F.min(order).alias("__stop"))).groupBy(*group).agg(F.min("__stop").alias("__stop"))
    return _before(scan, stops, group, F.col(order) <= F.col("__stop"))


def _before(rows: DataFrame, stops: DataFrame, group: list[str], kept: Column) -> DataFrame:
    """Rows of groups without a stop, and those ``kept`` before it; stops are counted apart, so no group is held whole."""
    named = _named(stops, group)
    return rows.join(named, _same(group), "left").filter(F.col("__stop").isNull() | kept).select(*rows.columns)


def until_empty(pages: DataFrame, group: list[str], page: str, n_items: str) -> DataFrame:
    """STR-03: pages before the first empty one, per group."""
    stops = pages.filter(F.col(n_items) == 0).groupBy(*group).agg(F.min(page).alias("__stop"))
    return _before(pages, stops, group, F.col(page) < F.col("__stop"))


def backoff_seconds(attempts: Column, most: int = 60) -> Column:
    """STR-05: total wait of a number of failed attempts, each the power of two of its number, at most ``most``."""
    waits = F.transform(F.sequence(F.lit(1), F.greatest(attempts, F.lit(1))), lambda n: F.least(F.lit(float(most)), F.pow(F.lit(2.0), n)))
    return F.when(attempts <= 0, 0.0).otherwise(F.aggregate(waits, F.lit(0.0), lambda a, x: a + x))


def limited_starts(requests: DataFrame, group: list[str], arrival: str, order: str, delay: float) -> DataFrame:
    """STR-06: start of each request when starts are ``delay`` apart at least: ``t_i = max(a_i, t_(i-1) + d)``.

    In closed form ``d * i + max over j <= i of (a_j - d * j)``: a count and a maximum, both running. They run in
    stretches; of the stretches before only their numbers of requests and maxima are passed on, so a limiter that all
    requests share is no single task.
    """
    columns = requests.columns
    rows = _stretches(requests, group, [arrival, order])
    ordered = Window.partitionBy(*group, "__part").orderBy(arrival, order)
    rows = rows.withColumn("__i", F.row_number().over(ordered) - 1)
    rows = rows.withColumn("__slack", F.max(F.col(arrival) - F.col("__i") * delay).over(ordered.rowsBetween(Window.unboundedPreceding, 0)))
    ends = rows.groupBy(*group, "__part").agg(F.count("*").alias("__n"), F.max("__slack").alias("__most"))
    before = Window.partitionBy(*group).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    ends = ends.withColumn("__base", F.coalesce(F.sum("__n").over(before), F.lit(0)))
    ends = ends.withColumn("__past", F.max(F.col("__most") - F.col("__base") * delay).over(before))
    ends = _named(ends.select(*group, F.col("__part").alias("__at"), "__base", "__past"), group)
    joined = rows.join(ends, _same(group) & (F.col("__part") == F.col("__at")))
    slack = F.greatest(F.col("__past"), F.col("__slack") - F.col("__base") * delay)
    return joined.select(*columns, ((F.col("__i") + F.col("__base")) * delay + slack).alias("start"))
