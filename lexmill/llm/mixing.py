"""Sources mixed to target shares along a curriculum (problem 9).

Total. The mix is as large as the tightest source allows: the smallest
``available tokens * max_repeats / target_share`` over the sources that have
texts. Then every such source reaches its share and none repeats a text more
often than allowed. A larger total may be asked for; sources that run out then
give what they have and the shares reached are reported. A source without
texts gives nothing; it stays in the report.

Method. Each source has a weight schedule over training, its share times
``1 + slope * (2t - 1)`` for t from 0 to 1. The slopes are centred so that the
weights of all sources add up to the same at every t. The schedule's integral
is the share of a source's tokens due by t. A text whose tokens begin after c
of them is due at the t where the integral is c: the inverse of a quadratic.
Texts are range-sorted by that position.

Scale: tokens are counted in one scan and kept in the shared folder as ids and
numbers. Running sums within a source go over hash buckets: sums of buckets
are accumulated over a small table, then within each bucket, so a source with
a third of all rows is worked on in as many tasks as it has buckets. Only ids
and numbers are shuffled.

Nulls and ties: a text without tokens is no candidate, a null source matches no
target. Texts are drawn in order of a hash of the id, then the id. Repeated
rows are texts of their own. Empty tables give an empty mix and zero shares.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lexmill.llm.tokenizers import TOKENIZER, with_token_counts
from lexmill.session import checkpointed

ROWS_PER_BUCKET = 50_000
MOST_SOURCES = 100_000
#: Largest slope of a source's weight over training.
STEEPEST = 0.5


def plan_mix(stats: list[dict], total: float | None = None) -> list[dict]:
    """Demand in tokens and slope of every source; ``stats``: source, target_share, max_repeats, tokens, texts."""
    open_ = [s for s in stats if s["tokens"] > 0 and s["target_share"] > 0 and s["max_repeats"] > 0]
    if total is None:
        total = min((s["tokens"] * s["max_repeats"] / s["target_share"] for s in open_), default=0.0)
    ranked = sorted(open_, key=lambda s: (s["tokens"] / s["texts"], s["source"]))  # short texts first
    slopes = {s["source"]: STEEPEST * (2 * i / (len(ranked) - 1) - 1) if len(ranked) > 1 else 0.0 for i, s in enumerate(ranked)}
    weight = sum(s["target_share"] for s in open_)
    mean = sum(slopes[s["source"]] * s["target_share"] for s in open_) / weight if weight else 0.0
    out = []
    for s in stats:
        demand = min(s["target_share"] * total, s["tokens"] * s["max_repeats"]) if s in open_ else 0.0
        out.append(s | {"demand": float(demand), "slope": slopes.get(s["source"], mean) - mean, "total": float(total)})
    return out


def due(fraction: Column, slope: Column) -> Column:
    """Where in training (0 to 1) a fraction of a source's tokens is due."""
    steep = (F.sqrt((1 - slope) * (1 - slope) + 4 * slope * fraction) - (1 - slope)) / (2 * slope)
    return F.when(F.abs(slope) < 1e-9, fraction).otherwise(steep)


def token_table(rows: DataFrame, doc_id: str, source: str, text: str, tokenizer: str = TOKENIZER) -> DataFrame:
    """``doc_id, source, n_tokens`` of every text that has tokens, kept in the shared folder."""
    base = rows.select(F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), F.col(text).alias("text"))
    counted = with_token_counts(base.filter(F.length("text") > 0), "text", tokenizer=tokenizer)
    return checkpointed(counted.filter(F.col("n_tokens") > 0))


def _stats(tokens: DataFrame, targets: DataFrame) -> list[dict]:
    held = tokens.groupBy("source").agg(F.sum("n_tokens").alias("tokens"), F.count("*").alias("texts"))
    rows = (
        targets.select("source", "target_share", "max_repeats")
        .join(held, "source", "left")
        .fillna(0, ["tokens", "texts", "target_share", "max_repeats"])
        .limit(MOST_SOURCES + 1)
        .collect()
    )
    if len(rows) > MOST_SOURCES:
        raise ValueError("mix_targets lists too many sources")
    return [r.asDict() for r in rows]


def mix_sources(tokens: DataFrame, targets: DataFrame, total: float | None = None) -> DataFrame:
    """``position, doc_id, source, copy, n_tokens`` of the texts chosen, sorted by position (in tokens)."""
    spark = tokens.sparkSession
    plan = plan_mix(_stats(tokens, targets), total)
    schema = "source string, target_share double, max_repeats int, tokens long, texts long, demand double, slope double, total double"
    planned = spark.createDataFrame([[p[c.split()[0]] for c in schema.split(", ")] for p in plan], schema)
    wanted = F.broadcast(planned.filter("demand > 0"))  # as many rows as mix_targets, which is checked
    buckets = max(1, -(-sum(p["texts"] for p in plan) // ROWS_PER_BUCKET))
    drawn = tokens.withColumn("lot", F.xxhash64(F.lit("mix"), F.col("doc_id").cast("string"))).withColumn(
        "bucket", F.shiftrightunsigned("lot", 1) % buckets
    )
    sums = drawn.groupBy("source", "bucket").agg(F.sum("n_tokens").alias("held"))
    earlier = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select("source", "bucket", F.coalesce(F.sum("held").over(earlier), F.lit(0)).alias("before"))
    inside = Window.partitionBy("source", "bucket").orderBy("lot", "doc_id").rowsBetween(Window.unboundedPreceding, -1)
    placed = drawn.withColumn("within", F.coalesce(F.sum("n_tokens").over(inside), F.lit(0))).join(sums, ["source", "bucket"]).join(wanted, "source")
    first = F.col("before") + F.col("within") + F.col("n_tokens") / 2
    copies = F.least(F.col("max_repeats"), (F.floor((F.col("demand") - first) / F.col("tokens")) + 1).cast("int"))
    chosen = placed.withColumn("copies", copies).filter("copies > 0").withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    reached = F.least(F.lit(1.0), (first + (F.col("copy") - 1) * F.col("tokens")) / F.col("demand"))
    return chosen.select(
        (due(reached, F.col("slope")) * F.col("total")).alias("position"), "doc_id", "source", "copy", "n_tokens"
    ).orderBy("position", "doc_id", "copy")


def mix_shares(mixed: DataFrame, tokens: DataFrame, targets: DataFrame) -> DataFrame:
    """Share reached by every source of the targets, those without texts included."""
    held = tokens.groupBy("source").agg(F.sum("n_tokens").alias("available_tokens"), F.count("*").alias("n_texts"))
    used = mixed.groupBy("source").agg(
        F.sum("n_tokens").alias("mixed_tokens"), F.count("*").alias("n_copies"), F.max("copy").alias("most_repeats")
    )
    everything = Window.partitionBy()  # one row a source
    return (
        targets.select("source", "target_share", "max_repeats")
        .join(held, "source", "left")
        .join(used, "source", "left")
        .fillna(0, ["available_tokens", "n_texts", "mixed_tokens", "n_copies", "most_repeats"])
        .withColumn("actual_share", F.coalesce(F.try_divide(F.col("mixed_tokens"), F.sum("mixed_tokens").over(everything)), F.lit(0.0)))
    )
