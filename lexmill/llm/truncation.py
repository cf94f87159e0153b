"""Texts cut off by field limits or broken transfers (problem 10).

Method. A backward character n-gram model: for the last 1, 2, 4, ... 44
characters of a text (``ORDERS``) it compares how often text of the language
comes to an end after them and how often it goes on. An end is the end of a
text, of a line, or of a sentence at its stop; everything else goes on. From
the shortest to the longest context the estimate of P(end | context) is
refined; at each step only the occurrences that the longer context no longer
shares are added, so none counts twice, and the text itself is left out. A text
whose log-odds of ending against going on lie below the threshold of its
language and column was cut. Counts are over all texts. Marks that a transfer
leaves at a cut ("...", "[...]", a lone hyphen, half a character) are taken off
first, so that what stands before them is judged; digits count as one
character, a line of dots as one stop.

Threshold. The log-odds of a language and column have two heaps, ends and cuts.
The threshold is the emptiest place of the smoothed histogram of that language
and column, by shares, with a mild preference (``PULL``) for the usual place
(``USUAL``); it follows the data and is sought alike at every size.

Scale. Only contexts that some text ends with are counted: a bitmap tells a task
which ones, a context being followed to the next longer one only while it
passes. It has ``BITS_A_KEY`` bits for each context, so what passes by chance is
the same share at every size. Beyond ``MOST_BITS`` bits the endings are split by
their last four characters into groups with a bitmap each, and each group's
contexts are counted in a pass of its own; a pass follows only what its group may hold.
A task combines its counts before they are shuffled, and gives away what it holds
beyond ``HELD`` contexts. Endings (the last ``TAIL``
characters with the length of the text) count once for each group of copies,
so a text that came in a million times has the weight of one. Nothing but the
bitmap is collected.

Nulls and edges: a null or empty text is never cut. Repeated rows are judged
alike. A null language is a language of its own. Empty tables give no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexmill.llm.lookalikes import SUSPECT, one_form
from lexmill.llm.textbatch import by_volume, code_points, is_space
from lexmill.session import checkpointed

ORDERS = (1, 2, 4, 6, 9, 12, 16, 20, 25, 30, 36, 44)
#: Bits of the hash that tell a short context; longer ones are told by 63.
SHORT_BITS = {1: 16, 2: 20, 4: 22}
#: Characters of an ending that are looked at: the longest context and a mark.
TAIL = 64
BITS_A_KEY, LEAST_BITS, MOST_BITS = 32, 16, 29
#: Contexts of a task that are combined before they are given away.
HELD = 1_000_000
#: Weight, in texts, of the estimate from the next shorter context.
PRIOR = 4.0
#: Texts that must end alike before their ends count; two cut texts may share a context by chance.
OTHERS = 2
#: Where the threshold usually lies, and what a unit's distance from there weighs beside a share of the texts.
USUAL, PULL = -5.0, 2e-4
STEP = 0.1
#: Stops that end a sentence before white space (fixed values).
STOPS = np.array([ord(c) for c in ".!?؟"], np.uint32)
DOTS = re.compile(r"([._])\1{3,}$")
#: What a transfer leaves behind a cut (fixed values).
MARKS = re.compile(r"(?:\s*[\[(](?:\.\.\.|…)[\])]|…|(?<!\.)\.\.\.|�+|(?<=\w)-|(?<=\w )-)$")
_SUSPECT = re.compile(SUSPECT)
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64."""
    forth = np.full(n, _BASE, np.uint64)
    forth[0] = 1
    back = np.full(n, np.uint64(pow(int(_BASE), -1, 1 << 64)), np.uint64)
    back[0] = 1
    with np.errstate(over="ignore"):
        return np.cumprod(forth, dtype=np.uint64), np.cumprod(back, dtype=np.uint64)


class Contexts:
    """Hashes of the n characters before every position of the texts of a batch."""

    def __init__(self, texts: list[str], seeds: np.ndarray):
        points, self.starts = code_points(texts)
        self.points = points
        letters = points.astype(np.uint64)
        digit = (points >= 48) & (points <= 57) | (points >= 0x660) & (points <= 0x669)
        letters[digit] = 48
        # the language goes into every character, so languages never share a context
        owner_seed = np.repeat(seeds, np.diff(self.starts))
        with np.errstate(over="ignore"):
            letters = (letters + owner_seed) * np.uint64(0xBF58476D1CE4E5B9)
            letters ^= letters >> np.uint64(29)
            forth, self.back = _powers(len(letters) + 1)
            self.sums = np.concatenate([[np.uint64(0)], np.cumsum(letters * forth[:-1], dtype=np.uint64)])

    def at(self, ends: np.ndarray, n: int) -> np.ndarray:
        """63-bit hash of the n characters before each position (all at least n into the batch)."""
        with np.errstate(over="ignore"):
            h = (self.sums[ends] - self.sums[ends - n]) * self.back[ends - n]
            h ^= h >> np.uint64(32)
            h *= np.uint64(0x94D049BB133111EB) + np.uint64(2 * n)
            h ^= h >> np.uint64(31)
        return h >> np.uint64(64 - SHORT_BITS.get(n, 63))


def _slots(h: np.ndarray, n: int, bits: int) -> np.ndarray:
    with np.errstate(over="ignore"):
        return ((h + np.uint64(n)) * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(64 - bits)


#: The order that splits contexts into groups; longer ones are followed by the bitmap.
GROUPING = 4


def _group(h: np.ndarray, groups: int) -> np.ndarray:
    """Group of a context by the hash of its last four characters."""
    return (h.astype(np.uint64) % np.uint64(groups)).astype(np.int32)


def _seed(code: str | None) -> int:
    out = 1469598103934665603
    for b in (code if code is not None else "\x00").encode():
        out = (out ^ b) * 1099511628211 % (1 << 64)
    return out


def ending(tail: str) -> str:
    """The end of a text without a transfer's marks, in one form."""
    tail = tail.rstrip("\n\r")
    if _SUSPECT.search(tail):
        kept = tail[-1:] if tail[-1:] == " " else ""
        tail = one_form(tail)[0].rstrip("\n\r")
        tail += kept if kept and not tail.endswith(" ") else ""
    return DOTS.sub(r"\1", MARKS.sub("", tail))


def _ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Ending, order, hash and the hash of the last four characters; endings shorter than an order lack it."""
    for batch in by_volume(batches, "tail"):
        tails = [ending(t) for t in batch.column(batch.schema.get_field_index("tail")).to_pylist()]
        codes = batch.column(batch.schema.get_field_index("code")).to_pylist()
        seeds = np.array([_seed(c) for c in codes], np.uint64)
        contexts = Contexts(tails, seeds)
        length = np.diff(contexts.starts)
        rows, orders, hashes = [], [], []
        four = np.zeros(len(tails), np.int64)
        some = np.flatnonzero(length >= GROUPING)
        four[some] = contexts.at(contexts.starts[1:][some], GROUPING).astype(np.int64)
        for n in ORDERS:
            long = np.flatnonzero(length >= n)
            rows.append(long)
            orders.append(np.full(len(long), n, np.int32))
            hashes.append(contexts.at(contexts.starts[1:][long], n).astype(np.int64))
        row = pa.array(np.concatenate(rows))
        yield pa.RecordBatch.from_arrays(
            [
                batch.column(batch.schema.get_field_index("ending_id")).take(row),
                batch.column(batch.schema.get_field_index("code")).take(row),
                pa.array(np.concatenate(orders)),
                pa.array(np.concatenate(hashes)),
                pa.array(four[np.concatenate(rows)]),
            ],
            ["ending_id", "code", "n", "h", "four"],
        )


def _bitmap_parts(bits: int):
    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Set bits of this task as 64-bit words."""
        table = np.zeros(1 << (bits - 3), np.uint8)
        for batch in batches:
            h, n = batch.column(0).to_numpy().astype(np.uint64), batch.column(1).to_numpy()
            for order in ORDERS:
                slot = np.unique(_slots(h[n == order], order, bits))
                np.bitwise_or.at(table, (slot >> np.uint64(3)).astype(np.int64), np.uint8(1) << (slot & np.uint64(7)).astype(np.uint8))
        words = table.view("<i8")
        some = np.flatnonzero(words)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(words[some])], ["word", "bits"])

    return parts


def bitmap_size(keys: int) -> tuple[int, int]:
    """Bits of a bitmap (their logarithm) for so many contexts, and into how many groups they are split."""
    wanted = max(LEAST_BITS, (max(1, keys) * BITS_A_KEY - 1).bit_length())
    return min(wanted, MOST_BITS), 1 << max(0, wanted - MOST_BITS)


def _mid_counts(bitmap, bits: int, group: int, groups: int):
    """Counts of the contexts in one group; the short ones are counted with the first."""

    def compact(parts: list[tuple]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        h, inverse = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
        return h, *(np.bincount(inverse, np.concatenate([p[k] for p in parts]), len(h)).astype(np.int64) for k in (1, 2))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = bitmap.value
        short = {n: np.zeros((2, 1 << bits), np.int32) for n, bits in SHORT_BITS.items()}
        long: dict[int, list] = {n: [] for n in ORDERS if n not in SHORT_BITS}
        held = dict.fromkeys(long, 0)
        room = HELD // len(long)
        for batch in by_volume(batches, "text", 1 << 20):
            texts = batch.column(batch.schema.get_field_index("text")).to_pylist()
            seeds = np.array([_seed(c) for c in batch.column(batch.schema.get_field_index("code")).to_pylist()], np.uint64)
            contexts = Contexts(texts, seeds)
            length = np.diff(contexts.starts)
            at = np.arange(1, int(contexts.starts[-1]) + 1)
            inside = at - np.repeat(contexts.starts[:-1], length)
            inner = np.ones(len(at), bool)
            inner[contexts.starts[1:][length > 0] - 1] = False
            at, inside = at[inner], inside[inner]
            after = contexts.points[at]
            following = np.append(contexts.points, 0)[at + 1]
            stops = (after == 10) | (after == 59) & (following == 10) | np.isin(contexts.points[at - 1], STOPS) & is_space(after)
            stops &= contexts.points[at - 1] != 10
            for n in ORDERS:
                if n < GROUPING and group:
                    continue
                h = contexts.at(at[inside >= n], n)
                if n < GROUPING:
                    passed = np.ones(len(h), bool)
                elif n == GROUPING:
                    passed = _group(h, groups) == group
                else:
                    slot = _slots(h, n, bits)
                    passed = (known[slot >> np.uint64(3)] >> (slot & np.uint64(7)).astype(np.uint8)) & 1 == 1
                kept = np.flatnonzero(inside >= n)[passed]
                at, inside, stops, h = at[kept], inside[kept], stops[kept], h[passed]
                if n in SHORT_BITS:
                    own = (h.astype(np.int64) << 1) | stops
                    if SHORT_BITS[n] <= 20:
                        short[n] += np.bincount(own, minlength=2 << SHORT_BITS[n]).reshape(-1, 2).T.astype(np.int32)
                    else:
                        own, k = np.unique(own, return_counts=True)
                        short[n][own & 1, own >> 1] += k.astype(np.int32)
                elif len(h):
                    long[n].append(compact([(h, (~stops).astype(np.int64), stops.astype(np.int64))]))
                    held[n] += len(long[n][-1][0])
                    if held[n] > room:
                        long[n] = [compact(long[n])]
                        held[n] = len(long[n][0][0])
                        if 2 * held[n] > room:  # what is held no longer shrinks
                            yield _counted(n, *long[n].pop())
                            held[n] = 0
        for n, (going_on, ending_) in short.items():
            some = np.flatnonzero(going_on | ending_)
            yield _counted(n, some, going_on[some], ending_[some])
        for n, parts in long.items():
            if parts:
                yield _counted(n, *compact(parts))

    return count


def _counted(n: int, h: np.ndarray, mid: np.ndarray, end: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(np.full(len(h), n, np.int32)), pa.array(h.astype(np.int64)), pa.array(mid.astype(np.int64)), pa.array(end.astype(np.int64))],
        ["n", "h", "mid", "stop"],
    )


def _log_odds(seen: Column) -> Column:
    """From end and mid counts, shortest context first, to log-odds."""
    start = F.struct(F.lit(0.5).alias("p"), F.lit(None).cast("double").alias("e"), F.lit(None).cast("double").alias("m"))

    def refine(a: Column, x: Column) -> Column:
        # what the shorter context saw and this one does not
        e, m = F.greatest(F.lit(0.0), a["e"] - x["e"]), F.greatest(F.lit(0.0), a["m"] - x["m"])
        p = F.when(a["e"].isNull(), a["p"]).otherwise((e + PRIOR * a["p"]) / (e + m + PRIOR))
        return F.struct(p.alias("p"), x["e"].alias("e"), x["m"].alias("m"))

    def last(a: Column) -> Column:
        p = (a["e"] + PRIOR * a["p"]) / (a["e"] + a["m"] + PRIOR)
        p = F.least(F.lit(1 - 1e-9), F.greatest(F.lit(1e-9), p))
        return F.log(p / (1 - p))

    return F.aggregate(seen, start, refine, last)


def ending_odds(rows: DataFrame, doc_id: str, text: str, code: Column) -> DataFrame:
    """``doc_id, code, log_odds`` of every text that is long enough to judge."""
    spark = rows.sparkSession
    base = rows.select(F.col(doc_id).alias("doc_id"), code.alias("code"), F.col(text).alias("text")).filter(F.length("text") > 0)
    tails = base.select("doc_id", "code", F.expr(f"right(text, {TAIL})").alias("tail"), F.length("text").alias("length"))
    # copies of a text have one ending
    keyed = tails.withColumn("ending_id", F.xxhash64("code", "tail", "length"))
    endings = keyed.groupBy("ending_id").agg(F.first("code").alias("code"), F.first("tail").alias("tail"))
    ends = checkpointed(endings.mapInArrow(_ends, "ending_id long, code string, n int, h long, four long"))
    per_context = ends.groupBy("n", "h").agg(F.count("*").alias("end"), F.first("four").alias("four"))
    bits, groups = bitmap_size(per_context.filter(F.col("n") > GROUPING).count())
    mids = None
    for group in range(groups):
        mine = per_context.filter((F.col("n") > GROUPING) & (F.pmod("four", F.lit(groups)) == group)).select("h", "n")
        words = mine.mapInArrow(_bitmap_parts(bits), "word int, bits long")
        merged = words.groupBy("word").agg(F.bit_or("bits").alias("bits")).toPandas()  # at most 2**23 words
        table = np.zeros(1 << (bits - 6), np.int64)
        table[merged["word"].to_numpy()] = merged["bits"].to_numpy()
        bitmap = spark.sparkContext.broadcast(table.view(np.uint8))
        counted = base.select("code", "text").mapInArrow(_mid_counts(bitmap, bits, group, groups), "n int, h long, mid long, stop long")
        mids = counted if mids is None else mids.unionByName(counted)
    mids = mids.groupBy("n", "h").agg(F.sum("mid").alias("mid"), F.sum("stop").alias("stop"))
    counts = per_context.select("n", "h", "end").join(mids, ["n", "h"], "left")
    others = F.col("end") - 1  # but for this text
    end = F.when(others >= OTHERS, others).otherwise(0) + F.coalesce("stop", F.lit(0))
    seen = F.struct("n", end.cast("double").alias("e"), F.coalesce("mid", F.lit(0)).cast("double").alias("m"))
    judged = (
        ends.join(counts, ["n", "h"])
        .groupBy("ending_id")
        .agg(F.array_sort(F.collect_list(seen)).alias("seen"))
        .select("ending_id", _log_odds(F.col("seen")).alias("log_odds"))
    )
    return keyed.select("doc_id", "code", "ending_id").join(judged, "ending_id").select("doc_id", "code", "log_odds")


def threshold(bins: dict[int, int]) -> float:
    """The emptiest place of a histogram in steps of ``STEP``."""
    total = sum(bins.values())
    usual = round(USUAL / STEP)
    places = range(min([*bins, usual]) - 2, max([*bins, usual]) + 3)

    def crowd(b: int) -> float:
        near = sum(bins.get(b + j, 0) * (3 - abs(j)) for j in range(-2, 3)) / 9
        return near / max(total, 1) + PULL * ((b + 0.5) * STEP - USUAL) ** 2

    return (min(places, key=crowd) + 0.5) * STEP


def thresholds(odds: DataFrame) -> DataFrame:
    """``code, threshold`` of each language."""
    bins = odds.groupBy("code", F.floor(F.col("log_odds") / STEP).alias("bin")).agg(F.count("*").alias("k"))

    def one(frame: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"code": frame["code"].iloc[:1], "threshold": [threshold(dict(zip(frame["bin"], frame["k"])))]})

    return bins.groupBy("code").applyInPandas(one, "code string, threshold double")  # at most some 420 bins each


def truncated(odds: DataFrame) -> DataFrame:
    """``odds`` with ``is_cut``; the log-odds are kept in the shared folder, since the threshold needs them first."""
    limits = thresholds(odds).withColumnRenamed("code", "of")
    return odds.join(limits, F.col("code").eqNullSafe(F.col("of"))).select(*odds.columns, (F.col("log_odds") < F.col("threshold")).alias("is_cut"))


def truncation_rates(rows: DataFrame, doc_id: str, source: str, text: str, judged: DataFrame) -> DataFrame:
    """Texts, cut texts and their rate of every source."""
    base = rows.select(F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), (F.length(text) > 0).alias("has_text"))
    cut = judged.filter("is_cut").select("doc_id", F.lit(1).alias("cut"))
    return (
        base.join(cut, "doc_id", "left")
        .groupBy("source")
        .agg(F.count_if("has_text").alias("n_texts"), F.count("cut").alias("n_cut"))
        .withColumn("rate", F.try_divide("n_cut", "n_texts"))
    )
