"""Orphan references by compressed bitmaps (problem 4).

A reference names a key of a parent table. It is an orphan when no parent has
the key (``missing``, or ``deleted`` when a table of withdrawn keys has it),
and ``late`` when the parent appears only after the referring row.

Method. Keys are spread over key ranges by hash. Inside a range every distinct
key gets an integer (its place in the sorted dictionary of the range) and each
(table, period) that refers into the range becomes a compressed bitmap, as do
the parents of each period and the withdrawn keys. Then

    missing or deleted:  reference AND-NOT any parent
    late for certain:    reference AND parents of later periods
    late or not:         reference AND parents of the same period

and the surviving bits are decoded to keys. The third set is settled by
comparing the two times exactly when the survivors meet the rows again.

Scale. What is shuffled to build bitmaps are distinct (key, table, period)
triples, combined before the shuffle, so a key that a third of all rows name
costs one triple a period. A range holds about ``keys_per_range`` keys at every
input size. Survivors join back on all three columns; a side of that join is
never broadcast by hint, Spark decides by the measured size at run time, and
splits a hot key by its skew handling.

Nulls and ties: a null reference refers to nothing and is no orphan; an empty
string is a key like any other. A row without a time is never late. Where one
parent key occurs several times, its earliest time counts; a parent without a
time is never late. Empty tables give no rows. Columns other than those named
are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexmill.session import shuffle_width

#: Members up to which a container is kept as a sorted array, and bits of one.
ARRAY_MOST = 4096
CONTAINER = 1 << 16


class Bitmap:
    """A set of integers below 2**31 in containers of 65536, each sparse or dense."""

    __slots__ = ("containers",)

    def __init__(self, containers: dict[int, np.ndarray]):
        self.containers = containers

    @classmethod
    def of(cls, values: np.ndarray) -> Bitmap:
        values = np.unique(np.asarray(values, dtype=np.int64))
        high, low = values >> 16, (values & 0xFFFF).astype(np.uint16)
        starts = np.flatnonzero(np.r_[True, high[1:] != high[:-1]]) if len(values) else []
        ends = np.r_[starts[1:], len(values)] if len(values) else []
        return cls({int(high[a]): cls._pack(low[a:b]) for a, b in zip(starts, ends)})

    @staticmethod
    def _pack(low: np.ndarray) -> np.ndarray:
        """Sorted uint16 members while few, else 8 KB of bits (uint8)."""
        if len(low) <= ARRAY_MOST:
            return low
        bits = np.zeros(CONTAINER, dtype=bool)
        bits[low] = True
        return np.packbits(bits)

    @staticmethod
    def _bits(container: np.ndarray) -> np.ndarray:
        if container.dtype == np.uint8:
            return np.unpackbits(container).view(bool)
        bits = np.zeros(CONTAINER, dtype=bool)
        bits[container] = True
        return bits

    @classmethod
    def _members(cls, container: np.ndarray) -> np.ndarray:
        if container.dtype == np.uint16:
            return container
        return np.flatnonzero(cls._bits(container)).astype(np.uint16)

    def _merge(self, other: Bitmap, keep: bool) -> Bitmap:
        """Members that are (keep) or are not in ``other``."""
        out = {}
        for high, mine in self.containers.items():
            theirs = other.containers.get(high)
            if theirs is None:
                left = mine if not keep else mine[:0]
            elif mine.dtype == np.uint8 and theirs.dtype == np.uint8:
                left = self._pack(self._members(mine & (theirs if keep else ~theirs)))
            else:
                members = self._members(mine)
                inside = self._bits(theirs)[members]
                left = self._pack(members[inside == keep])
            if len(left):
                out[high] = left
        return Bitmap(out)

    def and_not(self, other: Bitmap) -> Bitmap:
        return self._merge(other, keep=False)

    def __and__(self, other: Bitmap) -> Bitmap:
        return self._merge(other, keep=True)

    def __or__(self, other: Bitmap) -> Bitmap:
        out = dict(self.containers)
        for high, theirs in other.containers.items():
            mine = out.get(high)
            if mine is None:
                out[high] = theirs
            else:
                out[high] = self._pack(np.union1d(self._members(mine), self._members(theirs)))
        return Bitmap(out)

    def values(self) -> np.ndarray:
        parts = [self._members(c).astype(np.int64) + (high << 16) for high, c in sorted(self.containers.items())]
        return np.concatenate(parts) if parts else np.empty(0, dtype=np.int64)


@dataclass(frozen=True)
class Reference:
    """A table whose ``key`` column refers to the parents; ``time`` may be text."""

    name: str
    rows: DataFrame
    row_id: str
    key: str
    time: str


def event_time(column: Column) -> Column:
    """Text in any of the ISO-like layouts to a time without zone; else null."""
    return column.try_cast("timestamp_ntz")


def _period(time: Column) -> Column:
    """Months since year 0; -1 without a time, before every other period."""
    return F.coalesce(F.year(time) * 12 + F.month(time) - 1, F.lit(-1))


def _micros(time: Column) -> Column:
    return F.unix_micros(time.cast("timestamp"))


#: Kinds in the shuffled triples.
PARENT, WITHDRAWN = "<parent>", "<withdrawn>"


_SURVIVORS = pa.schema(
    [("table_name", pa.string()), ("period", pa.int32()), ("key", pa.string()), ("kind", pa.string()), ("parent_at", pa.int64())]
)


def _verdicts(table: pa.Table) -> pa.Table:
    """Survivors of one key range: table_name, period, key, kind, parent_at."""
    part = table.to_pandas()
    codes, dictionary = pd.factorize(part["key"], sort=True)
    dictionary = np.asarray(dictionary, dtype=object)
    is_parent = (part["table_name"] == PARENT).to_numpy()
    times = np.full(len(dictionary), None, dtype=object)
    times[codes[is_parent]] = np.array(table.column("parent_at").to_pylist(), dtype=object)[is_parent]
    by: dict[tuple[str, int], Bitmap] = {
        key: Bitmap.of(codes[at]) for key, at in part.groupby(["table_name", "period"]).indices.items()
    }
    none = Bitmap({})
    parents = {period: bits for (name, period), bits in by.items() if name == PARENT}
    withdrawn = next((bits for (name, _), bits in by.items() if name == WITHDRAWN), none)
    anyone = none
    for bits in parents.values():
        anyone = anyone | bits
    after: dict[int, Bitmap] = {}
    growing = none
    ordered = sorted({*parents, *(p for n, p in by if n not in (PARENT, WITHDRAWN))}, reverse=True)
    for period in ordered:  # parents of later periods
        after[period] = growing
        growing = growing | parents.get(period, none)
    found: list[list] = [[], [], [], [], []]
    for (name, period), bits in by.items():
        if name in (PARENT, WITHDRAWN):
            continue
        absent = bits.and_not(anyone)
        verdicts = [("deleted", False, absent & withdrawn), ("missing", False, absent.and_not(withdrawn))]
        if period >= 0:
            verdicts += [("late", False, bits & after[period]), ("late", True, bits & parents.get(period, none))]
        for kind, exact, left in verdicts:
            at = left.values()
            keys = dictionary[at].tolist()
            for column, values in zip(found, ([name] * len(at), [period] * len(at), keys, [kind] * len(at), times[at].tolist() if exact else [None] * len(at))):
                column += values
    return pa.table([pa.array(c, f.type) for c, f in zip(found, _SURVIVORS)], schema=_SURVIVORS)


def orphan_references(
    references: list[Reference],
    parents: DataFrame,
    parent_key: str,
    parent_time: str,
    withdrawn: DataFrame,
    withdrawn_key: str,
    keys_per_range: int = 100_000,
) -> DataFrame:
    """``table_name, row_id, period, kind`` of every orphan or late reference."""
    spark = parents.sparkSession
    rows = None
    for r in references:
        time = event_time(F.col(r.time))
        one = r.rows.filter(F.col(r.key).isNotNull()).select(
            F.lit(r.name).alias("table_name"),
            F.col(r.row_id).cast("long").alias("row_id"),
            F.col(r.key).alias("key"),
            time.alias("at"),
            _period(time).alias("period"),
        )
        rows = one if rows is None else rows.unionByName(one)
    parent_at = event_time(F.col(parent_time))
    firsts = (
        parents.filter(F.col(parent_key).isNotNull())
        .groupBy(F.col(parent_key).alias("key"))
        # a parent that is listed once without a time counts as there from the start
        .agg(F.when(F.count(parent_at) == F.count("*"), F.min(parent_at)).alias("at"))
        .select("key", F.lit(PARENT).alias("table_name"), _period(F.col("at")).alias("period"), _micros(F.col("at")).alias("parent_at"))
    )
    gone = withdrawn.filter(F.col(withdrawn_key).isNotNull()).select(
        F.col(withdrawn_key).alias("key"), F.lit(WITHDRAWN).alias("table_name"), F.lit(-1).alias("period")
    )
    named = rows.select("key", "table_name", "period").unionByName(gone).distinct().withColumn("parent_at", F.lit(None).cast("long"))
    total = sum(r.rows.count() for r in references) + parents.count()
    ranges = shuffle_width(spark, total, keys_per_range)
    survivors = (
        named.unionByName(firsts)
        .withColumn("key_range", F.pmod(F.xxhash64("key"), F.lit(ranges)))
        .groupBy("key_range")
        .applyInArrow(_verdicts, "table_name string, period int, key string, kind string, parent_at long")
    )
    return (
        rows.join(survivors, ["table_name", "period", "key"])
        .filter(F.col("parent_at").isNull() | (F.col("parent_at") > _micros(F.col("at"))))
        .select("table_name", "row_id", F.when(F.col("period") >= 0, F.col("period")).alias("period"), "kind")
    )


def orphan_counts(orphans: DataFrame) -> DataFrame:
    """Orphans per table, month of the referring row and kind."""
    month = F.when(
        F.col("period").isNotNull(),
        F.format_string("%04d-%02d", F.floor(F.col("period") / 12).cast("int"), (F.col("period") % 12 + 1).cast("int")),
    )
    return orphans.groupBy("table_name", month.alias("month"), "kind").agg(F.count("*").alias("n_rows"))
