import random

import numpy as np
import pytest

from lexmill.operators.references import Bitmap, Reference, orphan_counts, orphan_references


@pytest.mark.parametrize("seed", range(6))
def test_bitmaps_equal_sets(seed):
    rng = random.Random(seed)
    most = rng.choice([50, 70_000, 400_000])

    def some():
        start, n = rng.randrange(most), rng.choice([0, 3, 3000, 20_000])
        return {rng.randrange(most) for _ in range(n)} | set(range(start, min(most, start + rng.choice([0, 9000]))))

    a, b = some(), some()
    x, y = (Bitmap.of(np.array(sorted(s), dtype=np.int64)) for s in (a, b))
    assert set(x.and_not(y).values().tolist()) == a - b
    assert set((x & y).values().tolist()) == a & b
    assert set((x | y).values().tolist()) == a | b
    assert x.values().tolist() == sorted(a)


def orphans(spark, rows, parents, gone, size=100_000):
    refs = spark.createDataFrame(rows, "id long, ref string, at string, parent_at string, period string")
    known = spark.createDataFrame(parents, "key string, made string, period string")
    withdrawn = spark.createDataFrame(gone, "key string")
    return orphan_references([Reference("t", refs, "id", "ref", "at")], known, "key", "made", withdrawn, "key", size)


def test_kinds_nulls_ties_and_clashing_columns(spark):
    rows = [
        (1, "a", "2025-03-01T00:00:00", "x", "x"), (2, "b", "2025-03-01 00:00:00", "x", "x"), (3, "c", None, None, None), (4, None, "2025-01-01", None, None),
        (5, "d", "2025-01-01 10:00:00", None, None), (6, "d", "2025-01-01 10:00:00.000001", None, None), (7, "", "2025-01-01", None, None), (8, "e", "2025-01-05", None, None),
        (9, "late", "2024-12-31 23:59:59", None, None), (9, "late", "2024-12-31 23:59:59", None, None), (10, "late", None, None, None), (11, "no time", "2020-01-01", None, None),
        (12, "twice", "2025-02-01", None, None), (13, "A", "2025-03-01", None, None), (14, "x" * 5000, "bad", None, None),
    ]
    parents = [("a", "2025-01-01", ""), ("d", "2025-01-01T10:00:00.000001", ""), ("late", "2025-06-01", ""), ("no time", None, ""), ("twice", "2026-01-01", ""), ("twice", "2025-01-01", ""), (None, "2025-01-01", "")]
    got = sorted((r.row_id, r.kind) for r in orphans(spark, rows, parents, [("c",), ("a",), (None,)], 3).collect())
    assert got == [(2, "missing"), (3, "deleted"), (5, "late"), (7, "missing"), (8, "missing"), (9, "late"), (9, "late"), (13, "missing"), (14, "missing")]
    counts = {(r.month, r.kind): r.n_rows for r in orphan_counts(orphans(spark, rows, parents, [("c",)])).collect()}
    assert counts["2024-12", "late"] == 2 and counts[None, "deleted"] == 1


def test_random_against_brute_force(spark):
    rng = random.Random(3)
    day = lambda: f"2025-{rng.randrange(1, 13):02d}-{rng.randrange(1, 28):02d} 0{rng.randrange(10)}:00:00"
    parents = [(f"k{i}", day() if rng.random() < 0.9 else None, "") for i in range(300)]
    gone = [(f"k{i}",) for i in range(250, 400)]
    # one key has a third of all rows
    rows = [(i, "k7" if rng.random() < 0.33 else f"k{rng.randrange(450)}", day() if rng.random() < 0.9 else None, None, None) for i in range(3000)]
    made, left = {k: t for k, t, _ in parents}, {k for k, in gone}
    true = set()
    for i, key, at, *_ in rows:
        if key not in made:
            true.add((i, "deleted" if key in left else "missing"))
        elif at and made[key] and made[key] > at:
            true.add((i, "late"))
    assert {(r.row_id, r.kind) for r in orphans(spark, rows, parents, gone, 40).collect()} == true


def test_empty_tables(spark):
    assert orphans(spark, [], [], []).count() == 0
    assert [r.kind for r in orphans(spark, [(1, "a", None, None, None)], [], []).collect()] == ["missing"]
