import pytest
from pyspark.sql import functions as F

from lexmill.llm.mixing import due, mix_shares, mix_sources, plan_mix, token_table


def targets(spark):
    return spark.createDataFrame([("a", 0.5, 1), ("b", 0.3, 3), ("none", 0.2, 2)], "source string, target_share double, max_repeats int")


def tokens(spark):
    rows = [(i, "a", 10) for i in range(400)] + [(1000 + i, "b", 20) for i in range(40)] + [(5000, "other", 9), (5001, None, 9)]
    return spark.createDataFrame(rows, "doc_id long, source string, n_tokens long")


def test_shares_and_repeats(spark):
    t, g = tokens(spark), targets(spark)
    mixed = mix_sources(t, g)
    shares = {r.source: r for r in mix_shares(mixed, t, g).collect()}
    assert set(shares) == {"a", "b", "none"} and shares["none"].mixed_tokens == 0
    assert abs(shares["a"].actual_share - 0.625) < 0.01 and abs(shares["b"].actual_share - 0.375) < 0.01
    assert shares["a"].most_repeats == 1 and shares["b"].most_repeats <= 3
    rows = mixed.collect()
    assert [r.position for r in rows] == sorted(r.position for r in rows)
    assert len({(r.doc_id, r["copy"]) for r in rows}) == len(rows)
    assert [r.doc_id for r in mix_sources(t, g).collect()] == [r.doc_id for r in rows]


def test_due_inverts_the_schedule(spark):
    for slope in (-0.4, 0.0, 0.3):
        for c in (0.0, 0.2, 0.9, 1.0):
            t = spark.range(1).select(due(F.lit(c), F.lit(slope)).alias("t")).first().t
            assert t + slope * (t * t - t) == pytest.approx(c, abs=1e-9)


def test_weights_add_up_and_short_sources_are_capped():
    stats = [
        {"source": s, "target_share": w, "max_repeats": 2, "tokens": n, "texts": k}
        for s, w, n, k in (("x", 0.5, 900, 9), ("y", 0.3, 800, 80), ("z", 0.2, 0, 0))
    ]
    plan = plan_mix(stats)
    assert sum(p["slope"] * p["target_share"] for p in plan if p["tokens"]) == pytest.approx(0)
    assert plan[0]["demand"] / plan[1]["demand"] == pytest.approx(5 / 3) and plan[2]["demand"] == 0
    assert plan_mix(stats, total=1e6)[0]["demand"] == 1800


def test_texts_to_tokens_and_empty(spark):
    df = spark.createDataFrame([(1, "a", "x y"), (2, "a", None), (3, "a", ""), (4, None, "z")], "doc_id long, source string, text string")
    got = {r.doc_id: r.n_tokens for r in token_table(df, "doc_id", "source", "text").collect()}
    assert set(got) == {1, 4} and got[1] == 2
    empty = tokens(spark).limit(0)
    assert mix_sources(empty, targets(spark)).count() == 0
    assert {r.actual_share for r in mix_shares(mix_sources(empty, targets(spark)), empty, targets(spark)).collect()} == {0.0}
