import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from lexmill.llm import linkage
from lexmill.llm.linkage import (
    VOTES, LabelModel, candidates, chance_votes, common_numbers, decision_attributes, canonical_terms, full_year, index_attributes, link, number_chance, numbers, pieces, profiled,
    split_terms, votes, year_of,
)

CHAMBERS = [(1, "الغرفة المدنية", "Chambre civile"), (2, "الغرفة العقارية", "Chambre foncière"), (3, "الغرفة الجنائية", "Chambre criminelle")]
TERMS = ["bail rural", "préemption", "faute lourde", "astreinte", "donation", "partage", "marque", "brevet", "retraite", "servitude"]
INDEX = "id long, decision_number string, decision_year int, issue_year int, chamber string, subject string, extra string"
DECISIONS = "id long, decision_number string, date string, chamber string, subject string, year string"


def test_parsing(spark):
    rows = spark.createDataFrame([("A l5O 123",), ("l57472",), ("160.955",), ("153566 et 153567",), ("166480/05",), ("00138465",), (None,), ("",)], "n string")
    got = [r.x for r in rows.select(numbers(F.col("n")).alias("x")).collect()]
    assert got == [[150123], [157472], [160955], [153566, 153567], [166480], [138465], [], []]
    dates = spark.createDataFrame([("1993-01-13",), ("19/11/1999",), ("2013/12/09",), (None,), ("x",)], "d string")
    assert [r.y for r in dates.select(year_of(F.col("d")).alias("y")).collect()] == [1993, 1999, 2013, None, None]
    years = spark.createDataFrame([(94, 1995), (3, 2004), (2001, 1990), (None, 2000), (12, None)], "y int, i int")
    assert [r.y for r in years.select(full_year(F.col("y"), F.col("i")).alias("y")).collect()] == [1994, 2003, 2001, None, 2012]
    assert split_terms("bail rural - Faute  lourde ، marque/brevet") == ["bail rural", "faute lourde", "marque/brevet"] and split_terms(None) == []


def test_numbers_in_eastern_digits(spark):
    rows = spark.createDataFrame([("١٥٣٥٦٦",), ("۱۵۳۵۶۶ و ١٥٣٥٦٧",), ("١٦٠.٩٥٥",), ("ملف رقم ١5٠1٢3",), ("٠٠١٣٨٤٦٥",), ("١٢٣٤",)], "n string")
    got = [r.x for r in rows.select(numbers(F.col("n")).alias("x")).collect()]
    assert got == [[153566], [153566, 153567], [160955], [150123], [138465], []]


def shaped(left, right):
    """Profiles of both sides and their members as rows with attributes."""
    rows = left.withColumn("side", F.lit("left")).unionByName(right.withColumn("side", F.lit("right"))).cache()
    unique, members = profiled(rows, canonical_terms(rows))
    return unique, [members.filter(F.col("side") == s).join(unique.drop("side"), "profile") for s in ("left", "right")]


def test_terms_are_spelled_alike(spark):
    terms = ["donation"] * 40 + ["donatoin", "donatiom", "donations", "dnatoin", "nation"] + ["servitude"] * 9 + ["servitudes"] * 9 + ["bail"] * 30 + ["bial", "bal", "xyz", ""]
    got = {r.term: r.canonical for r in canonical_terms(spark.createDataFrame([([t],) for t in terms], "terms array<string>")).collect()}
    near = ("donatoin", "donatiom", "donations", "dnatoin", "nation")
    assert got == {**dict.fromkeys(near, "donation"), "bial": "bail"}
    assert pieces(7, 1) == [(0, 2), (2, 4), (4, 7)]


def tables(spark, n=240):
    decisions, index, true = [], [], set()
    rng = random.Random(7)
    for i in range(n):
        terms = rng.sample(TERMS, 4)
        year, chamber = rng.randrange(1970, 2020), CHAMBERS[i % 3]
        decisions.append((5000 + i, f"{120000 + 37 * i}", f"{year}-03-0{i % 9 + 1}" if i % 11 else None, chamber[2], " - ".join(terms), "y"))
        number = f"{120000 + 37 * i}"
        if i % 10 == 4:
            number = None
        index.append((i, number, year if i % 7 else None, year + 1, chamber[1] if i % 5 else None, " / ".join(terms[::-1]), "e"))
        if number or (i % 7 and i % 11):
            true.add((i, 5000 + i))
    # another series reuses numbers
    decisions += [(9000 + i, f"{120000 + 37 * i}", "1955-01-01", "Chambre criminelle", "zzz", "y") for i in range(0, 60, 3)]
    decisions.append((9999, None, None, None, None, None))
    index.append((9999, None, None, None, None, None, None))
    return spark.createDataFrame(index, INDEX), spark.createDataFrame(decisions, DECISIONS), true


def test_links(spark):
    index, decisions, true = tables(spark)
    reference = spark.createDataFrame(CHAMBERS, "chamber_id int, label_ar string, label_fr string")
    left, right = index_attributes(index, reference), decision_attributes(decisions.unionByName(decisions.filter("id = 5003")), reference)
    found = [(r.left_id, r.right_id) for r in link(left, right).collect()]
    assert len(set(found) & true) > 0.97 * len(true) and len(set(found) - true) < 0.03 * len(true)
    assert found.count((3, 5003)) == 2 and not any(9000 <= b for _, b in found)
    assert link(left.limit(0), right).count() == 0 and link(left, right.limit(0)).count() == 0


def test_candidates_hold_every_pair_with_a_number_and_support(spark):
    index, decisions, _ = tables(spark, 40)
    reference = spark.createDataFrame(CHAMBERS, "chamber_id int, label_ar string, label_fr string")
    left, right = index_attributes(index, reference), decision_attributes(decisions, reference)
    unique, (left, right) = shaped(left, right)
    rows_left, rows_right = left.collect(), right.collect()
    got = {(r.l_profile, r.r_profile) for r in candidates(unique).collect()}
    for a in rows_left:
        for b in rows_right:
            if set(a.nums) & set(b.nums) and (a.chamber is not None and a.chamber == b.chamber or a.year is not None and b.year is not None and abs(a.year - b.year) <= 1 or set(a.terms) & set(b.terms)):
                assert (a.profile, b.profile) in got


def test_a_common_number_makes_fine_blocks(spark):
    rows = [(i, "111111", 1980 + i % 40, 2000, CHAMBERS[i % 3][2], TERMS[i % 10] + " - " + TERMS[(i * 7 + 3) % 10], "") for i in range(900)]
    index = spark.createDataFrame(rows, INDEX)
    decisions = spark.createDataFrame([(9000 + r[0], r[1], f"{r[2]}-01-01", r[4], r[5], "") for r in rows], DECISIONS)
    reference = spark.createDataFrame(CHAMBERS, "chamber_id int, label_ar string, label_fr string")
    unique, (left, right) = shaped(index_attributes(index, reference), decision_attributes(decisions, reference))
    assert common_numbers(unique.limit(400)) == []
    many = spark.range(700).select(F.array(F.lit(111111).cast("long"), F.col("id")).alias("nums"))
    assert common_numbers(many) == [111111]
    got = {(r.l_profile, r.r_profile) for r in candidates(unique).collect()}
    rights = {r.id - 9000: r.profile for r in right.collect()}
    assert all((r.profile, rights[r.id]) in got for r in left.collect())


def test_pairs_on_a_very_common_number_are_the_same_as_on_any_other(spark, monkeypatch):
    rng = random.Random(3)
    index, decisions = [], []
    for i in range(420):
        year, chamber, subject = rng.randrange(1980, 2020), CHAMBERS[i % 3], " - ".join(rng.sample(TERMS, 3))
        number = "111111" if i % 2 else f"111111 et 222222 et {300000 + 41 * i}"
        left = (year, year + 1, chamber[1], subject)
        right = [f"{year}-01-01", chamber[2], subject]
        if i % 4 == 1:  # the year alone is left, or the chamber, or a term
            keep = i // 4 % 3
            right = [right[0] if keep == 0 else None, right[1] if keep == 1 else None, right[2].split(" - ")[0] if keep == 2 else None]
        if i % 4 == 3:  # one attribute agrees, the others do not
            right = [right[0], CHAMBERS[(i + 1) % 3][2], "saisie"]
        if i % 50 == 7:
            left = (None, None, None, None)
        index.append((i, number, *left, "e"))
        decisions.append((9000 + i, number, *right, "y"))
    index.append(index[5])
    reference = spark.createDataFrame(CHAMBERS, "chamber_id int, label_ar string, label_fr string")
    left = index_attributes(spark.createDataFrame(index, INDEX), reference)
    right = decision_attributes(spark.createDataFrame(decisions, DECISIONS), reference)
    unique, sides = shaped(left, right)
    unique = unique.cache()
    held = [{r.id: r for r in a.collect()} for a in sides]
    columns = ["l_profile", "r_profile", *VOTES]

    def results():
        pairs = sorted(map(tuple, candidates(unique).select(columns).collect()))
        return pairs, sorted((r.left_id, r.right_id, round(r.confidence, 9)) for r in link(left, right).collect())

    assert common_numbers(unique) == [111111]
    pairs, found = results()
    monkeypatch.setattr(linkage, "COMMON_ROWS", 10**9)
    pairs_below, found_below = results()
    assert pairs == pairs_below and found == found_below and len(found) > 100
    got = {p[:2] for p in pairs}
    assert all((held[0][i].profile, held[1][9000 + i].profile) in got for i in range(420))


def test_a_pair_that_only_shares_a_number_is_not_linked(spark):
    rng = random.Random(5)
    index, decisions = [], []
    for i in range(300):  # true pairs with rare numbers, so that equal numbers are hardly ever chance
        year, chamber, subject = rng.randrange(1970, 2020), CHAMBERS[i % 3], " - ".join(rng.sample(TERMS, 4))
        number = f"{200000 + 37 * i}" if i % 3 == 0 else None
        index.append((i, number, year, year + 1, chamber[1], subject, "e"))
        decisions.append((9000 + i, number, f"{year}-01-01", chamber[2], subject, "y"))
    for i in range(300, 330):  # nothing but the number
        index.append((i, f"{200000 + 37 * i}", None, None, None, None, "e"))
        decisions.append((9000 + i, f"{200000 + 37 * i}", None, None, None, "y"))
    reference = spark.createDataFrame(CHAMBERS, "chamber_id int, label_ar string, label_fr string")
    left = index_attributes(spark.createDataFrame(index, INDEX), reference)
    right = decision_attributes(spark.createDataFrame(decisions, DECISIONS), reference)
    found = {(r.left_id, r.right_id) for r in link(left, right).collect()}
    assert len(found & {(i, 9000 + i) for i in range(300)}) > 290 and not any(a >= 300 for a, _ in found)


@pytest.mark.parametrize("hot", [False, True])
def test_chance_is_counted_over_all_pairs(spark, hot):
    rng = random.Random(11)

    def side(first, n):
        out = []
        for i in range(n):
            terms = sorted(rng.sample(TERMS, rng.choice([0, 1, 2, 3, 3, 4, 8])))
            nums = [111111] if hot and i % 3 == 0 else [200000 + rng.randrange(30) + 10 * 7 * i] if i % 5 else [333333, 444444, 2000000 + i]
            out.append((first + i, nums if i % 7 else [], rng.choice([None, *range(1990, 1999)]), rng.choice([None, *range(1991, 2001)]), rng.choice([None, 1, 2, 3]), terms))
        return out + out[:5]  # copies count

    schema = "id long, nums array<long>, year int, issue int, chamber long, terms array<string>"
    left, right = side(0, 70), side(1000, 60)
    rows = spark.createDataFrame([("left", *r) for r in left] + [("right", *r) for r in right], "side string, " + schema)
    unique, members = profiled(rows, canonical_terms(rows.limit(0)))
    n = {"left": len(left), "right": len(right)}
    got = chance_votes(unique, members, number_chance(rows, n))
    a, b = (spark.createDataFrame(x, schema) for x in (left, right))
    pairs = a.select(*[F.col(c).alias(f"l_{c}") for c in a.columns]).crossJoin(b.select(*[F.col(c).alias(f"r_{c}") for c in b.columns]))
    every = pairs.select(*[v.alias(k) for k, v in votes().items()]).toPandas()
    names = {x for x in got if "number" not in x}
    assert len(names) == 10 and (not hot or {("number", x) for x in ("year", "delay", "chamber", "subject")} <= set(got))
    for of, table in got.items():
        held = every[(every[list(of)] != "").all(axis=1)] if "number" in of else every
        want = held.groupby(list(of)).size().to_dict()
        mine = table.groupby(list(of))["n"].sum()
        assert {k: int(v) for k, v in mine.items() if v} == {k[0] if isinstance(k, tuple) and len(of) == 1 else k: v for k, v in want.items()}, of


def test_model_needs_more_than_the_number():
    patterns = pd.DataFrame(
        [("same", "same", "usual", "same", "same", 90), ("same", "other", "other", "other", "none", 30), ("other", "other", "other", "other", "same", 40), ("same", "", "", "", "", 4)],
        columns=[*VOTES, "n"],
    )
    chance = pd.DataFrame(
        [("other", "other", "other", "other", "none", 9000), ("other", "same", "usual", "same", "one", 300), ("other", "next", "usual", "other", "same", 2)],
        columns=[*VOTES, "n"],
    )
    model = LabelModel(patterns, chance, (1e-5, 1e-4), 1e6)
    confidence = {r[:5]: r[5] for r in model.table()}
    assert confidence["same", "same", "usual", "same", "same"] > 0.99
    assert confidence["same", "other", "other", "other", "none"] < 0.1 and confidence["other", "other", "other", "other", "same"] < 0.1
    assert confidence["same", "", "", "", ""] <= 0.5


def test_only_known_votes():
    with pytest.raises(KeyError):
        LabelModel(pd.DataFrame({"n": [1]}), pd.DataFrame({"n": [1]}), (0.1, 0.1), 1)
