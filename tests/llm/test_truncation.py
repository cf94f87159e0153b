import numpy as np
import pytest
from pyspark.sql import functions as F

from lexmill.llm import truncation
from lexmill.llm.truncation import ORDERS, Contexts, bitmap_size, ending, ending_odds, threshold, thresholds, truncated, truncation_rates


def test_hashes_tell_contexts_apart():
    texts = ["le registre des déclarations", "un registre des déclarations", "le registre des declarations"]
    c = Contexts(texts, np.array([1, 1, 1], np.uint64))
    for n in (2, 6, 20):
        h = c.at(c.starts[1:], n).tolist()
        assert len({t[-n:] for t in texts}) == len(set(h))
    other = Contexts([texts[0]], np.array([2], np.uint64))
    assert other.at(other.starts[1:], 6)[0] != c.at(c.starts[1:2], 6)[0]
    digits = Contexts(["le 12", "le 95", "le ٢٣"], np.array([1, 1, 1], np.uint64))
    assert len(set(digits.at(digits.starts[1:], 4).tolist())) == 1


@pytest.mark.parametrize(
    "tail,left",
    [("la red...", "la red"), ("la red [...]", "la red"), ("la r�", "la r"), ("la red-", "la red"), ("fin.\n", "fin."), ("x ........", "x ."), ("etc.", "etc."), ("", "")],
)
def test_marks(tail, left):
    assert ending(tail) == left


def corpus(n=300):
    nouns = ["le registre des déclarations", "le bilan de fin d'exercice", "la grille des emplois", "le plan de gestion", "la mise en demeure"]
    verbs = ["fixe", "approuve", "publie", "conserve"]
    rows = []
    for i in range(n):
        body = " ".join(f"Le comité {verbs[(i + j) % 4]} {nouns[(i * 7 + j) % 5]} au vu des résultats." for j in range(4))
        end = ["\nPour le ministre, le secrétaire général", "\n- " + nouns[i % 5] + "\n- " + nouns[(i + 1) % 5], "", "\nTotal : 12.000 DA"][i % 4]
        rows.append((i, "fr", "s", body + end))
    return rows


def test_cut_texts_are_found(spark):
    rows = corpus()
    whole = rows[0][3].split("\n")[0]
    cut = [(1000 + k, "fr", "t", whole[: 60 + 11 * k]) for k in range(8)] + [(1100, "fr", "t", whole[:75] + "..."), (1100, "fr", "t", whole[:75] + "...")]
    odd = [(2000, "fr", "t", None), (2001, "fr", "t", ""), (2002, None, "t", "x"), (2003, "fr", None, (whole + "\n") * 400 + "Total : 7 DA")]
    df = spark.createDataFrame(rows + cut + odd, "doc_id long, code string, source string, text string")
    judged = truncated(ending_odds(df, "doc_id", "text", F.col("code")))
    found = sorted(r.doc_id for r in judged.filter("is_cut").collect())
    plain = [r[0] for r in cut if not r[3].rstrip(".").endswith(("résultats", "."))]
    assert found == sorted(plain)
    rates = {r.source: r for r in truncation_rates(df.dropDuplicates(["doc_id"]), "doc_id", "source", "text", judged.dropDuplicates(["doc_id"])).collect()}
    assert rates["s"].n_cut == 0 and rates["t"].n_cut == len(set(plain)) and rates[None].n_texts == 1


def test_counts_equal_brute_force(spark):
    rows = corpus(60)
    df = spark.createDataFrame(rows, "doc_id long, code string, source string, text string")
    got = {r.doc_id: r.log_odds for r in ending_odds(df, "doc_id", "text", F.col("code")).collect()}

    def masked(t):
        return "".join("0" if c.isdigit() else c for c in t)

    texts = [masked(r[3]) for r in rows]
    unique = {t[-64:] + str(len(t)) + r[3][-64:] for t, r in zip(texts, rows)}
    assert len(unique) <= len(rows)
    ends_of = sorted({(r[3][-64:], len(r[3])) for r in rows})
    for r, text in list(zip(rows, texts))[:12]:
        seen = []
        for n in ORDERS:
            context = text[-n:]
            others = sum(masked(e)[-n:] == context for e, k in ends_of if k >= n) - 1
            mid = stop = 0
            for other in texts:
                for i in range(n, len(other)):
                    if other[i - n : i] == context:
                        end = (other[i] == "\n" or (other[i] == ";" and other[i + 1 : i + 2] == "\n") or (other[i - 1] in ".!?" and other[i].isspace())) and other[i - 1] != "\n"
                        stop, mid = stop + end, mid + (not end)
            seen.append(((others if others >= 2 else 0) + stop, mid))
        p, prior = 0.5, 4.0
        for (e0, m0), (e1, m1) in zip(seen, seen[1:]):
            e, m = max(0, e0 - e1), max(0, m0 - m1)
            p = (e + prior * p) / (e + m + prior)
        p = (seen[-1][0] + prior * p) / (sum(seen[-1]) + prior)
        p = min(1 - 1e-9, max(1e-9, p))
        assert got[r[0]] == pytest.approx(np.log(p / (1 - p)), rel=1e-6)


def test_groups_and_small_tasks_count_alike(spark, monkeypatch):
    df = spark.createDataFrame(corpus(80), "doc_id long, code string, source string, text string")

    def odds():
        return {r.doc_id: round(r.log_odds, 9) for r in ending_odds(df, "doc_id", "text", F.col("code")).collect()}

    once = odds()
    monkeypatch.setattr(truncation, "MOST_BITS", 13)
    monkeypatch.setattr(truncation, "LEAST_BITS", 8)
    assert bitmap_size(700)[1] > 1
    assert odds() == once
    monkeypatch.setattr(truncation, "HELD", 50)
    assert odds() == once


def test_size_of_bitmaps():
    assert bitmap_size(0) == (16, 1) and bitmap_size(1 << 24) == (29, 1) and bitmap_size((1 << 24) + 1) == (29, 2) and bitmap_size(1 << 26) == (29, 4)


def test_threshold_lies_between_the_heaps_at_any_size():
    heaps = {-90: 3, -80: 4, -70: 2, 10: 200, 20: 300, 30: 100, -35: 1}
    few = threshold(heaps)
    assert -6.5 < few < -3.6 and few == threshold({b: 1000 * k for b, k in heaps.items()})
    assert threshold({}) == pytest.approx(-4.95) and threshold({-50: 1}) != pytest.approx(-4.95)


def test_empty(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    odds = ending_odds(df, "doc_id", "text", F.lit("fr"))
    assert odds.count() == 0 and thresholds(odds).count() == 0 and truncated(odds).count() == 0
