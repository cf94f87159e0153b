import random

import pytest
from pyspark.sql import functions as F

from lexmill.llm.vocabulary import CHAMBER_NOISE, Matcher, ReferenceTrie, chamber_spellings, fold, map_chambers

CHAMBERS = [
    (1, "الغرفة المدنية", "Chambre civile"),
    (4, "الغرفة التجارية والبحرية", "Chambre commerciale et maritime"),
    (8, "الغرف المجتمعة", "Chambres réunies"),
    (9, "لجنة التعويض عن الحبس", "Commission d'indemnisation de la détention"),
]


def distance(a, b):
    """Edit distance where swapped neighbours count once (no further edit between them)."""
    d = {(i, 0): i for i in range(len(a) + 1)} | {(0, j): j for j in range(len(b) + 1)}
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            d[i, j] = min(d[i - 1, j] + 1, d[i, j - 1] + 1, d[i - 1, j - 1] + (a[i - 1] != b[j - 1]))
            if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
                d[i, j] = min(d[i, j], d[i - 2, j - 2] + 1)
    return d[len(a), len(b)]


@pytest.mark.parametrize("most", [0, 1, 2, 3])
def test_automaton_equals_brute_force(most):
    rng = random.Random(most)
    words = ["".join(rng.choices("abc", k=rng.randrange(1, 9))) for _ in range(150)]
    trie = ReferenceTrie(enumerate(words))
    for _ in range(150):
        value = "".join(rng.choices("abc", k=rng.randrange(1, 9)))
        true = {i: d for i, w in enumerate(words) if (d := distance(value, w)) <= most}
        assert trie.search(value, most) == true


def matcher():
    return Matcher([x for c in CHAMBERS for x in chamber_spellings(*c)], CHAMBER_NOISE)


@pytest.mark.parametrize(
    "value,entry",
    [
        ("CH. CIVILE", 1), ("civile", 1), ("الغرفه المدنيه", 1), ("المدنیة", 1), ("ةيندملا ةفرغلا", 1), ("غ/ المدنية", 1),
        ("chambre civile / الغرفة المدنية", 1), ("# 2. Chambre civvile", 1), ("ﺍﻟﻐﺮﻓﻪ ﺍﻟﻤﺪﻧﻴﻪ", 1), ("الغرفة_المدنية – ق 3", 1),
        ("CH. réunies , sect. 4", 8), ("COMMISSION D'INDEMMNISATION DE LA DETENTION", 9), ("قرار الغرفة التجايرة والبحرية القسم 2", 4),
        ("Chambre arbitrale", None), ("Section 2", None), ("-", None), ("", None), ("غرفة الموثقين", None), ("12345", None),
    ],
)
def test_typed_chambers(value, entry):
    found = matcher().candidates(value)
    assert (found[0][0] if found else None) == entry


def test_spellings_grow_with_the_words_of_a_label():
    long = " ".join(f"الكلمة{i}" for i in range(14))
    assert len(chamber_spellings(1, f"الغرفة {long}", "Chambre x")) < 14 * 12 and chamber_spellings(1, "", "") == []
    # any choice of articles is found
    trie = Matcher(chamber_spellings(1, f"الغرفة {long}", "x"))
    typed = "غرفة " + " ".join(f"{'ال' if i % 3 else ''}كلمة{i}" for i in range(14))
    assert trie.candidates(typed) == [(1, 0)]


def test_folding():
    assert fold("É‏ـ٣ x") == "ex" and fold(" ؟") == ""


def test_rows_nulls_repeats_and_clashes(spark):
    reference = spark.createDataFrame(CHAMBERS, "chamber_id int, label_ar string, label_fr string")
    rows = [(1, None, "a"), (2, "civile", "b"), (2, "civile", "b"), (3, "x" * 50_000, "c"), (4, "", "d")]
    df = spark.createDataFrame(rows, "id long, value string, chamber_id string")
    out = map_chambers(df, "value", reference)
    got = sorted((r.id, r.chamber_id, r.chambers and r.chambers[0].entry_id) for r in out.collect())
    assert got == [(1, "a", None), (2, "b", 1), (2, "b", 1), (3, "c", []), (4, "d", [])]
    assert map_chambers(df.filter(F.lit(False)), "value", reference).count() == 0
    with pytest.raises(ValueError):
        map_chambers(df, "value", reference, into="id")
    empty = reference.filter(F.lit(False))
    assert all(not r.chambers for r in map_chambers(df, "value", empty).collect())
