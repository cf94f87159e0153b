import re

import pytest

from lexmill.llm.lookalikes import LATIN_FOR, LATIN_OWN, ORDINARY, SIGNS, SUSPECT, consistent_forms, one_form, resolved_scripts, script, suspect_forms


@pytest.mark.parametrize(
    "text,form",
    [
        ("l'еаu", "l'eau"),  # mixed token
        ("la рӏасе ouverte", "la place ouverte"),  # whole-script confusable in Latin text
        ("accord de Мирград", None),  # a word that looks different
        ("catégories α et β", None),
        ("Noνembre", "November".replace("er", "re")),
        ("m², n° 5 — ١٢", None),  # superscripts, dashes, eastern digits
        ("مُحَمَّد كــ", None),  # vowel signs, stretching
        ("état", "état"),
        ("أحكام", "أحكام"),
        ("ｄｅｓ ２０", "des 20"),
        ("ﬁn", "fin"),
        ("ﻭﺎﻻ", "والا"),
        ("الصید", "الصيد"),
        ("a​b­c‑d", "abc-d"),
        ("", None),
        ("𝐥𝐞 𝟏𝟐", "le 12"),
        ("hɑut ɡré ᴄode", "haut gré code"),
        ("/ɑ/ et ɡ", None),  # letters of a transcription that stand alone
        ("le cօnseil", "le conseil"),
        ("νν.aaМ", "vv.aaM"),  # the mixed token put right makes the text Latin
        ("ՀԱՅԱՍՏԱՆ", None),
        ("12∕2003 ․", "12/2003 ."),
        ("دادگاه عالی برای رسیدگی به پرونده ها", None),  # Persian stays
        ("این قانون در کشور است", None),
        ("القضایا المدنية کما هي", "القضايا المدنية كما هي"),
    ],
)
def test_one_form(text, form):
    assert one_form(text)[0] == (text if form is None else form)
    assert one_form(one_form(text)[0])[0] == one_form(text)[0]


@pytest.mark.parametrize("name", LATIN_FOR)
def test_every_letter_amid_latin_ones_is_respelled(name):
    for letter, plain in LATIN_FOR[name].items():
        assert script(letter) == name and one_form(f"com{letter}te des actes")[0] == f"com{plain}te des actes"


def test_every_sign_and_own_letter():
    for table in (LATIN_OWN, SIGNS):
        for letter, plain in table.items():
            assert one_form(f"ab{letter}cd")[0] == f"ab{plain}cd"


def test_no_ordinary_character_is_suspect():
    ordinary, suspects = re.compile(f"[{ORDINARY}]"), re.compile(SUSPECT)
    assert not [hex(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000 and ordinary.match(chr(c)) and suspects.match(chr(c))]


def test_scripts():
    assert script("а") == "Cyrillic" and resolved_scripts("аb") == {"Latin"}
    assert resolved_scripts("ба") == {"Cyrillic"} and resolved_scripts("bб") == set()


def test_rows(spark):
    rows = [(1, None, 1), (2, "", 1), (3, "plain", 1), (4, "аb", 1), (4, "аb", 2), (5, "ａ" * 100_000, 3), (6, "α", 0)]
    df = spark.createDataFrame(rows, "id long, text string, form int")
    out = {r.row_id: (r.form, r.changed) for r in consistent_forms(df, "id", "text").collect()}
    assert out == {1: (None, False), 2: ("", False), 3: ("plain", False), 4: ("ab", True), 5: ("a" * 100_000, True), 6: ("α", False)}
    assert sorted(r.row_id for r in suspect_forms(df, "id", "text").filter("changed").collect()) == [4, 4, 5]
    assert consistent_forms(df.limit(0), "id", "text").count() == 0
