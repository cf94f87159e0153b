"""One form for text that looks the same but is coded differently (problem 7).

Method. A text is split into tokens of letters. Every letter has a set of
scripts it can be spelled in: its own and those of its look-alikes. A token
whose letters' own scripts have no script in common is mixed. The sets are
intersected over the token; of the scripts left, the one that most letters of
the text are native to is the consistent spelling (the token's own letters
break a tie), and the other letters are replaced by their look-alikes in it. A token of one script whose letters all have
look-alikes in another is a whole-script confusable. It is respelled if it has
two letters or more amid a text of the other script, or if a mixed token of the
same text shows that letters of its script were slipped in; else it stays, as
any word or letter of another script that stands alone does. Alphabets written in
Arabic letters are told apart likewise: Persian and Urdu forms of a letter become the Arabic one, but
not in a text in which they prevail and that has letters or words only those languages have.

The remaining forms are then brought to one: full-width and positional forms
and ligatures to plain letters, base and combining accent to the precomposed
letter, special spaces to the plain space, special hyphens to the ASCII hyphen,
invisible characters away. What looks different stays: superscripts, vowel
signs, eastern digits, dashes, stretching.

Scale: no shuffle. Two regular expressions in the JVM pass on texts that hold no
unusual character, and none in question; the rest reach Python in blocks of bounded volume.

Nulls stay null, an empty text stays empty, repeated rows come out alike. The
result depends on the text alone. Clashing column names raise.
"""

from __future__ import annotations

import re
import unicodedata
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lexmill.llm.textbatch import by_volume

#: Letters of other scripts that a reader takes for a Latin letter (fixed values).
LATIN_FOR = {
    "Cyrillic": dict(zip("аеорсухѕіјԁԛԝһѵӏАВЕЅІЈКМНОРСТУХԌԚԜҮ", "aeopcyxsijdqwhvlABESIJKMHOPCTYXGQWY", strict=True)),
    "Greek": dict(zip("νοριΑΒΕΖΗΙΚΜΝΟΡΤΥΧϲϳ", "vopiABEZHIKMNOPTYXcj", strict=True)),
    "Armenian": dict(zip("օսհոռգցյՕՍԼՏ", "ouhnnqgjOULS", strict=True)),
    "Cherokee": dict(zip("ᎠᎡᎢᎥᎪᎫᎬᎳᎷᎻᎽᏀᏃᏎᏒᏙᏚᏞᏟᏢᏦᏴ", "DRTiAJEWMHYGZ4RVSLCPKB", strict=True)),
}
#: Latin letters that a reader takes for a plain one amid plain ones (fixed values).
LATIN_OWN = dict(zip("ɑɡᴄᴏᴠᴡᴢꜱ", "agcovwzs", strict=True))
#: Signs that a reader takes for an ASCII one (fixed values).
SIGNS = dict(zip("\u2044\u2215\u2024\u2236\uA789\uFF0F", "//.::/", strict=True))
#: Letters and short words that only Persian or Urdu has (fixed values).
PERSIAN_LETTERS = "پچژگٹڈڑںے"
PERSIAN_WORDS = {"از", "در", "است", "برای", "این", "که", "را", "بود", "شد", "شود", "می", "های", "کے", "کی", "ہے", "میں", "اور", "کا"}
#: Letters of other languages in Arabic script that a reader takes for an Arabic letter (fixed values).
ARABIC_FOR = dict(zip("یکڪھہۃ", "يككههة", strict=True))
SPACE = "\u00A0\u1680\u2000-\u200A\u202F\u205F\u3000"
INVISIBLE = (
    "\u00AD\u034F\u061C\u115F\u1160\u17B4\u17B5\u180B-\u180E\u200B-\u200F\u202A-\u202E"
    "\u2060-\u2064\u2066-\u206F\uFE00-\uFE0F\uFEFF\uFFA0\uFFF9-\uFFFB"
)
HYPHEN = "\u2010\u2011\uFE63"
#: Compatibility forms that look like the plain character.
FORMS = "\U0001D400-\U0001D7FF\u2160-\u217F\uFB00-\uFB06\uFB50-\uFDFF\uFE70-\uFEFC\uFF01-\uFF5E\u212A\u212B\u037E\u0387"
COMBINING = "\u0300-\u036F\u0653-\u0655"
LINE_BREAK = "\u2028\u2029"
FOREIGN = "\u0370-\u03FF\u0400-\u058F\u13A0-\u13F5"

_SPACE, _INVISIBLE, _HYPHEN = (re.compile(f"[{x}]") for x in (SPACE, INVISIBLE, HYPHEN))
_FORMS = re.compile(f"[{FORMS}]+")
_COMBINED = re.compile(f"[^\\W\\d_][{COMBINING}]+")
_LINE_BREAK = re.compile(f"[{LINE_BREAK}]")
_TOKEN = re.compile(r"[^\W\d_]+")
_FOREIGN = re.compile(f"[{FOREIGN}]")
#: What the JVM looks for: a text without any of these stays as it is.
SUSPECT = f"[{SPACE}{INVISIBLE}{HYPHEN}{FORMS}{COMBINING}{LINE_BREAK}{FOREIGN}{''.join(ARABIC_FOR)}{''.join(LATIN_OWN)}{''.join(SIGNS)}]"


#: Ordinary characters: Latin letters and signs, Arabic letters, marks and digits, dashes, quotes; none of them is suspect.
ORDINARY = "\x00-\x9F\xA1-\xAC\xAE-\u024F\u060C\u061B\u061F\u0621-\u0652\u0660-\u0669\u2013\u2014\u2018-\u201D\u2026"
#: A text without any other is passed on by this class of few ranges.
UNUSUAL = f"[^{ORDINARY}]"


SCRIPTS = ("Latin", *LATIN_FOR, "Arabic", "Other")


def script(letter: str) -> str:
    """Script of a letter among those that matter here."""
    c = ord(letter)
    if c < 0x2B0 or 0x1D00 <= c < 0x1D80 or 0x1E00 <= c < 0x1F00 or 0xA720 <= c < 0xA800:
        return "Latin"
    if 0x370 <= c < 0x400 or 0x1F00 <= c < 0x2000:
        return "Greek"
    if 0x400 <= c < 0x530:
        return "Cyrillic"
    if 0x530 <= c < 0x590:
        return "Armenian"
    if 0x13A0 <= c < 0x1400:
        return "Cherokee"
    if 0x600 <= c < 0x780:
        return "Arabic"
    return "Other"


_BACK: dict[tuple[str, str], str] = {}
for _script, _map in LATIN_FOR.items():
    for _a, _b in _map.items():
        _BACK.setdefault((_script, _b), _a)


def spelled(letter: str, into: str) -> str | None:
    """The letter as it is spelled in a script, or None if it has no look-alike there."""
    own = script(letter)
    if own == into:
        return letter
    if into == "Latin":
        return LATIN_FOR.get(own, {}).get(letter)
    latin = letter if own == "Latin" else LATIN_FOR.get(own, {}).get(letter)
    return _BACK.get((into, latin)) if latin else None


def resolved_scripts(token: str) -> set[str]:
    """Scripts in which the whole token can be spelled."""
    left = {*SCRIPTS}
    for letter in token:
        left = {s for s in left if spelled(letter, s) is not None}
    return left


def consistent(text: str) -> tuple[str, int, int]:
    """Text with its tokens in one script each; number of mixed and of whole-script confusable tokens."""
    mixed = whole = 0
    tokens = list(_TOKEN.finditer(text))
    slipped: Counter = Counter()
    letters = Counter(script(x) for m in tokens for x in m[0])
    fixed: dict[int, str] = {}
    confusable: list[tuple[int, str]] = []
    for k, m in enumerate(tokens):
        token = m[0]
        own = Counter(script(x) for x in token)
        if len(own) > 1:
            possible = resolved_scripts(token)
            if possible:
                mixed += 1
                into = max(possible, key=lambda s: (letters[s], own[s], s))
                fixed[k] = "".join(spelled(x, into) for x in token)
                slipped.update({(s, into): n for s, n in own.items() if s != into})
        elif own and (only := next(iter(own))) in LATIN_FOR and "Latin" in resolved_scripts(token):
            whole += 1
            confusable.append((k, only))
    for k, only in confusable:
        if slipped[only, "Latin"] or (len(tokens[k][0]) > 1 and letters["Latin"] > letters[only]):
            fixed[k] = "".join(spelled(x, "Latin") for x in tokens[k][0])
    if not fixed:
        return text, mixed, whole
    out, at = [], 0
    for k in sorted(fixed):
        out += [text[at : tokens[k].start()], fixed[k]]
        at = tokens[k].end()
    return "".join([*out, text[at:]]), mixed, whole


_ARABIC = str.maketrans(ARABIC_FOR)
_SIGNS = str.maketrans(SIGNS)
_OWN, _OWN_LETTERS = str.maketrans(LATIN_OWN), re.compile(f"[{''.join(LATIN_OWN)}]")
_PERSIAN_FORMS, _ARABIC_FORMS, _ONLY_PERSIAN = re.compile("[یکہھ]"), re.compile("[يكةى]"), re.compile(f"[{PERSIAN_LETTERS}]")


def is_persian(text: str) -> bool:
    """Whether the text is in a language whose forms of Arabic letters are its own."""
    forms = len(_PERSIAN_FORMS.findall(text))
    if not forms or forms <= len(_ARABIC_FORMS.findall(text)):
        return False
    return _ONLY_PERSIAN.search(text) is not None or any(m[0] in PERSIAN_WORDS for m in _TOKEN.finditer(text))


def _plain_latin(match: re.Match) -> str:
    token = match[0]
    return token.translate(_OWN) if any(c.isascii() for c in token) else token


def one_form(text: str) -> tuple[str, int, int]:
    """The text in its consistent form; numbers of mixed and whole-script confusable tokens."""
    text = _INVISIBLE.sub("", text)
    text = _FORMS.sub(lambda m: unicodedata.normalize("NFKC", m[0]), text).translate(_SIGNS)
    if not is_persian(text):
        text = text.translate(_ARABIC)
    if _OWN_LETTERS.search(text):
        text = _TOKEN.sub(_plain_latin, text)
    text = _COMBINED.sub(lambda m: unicodedata.normalize("NFC", m[0]), text)
    text = _LINE_BREAK.sub("\n", _HYPHEN.sub("-", _SPACE.sub(" ", text)))
    mixed = whole = 0
    if _FOREIGN.search(text):
        fixed, mixed, whole = consistent(text)
        while fixed != text:  # letters put right may decide on other tokens
            text, (fixed, *_) = fixed, consistent(fixed)
        text = _COMBINED.sub(lambda m: unicodedata.normalize("NFC", m[0]), text)
    return text, mixed, whole


def _normalise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in by_volume(batches, "text"):
        done = [one_form(t) for t in batch.column(1).to_pylist()]
        columns = [batch.column(0), pa.array([d[0] for d in done], pa.string())]
        columns += [pa.array([d[k] for d in done], pa.int32()) for k in (1, 2)]
        yield pa.RecordBatch.from_arrays(columns, ["row_id", "form", "mixed_tokens", "whole_script_tokens"])


def suspect(text: Column) -> Column:
    return text.rlike(UNUSUAL) & text.rlike(SUSPECT)


def suspect_forms(rows: DataFrame, row_id: str, text: str) -> DataFrame:
    """``row_id, form, mixed_tokens, whole_script_tokens, changed`` of the texts that hold a character in question."""
    some = rows.select(F.col(row_id).cast("long").alias("row_id"), F.col(text).alias("text")).filter(suspect(F.col("text")))
    schema = "row_id long, form string, mixed_tokens int, whole_script_tokens int, changed boolean"

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in by_volume(batches, "text"):
            texts = batch.column(1).to_pylist()
            for out in _normalise(iter([batch])):
                changed = pa.array([a != b for a, b in zip(texts, out.column(1).to_pylist())])
                yield pa.RecordBatch.from_arrays([*out.columns, changed], [*out.schema.names, "changed"])

    return some.mapInArrow(work, schema)


def consistent_forms(rows: DataFrame, row_id: str, text: str) -> DataFrame:
    """``row_id, form, changed`` of every row; a null text has a null form."""
    plain = rows.filter(F.col(text).isNull() | ~suspect(F.col(text))).select(
        F.col(row_id).cast("long").alias("row_id"), F.col(text).alias("form"), F.lit(False).alias("changed")
    )
    return plain.unionByName(suspect_forms(rows, row_id, text).select("row_id", "form", "changed"))
