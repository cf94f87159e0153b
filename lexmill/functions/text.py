"""Text: cleaning, ligatures, digits, language, slugs, keyword lists, labels."""

from __future__ import annotations

import re
import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from lexmill.functions.fixed import ARABIC_MARKS, DIGITS, EASTERN_DIGITS, LIGATURES, ODD_SPACES, STRIP


def let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once, however often it is named."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


#: The characters of ``STRIP`` and the line feed.
_SPACES = "".join(map(chr, [*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))


def strip(text: Column) -> Column:
    """Without white space of any kind at either end; only the ends are looked at."""
    return F.btrim(text, F.lit(_SPACES))


def clean_text(text: Column) -> Column:
    """TXT-01: plain spaces, line feeds, single spaces, stripped lines, at most one blank line; empty to null."""
    spaced = F.regexp_replace(F.regexp_replace(text, f"[{ODD_SPACES}]", " "), r"\r\n?", "\n")
    lines = F.regexp_replace(F.regexp_replace(spaced, r"[ \t]+", " "), rf"(?dm)^[{STRIP}]+|[{STRIP}]+$", "")
    return F.nullif(strip(F.regexp_replace(lines, r"\n{3,}", "\n\n")), F.lit(""))


def fold_ligatures(text: Column) -> Column:
    """Lam-alef ligatures to their two letters."""
    for forms, letters in LIGATURES:
        text = F.regexp_replace(text, f"[{forms}]", letters)
    return text


def normalize_arabic(text: Column, strip_marks: bool = False) -> Column:
    """TXT-02: ligatures folded, vowel signs dropped on request, then cleaned."""
    text = fold_ligatures(text)
    return clean_text(F.regexp_replace(text, f"[{ARABIC_MARKS}]", "") if strip_marks else text)


@F.pandas_udf(StringType())
def nfc(text: pd.Series) -> pd.Series:
    """TXT-03: canonical composition (no built-in function has it)."""
    return text.map(lambda t: t if t is None else unicodedata.normalize("NFC", t))


_RUN = re.compile(r"[0-9]+(?:[.,:/-][0-9]+)*|[A-Za-z]+")


def visual_to_logical(line: Column) -> Column:
    """TXT-04: a line reversed, its runs of digits and of Latin letters kept in their order."""
    pattern = F.lit(r"[0-9]+(?:[.,:/-][0-9]+)*|[A-Za-z]+")
    back = F.reverse(line)
    runs = F.regexp_extract_all(back, pattern, F.lit(0))
    between = F.split(back, r"[0-9]+(?:[.,:/-][0-9]+)*|[A-Za-z]+", -1)
    pieces = F.zip_with(between, F.concat(F.transform(runs, F.reverse), F.array(F.lit(""))), lambda a, b: F.concat(a, b))
    return F.when(line.isNotNull(), F.array_join(pieces, ""))


@F.pandas_udf(StringType())
def _guide(text: pd.Series) -> pd.Series:
    def one(t: str | None) -> str | None:
        if t is None:
            return None
        lines = []
        for line in t.split("\n"):
            line = _RUN.sub(lambda m: m[0][::-1], line[::-1])
            line = re.sub("[\u200b-\u200f\u202a-\u202e\ufeff\u0640]", "", unicodedata.normalize("NFKC", line))
            line = re.sub("[ \t\u00a0]+", " ", line).strip()
            if line:
                lines.append(line)
        return "\n".join(lines)

    return text.map(one)


def normalize_guide_text(text: Column) -> Column:
    """TXT-05: lines put in logical order, compatibility forms, invisible marks and stretching away."""
    return _guide(text)


def plain_digits(text: Column) -> Column:
    """TXT-06: eastern digits to plain ones."""
    return F.translate(text, EASTERN_DIGITS, DIGITS)


def dominant_language(text: Column, default: str = "FR") -> Column:
    """TXT-07: AR or FR by the letters of the first 3000 characters; a tie gives the default."""
    head = F.substring(text, 1, 3000)
    arabic = F.regexp_count(head, F.lit(r"[\x{0600}-\x{06FF}]"))
    latin = F.regexp_count(head, F.lit("[a-zA-Z]"))
    return F.when(arabic > latin, "AR").when(latin > arabic, "FR").otherwise(default)


def slug(value: Column, default: str, lower: bool = True) -> Column:
    """TXT-08: only ASCII letters, digits, - and _; null or nothing left gives the default."""
    kept = F.regexp_replace(value.cast("string"), "[^0-9a-zA-Z_-]", "")
    return F.coalesce(F.nullif(F.lower(kept) if lower else kept, F.lit("")), F.lit(default))


def json_strings(items: Column) -> Column:
    """A JSON array of strings with a blank after each comma, other letters as they are."""
    escaped = F.transform(items, lambda x: F.regexp_extract(F.to_json(F.array(x)), r"(?s)^\[(.*)\]$", 1))
    return F.concat(F.lit("["), F.array_join(escaped, ", "), F.lit("]"))


def keywords_json(keywords: Column, commas: bool) -> Column:
    """TXT-09: keywords to a JSON array. Court pages split at commas, the other sources at colons."""
    between = "[-–—,\n]+" if commas else "[-–—:\n]+"
    parts = F.filter(F.transform(F.split(keywords, between), strip), lambda x: x != "")
    given = F.nullif(keywords, F.lit(""))
    return F.when(given.isNull(), None).when(F.startswith(strip(given), F.lit("[")), given).otherwise(json_strings(parts))


def needs_ocr(pages: Column, most: int = 100) -> Column:
    """TXT-10: more than ``most`` private-use characters in the text of the first pages."""
    return F.regexp_count(pages, F.lit(r"[\x{E000}-\x{F8FF}]")) > most


def label_of(text: Column) -> Column:
    """TXT-11: what stands before the first colon."""
    return strip(F.substring_index(text, ":", 1))


def without_label(text: Column) -> Column:
    """TXT-11: the text without its ``label:``."""
    return F.regexp_replace(text, rf"\A[^:]+:[{STRIP}\n]*", "")


def sha256(text: Column) -> Column:
    """HSH-01: SHA-256 of the UTF-8 text or the bytes, in hexadecimal."""
    return F.sha2(text, 256)


def register(spark) -> list[str]:
    """The functions that need Python under SQL names; gives the names."""
    made = {"lexmill_nfc": nfc, "lexmill_guide_text": _guide}
    for name, function in made.items():
        spark.udf.register(name, function)
    return sorted(made)
