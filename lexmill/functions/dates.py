"""Dates and numbers as text; a date is never checked against the calendar."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from lexmill.functions.fixed import MONTHS_AR, MONTHS_COUNCIL, MONTHS_FR
from lexmill.functions.text import clean_text, let, plain_digits, strip


def padded(number: Column, width: int) -> Column:
    """Zeros in front up to the width; a longer number is kept whole (``lpad`` would cut it)."""
    text = number.cast("string")
    return F.when(F.length(text) < width, F.lpad(text, width, "0")).otherwise(text)


def _month(name: Column, months: dict[str, str]) -> Column:
    return F.try_element_at(F.create_map(*[F.lit(x) for pair in months.items() for x in pair]), name)


def _found(text: Column, pattern: str, group: int) -> Column:
    return F.nullif(F.regexp_extract(text, pattern, group), F.lit(""))


def _day(day: Column) -> Column:
    return padded(day.cast("int"), 2)


#: A day, a word and a year; the first such place decides, also where the word is no month.
DATE_FR = r"(?iu)(?U)\b([0-9]{1,2})(?:er)?\s+([a-zéèûô]+)\s+([0-9]{4})\b"
DATE_AR = rf"(?U)\b([0-9]{{1,2}})\s*({'|'.join(MONTHS_AR)})\s*(?:سنة\s+|عام\s+)?([0-9]{{4}})\b"


def _named_date(text: Column, pattern: str, month) -> Column:
    """The first place that fits, found once and then taken apart."""

    def read(found: Column) -> Column:
        name = month(F.regexp_extract(found, pattern, 2))
        return F.concat(_found(found, pattern, 3), F.lit("-"), name, F.lit("-"), _day(_found(found, pattern, 1)))

    return let(F.regexp_substr(text, F.lit(pattern)), read)


def date_fr(text: Column) -> Column:
    """DAT-01: the first French date, ISO."""
    return _named_date(text, DATE_FR, lambda name: _month(F.translate(F.lower(name), "éèû", "eeu"), MONTHS_FR))


def date_ar(text: Column) -> Column:
    """DAT-02: the first Arabic date, eastern digits included, ISO."""
    return _named_date(plain_digits(text), DATE_AR, lambda name: _month(name, MONTHS_AR))


def _ymd(text: Column, between: str) -> Column:
    pattern = rf"(\d{{4}})[{between}](\d{{1,2}})[{between}](\d{{1,2}})"
    return _in_range(*[_found(text, pattern, g) for g in (1, 2, 3)])


def _dmy(text: Column, between: str, day_first: bool = True) -> Column:
    pattern = rf"(\d{{1,2}})[{between}](\d{{1,2}})[{between}](\d{{4}})"
    first, second, year = (_found(text, pattern, g) for g in (1, 2, 3))
    return _in_range(year, second, first) if day_first else _in_range(year, first, second)


def _in_range(year: Column, month: Column, day: Column) -> Column:
    fits = month.cast("int").between(1, 12) & day.cast("int").between(1, 31)
    return F.when(fits, F.concat_ws("-", year, _day(month), _day(day)))


def normalize_date(raw: Column, day_first: bool = True) -> Column:
    """DAT-03: a numeric date in either order, ISO, else null."""
    return let(clean_text(raw), lambda text: F.coalesce(_ymd(text, "-/."), _dmy(text, "-/.", day_first)))


def council_date(raw: Column) -> Column:
    """DAT-04: a date of the administrative court's pages: month by name, then numeric orders."""
    pattern = rf"(\d{{1,2}})\s+({'|'.join(MONTHS_COUNCIL)})\s+(\d{{4}})"

    def read(text: Column) -> Column:
        month = _month(F.regexp_extract(text, pattern, 2), MONTHS_COUNCIL)
        named = F.concat(_found(text, pattern, 3), F.lit("-"), month, F.lit("-"), _day(_found(text, pattern, 1)))
        return F.coalesce(named, _ymd(text, "/-"), _dmy(text, "/-"))

    return let(clean_text(raw), read)


def first_year(raw: Column) -> Column:
    """DAT-05: the first year of the last or this century that stands as a word."""
    return F.regexp_substr(raw, F.lit(r"(?U)\b(19\d\d|20\d\d)\b"))


def year_of(date: Column, fallback: Column | None = None, strict: bool = False) -> Column:
    """DAT-06: the year of an ISO date. The fallback serves a date that is missing (``strict``) or has no year."""
    year = F.when(F.length(date) >= 4, F.substring(date, 1, 4).try_cast("int"))
    if fallback is None:
        return year
    fallback = fallback.try_cast("int")
    if strict:
        return F.when(F.length(date) >= 4, year).otherwise(F.nullif(fallback, F.lit(0)))
    return F.coalesce(F.when(F.substring(date, 1, 4).rlike(r"^\d{4}$"), year), F.nullif(fallback, F.lit(0)))


def act_number(number: Column, year: Column) -> Column:
    """NUM-01: ``yy-nn``; the parts change places when the second is the year's suffix."""
    kept = F.translate(F.regexp_replace(number, "[^0-9–/-]", ""), "–/", "--")
    parts = F.split(kept, "-", -1)
    first, second = F.get(parts, F.lit(0)), F.get(parts, F.lit(1))
    suffix = F.right(year.cast("string"), F.lit(2))
    swapped = F.when((second == suffix) & (first != suffix), F.concat(suffix, F.lit("-"), padded(first.try_cast("int"), 2)))
    ordered = F.when(first == suffix, F.concat(suffix, F.lit("-"), padded(second.try_cast("int"), 2)))
    two = F.coalesce(swapped, ordered, F.concat(first, F.lit("-"), second))
    return F.when(F.nullif(number, F.lit("")).isNull(), None).when(F.size(parts) == 2, two).otherwise(kept)


def heading_number(heading: Column, language: Column) -> Column:
    """NUM-02: the number of an act in its heading."""
    parts = r"\s*([0-9]{2,4}[-–/][0-9]{1,4}|[0-9]+)"
    return F.when(language == "AR", _found(heading, "رقم" + parts, 1)).otherwise(_found(heading, r"(?iu)(?U)\bn°?" + parts, 1))


def decision_number(raw: Column) -> Column:
    """NUM-03: the first run of digits, as written."""
    return F.regexp_substr(clean_text(raw), F.lit(r"\d+"))


def bare_number(number: Column, zero_is_null: bool) -> Column:
    """NUM-04: without zeros in front; only zeros give null or ``0``."""
    kept = F.ltrim(strip(number) if zero_is_null else number, F.lit("0"))
    return F.nullif(kept, F.lit("")) if zero_is_null else F.when(number.isNotNull(), F.coalesce(F.nullif(kept, F.lit("")), F.lit("0")))


def tolerant_int(text: Column) -> Column:
    """NUM-05: an integer written with blanks, else null."""
    return F.replace(text, F.lit(" "), F.lit("")).try_cast("int")


def year_before_dash(text: Column) -> Column:
    """NUM-05: the integer before the first dash, else null."""
    return strip(F.substring_index(text, "-", 1)).try_cast("int")
