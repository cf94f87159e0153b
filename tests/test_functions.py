import pytest
from pyspark.sql import functions as F

from lexmill.functions import classify as C
from lexmill.functions import dates as D
from lexmill.functions import extract as E
from lexmill.functions import text as T


def values(spark, rows, make, schema="x string"):
    rows = [r if isinstance(r, tuple) else (r,) for r in rows]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, " + schema)
    return [r[0] for r in df.select("i", make().alias("v")).orderBy("i").select("v").collect()]


def test_clean_text(spark):
    cases = {"a b\r\n\r\n\r\n c\t\td  ": "a b\n\nc d", " ​ ": None, None: None, "x\n\ny": "x\n\ny", "﻿t": "t", "l\r m": "l\nm"}
    assert values(spark, list(cases), lambda: T.clean_text(F.col("x"))) == list(cases.values())


def test_arabic_and_digits(spark):
    assert values(spark, ["ﻻ ﻷ ﻹ", "مُحَمد"], lambda: T.normalize_arabic(F.col("x"))) == ["لا لأ لإ", "مُحَمد"]
    assert values(spark, ["مُحَمد"], lambda: T.normalize_arabic(F.col("x"), True)) == ["محمد"]
    assert values(spark, ["٠١٢٣٤٥٦٧٨٩ x"], lambda: T.plain_digits(F.col("x"))) == ["0123456789 x"]
    assert values(spark, ["é", None], lambda: T.nfc(F.col("x"))) == ["é", None]


@pytest.mark.parametrize("line,out", [("7799 رارق", "قرار 7799"), ("", ""), ("12/05/2009 خيرات", "تاريخ 12/05/2009"), ("abc دج", "جد abc"), (None, None)])
def test_visual_to_logical(spark, line, out):
    assert values(spark, [line], lambda: T.visual_to_logical(F.col("x"))) == [out]
    if line:
        assert values(spark, [line + "\n\nـ"], lambda: T.normalize_guide_text(F.col("x"))) == [out]


def test_language_slug_keywords_labels(spark):
    assert values(spark, ["abc ض", "ضضض a", "12", None], lambda: T.dominant_language(F.col("x"))) == ["FR", "AR", "FR", "FR"]
    assert values(spark, ["N° 12/A", "***", None], lambda: T.slug(F.col("x"), "none")) == ["n12a", "none", "none"]
    keys = ['a - "b", c', '["x"]', "", None, "-", "é:\nz"]
    assert values(spark, keys, lambda: T.keywords_json(F.col("x"), True)) == ['["a", "\\"b\\"", "c"]', '["x"]', None, None, "[]", '["é:", "z"]']
    assert values(spark, keys, lambda: T.keywords_json(F.col("x"), False))[5] == '["é", "z"]'
    assert values(spark, ["ab: c: d", "x"], lambda: T.without_label(F.col("x"))) == ["c: d", "x"]
    assert values(spark, ["ab : c", "x"], lambda: T.label_of(F.col("x"))) == ["ab", "x"]
    assert values(spark, ["" * 101, "" * 100], lambda: T.needs_ocr(F.col("x"))) == [True, False]


def test_dates(spark):
    french = ["Loi du 20 février 2006", "le 1er juillet 1962", "2 JANVIER 2023", "5 Safar 1427 correspondant au 5 mars 2006", "31 février 2023", "rien", None]
    assert values(spark, french, lambda: D.date_fr(F.col("x"))) == ["2006-02-20", "1962-07-01", "2023-01-02", None, "2023-02-31", None, None]
    arabic = ["مؤرخ في 20 فبراير 2006", "2 جانفي سنة 2023", "٨ أبريل سنة ١٩٦٥", "5 تشرين الأول عام 1970", "لا", None]
    assert values(spark, arabic, lambda: D.date_ar(F.col("x"))) == ["2006-02-20", "2023-01-02", "1965-04-08", "1970-10-05", None, None]
    numeric = ["2013/12/09", "28-1-2014", "19.11.1999", "2013-13-01", "40/01/2000", "", None]
    assert values(spark, numeric, lambda: D.normalize_date(F.col("x"))) == ["2013-12-09", "2014-01-28", "1999-11-19", None, None, None, None]
    assert values(spark, ["12/31/1999"], lambda: D.normalize_date(F.col("x"), day_first=False)) == ["1999-12-31"]
    council = ["20  أفريل  2017", "2017/04/05", "5/4/2017", "20 آذار 2017", None]
    assert values(spark, council, lambda: D.council_date(F.col("x"))) == ["2017-04-20", "2017-04-05", "2017-04-05", None, None]
    assert values(spark, ["le 12 mai 1987", "n° 20451", "(2003)"], lambda: D.first_year(F.col("x"))) == ["1987", None, "2003"]


def test_years(spark):
    rows = [("2001-02-03", "1999"), ("x", "1999"), (None, "1999"), ("abcd-01", "1999"), (None, "0")]
    schema = "x string, y string"
    assert values(spark, rows, lambda: D.year_of(F.col("x")), schema) == [2001, None, None, None, None]
    assert values(spark, rows, lambda: D.year_of(F.col("x"), F.col("y")), schema) == [2001, 1999, 1999, 1999, None]
    assert values(spark, rows, lambda: D.year_of(F.col("x"), F.col("y"), strict=True), schema) == [2001, 1999, 1999, None, None]


def test_numbers(spark):
    rows = [("01-23", 2023), ("23-01", 2023), ("06-01", 2001), ("12", 2000), ("12/345", 1999), ("n° 5–23", 2023), ("", 2000), (None, 2000)]
    assert values(spark, rows, lambda: D.act_number(F.col("x"), F.col("y")), "x string, y int") == ["23-01", "23-01", "01-06", "12", "12-345", "23-05", None, None]
    assert values(spark, ["Décret n° 97-12 du", "Loi 7", "x"], lambda: D.heading_number(F.col("x"), F.lit("FR"))) == ["97-12", None, None]
    assert values(spark, ["قانون رقم 06-01 مؤرخ"], lambda: D.heading_number(F.col("x"), F.lit("AR"))) == ["06-01"]
    assert values(spark, ["رقم القرار:  7799", "x", None], lambda: D.decision_number(F.col("x"))) == ["7799", None, None]
    assert values(spark, ["0012", "000", "", None], lambda: D.bare_number(F.col("x"), True)) == ["12", None, None, None]
    assert values(spark, ["0012", "000", "", None], lambda: D.bare_number(F.col("x"), False)) == ["12", "0", "0", None]
    assert values(spark, ["1 2", "x", None], lambda: D.tolerant_int(F.col("x"))) == [12, None, None]
    assert values(spark, ["2001-02", " 7 -x", "x"], lambda: D.year_before_dash(F.col("x"))) == [2001, 7, None]
    assert values(spark, ["7", "1234"], lambda: D.padded(F.col("x"), 3)) == ["007", "1234"]


FRENCH = {
    "Loi organique n° 1": "loi_org", "LOI n° 2": "loi", "Loisir": "act", "Ordonnance": "ord", "DECRET législatif": "dl", "Décret présidentiel": "dp", "Decret exécutif": "de",
    "Décret du": "dec", "ARRETE": "arr", "Décisions": "dcs", "Circulaire": "circ", "Lettre du": "lettre", "Accord": "accord", "Règlement intérieur": "reg", "Statuts": "reg",
    "Résolution": "res", "Proclamation": "avis", "Autre": "act",
}
ARABIC = {
    "قانون عضوي رقم": "loi_org", "قانون رقم": "loi", "أمر رقم": "ord", "مرسوم رئاسي": "dp", "مراسيم تنفيذية": "de", "مرسومان": "dec", "قرار وزاري": "arr", "مقرر": "dcs",
    "منشور": "circ", "النظام": "nizam", "لوائح": "laiha", "رسالة": "lettre", "إعلان": "avis", "بيان": "avis", "شيء": "act",
}


def test_act_kinds(spark):
    assert values(spark, list(FRENCH), lambda: C.act_slug(F.col("x"), F.lit("FR"))) == list(FRENCH.values())
    assert values(spark, list(ARABIC), lambda: C.act_slug(F.col("x"), F.lit("AR"))) == list(ARABIC.values())
    assert values(spark, ["Ordonnance n° 1", "Avis", None], lambda: C.act_type(F.col("x"), F.lit("FR"))) == ["ORDER", "NOTICE", None]
    assert values(spark, ["Loi n° 1 portant code x..", "Loi"], lambda: C.heading_subject(F.col("x"), F.lit("FR"))) == ["portant code x", None]


def test_classes(spark):
    css = ["post decision civil-chambers-12 x", "a joint-chambers", "civil-chambersx", None]
    assert values(spark, css, lambda: C.taxonomy_class(F.col("x"))) == ["civil-chambers-12", "joint-chambers", None, None]
    assert values(spark, ["civil-chambers-12", "x"], lambda: C.chamber_of_class(F.col("x"))) == ["الغرف المدنية", None]
    assert values(spark, ["node publications-revue jurisprudence", "x"], lambda: C.node_type(F.col("x"))) == ["publications-revue", None]
    titles = ["مجلة عدد خاص", "مجلة-عدد-02-2010", "دليل قرارات", "دليل", "x"]
    assert values(spark, titles, lambda: C.resource_type(F.col("x"))) == ["SPECIAL_ISSUE", "REVUE", "GUIDE", "INDEX", "OTHER"]
    texts = ["x" * 1000, "x" * 250, "x" * 101, "x", None]
    assert values(spark, texts, lambda: C.completeness(F.col("x"), "court")) == ["FULL_TEXT"] * 3 + ["PARTIAL_TEXT"] * 2
    assert values(spark, texts, lambda: C.completeness(F.col("x"), "council")) == ["FULL_TEXT"] + ["INDEX_ONLY"] * 4
    assert values(spark, [("1", 0, 5), ("1", 2000, 5), ("", 2000, 5)], lambda: C.parser_status(F.col("x"), F.col("y"), F.col("z")), "x string, y int, z int") == ["partial", "ok", "error"]


def test_extraction(spark):
    text = "رأس\nلهذه الأسباب تقرر\nرفض الطعن  "
    assert values(spark, [text, "x"], lambda: E.disposition(F.col("x"), "review")) == ["لهذه الأسباب تقرر\nرفض الطعن", None]
    lines = "# عنوان\nبلدية أ\nفلان ضد فلان\nبلدية ب\nشركة ج\nوزارة د\n"
    assert values(spark, [lines, "بلدية", None], lambda: E.parties(F.col("x"))) == ["فلان ضد فلان | بلدية ب | شركة ج", None, None]
    refs = "التشريع: قانون 1\nبمقتضى الأمر 2\nالمادة 5 من القانون المدني. و المادة 5 من القانون المدني."
    assert values(spark, [refs, "x"], lambda: E.legal_references(F.col("x"))) == ["قانون 1 | بمقتضى الأمر 2 | المادة 5 من القانون المدني", None]


PAGE = """<html><a href="/decision/12?x=1">a</a><a class='b' href='https://c.example.invalid/decision/13/#t'>b</a><a href="/decision/12/">c</a><a href="/other/">o</a>
<div class="pagination"><a class="page-numbers" href="?paged=4">4</a><a class="page-numbers" href="/page/9/">9</a></div><a href="/f/a.pdf?v">p</a>
<iframe src="/f/b.pdf"></iframe><script>x("https://d.example.invalid/c.pdf")</script></html>"""


def test_links(spark):
    base = "https://c.example.invalid/list"
    assert values(spark, [PAGE], lambda: E.decision_urls(F.col("x"), base)) == [["https://c.example.invalid/decision/12/", "https://c.example.invalid/decision/13/"]]
    assert values(spark, [PAGE, "x"], lambda: E.last_page(F.col("x"))) == [9, 1] and values(spark, [PAGE], lambda: E.last_page(F.col("x"), paths=False)) == [4]
    assert values(spark, [PAGE], lambda: E.pdf_links(F.col("x"), base)) == [["https://c.example.invalid/f/a.pdf?v", "https://d.example.invalid/c.pdf"]]
    assert len(values(spark, [PAGE], lambda: E.pdf_links(F.col("x"), base, embedded=True))[0]) == 3
    index = "<script>MaxWin('7')</script>", "<a href=\"javascript:MaxWin('12')\">", "<form name='zFrm2'><select name='znjo'><option value='2'><option value='10'><option value='x'></select></form>"
    assert values(spark, list(index), lambda: E.issue_numbers(F.col("x"), F.lit("AR"))) == [["007"], ["012"], ["010", "002"]]
    assert values(spark, [index[2]], lambda: E.issue_numbers(F.col("x"), F.lit("FR"))) == [[]]


def test_court_page():
    html = """<article id="p" class="decision joint-chambers-3"><div class="entry-content"><ul><li>رقم القرار:  0012</li><li>الموضوع: بيع: شراء</li>
    <li><h5>المبدأ :</h5><p>أ</p><p>ب</p></li><li><h5>رد المحكمة العليا عن الوجه المرتبط بالمبدأ</h5></li></ul><p>يتيم</p><ul><li><h5>جديد</h5><p>ج</p></li></ul></div></article>"""
    got = E.court_record(html)
    assert got["chamber"] == "الغرف المجتمعة" and got["chamber_class"] == "joint-chambers-3" and got["decision_number"] == "0012" and got["subject"] == "بيع: شراء"
    assert got["principle"] == "أ\nب" and got["court_response"] == "يتيم" and got["extra_sections"] == {"جديد": "ج"} and got["text"].startswith("رقم القرار")
    assert E.court_record("<p>x</p>") == {"_error": "no decision"} and E.court_record('<article class="decision"></article>') == {"_error": "no content"}


def test_council_page():
    html = """<article class="node jurisprudence"><div class="field--name-field-numm-arr"><div class="field__label">رقم</div>رقم77</div>
    <div class="field--name-field-keywords-juris"><div class="field__item">a</div><div class="field__item">b</div></div><a href="/x.PDF?1">f</a></article>"""
    got = E.council_record(html)
    assert got["node_type"] == "jurisprudence" and got["decision_number"] == "رقم77" and got["keywords"] == "a - b" and got["pdf_url"] == "/x.PDF?1" and got["subject"] is None
    assert "_error" in E.council_record("<article class='page'></article>")


def test_pages_with_nulls(spark):
    df = spark.createDataFrame([(None,), ("<p>",), ("",)], "x string")
    assert [r.r._error for r in df.select(E.court_page(F.col("x")).alias("r")).collect()] == ["no page", "no decision", "no decision"]


def test_registered_functions(spark):
    assert T.register(spark) == ["lexmill_guide_text", "lexmill_nfc"]
    row = spark.sql("SELECT lexmill_nfc('e\u0301') AS a, lexmill_guide_text('2020 cba') AS b, lexmill_nfc(CAST(NULL AS STRING)) AS c").first()
    assert (row.a, row.b, row.c) == ("é", "cba 2020", None)


def test_guide_text(spark):
    rows = ["ﻡﻼﺳ 12.5 cd", " \u200b\n\u00a0x\u0640y ", "", None]
    assert values(spark, rows, lambda: T.normalize_guide_text(F.col("x"))) == ["cd 12.5 سلام", "yx", "", None]
