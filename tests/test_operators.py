import random

import pytest
from pyspark.sql import functions as F

from lexmill.operators import audit as A
from lexmill.operators import gazette as G
from lexmill.operators import lifecycle as L
from lexmill.operators import load as O
from lexmill.operators import matching as M
from lexmill.operators import reconcile as R
from lexmill.operators.courts import patched_nodes
from lexmill.operators.review import segment
from lexmill.operators.search import search

ISSUE = """SOMMAIRE
Décret exécutif n° 23-01 du 2 janvier 2023 portant création ... 6
Loi n° 23-02 du 3 janvier 2023 relative aux archives, p. 9

Loi n° 23-02 du 3 janvier 2023 portant code des archives.
Le Président de la République,
Vu la Constitution ;
Article 1er. — Premier.
Art. 2. — Deux.
Fait à Alger, le 3 janvier 2023.
**Décret exécutif n° 01-23 du 2 janvier 2023 portant création d'un fonds**
Vu la loi ;
Article premier. — Un.
Au lieu de :
Arrêté du 5 mars 2022 fixant une liste
Lire le texte.
Loi n° 23-02 du 3 janvier 2023 portant code des archives.
Vu la Constitution ; autre texte.
"""


def issues(spark, text, language="FR"):
    return spark.createDataFrame([(2023, "7", language, text)], "year int, issue string, language string, text string")


def test_acts(spark):
    rows = G.acts(issues(spark, ISSUE)).orderBy("start").collect()
    assert [r.type_slug for r in rows] == ["loi", "de", "loi"]
    assert rows[1].canonical_id == "joradp_2023_007_de_23-01_fr" and rows[1].date == "2023-01-02" and rows[1].subject == "portant création d'un fonds"
    assert rows[0].canonical_id.startswith("joradp_2023_007_loi_23-02_fr_") and rows[0].canonical_id != rows[2].canonical_id
    assert "Au lieu de" in rows[1].full_text and [r.ordinal for r in rows] == [1, 2, 3]
    made = G.act_documents(G.acts(issues(spark, ISSUE))).collect()
    assert {r.publication_number for r in made} == {"JO 2023-007"}


def test_exact_repeats_and_fallback(spark):
    one = "\nLoi n° 1 du 2 mai 2000 portant x.\ncorps"
    rows = G.acts(issues(spark, one + one)).collect()  # no preamble anywhere: all headings count, equal acts once
    assert len(rows) == 1 and rows[0].base_id == "joradp_2023_007_loi_1_fr"
    assert G.acts(issues(spark, "rien")).count() == 0 and G.acts(issues(spark, "").limit(0)).count() == 0


def test_arabic_issue(spark):
    text = "\nمرسوم تنفيذي رقم ٠١-٢٣ مؤرخ في ٢ يناير سنة ٢٠٢٣ يتضمن إنشاء صندوق\nبناء على الدستور\nالمادة الأولى : نص\nالمادة 2: آخر\nحرر بالجزائر في 2 يناير"
    (row,) = G.acts(issues(spark, text, "AR")).collect()
    assert row.canonical_id == "joradp_2023_007_de_23-01_ar" and row.date == "2023-01-02"
    found = G.articles(G.acts(issues(spark, text, "AR")), "canonical_id").orderBy("ordinal").collect()
    assert [(r.article_number, r.text) for r in found] == [("الأولى", "نص"), ("2", "آخر")]


def test_articles(spark):
    text = "Article premier. — Un.\nencore\n**Art. 2 bis. —** Deux\nFait à Alger, le 3 mai\nfin"
    df = spark.createDataFrame([("d", "FR", text), ("e", "FR", "rien"), ("f", "FR", None)], "id string, language string, full_text string")
    got = [(r.ordinal, r.article_number, r.text) for r in G.articles(df, "id").orderBy("ordinal").collect()]
    assert got == [(1, "1er", "Un.\nencore"), (2, "2 bis", "Deux")]


def test_bilingual_pairs(spark):
    rows = [("f1", "LAW", "1", "FR", 1), ("f2", "LAW", "1", "FR", 2), ("a1", "LAW", "1", "AR", 1), ("a2", "LAW", "1", "AR", 2), ("f3", "LAW", "", "FR", 3), ("a3", "LAW", "", "AR", 3), ("f4", "LAW", "9", "FR", 4)]
    df = spark.createDataFrame(rows, "canonical_id string, document_type string, document_number string, language string, ordinal int").withColumn("issue", F.lit(1))
    assert {(r.canonical_id, r.language_pair_id) for r in G.bilingual_pairs(df, ["issue"]).collect()} == {("f1", "a2"), ("f2", "a2"), ("a2", "f2")}


def test_node_patch(spark):
    df = spark.createDataFrame([(30, None, None, "1"), (30, "x", "d", "1"), (5, None, None, None)], "nid int, decision_number string, date string, year string")
    got = sorted((r.nid, r.decision_number or "", r.date or "") for r in patched_nodes(df).collect())
    assert got == [(5, "", ""), (30, "214445", "2021-12-19"), (30, "x", "d")]


def test_match_ladder(spark):
    decisions = [(1, "0012", "2001-01-01", "الغرف المدنية", "telecharge"), (2, "12", "1999-01-01", "الغرف الجزائية", "telecharge"), (3, "7", None, None, "telecharge"), (4, "8", "2000-01-01", None, "erreur")]
    entries = [(1, "12", 1999, None), (2, "12", 1970, "الجزائية"), (3, "12", None, None), (4, "7", 2000, "x"), (5, "8", 2000, None), (6, "000", 2000, None), (7, None, 2000, None)]
    d = spark.createDataFrame(decisions, "id long, decision_number string, date string, chamber string, status string")
    e = spark.createDataFrame([(i, n, y, c, 2010, 3) for i, n, y, c in entries], "id long, decision_number string, decision_year int, chamber string, issue_year int, issue_number int")
    got = {r.entry_id: (r.verdict, r.level, r.decision_id, r.sources) for r in M.index_matches(e, d).collect()}
    both = "supreme_court_html+revue"
    assert got == {
        1: ("MATCH_EXACT", 1, 2, both), 2: ("MATCH_PROBABLE", 2, 2, both), 3: ("MATCH_PROBABLE", 3, 1, both), 4: ("MATCH_PROBABLE", 3, 3, both),
        5: ("NEW", 3, None, "revue_2010-03"), 6: ("UNCERTAIN", 0, None, "revue_2010-03"),
    }


def test_offsets(spark):
    issue = "issue_year int, issue_number int, "
    samples = spark.createDataFrame([(1, 1, 3, k) for k in range(5)] + [(1, 1, 9, 9)] + [(1, 2, 4, 2), (1, 2, 7, 1)], issue + "offset int, seq int")
    got = {r.issue_number: (r.offset_value, r.confidence, r.consensus_pct) for r in M.offset_mode(samples, "text_markers").collect()}
    assert got == {1: (3, "HIGH", 83.3), 2: (7, "LOW", 50.0)}
    pages = spark.createDataFrame([(1, 1, 10, "a\n- 7 -\nb\n\n"), (1, 1, 11, "- 2 -\nx\ny\nz"), (1, 1, 12, "12")], issue + "page_no int, text string")
    assert [(r.offset, r.seq) for r in M.footer_samples(pages).collect()] == [(3, 10)]
    entries = spark.createDataFrame([(1, 1, "12", 4, 1), (1, 1, "99", 4, 2)], issue + "decision_number string, start_page int, id int")
    assert [(r.seq, r.offset) for r in M.search_samples(entries, pages).collect()] == [(1, 8)]
    none = samples.limit(0)
    best = M.best_offsets(spark.createDataFrame([(5, 5)], issue[:-2]), [M.offset_mode(none, m) for m in ("text_markers", "page_footers", "text_search")]).collect()
    assert [(r.offset_value, r.confidence) for r in best] == [(0, "FALLBACK")]


def test_review_segments(spark):
    text = "# 1. الغرفة المدنية\nملف رقم 0123 قرار بتاريخ 2020/01/02\n**الموضوع**: بيع\nالموضوع: ثان\n# 2. الغرفة الجنائية\nقررت المحكمة العليا\nملف رقم 9 قرار بتاريخ 2021/05/06\nالمبدأ: م"
    pages = spark.createDataFrame([(1, 5, text)], "issue int, page_no int, text string")
    rows = segment(pages, ["issue"]).orderBy("decision_number").collect()
    assert [(r.decision_number, r.date, r.chamber, r.has_disposition) for r in rows] == [("0123", "2020-01-02", "الغرف المدنية", True), ("9", "2021-05-06", "الغرف الجزائية", False)]
    assert rows[0].subject == "بيع" and rows[1].principle == "م" and rows[1].subject is None


def test_paired_ids(spark):
    schema = "issue_year int, issue_number int, decision_number string, page int, id int"
    entries = spark.createDataFrame([(1, 1, "a", 5, 1), (1, 1, "a", 5, 2), (1, 1, "a", 9, 3), (1, 1, "b", 1, 4)], schema)
    existing = spark.createDataFrame([(1, 1, "a", 5, 50), (1, 1, "a", 7, 51)], schema)
    assert {(r.id, r.decision_id) for r in M.paired_ids(entries, existing).collect()} == {(1, 50), (3, 51)}


def frame(spark, rows):
    return spark.createDataFrame(rows, "url string, title string, seen string, seq int")


def test_loads(spark):
    target = frame(spark, [("a", "A", "1", 0), ("b", "B", "1", 0)])
    batch = frame(spark, [("b", "", "2", 1), ("c", "C", "2", 2), ("c", "C2", "3", 3)])
    new_target, new = O.insert_or_ignore(target, batch, ["url"], "seq")
    assert {(r.url, r.title) for r in new.collect()} == {("c", "C")} and new_target.count() == 3
    assert O.insert_or_ignore(new_target, batch, ["url"], "seq")[1].count() == 0
    as_set = lambda df: {tuple(r) for r in df.collect()}
    assert as_set(O.upsert(target, batch, ["url"], "seq", keep=("seen",))) == {("a", "A", "1", 0), ("b", "", "1", 1), ("c", "C2", "3", 3)}
    assert as_set(O.partial_upsert(target, batch, ["url"], "seq", ("title",))) == {("a", "A", "1", 0), ("b", "B", "2", 1), ("c", "C2", "3", 3)}
    assert as_set(O.replace_partitions(target, frame(spark, [("b", "x", "9", 9)]), ["url"])) == {("a", "A", "1", 0), ("b", "x", "9", 9)}
    changes = spark.createDataFrame([("a", None, "later" * 3, 5), ("zz", "n", "n", 6)], "url string, title string, seen string, seq int")
    assert as_set(O.patch(target, changes, ["url"], "seq", {"seen": 5})) == {("a", "A", "later", 5), ("b", "B", "1", 0)}
    assert O.strict_insert(target, frame(spark, [("z", "Z", "1", 1)]), ["url"]).count() == 3
    with pytest.raises(Exception, match="duplicate key: b"):
        O.strict_insert(target, batch, ["url"]).collect()
    assert O.upsert(target.limit(0), batch, ["url"], "seq").count() == 2 and O.upsert(target, batch.limit(0), ["url"], "seq").count() == 2


def test_partition_overwrite(spark, tmp_path):
    path = str(tmp_path / "t")
    O.write_partitions(spark.createDataFrame([(1, 1, "a"), (2, 1, "b")], "y int, n int, v string"), path, ["y", "n"])
    O.write_partitions(spark.createDataFrame([(2, 1, "c")], "y int, n int, v string"), path, ["y", "n"])
    assert {r.v for r in spark.read.parquet(path).collect()} == {"a", "c"}


def test_lifecycle(spark):
    scan = spark.createDataFrame([(1, i, i in (2, 3, 5, 6, 7, 9)) for i in range(1, 11)], "g int, n int, miss boolean")
    assert [r.n for r in L.until_misses(scan, ["g"], "n", F.col("miss"), 3).orderBy("n").collect()] == [1, 2, 3, 4, 5, 6, 7]
    pages = spark.createDataFrame([(1, 1, 5), (1, 2, 0), (1, 3, 4)], "g int, p int, k int")
    assert [r.p for r in L.until_empty(pages, ["g"], "p", "k").collect()] == [1]
    waits = spark.range(0, 9).select(L.backoff_seconds(F.col("id").cast("int")).alias("w"))
    assert [r.w for r in waits.collect()] == [0, 2, 6, 14, 30, 62, 122, 182, 242]
    arrivals = spark.createDataFrame([(1, i, a) for i, a in enumerate([0.0, 1.0, 1.5, 10.0, 11.0])], "g int, i int, a double")
    assert [r.start for r in L.limited_starts(arrivals, ["g"], "a", "i", 2.0).orderBy("i").collect()] == [0, 2, 4, 10, 12]


def test_hot_groups_run_in_stretches(spark, monkeypatch):
    """One group of most rows: the same as one row after the other, though no task holds it."""
    monkeypatch.setattr(L, "STRETCH_ROWS", 40)
    rng = random.Random(4)
    for most in (3, 25, 60):
        hot = [("hot", i, rng.random() < (0.95 if i > 200 else 0.6)) for i in range(400)]
        rows = hot + [(None, i, i % 2 == 0) for i in range(30)] + [("all", i, True) for i in range(most + 2)]
        scan = spark.createDataFrame(rows, "g string, n int, miss boolean")
        expected = []
        for group in ("hot", None, "all"):
            run = 0
            for _, n, miss in (r for r in rows if r[0] == group):
                run = run + 1 if miss else 0
                expected.append((group, n))
                if run == most:
                    break
        got = [(r.g, r.n) for r in L.until_misses(scan, ["g"], "n", F.col("miss"), most).collect()]
        assert sorted(got, key=str) == sorted(expected, key=str)
    arrivals = [("hot", i, float(rng.randrange(0, 900))) for i in range(400)] + [("b", i, float(i)) for i in range(20)]
    expected = {}
    for group in ("hot", "b"):
        free = None
        for _, i, a in sorted((r for r in arrivals if r[0] == group), key=lambda r: (r[2], r[1])):
            free = a if free is None else max(a, free + 2.0)
            expected[group, i] = free
    rows = spark.createDataFrame(arrivals, "g string, i int, a double")
    assert {(r.g, r.i): r.start for r in L.limited_starts(rows, ["g"], "a", "i", 2.0).collect()} == expected


def test_one_per_key_of_null_orders(spark):
    rows = spark.createDataFrame([("a", None, 1), ("a", 5, 2), ("a", 7, 3), (None, None, 4), (None, 2, 5)], "k string, o int, v int")
    assert sorted(r.v for r in O.one_per_key(rows, ["k"], "o").collect()) == [1, 4]
    assert sorted(r.v for r in O.one_per_key(rows, ["k"], "o", last=True).collect()) == [3, 5]
    assert "Window" not in O.one_per_key(rows, ["k"], "o")._jdf.queryExecution().toString()


def test_sections_go_on_over_pages(spark):
    rows = [(1, 2, "ملف رقم 1 قرار بتاريخ 2020/01/02"), (1, 1, "# 1. الغرفة المدنية\nx"), (1, 3, "الموضوع: بيع\n# 2. الغرفة الجنائية\nملف رقم 2 قرار بتاريخ 2020/01/03"), (1, 3, "ييي"), (None, 1, "ملف رقم 3 قرار بتاريخ 2020/01/04")]
    pages = spark.createDataFrame(rows, "issue int, page_no int, text string")
    got = {r.decision_number: (r.issue, r.chamber_raw, r.start_page, r.subject) for r in segment(pages, ["issue"]).collect()}
    assert got == {"1": (1, "الغرفة المدنية", 2, "بيع"), "2": (1, "الغرفة الجنائية", 3, None), "3": (None, None, 1, None)}


def test_reconcile_and_audit(spark):
    url = lambda *u: spark.createDataFrame([(x,) for x in u], "url string")
    sides = R.reconcile(url("a", "b", "b", None), url("b", "c"))
    assert {(r.url, r.side) for r in sides.collect()} == {("a", "site_only"), ("b", "both"), ("c", "stored_only")}
    assert R.verdict(sides).first().verdict == "FAIL" and R.verdict(R.reconcile(url("a"), url("a"))).first().verdict == "PASS"
    with pytest.raises(ValueError):
        A.count_by(url("a"), "url; drop")
    gaps = spark.createDataFrame([(1, 1), (1, 4), (1, 4), (2, 9), (1, None)], "y int, n int")
    assert sorted(r.missing for r in A.sequence_gaps(gaps, "y", "n").collect()) == [2, 3]
    scores = A.gold_scores(spark.createDataFrame([(True,), (True,), (False,)], "ok boolean")).first()
    assert (scores.precision, round(scores.recall, 3)) == (1.0, 0.667)


def test_search_wildcards_and_case(spark):
    df = spark.createDataFrame([(1, "s", "Loi ÉTAT a.c"), (2, "s", "loi état abc"), (3, "t", "LOI a_c"), (4, "s", None)], "id int, source string, title string")
    ids = lambda q, s=None: [r.id for r in search(df, q, s, "id", ("title",)).collect()]
    assert ids("LOI") == [3, 2, 1] and ids("a_c") == [3, 2, 1] and ids("a.c") == [1] and ids("état") == [2] and ids(None, "s") == [4, 2, 1]
